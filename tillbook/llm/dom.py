"""Block structure of an HTML page: elements that hold blocks, with statistics for a classifier.

Inline elements (links, emphasis, spans) belong to the block around them. A block is a run of text
without an element of block kind in between. Missing end tags are implied where HTML implies them.
"""

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

# HTML's element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title".split())
#: Not shown as text where they have an end; without one, what follows is the page's.
HIDDEN = frozenset("noscript template iframe svg canvas select annotation annotation-xml".split())
INLINE = frozenset(
    "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose msub msup msubsup munder mover "
    "munderover mmultiscripts mtable mtr mtd semantics maction object "
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr br td th".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre search section table ul".split()
)
CLOSES_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "option": {"option"}, "thead": {"tr"}, "tbody": {"thead", "tr"}}
SCOPE = frozenset("ul ol dl table html body td th".split())
CONTROLS = frozenset("input button select textarea option".split())
GROUPS = (
    "article main", "nav menu", "header hgroup", "footer", "aside", "form fieldset button dialog", "section", "div center", "p",
    "h1 h2 h3 h4 h5 h6", "li dt dd", "ul ol dl dir", "table thead tbody tfoot tr caption", "blockquote pre figure figcaption details address",
)
# Words that class, id and role attributes use for parts of a page.
BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertorial alert aside author banner bar bottom breadcrumb breadcrumbs bio button byline card "
    "comment comments commentlist consent contact cookie cookies copyright credit credits cta dialog discussion disqus disclaimer "
    "feedback foot footer form gdpr head header hidden kicker legal links login masthead menu meta modal more nav navbar navigation "
    "newsletter notice notification outbrain overlay pager pagination paywall popular popup prev privacy promo promotion rail rating "
    "recommended related replies reply respond review search share sharing sidebar signin signup site skip skyscraper social sponsor "
    "sponsored subscribe subscription taboola tags teaser thread toc toolbar tooltip top topbar trending warning widget".split()
)
CONTENT = frozenset("article body content copy entry main mainbody page post prose richtext story text".split())
NOTICES = re.compile(r"©|\b(?:copyright|cookies?|subscribe|newsletter|sign up|log in|all rights reserved|reply|advertisement|sponsored)\b", re.I)

_GROUP = {tag: k for k, tags in enumerate(GROUPS) for tag in tags.split()}
FEATURES = (
    *(f"is_{g.split()[0]}" for g in GROUPS), "is_other",
    "boilerplate_words", "content_words", "boilerplate_above", "content_above", "dropped_tag_above", "kept_tag_above",
    "depth", "own_chars", "all_chars", "all_words", "link_share", "links", "chars_per_node", "stops_per_word", "words_per_block", "blocks",
    "controls", "notices", "starts_at", "share_of_page", "share_of_parent", "siblings", "same_siblings", "rank", "before_chars", "after_chars",
    "before_links", "after_links", "longest_block",
)


class Page:
    """Elements in page order with parent positions; 0 is the page itself."""

    def __init__(self, html: str):
        self.tag, self.parent, self.words, self.keep = ["#page"], [-1], [()], [None]
        self.links, self.controls = [0], [0]
        #: Text runs in page order: element, text, characters of it within links.
        self.blocks: list[tuple[int, str, int]] = []
        self._pieces: list[str] = []
        self._linked = 0
        self._parse(html)

    def _flush(self, at: int) -> None:
        if self._pieces:
            text = " ".join("".join(self._pieces).split())
            if text:
                self.blocks.append((at, text, min(self._linked, len(text))))
            self._pieces, self._linked = [], 0

    def _parse(self, html: str) -> None:
        # the open elements as (tag, element or -1 for inline ones)
        stack: list[tuple[str, int]] = [("#page", 0)]
        at, position, in_link = 0, 0, 0
        never_ends: set[str] = set()
        while True:
            match = _TOKEN.search(html, position)
            end = match.start() if match else len(html)
            if end > position:
                text = html[position:end]
                if "&" in text:
                    text = unescape(text)
                self._pieces.append(text)
                if in_link:
                    self._linked += len(text)
            if not match:
                break
            position = match.end()
            if not match[2]:
                continue
            tag = match[2].lower()
            if match[1]:
                if tag in INLINE:
                    if tag in ("td", "th"):
                        self._pieces.append(" ")
                    for k in range(len(stack) - 1, 0, -1):
                        if stack[k][0] == tag:
                            del stack[k]
                            in_link -= tag == "a"
                            break
                        if stack[k][1] >= 0:
                            break
                elif any(name == tag for name, _ in stack):
                    self._flush(at)
                    while stack.pop()[0] != tag:
                        pass
                    at, in_link = self._top(stack)
                continue
            if tag in RAW or tag in HIDDEN:
                if tag in CONTROLS:
                    self.controls[at] += 1
                if tag not in never_ends and not match[3].rstrip().endswith("/"):
                    close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, position)
                    if close:
                        position = close.end()
                    elif tag in RAW:
                        position = len(html)
                    else:
                        never_ends.add(tag)
                continue
            if tag in ("br", "wbr", "img", "td", "th"):
                if tag != "wbr":
                    self._pieces.append(" ")
            if tag in VOID:
                if tag in CONTROLS:
                    self.controls[at] += 1
                if tag == "hr":
                    self._flush(at)
                continue
            if tag in INLINE:
                stack.append((tag, -1))
                if tag == "a":
                    in_link += 1
                    self.links[at] += 1
                continue
            self._flush(at)
            self._imply_ends(tag, stack)
            at, in_link = self._top(stack)
            if tag in CONTROLS:
                self.controls[at] += 1
            words, keep = self._attributes(match[3]) if match[3] else ((), None)
            self.tag.append(tag)
            self.parent.append(at)
            self.words.append(words)
            self.keep.append(keep)
            self.links.append(0)
            self.controls.append(0)
            at = len(self.tag) - 1
            stack.append((tag, at))
        self._flush(at)

    @staticmethod
    def _top(stack: list[tuple[str, int]]) -> tuple[int, int]:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][1] >= 0:
                return stack[k][1], sum(name == "a" for name, _ in stack[k + 1 :])
        return 0, 0

    @staticmethod
    def _imply_ends(tag: str, stack: list[tuple[str, int]]) -> None:
        ends = CLOSES_SAME.get(tag, set()) | ({"p"} if tag in CLOSES_P else set())
        for k in range(len(stack) - 1, 0, -1):
            name = stack[k][0]
            if name in ends:
                del stack[k:]
                break
            if name in SCOPE or name in CLOSES_P:
                break

    @staticmethod
    def _attributes(text: str) -> tuple[tuple[str, ...], bool | None]:
        words: list[str] = []
        keep = None
        for name, *values in _ATTRIBUTE.findall(text):
            name, value = name.lower(), "".join(values)
            if name in ("class", "id", "role", "itemprop", "aria-label", "data-role"):
                words += [w.lower() for w in _PART.findall(value)]
            elif name == "hidden" or name == "style" and "display:none" in value.replace(" ", ""):
                words.append("hidden")
            elif name == "data-keep":
                keep = value == "1"
        return tuple(words), keep


def features(page: Page) -> np.ndarray:
    """A row of FEATURES for each element but the page itself."""
    n = len(page.tag)
    parent = page.parent
    own = [0] * n
    stops, notices, blocks, linked, words, longest, first = ([0] * n for _ in range(7))
    nodes = [1] * n
    at = 0
    for k, text, in_links in page.blocks:
        own[k] += len(text)
        linked[k] += in_links
        blocks[k] += 1
        spaces = text.count(" ") + 1
        words[k] += spaces
        longest[k] = max(longest[k], spaces)
        stops[k] += text.count(".") + text.count(",")
        notices[k] += bool(NOTICES.search(text))
        at += len(text)
    # where an element begins: the characters before it
    seen, b = 0, 0
    for k in range(n):
        while b < len(page.blocks) and page.blocks[b][0] < k:
            seen += len(page.blocks[b][1])
            b += 1
        first[k] = seen
    total = max(1, at)
    chars, links, controls = own[:], page.links[:], page.controls[:]
    for k in range(n - 1, 0, -1):
        p = parent[k]
        chars[p] += chars[k]
        linked[p] += linked[k]
        blocks[p] += blocks[k]
        words[p] += words[k]
        stops[p] += stops[k]
        notices[p] += notices[k]
        links[p] += links[k]
        controls[p] += controls[k]
        nodes[p] += nodes[k]
        longest[p] = max(longest[p], longest[k])
    children: list[list[int]] = [[] for _ in range(n)]
    for k in range(1, n):
        children[parent[k]].append(k)
    group = [_GROUP.get(t, len(GROUPS)) for t in page.tag]
    # of each element: its place among its siblings, those beside it (0 for none), those of its group
    rank, previous, following, alike = ([0] * n for _ in range(4))
    for family in children:
        groups = Counter(group[c] for c in family)
        for place, k in enumerate(family):
            rank[k], alike[k] = place, groups[group[k]]
            if place:
                previous[k], following[family[place - 1]] = family[place - 1], k
    bad = [sum(w in BOILERPLATE for w in ws) for ws in page.words]
    good = [sum(w in CONTENT for w in ws) for ws in page.words]
    depth, bad_above, good_above, tag_bad, tag_good = ([0] * n for _ in range(5))
    out = np.zeros((n - 1, len(FEATURES)), np.float32)
    kinds = len(GROUPS) + 1
    for k in range(1, n):
        p = parent[k]
        depth[k] = depth[p] + 1
        bad_above[k], good_above[k] = bad_above[p] + bad[p], good_above[p] + good[p]
        tag_bad[k] = tag_bad[p] or 1 <= group[p] <= 5
        tag_good[k] = tag_good[p] or group[p] == 0
        before, after = previous[k], following[k]
        row = out[k - 1]
        row[group[k]] = 1
        row[kinds:] = (
            bad[k], good[k], bad_above[k], good_above[k], tag_bad[k], tag_good[k],
            depth[k], own[k], chars[k], words[k], linked[k] / max(1, chars[k]), links[k], chars[k] / nodes[k], stops[k] / max(1, words[k]),
            words[k] / max(1, blocks[k]), blocks[k], controls[k], notices[k], first[k] / total, chars[k] / total, chars[k] / max(1, chars[p]),
            len(children[p]), alike[k], rank[k], chars[before] if before else 0, chars[after] if after else 0,
            linked[before] / max(1, chars[before]) if before else 0, linked[after] / max(1, chars[after]) if after else 0, longest[k],
        )
    return out


def subtree_labels(page: Page) -> list[bool | None]:
    """``keep`` of each element but the page itself: its own mark, or its parent's."""
    for k in range(1, len(page.tag)):
        if page.keep[k] is None:
            page.keep[k] = page.keep[page.parent[k]]
    return page.keep[1:]


def decode(page: Page, probability: np.ndarray) -> Iterator[str]:
    """The kept blocks in page order, under the likeliest choice in which nothing inside a dropped
    element is kept. ``probability``: of being kept, for each element but the page itself."""
    n = len(page.tag)
    p = np.clip(probability, 1e-6, 1 - 1e-6)
    keep, drop = [0.0, *np.log(p).tolist()], [0.0, *np.log1p(-p).tolist()]
    for k in range(n - 1, 0, -1):  # children come after their parent, so their sums are complete
        keep[page.parent[k]] += max(keep[k], drop[k])
        drop[page.parent[k]] += drop[k]
    kept = [True] * n
    for k in range(1, n):
        kept[k] = kept[page.parent[k]] and keep[k] > drop[k]
    return (text for k, text, _ in page.blocks if kept[k])
