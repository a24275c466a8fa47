"""Main text of web pages by boosted trees over DOM elements and hierarchical decoding.

No page comes with labels, so the trees learn from pages whose parts are known: a bounded choice of
the given pages, as they are where their own markup (article, nav, footer and the like, or words in
class and id) says what a part is, and rearranged, with the same parts in other markup, other places
and among further parts made of the page's own sentences: side bars, notices, forms, reader comments.
"""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.llm import boosting
from tillbook.llm.common import pieces
from tillbook.llm.dom import BOILERPLATE, CONTENT, FEATURES, Page, decode, features, subtree_labels

#: Pages that are learned from, in the mean: a random choice by hash of page_id and url.
LEARN_PAGES = 400
LEARN_PARTS = 8
#: Rearranged copies of each of them.
COPIES = 3
#: Elements learned from a page, at most: a random choice of longer pages' elements.
PAGE_ELEMENTS = 120

# Tags and class names that pages use for the parts that aren't the article.
PARTS = {
    "menu": ("nav menu div ul header", "nav navbar menu main-menu site-nav navigation breadcrumb breadcrumbs topbar toolbar"),
    "header": ("header div section", "header masthead banner site-header page-header head top-bar branding-header"),
    "footer": ("footer div section", "footer site-footer foot bottom copyright credits legal footer-links"),
    "sidebar": ("aside div section", "sidebar side-bar widget widget-area rail related related-posts recommended popular trending more-links"),
    "notice": ("div section aside dialog", "notice cookie-notice cookie-banner consent gdpr alert alert-box popup modal overlay paywall notification"),
    "advert": ("div aside section", "ad ads advert advertisement ad-slot banner-ad sponsored sponsor promo promotion taboola"),
    "form": ("form div section", "form newsletter newsletter-form signup subscribe login search-form contact-form feedback"),
    "comments": ("div section aside", "comments comment-list comment discussion disqus replies comment-thread responses reply-list"),
    "share": ("div section", "share social sharing share-buttons social-links tags meta byline author-bio pagination pager"),
}
ARTICLE = ("article main div section", "article content post entry story main main-content post-content entry-content article-body prose text")
_DROPPED = frozenset("nav menu header footer aside form dialog button".split())


def mark(page: Page) -> bool:
    """Mark what the page's own markup says; False if it names no article."""
    found = False
    for k in range(1, len(page.tag)):
        words = set(page.words[k])
        if page.tag[k] in ("article", "main") or words & CONTENT and not words & BOILERPLATE:
            page.keep[k] = found = True
        elif page.tag[k] in _DROPPED or words & BOILERPLATE:
            page.keep[k] = False
    if found:
        kept = page.keep[:]
        # what is around an article has to be kept, what is beside it is not
        around = set()
        for k in range(1, len(page.tag)):
            if kept[k]:
                while k > 0 and k not in around:
                    around.add(k)
                    k = page.parent[k]
        page.keep[0] = False
        for k in range(1, len(page.tag)):
            if k in around and page.keep[k] is None:
                page.keep[k] = True if not _inside(page, k, kept) else None
            elif kept[k] is None and page.parent[k] in around and not _inside(page, k, kept):
                page.keep[k] = False
    return found


def _inside(page: Page, k: int, kept: list[bool | None]) -> bool:
    k = page.parent[k]
    while k > 0:
        if kept[k] is not None:
            return True
        k = page.parent[k]
    return False


def _escaped(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;")


def rearranged(page: Page, choose: random.Random) -> str | None:
    """A page with the same blocks in other markup; ``data-keep`` marks its parts. ``page`` is marked."""
    labels = [None, *subtree_labels(page)]
    article = [(page.tag[k], text) for k, text, _ in page.blocks if labels[k]]
    rest = [text for k, text, _ in page.blocks if k and not labels[k]] or ["Home"]
    if not article:
        return None
    sentences = [s for _, text in article for s in text.split(". ")]

    def some(most: int) -> list[str]:
        return [choose.choice(sentences if choose.random() < 0.6 else rest) for _ in range(choose.randint(1, most))]

    def element(tags: str, names: str, keep: bool | None, inner: str, named: float = 0.8) -> str:
        tag = choose.choice(tags.split())
        plain = tag in ("div", "section", "ul", "aside", "header")
        name = ""
        if choose.random() < named or plain and keep is not None:
            name = f' {choose.choice(("class", "class", "id"))}="{choose.choice(names.split())}"'
        mark = "" if keep is None else f' data-keep="{int(keep)}"'
        return f"<{tag}{name}{mark}>{inner}</{tag}>"

    def links(texts: list[str]) -> str:
        items = "".join(f'<li><a href="/x">{_escaped(t[:40])}</a></li>' for t in texts)
        return f"<ul>{items}</ul>" if choose.random() < 0.7 else " ".join(f'<a href="/x">{_escaped(t[:30])}</a>' for t in texts)

    def paragraphs(texts: list[str]) -> str:
        tag = choose.choice(("p", "p", "div"))
        return "".join(f"<{tag}>{_escaped(t)}</{tag}>" for t in texts)

    def part(kind: str) -> str:
        if kind in ("menu", "share"):
            inner = links(some(8))
        elif kind == "comments":
            inner = "".join(f"<div>{paragraphs(some(3))}</div>" if choose.random() < 0.7 else paragraphs(some(3)) for _ in range(choose.randint(1, 6)))
            inner = choose.choice(("", "<h3>Comments</h3>", "<h2>Discussion</h2>")) + inner
        elif kind == "form":
            inner = f"<label>{_escaped(choose.choice(rest)[:60])}</label><input name=q><button>OK</button>" + (paragraphs(some(1)) if choose.random() < 0.5 else "")
        elif kind == "sidebar":
            inner = choose.choice(("", "<h3>Related</h3>")) + (links(some(6)) if choose.random() < 0.6 else paragraphs(some(3)))
        elif kind == "footer":
            inner = f"&copy; {_escaped(choose.choice(rest)[:80])}" + (links(some(4)) if choose.random() < 0.3 else "")
        else:
            inner = paragraphs(some(2)) if choose.random() < 0.5 else _escaped(choose.choice(rest))
        return element(*PARTS[kind], False, inner)

    body = []
    for tag, text in article:
        use = tag if tag in ("h1", "h2", "h3", "li", "blockquote", "pre") else choose.choice(("p", "p", "p", "div", "blockquote", "h2") if len(text) < 80 else ("p", "p", "p", "div"))
        inner = f"<{use}>{_escaped(text)}</{use}>"
        if choose.random() < 0.05:
            inner = f"<ul>{''.join(f'<li>{_escaped(s)}</li>' for s in text.split(', '))}</ul>"
        body.append(inner)
        if choose.random() < 0.04:
            body.append(part(choose.choice(("advert", "notice", "share", "sidebar", "form"))))
    if choose.random() < 0.3:
        body.append(part(choose.choice(("share", "comments", "form"))))
    main = element(*ARTICLE, True, "".join(body), 0.6)
    if choose.random() < 0.3:
        main = f'<div data-keep="1">{main}{part("comments") if choose.random() < 0.5 else ""}</div>'
    before = [part(k) for k in ("notice", "header", "menu", "advert", "sidebar") if choose.random() < 0.5]
    after = [part(k) for k in ("share", "comments", "sidebar", "advert", "form", "footer", "notice") if choose.random() < 0.45]
    choose.shuffle(before)
    return f"<html><body>{''.join(before)}{main}{''.join(after)}</body></html>"


def training_rows(html: str | None, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of a page's elements and those of its rearranged copies."""
    choose = random.Random(seed)
    page = Page(html or "")
    rows, labels = [np.empty((0, len(FEATURES)), np.float32)], [np.empty(0)]
    if mark(page):
        copies = [page]
        for _ in range(COPIES):
            changed = rearranged(page, choose)
            if changed:
                copies.append(Page(changed))
        for copy in copies:
            marked = subtree_labels(copy)
            if copy is not page:  # around the parts nothing is marked: the page's body has to be kept
                marked = [True if m is None else m for m in marked]
            known = [k for k, m in enumerate(marked) if m is not None]
            known = choose.sample(known, min(len(known), PAGE_ELEMENTS))
            rows.append(features(copy)[known])
            labels.append(np.array([float(marked[k]) for k in known]))
    return np.concatenate(rows), np.concatenate(labels)


def learn(pages: DataFrame, most: int = LEARN_PAGES) -> boosting.Trees:
    share = most / max(1, pages.count())
    draw = F.pmod(F.xxhash64("page_id", "url"), F.lit(1_000_000)) / 1_000_000
    schema = "features binary, labels binary"

    def run(batches):
        for piece in pieces(batches):
            found = [training_rows(html, seed) for seed, html in zip(*(c.to_pylist() for c in piece.columns))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r.tobytes() for r, _ in found], pa.binary()), pa.array([l.tobytes() for _, l in found], pa.binary())], names=["features", "labels"]
            )

    chosen = pages.where(draw < share).select(F.xxhash64("page_id", "url"), "html").repartition(LEARN_PARTS)
    found = chosen.mapInArrow(run, schema).collect()
    rows = np.frombuffer(b"".join(r.features for r in found), np.float32).reshape(-1, len(FEATURES))
    labels = np.frombuffer(b"".join(r.labels for r in found))
    return boosting.fit(rows, labels, np.ones(len(rows)))


def main_text(html: str | None, trees: boosting.Trees) -> str:
    return main_texts([html], trees)[0]


def main_texts(htmls: list[str | None], trees: boosting.Trees) -> list[str]:
    parsed = [Page(h or "") for h in htmls]
    rows = [features(p) for p in parsed]
    probability = trees.probability(np.concatenate(rows)) if rows else np.empty(0)
    ends = np.cumsum([len(r) for r in rows])
    return ["\n\n".join(decode(p, probability[e - len(r) : e])) for p, r, e in zip(parsed, rows, ends)]


def extract(pages: DataFrame, trees: boosting.Trees) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    ``text`` has the kept blocks in page order, joined by two line breaks, with character references
    decoded and white space within a block as one space. Null and empty pages and pages without kept
    text have the empty text. Trees that saw no marked page keep every element. Pages are read one by
    one: repeated rows and null ids stay, an empty table gives an empty one, other columns play no part.
    """
    keys = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html")
    schema = T._parse_datatype_string("page_id long, url string, text string, n_chars long")

    def run(batches):
        for piece in pieces(batches):
            texts = main_texts(piece.column(2).to_pylist(), trees)
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), piece.column(1).cast(pa.string()), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return keys.mapInArrow(run, schema)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """Learns from the pages' own markup and extracts all of them."""
    return extract(pages, learn(pages))
