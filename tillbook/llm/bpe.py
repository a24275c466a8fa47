"""BPE encoding and decoding by prefix-sharing trie traversal.

New distinct words go into a trie, kept as a map from each prefix to its state, and are walked in
sorted order, which visits the trie depth first. The state of a prefix is the last token of its
encoding. That one token determines the encoding, because what is before it is again a prefix on the
path, with its own last token. A token can follow another exactly if merging the symbols of both gives
the two back. So the state of a longer prefix is found by trying the tokens that end there, each
against the state where it would begin, and a shared prefix is computed once. A word's end is part of
its last symbol, so each word needs one closing step.

The vocabulary is a ``tokenizers`` file with a BPE model that marks word ends, byte-level symbols and
lower-cased NFC text; the file's path is a parameter and every executor must find it there. This module
encodes text by text; ``batch_bpe`` walks the new words of many texts through the same trie at once.
"""

import json
import re
import unicodedata
from array import array
from collections.abc import Iterable
from functools import lru_cache

import regex

#: Distinct words, prefixes and words with their punctuation that a worker process keeps; beyond, it
#: starts anew.
KEPT_WORDS = 200_000
KEPT_PREFIXES = 500_000
KEPT_CHUNKS = 200_000

_ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
_SPACE = "\\t-\\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_ASCII_WORD = re.compile(rf"{_ENDINGS}|[a-z]+|[0-9]|[^{_SPACE}a-z0-9]+|\n")


def _latin_word() -> re.Pattern:
    """The word pattern for texts below U+0250, where letters and numbers can be listed."""
    kinds = {k: "".join(c for c in map(chr, range(128, 0x250)) if unicodedata.category(c)[0] == k) for k in "LN"}
    letters, numbers = "a-z" + kinds["L"], "0-9" + kinds["N"]
    return re.compile(rf"{_ENDINGS}|[{letters}]+|[{numbers}]|[^{_SPACE}{letters}{numbers}]+|\n")


_LATIN_WORD, _BEYOND_LATIN = _latin_word(), re.compile("[^\x00-\u024f]")
#: White space to ``str.split`` and not to the vocabulary.
_ODD_SPACE, _CHUNK = "\x1c\x1d\x1e\x1f", re.compile(f"[^{_SPACE}]+")


#: Code points that the ``regex`` module counts as letters or numbers and the
#: vocabulary's own library, with an older character table, does not. Letters that are newer still may differ.
_NEWER = (
    "0558 058B-058C 088F 0C5C 0CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D "
    "107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F "
    "12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 "
    "18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF "
    "1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E "
    "2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
)


@lru_cache(maxsize=1)
def _any_word() -> regex.Pattern:
    """The word pattern for all texts."""
    newer = "".join("-".join(f"\\U{code:0>8}" for code in r.split("-")) for r in _NEWER.split())
    return regex.compile(
        rf"(?V1){_ENDINGS}|[\p{{L}}--[{newer}]]+|[\p{{N}}--[{newer}]]|(?:[^{_SPACE}\p{{L}}\p{{N}}]|[{newer}])+|\n"
    )


def _byte_symbols() -> dict[int, str]:
    """The usual printable stand-in for each byte: itself if printable, else the next free one."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


def words_of(text: str) -> list[str]:
    """The words of a text without special tokens, folded; line feeds stay between them."""
    if text.isascii():
        return _ASCII_WORD.findall(text.lower())
    # lower-casing goes letter by letter: a sigma doesn't depend on its place
    text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
    return (_any_word() if _BEYOND_LATIN.search(text) else _LATIN_WORD).findall(text)


class Encoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end: str = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.rank = {tuple(pair): i for i, pair in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (self.ids | self.special).items()}
        self._split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.byte_symbols = _byte_symbols()
        self._symbols = str.maketrans({chr(b): s for b, s in self.byte_symbols.items()})
        # tokens inside a word and at its end, each with the lengths of those that share an ending
        self._inner = {t: t for t in self.ids if t == self.end or not t.endswith(self.end)}
        self._final = {t[: -len(self.end)]: t for t in self.ids.keys() - self._inner.keys()}
        self._inner_lengths, self._final_lengths = (_lengths(tokens) for tokens in (self._inner, self._final))
        self._halves = {left + right: (left, right) for left, right in reversed(self.rank)}
        self._spines: dict[tuple[str, int], list[tuple[str, int]]] = {}
        self._follows: dict[tuple[str, str], bool] = {}
        # the trie: a node's child by symbol, and the last token of the encoding of each node's prefix
        self._child: dict[tuple[int, str], int] = {}
        self._states = [""]
        self._words: dict[str, bytes] = {}
        self._chunks: dict[str, bytes] = {}

    # -- which tokens may be neighbours -------------------------------------------------------

    def _spine(self, token: str, side: int) -> list[tuple[str, int]]:
        """The tokens along a token's left (0) or right (1) edge while it is merged, each with the
        rank of the merge that ends it."""
        key = token, side
        if key not in self._spines:
            spine, ends = [], len(self.rank)
            while token:
                spine.append((token, ends))
                ends = self.rank.get(self._halves.get(token), -1)
                token = self._halves[token][side] if ends >= 0 else ""
            self._spines[key] = spine
        return self._spines[key]

    def _may_follow(self, before: str, token: str) -> bool:
        """Whether merging the symbols of both never merges across their border.

        A pair of edge tokens would be merged if its rank comes before the merges that end either of
        them; of equal pairs the left one goes first, so a tie is lost to ``before`` and won from
        ``token``.
        """
        if len(self._follows) > KEPT_PREFIXES:
            self._follows.clear()
        rank = self.rank
        known = self._follows[before, token] = not before or not any(
            (r := rank.get((u, v))) is not None and r < u_ends and r <= v_ends
            for u, u_ends in self._spine(before, 1)
            for v, v_ends in self._spine(token, 0)
        )
        return known

    # -- trie ----------------------------------------------------------------------------------

    def _last(self, word: str, depth: int, closed: bool, path: list[int]) -> str:
        """The last token of the encoding of ``word[:depth]``, given the nodes of shorter prefixes."""
        tokens, lengths = (self._final, self._final_lengths) if closed else (self._inner, self._inner_lengths)
        states, follows = self._states, self._follows
        for length in lengths.get(word[max(depth - 2, 0) : depth], (1,)):
            if length <= depth and (token := tokens.get(word[depth - length : depth])):
                before = states[path[depth - length]]
                if (known := follows.get((before, token))) or known is None and self._may_follow(before, token):
                    return token
        raise ValueError(f"no token of the vocabulary ends {word[:depth]!r}")

    def insert(self, words: Iterable[str]) -> dict[str, bytes]:
        """Walk words through the trie, in order, so that each goes on from the prefix it shares with the one before;
        their ids as unsigned 32-bit integers."""
        states, child, ids, out = self._states, self._child, self.ids, {}
        if len(states) > KEPT_PREFIXES:
            states[1:] = []
            child.clear()
        path, before = [0], ""
        for word in sorted(words):
            symbols = word if word.isascii() and word.isalnum() else word.encode().decode("latin-1").translate(self._symbols)
            most = min(len(path), len(symbols)) - 1
            shared = next((d for d in range(most) if symbols[d] != before[d]), most)
            del path[shared + 1 :]
            for d in range(shared + 1, len(symbols)):
                edge = path[-1], symbols[d - 1]
                node = child.get(edge)
                if node is None:
                    state = self._last(symbols, d, False, path)
                    node = child[edge] = len(states)
                    states.append(state)
                path.append(node)
            before = symbols
            token = self._last(symbols, len(symbols), True, path)
            found = [ids[token]]
            at = len(symbols) - len(token) + len(self.end)
            while at:
                token = states[path[at]]
                found.append(ids[token])
                at -= len(token)
            found.reverse()
            out[word] = array("I", found).tobytes()
        return out

    # -- text ----------------------------------------------------------------------------------

    def _split(self, text: str | None) -> list[str]:
        """Chunks between white space; special tokens are chunks of their own."""
        if not text:
            return []
        if self._split_special and "<|" in text:
            parts = self._split_special.split(text)
            if len(parts) > 1:
                return [w for p in parts for w in ([p] if p in self.special else self._split(p))]
        return _CHUNK.findall(text) if any(c in text for c in _ODD_SPACE) else text.split()

    def _split_all(self, texts: list[str | None]) -> list[list[str]]:
        """Chunks of each text; all of them are known then."""
        split = [self._split(t) for t in texts]
        known, words = self._chunks, self._words
        new = {c for chunks in split for c in chunks if c not in known}
        if len(known) + len(new) > KEPT_CHUNKS or len(words) + len(new) > KEPT_WORDS:
            known.clear()
            words.clear()
            new = set().union(*split)
        for special in new & self.special.keys():
            new.remove(special)
            known[special] = array("I", [self.special[special]]).tobytes()
        spelled = {c: words_of(c) for c in new}
        words |= self.insert({w for found in spelled.values() for w in found if w not in words})
        for chunk, found in spelled.items():
            known[chunk] = words[found[0]] if len(found) == 1 else b"".join([words[w] for w in found])
        return split

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """For each text its ids as unsigned 32-bit integers, little-endian on the usual machines."""
        split, find = self._split_all(texts), self._chunks.__getitem__
        return [b"".join(map(find, chunks)) for chunks in split]

    def decode(self, ids: bytes) -> str:
        """Token texts with a space between, special ones included; ids that are none are left out."""
        return " ".join([self.tokens[i] for i in array("I", ids) if i in self.tokens])


def _lengths(tokens: Iterable[str]) -> dict[str, list[int]]:
    """For each last two symbols, and each single one, the lengths of the tokens that may end there."""
    found: dict[str, set[int]] = {}
    for token in tokens:
        found.setdefault(token[-2:], {1}).add(len(token))
    return {end: sorted(lengths, reverse=True) for end, lengths in found.items()}
