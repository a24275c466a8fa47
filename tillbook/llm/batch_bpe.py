"""BPE ids of many texts at once.

Text between white space is looked up whole: the chunks of a batch are grouped by a 64-bit hash, compared
byte by byte within a group, and each group's bytes are the key of what is known. What isn't known yet is split
into words, and the new words of a batch are encoded together: by the trie of ``bpe.Encoder`` (TrieEncoder), or, for
uses that need ids only, by merging with numpy, in each step the first of the best pairs of every word
(BatchEncoder). Texts that hold a special token go through ``bpe.Encoder`` whole.
"""

import hashlib
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.llm.bpe import Encoder, words_of
from tillbook.llm.common import pieces
from tillbook.llm.shingles import LONG, lowered_words

#: Distinct chunks and words that a worker process keeps; beyond, it starts anew.
KEPT_CHUNKS = 500_000
KEPT_WORDS = 500_000
#: Bytes of the chunks that a worker process keeps; beyond, too, it starts anew.
KEPT_BYTES = 32 << 20
#: Bytes that are compared at once.
COMPARED = 1 << 19
#: What stays of eight bytes, by the length of a word.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_NONE = np.iinfo(np.int64).max


class Slices:
    """Runs of ids in one growing buffer."""

    def __init__(self):
        self.ids, self.used = np.empty(1 << 16, np.uint32), 0
        self.starts, self.sizes, self.count = np.empty(1 << 12, np.int64), np.empty(1 << 12, np.int64), 0

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.ids = _grown(self.ids, self.used, len(ids))
        self.ids[self.used : self.used + len(ids)] = ids
        self.starts, self.sizes = _grown(self.starts, self.count, len(sizes)), _grown(self.sizes, self.count, len(sizes))
        self.starts[self.count : self.count + len(sizes)] = self.used + np.cumsum(sizes) - sizes
        self.sizes[self.count : self.count + len(sizes)] = sizes
        self.used, self.count = self.used + len(ids), self.count + len(sizes)

    def of(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The runs one after the other, and their sizes."""
        sizes = self.sizes[which]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(self.starts[which] - (ends - sizes), sizes) + np.arange(total)], sizes


def _grown(array: np.ndarray, used: int, more: int) -> np.ndarray:
    if used + more <= len(array):
        return array
    out = np.empty(max(2 * len(array), used + more), array.dtype)
    out[:used] = array[:used]
    return out


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all bytes of the spans, one span after the other."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def unlike(buffer: bytes, starts: np.ndarray, ends: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The words whose bytes aren't those of word ``other[k]``. Up to sixteen bytes, the first and the last eight say so."""
    sizes = ends - starts
    eights = np.ndarray((len(buffer),), "<u8", buffer + bytes(8), strides=(1,))
    first = eights[starts] & _FIRST[np.minimum(sizes, 8)]
    last = np.where(sizes > 8, eights[np.maximum(ends - 8, 0)], np.uint64(0))
    out = (sizes != sizes[other]) | (first != first[other]) | (last != last[other])
    data = np.frombuffer(buffer, np.uint8)
    check = np.flatnonzero((sizes > 16) & (other != np.arange(len(other))) & ~out)
    for k in check[sizes[check] > LONG].tolist():
        out[k] = buffer[starts[k] : ends[k]] != buffer[starts[other[k]] : ends[other[k]]]
    check = check[sizes[check] <= LONG]
    cuts = np.searchsorted(np.cumsum(sizes[check]), np.arange(COMPARED, sizes[check].sum() + COMPARED, COMPARED))
    for part in np.split(check, np.unique(cuts)):
        if len(part):
            differ = data[_spans(starts[part], sizes[part])] != data[_spans(starts[other[part]], sizes[part])]
            if differ.any():
                out[part] = np.logical_or.reduceat(differ, np.cumsum(sizes[part]) - sizes[part])
    return np.flatnonzero(out)


class BatchEncoder:
    def __init__(self, path: str):
        self.path = path
        base = self._kept(path)
        ids, end, symbols = base.ids, base.end, base.byte_symbols
        self._inner = np.array([ids[symbols[b]] for b in range(256)], np.int64)
        self._final = np.array([ids[symbols[b] + end] for b in range(256)], np.int64)
        pairs = np.array([(ids[a] << 32 | ids[b], rank) for (a, b), rank in base.rank.items()], np.int64)
        pairs = pairs[np.argsort(pairs[:, 0])]
        self._pairs, self._ranks = np.ascontiguousarray(pairs[:, 0]), np.ascontiguousarray(pairs[:, 1])
        self._merged = np.array([ids[a + b] for a, b in base.rank], np.int64)
        self._start()

    def _kept(self, path: str) -> Encoder:
        """The whole vocabulary, which isn't kept: merging needs the arrays only."""
        return Encoder(path)

    @cached_property
    def base(self) -> Encoder:
        """For texts with special tokens."""
        return Encoder(self.path)

    def _start(self) -> None:
        self._chunk_at: dict[bytes, int] = {}
        self._chunk_bytes = 0
        self._chunk_ids, self._word_ids = Slices(), Slices()
        # the break between chunks is a word without ids
        self._word_at: dict[str, int] = {"\n": 0}
        self._word_ids.add(np.empty(0, np.uint32), np.zeros(1, np.int64))

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self._pairs, key), len(self._pairs) - 1)
        return np.where(self._pairs[at] == key, self._ranks[at], _NONE)

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, one after the other, and the number of each word's ids."""
        data = [w.encode() for w in words]
        sizes = np.array([len(d) for d in data], np.int64)
        raw = np.frombuffer(b"".join(data), np.uint8)
        symbols, last = self._inner[raw], np.cumsum(sizes) - 1
        symbols[last] = self._final[raw[last]]
        word = np.repeat(np.arange(len(words)), sizes)
        ranks = np.full(len(symbols), _NONE)  # of each symbol with the next one
        inside = np.flatnonzero(word[:-1] == word[1:])
        ranks[inside] = self._rank(symbols[inside], symbols[inside + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            spans = np.diff(np.r_[starts, len(word)])
            best = np.minimum.reduceat(ranks, starts)
            if 2 * (best < _NONE).sum() < len(starts):
                over = np.repeat(best == _NONE, spans)
                done.append((word[over], symbols[over]))
                symbols, ranks, word = symbols[~over], ranks[~over], word[~over]
                continue
            found = np.flatnonzero((ranks == np.repeat(best, spans)) & (ranks < _NONE))
            owner = word[found]
            at = found[np.r_[True, owner[1:] != owner[:-1]]]
            symbols[at] = self._merged[ranks[at]]
            stays = np.ones(len(symbols), bool)
            stays[at + 1] = False
            symbols, ranks, word = symbols[stays], ranks[stays], word[stays]
            at = at - np.arange(len(at))
            for left in (at, at[at > 0] - 1):
                right = np.minimum(left + 1, len(word) - 1)
                pair = (right > left) & (word[left] == word[right])
                ranks[left] = np.where(pair, self._rank(symbols[left], symbols[right]), _NONE)
        owners = np.concatenate([w for w, _ in done]) if done else np.empty(0, np.int64)
        ids = np.concatenate([s for _, s in done]) if done else np.empty(0, np.int64)
        order = np.argsort(owners, kind="stable")
        return ids[order].astype(np.uint32), np.bincount(owners, minlength=len(words))

    def _learn(self, chunks: list[bytes]) -> None:
        """Look up the ids of new chunks, after those of their new words."""
        words, known = words_of(b"\n".join(chunks).decode()), self._word_at
        new = [*dict.fromkeys([w for w in words if w not in known])]
        if new:
            known |= zip(new, range(self._word_ids.count, self._word_ids.count + len(new)))
            self._word_ids.add(*self.merge(new))
        which = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        ids, sizes = self._word_ids.of(which)
        ends = np.r_[np.cumsum(sizes)[which == 0], len(ids)]
        self._chunk_bytes += sum(map(len, chunks))
        self._chunk_at |= zip(chunks, range(self._chunk_ids.count, self._chunk_ids.count + len(chunks)))
        self._chunk_ids.add(ids, np.diff(np.r_[0, ends]))

    def _looked_up(self, texts: list[bytes]):
        """For each group of texts the place of each chunk and the number of chunks before each text."""
        for buffer, starts, ends, hashes, borders in lowered_words(texts):
            _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
            wrong = unlike(buffer, starts, ends, first[which])
            if len(wrong):  # other words with the same hash: each is looked up by itself
                which[wrong] = len(first) + np.arange(len(wrong))
                first = np.r_[first, wrong]
            if len(self._chunk_at) + len(first) > KEPT_CHUNKS or len(self._word_at) > KEPT_WORDS or self._chunk_bytes > KEPT_BYTES:
                self._start()
            chunks = [buffer[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
            known = self._chunk_at
            new = [*dict.fromkeys([c for c in chunks if c not in known])]
            if new:
                self._learn(new)
            at = np.array([known[c] for c in chunks], np.int64)
            yield at[which], borders

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """For each text its ids as unsigned 32-bit integers."""
        out: list[bytes] = []
        for at, borders in self._looked_up([b"" if t is None or b"<|" in t else t for t in texts]):
            ids, sizes = self._chunk_ids.of(at)
            cuts = np.r_[0, np.cumsum(sizes)][borders].tolist()
            out += [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
        for i, text in enumerate(texts):
            if text is not None and b"<|" in text:
                out[i] = self.base.encode([text.decode()])[0]
        return out


class TrieEncoder(BatchEncoder):
    """Encodes new words by the trie, and keeps the decoding of every chunk."""

    def _kept(self, path: str) -> Encoder:
        return self.base

    def _start(self) -> None:
        super()._start()
        self._chunk_texts: list[bytes] = []

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.base.insert(words)
        ids = [found[w] for w in words]
        return np.frombuffer(b"".join(ids), np.uint32), np.array([len(i) // 4 for i in ids], np.int64)

    def _learn(self, chunks: list[bytes]) -> None:
        known = self._chunk_ids.count
        super()._learn(chunks)
        ids, sizes = self._chunk_ids.of(np.arange(known, self._chunk_ids.count))
        tokens = list(map(self.base.tokens.__getitem__, ids.tolist()))
        ends = np.cumsum(sizes).tolist()
        self._chunk_texts += [" ".join(tokens[b - n : b]).encode() for b, n in zip(ends, sizes.tolist())]

    def round_trip(self, texts: list[bytes | None]) -> list[tuple[bytes, bytes]]:
        """For each text its ids, and their decoding: token texts with a space between."""
        out: list[tuple[bytes, bytes]] = []
        for at, borders in self._looked_up([b"" if t is None or b"<|" in t else t for t in texts]):
            ids, sizes = self._chunk_ids.of(at)
            cuts = np.r_[0, np.cumsum(sizes)][borders].tolist()
            some = np.r_[0, np.cumsum(sizes > 0)][borders].tolist()
            parts = list(map(self._chunk_texts.__getitem__, at[sizes > 0].tolist()))
            out += [
                (ids[a:b].tobytes(), b" ".join(parts[c:d]))
                for a, b, c, d in zip(cuts, cuts[1:], some, some[1:])
            ]
        for i, text in enumerate(texts):
            if text is not None and b"<|" in text:
                ids = self.base.encode([text.decode()])[0]
                out[i] = ids, self.base.decode(ids).encode()
        return out


@lru_cache(maxsize=2)
def batch_encoder(path: str) -> BatchEncoder:
    """One a worker process, kept between tasks."""
    return BatchEncoder(path)


@lru_cache(maxsize=2)
def trie_encoder(path: str) -> TrieEncoder:
    """One a worker process, kept between tasks."""
    return TrieEncoder(path)


def encode_documents(documents: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: its id, ``ids`` (array of int), ``decoded``.

    Null and empty texts and texts of white space have no ids and decode to the empty text. Rows are
    taken one by one: repeated rows and null ids stay, other columns play no part.
    """
    fields = f"{id_column} {documents.schema[id_column].dataType.simpleString()}, ids array<int>, decoded string"
    schema = T._parse_datatype_string(fields)

    def run(batches):
        kept = trie_encoder(path)
        for piece in pieces(batches):
            out = kept.round_trip(piece.column(1).cast(pa.binary()).to_pylist())
            ids = [np.frombuffer(i, np.uint32).tolist() for i, _ in out]
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([d.decode() for _, d in out], pa.string())],
                names=[f.name for f in schema.fields],
            )

    return documents.select(id_column, text_column).mapInArrow(run, schema)


def token_digests(documents: DataFrame, path: str) -> DataFrame:
    """``encode_documents`` with sums in place of the ids and texts, made before rows leave Python."""
    schema = T._parse_datatype_string("doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

    def run(batches):
        kept = trie_encoder(path)
        for piece in pieces(batches):
            out = kept.round_trip(piece.column(1).cast(pa.binary()).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column(0).cast(pa.int64()),
                    pa.array([len(ids) // 4 for ids, _ in out], pa.int64()),
                    pa.array([hashlib.sha256(ids).hexdigest() for ids, _ in out]),
                    pa.array([hashlib.sha256(text).hexdigest() for _, text in out]),
                ],
                names=[f.name for f in schema.fields],
            )

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
