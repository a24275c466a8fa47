"""Exact top-k by inner product over an impact-ordered index, score at a time.

Vectors are quantised to whole numbers. A shard's index has, for each component, its rows in the order of
their values: the rows of one value are a posting segment, a run of that list. For a query, a segment's impact
is what it adds to a score above the least that the component can add, so either end of a list has the
segments of the largest impact. Segments are processed by descending impact, in levels: each level takes the
next run off every list, and only the rows in it gain. What a row may still gain is bounded by the level's
impact for each component it hasn't been seen in. Once the k best rows seen so far, scored exactly, rule out
all but a few rows, these possible members are scored exactly; without that proof, all segments are processed.
Gains, bounds and scores are 64-bit whole numbers; where these can't hold them, Python's are taken.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.llm.common import pieces, written
from tillbook.llm.vectors import against_all, blocks, ranked, same_width, unpacked, usable

#: Rows of a shard, and of a block of queries.
SHARD_ROWS = 16384
BLOCK_ROWS = 256
#: Levels of impact, in hundredths of the largest; below the last one nothing is left unprocessed.
LEVELS = (12, 8, 4)
#: Processing stops when at most this share of a shard is still possible: scoring a row exactly takes less time
#: than processing the rest of its postings.
POSSIBLE = 0.5
#: A run of more than this share of the rows is read off the component's values in the order of rows, which takes less time
#: than going from row to row.
LONG_RUN = 0.2
#: Tasks that the blocks of queries of one shard are dealt to.
COPIES = 4
#: Whole numbers up to here add up exactly in doubles, and up to there in 64 bits.
_DOUBLE, _LONG = 2.0**52, 2.0**62


class Shard:
    """Posting lists of one shard: ``rows[d]`` are the rows by their values of component d, ``values[d]`` those values."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.largest = ids, np.abs(vectors).max(initial=0)
        self.doubles = vectors
        self.vectors = vectors.astype(np.int64) if self.largest < _LONG else None
        if self.vectors is not None:
            # numbers of 16 bits are sorted by their digits
            by_component = np.ascontiguousarray(self.vectors.T)
            self.rows = np.argsort(by_component.astype(np.int16) if self.largest < 2**15 else by_component, axis=1, kind="stable")
            self.values = np.take_along_axis(by_component, self.rows, axis=1)
            # what each posting's value is above its component's least, as doubles while they hold it
            self.above = (self.values - self.values[:, :1]).astype(float) if self.largest < _DOUBLE and len(ids) else None
            self._by_row: dict[type, np.ndarray] = {}

    def _scores(self, rows: np.ndarray, query: np.ndarray, most: float) -> np.ndarray:
        if most < _DOUBLE:
            return (self.doubles[rows] @ query.astype(float)).astype(np.int64)
        return self.vectors[rows] @ query

    def _in_rows(self, kind: type) -> np.ndarray:
        """What each row's value is above its component's least, a line for each component."""
        if kind not in self._by_row:
            self._by_row[kind] = np.ascontiguousarray((self.vectors - self.values[:, 0]).T.astype(kind))
        return self._by_row[kind]

    def _beyond_longs(self, query: np.ndarray) -> np.ndarray:
        """Scores of all rows; what no 64 bits hold is cut to the largest or the least that they do."""
        whole = [int(x) for x in query]
        scores = [sum(q * int(x) for q, x in zip(whole, row)) for row in self.doubles]
        return np.array([min(max(s, -(2**63)), 2**63 - 1) for s in scores], np.int64)

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids and scores of the ``k`` best rows whose id isn't ``own``, ties to smaller ids; and how many rows were
        scored apart from their postings."""
        n, others = len(self.ids), self.ids != own
        most = 2 * float(np.abs(query).sum()) * float(self.largest)
        if most >= _LONG or self.vectors is None:
            return *self._best(np.flatnonzero(others), self._beyond_longs(query)[others], k), n
        query = query.astype(np.int64)
        if n <= k or not len(query):
            return *self._best(np.flatnonzero(others), self._scores(others, query, most), k), n
        low, high = self.values[:, 0], self.values[:, -1]
        least = int(np.where(query > 0, query * low, query * high).sum())
        weight = np.abs(query)
        spans = weight * (high - low)
        # one sum for both where doubles hold it: units of gain, and below them the number of components seen
        unit = 1 << len(query).bit_length()
        both = most * unit < _DOUBLE
        gained, seen = np.zeros(n, np.int64), np.zeros(n, np.int64)
        kind = np.int32 if most * unit < 2.0**31 else np.int64
        sums = np.zeros(n, kind)
        taken = np.zeros(len(query), np.int64)
        top, before = int(spans.max()), None
        for level in [top * share // 100 for share in LEVELS] + [0]:
            rows, gains = [], []
            for d in np.flatnonzero(spans > level).tolist():
                values, q = self.values[d], int(weight[d])
                if query[d] > 0:
                    cut = n - int(np.searchsorted(values, low[d] + level // q, "right"))
                    run = slice(n - cut, n - int(taken[d]))
                else:
                    cut = int(np.searchsorted(values, high[d] - level // q, "left"))
                    run = slice(int(taken[d]), cut)
                if both and cut - taken[d] > LONG_RUN * n:
                    impact = self._in_rows(kind)[d] * kind(q if query[d] > 0 else -q)
                    if query[d] < 0:
                        impact += kind(spans[d])
                    here = impact > level if before is None else (impact > level) & (impact <= before)
                    impact *= kind(unit)
                    impact += kind(1)
                    impact *= here
                    sums += impact
                else:
                    rows.append(self.rows[d][run])
                    if not both:
                        gains.append((values[run] - low[d] if query[d] > 0 else high[d] - values[run]) * q)
                    elif query[d] > 0:
                        gains.append(self.above[d][run] * (q * unit) + 1)
                    else:
                        gains.append(self.above[d][run] * (-q * unit) + (int(spans[d]) * unit + 1))
                taken[d] = cut
            before = level
            if both:
                if rows:
                    sums += np.bincount(np.concatenate(rows), np.concatenate(gains), n).astype(kind)
                gained, seen = (x.astype(np.int64) for x in np.divmod(sums, kind(unit)))
            elif rows:
                self._add(gained, seen, np.concatenate(rows), np.concatenate(gains))
            ranked_ = np.where(others, gained, -1)
            best = np.argpartition(ranked_, n - k)[n - k :]
            if level == 0:  # nothing is left to gain
                possible = np.flatnonzero((gained >= ranked_[best].min()) & others)
                return *self._best(possible, least + gained[possible], k), 0
            best = best[others[best]]
            if len(best) < k:
                continue
            proven = self._scores(best, query, most).min()
            bound = least + gained - seen * level + int(np.minimum(spans, level).sum())
            possible = np.flatnonzero((bound >= proven) & others)
            if len(possible) <= max(POSSIBLE * n, k):
                return *self._best(possible, self._scores(possible, query, most), k), len(possible)
        raise AssertionError("the last level returns")

    @staticmethod
    def _add(gained: np.ndarray, seen: np.ndarray, rows: np.ndarray, gains: np.ndarray) -> None:
        """Add gains of up to 62 bits: the halves of the bits add up exactly."""
        n = len(gained)
        seen += np.bincount(rows, minlength=n)
        gained += np.bincount(rows, gains & 0x7FFFFFFF, n).astype(np.int64)
        gained += np.bincount(rows, gains >> 31, n).astype(np.int64) << 31

    def _best(self, rows: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        if len(scores) > k:
            good = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
            rows, scores = rows[good], scores[good]
        best = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows[best]], scores[best]


def search(vectors: DataFrame, queries: DataFrame, k: int, scale: float, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's ``k`` rows of the largest inner product of
    the vectors' components times ``scale``, rounded down; all if there are fewer.

    A row whose id is the query's is no candidate. Rows with null ids, null vectors or null or
    non-finite components take no part; missing components of shorter vectors count as zero. Equal
    query rows are one query; rows with one id and different vectors are queries of their own, and
    candidates always count row by row. An empty table gives an empty one. Other columns play no part.
    """

    def whole(df: DataFrame) -> DataFrame:
        return usable(df, id_column, vector_column).select("id", F.transform("vector", lambda x: F.floor(x * scale).cast("double")).alias("vector"))

    index = written(blocks(whole(vectors), SHARD_ROWS).withColumnRenamed("block", "shard"), "topk_shards")
    asked = blocks(whole(queries).dropDuplicates(["id", "vector"]), BLOCK_ROWS)

    def run(batches):
        last = shard = None
        for batch in pieces(batches, 1):
            number, ids, dims, matrix, query_ids, query_dims, query_matrix = (c[0].as_py() for c in batch.columns)
            (ids, rows), (query_ids, asked_rows) = unpacked(ids, dims, matrix), unpacked(query_ids, query_dims, query_matrix)
            shard_rows, asked_rows = same_width(rows, asked_rows)
            if last != (number, shard_rows.shape):  # a shard's blocks of queries follow each other
                last, shard = (number, shard_rows.shape), Shard(ids, shard_rows)
            out: list[tuple] = []
            for query_id, query in zip(query_ids.tolist(), asked_rows):
                found, scores, _ = shard.search(query, query_id, k)
                out += [(query_id, zlib.crc32(query.tobytes()), v, s) for v, s in zip(found.tolist(), scores.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)] or [pa.array([], pa.int64())] * 4, names=["query_id", "query_no", "vec_id", "score"])

    found = against_all(index, asked, COPIES).mapInArrow(run, "query_id long, query_no long, vec_id long, score long")
    return ranked(found, k).select("query_id", "rank", "vec_id", "score")
