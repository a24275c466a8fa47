"""Quality score of documents: kernel ridge regression by random Fourier features, calibrated.

A document becomes a few statistics of its whole text. Random Fourier features turn them into
coordinates whose inner products approximate a Gaussian kernel; each partition sums its part of the
normal equations, and the driver solves the ridge system of a fixed size. Isotonic regression on rows
that the ridge hasn't seen turns its values into shares of good documents.
"""

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.llm.common import PIECE_ROWS, pieces, text_key, written

#: Labelled documents that are learned from, in the mean: a random choice by hash of doc_id.
LEARN_DOCUMENTS = 20_000
#: Partitions that sum the normal equations; each sends one matrix to the driver.
LEARN_PARTS = 8
FEATURES = 256
BANDWIDTH = 6.0
RIDGE = 1e-4
#: Values of the ridge are calibrated in steps of this size.
STEP = 0.002
THRESHOLD = 0.3

STATISTICS = (
    "log_chars", "log_words", "log_lines", "word_length", "letters", "capitals", "digits", "blanks", "stops",
    "symbols", "bytes_entropy", "distinct_words", "commonest_word", "repeats_word", "distinct_lines", "ends_in_symbol", "accents",
)

_KIND = np.zeros((256, 6))
for _b in range(256):
    _c = chr(_b)
    _KIND[_b] = (
        _b >= 128 or _c.isalpha(), _b < 128 and _c.isupper(), _b < 128 and _c.isdigit(), _b < 128 and _c.isspace(),
        _c in ".,;:'-", _b >= 128,
    )


def statistics(text: str | None) -> list[float]:
    """STATISTICS of a text; all zero for null, empty and blank ones."""
    words = (text or "").split()
    if not words:
        return [0.0] * len(STATISTICS)
    data = text.encode("utf-8", "surrogatepass")
    seen = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    letters, capitals, digits, blanks, stops, accents = (seen @ _KIND).tolist()
    shares = seen[seen > 0] / len(data)
    counts = Counter(words)
    lines = [line for line in text.split("\n") if line]
    symbols = len(data) - letters - digits - blanks - stops
    return [
        np.log1p(len(data)), np.log1p(len(words)), np.log1p(len(lines)), (len(data) - blanks) / len(words),
        letters / len(data), capitals / max(1, letters), digits / len(data), blanks / len(data), stops / len(data),
        symbols / len(data), float(-(shares * np.log(shares)).sum()), len(counts) / len(words),
        max(counts.values()) / len(words), sum(map(eq, words, words[1:])) / len(words), len(set(lines)) / max(1, len(lines)),
        sum(not w[-1].isalnum() for w in counts) / len(counts), accents / len(data),
    ]


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    #: Isotonic calibration: values and the shares between which it interpolates.
    values: np.ndarray
    shares: np.ndarray

    def features(self, rows: np.ndarray) -> np.ndarray:
        x = np.clip((rows - self.mean) / self.scale, -6, 6)
        waves = np.sqrt(2 / len(self.phases)) * np.cos(x @ self.directions + self.phases)
        return np.c_[waves, np.ones(len(rows))]

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return self.features(rows) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(rows), self.values, self.shares), 0, 1)


def isotonic(values: np.ndarray, good: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pools neighbours out of order: each pool's mean value and share of good rows, both rising."""
    pools: list[list[float]] = []
    for v, g, t in zip(values, good, total):
        pools.append([v * t, g, t])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return np.array([v / t for v, _, t in pools]), np.array([g / t for _, g, t in pools])


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([batch.column(n).to_numpy(zero_copy_only=False) for n in STATISTICS])


def _described(documents: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` and the statistics of ``text``."""
    fields = [f"{n} {documents.schema[n].dataType.simpleString()}" for n in keep] + [f"{n} double" for n in STATISTICS]

    def run(batches):
        for piece in pieces(batches):
            rows = np.array([statistics(t) for t in piece.column(len(keep)).to_pylist()]).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([*piece.columns[: len(keep)], *map(pa.array, rows.T)], names=[*keep, *STATISTICS])

    return documents.select(*keep, "text").mapInArrow(run, ", ".join(fields))


def learn(documents: DataFrame, labels: DataFrame, most: int = LEARN_DOCUMENTS) -> Model | None:
    """``labels``: doc_id, quality (0 or 1). Null labels teach nothing, and of several labels of a
    document the majority counts, good if there is none. None if there is nothing to learn from.

    The labelled documents are drawn before their texts are read, ``most`` in the mean, so that the
    drawn ids may be broadcast. One draw in four calibrates, the others fit the ridge.
    """
    labels = labels.where("doc_id is not null and quality is not null")
    voted = labels.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("double").alias("good"))
    share = most / max(1, voted.count())
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000
    drawn = voted.where(draw < share).withColumn("fits", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4)) > 0)
    joined = documents.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").select("good", "fits", "text")
    rows = written(_described(joined.repartition(LEARN_PARTS), "good", "fits"), "quality_rows")
    summary = rows.agg(F.count("*"), *[f(n) for n in STATISTICS for f in (F.avg, F.stddev_pop)]).first()
    if not summary[0]:
        return None
    random = np.random.default_rng(5)
    model = Model(
        np.array(summary[1::2]), np.maximum(np.array(summary[2::2]), 1e-6),
        random.normal(size=(len(STATISTICS), FEATURES)) / BANDWIDTH, random.uniform(0, 2 * np.pi, FEATURES),
        np.zeros(FEATURES + 1), np.zeros(1), np.zeros(1),
    )

    def sums(batches):
        squares, products = np.zeros((FEATURES + 1, FEATURES + 1)), np.zeros(FEATURES + 1)
        for piece in pieces(batches, 2048):
            z = model.features(_matrix(piece))
            squares += z.T @ z
            products += z.T @ piece.column("good").to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array([squares.tobytes()]), pa.array([products.tobytes()])], names=["squares", "products"])

    squares, products = RIDGE * np.eye(FEATURES + 1), np.zeros(FEATURES + 1)
    n = summary[0]
    fitting = rows.where("fits").coalesce(LEARN_PARTS)
    for part in fitting.mapInArrow(sums, "squares binary, products binary").collect():
        squares += np.frombuffer(part.squares).reshape(squares.shape) / n
        products += np.frombuffer(part.products) / n
    model = Model(model.mean, model.scale, model.directions, model.phases, np.linalg.solve(squares, products), model.values, model.shares)

    def raw(batches):
        for piece in pieces(batches, 2048):
            yield pa.RecordBatch.from_arrays([pa.array(model.raw(_matrix(piece))), piece.column("good")], names=["value", "good"])

    step = F.round(F.col("value") / STEP)
    seen = rows.where("not fits").mapInArrow(raw, "value double, good double").groupBy(step.alias("step")).agg(F.sum("good"), F.count("*"))
    found = np.array(sorted(map(tuple, seen.collect())), float).reshape(-1, 3)
    if not len(found):  # too few rows to calibrate: the ridge's own values, cut to 0..1
        values, shares = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    else:
        values, shares = isotonic(found[:, 0] * STEP, found[:, 1], found[:, 2])
    return Model(model.mean, model.scale, model.directions, model.phases, model.weights, values, shares)


def score(documents: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, score (0 to 1), predicted (1 if score >= ``threshold``).

    Null, empty and blank texts are scored by their statistics, which are zero. Without a model every
    score is 0.5. Rows are judged one by one: repeated rows and null ids stay, an empty table gives an
    empty one, other columns play no part.
    """

    def run(batches):
        for piece in pieces(batches):
            rows = np.array([statistics(t) for t in piece.column(1).to_pylist()]).reshape(-1, len(STATISTICS))
            scores = model.score(rows) if model else np.full(len(rows), 0.5)
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"]
            )

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double, predicted int")


def keep_good(documents: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score at least ``threshold``, with all their columns; all without a model. Only texts go to
    Python, and only decisions come back."""
    if not model:
        return documents

    @F.arrow_udf("boolean")
    def good(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in texts:
            kept: list[bool] = []
            for start in range(0, len(part), PIECE_ROWS):
                rows = np.array([statistics(t) for t in part.slice(start, PIECE_ROWS).to_pylist()]).reshape(-1, len(STATISTICS))
                kept += (model.score(rows) >= threshold).tolist()
            yield pa.array(kept, pa.bool_())

    return documents.where(good("text"))


def held_out_split(rows: DataFrame) -> DataFrame:
    """``held_out``: crc32 of doc_id as text is divisible by 5. A null id is held out."""
    return rows.withColumn("held_out", F.coalesce(text_key("doc_id") % 5 == 0, F.lit(True)))


def score_held_out(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Learns from labelled documents that aren't held out and scores all documents."""
    model = learn(documents, held_out_split(labels.select("doc_id", "quality")).where("not held_out"))
    return held_out_split(score(documents, model)).select("doc_id", "held_out", "score", "predicted")
