"""Language identification as inference of a document's mixture of languages.

Each language is a distribution over hashed character trigrams, learned by counting. A document's
trigrams are taken as drawn from a mixture of the languages; expectation-maximisation estimates the
proportions. Its set of languages is the one with the best likelihood less a penalty for each language
more, searched along the languages in the order of their proportions. The full mixture's likelihood
bounds that of every set, so most documents need no search.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.llm.common import PIECE_ROWS, pieces, text_key

UNDETERMINED = "und"
#: Documents of each language that are learned from, in the mean: a random choice by hash of doc_id.
LEARN_DOCUMENTS = 3000
#: Different values of lang: the model has 128 KB for each, on the driver and in every worker.
MOST_LANGUAGES = 512
#: Partitions that count the chosen documents; each sends one row per language to the driver.
LEARN_PARTS = 12
BITS = 14
SMOOTHING = 0.5
ROUNDS = 12
#: Neighbouring trigrams share characters: this many count as one observation.
OVERLAP = 3.0
#: Penalty for each further language, beside half the logarithm of the number of observations.
PENALTY = 3.0


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    #: p(trigram | language), a row per bucket.
    table: np.ndarray


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def trigram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and counts of the trigrams of a whole text: lower-cased letters, runs of anything else
    as one space, and a space at both ends. Both are empty if there is no letter."""
    codes = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    kept = letter.copy()
    kept[0] = True
    kept[1:] |= letter[:-1]
    codes = np.where(letter, codes, 32)[kept].astype(np.uint64)
    mixed = codes[:-2] * np.uint64(0x9E3779B97F4A7C15) + codes[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + codes[2:] * np.uint64(0x165667B19E3779F9)
    mixed ^= mixed >> np.uint64(29)
    counts = np.bincount(((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BITS)).astype(np.int64), minlength=1 << BITS)
    buckets = np.flatnonzero(counts)
    return buckets, counts[buckets]


def learn(labelled: DataFrame, documents_per_language: int = LEARN_DOCUMENTS, most_languages: int = MOST_LANGUAGES) -> Model:
    """``labelled``: doc_id, text, lang. Rows without lang or letters teach nothing. More than ``most_languages``
    different values of lang are an error, as they can't all be languages."""
    labelled = labelled.where("lang is not null").select("doc_id", "text", "lang")
    sizes = {r.lang: r["count"] for r in labelled.groupBy("lang").count().limit(most_languages + 1).collect()}
    if len(sizes) > most_languages:
        raise ValueError(f"lang has more than {most_languages} different values")
    if not sizes:
        return Model((), np.empty((1 << BITS, 0)))
    languages = tuple(sorted(sizes))
    share = F.create_map(*[F.lit(x) for lang in languages for x in (lang, documents_per_language / sizes[lang])])
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for piece in pieces(batches):
            for lang, text in zip(*(c.to_pylist() for c in piece.columns)):
                buckets, counts = trigram_counts(text)
                total = sums.setdefault(lang, np.zeros(1 << BITS))
                total[buckets] += counts
        yield pa.RecordBatch.from_arrays(
            [pa.array([*sums], pa.string()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["lang", "counts"]
        )

    chosen = labelled.where(draw < share[F.col("lang")]).select("lang", "text").repartition(LEARN_PARTS)
    table = np.full((1 << BITS, len(languages)), SMOOTHING)
    for lang, counts in chosen.mapInArrow(count, "lang string, counts binary").collect():
        table[:, languages.index(lang)] += np.frombuffer(counts)
    return Model(languages, table / table.sum(axis=0))


def _mixtures(likely: np.ndarray, counts: np.ndarray, starts: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log-likelihood of each document. ``likely``: a row for each of its trigrams;
    languages that ``start`` leaves out stay out."""
    sizes = np.add.reduceat(counts, starts)
    spans = np.diff(np.r_[starts, len(counts)])
    proportions = start / start.sum(axis=1, keepdims=True)
    for _ in range(ROUNDS):
        joint = likely * np.repeat(proportions, spans, axis=0)
        joint *= (counts / joint.sum(axis=1))[:, None]
        proportions = np.add.reduceat(joint, starts) / sizes[:, None]
    total = (likely * np.repeat(proportions, spans, axis=0)).sum(axis=1)
    return proportions, np.add.reduceat(counts * np.log(total), starts)


def infer(model: Model, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """For each text the proportions of the chosen languages, and those of the full mixture; rows of
    zeros for texts without letters."""
    n = len(model.languages)
    chosen, full = np.zeros((len(texts), n)), np.zeros((len(texts), n))
    found = [trigram_counts(t) for t in texts]
    some = np.array([i for i, (b, _) in enumerate(found) if len(b)], np.int64)
    if not len(some) or not n:
        return chosen, full
    spans = np.array([len(found[i][0]) for i in some])
    starts = np.cumsum(spans) - spans
    likely = model.table[np.concatenate([found[i][0] for i in some])]
    counts = np.concatenate([found[i][1] for i in some]).astype(float)
    observed = np.add.reduceat(counts, starts) / OVERLAP
    penalty = 0.5 * np.log(observed + 1) + PENALTY

    everything, best = _mixtures(likely, counts, starts, np.ones((len(some), n)))
    singles = np.add.reduceat(counts[:, None] * np.log(likely), starts)
    result = np.zeros_like(everything)
    result[np.arange(len(some)), singles.argmax(axis=1)] = 1
    value = singles.max(axis=1) / OVERLAP
    order = np.argsort(-everything, axis=1, kind="stable")
    for k in range(2, n + 1):
        # no set of k languages is likelier than all of them together
        open_ = np.flatnonzero(best / OVERLAP - (k - 1) * penalty > value)
        if not len(open_):
            break
        rows = np.repeat(np.isin(np.arange(len(some)), open_), spans)
        start = np.zeros((len(open_), n))
        np.put_along_axis(start, order[open_, :k], 1, axis=1)
        part = np.cumsum(spans[open_]) - spans[open_]
        proportions, reached = _mixtures(likely[rows], counts[rows], part, start)
        reached = reached / OVERLAP - (k - 1) * penalty[open_]
        better = reached > value[open_]
        result[open_[better]], value[open_[better]] = proportions[better], reached[better]
    chosen[some], full[some] = result, everything
    return chosen, full


def identify(documents: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, lang_pred, score, and ``languages``, a map of the chosen languages
    to their proportions.

    lang_pred is the language with the largest proportion (the first by name among equals) and score its
    proportion in the full mixture. Null texts and texts without a letter get ``und``, 0 and an empty
    map, as does everything if there was nothing to learn from. Rows are judged one by one: repeated
    rows and null ids stay, an empty table gives an empty one, other columns play no part.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        kept: Model = shared.value
        for piece in pieces(batches):
            chosen, full = infer(kept, piece.column(1).to_pylist())
            names, scores, maps = [], [], []
            for row, whole in zip(chosen, full):
                at = int(row.argmax()) if row.any() else -1
                names.append(kept.languages[at] if at >= 0 else UNDETERMINED)
                scores.append(min(1.0, float(whole[at])) if at >= 0 else 0.0)
                maps.append([(kept.languages[k], float(row[k])) for k in np.flatnonzero(row)])
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(maps, pa.map_(pa.string(), pa.float64()))],
                names=["doc_id", "lang_pred", "score", "languages"],
            )

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double, languages map<string,double>"
    )


def with_background(model: Model) -> Model:
    """The model with UNDETERMINED as its last language, in which all trigrams are alike."""
    uniform = np.full((len(model.table), 1), 1 / len(model.table))
    return Model((*model.languages, UNDETERMINED), np.c_[model.table, uniform])


def keep_identified(documents: DataFrame, model: Model) -> DataFrame:
    """The documents with a language, with all their columns. Those go that have no letter, and those of which the
    chosen mixture says that most of it is in none of the languages. Without a learned language, documents with
    letters stay.

    Only texts go to Python, and only decisions come back.
    """
    shared = documents.sparkSession.sparkContext.broadcast(with_background(model))

    @F.arrow_udf("boolean")
    def identified(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in texts:
            kept: list[bool] = []
            for start in range(0, len(part), PIECE_ROWS):
                some = part.slice(start, PIECE_ROWS).to_pylist()
                if len(shared.value.languages) > 1:
                    chosen = infer(shared.value, some)[0]
                    kept += (chosen.any(axis=1) & (chosen.argmax(axis=1) < chosen.shape[1] - 1)).tolist()
                else:
                    kept += [len(trigram_counts(t)[0]) > 0 for t in some]
            yield pa.array(kept, pa.bool_())

    return documents.where(identified("text"))


def held_out_split(documents: DataFrame) -> DataFrame:
    """``held_out``: crc32 of doc_id as text leaves 1 when divided by 3. A null id is held out."""
    return documents.withColumn("held_out", F.coalesce(text_key("doc_id") % 3 == 1, F.lit(True)))


def identify_held_out(documents: DataFrame) -> DataFrame:
    """Learns from the documents that aren't held out and identifies all of them."""
    model = learn(held_out_split(documents.select("doc_id", "text", "lang")).where("not held_out"))
    return held_out_split(identify(documents, model)).select("doc_id", "held_out", "lang_pred", "score", "languages")
