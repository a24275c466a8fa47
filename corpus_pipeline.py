"""Corpus cleaning and packing: language, quality, near duplicates, training sequences.

Each stage takes (spark, docs, sf_dir) and works on what its predecessor kept; all but the last return
the columns they were given. SQL can't express the learned stages, so there is no oracle: the stages
are tested against brute force and held-out labels.
"""

from pyspark.sql import DataFrame, SparkSession

from tillbook.llm import jaccard, langid, packing, quality
from tillbook.llm.common import small_batches, table, written
from tillbook.llm.queries import VOCABULARY

ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: those without a letter, and those mostly in none of the languages."""
    small_batches(spark)
    return langid.keep_identified(docs, langid.learn(docs))


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that the score calls bad. Every label of a document that is still there teaches."""
    return quality.keep_good(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five-word shingles, similarity of 0.8 at least."""
    return jaccard.keep_one(docs, width=5, percent=80)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in training sequences."""
    return packing.pack_documents(docs, VOCABULARY, capacity=4096, end_id=1)


STAGES = [("language ID", language), ("quality classifier", good), ("n-gram Jaccard join", distinct), ("best-fit packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
