"""The registered queries: each applies its operator to its whole table and derives the digest columns."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.llm import ann, batch_bpe, extract, jaccard, langid, licenses, merkle, packing, quality, toolcalls, topk, trie, warc
from tillbook.llm.common import table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

#: The one tool that chats without tools are read as calling; see ``toolcalls.exchanges``.
RESPOND = [("respond", "prompt", "string", True), ("respond", "after", "string", False)]


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return topk.search(rows, rows.where("vec_id % 20 = 0"), k=20, scale=64.0)


def op2_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.identify_held_out(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked_components(table(spark, sf_dir, "documents"), width=4, percent=85)


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract_main_text(table(spark, sf_dir, "pages"))


def op5_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_held_out(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), VOCABULARY, capacity=4096, end_id=1)


def op7_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls and results that the messages hold as JSON, and questions and answers as such."""
    messages = table(spark, sf_dir, "conversations")
    spoken, written_ = toolcalls.exchanges(messages), toolcalls.parse_messages(messages)
    schemas = spark.createDataFrame(RESPOND, toolcalls.SCHEMAS)
    found = toolcalls.link(spoken[0].unionByName(written_[0]), spoken[1].unionByName(written_[1]), schemas)
    return found.withColumn("errors", F.concat_ws(", ", "errors"))


def op8_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return ann.search(ann.build_index(rows, k=5), rows.where("vec_id % 50 = 0"), k=5)


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_bpe.token_digests(table(spark, sf_dir, "documents"), VOCABULARY)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as a file tree: a source's thousands and hundreds are directories. Of each hundred
    the first five documents are the license files of the thousand's directory and the next five those
    of the hundred's."""
    documents = table(spark, sf_dir, "documents")
    thousand, hundred, rest = (F.expr(e).cast("string") for e in ("doc_id div 1000", "doc_id div 100 % 10", "doc_id"))
    place = F.expr("doc_id % 100")
    path = (
        F.when(place < 5, F.concat_ws("/", "source", thousand, F.concat(F.lit("LICENSE."), rest)))
        .when(place < 10, F.concat_ws("/", "source", thousand, hundred, F.concat(F.lit("LICENSE."), rest)))
        .otherwise(F.concat_ws("/", "source", thousand, hundred, F.concat(rest, F.lit(".txt"))))
    )
    files = documents.select(F.col("doc_id").alias("file_id"), F.when(F.col("doc_id").isNotNull(), path).alias("path"), "text")
    return licenses.scan(files, licenses.templates(spark)).withColumnRenamed("file_id", "doc_id")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.build(table(spark, sf_dir, "conversations"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"), every=7)


def op13_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), segment_bytes=16 << 10, chunk_bytes=4 << 10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_exact_top_k, op2_language_mixture, op3_ngram_jaccard_join, op4_html_extraction, op5_quality_score,
        op6_best_fit_packing, op7_tool_call_linking, op8_ann_search, op9_bpe_round_trip, op10_license_scan, op11_prefix_trie,
        op12_merkle_manifest, op13_warc_round_trip,
    )
}
