"""Registered queries against their SQL, and the pipeline."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from tests.llm.fixtures import DOCUMENTS, with_clashes, with_every_clash
from tests.llm.test_jaccard import brute_force
from tillbook.llm import langid, quality
from tillbook.llm.oracle import SQL
from tillbook.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, name):
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    cursor = connection.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    ours = Counter(tuple(r[c] for c in columns) for r in result.collect())
    assert ours and ours == Counter(tuple(row[i] for i in at) for row in cursor.fetchall())


def test_every_operator_is_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    extra = spark.createDataFrame([(9001, " 12 !", None, None, 0), (9002, None, None, None, 0), (9003, "", None, None, 0)], DOCUMENTS)
    docs = with_clashes(docs.unionByName(extra))
    (_, language), (_, good), (_, distinct), (_, packed) = corpus_pipeline.STAGES

    spoken = language(spark, docs, SF_DIR)
    assert spoken.columns == docs.columns
    assert {r.doc_id for r in docs.select("doc_id").subtract(spoken.select("doc_id")).collect()} == {9001, 9002, 9003}

    kept = good(spark, spoken, SF_DIR)
    assert kept.columns == docs.columns
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = quality.learn(spoken, labels)
    expected = {r.doc_id for r in quality.score(spoken, model).where("predicted = 1").collect()}
    assert {r.doc_id for r in kept.select("doc_id").collect()} == expected
    clean = {r.doc_id for r in labels.where("quality = 1").collect()}
    assert len(clean - expected) <= 0.02 * len(clean)

    single = distinct(spark, kept, SF_DIR)
    assert single.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in kept.select("doc_id", "text").collect()]
    assert sorted(r.doc_id for r in single.select("doc_id").collect()) == sorted(i for i, _, c in brute_force(rows) if c == i)

    pieces = packed(spark, single, SF_DIR).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in single.select("doc_id").collect()}


def test_pipeline_joins_at_five_words_and_four_fifths(spark):
    """Words added to a copy leave the similarity between 0.80 and 0.85, or just below 0.80."""
    base = [f"w{k}" for k in range(104)]
    texts = [base, base + [f"x{k}" for k in range(20)], base + [f"y{k}" for k in range(25)], base + [f"z{k}" for k in range(26)], [f"v{k}" for k in range(50)]]
    rows = [(i, " ".join(words)) for i, words in enumerate(texts)]
    docs = spark.createDataFrame([(i, text, None, None, 0) for i, text in rows], DOCUMENTS)
    _, distinct = corpus_pipeline.STAGES[2]
    kept = sorted(r.doc_id for r in distinct(spark, docs, SF_DIR).collect())
    assert kept == sorted(i for i, _, c in brute_force(rows, width=5, percent=80) if c == i) == [0, 3, 4]


def test_stages_bear_columns_of_every_name(spark):
    docs = with_every_clash(spark.read.parquet(f"{SF_DIR}/documents.parquet").where("doc_id < 60"))
    plain = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("doc_id < 60")
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, SF_DIR)
        assert found.columns == docs.columns or name == "best-fit packing"
        assert sorted(r.doc_id for r in found.select("doc_id").collect()) == sorted(r.doc_id for r in stage(spark, plain, SF_DIR).select("doc_id").collect())


def test_the_mixture_decides_what_has_no_language(spark):
    """A text of letters in no learned language goes, one that holds some such letters stays."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    english = docs.where("lang = 'en' and n_chars > 500").first().text
    extra = [(9001, "qzx kkjw vvqp xxzj wqkz " * 20, None, None, 0), (9002, english, None, None, 0), (9003, english + " qzx kkjw vvqp" * 5, None, None, 0)]
    docs = docs.unionByName(spark.createDataFrame(extra, DOCUMENTS))
    kept = {r.doc_id for r in corpus_pipeline.STAGES[0][1](spark, docs, SF_DIR).collect()}
    assert 9001 not in kept and {9002, 9003} <= kept


def test_pipeline_bears_no_rows(spark):
    docs = spark.createDataFrame([], DOCUMENTS)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert docs.collect() == []


def test_a_language_model_needs_no_ids(spark):
    """lang, source and doc_id are no inputs of a prediction."""
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = langid.learn(rows)
    changed = rows.selectExpr("doc_id + 7 as doc_id", "text", "'xx' as lang", "'s' as source", "n_chars")
    assert sorted((r.doc_id, r.lang_pred) for r in langid.identify(rows, model).collect()) == sorted((r.doc_id - 7, r.lang_pred) for r in langid.identify(changed, model).collect())
