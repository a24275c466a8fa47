"""Every registered query against its SQL oracle."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from tillbook.verification.oracle import sql
from tillbook.verification.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"
ORACLE = sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def exact(value):
    """Type and scale count too, not only equality of numbers."""
    return type(value).__name__, str(value)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    ours = Counter(tuple(map(exact, (r[c] for c in columns))) for r in result.collect())
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    position = [names.index(c) for c in columns]
    theirs = Counter(tuple(map(exact, (row[i] for i in position))) for row in cursor.fetchall())
    assert sum(ours.values()) > 0
    assert ours == theirs
