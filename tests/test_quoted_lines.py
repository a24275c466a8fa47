"""Line breaks in quotes, read by splits, against Spark's own reader of whole files and against pandas."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException

from golden import GOLDEN
from test_dialect import BREAKS, TEXTS, random_file
from tillbook.schema import RAW_COLUMNS, order_columns
from tillbook.sources import quoted_lines
from tillbook.sources.csv_source import normalize_headers, read_sales_csv

HEADER = GOLDEN.splitlines()[0]


@pytest.fixture
def small_splits(spark):
    def use(n_bytes):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n_bytes))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield use
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def whole_files(spark, path):
    """Text columns as Spark reads them with a file as one split."""
    df = spark.read.options(header=True, multiLine=True, quote='"', escape='"').csv(path)
    return [tuple(r) for r in df.toDF(*normalize_headers(df.columns)).select("invoice_id", "branch", "city", "payment").collect()]


def by_splits(spark, path):
    df = read_sales_csv(spark, path, multi_line=True)
    return df.rdd.getNumPartitions(), [tuple(r) for r in df.orderBy(*order_columns(df)).select("invoice_id", "branch", "city", "payment").collect()]


def plain(seed, end):
    """Rows without tokens for null, which only our reader knows."""
    texts = [t for t in TEXTS if t.strip('"') not in ("", "NA", "n/a", "None", "none", "null", "Null", "nan", "#N/A", "<NA>", " NA ")]
    text = random_file(seed, texts + BREAKS * 3)
    return text.replace("\n", end)


@pytest.mark.parametrize("seed, split, end", [(1, 1500, "\n"), (2, 600, "\n"), (3, 1500, "\r\n"), (4, 1 << 20, "\n")])
def test_equals_whole_files(spark, tmp_path, small_splits, seed, split, end):
    """But for the two bytes of a line break in a field, which Spark's reader makes one, and pandas doesn't."""
    path = tmp_path / "breaks.csv"
    path.write_bytes(plain(seed, end).encode())
    expected = [tuple(v and v.replace("\n", end) for v in r) for r in whole_files(spark, str(path)) if r != ("   ", None, None, None)]
    small_splits(split)
    parts, found = by_splits(spark, str(path))
    assert found == expected
    assert parts > 4 or split > 4000
    assert any("\n" in (v or "") for r in found for v in r)


def test_records_over_many_splits_and_files(spark, tmp_path, small_splits):
    long = "x,\n" * 700 + '""y""' + "\n" * 300
    row = ",".join(["A"] * 3 + ["1"] * 14)
    for name, records in (("b.csv", [f'"{long}",{row[2:]}', row]), ("a.csv", [row, f'"1{long}","{long}",{row[4:]}', f'Z,"\n",{row[4:]}']), ("c.csv", [])):
        (tmp_path / name).write_text("\n".join([HEADER, *records]) + ("\n" if name != "a.csv" else ""))
    small_splits(64)
    _, found = by_splits(spark, str(tmp_path))
    real = long.replace('""', '"')
    assert [r[:2] for r in found] == [("A", "A"), (f"1{real}", real), ("Z", "\n"), (real, "A"), ("A", "A")]


def test_pandas_reads_the_same(spark, tmp_path, small_splits):
    path = tmp_path / "breaks.csv"
    path.write_bytes(random_file(9, TEXTS + BREAKS * 3).replace("\n", "\r\n").encode())
    small_splits(2000)
    expected = pd.read_csv(path, header=0, names=RAW_COLUMNS, dtype=str)
    df = read_sales_csv(spark, str(path), multi_line=True)
    got = df.orderBy(*order_columns(df)).select("invoice_id", "branch", "payment").collect()
    assert [tuple(r) for r in got] == [tuple(None if pd.isna(v) else v for v in r) for r in expected[["invoice_id", "branch", "payment"]].itertuples(index=False)]


def test_an_open_quote_is_an_error(spark, tmp_path, small_splits):
    path = tmp_path / "open.csv"
    path.write_text(f'{HEADER}\nX-1,"A,Yangon\n' + "X-2,B\n" * 50)
    small_splits(100)
    with pytest.raises(Exception, match="quote isn.t closed.*open.csv"):
        read_sales_csv(spark, str(path), multi_line=True).collect()


def test_headers_differ(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f'{HEADER}\nX-1,"A\n"\n')
    (tmp_path / "b.csv").write_text(f'{HEADER.replace("Branch,City", "City,Branch")}\nX-1,"A\n"\n')
    with pytest.raises(PySparkException, match="header does not conform"):
        read_sales_csv(spark, str(tmp_path), multi_line=True).collect()


def test_how_lines_begin():
    choose = random.Random(4)
    for _ in range(300):
        pairs = [choose.choice([(False, True), (True, False), (False, False), (True, True)]) for _ in range(choose.randint(1, 12))]
        for inside in (False, True):
            states = [inside]
            for a, b in pairs:
                states.append(b if states[-1] else a)
            a, b = (np.array(x) for x in zip(*pairs))
            assert quoted_lines._begins(inside, a, b).tolist() == states


@pytest.mark.parametrize("multi_line", [False, True])
def test_a_replacement_character_is_no_bad_byte(spark, tmp_path, multi_line):
    path = tmp_path / "sales.csv"
    rows = ["X-1,A,Z�rich", "X-2,日本,Zürich 😀", 'X-3,"é\n",x' if multi_line else "X-3,é,x"]
    path.write_text("\n".join([HEADER, *rows]) + "\n", encoding="utf-8")
    df = read_sales_csv(spark, str(path), multi_line=multi_line)
    assert [tuple(r) for r in df.orderBy(*order_columns(df)).select("branch", "city").collect()] == [("A", "Z�rich"), ("日本", "Zürich 😀"), ("é\n" if multi_line else "é", "x")]
    for bad in (b"X-4,Z\xfcrich\n", b"X-4,\xc3,\xa9\n", b"X-4,\xed\xa0\x80\n"):
        (tmp_path / "bad.csv").write_bytes(path.read_bytes() + bad)
        with pytest.raises(PySparkException, match="not UTF-8.*bad.csv"):
            read_sales_csv(spark, str(tmp_path / "bad.csv"), multi_line=multi_line).collect()


@pytest.mark.parametrize("multi_line", [False, True])
def test_headings_of_other_letters(spark, tmp_path, multi_line):
    path = tmp_path / "sales.csv"
    path.write_text(HEADER.replace("City", "Stadt ü") + "\nX,A,B\n", encoding="utf-8")
    with pytest.raises(ValueError, match="stadt_ü"):
        read_sales_csv(spark, str(path), multi_line=multi_line)


def test_single_byte_encodings_are_split_too(spark, tmp_path, small_splits):
    path = tmp_path / "latin.csv"
    path.write_bytes("\n".join([HEADER, *[f'X-{k},"Zü\nrich",é' for k in range(60)], ""]).encode("latin-1"))
    small_splits(100)
    df = read_sales_csv(spark, str(path), multi_line=True, encoding="ISO-8859-1")
    assert df.rdd.getNumPartitions() > 4
    assert [tuple(r) for r in df.orderBy(*order_columns(df)).select("invoice_id", "branch", "city").collect()] == [(f"X-{k}", "Zü\nrich", "é") for k in range(60)]


def test_wide_encodings_are_read_whole(spark, tmp_path):
    path = tmp_path / "wide.csv"
    path.write_bytes(f'{HEADER}\nX-1,"Zü\nrich",é\n'.encode("utf-16"))
    assert [tuple(r) for r in read_sales_csv(spark, str(path), multi_line=True, encoding="UTF-16").select("branch", "city").collect()] == [("Zü\nrich", "é")]
