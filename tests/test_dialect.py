"""Random CSV text read by Spark and by pandas."""

import random

import pandas as pd
import pytest
from pyspark.errors import PySparkException

from golden import GOLDEN
from tillbook.schema import RAW_COLUMNS, RAW_SCHEMA, order_columns
from tillbook.sources.csv_source import read_sales_csv

TEXTS = [
    "A", "", '""', "NA", '"NA"', " NA ", "n/a", "None", "none", "null", "Null", "nan", "#N/A", "<NA>", "-", "0",
    '"x,y"', '"say ""hi"""', '"""quoted"""', 'a"b', "it's", "é", "日本", "a;b", "tab\tx", "back\\slash", '"in \\ quotes"',
    '"ends with \\"', " padded ", "'single'", "#comment", "1e5", "007", "=1+1", '","', '",,"',
]
NUMBERS = ["5", "5.00", "-0.25", "0", "1234567.8901", "NA", "", "null", " 5.5 ", "1e2", "+3", ".5", "5.", "0005"]
BREAKS = ['"two\nlines"', '"three\n\nlines"', '"break, ""and"" \n comma"']


def random_file(seed, texts):
    rng = random.Random(seed)
    lines = [GOLDEN.splitlines()[0]]
    for i in range(400):
        row = [f"X-{i}"]
        for field in RAW_SCHEMA.fields[1:]:
            kind = field.dataType.typeName()
            row.append(rng.choice(texts if kind == "string" else ["1", "2", "NA", "7"] if kind == "integer" else NUMBERS))
        if rng.random() < 0.05:
            row = row[: rng.randrange(2, len(row))]
        lines.append(",".join(row))
        if rng.random() < 0.05:
            lines.append(rng.choice(["", "   "]))
    return "\n".join(lines) + "\n"


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("multi_line", [False, True])
def test_reads_what_pandas_reads(spark, tmp_path, seed, multi_line):
    path = tmp_path / "random.csv"
    path.write_text(random_file(seed, TEXTS + BREAKS if multi_line else TEXTS))
    text_columns = [f.name for f in RAW_SCHEMA if f.dataType.typeName() == "string"]
    expected = pd.read_csv(path, header=0, names=RAW_COLUMNS, dtype=dict.fromkeys(text_columns, str))
    df = read_sales_csv(spark, str(path), multi_line=multi_line)
    got = df.orderBy(*order_columns(df)).select(*RAW_COLUMNS).collect()
    assert len(got) == len(expected)
    for column in RAW_COLUMNS:
        for row, want in zip(got, expected[column]):
            have = row[column]
            if pd.isna(want):
                assert have is None, (column, row)
            elif column in text_columns:
                assert have == want, (column, row)
            else:
                assert float(have) == want, (column, row)


@pytest.mark.parametrize("seed", range(5))
def test_a_single_quoted_line_break_is_reported(spark, tmp_path, seed):
    """In any text column, among otherwise readable rows."""
    rng = random.Random(seed)
    lines = random_file(seed, [t for t in TEXTS if '"' not in t]).splitlines()
    row = ["X", *["1"] * 16]
    row[rng.choice([0, 1, 5, 12])] = rng.choice(BREAKS)
    lines.insert(rng.randrange(2, len(lines)), ",".join(row))
    path = tmp_path / "break.csv"
    path.write_text("\n".join(lines) + "\n")
    with pytest.raises(PySparkException, match="multi_line"):
        read_sales_csv(spark, str(path)).collect()
    assert len(pd.read_csv(path)) == read_sales_csv(spark, str(path), multi_line=True).count()
