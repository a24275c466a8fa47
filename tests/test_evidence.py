"""Date patterns and decimals from the data, and all reports from one scan."""

import random
import re
from decimal import Decimal
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from golden import GOLDEN, changed
from tillbook.functions import AmbiguousDatesError, date_evidence, date_pattern_of, decimals_needed
from tillbook.functions.evidence import DATE_PATTERNS, decimals
from tillbook.operators.quality import table_profile
from tillbook.plans import daily_load, reports
from tillbook.sources.csv_source import read_sales_csv
from tillbook.verification.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def dates(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "date string")


@pytest.mark.parametrize("texts, pattern", [
    (["1/5/2019", "12/31/2019", None], "M/d/yyyy"),
    (["1/5/2019", "13/01/2019"], "d/M/yyyy"),
    (["1/5/2019", "13/01/2019", "1/13/2019", "14/2/2019", "no date"], "d/M/yyyy"),
    (["5/5/2019", "1/1/2020"], "M/d/yyyy"),
    (["2019-03-27"], "yyyy-M-d"), (["27.3.2019"], "d.M.yyyy"), (["27 Mar 2019"], "d MMM yyyy"), (["Mar 27, 2019"], "MMM d, yyyy"),
    ([], "M/d/yyyy"), ([None, "never"], "M/d/yyyy"),
])
def test_the_pattern_that_fits_most(spark, texts, pattern):
    assert date_pattern_of(dates(spark, texts)) == pattern


def test_dates_that_say_nothing_are_an_error(spark):
    with pytest.raises(AmbiguousDatesError, match="M/d/yyyy and d/M/yyyy"):
        date_pattern_of(dates(spark, ["1/5/2019", "5/5/2019"]))
    counts = {r.pattern: (r.parsed, r.texts) for r in date_evidence(dates(spark, ["1/5/2019", "13/5/2019", None])).collect()}
    assert counts["M/d/yyyy"] == (1, 2) and counts["d/M/yyyy"] == (2, 2) and list(counts) == DATE_PATTERNS


def test_any_file_decides(spark, tmp_path):
    """The only date that tells day and month apart may be in any of the files."""
    header, *rows = GOLDEN.splitlines()
    plain = [re.sub(r",\d+/\d+/2019,", ",2/3/2019,", r) for r in rows if r.startswith(("I-01", "I-07", "I-08"))]
    telling = plain[-1].replace("2/3/2019", "13/01/2019").replace("I-08", "I-09")
    for k, order in enumerate(permutations([plain[:1], plain[1:], [telling]])):
        folder = tmp_path / f"files{k}"
        folder.mkdir()
        for name, part in zip("abc", order):
            (folder / f"{name}.csv").write_text("\n".join([header, *part]) + "\n")
        daily_load.run(spark, str(folder), str(tmp_path / "out"), "raw_dates", "wh_dates", date_pattern=None)
        assert {str(r.date) for r in spark.table("wh_dates").collect()} == {"2019-03-02", "2019-01-13"}
    with pytest.raises(AmbiguousDatesError):
        (tmp_path / "same.csv").write_text("\n".join([header, *plain]) + "\n")
        daily_load.run(spark, str(tmp_path / "same.csv"), str(tmp_path / "out"), "raw_dates", "wh_dates", date_pattern=None)
    assert spark.table("wh_dates").count() == 4


def test_decimals_of_numbers(spark):
    texts = {"1.50": 1, "10.500000000000002": 15, "7": 0, "100": 0, "1e-3": 3, "1.5e-3": 4, "2.50E+1": 0, "2.55e1": 1, "150e-1": 0, "100e-3": 1, "0e-9": 0, "0.000": 0, "-.5": 1, "5.": 0, " 1.25 ": 2}
    choose = random.Random(1)
    numbers = [f"{choose.randint(-9999, 9999)}{choose.choice(['', '.', '.0', '.5', '.250', '.0001'])}e{choose.randint(-4, 4)}" for _ in range(200)]
    texts |= {n: max(0, -Decimal(n).normalize().as_tuple().exponent) for n in numbers} | {"n.a.": None, "": None}
    found = spark.createDataFrame([(t,) for t in texts], "x string").select("x", decimals(F.col("x")).alias("n"))
    assert {r.x: r.n for r in found.collect()} == texts
    (row,) = decimals_needed(spark.createDataFrame([("1.25",), ("n.a.",), (None,), ("7.5",)], "x string"), ["x"]).collect()
    assert tuple(row) == ("x", 2)
    assert [tuple(r) for r in decimals_needed(spark.createDataFrame([], "x string, y string"), ["x", "y"]).collect()] == [("x", 0), ("y", 0)]


def test_scale_follows_the_numbers(spark, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text(changed("10.00,1,", "10.500000000000002,1,"))
    daily_load.run(spark, str(path), str(tmp_path / "out"), "raw_digits", "wh_digits", scale=None)
    assert spark.table("wh_digits").where("invoice_id = 'I-08'").first().unit_price == Decimal("10.500000000000002")
    path.write_text(GOLDEN)
    assert read_sales_csv(spark, str(path), scale=None).schema["total"].dataType.simpleString() == "decimal(18,4)"
    path.write_text(changed("10.00,1,", "1e-30,1,"))
    with pytest.raises(Exception, match="does not fit"):
        read_sales_csv(spark, str(path), scale=None).collect()


def test_reports_from_one_scan(spark, tmp_path):
    warehouse = QUERIES["load_warehouse"](spark, SF_DIR)
    odd = spark.createDataFrame([("x", None, None, None, None, None, None, None, None, None, None, None, None, None, None, None)], warehouse.schema)
    path = str(tmp_path / "warehouse")
    warehouse.unionByName(odd).write.parquet(path)
    for table in (spark.read.parquet(path), spark.read.parquet(path).where("false")):
        packed = reports.pack(table)
        plan = packed._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("FileScan") == plan.count("Expand") == 1 or table.isEmpty()
        single = reports.from_pack(packed.cache())
        for name, found in single.items():
            if name == "row_checks":
                profile = table_profile(table).first()
                assert found.first().row_count == profile.row_count == table.count()
                assert found.first().critical_null_rows == table.where("invoice_id is null or branch is null or product_line is null or total is null or date is null").count()
                assert found.first().not_positive_rows == table.where("total <= 0 or quantity <= 0").count()
            else:
                expected = getattr(reports, name)(table)
                assert found.columns == expected.columns and found.dtypes == expected.dtypes
                assert [tuple(r) for r in found.collect()] == [tuple(r) for r in expected.collect()], name

