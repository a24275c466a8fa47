from datetime import date
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tillbook.functions import average, exact_decimal, money, percentage, sale_date, sale_time, whole_number
from tillbook.plans import reports
from tillbook.schema import MONEY


MONEY_UNIT = Decimal("0.0001")


def values(spark, texts, expression):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, x string").withColumn("y", expression(F.col("x")))
    return [r.y for r in df.orderBy("i").collect()]


def test_dates_parse_as_pandas_does(spark):
    texts = [
        "1/5/2019", "12/31/2019", "01/05/2019", "2/29/2020", "2/29/2019", "2/30/2019", "13/01/2019", "0/1/2019",
        "1/0/2019", "1/32/2019", "1/5/2019 10:00", "2019-01-05", "Jan 5 2019", "1-5-2019", "abc", "", None,
        "10/10/2019", "9/9/1999",
    ]
    want = pd.to_datetime(pd.Series(texts), format="%m/%d/%Y", errors="coerce")
    got = values(spark, texts, lambda x: sale_date(x, "M/d/yyyy"))
    assert got == [None if pd.isna(w) else w.date() for w in want]


def test_date_pattern_is_a_parameter(spark):
    assert values(spark, ["13/01/2019", "2019"], lambda x: sale_date(x, "d/M/yyyy")) == [date(2019, 1, 13), None]


def test_times_are_normalised(spark):
    texts = ["13:08", "7:08", "13:08:09", "00:00", "23:59:59", "25:99", "12:60", "noon", "", None]
    want = ["13:08:00", "07:08:00", "13:08:09", "00:00:00", "23:59:59"] + [None] * 5
    assert values(spark, texts, sale_time) == want
    texts = ["8:59:00 PM", "01:08 PM", "12:00 am", "12:30 PM", "0:30 AM", "1:08pm", "13:08:09.5", "13:08:09.123456", "13:08:00.100", "24:00:00", "24:00"]
    texts += ["24:00:01", "13:08 PM", "8:60 PM", "13:08:09.x", "PM", " 7:08 "]
    want = ["20:59:00", "13:08:00", "00:00:00", "12:30:00", "00:30:00", "13:08:00", "13:08:09.5", "13:08:09.123456", "13:08:00.1", "24:00:00", "24:00:00"]
    want += [None] * 5 + ["07:08:00"]
    assert values(spark, texts, sale_time) == want
    assert values(spark, want, sale_time) == want


def test_numbers_that_do_not_parse_become_null(spark):
    texts = ["1.5", "-0.0001", "n.a.", "", None, "1e3", "99999999999999.9999"]
    want = [Decimal("1.5"), Decimal("-0.0001"), None, None, None, Decimal(1000), Decimal("99999999999999.9999")]
    assert values(spark, texts, lambda x: exact_decimal(x, MONEY, "x")) == want
    assert values(spark, ["7.5", "-7.5", "x", None, "2147483648"], whole_number) == [8, -8, None, None, None]
    fine = ["1.5000000000000000000000", "1e-4", "15e-1", "0.0e-30", "1.50E+1"]
    assert values(spark, fine, lambda x: exact_decimal(x, MONEY, "x")) == [Decimal(t).quantize(MONEY_UNIT) for t in fine]
    for text in ("0.00001", "100000000000000", "1.00000000000000000001", "1e-20", "1.00000000000000000001e0", "-0.0000000000000000000000001"):
        with pytest.raises(PySparkException, match="does not fit"):
            values(spark, [text], lambda x: exact_decimal(x, MONEY, "x"))


def test_rounding_is_half_away_from_zero(spark):
    texts = ["2.345", "-2.345", "2.3449", "0.005", "-0.005"]
    want = [Decimal(v) for v in ("2.35", "-2.35", "2.34", "0.01", "-0.01")]
    for rounded in (money, lambda x: average(x, F.lit(1))):
        assert values(spark, texts, lambda x: rounded(x.cast("decimal(18,4)"))) == want


def test_averages_are_rounded_once(spark):
    def mean(data):
        df = spark.createDataFrame([(x and Decimal(x),) for x in data], "x decimal(18,4)")
        return df.agg(average(F.sum("x"), F.count("x"))).first()[0]

    assert mean(["1.0050"] * 29_999 + ["1.0049"]) == Decimal("1.00")
    assert mean(["-1.0050"] * 29_999 + ["-1.0049"]) == Decimal("-1.00")
    assert mean(["1.0050"] * 3) == Decimal("1.01") and mean(["-1.0050"] * 3) == Decimal("-1.01")
    assert mean([None, "2.0000"]) == Decimal("2.00") and mean([None]) is None and mean([]) is None
    assert mean(["99999999999999.9999"] * 5) == Decimal("100000000000000.00")


def test_reports_average_large_groups_exactly(spark):
    """Groups just below a half cent, as one row more or less of a ten-thousandth decides."""
    rows = spark.range(60_000).selectExpr(
        "case when id % 2 = 0 then 'A' else 'B' end as branch", "'c' as city", "'m' as customer_type", "'g' as gender", "'p' as product_line",
        "cast(case when id = 0 then 1.0049 else 1.0050 end as decimal(18,4)) as total",
        "cast(case when id = 1 then 1.0049 else 1.0050 end as decimal(18,4)) as rating",
    )
    by_branch = {r.branch: r.avg_revenue_per_transaction for r in reports.revenue_by_branch_city(rows).collect()}
    assert by_branch == {"A": Decimal("1.00"), "B": Decimal("1.01")}
    assert reports.top_product_lines(rows).first().avg_rating == Decimal("1.00")
    assert reports.customer_segment_spend(rows).first().avg_spent == Decimal("1.00")


def test_percentage(spark):
    rows = spark.createDataFrame([(1, 3), (2, 3), (1, 8), (0, 5), (5, 0)], "part bigint, whole bigint")
    got = [r[0] for r in rows.select(percentage(F.col("part"), F.col("whole"))).collect()]
    assert got == [Decimal("33.33"), Decimal("66.67"), Decimal("12.50"), Decimal("0.00"), None]


def test_sums_of_very_large_tables_fit(spark):
    row = spark.createDataFrame([(Decimal("99999999999999.9999"),)], "x decimal(18,4)")
    total = row.select((F.sum("x") * 10**9).cast("decimal(28,4)").alias("x")).select(money(F.col("x"))).first()[0]
    assert total == Decimal("99999999999999999900000.00")
