"""Reports on the warehouse table.

Orders follow the reports' original database: NULLs first when descending, last when ascending.
A last sort key makes results with equal values repeatable.
"""

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillbook.functions import average, money, percentage
from tillbook.schema import CRITICAL, RAW_TABLE, WAREHOUSE_COLUMNS, WAREHOUSE_TABLE


def _rows():
    return F.count(F.lit(1))


def row_count(table: DataFrame) -> DataFrame:
    return table.agg(_rows().alias("row_count"))


def row_count_audit(raw: DataFrame, warehouse: DataFrame) -> DataFrame:
    def named(name, table):
        return row_count(table).select(F.lit(name).alias("table_name"), "row_count")

    return named(RAW_TABLE, raw).union(named(WAREHOUSE_TABLE, warehouse))


def warehouse_preview(warehouse: DataFrame) -> DataFrame:
    return warehouse.select(*WAREHOUSE_COLUMNS).orderBy("invoice_id").limit(5)


def revenue_by_branch_city(warehouse: DataFrame) -> DataFrame:
    return (
        warehouse.groupBy("branch", "city")
        .agg(
            _rows().alias("total_transactions"),
            money(F.sum("total")).alias("total_revenue"),
            average(F.sum("total"), F.count("total")).alias("avg_revenue_per_transaction"),
        )
        .orderBy(F.desc_nulls_first("total_revenue"), "branch", "city")
    )


def top_product_lines(warehouse: DataFrame) -> DataFrame:
    """``total_sold`` counts transactions, not units."""
    return (
        warehouse.groupBy("product_line")
        .agg(
            _rows().alias("total_sold"),
            money(F.sum("total")).alias("total_revenue"),
            average(F.sum("rating"), F.count("rating")).alias("avg_rating"),
        )
        .orderBy(F.desc_nulls_first("total_revenue"), "product_line")
        .limit(5)
    )


def customer_segment_spend(warehouse: DataFrame) -> DataFrame:
    return (
        warehouse.groupBy("customer_type", "gender")
        .agg(
            _rows().alias("total_transactions"),
            money(F.sum("total")).alias("total_spent"),
            average(F.sum("total"), F.count("total")).alias("avg_spent"),
        )
        .orderBy(F.desc_nulls_first("total_spent"), "customer_type", "gender")
    )


def payment_mix(warehouse: DataFrame) -> DataFrame:
    """The window has no partition, but sees one row per payment method only."""
    everything = F.sum("total_transactions").over(Window.partitionBy())
    return (
        warehouse.groupBy("payment")
        .agg(_rows().alias("total_transactions"), money(F.sum("total")).alias("total_revenue"))
        .withColumn("percentage", percentage(F.col("total_transactions"), everything))
        .orderBy(F.desc_nulls_first("total_revenue"), "payment")
    )


def monthly_revenue(warehouse: DataFrame) -> DataFrame:
    """Grouped on the first day of the month; only the few result rows are formatted as text."""
    return (
        warehouse.groupBy(F.trunc("date", "month").alias("first_day"))
        .agg(_rows().alias("total_transactions"), money(F.sum("total")).alias("monthly_revenue"))
        .select(F.date_format("first_day", "yyyy-MM").alias("month"), "total_transactions", "monthly_revenue")
        .orderBy(F.asc_nulls_last("month"))
    )


def top_transactions(warehouse: DataFrame) -> DataFrame:
    return (
        warehouse.select("invoice_id", "branch", "product_line", "quantity", "total", "date")
        .orderBy(F.desc_nulls_first("total"), "invoice_id")
        .limit(10)
    )


def null_profile(warehouse: DataFrame) -> DataFrame:
    return warehouse.agg(
        _rows().alias("total_rows"),
        *[
            (_rows() - F.count(c)).alias(f"null_{c}")
            for c in ("invoice_id", "branch", "total", "date")
        ],
    )

def branch_revenue_sample(warehouse: DataFrame) -> DataFrame:
    return (
        warehouse.groupBy("branch")
        .agg(_rows().alias("total_transactions"), money(F.sum("total")).alias("total_revenue"))
        .orderBy(F.asc_nulls_last("branch"))
    )


# The reports of the pack: the keys they group by.
_GROUPED = {
    "revenue_by_branch_city": ["branch", "city"], "top_product_lines": ["product_line"], "customer_segment_spend": ["customer_type", "gender"],
    "payment_mix": ["payment"], "monthly_revenue": ["first_day"], "branch_revenue_sample": ["branch"], "null_profile": [],
}


def pack(warehouse: DataFrame) -> DataFrame:
    """What all grouped reports and the checks of single rows need, in one scan and one aggregate: a row per report and
    group, with the report's name, its keys, and sums and counts. See ``from_pack``.

    Every row is expanded to one for each set of keys, and summed up before the shuffle.
    """
    rows = warehouse.withColumn("first_day", F.trunc("date", "month"))
    keys = list(dict.fromkeys(k for columns in _GROUPED.values() for k in columns))
    incomplete = reduce(or_, [F.col(c).isNull() for c in CRITICAL])
    # the keys are needed as values too, where the expansion makes them NULL
    values = rows.select(
        *keys, "total", "rating", *[F.col(c).isNull().cast("int").alias(f"no_{c}") for c in ("invoice_id", "branch", "total", "date")],
        incomplete.cast("int").alias("incomplete"), F.coalesce((F.col("total") <= 0) | (F.col("quantity") <= 0), F.lit(False)).cast("int").alias("not_positive"),
    )
    grouped = values.groupingSets([[F.col(k) for k in columns] for columns in _GROUPED.values()], *[F.col(k) for k in keys])
    summed = grouped.agg(
        F.grouping_id().alias("set"), _rows().alias("rows"), F.sum("total").alias("total"), F.count("total").alias("totals"), F.sum("rating").alias("rating"),
        F.count("rating").alias("ratings"), *[F.sum(c).alias(c) for c in ("no_invoice_id", "no_branch", "no_total", "no_date", "incomplete", "not_positive")],
    )
    # a set's number has a bit for each key that it leaves out, the first key's the highest
    number = {name: sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in columns) for name, columns in _GROUPED.items()}
    name = reduce(lambda known, item: known.when(F.col("set") == item[1], item[0]), number.items(), F.when(F.lit(False), ""))
    return summed.select(name.alias("report"), *keys, *[c for c in summed.columns if c not in ("set", *keys)])


def from_pack(packed: DataFrame) -> dict[str, DataFrame]:
    """The single reports, and the checks of single rows, out of a pack; row for row what they are on the table."""

    def of(name: str) -> DataFrame:
        return packed.where(F.col("report") == name)

    revenue, totals = money(F.col("total")), average(F.col("total"), F.col("totals"))
    segments, lines, mix, everything = (of(n) for n in ("customer_segment_spend", "top_product_lines", "payment_mix", "null_profile"))
    # an aggregate of no rows is one row of counts, where a set of no keys has none
    whole = everything.agg(*[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in ("rows", "no_invoice_id", "no_branch", "no_total", "no_date", "incomplete", "not_positive")])
    return {
        "revenue_by_branch_city": of("revenue_by_branch_city").select(
            "branch", "city", F.col("rows").alias("total_transactions"), revenue.alias("total_revenue"), totals.alias("avg_revenue_per_transaction")
        ).orderBy(F.desc_nulls_first("total_revenue"), "branch", "city"),
        "top_product_lines": lines.select(
            "product_line", F.col("rows").alias("total_sold"), revenue.alias("total_revenue"), average(F.col("rating"), F.col("ratings")).alias("avg_rating")
        ).orderBy(F.desc_nulls_first("total_revenue"), "product_line").limit(5),
        "customer_segment_spend": segments.select(
            "customer_type", "gender", F.col("rows").alias("total_transactions"), revenue.alias("total_spent"), totals.alias("avg_spent")
        ).orderBy(F.desc_nulls_first("total_spent"), "customer_type", "gender"),
        "payment_mix": mix.select("payment", F.col("rows").alias("total_transactions"), revenue.alias("total_revenue"))
        .withColumn("percentage", percentage(F.col("total_transactions"), F.sum("total_transactions").over(Window.partitionBy())))
        .orderBy(F.desc_nulls_first("total_revenue"), "payment"),
        "monthly_revenue": of("monthly_revenue").select(
            F.date_format("first_day", "yyyy-MM").alias("month"), F.col("rows").alias("total_transactions"), revenue.alias("monthly_revenue")
        ).orderBy(F.asc_nulls_last("month")),
        "branch_revenue_sample": of("branch_revenue_sample").select(
            "branch", F.col("rows").alias("total_transactions"), revenue.alias("total_revenue")
        ).orderBy(F.asc_nulls_last("branch")),
        "null_profile": whole.select(F.col("rows").alias("total_rows"), *[F.col(f"no_{c}").alias(f"null_{c}") for c in ("invoice_id", "branch", "total", "date")]),
        "row_checks": whole.select(F.col("rows").alias("row_count"), F.col("incomplete").alias("critical_null_rows"), F.col("not_positive").alias("not_positive_rows")),
    }
