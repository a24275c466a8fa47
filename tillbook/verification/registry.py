"""Every operator and report as a query over the star-schema test tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.functions import date_evidence, decimals_needed, money
from tillbook.functions.evidence import DATE_PATTERNS
from tillbook.operators import cleaning, quality
from tillbook.plans import daily_load, reports
from tillbook.schema import CRITICAL, KEY, RAW_COLUMNS, RAW_SCHEMA, WAREHOUSE_COLUMNS
from tillbook.sources.csv_source import normalize_headers, source_profile
from tillbook.sources.tables import read_staged, shared_root, stage
from tillbook.verification.star import bad_dates, bad_times, missing_values, number_texts, raw_sales

Query = Callable[[SparkSession, str], DataFrame]

# Headings as a source file may spell them, in raw column order.
SOURCE_HEADINGS = [
    "Invoice ID", "Branch", " City ", "Customer type", "Gender", "Product line", "Unit price", "Quantity",
    "Tax 5 %", "Total", "Date", "Time", "Payment", "cogs", "gross-margin-percentage", "gross income", "Rating",
]


def _without_order(df: DataFrame) -> DataFrame:
    return df.select(*RAW_COLUMNS)


def _warehouse(spark, sf_dir):
    return daily_load.warehouse_rows(cleaning.clean_sales(raw_sales(spark, sf_dir)))


def _audit(spark, sf_dir):
    return cleaning.audit_of_raw(raw_sales(spark, sf_dir, [*CRITICAL, "quantity"]))


def _stored(df, name):
    """Write a derived table once, where a query has to scan it more than once."""
    spark = df.sparkSession
    return read_staged(spark, stage(df, shared_root(spark), name), df.schema)


def _on_warehouse(report) -> Query:
    return lambda spark, sf_dir: report(_warehouse(spark, sf_dir))


def _on_audit(view) -> Query:
    return lambda spark, sf_dir: view(_audit(spark, sf_dir))


def _on_both(check, columns) -> Query:
    """A check on the uncleaned and on the cleaned sales; only the former can fail."""

    def query(spark, sf_dir):
        def named(name, df):
            return check(df).select(F.lit(name).alias("table_name"), "*")

        raw = named("raw", raw_sales(spark, sf_dir, columns))
        return raw.union(named("warehouse", _warehouse(spark, sf_dir)))

    return query


def _source_profile(spark, sf_dir):
    return source_profile(raw_sales(spark, sf_dir))


def _raw_load(spark, sf_dir):
    return _without_order(daily_load.load_raw(raw_sales(spark, sf_dir), shared_root(spark)).rows)


def _load_warehouse(spark, sf_dir):
    load = daily_load.refresh(raw_sales(spark, sf_dir), shared_root(spark))
    return load.warehouse.rows.select(*WAREHOUSE_COLUMNS)


def _load_reconciliation(spark, sf_dir):
    return daily_load.refresh(raw_sales(spark, sf_dir), shared_root(spark)).metrics


def _normalize_headers(spark, sf_dir):
    source = _without_order(raw_sales(spark, sf_dir)).toDF(*SOURCE_HEADINGS)
    return source.toDF(*normalize_headers(source.columns))


def _deduplicated(spark, sf_dir):
    return cleaning.keep_first(raw_sales(spark, sf_dir))


def _complete(spark, sf_dir):
    return cleaning.drop_critical_nulls(_deduplicated(spark, sf_dir))


def _coerce_dates(spark, sf_dir):
    sales = raw_sales(spark, sf_dir, [KEY, "date", "unit_price", "quantity", "total"], bad_dates())
    return cleaning.coerce_types(sales).select(KEY, "date")


def _coerce_numerics(spark, sf_dir):
    columns = [KEY, "date", "unit_price", "quantity", "total"]
    sales = raw_sales(spark, sf_dir, columns, number_texts())
    return cleaning.coerce_types(sales).select(KEY, "unit_price", "quantity", "total")


def _constraint_violations(spark, sf_dir):
    sales = raw_sales(spark, sf_dir, variant=bad_dates() | bad_times() | missing_values())
    stored = _stored(cleaning.coerce_types(sales), "unclean")
    return quality.constraint_violations(quality.table_profile(stored))


def _dq_report(spark, sf_dir):
    load = daily_load.refresh(raw_sales(spark, sf_dir), shared_root(spark))
    reports_by_table = [
        quality.dq_report(profile).select(F.lit(name).alias("table_name"), "*")
        for name, profile in [
            ("raw", quality.table_profile(load.raw.rows)),
            ("warehouse", load.warehouse.profile),
        ]
    ]
    return reports_by_table[0].union(reports_by_table[1])


def _date_pattern_evidence(spark, sf_dir):
    return date_evidence(raw_sales(spark, sf_dir, ["date"], bad_dates()), patterns=DATE_PATTERNS[:6])


def _decimals_needed(spark, sf_dir):
    numbers = [f.name for f in RAW_SCHEMA if isinstance(f.dataType, T.DecimalType)]
    return decimals_needed(raw_sales(spark, sf_dir, numbers), numbers)


def _report_pack(spark, sf_dir):
    packed = reports.pack(_warehouse(spark, sf_dir))
    month = F.date_format("first_day", "yyyy-MM").alias("month")
    return packed.select("*", month).drop("first_day").withColumn("total", money(F.col("total"))).withColumn("rating", money(F.col("rating")))


QUERIES: dict[str, Query] = {
    "source_profile": _source_profile,
    "raw_load": _raw_load,
    "raw_row_count": lambda spark, sf_dir: reports.row_count(raw_sales(spark, sf_dir, [KEY])),
    "warehouse_row_count": _on_warehouse(reports.row_count),
    "warehouse_preview": _on_warehouse(reports.warehouse_preview),
    "load_warehouse": _load_warehouse,
    "constraint_violations": _constraint_violations,
    "normalize_headers": _normalize_headers,
    "dedup_keep_first": lambda spark, sf_dir: _without_order(_deduplicated(spark, sf_dir)),
    "duplicate_count": lambda spark, sf_dir: cleaning.duplicate_count(raw_sales(spark, sf_dir, [KEY])),
    "critical_null_profile": _on_audit(cleaning.critical_null_profile),
    "drop_critical_nulls": lambda spark, sf_dir: _without_order(_complete(spark, sf_dir)),
    "invalid_value_counts": _on_audit(cleaning.invalid_value_counts),
    "positive_filter": lambda spark, sf_dir: _without_order(cleaning.positive_filter(_complete(spark, sf_dir))),
    "coerce_dates": _coerce_dates,
    "coerce_numerics": _coerce_numerics,
    "drop_constant_column": lambda spark, sf_dir: cleaning.drop_constant_column(
        _without_order(raw_sales(spark, sf_dir))
    ),
    "clean_sales": lambda spark, sf_dir: cleaning.clean_sales(raw_sales(spark, sf_dir)),
    "clean_summary": _on_audit(cleaning.clean_summary),
    "removed_by_reason": _on_audit(cleaning.removed_by_reason),
    "row_count_audit": lambda spark, sf_dir: reports.row_count_audit(
        raw_sales(spark, sf_dir, [KEY]), _warehouse(spark, sf_dir)
    ),
    "revenue_by_branch_city": _on_warehouse(reports.revenue_by_branch_city),
    "top_product_lines": _on_warehouse(reports.top_product_lines),
    "customer_segment_spend": _on_warehouse(reports.customer_segment_spend),
    "payment_mix": _on_warehouse(reports.payment_mix),
    "monthly_revenue": _on_warehouse(reports.monthly_revenue),
    "top_transactions": _on_warehouse(reports.top_transactions),
    "null_profile": _on_warehouse(reports.null_profile),
    "dq_not_empty": _on_both(quality.dq_not_empty, [KEY]),
    "dq_null_critical": _on_both(quality.dq_null_critical, CRITICAL),
    "dq_duplicate_keys": _on_both(quality.dq_duplicate_keys, [KEY]),
    "dq_positive_values": _on_both(quality.dq_positive_values, ["total", "quantity"]),
    "branch_revenue_sample": _on_warehouse(reports.branch_revenue_sample),
    "dq_report": _dq_report,
    "load_reconciliation": _load_reconciliation,
    "date_pattern_evidence": _date_pattern_evidence,
    "decimals_needed": _decimals_needed,
    "report_pack": _report_pack,
}
