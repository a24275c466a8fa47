"""Cleaning steps of the sales table and the account of what they remove.

The order of the steps matters and is kept: duplicates go first, so an invoice whose first row
is bad is lost even when a later row of it is good.
"""

from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillbook.functions import exact_decimal, percentage, sale_date, whole_number
from tillbook.schema import CONSTANT_COLUMN, CRITICAL, KEY, MONEY, ORDER_PREFIX, order_columns

DATE_PATTERN = "M/d/yyyy"
FLAGS = "_flags"


def _order(df: DataFrame) -> list[str]:
    order = order_columns(df)
    if not order:
        raise ValueError(f"no {ORDER_PREFIX}* columns: which row of a key is first is undefined")
    return order


def keep_first(df: DataFrame, key: str = KEY) -> DataFrame:
    """First row of each key; NULL keys count as one key.

    Catalyst turns ``rank == 1`` into a group limit ahead of the shuffle, so each input partition
    sends at most one row per key however often the key occurs.
    """
    first = Window.partitionBy(key).orderBy(*_order(df))
    return df.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")


def drop_critical_nulls(df: DataFrame) -> DataFrame:
    return df.where(reduce(and_, [F.col(c).isNotNull() for c in CRITICAL]))


def positive_filter(df: DataFrame) -> DataFrame:
    """Rows with a positive quantity and total; a NULL quantity fails the test too."""
    return df.where("quantity > 0 AND total > 0")


def coerce_types(df: DataFrame, date_pattern: str = DATE_PATTERN) -> DataFrame:
    """Date text to dates and number text to numbers; what does not parse becomes NULL."""
    types = dict(df.dtypes)
    changes = {}
    if types["date"] == "string":
        changes["date"] = sale_date(F.col("date"), date_pattern)
    for name in ("unit_price", "total"):
        if types[name] == "string":
            changes[name] = exact_decimal(F.col(name), MONEY, name)
    if types["quantity"] == "string":
        changes["quantity"] = whole_number(F.col("quantity"))
    return df.withColumns(changes) if changes else df


def drop_constant_column(df: DataFrame) -> DataFrame:
    return df.drop(CONSTANT_COLUMN)


def clean_sales(raw: DataFrame, date_pattern: str = DATE_PATTERN) -> DataFrame:
    order = _order(raw)
    return (
        raw.transform(keep_first)
        .transform(drop_critical_nulls)
        .transform(positive_filter)
        .transform(coerce_types, date_pattern)
        .transform(drop_constant_column)
        .drop(*order)
    )


def _flag_values() -> dict[str, Column]:
    """What can be wrong with a row; a row without any of these is clean."""
    return {f"null_{c}": F.col(c).isNull() for c in CRITICAL} | {
        "quantity_bad": F.col("quantity") <= 0,
        "total_bad": F.col("total") <= 0,
        "quantity_null": F.col("quantity").isNull(),
    }


def with_flags(df: DataFrame) -> DataFrame:
    """Add ``_flags``, one bit for each thing that is wrong; 0 for rows that cleaning keeps."""
    bits = [F.when(bad, 1 << i).otherwise(0) for i, bad in enumerate(_flag_values().values())]
    return df.withColumn(FLAGS, reduce(add, bits))


def cleaning_audit(flag_counts: DataFrame, rows_before: Column) -> DataFrame:
    """One row with every count the cleaning steps report.

    ``flag_counts`` holds ``_flags`` and ``n``, the number of rows with them that are left after
    removing duplicates; ``rows_before`` is an aggregate over it that gives the raw row count.
    """
    names = list(_flag_values())

    def has(*wanted):
        return F.col(FLAGS).bitwiseAND(sum(1 << names.index(w) for w in wanted)) != 0

    def rows(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("n")).otherwise(0)), F.lit(0))

    nulls = [f"null_{c}" for c in CRITICAL]
    complete = ~has(*nulls)
    bad_value = has("quantity_bad", "total_bad")
    left = rows(F.lit(True))
    return (
        flag_counts.agg(
            F.coalesce(rows_before, F.lit(0)).alias("rows_before"),
            left.alias("_left"),
            *[rows(has(name)).alias(name) for name in nulls],
            rows(~complete).alias("critical_null_rows"),
            rows(complete & has("quantity_bad")).alias("invalid_quantity"),
            rows(complete & has("total_bad")).alias("invalid_total"),
            rows(complete & bad_value).alias("bad_value_rows"),
            rows(complete & ~bad_value & has("quantity_null")).alias("null_quantity_rows"),
            rows(F.col(FLAGS) == 0).alias("rows_after"),
        )
        .withColumn("duplicate_rows", F.col("rows_before") - F.col("_left"))
        .withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))
        .drop("_left")
    )


def audit_of_raw(raw: DataFrame) -> DataFrame:
    """The audit of raw sales that are not going to be stored.

    One scan and one shuffle: a row is reduced to its flags, and of each key only the first row's
    flags and the number of rows leave a partition.
    """
    per_key = (
        with_flags(raw)
        .groupBy(KEY)
        .agg(F.min_by(FLAGS, F.struct(*_order(raw))).alias(FLAGS), F.count(F.lit(1)).alias("rows"))
    )
    flag_counts = per_key.groupBy(FLAGS).agg(F.count(F.lit(1)).alias("n"), F.sum("rows").alias("rows"))
    return cleaning_audit(flag_counts, F.sum("rows"))


def duplicate_count(raw: DataFrame) -> DataFrame:
    """Rows beyond the first of each key. Rows are counted per key before the shuffle."""
    return (
        raw.groupBy(KEY)
        .agg((F.count(F.lit(1)) - 1).alias("extra"))
        .agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("duplicate_count"))
    )


def critical_null_profile(audit: DataFrame) -> DataFrame:
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"null_{c}").alias("null_count"))
        for c in CRITICAL
    ]
    return audit.select(F.inline(F.array(*rows)))


def invalid_value_counts(audit: DataFrame) -> DataFrame:
    return audit.select("invalid_quantity", "invalid_total")


def clean_summary(audit: DataFrame) -> DataFrame:
    share = percentage(F.col("rows_after"), F.col("rows_before"), digits=1)
    return audit.select(
        "rows_before",
        "rows_removed",
        "rows_after",
        F.coalesce(share, F.lit(0)).cast("decimal(18,2)").alias("clean_pct"),
    )


def removed_by_reason(audit: DataFrame) -> DataFrame:
    """Why rows were removed, counted in two ways.

    ``reported``: the counts each step reports, in which a row can occur twice or not at all.
    ``removed``: every removed row once, under the first step that removes it.
    """
    columns = {
        ("reported", "duplicate"): "duplicate_rows",
        ("reported", "critical_null"): "critical_null_rows",
        ("reported", "quantity_not_positive"): "invalid_quantity",
        ("reported", "total_not_positive"): "invalid_total",
        ("removed", "duplicate"): "duplicate_rows",
        ("removed", "critical_null"): "critical_null_rows",
        ("removed", "value_not_positive"): "bad_value_rows",
        ("removed", "quantity_null"): "null_quantity_rows",
    }
    rows = [
        F.struct(F.lit(kind).alias("counted"), F.lit(reason).alias("reason"), F.col(c).alias("row_count"))
        for (kind, reason), c in columns.items()
    ]
    return audit.select(F.inline(F.array(*rows)))
