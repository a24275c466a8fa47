"""Constraint counts, data quality checks and the gates that act on them."""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, GroupedData, Row
from pyspark.sql import functions as F

from tillbook.functions import sale_time
from tillbook.schema import CRITICAL, KEY, NOT_NULL


class ConstraintError(ValueError):
    """The rows to load break a constraint of the warehouse table."""


class QualityError(ValueError):
    """A data quality check failed."""


def _row_metrics() -> dict[str, Column]:
    any_null = reduce(or_, [F.col(c).isNull() for c in CRITICAL])
    return {
        "row_count": F.count(F.lit(1)),
        "critical_null_rows": F.count_if(any_null),
        "not_positive_rows": F.count_if((F.col("total") <= 0) | (F.col("quantity") <= 0)),
        "bad_time_rows": F.count_if(F.col("time").isNotNull() & sale_time(F.col("time")).isNull()),
        **{f"null_{c}": F.count_if(F.col(c).isNull()) for c in NOT_NULL},
    }


def row_profile(rows: DataFrame | GroupedData, *more: Column) -> DataFrame:
    """The counts over single rows, of all rows or by group."""
    return rows.agg(*more, *[metric.alias(n) for n, metric in _row_metrics().items()])


def _row_profile(df: DataFrame, names: list[str]) -> DataFrame:
    metrics = _row_metrics()
    return df.agg(*[metrics[n].alias(n) for n in names])


def _key_profile(df: DataFrame) -> DataFrame:
    """Keys that occur more than once, with NULL as a key and without. Partial counts cross the
    shuffle, so a frequent key is no burden."""
    repeated = df.groupBy(KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return repeated.agg(
        F.count(F.lit(1)).alias("duplicate_keys"),
        F.count(KEY).alias("duplicate_values"),
    )


def table_profile(df: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """One row with all counts that constraints and checks need.

    One scan counts rows without a shuffle, unless ``rows`` has these counts already, one scan of the key
    column finds duplicates. The results are laid over each other by a union and a sum.
    """
    rows = row_profile(df) if rows is None else rows
    keys = _key_profile(df)
    names = rows.columns + keys.columns

    def padded(part: DataFrame) -> DataFrame:
        return part.select(*[F.col(n) if n in part.columns else F.lit(0).cast("bigint").alias(n) for n in names])

    return padded(rows).union(padded(keys)).agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])


def constraint_violations(profile: DataFrame) -> DataFrame:
    """Violations of each constraint of the warehouse table."""
    counts = [("not_null", c, f"null_{c}") for c in NOT_NULL]
    counts += [("unique", KEY, "duplicate_values"), ("time_of_day", "time", "bad_time_rows")]
    rows = [
        F.struct(
            F.lit(kind).alias("constraint_name"),
            F.lit(column).alias("column_name"),
            F.col(count).alias("violations"),
        )
        for kind, column, count in counts
    ]
    return profile.select(F.inline(F.array(*rows)))


def enforce_constraints(violations: DataFrame) -> None:
    broken = [r.asDict() for r in violations.where("violations > 0").collect()]
    if broken:
        raise ConstraintError(f"load rejected: {broken}")


# Check id, name, observed count, and what the count must be.
def _checks() -> list[tuple[int, str, Column, Column]]:
    none = F.lit(0)
    rows, nulls = F.col("row_count"), F.col("critical_null_rows")
    keys, values = F.col("duplicate_keys"), F.col("not_positive_rows")
    return [
        (1, "not_empty", rows, rows > none),
        (2, "no_critical_nulls", nulls, nulls == none),
        (3, "unique_invoice_id", keys, keys == none),
        (4, "positive_values", values, values == none),
        (5, "branch_sample", rows, F.lit(True)),
    ]


def _check_row(check_id: int, name: str, observed: Column, passed: Column) -> Column:
    return F.struct(
        F.lit(check_id).alias("check_id"),
        F.lit(name).alias("check_name"),
        observed.alias("observed"),
        passed.alias("passed"),
    )


def _single_check(profile: DataFrame, check_id: int) -> DataFrame:
    return profile.select(_check_row(*_checks()[check_id - 1]).alias("check")).select("check.*")


def dq_not_empty(df: DataFrame) -> DataFrame:
    return _single_check(_row_profile(df, ["row_count"]), 1)


def dq_null_critical(df: DataFrame) -> DataFrame:
    return _single_check(_row_profile(df, ["critical_null_rows"]), 2)


def dq_duplicate_keys(df: DataFrame) -> DataFrame:
    return _single_check(_key_profile(df), 3)


def dq_positive_values(df: DataFrame) -> DataFrame:
    return _single_check(_row_profile(df, ["not_positive_rows"]), 4)


def dq_report(profile: DataFrame) -> DataFrame:
    """All checks; none is skipped when an earlier one fails. The branch sample always passes and
    reports the rows it covers."""
    return profile.select(F.inline(F.array(*[_check_row(*c) for c in _checks()])))


def enforce_checks(report: DataFrame) -> list[Row]:
    checks = report.orderBy("check_id").collect()
    failed = [f"{c.check_name} ({c.observed})" for c in checks if not c.passed]
    if failed:
        passed = len(checks) - len(failed)
        raise QualityError(f"{passed}/{len(checks)} checks passed, failed: {', '.join(failed)}")
    return checks
