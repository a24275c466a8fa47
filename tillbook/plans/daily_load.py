"""The daily full refresh: source file, raw table, cleaning, warehouse table, quality gate.

Every table is written to a new folder, checked there, and published last. Counts come from what
was written, so a lost executor cannot falsify them.
"""

import logging
import time
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.functions import date_pattern_of, sale_time
from tillbook.operators import quality
from tillbook.operators.cleaning import (
    DATE_PATTERN, FLAGS, cleaning_audit, coerce_types, drop_constant_column, keep_first, with_flags,
)
from tillbook.plans.reports import branch_revenue_sample, row_count
from tillbook.schema import (
    CRITICAL, KEY, RAW_COLUMNS, RAW_TABLE, ROUNDED, SCALE, WAREHOUSE_COLUMNS, WAREHOUSE_SCHEMA, WAREHOUSE_TABLE, order_columns, with_scale,
)
from tillbook.sizing import sized_for
from tillbook.sources.csv_source import read_sales_csv, rounded_counts, source_bytes, to_raw
from tillbook.sources.tables import (
    drop_staged, forget_versions, new_version, old_versions, publish_together, read_staged, remove_old_versions, remove_version, stage,
    stage_by_key,
)

log = logging.getLogger(__name__)

_REJECTED = "rejected"


@dataclass
class RawLoad:
    path: str
    schema: T.StructType
    rows: DataFrame
    rounded: dict[str, int]  # rows per column, if rounding was asked for


@dataclass
class WarehouseLoad:
    path: str
    schema: T.StructType
    rows: DataFrame
    audit: DataFrame  # one local row, see cleaning.cleaning_audit
    profile: DataFrame  # one local row, see quality.table_profile


@dataclass
class Refresh:
    raw: RawLoad
    warehouse: WarehouseLoad
    metrics: DataFrame  # one local row, row counts of the stages


@dataclass
class LoadResult:
    metrics: Row
    audit: Row
    checks: list[Row]
    branch_sample: DataFrame
    raw_path: str
    warehouse_path: str


@contextmanager
def _timed(step: str):
    start = time.monotonic()
    yield
    log.info("%s took %.2f s", step, time.monotonic() - start)


def _one_row(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    return spark.range(1).select(*[F.lit(n).cast("bigint").alias(name) for name, n in counts.items()])


def _computed(one_row: DataFrame) -> DataFrame:
    """Run a one-row aggregate of counts now, so that later uses do not run it again."""
    return _one_row(one_row.sparkSession, one_row.first().asDict())


def _warehouse_schema(rows: DataFrame) -> T.StructType:
    """The warehouse's columns with the number of decimals that the rows' totals have."""
    return with_scale(WAREHOUSE_SCHEMA, rows.schema["total"].dataType.scale)


def warehouse_rows(clean: DataFrame, *extra: str) -> DataFrame:
    """Cleaned sales in warehouse columns. A time that does not parse is left as it is, for the
    constraint check to find."""
    time_of_day = F.coalesce(sale_time(F.col("time")), F.col("time"))
    types = {f.name: f.dataType for f in _warehouse_schema(clean)}
    return clean.withColumn("time", time_of_day).select(
        *[F.col(c).cast(types[c]).alias(c) for c in WAREHOUSE_COLUMNS], *extra
    )


def load_raw(df: DataFrame, root: str, version: str | None = None) -> RawLoad:
    """Write raw sales, with the columns that keep their order, and read them back.

    Sales that ``to_raw`` has not typed yet get the default number of decimals.
    """
    raw = df if ROUNDED in df.columns else to_raw(df, _scale(df))
    names = [*RAW_COLUMNS, *order_columns(raw), *[c for c in raw.columns if c == ROUNDED]]
    schema = T.StructType([T.StructField(n, raw.schema[n].dataType) for n in names])
    path = stage(raw.select(*names), root, "raw", version=version)
    rows = read_staged(df.sparkSession, path, schema)
    return RawLoad(path, schema, rows, rounded_counts(rows).first().asDict() if ROUNDED in names else {})


def _scale(df: DataFrame) -> int:
    given = next((f.dataType for f in df.schema if f.name == "total"), None)
    known = isinstance(given, T.DecimalType) and given.precision == 14 + given.scale and given.scale >= 2
    return given.scale if known else SCALE


def load_warehouse(
    raw: DataFrame, root: str, date_pattern: str = DATE_PATTERN, version: str | None = None, buckets: int | None = None
) -> WarehouseLoad:
    """Clean raw sales into a new version of the warehouse table, in one pass over them.

    The rows that cleaning rejects are written too, in a folder beside the clean ones, with flags
    for what is wrong. The counts that cleaning reports then follow from what was written; only
    duplicates are not written, and are the difference to the raw row count. The constraints are
    checked on the written rows as well. A version that breaks one is never published.

    With ``buckets``, the rows are stored by the hash of the key, in as many files of each kind. Then checks of the
    key and joins by it need no shuffle.
    """
    version = version or new_version()
    first = raw.transform(keep_first).transform(with_flags)
    judged = first.transform(coerce_types, date_pattern).transform(drop_constant_column)
    stamped = (
        warehouse_rows(judged, FLAGS)
        .withColumn("loaded_at", F.current_timestamp().cast("timestamp_ntz"))
        .withColumn(_REJECTED, F.col(FLAGS) != 0)
    )
    schema = _warehouse_schema(raw)
    kinds = [*schema.fieldNames(), FLAGS, _REJECTED]
    # both kinds of rows stay open, so that the rows need no sort by kind
    if buckets:
        path, table = stage_by_key(stamped, root, "warehouse", KEY, buckets, _REJECTED, version=version, writers=2)
        written = raw.sparkSession.table(table).select(*kinds)
    else:
        path, table = stage(stamped, root, "warehouse", _REJECTED, version=version, writers=2), None
        written = read_staged(raw.sparkSession, path, T.StructType([*schema.fields, stamped.schema[FLAGS], stamped.schema[_REJECTED]]))

    # one scan for what cleaning reports and for the constraints of single rows
    by_flags = quality.row_profile(written.groupBy(FLAGS), F.count(F.lit(1)).alias("n"))
    by_flags = raw.sparkSession.createDataFrame(by_flags.toArrow(), by_flags.schema)  # a local relation
    flag_counts = by_flags.select(FLAGS, "n")
    audit = _computed(cleaning_audit(flag_counts, F.max(F.lit(row_count(raw).first().row_count))))
    counts = audit.first().asDict()
    log.info("cleaning: %s", counts)
    for column in CRITICAL:
        if counts[f"null_{column}"]:
            log.warning("column %s: %d rows without a value", column, counts[f"null_{column}"])

    rows = written.where(~F.col(_REJECTED)).select(*WAREHOUSE_SCHEMA.fieldNames())
    clean = by_flags.where(f"{FLAGS} = 0").drop(FLAGS, "n")
    profile = _computed(quality.table_profile(rows, clean))
    quality.enforce_constraints(quality.constraint_violations(profile))
    if table:
        drop_staged(raw.sparkSession, table)
        rows = read_staged(raw.sparkSession, f"{path}/{_REJECTED}=false", schema)
    return WarehouseLoad(f"{path}/{_REJECTED}=false", schema, rows, audit, profile)


def refresh(
    raw_sales: DataFrame, root: str, date_pattern: str | None = DATE_PATTERN, version: str | None = None, buckets: int | None = None
) -> Refresh:
    """Write new versions of the raw and the warehouse table, with their row counts side by side. Without a date
    pattern it is taken from the dates, see ``date_pattern_of``."""
    with _timed("raw load"):
        raw = load_raw(raw_sales, root, version)
    if date_pattern is None:
        date_pattern = date_pattern_of(raw.rows)
        log.info("dates are written %s", date_pattern)
    with _timed("cleaning and warehouse load"):
        warehouse = load_warehouse(raw.rows, root, date_pattern, version, buckets)
    audit = warehouse.audit.first()
    counts = {
        "raw_row_count": audit.rows_before,
        "clean_row_count": audit.rows_after,
        "removed_row_count": audit.rows_removed,
        "warehouse_row_count": warehouse.profile.first().row_count,
        **raw.rounded,
    }
    log.info("rows: %s", counts)
    return Refresh(raw, warehouse, _one_row(raw_sales.sparkSession, counts))


def run(
    spark: SparkSession,
    source: str,
    root: str,
    raw_table: str = RAW_TABLE,
    warehouse_table: str = WAREHOUSE_TABLE,
    multi_line: bool = False,
    date_pattern: str | None = DATE_PATTERN,
    encoding: str = "UTF-8",
    scale: int | None = SCALE,
    round_digits: bool = False,
    growth: float = 1.0,
    keep: int | None = 2,
    replace_definition: bool = False,
    buckets: int | None = None,
) -> LoadResult:
    """One full refresh from CSV; raises without publishing anything when the data is rejected.

    ``root`` is a folder that all executors share, used by one load at a time. ``encoding``, ``scale`` and
    ``round_digits``: see ``read_sales_csv``. ``date_pattern`` and ``scale`` of None: as the data need. ``growth``: how much larger the source is than its files,
    say 5 for gzip; the session's partition settings follow it while the load runs. ``keep``: versions of
    each table that stay, the published one included; the folders of a rejected load go. None keeps
    everything. ``replace_definition``: see ``publish_together``.
    ``buckets``: see ``load_warehouse``; as many as the shuffle has partitions are best.

    Both tables are published by one catalog change, see ``publish_together``: whenever a load ends, they
    are both as before or both new.
    """
    n_bytes = source_bytes(spark, source)
    version, published = new_version(), False
    with sized_for(spark, n_bytes, growth):
        try:
            sales = read_sales_csv(spark, source, multi_line, encoding, scale, round_digits)
            log.info("source %s: %.2f KB, columns %s", source, n_bytes / 1024, ", ".join(sales.columns))
            done = refresh(sales, root, date_pattern, version, buckets)
            checks = quality.enforce_checks(quality.dq_report(done.warehouse.profile))
            published = True
            tables = {raw_table: (done.raw.path, done.raw.schema), warehouse_table: (done.warehouse.path, done.warehouse.schema)}
            publish_together(spark, f"{warehouse_table}_published", root, version, tables, replace_definition, {warehouse_table: (KEY, buckets)} if buckets else None)
        except Exception:
            drop_staged(spark, f"warehouse_{version}")
            if not published and keep is not None:
                for name in ("raw", "warehouse"):
                    remove_version(spark, root, name, version)
            raise
    if keep is not None:
        for name, table in (("raw", raw_table), ("warehouse", warehouse_table)):
            forget_versions(spark, table, old_versions(spark, root, name, version, keep))
            log.info("removed versions of %s: %s", name, remove_old_versions(spark, root, name, version, keep))
        remove_old_versions(spark, root, "published", version, keep)
    return LoadResult(
        done.metrics.first(),
        done.warehouse.audit.first(),
        checks,
        branch_revenue_sample(spark.table(warehouse_table)),
        done.raw.path,
        done.warehouse.path,
    )
