"""Parquet tables that are replaced as a whole.

A load writes a new folder, which is checked and only then made the table's location. A failed
or repeated load therefore never touches the data readers see.
"""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
_VERSION = "load_"
_LOAD = "load"


@lru_cache
def _local_root(application_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"tillbook-{application_id}-")


def shared_root(spark: SparkSession) -> str:
    """Folder for written intermediate tables, as named by ``spark.checkpoint.dir``. Only a local
    session, whose tasks all run on this machine, may do without the setting."""
    application_id = spark.sparkContext.applicationId
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return f"{root}/tillbook/{application_id}"
    if not spark.conf.get("spark.master").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_root(application_id)


def new_version() -> str:
    """Name of a version; names sort by time."""
    return f"{_VERSION}{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}_{uuid.uuid4().hex[:12]}"


@contextmanager
def _open_writers(spark: SparkSession, n: int) -> Iterator[None]:
    before = spark.conf.get(_WRITERS)
    spark.conf.set(_WRITERS, n)
    try:
        yield
    finally:
        spark.conf.set(_WRITERS, before)


def stage(df: DataFrame, root: str, name: str, *partition: str, version: str | None = None, writers: int = 0) -> str:
    """Write a new version of a table and return its folder. A task keeps up to ``writers`` partitions
    open at once; rows are sorted by partition only if there are more."""
    path = f"{root}/{name}/{version or new_version()}"
    with _open_writers(df.sparkSession, writers):
        df.write.mode("error").partitionBy(*partition).parquet(path)
    return path


def read_staged(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def stage_by_key(df: DataFrame, root: str, name: str, key: str, buckets: int, *partition: str, version: str, writers: int = 0) -> tuple[str, str]:
    """Like ``stage``, with the rows of each partition dealt to ``buckets`` files by the hash of ``key``. Returns the
    folder and a table of the catalog that knows of this, for the checks of the load; ``drop_staged`` removes it,
    not the files. Rows that a shuffle by the key has dealt to as many tasks are written as they come."""
    path, table = f"{root}/{name}/{version}", f"{name}_{version}"
    with _open_writers(df.sparkSession, writers):
        df.write.mode("error").partitionBy(*partition).bucketBy(buckets, key).option("path", path).saveAsTable(table)
    return path, table


def drop_staged(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


class SchemaChangedError(ValueError):
    """The new version of a published table has other columns or types."""


def publish(spark: SparkSession, table: str, path: str, schema: T.StructType, replace_definition: bool = False) -> None:
    """Point ``table`` at a staged folder; for an existing table this is one catalog change.

    A table keeps its columns: the new version's columns would read as NULL under other names, so another
    schema is an error. With ``replace_definition`` the table is dropped and created anew in that case; its
    files stay, but for a moment there is no table.
    """
    if spark.catalog.tableExists(table):
        ours, theirs = ([(f.name, f.dataType) for f in s] for s in (schema, spark.table(table).schema))
        if ours == theirs:
            spark.sql(f"ALTER TABLE {table} SET LOCATION {_location(path)}")
            spark.catalog.refreshTable(table)
            return
        if not replace_definition:
            changed = sorted({n for n, _ in set(ours) ^ set(theirs)}) or "order of columns"
            raise SchemaChangedError(f"{table} has another schema: {changed}; replace_definition would replace it")
        spark.sql(f"DROP TABLE {table}")
    spark.catalog.createTable(table, path=path, source="parquet", schema=schema)


def _location(path: str) -> str:
    return "'" + path.replace("'", "\\'") + "'"


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def _is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType == "VIEW"


def publish_together(
    spark: SparkSession, pointer: str, root: str, version: str, tables: dict[str, tuple[str, T.StructType]], replace_definition: bool = False,
    clustered: dict[str, tuple[str, int]] | None = None,
) -> None:
    """Let all ``tables`` (name: staged folder and schema) show ``version``, by one catalog change.

    Each name is a view of ``<name>_versions``, a table that has the staged folders as its partitions, and shows the
    partition that the table ``pointer`` names. The new partitions are added first, where no reader looks; then
    the pointer is moved to a folder written aside. A crash at any step leaves all tables at the old version, or
    all at the new one, and a repeated call goes on from there. Readers prune the other partitions.

    ``clustered``: for tables that ``stage_by_key`` has laid out, the key and the number of buckets. Another schema
    or layout is an error, unless ``replace_definition`` is set: then all versions are taken out of the catalog,
    and for a moment there are no tables, as when a table that ``publish`` made becomes a view. Their files stay.
    """
    layout = {name: (clustered or {}).get(name) for name in tables}
    for name, (_, schema) in tables.items():
        versions = f"{name}_versions"
        if spark.catalog.tableExists(name) and not replace_definition:
            ours, theirs = _fields(schema), _fields(spark.table(name).schema)
            if ours != theirs:
                changed = sorted({n for n, _ in set(ours) ^ set(theirs)}) or "order of columns"
                raise SchemaChangedError(f"{name} has another schema: {changed}; replace_definition would replace it")
            if spark.catalog.tableExists(versions) and _layout(spark, versions) != layout[name]:
                raise SchemaChangedError(f"{name} has another layout: {_layout(spark, versions)}; replace_definition would replace it")
    for name, (path, schema) in tables.items():
        if spark.catalog.tableExists(name) and not _is_view(spark, name):
            spark.sql(f"DROP TABLE {name}")
        versions = f"{name}_versions"
        if spark.catalog.tableExists(versions) and (_fields(spark.table(versions).drop(_LOAD).schema), _layout(spark, versions)) != (_fields(schema), layout[name]):
            spark.sql(f"DROP VIEW IF EXISTS {name}")
            spark.sql(f"DROP TABLE {versions}")
        by_key = "CLUSTERED BY ({}) INTO {} BUCKETS".format(*layout[name]) if layout[name] else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {versions} ({_columns(schema)}, {_LOAD} string) USING parquet PARTITIONED BY ({_LOAD}) {by_key} LOCATION {_location(f'{root}/none')}")
        spark.sql(f"ALTER TABLE {versions} ADD IF NOT EXISTS PARTITION ({_LOAD} = '{version}') LOCATION {_location(path)}")
        spark.catalog.refreshTable(versions)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {pointer} ({_LOAD} string) USING parquet LOCATION {_location(f'{root}/none')}")
    for name, (_, schema) in tables.items():
        shown = ", ".join(f"`{f.name}`" for f in schema)
        if not _is_view(spark, name):
            spark.sql(f"CREATE VIEW {name} AS SELECT {shown} FROM {name}_versions WHERE {_LOAD} = (SELECT max({_LOAD}) FROM {pointer})")
    path = f"{root}/published/{version}"
    spark.createDataFrame([(version,)], f"{_LOAD} string").coalesce(1).write.mode("overwrite").parquet(path)
    spark.sql(f"ALTER TABLE {pointer} SET LOCATION {_location(path)}")  # from here on, readers see the new version
    spark.catalog.refreshTable(pointer)


def published_version(spark: SparkSession, pointer: str) -> str | None:
    """The version that the tables of ``pointer`` show."""
    return spark.table(pointer).agg({_LOAD: "max"}).first()[0] if spark.catalog.tableExists(pointer) else None


def forget_versions(spark: SparkSession, name: str, versions: list[str]) -> None:
    """Take versions that nobody needs out of the catalog, before their files go."""
    for version in versions:
        spark.sql(f"ALTER TABLE {name}_versions DROP IF EXISTS PARTITION ({_LOAD} = '{version}')")
    spark.catalog.refreshTable(f"{name}_versions")


def _layout(spark: SparkSession, table: str) -> tuple[str, int] | None:
    """Key and number of buckets of a table, if it has any."""
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    if not described.get("Num Buckets"):
        return None
    return described["Bucket Columns"].strip("[]`"), int(described["Num Buckets"])


def _fields(schema: T.StructType) -> list[tuple[str, T.DataType]]:
    return [(f.name, f.dataType) for f in schema]


def _folder(spark: SparkSession, path: str):
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there, there.getFileSystem(spark._jsc.hadoopConfiguration())


def remove_version(spark: SparkSession, root: str, name: str, version: str) -> None:
    there, files = _folder(spark, f"{root}/{name}/{version}")
    files.delete(there, True)


def old_versions(spark: SparkSession, root: str, name: str, version: str, keep: int) -> list[str]:
    """All but the ``keep`` latest versions up to ``version``. Later versions and other folders aren't among them."""
    if keep < 1:
        raise ValueError("at least the published version has to stay")
    there, files = _folder(spark, f"{root}/{name}")
    found = sorted(s.getPath().getName() for s in files.listStatus(there))
    return [v for v in found if v.startswith(_VERSION) and v <= version][:-keep]


def remove_old_versions(spark: SparkSession, root: str, name: str, version: str, keep: int) -> list[str]:
    """Remove ``old_versions``, and return them."""
    old = old_versions(spark, root, name, version, keep)
    for v in old:
        remove_version(spark, root, name, v)
    return old
