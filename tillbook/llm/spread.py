"""Positions within groups and lookups by key, without gathering a group in one task."""

import itertools
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.llm.common import written

#: A key of more than this share of all rows counts as hot, so there are at most as many hot keys as its inverse.
HOT_SHARE = 1000
#: Fewer rows than this are never hot.
HOT_ROWS = 256


def numbered(rows: DataFrame, group: list[str], order: list[str], name: str, cached: str) -> DataFrame:
    """``rows`` with ``name``: the row's position (from 0) among those of its group, by ``order``, nulls first.

    Rows are sorted by range, so that a large group spans many tasks and equal rows may be parted; each
    task counts its own, and the counts before it are added. Those are wanted only where a group goes on
    from the partition before, so there are no more of them than partitions and they may be broadcast.
    ``rows`` is written once, under the name ``cached``.
    """
    sort = [*group, *order, "_tie"]
    width = len(rows.columns)
    schema = T.StructType([*rows.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_local", T.LongType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            keys = zip(*(batch.column(g).to_pylist() for g in group)) if group else itertools.repeat((), batch.num_rows)
            local = []
            for key, same in itertools.groupby(keys):
                n = sum(1 for _ in same)
                seen = seen if key == last else 0
                local.append(np.arange(seen, seen + n))
                last, seen = key, seen + n
            local = np.concatenate(local) if local else np.empty(0, np.int64)
            columns = [*batch.columns[:width], pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(local)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    placed = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*sort).sortWithinPartitions(*sort)
    placed = written(placed.mapInArrow(run, schema), cached)
    sizes = placed.groupBy(*group, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_before", F.sum("_n").over(before)).where("_before > 0")
    offsets = offsets.select("_before", *[F.col(c).alias(f"_of{k}") for k, c in enumerate([*group, "_part"])])
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_of{k}")) for k, c in enumerate([*group, "_part"])])
    found = placed.join(F.broadcast(offsets), same, "left")
    return found.select(*rows.columns, (F.col("_local") + F.coalesce("_before", F.lit(0))).alias(name))


def attached(rows: DataFrame, lookup: DataFrame, keys: list[str], counts: DataFrame | None = None) -> DataFrame:
    """``rows`` left-joined to ``lookup`` by ``keys``, which are unique there; null keys find nothing.

    Keys of more than a thousandth of the rows are found first, from ``counts`` (keys and n) if they are known;
    there are a thousand at most, and what the lookup says of them is broadcast. In the join of the others
    these rows and those with null keys have a number of their own in the key, which spreads them. So no
    task gets all rows of a hot key.
    """
    values = [c for c in lookup.columns if c not in keys]
    if counts is None:
        counts = rows.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("n"))
    total, most = counts.agg(F.sum("n"), F.max("n")).first()
    limit = max(HOT_ROWS, -(-(total or 0) // HOT_SHARE))
    alone = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    if some_hot := (most or 0) > limit:
        hot = counts.where(F.col("n") > limit).select(*keys).join(lookup, keys, "left")
        hot = written(hot.select(*keys, F.lit(True).alias("_hot"), *[F.col(v).alias(f"_hot_{v}") for v in values]), "hot_keys")
        rows, columns = rows.join(F.broadcast(hot), keys, "left"), rows.columns
        alone |= F.coalesce("_hot", F.lit(False))
    else:
        columns = rows.columns
    spread = rows.withColumn("_own", F.when(alone, F.monotonically_increasing_id() + 1).otherwise(F.lit(0)).cast("long"))
    found = spread.join(lookup.withColumn("_own", F.lit(0).cast("long")), [*keys, "_own"], "left")
    if not some_hot:
        return found.select(*columns, *values)
    return found.select(*columns, *[F.when(F.col("_hot"), F.col(f"_hot_{v}")).otherwise(F.col(v)).alias(v) for v in values])
