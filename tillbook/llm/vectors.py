"""Vectors in blocks of a bounded number of rows, for searches of a query set against all rows."""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillbook.llm.common import parts_for

BLOCK = "block int, ids binary, dims int, vectors binary"


def usable(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(id, vector of double) of the rows whose id isn't null and whose vector isn't null and has neither null
    nor non-finite components."""

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    vector = F.col(vector_column).cast("array<double>")
    return vectors.select(F.col(id_column).cast("long").alias("id"), vector.alias("vector")).where(
        F.col("id").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", finite)
    )


def blocks(vectors: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` of (id, vector) in each row of BLOCK: ids as int64, vectors as a matrix of
    float64, shorter ones filled with zeros. Rows are spread by their position, so repeated ids and
    vectors don't meet in one block."""
    total = parts_for(vectors.count(), rows)

    def pack(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("id", ignore_index=True, kind="stable")
        dims = max(part["vector"].map(len).max(), 1)
        matrix = np.zeros((len(part), dims))
        for row, vector in zip(matrix, part["vector"]):
            row[: len(vector)] = vector
        ids = part["id"].to_numpy(np.int64)
        return pd.DataFrame({"block": [key[0]], "ids": [ids.tobytes()], "dims": [dims], "vectors": [matrix.tobytes()]})

    spread = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(total)).cast("int")
    return vectors.withColumn("block", spread).groupBy("block").applyInPandas(pack, BLOCK)


def unpacked(ids: bytes, dims: int, vectors: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, np.int64), np.frombuffer(vectors).reshape(-1, dims)


def same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) if m.shape[1] < width else m for m in (a, b))
    return a, b


def against_all(index: DataFrame, queries: DataFrame, copies: int) -> DataFrame:
    """Every block of ``queries`` beside every shard of ``index`` (column shard), as one equi-join.

    A search takes far longer than its rows are large, so each shard's blocks are dealt to ``copies`` tasks, and
    the number of tasks is fixed, which adaptive execution leaves alone.
    """
    last = index.agg(F.max("shard")).first()[0]
    shards = F.array().cast("array<int>") if last is None else F.sequence(F.lit(0), F.lit(last))
    tasks = 2 * copies * (1 + (last or 0))
    spread = queries.select(
        F.explode(shards).alias("shard"), F.pmod(F.xxhash64("block"), F.lit(copies)).cast("int").alias("copy"),
        F.col("ids").alias("query_ids"), F.col("dims").alias("query_dims"), F.col("vectors").alias("query_vectors"),
    )
    copied = index.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    found = copied.repartition(tasks, "shard", "copy").join(spread.repartition(tasks, "shard", "copy"), ["shard", "copy"])
    return found.drop("copy")


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of (query_id, query_no, vec_id, score) of each query, ties to smaller vec_id."""
    order = Window.partitionBy("query_id", "query_no").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
