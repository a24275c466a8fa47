"""Relational tables through Spark's JDBC source and sink.

Not exercised by the tests: that needs a database server.
"""

from pyspark.sql import DataFrame, SparkSession


def connection_options(url: str, table: str, user: str = "", password: str = "", batch_rows: int = 10_000) -> dict:
    options = {"url": url, "dbtable": table, "batchsize": str(batch_rows), "fetchsize": str(batch_rows)}
    if user:
        options |= {"user": user, "password": password}
    return options


def read_table(
    spark: SparkSession,
    connection: dict,
    split_column: str,
    lower: str,
    upper: str,
    partitions: int,
) -> DataFrame:
    """Read in parallel ranges of a numeric or date column; the bounds split, they do not filter."""
    return (
        spark.read.format("jdbc")
        .options(**connection)
        .option("partitionColumn", split_column)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", partitions)
        .load()
    )


def replace_table(df: DataFrame, connection: dict, partitions: int) -> None:
    """Empty the existing table, keeping its constraints, and insert over ``partitions`` connections.

    Each task commits its own rows, so the target's primary key is what rejects a repeated insert
    after a lost executor.
    """
    (
        df.write.format("jdbc")
        .options(**connection)
        .option("truncate", True)
        .option("numPartitions", partitions)
        .mode("overwrite")
        .save()
    )
