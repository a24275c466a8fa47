"""What the operators share: reading tables, cutting lineage, walking Arrow batches in small pieces."""

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.sources.tables import shared_root

#: Rows of a piece in ``pieces``: what a task holds as Python objects at once.
PIECE_ROWS = 256


#: Rows of a task that writes the result of a shuffle whose size is known.
TASK_ROWS = 8192

#: Bytes of the batches in which texts go to Python and back, and Spark's own default.
BATCH_BYTES, _DEFAULT_BATCH_BYTES = "4194304b", "67108864b"
_BATCHES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Let texts go to Python in batches of a few MB, unless the session has a setting of its own. Both sides hold a
    batch for each task, in memory that they don't give back."""
    if spark.conf.get(_BATCHES) == _DEFAULT_BATCH_BYTES:
        spark.conf.set(_BATCHES, BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new name in the folder that all executors share."""
    return f"{shared_root(spark)}/llm/{name}_{uuid.uuid4().hex}"


def drop_at_end(spark: SparkSession, path: str) -> None:
    """Let a written folder go when the driver ends; until then, results that aren't yet computed may read it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(folder)


def in_few_parts(df: DataFrame, rows: int, task_rows: int = TASK_ROWS) -> DataFrame:
    """``df``, the result of a shuffle, in no more parts than about ``rows`` rows want. A task then takes several
    partitions of the shuffle, where each would be small; the more rows there are, the more tasks."""
    return df.coalesce(parts_for(rows, task_rows))


def written(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write to the folder all executors share and read again, so that a lost executor costs no
    more than the task it ran. With ``rows``, in few parts."""
    path = shared_folder(df.sparkSession, name)
    if rows is not None:
        df = in_few_parts(df, rows)
    df.write.parquet(path)
    drop_at_end(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint small intermediate rows; the session's folder, or the shared one if it has none."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{shared_root(df.sparkSession)}/checkpoints")
    return df.checkpoint()


def pieces(batches: Iterator[pa.RecordBatch], rows: int = PIECE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def parts_for(rows: int, rows_per_part: int) -> int:
    return max(1, -(-rows // rows_per_part))


def text_key(column: str) -> F.Column:
    """crc32 of a column as text, the number that splits learning and held-out rows."""
    return F.crc32(F.col(column).cast("string").cast("binary"))
