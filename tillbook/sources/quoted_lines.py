"""Records of CSV files whose quoted fields hold line breaks, read by splits.

Whether a line begins inside quotes depends on all lines before it. But a line only says one of two things for
either answer: where it ends, if it begins outside, and if inside. Such a pair of answers is composed over
the lines of each split, and by a window over the splits of a file, a row each. Then every split knows how it
begins, and its lines are joined to records where they are read. The few records that go on in a further
split, one at most for each border, are put together in a group each.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_SPLITS = "file string, block long, from_outside boolean, from_inside boolean, ever_outside boolean"
_RECORDS = "record binary, file string, block long, row long, first boolean, part int"
# parts of records
WHOLE, BEGUN, GOES_ON = 0, 1, 2
#: The rest of a quoted field up to its closing quote.
_CLOSED = r'^[^"]*+(?:""[^"]*+)*+"(?!")'


def _ends_inside(line: Column) -> Column:
    """Whether a line that begins outside quotes ends inside: a field that begins with a quote isn't closed."""
    return F.regexp_replace(line, r'(^|,)"[^"]*+(?:""[^"]*+)*+"(?!")', "$1x").rlike(r'(^|,)"')


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the files with what they say of quotes; carriage returns stay, as they may be in a field."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )
    # a closed field ends where the next one begins or the line does; a letter stands for it
    after = F.regexp_replace("value", _CLOSED, "x")
    closes = F.col("value").rlike(_CLOSED)
    return lines.select("*", _ends_inside(F.col("value")).alias("from_outside"), (~closes | _ends_inside(after)).alias("from_inside"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Neighbouring rows of one split."""
    at = 0
    files, blocks = batch.column("file"), batch.column("block").to_numpy()
    while at < batch.num_rows:
        end = at + 1
        if files[batch.num_rows - 1].as_py() == files[at].as_py() and blocks[-1] == blocks[at]:
            end = batch.num_rows
        else:
            while end < batch.num_rows and blocks[end] == blocks[at] and files[end].as_py() == files[at].as_py():
                end += 1
        yield (files[at].as_py(), int(blocks[at])), batch.slice(at, end - at)
        at = end


def _flags(run: pa.RecordBatch, name: str) -> np.ndarray:
    return run.column(name).to_numpy(zero_copy_only=False).astype(bool)


def _begins(inside: bool, outside_ends: np.ndarray, inside_ends: np.ndarray) -> np.ndarray:
    """Whether each line, and what follows the last, begins inside quotes. Most lines say the same for both answers;
    the others keep the answer or turn it round."""
    n = len(outside_ends)
    fixed, turns = outside_ends == inside_ends, outside_ends & ~inside_ends
    last = np.maximum.accumulate(np.where(fixed, np.arange(n), -1))
    turned = np.cumsum(turns)
    base = np.where(last >= 0, outside_ends[last], inside)
    since = turned - np.where(last >= 0, turned[last], 0)
    return np.concatenate(([inside], base ^ (since % 2 == 1)))


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row of _SPLITS for each split; ever_outside: begun inside, some line in it begins outside."""
    place, state = None, None

    def row() -> pa.RecordBatch:
        values = [*place, *state]
        types = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=["file", "block", "from_outside", "from_inside", "ever_outside"])

    for batch in batches:
        for here, run in _runs(batch):
            if here != place:
                if place:
                    yield row()
                place, state = here, (False, True, False)
            a, b = _flags(run, "from_outside"), _flags(run, "from_inside")
            inside = _begins(state[1], a, b)
            state = (bool(_begins(state[0], a, b)[-1]), bool(inside[-1]), state[2] or not inside[:-1].all())
    if place:
        yield row()


def _starts(splits: DataFrame) -> DataFrame:
    """For each split whether it begins and ends inside quotes, and the split in which the record began that goes on
    in it."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    turned = splits.withColumn("turned", F.count_if(F.col("from_outside") & ~F.col("from_inside")).over(upto))
    fixed = F.when(F.col("from_outside") == F.col("from_inside"), F.struct(F.col("from_outside").alias("state"), "turned"))
    known = turned.withColumn("last", F.last(fixed, ignorenulls=True).over(before)).withColumn("so_far", F.coalesce(F.lag("turned").over(Window.partitionBy("file").orderBy("block")), F.lit(0)))
    odd = (F.col("so_far") - F.coalesce("last.turned", F.lit(0))) % 2 == 1
    known = known.withColumn("inside", F.coalesce("last.state", F.lit(False)) != odd)
    known = known.withColumn("open", F.when(F.col("inside"), F.col("from_inside")).otherwise(F.col("from_outside")))
    opens = F.when(F.col("open") & (~F.col("inside") | F.col("ever_outside")), F.col("block"))
    final = F.lead("block").over(Window.partitionBy("file").orderBy("block")).isNull()
    return known.select("file", "block", "inside", "open", F.last(opens, ignorenulls=True).over(before).alias("owner"), final.alias("final"))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of _RECORDS: a split's lines joined to records, in order; ``block`` is that in which a record began."""
    place, row, held, begun = None, 0, [], (0, 0, False)
    names = ["record", "file", "block", "row", "first", "part"]
    types = [pa.binary(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int32()]

    def left() -> list[tuple]:
        """What is held at the end of a split: a record that goes on, or a part of one that does."""
        return [(b"\n".join(held), place[0], begun[0], begun[1], begun[2], begun[3])] if held else []

    for batch in batches:
        out: list[tuple] = []
        for here, run in _runs(batch):
            if here != place:
                out += left()
                place, row, held = here, 0, []
                inside = run.column("inside")[0].as_py() or False
                if inside:  # the rest of a record that began in an earlier split
                    begun = (run.column("owner")[0].as_py(), here[1], False, GOES_ON)
                state = inside
            begins = _begins(state, _flags(run, "from_outside"), _flags(run, "from_inside"))
            lines, first_row = run.column("value").to_pylist(), row
            for k, line in enumerate(lines):
                if not begins[k]:
                    begun = (here[1], first_row + k, here[1] == 0 and first_row + k == 0, WHOLE)
                if begins[k + 1]:
                    held.append(line)
                    if begun[3] == WHOLE:
                        begun = (*begun[:3], BEGUN)
                elif held:
                    held.append(line)
                    part = begun[3] if begun[3] == GOES_ON else WHOLE
                    out.append((b"\n".join(held), here[0], *begun[:3], part))
                    held = []
                else:
                    out.append((line, here[0], *begun[:3], begun[3]))
            row, state = first_row + len(lines), bool(begins[-1])
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
    if place and (out := left()):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(record, file, block, row, first) for each record of the CSV files: its bytes without the line's end, the split
    and the line in it where it begins, and whether it is the file's first. A quote that is never closed is an error.

    One row for each split goes through a window by file and, where a split begins inside quotes, to all tasks.
    """
    lines = _lines(spark, path)
    splits = lines.select("file", "block", "from_outside", "from_inside").mapInArrow(_summed, _SPLITS)
    starts = _starts(splits)
    unclosed = F.when(F.col("final") & F.col("open"), F.raise_error(F.concat(F.lit("a quote isn't closed: "), "file"))).otherwise(F.lit(True))
    starts = starts.where(unclosed).where("inside").select("file", "block", "inside", "owner")
    told = lines.withColumn("value", F.col("value").cast("binary")).join(F.broadcast(starts), ["file", "block"], "left")
    found = told.select("value", "file", "block", "from_outside", "from_inside", "inside", "owner").mapInArrow(_joined, _RECORDS)
    parts = found.where(f"part <> {WHOLE}").groupBy("file", "block").agg(
        F.sort_array(F.collect_list(F.struct("part", "row", "first", "record"))).alias("parts")
    )
    joined = F.array_join(F.transform("parts", lambda p: F.hex(p["record"])), "0A")
    stitched = parts.select(F.unhex(joined).alias("record"), "file", "block", F.col("parts")[0]["row"].alias("row"), F.col("parts")[0]["first"].alias("first"))
    return found.where(f"part = {WHOLE}").select("record", "file", "block", "row", "first").unionByName(stitched)
