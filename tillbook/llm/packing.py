"""Best-fit packing with certified bounds.

Documents become pieces of at most ``capacity`` tokens. Pieces are dealt evenly to partitions of a
bounded number of rows, and each partition packs its own by best-fit decreasing. Dual-feasible
functions give a lower bound of the sequences its lengths need in any packing. A partition that
reaches its bound is certified; it hands on only its emptiest sequence, as the remainders of many
partitions may still share one. A partition with a gap hands on all sequences that are not full.
What is handed on is dealt anew, by another hash and so among other neighbours, to fewer partitions,
which run best-fit decreasing again, until one partition holds all that is left or a round saves no more
sequences; the partitions that then close without reaching their bound are said so.
"""

import logging
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.llm.batch_bpe import batch_encoder
from tillbook.llm.common import parts_for, pieces, written

#: Rows that one partition packs, so that its memory doesn't grow with the input.
PART_ROWS = 2048
#: Rounds go on while they save this share of the sequences that are open.
SAVED = 0.0005
_NO = "_row"
#: What packing adds to its rows.
ADDED = ("sequence_id", "offset", "certified")
log = logging.getLogger(__name__)


def token_pieces(documents: DataFrame, path: str, capacity: int = 4096, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece (from 0), start, length, ids_crc32, and ids if asked for.

    A document's ids are those of its whole text, then ``end_id``; null and empty texts have that one
    only. Only documents of more than ``capacity`` ids are cut. Repeated rows and null ids stay; other
    columns play no part.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    fields = "doc_id long, piece int, start long, length long, ids_crc32 long"
    schema = T._parse_datatype_string(fields + (", ids array<int>" if with_ids else ""))
    step, end = 4 * capacity, np.array([end_id], "<u4").tobytes()

    def run(batches):
        kept = batch_encoder(path)
        for batch in pieces(batches):
            out: dict[str, list] = {n: [] for n in [*names, "ids"]}
            for doc_id, ids in zip(batch.column(0).to_pylist(), kept.encode(batch.column(1).cast(pa.binary()).to_pylist())):
                ids += end
                for piece, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    for name, value in zip(names, (doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part))):
                        out[name].append(value)
                    if with_ids:
                        out["ids"].append(np.frombuffer(part, "<u4").astype("i4").tolist())
            columns = [pa.array(out[n], pa.int32() if n == "piece" else pa.int64()) for n in names]
            if with_ids:
                columns.append(pa.array(out["ids"], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each length, and the free space of each bin.

    Takes the longest first, earlier rows first among equals, each into the fullest bin that has room.
    """
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    free: list[int] = []
    by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
    spaces = 0  # bit s is set if a bin has s tokens of free space
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        if roomy := spaces >> length:
            space = length + (roomy & -roomy).bit_length() - 1
            bin_ = by_space[space].pop()
            if not by_space[space]:
                spaces ^= 1 << space
        else:
            space, bin_ = capacity, len(free)
            free.append(capacity)
        bins[i], offsets[i] = bin_, capacity - space
        space -= length
        free[bin_] = space
        if space:
            by_space[space].append(bin_)
            spaces |= 1 << space
    return bins, offsets, np.array(free, np.int64)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs, by two families of dual-feasible functions.

    The first rounds lengths above ``capacity - k`` up to a whole bin and those below ``k`` down to
    nothing; the second rounds down to multiples of ``1/k`` of a bin where ``(k + 1)`` times the length
    isn't whole. ``k`` of 0 in the first is the plain volume.
    """
    sizes, counts = np.unique(lengths, return_counts=True)
    if not len(sizes):
        return 0
    best = 0
    for k in np.unique(np.r_[0, sizes[2 * sizes <= capacity]]):
        units = np.where(sizes > capacity - k, capacity, np.where(sizes < k, 0, sizes))
        best = max(best, -(-int((units * counts).sum()) // capacity))
    for k in range(1, 65):
        whole, rest = np.divmod((k + 1) * sizes, capacity)
        units = np.where(rest == 0, sizes * k, whole * capacity)
        best = max(best, -(-int((units * counts).sum()) // (k * capacity)))
    return best


def _packer(columns: list[str], capacity: int, turn: int):
    """What packs one partition: the sequences that go on are open, the emptiest one of a certified partition, or all
    that are not full."""

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(_NO, ignore_index=True)
        lengths = part["length"].to_numpy()
        if part["length"].isna().any() or lengths.min() < 1 or lengths.max() > capacity:
            raise ValueError(f"lengths must be from 1 to {capacity}")
        bins, offsets, free = best_fit_decreasing(lengths.astype(np.int64), capacity)
        certified = len(free) <= lower_bound(lengths, capacity)
        open_bins = free > 0
        if certified:
            open_bins = np.zeros(len(free), bool)
            open_bins[free.argmax()] = free.max() > 0
        part["sequence_id"] = ((turn << 28) + int(key[0]) << 20) + bins
        part["offset"], part["certified"], part["_open"] = offsets, certified, open_bins[bins]
        return part[columns]

    return run


def pack(items: DataFrame, capacity: int = 4096, part_rows: int = PART_ROWS) -> DataFrame:
    """The items with ``sequence_id``, ``offset`` and ``certified``; sequences are gapless from offset 0.

    ``certified``: the partition that closed the sequence needs as many as it has. ``items`` needs a whole
    ``length`` from 1 to ``capacity``, else the job fails; rows with equal values are packed one by one. An empty
    table gives an empty one. Other columns stay, but those named like the three new ones give way to them.
    """
    items = items.select(*[c for c in items.columns if c not in ADDED])
    # other columns go by position, so that no name of theirs can clash
    own = [c if c == "length" else f"_own{k}" for k, c in enumerate(items.columns)]
    fields = [T.StructField(n, f.dataType) for n, f in zip(own, items.schema.fields)]
    added = [T.StructField(_NO, T.LongType()), *[T.StructField(n, T.LongType()) for n in ADDED[:2]], *[T.StructField(n, T.BooleanType()) for n in (ADDED[2], "_open")]]
    schema = T.StructType([*fields, *added])
    left = written(items.toDF(*own), "pieces").withColumn(_NO, F.monotonically_increasing_id())
    done: list[DataFrame] = []
    rows, sequences, turn = left.count(), None, 0
    while True:
        parts = parts_for(rows, part_rows)
        dealt = left.withColumn("_part", F.pmod(F.xxhash64(_NO, F.lit(turn)), F.lit(parts)))
        packed = written(dealt.groupBy("_part").applyInPandas(_packer(schema.names, capacity, turn), schema), f"packed_{turn}")
        count = F.count_if(F.col("offset") == 0)
        used, open_, rows = packed.agg(count, F.count_if((F.col("offset") == 0) & F.col("_open")), F.count_if("_open")).first()
        if sequences is not None and used >= sequences:  # no better than before
            done.append(before.where("_open"))
            break
        if parts == 1 or not rows or (sequences is not None and sequences - used <= SAVED * sequences):
            done.append(packed)
            break
        done.append(packed.where("not _open"))
        before, sequences, turn = packed, open_, turn + 1
        left = packed.where("_open").select(*own, _NO)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    uncertified = out.where("not certified and offset = 0").select(F.shiftright("sequence_id", 20).alias("part")).distinct().count()
    if uncertified:
        log.info("%d partitions closed without reaching their bound", uncertified)
    return out.select(*own, *ADDED).toDF(*items.columns, *ADDED)


def pack_documents(documents: DataFrame, path: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """``token_pieces`` packed by ``pack``: doc_id, piece, start, length, ids_crc32, sequence_id, offset, certified."""
    return pack(token_pieces(documents, path, capacity, end_id), capacity)
