"""N-gram Jaccard join as a blocked sparse product of the document by n-gram incidence.

Documents with equal n-gram sets are one row of the incidence. Its columns are ordered by how full
the column's hash bucket is, rare ones first; any order gives right results, this one keeps common
passages out of the way. Two rows over the threshold share a column among the first few of each (those
that the threshold leaves beyond the shared part), so the product only runs over these.

- A light column (few rows) contributes all its pairs.
- A heavy column would contribute pairs with the square of its rows. Instead each row meets the
  column's pivot, the row with most of its leading columns among the heavy ones. Rows that link to the
  pivot are in one component, and links inside it can't change the components.
- Heavy columns with rows of several components left are taken up again. One of at most MANY rows
  contributes the pairs between components that the sizes allow. The rows of a larger one get an incidence of
  their own, with exact counts of all their columns, see ``_across``: pairs that share a column of few rows
  come from such a column, all others share heavy columns alone, so rows with the same heavy columns are one
  row of a smaller incidence, in which the sizes alone decide who links.

The product accumulates how many leading columns a pair shares. Pairs are dropped by bounds from sizes:
those of the two sets; the shared leading columns, as all else that is shared lies behind the leading
columns of one set; and the parities of the sets' sizes in each of 1,024 hash classes, as two sets differ
by at least the number of classes whose parities differ. What is left is multiplied out exactly, block by
block: one row against up to BLOCK_PAIRS others, which it is shipped for once.
"""

import hashlib
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.llm.common import in_few_parts, parts_for, pieces, written
from tillbook.llm.graph import components
from tillbook.llm.shingles import draw_base, shingle_sets
from tillbook.llm.spread import attached

#: Rows of a column that still contributes all pairs: its pairs stay below 8 for each of its rows.
LIGHT = 16
#: Rows of a heavy column whose pairs between components are all looked at.
MANY = 128
#: How much more rows a light column may have in each further incidence of ``_across``.
GROWTH = 8
#: Heavy columns that go to the workers at once: 8 MB.
SENT_COLUMNS = 1 << 20
#: Parts in which a lookup goes to the workers at most.
SENT_PARTS = 4
#: Pairs of one row that are multiplied out in one block.
BLOCK_PAIRS = 256
#: Leading columns of a core that all of its rows hold, so that a pair comes from the first that it shares.
HEAD = 32
#: Items that a task counts at once: 8 MB.
COUNTED = 1 << 20
#: Sets that a task takes from a shuffle of known size.
TASK_SETS = 1024
#: Buckets in which columns are counted to order them: 2 MB on the driver and each worker.
BUCKET_BITS = 18
_CHUNK = 4096
#: Hash classes whose parities are kept, 64 in a column.
CLASSES = 1024
#: Buckets of the filters that spare sets and texts a shuffle: what passes by chance is sorted out by joins.
FILTER = 1 << 23
DROPPED_BUCKETS = 1 << 20
_PARITIES = [f"p{i}" for i in range(CLASSES // 64)]


def _column_bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _print(hashes: np.ndarray) -> bytes:
    """128-bit fingerprint of a set; its first half is the set's key."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _key(fingerprint: bytes) -> int:
    return int.from_bytes(fingerprint[:8], "little", signed=True)


def _parities(hashes: np.ndarray) -> np.ndarray:
    odd = np.bincount((hashes % np.uint64(CLASSES)).astype(np.int64), minlength=CLASSES) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _sets(batches, width: int, base: int):
    """(ids, fingerprints, sets) of small pieces; texts are read as bytes."""
    for piece in pieces(batches):
        sets = list(shingle_sets(piece.column(1).cast(pa.binary()).to_pylist(), width, base))
        yield piece.column(0).to_pylist(), [_print(s) if len(s) else None for s in sets], sets


def _described(documents: DataFrame, width: int, base: int) -> DataFrame:
    """A row per document, and rows with the task's column counts."""
    schema = "doc_id long, n long, fp binary, key long, chunk int, counts binary, " + ", ".join(f"{c} long" for c in _PARITIES)
    types = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.binary(), *[pa.int64()] * len(_PARITIES)]
    names = ["doc_id", "n", "fp", "key", "chunk", "counts", *_PARITIES]

    def run(batches):
        counts = np.zeros(1 << BUCKET_BITS, np.int64)
        for ids, prints, sets in _sets(batches, width, base):
            counts += np.bincount(_column_bucket(np.concatenate(sets)), minlength=len(counts))
            parities = np.array([_parities(s) for s in sets])
            none = [None] * len(ids)
            columns = [ids, [len(s) for s in sets], prints, [p and _key(p) for p in prints], none, none, *parities.T]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)
        chunks = counts.reshape(-1, _CHUNK)
        full = np.flatnonzero(chunks.any(axis=1))
        none = [None] * len(full)
        columns = [none, none, none, none, full, [chunks[c].tobytes() for c in full], *[none] * len(_PARITIES)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return documents.mapInArrow(run, schema)


def _column_loads(described: DataFrame) -> np.ndarray:
    """Documents in each column bucket: sums of the tasks' counts, one bounded array."""

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for piece in pieces(batches):
            for chunk, counts in zip(*(c.to_pylist() for c in piece.columns)):
                sums[chunk] = sums.get(chunk, 0) + np.frombuffer(counts, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*sums], pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["chunk", "counts"]
        )

    rows = described.where("chunk is not null").select("chunk", "counts")
    # two steps, so that no task reads the counts of more than a few hundred others
    salted = rows.repartition(F.col("chunk"), F.pmod(F.xxhash64("counts"), F.lit(64)))
    once = in_few_parts(salted, rows.count(), _CHUNK // 16).mapInArrow(run, "chunk int, counts binary")
    out = np.zeros(((1 << BUCKET_BITS) // _CHUNK, _CHUNK), np.int64)
    for chunk, counts in in_few_parts(once.repartition("chunk"), len(out), 8).mapInArrow(run, "chunk int, counts binary").collect():
        out[chunk] = np.frombuffer(counts, np.int64)
    return out.reshape(-1)


def _postings(documents: DataFrame, width: int, base: int, percent: int, loads: np.ndarray) -> DataFrame:
    """(column, key) for the leading columns of every set."""
    shared = documents.sparkSession.sparkContext.broadcast(loads)

    def run(batches):
        order = shared.value
        for _, prints, sets in _sets(batches, width, base):
            columns, keys = [], []
            for fingerprint, hashes in zip(prints, sets):
                if fingerprint:
                    leading = len(hashes) - -(-percent * len(hashes) // 100) + 1
                    by_load = np.lexsort((hashes, order[_column_bucket(hashes)]))
                    columns.append(hashes[by_load[:leading]])
                    keys.append(np.full(leading, _key(fingerprint)))
            if columns:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(columns).view(np.int64)), pa.array(np.concatenate(keys))], names=["col", "key"]
                )

    return documents.mapInArrow(run, "col long, key long")


def _wanted_sets(documents: DataFrame, width: int, base: int, wanted: DataFrame) -> DataFrame:
    """(fp, items) of the sets in ``wanted`` (fp, key, id), each once: from a row with its smallest doc_id. A filter
    keeps most others out of the shuffle, and the join what passes it by chance."""
    wanted = written(wanted.distinct(), "wanted", wanted.count())
    count = wanted.count()
    bucket = F.pmod(F.col("key").bitwiseXOR(F.coalesce("id", F.lit(0))), F.lit(FILTER)) + 1
    maps = wanted.select(bucket.alias("x")).groupBy(F.bitmap_bucket_number("x")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("x")))
    bits = np.zeros(FILTER // 8, np.uint8)
    for number, bitmap in maps.collect():  # FILTER bits in all
        bits[(number - 1) * len(bitmap) : number * len(bitmap)] = np.frombuffer(bytes(bitmap), np.uint8)[: len(bits) - (number - 1) * len(bitmap)]
    shared = documents.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        filter_ = shared.value
        for ids, prints, sets in _sets(batches, width, base):
            places = [p and (_key(p) ^ (i or 0)) % FILTER for i, p in zip(ids, prints)]
            out = [(p, i, s.tobytes()) for p, i, s, at in zip(prints, ids, sets, places) if p and filter_[at >> 3] >> (at & 7) & 1]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[k] for o in out], t) for k, t in enumerate((pa.binary(), pa.int64(), pa.binary()))], names=["fp", "id", "items"]
            )

    sets = documents.mapInArrow(run, "fp binary, id long, items binary").alias("s")
    known = wanted.select("fp", "id").alias("w")
    found = sets.join(known, (F.col("s.fp") == F.col("w.fp")) & F.col("s.id").eqNullSafe(F.col("w.id")), "left_semi")
    return in_few_parts(found.dropDuplicates(["fp"]).select("fp", "items"), count, TASK_SETS)


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, shared) for ``pairs`` (a, b, each once) of rows of ``sets`` (fp, items: sorted 64-bit numbers).

    Of each pair the row that has more pairs is the first; it goes to blocks of about BLOCK_PAIRS of its pairs, so
    that no task gets all pairs of one row. A block is a product of one row with others.
    """
    degrees = pairs.select(F.col("a").alias("fp")).unionAll(pairs.select("b")).groupBy("fp").agg(F.count("*").alias("n"))
    count = pairs.count()
    degrees = written(degrees.where("n > 1"), "degrees", count)

    def degree(side: str) -> DataFrame:
        return degrees.select(F.col("fp").alias(side), F.col("n").alias(f"n_{side}"))

    counts = degrees.withColumnRenamed("fp", "a")
    turned = attached(pairs, degree("a"), ["a"], counts)
    turned = attached(turned, degree("b"), ["b"], degrees.withColumnRenamed("fp", "b")).fillna(1, ["n_a", "n_b"])
    first = F.col("n_a") >= F.col("n_b")
    turned = turned.select(
        F.when(first, F.col("a")).otherwise(F.col("b")).alias("x"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("y"),
        F.greatest("n_a", "n_b").alias("n"), first.alias("kept"),
    )
    block = F.when(F.col("n") > BLOCK_PAIRS, F.pmod(F.xxhash64("y"), F.ceil(F.col("n") / BLOCK_PAIRS))).otherwise(0).cast("long")
    turned = written(turned.select("x", "y", "kept", block.alias("block")), "turned", count)
    heads = turned.select("x", "block").distinct().join(sets.select(F.col("fp").alias("x"), "items"), "x")
    heads = heads.select("x", "block", F.lit(None).cast("binary").alias("y"), F.lit(None).cast("boolean").alias("kept"), "items")
    others = turned.join(sets.select(F.col("fp").alias("y"), "items"), "y").select("x", "block", "y", "kept", "items")
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("shared", pa.int64())])

    def run(batches):
        row = np.empty(0, np.uint64)
        for piece in pieces(batches):
            out = []
            x, y, kept = (piece.column(n).to_pylist() for n in ("x", "y", "kept"))
            items = [np.frombuffer(v.as_buffer(), np.uint64) for v in piece.column("items")]
            borders = [k for k in range(len(y)) if y[k] is None] + [len(y)]
            for start, end in zip([0, *[k + 1 for k in borders[:-1]]], borders):
                block = items[start:end]
                if block:
                    columns = np.concatenate(block)
                    at = np.minimum(np.searchsorted(row, columns), len(row) - 1)
                    owner = np.repeat(np.arange(len(block)), [len(b) for b in block])
                    shared = np.bincount(owner, row[at] == columns, len(block)).astype(np.int64).tolist()
                    out += [(i, j, n) if k else (j, i, n) for i, j, k, n in zip(x[start:end], y[start:end], kept[start:end], shared)]
                if end < len(y):
                    row = items[end].copy()
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)] if out else [pa.array([], f.type) for f in schema], schema=schema)

    both = in_few_parts(heads.unionByName(others).repartition("x", "block"), count, TASK_SETS).sortWithinPartitions("x", "block", "y")
    return both.mapInArrow(run, "a binary, b binary, shared long")


def _linked(documents: DataFrame, width: int, base: int, percent: int, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b of fingerprints) whose overlap reaches the threshold; ``pairs`` has keys, ids and sizes too."""
    sides = [pairs.select(F.col(s).alias("fp"), F.col(f"{s}_key").alias("key"), F.col(f"{s}_id").alias("id")) for s in "ab"]
    sets = written(_wanted_sets(documents, width, base, sides[0].unionAll(sides[1])), "sets")
    found = written(overlaps(pairs.select("a", "b"), sets), "overlaps")
    reached = 100 * F.col("shared") >= percent * (F.col("a_n") + F.col("b_n") - F.col("shared"))
    return pairs.join(found, ["a", "b"]).where(reached).select("a", "b")


def _looked_up(rows: DataFrame, lookup: DataFrame, name: str) -> DataFrame:
    """``rows`` with column ``name``: what ``lookup`` (col, value, both long) says of their col, null if nothing. A lookup of
    up to SENT_PARTS times SENT_COLUMNS goes to the workers in as many parts; a larger one is joined."""
    count = lookup.count()
    if count > SENT_PARTS * SENT_COLUMNS:
        return attached(rows, lookup.withColumnRenamed("value", name), ["col"])
    names, schema = [*rows.columns, name], T.StructType([*rows.schema.fields, T.StructField(name, T.LongType())])
    at, parts = rows.columns.index("col"), parts_for(count, SENT_COLUMNS)
    found = rows.withColumn(name, F.lit(None).cast("long"))
    for k in range(parts):
        some = lookup.where(F.pmod("col", F.lit(parts)) == k).select("col", "value").toArrow()
        keys, values = (some.column(c).to_numpy() for c in ("col", "value"))
        order = np.argsort(keys)
        sent = rows.sparkSession.sparkContext.broadcast((keys[order], values[order]))

        def run(batches, sent=sent):
            known, says = sent.value
            for batch in batches:
                before = batch.column(len(names) - 1)
                if len(known):
                    columns = batch.column(at).to_numpy()
                    place = np.minimum(np.searchsorted(known, columns), len(known) - 1)
                    here = pa.array(says[place], mask=known[place] != columns)
                    before = pc.coalesce(before, here)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], before], names=names)

        found = found.mapInArrow(run, schema)
    return found


def _column_counts(cores: DataFrame) -> DataFrame:
    """(col, rows) of the columns of several cores. Tasks count COUNTED items at a time, so that a column of many cores
    is sent on a few times only."""

    def counted(items):
        columns, rows = np.unique(np.concatenate(items), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(columns), pa.array(rows.astype(np.int64))], names=["col", "rows"])

    def run(batches):
        waiting, size = [], 0
        for piece in pieces(batches, 64):
            waiting += [np.frombuffer(v.as_buffer(), np.int64) for v in piece.column("items")]
            size += sum(len(w) for w in waiting[-piece.num_rows :])
            if size >= COUNTED:
                yield counted(waiting)
                waiting, size = [], 0
        if waiting:
            yield counted(waiting)

    return cores.select("items").mapInArrow(run, "col long, rows long").groupBy("col").agg(F.sum("rows").alias("rows")).where("rows > 1")


def _marked(cores: DataFrame, heavy: DataFrame) -> DataFrame:
    """``cores`` with ``heavy``, a byte for each item that says whether it is a heavy column. These go to the workers in
    parts of bounded size, one pass over a row for each."""
    names, schema = [*cores.columns, "heavy"], T.StructType([*cores.schema.fields, T.StructField("heavy", T.BinaryType())])
    parts = parts_for(heavy.count(), SENT_COLUMNS)
    marked = cores.withColumn("heavy", F.lit(None).cast("binary"))
    for k in range(parts):
        some = heavy.where(F.pmod("col", F.lit(parts)) == k).select("col").toArrow().column("col").to_numpy()
        sent = cores.sparkSession.sparkContext.broadcast(np.sort(some))

        def run(batches, sent=sent):
            known = sent.value
            for piece in pieces(batches):
                masks = []
                for items, mask in zip(piece.column("items"), piece.column("heavy").to_pylist()):
                    columns = np.frombuffer(items.as_buffer(), np.int64)
                    found = known[np.minimum(np.searchsorted(known, columns), len(known) - 1)] == columns if len(known) else np.zeros(len(columns), bool)
                    masks.append((found | np.frombuffer(mask, bool) if mask else found).tobytes())
                yield pa.RecordBatch.from_arrays([*piece.columns[:-1], pa.array(masks, pa.binary())], names=names)

        marked = marked.mapInArrow(run, schema)
    return marked


def _split(marked: DataFrame, percent: int) -> DataFrame:
    """For each row its leading light columns, a row each with its place (``at``) and the first of them (``head``), and, if the heavy ones can reach the threshold by themselves,
    a row with these as ``items`` and their fingerprint ``next``."""
    schema = "core binary, lo long, hi long, least long, first binary, size int, col long, at int, head array<long>, next binary, items binary"
    types = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.binary()]

    def run(batches):
        for piece in pieces(batches):
            out: list[tuple] = []
            fields = (piece.column(n).to_pylist() for n in ("core", "lo", "hi", "least", "first"))
            for *row, items, mask in zip(*fields, piece.column("items"), piece.column("heavy")):
                columns, heavy = np.frombuffer(items.as_buffer(), np.uint64), np.frombuffer(mask.as_buffer(), bool)
                needed = -(-percent * row[3] // 100)
                light = columns[~heavy].view(np.int64)
                leading = light[: len(columns) - needed + 1].tolist()
                out += [(*row, len(columns), c, at, leading[:HEAD], None, None) for at, c in enumerate(leading)]
                left = columns[heavy]
                if len(left) >= needed:
                    out.append((*row, len(left), None, None, None, _print(left), left.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(types)], names=[n.split()[0] for n in schema.split(", ")])

    return marked.mapInArrow(run, schema)


def _across(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b) links that join the components of ``rows`` (fp, n, label, items), as far as pairs of rows that reach
    the threshold have other labels. Not all such pairs, but enough for the components.

    Columns are ordered light ones first: those that few rows have, by exact counts. The first column that two linking
    rows share is among the leading ones of both. If it is light, the pair comes from it. Else all they share is
    heavy; what a row has of heavy columns is its core, and the overlap of two such rows that of their cores. So
    rows with one core are one row of the next incidence, with the size of the smallest, and the smallest links
    to all that it may link to by size. There, what few and many means grows by GROWTH.
    """

    def links(of: Column) -> Column:
        """The most that two sizes may add up to with an overlap."""
        return F.floor(of * (100 + percent) / percent)

    mixed = "not (lo = hi and other_lo = other_hi and lo = other_lo)"
    label = F.xxhash64("label")
    cores = rows.select(
        F.col("fp").alias("core"), F.col("n").cast("int").alias("size"), F.col("n").alias("least"), F.col("fp").alias("first"), label.alias("lo"), label.alias("hi"), "items"
    )
    cores = written(cores, "cores")
    members = cores.select("core", F.col("core").alias("fp"), F.col("least").alias("n"))
    n_members = members.count()
    out = [members.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)]
    few = LIGHT
    while True:
        about = cores.drop("items")
        total, n_cores = cores.agg(F.sum("size"), F.count("*")).first()
        counts = written(_column_counts(cores), "core_counts", total or 0)
        fewest, most, held = (x or 0 for x in counts.agg(F.min("rows"), F.max("rows"), F.sum("rows")).first())
        # without a light column or one of a single row, the next incidence would be this one
        while held == total and few < fewest:
            few *= GROWTH
        split = written(_split(_marked(cores, counts.where(F.col("rows") > few)), percent), "split_cores")
        shared = counts.where(F.col("rows") <= few).select("col")
        leading = split.where("next is null").join(shared, "col", "left_semi").select("col", "core", "lo", "hi", "size", "least", "at", "head")
        other = leading.select("col", *[F.col(c).alias(f"other_{c}") for c in leading.columns if c != "col"])
        # at the first column that two rows share, what both have from there on bounds the overlap
        behind = F.least(F.col("size") - F.col("at"), F.col("other_size") - F.col("other_at"))
        first = F.coalesce(F.get(F.array_intersect("head", "other_head"), F.lit(0)), F.col("col")) == F.col("col")
        pairs = leading.join(other, "col").where(f"core < other_core and {mixed}").where(links(behind) >= F.col("least") + F.col("other_least")).where(first)
        pairs = written(pairs.select(F.col("core").alias("a"), F.col("other_core").alias("b")).distinct(), "core_pairs", n_cores)
        if not pairs.isEmpty():
            found = written(overlaps(pairs, cores.select(F.col("core").alias("fp"), "items")), "core_overlaps")
            for near, far in (("a", "b"), ("b", "a")):
                starred = found.join(about.select(F.col("core").alias(near), "first", "least"), near)
                starred = starred.join(members.select(F.col("core").alias(far), "fp", F.col("n").alias("size")), far)
                out.append(starred.where(F.col("least") + F.col("size") <= links(F.col("shared"))).select(F.col("first").alias("a"), F.col("fp").alias("b")))
        if most <= few:
            break
        smaller = split.where("next is not null")
        best = F.min(F.struct("least", "first"))
        merged = smaller.groupBy("next").agg(F.first("items").alias("items"), F.first("size").alias("size"), best.alias("best"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        merged = written(merged.select(F.col("next").alias("core"), "size", "best.least", "best.first", "lo", "hi", "items"), "merged_cores", n_cores)
        members = attached(members, smaller.select("core", "next"), ["core"]).where("next is not null").select(F.col("next").alias("core"), "fp", "n")
        members = attached(members, merged.select("core", "size"), ["core"]).where(100 * F.col("size") >= percent * F.col("n")).drop("size")
        members = written(members, "core_members", n_members)
        inside = attached(members, merged.where("lo < hi").select("core", "least", "first", "size"), ["core"])
        out.append(inside.where((F.col("fp") != F.col("first")) & (F.col("least") + F.col("n") <= links(F.col("size")))).select(F.col("first").alias("a"), F.col("fp").alias("b")))
        if merged.agg(F.min("lo") < F.max("hi")).first()[0] is not True:
            break
        cores = merged
        few *= GROWTH
    return reduce(DataFrame.unionAll, out).distinct()


def _may_link(x: str, y: str, percent: int, shared: Column) -> Column:
    """Bounds from sizes; a pair that fails can't reach the threshold. ``shared``: light leading columns in
    both; of the heavy ones (h) at most the smaller number is in both."""
    a, b = F.col(f"{x}.n"), F.col(f"{y}.n")
    behind = F.floor((percent * F.greatest(a, b) + 99) / 100) - 1
    most = shared + F.least(f"{x}.h", f"{y}.h") + behind
    differ = reduce(add, (F.bit_count(F.col(f"{x}.{c}").bitwiseXOR(F.col(f"{y}.{c}"))) for c in _PARITIES))
    return (
        (100 * F.least(a, b) >= percent * F.greatest(a, b)) & ((100 + percent) * most >= percent * (a + b))
        & ((100 + percent) * differ <= (100 - percent) * (a + b))
    )


def _pair_columns() -> list[Column]:
    fields = (("fp", ""), ("key", "_key"), ("first_id", "_id"), ("n", "_n"))
    return [F.col(f"{s}.{c}").alias(f"{t}{d}") for s, t in (("x", "a"), ("y", "b")) for c, d in fields]


def _labelled(documents: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame, int]:
    """Rows (doc_id, n, fp), distinct sets (fp, first_id, label), and the base of their hashes; sets with one label
    are a component."""
    base = draw_base()
    documents = documents.select(F.col("doc_id").cast("long"), "text")
    described = written(_described(documents, width, base), "described")
    rows = described.where("chunk is null").select("doc_id", "n", "fp")
    n_rows = described.count()
    info = written(
        described.where("fp is not null").groupBy("fp", "key").agg(
            F.min("doc_id").alias("first_id"), F.max("n").alias("n"), *[F.max(c).alias(c) for c in _PARITIES]
        ),
        "distinct_sets", n_rows,
    )
    postings = written(_postings(documents, width, base, percent, _column_loads(described)), "postings")
    postings = postings.repartition("col")  # for both: the join and the columns' counts take one shuffle
    shared = postings.groupBy("col").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo <> hi").select("col")
    hits = written(postings.join(shared, "col").distinct(), "hits")
    n_hits = hits.count()
    counts = written(hits.groupBy("col").agg(F.count("*").alias("n")), "hit_counts", n_hits)
    marked = written(_looked_up(hits, counts.where(F.col("n") > LIGHT).withColumnRenamed("n", "value"), "rows"), "marked")
    heavy, light = marked.where("rows is not null").select("col", "key"), marked.where("rows is null").select("col", "key")
    pairs = light.alias("l").join(light.alias("r"), "col").where("l.key < r.key").select(F.col("l.key").alias("x"), F.col("r.key").alias("y"), F.lit(1).alias("shared"))

    some_heavy = not heavy.isEmpty()
    if some_heavy:
        weights = heavy.groupBy("key").agg(F.count("*").alias("h"))
        weighed = heavy.join(weights, "key")
        pivots = written(weighed.groupBy("col").agg(F.max(F.struct("h", "key"))["key"].alias("pivot")), "pivots", heavy.count())
        stars = _looked_up(heavy, pivots.withColumnRenamed("pivot", "value"), "pivot").where("key <> pivot")
        pairs = pairs.union(stars.select(F.least("key", "pivot"), F.greatest("key", "pivot"), F.lit(0)))
        sized = written(info.join(weights, "key", "left").fillna(0, ["h"]), "sized_sets", n_rows)
    else:
        sized = info.withColumn("h", F.lit(0))
    pairs = pairs.groupBy("x", "y").agg(F.sum("shared").alias("shared")).alias("p")
    bounded = (
        pairs.join(sized.alias("x"), F.col("p.x") == F.col("x.key")).join(sized.alias("y"), F.col("p.y") == F.col("y.key"))
        .where(_may_link("x", "y", percent, F.col("p.shared"))).select(_pair_columns())
    )
    links = written(_linked(documents, width, base, percent, written(bounded, "bounded", n_hits)), "links", n_hits)
    labels = components(links)

    if some_heavy:
        placed = info.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "key", "first_id", "n", F.coalesce("label", "fp").alias("label"))
        placed = written(placed, "placed", n_rows)
        # a column is settled if all of its rows are in one component
        about = placed.select("key", "n", F.xxhash64("label").alias("label"))
        at_label = written(heavy.join(about, "key"), "at_label", n_hits)
        sides = at_label.groupBy("col").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("rows"))
        open_ = written(sides.where("lo <> hi").select("col", "rows"), "open_columns", n_hits)
        more = []
        medium = at_label.join(open_.where(F.col("rows") <= MANY), "col").select("col", "key", "n", "label")
        other = medium.select("col", *[F.col(c).alias(f"other_{c}") for c in ("key", "n", "label")])
        sizes = (100 * F.least("n", "other_n") >= percent * F.greatest("n", "other_n")) & (F.col("key") < F.col("other_key"))
        crossing = medium.join(other, "col").where((F.col("label") != F.col("other_label")) & sizes).select(F.col("key").alias("x"), F.col("other_key").alias("y")).distinct()
        # a pair that shares light columns has been decided, so these count for none here
        crossing = (
            crossing.alias("p").join(sized.alias("x"), F.col("p.x") == F.col("x.key")).join(sized.alias("y"), F.col("p.y") == F.col("y.key"))
            .where(_may_link("x", "y", percent, F.lit(0))).select(_pair_columns())
        )
        crossing = written(crossing, "crossing", n_hits)
        if not crossing.isEmpty():
            more.append(written(_linked(documents, width, base, percent, crossing), "crossing_links", n_hits))
        large = _looked_up(heavy, open_.where(F.col("rows") > MANY).withColumnRenamed("rows", "value"), "rows").where("rows is not null").select("key").distinct()
        large = written(large.join(placed, "key"), "large", n_rows)
        if n_large := large.count():
            sets = _wanted_sets(documents, width, base, large.select("fp", "key", F.col("first_id").alias("id")))
            sets = in_few_parts(large.select("fp", "n", "label").join(sets, "fp"), n_large, TASK_SETS)
            more.append(written(_across(sets, percent), "across_links", n_large))
        if more := [m for m in more if not m.isEmpty()]:
            # the components so far are stars of their smallest
            labels = components(reduce(DataFrame.unionAll, [labels.toDF("a", "b"), *more]))

    return rows, info.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first_id", F.coalesce("label", "fp").alias("label")), base


def linked_components(documents: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    A document's set holds the distinct ``width``-word shingles of its whole text (all words as one, if
    fewer). Documents link when their sets' overlap is at least ``percent`` hundredths of their union;
    component_id is the smallest doc_id among those reachable. Null and empty texts and texts of white
    space have an empty set, link with nothing and keep their own id. Rows with one doc_id are separate
    documents. A null doc_id links like any other and is never a component's smallest, so a component
    of such rows alone has the id null. An empty table gives an empty one; other columns play no part.
    """
    rows, sets, _ = _labelled(documents, width, percent)
    smallest = sets.groupBy("label").agg(F.min("first_id").alias("component_id"))
    found = sets.join(smallest, "label").select("fp", "component_id")
    return rows.join(found, "fp", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("fp").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def keep_one(documents: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """One document of each component of ``linked_components``, with all its columns: that of the smallest
    doc_id, and only one of equal rows. Documents with an empty set all stay.

    Documents whose doc_id shares no bucket with one that goes, or that comes twice, stay as they are; only the
    others' texts are read again, for their fingerprints, and shuffled to the decision.
    """
    rows, sets, base = _labelled(documents, width, percent)
    order = F.struct(F.col("first_id").isNull(), "first_id", "fp")
    chosen = sets.groupBy("label").agg(F.min(order).alias("first")).select(F.col("first.first_id").alias("id"), F.col("first.fp").alias("fp"))
    chosen = written(chosen, "chosen")
    keys = rows.where("fp is not null").groupBy("doc_id", "fp").count()
    met = keys.alias("k").join(chosen.withColumn("stays", F.lit(True)).alias("c"), (F.col("k.fp") == F.col("c.fp")) & F.col("k.doc_id").eqNullSafe(F.col("c.id")), "left")
    bucket = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(DROPPED_BUCKETS))
    unclear = met.where("stays is null or count > 1").select(bucket.alias("bucket")).distinct()
    unclear = written(unclear.withColumn("unclear", F.lit(True)), "unclear_buckets")

    # the documents' own columns go by position, so that no name of theirs can clash
    own = [f"_{k}" for k in range(len(documents.columns))]
    plain = documents.toDF(*own)
    doc_id, text = (F.col(own[documents.columns.index(c)]) for c in ("doc_id", "text"))
    place = F.pmod(F.xxhash64(doc_id.cast("long")), F.lit(DROPPED_BUCKETS)).alias("bucket")
    dealt = plain.select("*", place).join(F.broadcast(unclear), "bucket", "left")  # DROPPED_BUCKETS rows at most
    clear = dealt.where("unclear is null").select(*own)

    def run(batches):
        for piece in pieces(batches):
            sets = shingle_sets(piece.column(1).cast(pa.binary()).to_pylist(), width, base)
            prints = pa.array([_print(s) if len(s) else None for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([piece.column(0), *piece.columns[2:], piece.column(1), prints], names=names)

    rest = [c for c in own if c not in (own[documents.columns.index("doc_id")], own[documents.columns.index("text")])]
    unsure = dealt.where("unclear").select(doc_id, text, *rest)
    names = [unsure.columns[0], *rest, unsure.columns[1], "fp"]
    schema = T.StructType([*[unsure.schema[n] for n in names[:-1]], T.StructField("fp", T.BinaryType())])
    marked = unsure.mapInArrow(run, schema)
    same = (F.col("m.fp") == F.col("c.fp")) & F.col(f"m.{names[0]}").cast("long").eqNullSafe(F.col("c.id"))
    kept = marked.alias("m").join(chosen.alias("c"), same, "left").where("c.fp is not null or m.fp is null").select("m.*")
    # equal rows of a chosen document: any one of them; a row without fingerprint is alone
    alone = F.when(F.col("fp").isNull(), F.monotonically_increasing_id())
    kept = kept.withColumn("alone", alone).dropDuplicates([names[0], "fp", "alone"])
    return clear.unionByName(kept.select(*own)).toDF(*documents.columns)
