"""Prefix trie of conversations, and subtree totals by parallel tree contraction.

Turns get their positions by a sort by range, so that a conversation of any length spans many tasks.
Each prefix of a conversation gets a SHA-256 key: turns are chained in blocks of BLOCK, the block ends
are keyed as sequences of their own, level by level, and a key joins the key of the blocks before with
the chain inside the block. Equal prefixes have equal keys, and groups of equal keys are the trie's nodes.

Totals over subtrees come from contraction. Every round is a few joins over the nodes still active:
rake takes off all leaves and adds what they hold to their parents; compress takes nodes of unary
chains out, those with the smallest hash among themselves, their parent and their child, so that no
two neighbours go at once. A node that is taken out leaves its amount on the edge from its child to
its parent. Rounds grow with the logarithm of the number of nodes, also for a single long chain. At the
end the rounds are gone through backwards: a node that was taken out has its child's total and what
lay between.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.llm.common import written
from tillbook.llm.spread import attached, numbered

#: Turns that are chained one after the other in a task.
BLOCK = 128
#: Ids that are joined to one text before a hash runs over the texts.
IDS = 4096
#: The most turns that a conversation takes over from its base.
HEAD = 9
#: Rounds that are gone through backwards in one plan; each doubles it.
UNWOUND = 2
_ID = ["conv_id", "depth"]


def _turns(messages: DataFrame) -> DataFrame:
    """(conv_id, at, digest, bytes): position and digest of each turn, without its text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat_ws(":", F.octet_length(role).cast("string"), F.concat(role, text)).cast("binary"), 256))
    turns = messages.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"),
        F.substring(text, 1, 64).alias("start"), digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes"),
    )
    return numbered(turns, ["conv_id"], ["turn", "role", "start", "digest"], "at", "turns").select("conv_id", "at", "digest", "bytes")


def rebuilt(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, turns) and their rebuilt turns (conv_id, at, digest, bytes).

    Conversation c begins with the first h turns of conversation c - c % 5, all if there are fewer and
    none if there is no such conversation, and goes on with its own after the first h; h is crc32 of c in
    decimals modulo 9.
    """
    own = written(_turns(messages), "numbered_turns")
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD).alias("taken")
    sizes = own.groupBy("conv_id").agg(F.count("*").alias("n"))
    conversations = sizes.select("conv_id", "n", taken, (F.col("conv_id") - F.col("conv_id") % 5).alias("base"))
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    conversations = conversations.join(bases, "base", "left").withColumn("copied", F.least("taken", F.coalesce("base_n", F.lit(0))))
    conversations = written(
        conversations.select(
            "conv_id", "base", "taken", "copied", (F.col("copied") + F.greatest(F.col("n") - F.col("taken"), F.lit(0))).alias("turns")
        ),
        "conversations",
    )
    heads = own.where(F.col("at") < HEAD - 1).withColumnRenamed("conv_id", "base")
    copies = conversations.join(heads, "base").where("at < taken").select("conv_id", "at", "digest", "bytes")
    tails = own.withColumn("taken", taken).where("at >= taken")
    # the place in the rebuilt conversation differs from that in the own one only after a short base
    short = conversations.where("copied < taken").select("conv_id", (F.col("taken") - F.col("copied")).alias("missing"))
    tails = attached(tails, short, ["conv_id"])
    tails = tails.select("conv_id", (F.col("at") - F.coalesce("missing", F.lit(0))).alias("at"), "digest", "bytes")
    return conversations.select("conv_id", "turns"), copies.unionByName(tails)


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each block's items up to here and up to the one before; rows come sorted."""
    at, state = None, None
    for batch in batches:
        here, before = [], []
        for key in zip(batch.column("conv_id").to_pylist(), batch.column("block").to_pylist(), batch.column("digest").to_pylist()):
            if key[:2] != at:
                at, state = key[:2], None
            before.append(state)
            state = hashlib.sha256((state or b"") + key[2]).digest()
            here.append(state)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(here, pa.binary()), pa.array(before, pa.binary())], names=[*batch.schema.names, "chain", "before"]
        )


def _hashed(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[F.coalesce(p, F.lit(b"")) for p in parts]), 256))


def prefix_keys(items: DataFrame, longest: int) -> DataFrame:
    """``items`` (conv_id, at, digest, and more) with the key of the prefix that ends here and of the one before,
    which is null at the start. ``longest``: the largest number of items of a conversation.

    A task chains a block of at most BLOCK items, and the block's end is an item of the next level.
    """
    placed = items.withColumn("block", F.floor(F.col("at") / BLOCK))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in placed.schema) + ", chain binary, before binary"
    chained = placed.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "at").mapInArrow(_chained, schema)
    if longest <= BLOCK:
        return chained.select(*items.columns, _hashed(F.col("chain")).alias("key"), F.when(F.col("at") > 0, _hashed(F.col("before"))).alias("parent_key"))
    chained = written(chained, "chains")
    ends = chained.where(F.col("at") % BLOCK == BLOCK - 1).select("conv_id", F.col("block").alias("at"), F.col("chain").alias("digest"))
    upper = prefix_keys(ends, -(-longest // BLOCK))
    # what the next block needs: the key of all blocks up to this one, and that of this one's last item
    passed = upper.select("conv_id", (F.col("at") + 1).alias("block"), F.col("key").alias("blocks"), _hashed(F.col("parent_key"), F.col("digest")).alias("last"))
    found = chained.join(passed, ["conv_id", "block"], "left")
    inside = _hashed(F.col("blocks"), F.col("before"))
    return found.select(
        *items.columns, _hashed(F.col("blocks"), F.col("chain")).alias("key"), F.when(F.col("before").isNotNull(), inside).otherwise(F.col("last")).alias("parent_key")
    )


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ids of each node in texts of bounded length, each with its first id."""
    names = ["depth", "key", "first", "ids"]
    at, ids = None, []
    for batch in batches:
        out = []
        for depth, key, conv_id in zip(*(batch.column(c).to_pylist() for c in ("depth", "key", "conv_id"))):
            if (depth, key) != at or len(ids) == IDS:
                if ids:
                    out.append((*at, ids[0], ",".join(map(str, ids))))
                at, ids = (depth, key), []
            ids.append(conv_id)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.binary(), pa.int64(), pa.string()))], names=names)
    if ids:
        last = (*at, ids[0], ",".join(map(str, ids)))
        yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(last, (pa.int64(), pa.binary(), pa.int64(), pa.string()))], names=names)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over each node's texts, one text in memory at a time."""
    at, state = None, None
    for batch in batches:
        out = []
        for depth, key, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "key", "ids"))):
            if (depth, key) == at:
                state.update(b",")
            else:
                if at:
                    out.append((*at, state.hexdigest()))
                at, state = (depth, key), hashlib.sha256()
            state.update(ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.binary(), pa.string()))], names=["depth", "key", "ends_sha256"])
    if at:
        yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip((*at, state.hexdigest()), (pa.int64(), pa.binary(), pa.string()))], names=["depth", "key", "ends_sha256"])


def _ends(rows: DataFrame) -> DataFrame:
    """(depth, key, ends_sha256) of the nodes where conversations end. Ids are sorted by range, so that those of a
    common node are listed by many tasks; only the lists meet."""
    last = rows.groupBy("conv_id").agg(F.max(F.struct("depth", "key")).alias("end")).select("conv_id", "end.depth", "end.key")
    by_node = ["depth", "key", "conv_id"]
    lists = last.repartitionByRange(*by_node).sortWithinPartitions(*by_node).mapInArrow(_listed, "depth long, key binary, first long, ids string")
    lists = lists.repartition("depth", "key").sortWithinPartitions("depth", "key", "first")
    return lists.mapInArrow(_digested, "depth long, key binary, ends_sha256 string")



def subtree_totals(nodes: DataFrame, amounts: list[str]) -> DataFrame:
    """(conv_id, depth, and the sums of ``amounts`` over each node's subtree, itself included).

    ``nodes``: conv_id, depth, parent_conv_id (null: a root), n_children and the amounts, as long. A node's
    parent is (parent_conv_id, depth - 1); a depth is unique for a conv_id.
    """
    edge = [f"edge_{a}" for a in amounts]
    state = nodes.select(*_ID, F.col("parent_conv_id").alias("up"), (F.col("depth") - 1).alias("up_depth"), (F.col("n_children") == 0).alias("leaf"), *amounts, *[F.lit(0).cast("long").alias(e) for e in edge])
    gone, taken_out = [state.where("leaf").select(*_ID, *amounts)], []
    round_ = 0
    while True:
        passed = [F.sum(F.when(F.col("leaf"), F.col(a) + F.col(e)).otherwise(0)).alias(f"raked_{a}") for a, e in zip(amounts, edge)]
        open_child = F.when(~F.col("leaf"), F.struct(F.col("conv_id").alias("child"), F.col("depth").alias("child_depth"), *edge))
        raked = (
            state.where("up is not null").groupBy(F.col("up").alias("conv_id"), F.col("up_depth").alias("depth"))
            .agg(*passed, F.count(open_child).alias("open"), F.min(open_child).alias("only"))
        )
        left = state.where("not leaf").join(raked, _ID, "left")

        def drawn(conv: str, depth: str) -> Column:
            return F.xxhash64(F.col(conv), F.col(depth), F.lit(round_))

        first = (drawn(*_ID) < drawn("only.child", "only.child_depth")) & (drawn(*_ID) < drawn("up", "up_depth"))
        left = written(
            left.select(
                *_ID, "up", "up_depth", (F.coalesce("open", F.lit(0)) == 0).alias("leaf"),
                *[(F.col(a) + F.coalesce(f"raked_{a}", F.lit(0))).alias(a) for a in amounts], *edge, "only",
                F.coalesce((F.col("open") == 1) & F.col("up").isNotNull() & first, F.lit(False)).alias("out"),
            ),
            "contracted",
        )
        gone.append(left.where("leaf").select(*_ID, *amounts))
        out = left.where("out")
        taken_out.append(
            out.select(*_ID, "only.child", "only.child_depth", *[(F.col(a) + F.col(f"only.{e}")).alias(a) for a, e in zip(amounts, edge)])
        )
        bridges = out.select(
            F.col("only.child").alias("conv_id"), F.col("only.child_depth").alias("depth"), F.col("up").alias("new_up"), F.col("up_depth").alias("new_depth"),
            *[(F.col(a) + F.col(e)).alias(f"new_{a}") for a, e in zip(amounts, edge)],
        )
        state = left.where("not out").join(bridges, _ID, "left").select(
            *_ID, F.coalesce("new_up", "up").alias("up"), F.when(F.col("new_up").isNull(), F.col("up_depth")).otherwise(F.col("new_depth")).alias("up_depth"),
            "leaf", *amounts, *[(F.col(e) + F.coalesce(f"new_{a}", F.lit(0))).alias(e) for a, e in zip(amounts, edge)],
        )
        round_ += 1
        if left.where("not leaf").isEmpty():
            break

    totals = gone.pop()
    while taken_out:
        later = totals.select(F.col("conv_id").alias("child"), F.col("depth").alias("child_depth"), *[F.col(a).alias(f"below_{a}") for a in amounts])
        found = taken_out.pop().join(later, ["child", "child_depth"]).select(*_ID, *[(F.col(a) + F.col(f"below_{a}")).alias(a) for a in amounts])
        totals = totals.unionByName(found).unionByName(gone.pop())
        if len(taken_out) % UNWOUND == 0 and taken_out:
            totals = written(totals, "unwound")
    return totals


def build(messages: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: conv_id (its smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256, all of the node's whole subtree where they are sums.

    ``messages``: conv_id, turn, role, text. Turns are ordered by turn, nulls first; equal ones by role, the
    first 64 characters of the text, and the digest of both, so that only repeated rows are interchangeable, and
    these count each. Null roles and texts are empty ones. Rows without conv_id belong to no conversation and
    take no part. A conversation that is left without turns ends at the root. An empty table has no nodes;
    other columns play no part.
    """
    conversations, turns = rebuilt(messages)
    longest = conversations.agg(F.max("turns")).first()[0] or 0
    keyed = prefix_keys(turns, longest).select("conv_id", (F.col("at") + 1).alias("depth"), "key", F.coalesce("parent_key", F.lit(b"")).alias("parent_key"), "bytes")
    roots = conversations.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(b"").alias("key"), F.lit(None).cast("binary").alias("parent_key"), F.lit(0).cast("long").alias("bytes"))
    rows = written(keyed.unionByName(roots), "prefixes")
    grouped = written(
        rows.groupBy("depth", "key").agg(
            F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("parent_key").alias("parent_key"), F.max("bytes").alias("bytes")
        ),
        "nodes",
    )
    parents = grouped.select((F.col("depth") + 1).alias("depth"), F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    nodes = attached(grouped, parents, ["depth", "parent_key"])
    children = grouped.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent_key").alias("key")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, ["depth", "key"], "left").join(_ends(rows), ["depth", "key"], "left")
    nodes = written(
        nodes.select(
            *_ID, "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
            F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"),
            F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"),
        ),
        "linked_nodes",
    )
    totals = subtree_totals(nodes, ["n_leaves", "saved_tokens"])
    return nodes.drop("n_leaves", "saved_tokens").join(totals, _ID).select(
        *_ID, "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )
