"""Merkle manifest of a table of documents, with an inclusion proof for each row.

A row's rank in its group becomes a block number and BITS binary digits. Within a block, of 2^BITS rows
at most, the digits are grouped away one after the other, the lowest first: each step nests the structs
of up to two children, and hashes them, in one struct of their parent. The blocks' roots are the rows of
the next level, ranked by their block number, until one root is left for each group; the groups' roots
are hashed likewise. On the way back each block meets the path above it in a group of two rows, and a
transform over its nested structs lists all of its rows with their siblings, which one explode emits.
So neither a group nor a tree is ever in one task, and no proof is joined together.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.llm.common import text_key, written
from tillbook.llm.spread import numbered

#: Binary digits of a rank that are grouped away within a block.
BITS = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_TYPES = {"doc_id": "long", "n_chars": "long"}
#: An entry of a path: a sibling, null if there is none, and whether it stands to the left.
PATH = "array<struct<on_left:boolean,node:string>>"


def hashed_fields(fields: list[Column]) -> Column:
    """SHA-256 in lower-case hex of the fields one after the other: ``-`` for null, else the number of UTF-8
    bytes, a colon, and the value as text."""
    parts = []
    for field in fields:
        text = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _blocks(nodes: DataFrame, group: list[str]) -> DataFrame:
    """A row per block of (group, rank, node, payload): group, block, node, hashed, and its nested ``kids``.

    A single child is hashed too, but for the first at its level, which has no others beside it in the
    whole group and so is the group's root already.
    """
    digits = [f"d{k}" for k in range(BITS)]
    rows = nodes.select(
        *group, F.shiftright("rank", BITS).alias("block"), *[F.shiftright("rank", k).bitwiseAND(1).cast("int").alias(d) for k, d in enumerate(digits)],
        "node", "payload",
    ).repartition(*group, "block")
    inner = ["payload"]
    for k, digit in enumerate(digits):
        above = digits[k + 1 :]
        rows = rows.groupBy(*group, "block", *above).agg(F.sort_array(F.collect_list(F.struct(F.col(digit).alias("digit"), "node", *inner))).alias("kids"))
        place = F.col("block")
        for d in above:
            place = place.bitwiseOR(F.col(d))
        hashed = (F.size("kids") > 1) | (place > 0)
        node = F.when(hashed, F.sha2(F.array_join("kids.node", ""), 256)).otherwise(F.col("kids")[0]["node"])
        rows = rows.select(*group, "block", *above, node.alias("node"), hashed.alias("hashed"), "kids")
        inner = ["hashed", "kids"]
    return rows


def _rolled_up(nodes: DataFrame, group: list[str], name: str) -> list[DataFrame]:
    """The blocks of each level, up to one block for each group."""
    levels = []
    while True:
        levels.append(written(_blocks(nodes, group), name))
        if not levels[-1].agg(F.max("block")).first()[0]:
            return levels
        nodes = levels[-1].select(*group, F.col("block").alias("rank"), "node", F.struct(F.col("block").alias("rank")).alias("payload"))


def _listed(kids: Column, hashed: Column, path: Column, depth: int) -> Column:
    """Payload and path of each row below ``kids``, whose parent has ``path``."""

    def one(kid: Column) -> Column:
        sibling = F.struct((kid["digit"] == 1).alias("on_left"), F.get(kids, 1 - kid["digit"])["node"].alias("node"))
        here = F.concat(F.when(hashed, F.array(sibling)).otherwise(F.array().cast(PATH)), path)
        if depth == 0:
            return F.array(F.struct(kid["payload"].alias("payload"), here.alias("path")))
        return _listed(kid["kids"], kid["hashed"], here, depth - 1)

    return F.flatten(F.transform(kids, one))


def _unrolled(levels: list[DataFrame], group: list[str], paths: DataFrame) -> DataFrame:
    """(group, payload, path, above) of all rows below the levels. ``paths``: group, block, path, and the struct ``above``
    that all rows below take over."""
    for blocks in reversed(levels):
        both = blocks.select(*group, "block", "hashed", "kids").unionByName(paths.select(*group, "block", "path", "above"), allowMissingColumns=True)
        met = both.groupBy(*group, "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("hashed", "kids", "path", "above")])
        rows = met.select(*group, "above", F.explode(_listed(F.col("kids"), F.col("hashed"), F.col("path"), BITS - 1)).alias("row"))
        rows = rows.select(*group, "row.payload", "row.path", "above")
        paths = rows.withColumn("block", F.col("payload.rank"))
    return paths.drop("block")


def proofs(leaves: DataFrame, group: str, order: str, keep: list[str]) -> DataFrame:
    """``leaves`` with columns group, order, ``leaf`` and ``keep``: each row's keep, leaf, subroot, root and path.

    Leaves of a group ascend by ``order``, nulls first, equal ones by digest; groups ascend bytewise, null first.
    """
    ranked = numbered(leaves.select(group, order, "leaf", *[k for k in keep if k not in (group, order)]), [group], [order, "leaf"], "rank", "leaves")
    nodes = ranked.select(group, "rank", F.col("leaf").alias("node"), F.struct("rank", "leaf", *keep).alias("payload"))
    levels = _rolled_up(nodes, [group], "blocks")
    subroots = numbered(levels[-1].select(group, "node"), [], [group], "rank", "subroots")
    tops = _rolled_up(subroots.select("rank", "node", F.struct("rank", F.col(group).alias("group"), "node").alias("payload")), [], "top_blocks")
    nothing = F.array().cast(PATH)
    root = tops[-1].select("block", nothing.alias("path"), F.struct(F.col("node").alias("root")).alias("above"))
    above = F.struct(F.col("payload.node").alias("subroot"), F.col("above.root").alias("root"))
    tops = _unrolled(tops, [], root).select(F.col("payload.group").alias(group), F.lit(0).cast("long").alias("block"), "path", above.alias("above"))
    found = _unrolled(levels, [group], tops)
    return found.select(*[F.col(f"payload.{k}").alias(k) for k in keep], "payload.leaf", "above.subroot", "above.root", "path")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""

    def step(node: Column, entry: Column) -> Column:
        sibling = entry["node"]
        both = F.when(sibling.isNull(), node).when(entry["on_left"], F.concat(sibling, node)).otherwise(F.concat(node, sibling))
        return F.sha2(both, 256)

    return F.aggregate(path, leaf, step)


def proof_digest(path: Column) -> Column:
    """SHA-256 over the siblings of a path, from the leaf's to the root's."""
    return F.sha2(F.array_join(F.transform(path, lambda entry: entry["node"]), ""), 256)


def manifest(documents: DataFrame, tampered: Column, changed: dict[str, Column]) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, path (its siblings up to the root), changed_leaf and
    folded_root, the root that follows from the path when ``changed`` replaces columns of the rows that are
    ``tampered`` (a condition on the documents' columns).

    Nulls in any column are hashed as such; a null lang is a group of its own, the first, and a null doc_id
    comes before all others. Rows with one doc_id follow by their digests, so that only repeated rows are
    interchangeable, and each has its own leaf. Empty and very long texts are texts like any other. An empty
    table has no rows, and so no root; other columns play no part.
    """
    plain = {f: F.col(f).cast(_TYPES.get(f, "string")) for f in FIELDS}
    other = F.when(tampered, hashed_fields([changed.get(f, plain[f]) for f in FIELDS]))
    leaves = documents.select(plain["lang"].alias("lang"), plain["doc_id"].alias("doc_id"), hashed_fields([plain[f] for f in FIELDS]).alias("leaf"), other.alias("other"))
    found = proofs(leaves, "lang", "doc_id", ["doc_id", "other"])
    changed_leaf = F.coalesce("other", "leaf")
    return found.select("doc_id", "leaf", "subroot", "root", "path", changed_leaf.alias("changed_leaf"), folded(changed_leaf, F.col("path")).alias("folded_root"))


def audit(documents: DataFrame, every: int = 7) -> DataFrame:
    """The manifest checked against documents of which one in ``every``, by crc32 of doc_id, has one character
    more in n_chars: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    tampered = text_key("doc_id") % every == 0
    found = manifest(documents, tampered, {"n_chars": F.col("n_chars").cast("long") + 1})
    return found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
