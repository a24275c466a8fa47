"""Approximate nearest neighbours by cosine over a robust-pruned directed graph.

Rows are dealt to shards, each with its own graph over unit vectors. Nodes join in batches: a greedy
beam search over the graph so far proposes a node's neighbours, and relaxed pruning keeps the nearest
of them and those that no kept one is much closer to, so edges point in diverse directions. Edges are
also laid back, and pruned again where a node has too many. At the end nodes that no path leads to are
tied to a near one that can be reached. A query runs a beam search in every shard and scores what it found
in double precision on the original vectors.

Searches start from nodes that are spread by distance, each the farthest from those before it. A dense cluster
gets few of them, and what lies outside many: such a search would otherwise fill its beam with the cluster,
whose nodes are alike in their distance, before it meets a neighbour outside.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillbook.llm.common import pieces, written
from tillbook.llm.vectors import against_all, blocks, ranked, same_width, unpacked, usable

#: Rows of a shard: as many as make SHARDS shards, within these bounds. The upper one is what a task of a few GB holds.
LEAST_SHARD_ROWS, SHARD_ROWS = 4096, 1 << 17
SHARDS = 64
BLOCK_ROWS = 512
#: Tasks that the blocks of queries of one shard are dealt to.
COPIES = 1
DEGREE = 32
#: Further edges of a node, to nodes that nothing else leads to.
TIES = 4
#: Nodes to start from.
ENTRIES = 512
#: Candidates that a search keeps while building, and while answering.
BUILD_BEAM = 48
QUERY_BEAM = 128
#: Searches answered at once.
SEARCHES = 256
#: A candidate goes if a kept neighbour is this many times closer to it than the node is.
RELAXED = 1.2
#: Nodes that join the graph at once, at most; they don't see each other.
BATCH = 512


def _squared(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Squared distances of unit vectors: rows (b, d), others (b, c, d)."""
    return 2 - 2 * np.einsum("bd,bcd->bc", rows, others)


def beam_search(units: np.ndarray, graph: np.ndarray, entries: np.ndarray, asked: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``width`` nearest nodes met (ids and squared distances, nearest first), for many queries at
    once; -1 where fewer were met. ``graph`` has -1 for no edge."""
    n, q = len(units), len(asked)
    ids = np.full((q, width), -1, np.int64)
    far = np.full((q, width), np.inf, np.float32)
    away = 2 - 2 * (asked @ units[entries].T)
    first = np.argpartition(away, width - 1, axis=1)[:, :width] if len(entries) > width else np.broadcast_to(np.arange(len(entries)), away.shape)
    ids[:, : first.shape[1]], far[:, : first.shape[1]] = entries[first], np.take_along_axis(away, first, axis=1)
    known = np.zeros((q, n), bool)
    known[:, entries] = True
    expanded = np.zeros((q, width), bool)
    active = np.arange(q)
    while len(active):
        waiting = np.where(expanded[active] | (ids[active] < 0), np.inf, far[active])
        pick = waiting.argmin(axis=1)
        going = np.isfinite(waiting[np.arange(len(active)), pick])
        active, pick = active[going], pick[going]
        if not len(active):
            break
        expanded[active, pick] = True
        near = graph[ids[active, pick]]
        new = (near >= 0) & ~known[active[:, None], near]
        known[active[:, None], np.where(near >= 0, near, ids[active, pick][:, None])] = True
        distance = np.where(new, _squared(asked[active], units[near]), np.inf).astype(np.float32)
        all_ids = np.concatenate((ids[active], np.where(new, near, -1)), axis=1)
        all_far = np.concatenate((far[active], distance), axis=1)
        all_done = np.concatenate((expanded[active], np.zeros(near.shape, bool)), axis=1)
        keep = np.argpartition(all_far, width - 1, axis=1)[:, :width]
        ids[active], far[active], expanded[active] = (np.take_along_axis(a, keep, axis=1) for a in (all_ids, all_far, all_done))
    order = np.argsort(far, axis=1, kind="stable")
    return np.take_along_axis(ids, order, axis=1), np.take_along_axis(far, order, axis=1)


def robust_prune(units: np.ndarray, nodes: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """At most DEGREE neighbours for each node out of its candidates (-1 for none)."""
    out = np.full((len(nodes), DEGREE), -1, np.int64)
    distance = _squared(units[nodes], units[candidates])
    none = (candidates < 0) | (candidates == nodes[:, None])
    # of a candidate that is there twice one is enough
    by_id = np.argsort(candidates, axis=1, kind="stable")
    sorted_ids = np.take_along_axis(candidates, by_id, axis=1)
    twice = np.zeros(candidates.shape, bool)
    np.put_along_axis(twice, by_id[:, 1:], sorted_ids[:, 1:] == sorted_ids[:, :-1], axis=1)
    distance = np.where(none | twice, np.inf, distance)
    order = np.argsort(distance, axis=1, kind="stable")
    candidates, distance = (np.take_along_axis(a, order, axis=1) for a in (candidates, distance))
    vectors = units[candidates]
    between = 2 - 2 * np.matmul(vectors, vectors.transpose(0, 2, 1))
    open_ = np.isfinite(distance)
    rows = np.arange(len(nodes))
    for slot in range(DEGREE):
        nearest = open_.argmax(axis=1)
        some = open_[rows, nearest]
        if not some.any():
            break
        out[some, slot] = candidates[rows, nearest][some]
        open_[rows, nearest] = False
        open_ &= RELAXED**2 * between[rows, nearest] > distance
    return out


def spread_nodes(units: np.ndarray, count: int) -> np.ndarray:
    """Nodes each of which is the farthest from those before it."""
    found = [0]
    nearest = np.full(len(units), np.inf, np.float32)
    for _ in range(min(count, len(units)) - 1):
        nearest = np.minimum(nearest, 2 - 2 * (units @ units[found[-1]]))
        nearest[found[-1]] = -1
        found.append(int(nearest.argmax()))
    return np.array(found, np.int64)


def reached(graph: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Whether a path leads from the entries to each node."""
    seen = np.zeros(len(graph), bool)
    seen[entries] = True
    while len(entries):
        near = np.unique(graph[entries])
        entries = near[(near >= 0) & ~seen[near]]
        seen[entries] = True
    return seen


def _tied(units: np.ndarray, graph: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The graph with ties to nodes that couldn't be reached, from near ones that can; those for which no near one has a
    tie left are entries too."""
    graph = np.c_[graph, np.full((len(graph), TIES), -1, np.int64)]
    while len(lost := np.flatnonzero(~reached(graph, entries))):
        open_ = lost
        for at in range(0, len(lost), SEARCHES):
            part = lost[at : at + SEARCHES]
            met, _ = beam_search(units, graph, entries, units[part], BUILD_BEAM)
            for node, near in zip(part.tolist(), met.tolist()):
                for other in near:
                    free = np.flatnonzero(graph[other, DEGREE:] < 0) if other >= 0 else ()
                    if len(free):
                        graph[other, DEGREE + free[0]] = node
                        open_ = open_[open_ != node]
                        break
        if len(open_):
            entries = np.r_[entries, open_]
    return graph, entries


def build(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Graph (a row of DEGREE + TIES neighbours for each node, -1 for none) and the nodes to start from. Every node
    can be reached from these."""
    n = len(units)
    graph = np.full((n, DEGREE), -1, np.int64)
    entries = spread_nodes(units, ENTRIES)
    order = np.random.default_rng(8).permutation(n)
    order = np.r_[entries, order[~np.isin(order, entries)]]
    first = order[: max(len(entries), min(n, 4 * DEGREE))]
    near = np.argsort(-(units[first] @ units[first].T), axis=1, kind="stable")[:, : 4 * DEGREE]
    graph[first] = robust_prune(units, first, first[near])
    joined = len(first)
    while joined < n:
        batch = order[joined : joined + min(BATCH, joined)]
        met, _ = beam_search(units, graph, entries, units[batch], BUILD_BEAM)
        graph[batch] = robust_prune(units, batch, met)
        back, source = graph[batch].ravel(), np.repeat(batch, DEGREE)
        back, source = back[back >= 0], source[back >= 0]
        by_target = np.lexsort((-np.einsum("ij,ij->i", units[back], units[source]), back))
        back, source = back[by_target], source[by_target]
        targets, starts, counts = np.unique(back, return_index=True, return_counts=True)
        place = np.arange(len(back)) - np.repeat(starts, counts)
        # a target's new edges, nearest first, are weighed in rounds of a bounded width until none is left:
        # the target joined before these nodes, so its own search can't have found them
        width = 2 * DEGREE
        for low in range(0, int(counts.max(initial=0)), width):
            more = np.flatnonzero(counts > low)
            row = np.searchsorted(more, np.repeat(np.arange(len(targets)), counts))
            fits = (place >= low) & (place < low + width)
            extra = np.full((len(more), min(width, int(counts.max()) - low)), -1, np.int64)
            extra[row[fits], place[fits] - low] = source[fits]
            for at in range(0, len(more), BATCH):
                part, some = slice(at, at + BATCH), targets[more[at : at + BATCH]]
                graph[some] = robust_prune(units, some, np.concatenate((graph[some], extra[part]), axis=1))
        joined += len(batch)
    return _tied(units, graph, entries)


def _lengths(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows by powers of two, so that squares neither overflow nor vanish, and the lengths of these."""
    matrix = np.ldexp(matrix, -np.frexp(np.abs(matrix).max(axis=1, keepdims=True))[1])
    return matrix, np.sqrt((matrix * matrix).sum(axis=1))


def _unit(matrix: np.ndarray) -> np.ndarray:
    scaled, lengths = _lengths(matrix)
    return (scaled / lengths[:, None]).astype(np.float32)


def build_index(vectors: DataFrame, k: int, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """One row per shard with its ids, vectors and graph; every usable row is in it, but that of equal
    vectors only the ``k`` + 1 smallest ids are, as no more can be among the ``k`` nearest."""
    rows = usable(vectors, id_column, vector_column).where(F.exists("vector", lambda x: x != 0))
    copies = Window.partitionBy("vector").orderBy("id")
    kept = rows.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).drop("copy")
    schema = "shard int, ids binary, dims int, vectors binary, node_of binary, graph binary, entries binary"

    def run(batches):
        for batch in pieces(batches, 1):
            shard, ids, dims, matrix = (c[0].as_py() for c in batch.columns)
            _, rows = unpacked(ids, dims, matrix)
            # equal vectors are one node
            distinct, node_of = np.unique(rows, axis=0, return_inverse=True)
            graph, entries = build(_unit(distinct))
            values = [shard, ids, dims, matrix, node_of.astype(np.int64).tobytes(), graph.astype(np.int32).tobytes(), entries.astype(np.int64).tobytes()]
            types = [pa.int32(), pa.binary(), pa.int32(), *[pa.binary()] * 4]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(values, types)], names=["shard", "ids", "dims", "vectors", "node_of", "graph", "entries"]
            )

    # a graph takes far longer than its row is large, so each shard's row is a task's work
    kept = written(kept, "ann_rows")
    shard_rows = min(max(kept.count() // SHARDS, LEAST_SHARD_ROWS), SHARD_ROWS)
    packed = written(blocks(kept, shard_rows), "ann_blocks")
    spread = packed.repartitionByRange(max(1, packed.count()), "block")
    return written(spread.mapInArrow(run, schema), "ann_index")


def search(index: DataFrame, queries: DataFrame, k: int, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` nearest found by cosine, all if there are fewer.

    A row whose id is the query's is no candidate. Rows with null ids, null or zero vectors, or null or
    non-finite components take no part; missing components of shorter vectors count as zero. Equal
    query rows are one query; rows with one id and different vectors are queries of their own. An empty
    index or no query gives an empty table; other columns play no part.
    """
    rows = usable(queries, id_column, vector_column).where(F.exists("vector", lambda x: x != 0))
    asked = blocks(rows.dropDuplicates(["id", "vector"]), BLOCK_ROWS)

    def run(batches):
        for batch in pieces(batches, 1):
            _, ids, dims, matrix, node_of, graph, entries, query_ids, query_dims, query_matrix = (c[0].as_py() for c in batch.columns)
            (ids, own), (query_ids, asked_rows) = unpacked(ids, dims, matrix), unpacked(query_ids, query_dims, query_matrix)
            own, asked_rows = same_width(own, asked_rows)
            node_of = np.frombuffer(node_of, np.int64)
            by_node = np.argsort(node_of, kind="stable")  # ids are ascending within a node
            starts = np.searchsorted(node_of[by_node], np.arange(node_of.max() + 2))
            distinct = own[by_node[starts[:-1]]]
            graph = np.frombuffer(graph, np.int32).reshape(-1, DEGREE + TIES).astype(np.int64)
            units, asked_units, entries = _unit(distinct), _unit(asked_rows), np.frombuffer(entries, np.int64)
            parts = [beam_search(units, graph, entries, asked_units[at : at + SEARCHES], max(QUERY_BEAM, k + 1))[0] for at in range(0, len(asked_units), SEARCHES)]
            met = np.concatenate(parts)
            distinct, lengths = _lengths(distinct)
            scaled, asked_lengths = _lengths(asked_rows)
            out: list[tuple] = []
            for query_id, query, row, length, nodes in zip(query_ids.tolist(), asked_rows, scaled, asked_lengths, met):
                nodes = nodes[nodes >= 0]
                scores = (distinct[nodes] * row).sum(axis=1) / (lengths[nodes] * length)
                found = [(-s, int(i)) for s, v in zip(scores.tolist(), nodes) for i in ids[by_node[starts[v] : starts[v + 1]]] if i != query_id]
                number = zlib.crc32(query.tobytes())
                out += [(query_id, number, i, -s) for s, i in sorted(found)[:k]]
            columns = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [*[pa.int64()] * 3, pa.float64()])], names=["query_id", "query_no", "vec_id", "score"]
            )

    found = against_all(index, asked, COPIES).mapInArrow(run, "query_id long, query_no long, vec_id long, score double")
    return ranked(found, k).select("query_id", "rank", "vec_id", "score")
