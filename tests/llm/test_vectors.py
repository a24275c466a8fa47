"""Exact top-k against brute force, and the graph search's recall."""

import math

import numpy as np
import pytest

from tillbook.llm import ann, topk, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x") for i, v in rows], SCHEMA)


def unusable():
    return [(900, None), (901, [1.0, None, 2.0]), (902, [float("nan"), 1.0, 1.0]), (903, [float("inf"), 0.0, 0.0]), (None, [1.0, 2.0, 3.0])]


def clustered(n, dims, seed):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(12, dims))
    rows = centres[random.integers(0, 12, n)] + 0.6 * random.normal(size=(n, dims))
    return (rows / np.linalg.norm(rows, axis=1, keepdims=True)).astype(np.float32)


def exact(rows, query_ids, k, scale=64.0):
    out = []
    usable = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for q, v in usable:
        if q in query_ids:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q)
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("n, shard_rows", [(300, 16384), (300, 70), (9, 16384), (1, 16384)])
def test_top_k_equals_brute_force(spark, monkeypatch, n, shard_rows):
    monkeypatch.setattr(topk, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 16)
    rows = [(i, v.tolist()) for i, v in enumerate(clustered(n, 16, 1))]
    rows += [(1000 + i, rows[0][1]) for i in range(120 if n > 100 else 0)] + [(2000, [0.0] * 16), (2020, [])] + unusable()
    df = table(spark, rows)
    found = topk.search(df, df.where("vec_id % 20 = 0"), 20, 64.0).collect()
    ids = {i for i, _ in rows if i is not None and i % 20 == 0}
    # a vector without components has a score of 0 with all others
    rows = [(i, [0.0] * 16 if v == [] else v) for i, v in rows]
    assert sorted(map(tuple, found)) == exact(rows, ids, 20)


def test_top_k_of_large_values(spark):
    rows = [(i, [float(np.float32(2 ** (i % 30))), -float(np.float32(3 ** (i % 19)))]) for i in range(60)]
    df = table(spark, rows)
    assert sorted(map(tuple, topk.search(df, df.where("vec_id % 20 = 0"), 5, 64.0).collect())) == exact(rows, {0, 20, 40}, 5)


def test_repeated_rows(spark):
    df = table(spark, [(0, [1.0, 0.0])] * 3 + [(1, [1.0, 0.5])] * 2)
    assert [tuple(r) for r in topk.search(df, df.where("vec_id = 0"), 3, 64.0).orderBy("rank").collect()] == [(0, 1, 1, 4096), (0, 2, 1, 4096)]


def nearest(rows, query_ids, k):
    matrix = np.array([v for _, v in rows], np.float64)
    ids = np.array([i for i, _ in rows])
    units = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    out = {}
    for q in query_ids:
        scores = units @ units[int(np.flatnonzero(ids == q)[0])]
        order = [int(i) for i in np.lexsort((ids, -scores)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(scores[i])) for i in order]
    return out


@pytest.mark.parametrize("shard_rows", [4096, 500])
def test_graph_search_recall(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(ann, "SHARD_ROWS", shard_rows)
    rows = [(i, v.tolist()) for i, v in enumerate(clustered(2000, 32, 2))]
    df = table(spark, rows + [(3000, [0.0] * 32), *unusable()])
    index = ann.build_index(df, 5)
    found = ann.search(index, df.where("vec_id % 20 = 0"), 5).collect()
    expected = nearest(rows, [i for i, _ in rows if i % 20 == 0], 5)
    by_query = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        by_query.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert by_query.keys() == expected.keys()
    hits = 0
    for q, got in by_query.items():
        assert [r for r, _, _ in got] == [1, 2, 3, 4, 5]
        assert all(a[2] >= b[2] for a, b in zip(got, got[1:]))
        known = dict(rows)
        for _, i, score in got:
            a, b = np.array(known[q]), np.array(known[i])
            assert score == pytest.approx(a @ b / math.sqrt((a @ a) * (b @ b)), abs=1e-14)
        hits += len({i for _, i, _ in got} & {i for i, _ in expected[q]})
    assert hits / (5 * len(expected)) >= 0.95


def test_every_row_is_in_the_index(spark):
    rows = [(i, v.tolist()) for i, v in enumerate(clustered(500, 8, 3))]
    kept = ann.build_index(table(spark, rows), 5).collect()
    ids = np.concatenate([np.frombuffer(bytes(r.ids), np.int64) for r in kept])
    assert sorted(ids) == list(range(500))


def test_hot_vector_and_ties(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(400)] + [(1000 + i, [2.0, 1.0, float(i)]) for i in range(30)]
    df = table(spark, rows)
    found = ann.search(ann.build_index(df, 5), df.where("vec_id in (0, 3, 1000)"), 5).orderBy("query_id", "rank").collect()
    assert [r.vec_id for r in found if r.query_id == 0] == [1, 2, 3, 4, 5]
    assert [r.vec_id for r in found if r.query_id == 3] == [0, 1, 2, 4, 5]
    assert [(r.vec_id, r.rank) for r in found if r.query_id == 1000][0] == (1001, 1)


def test_few_and_no_rows(spark):
    two = table(spark, [(0, [1.0, 0.0]), (7, [1.0, 1.0])])
    assert [(r.query_id, r.rank, r.vec_id) for r in ann.search(ann.build_index(two, 5), two.where("vec_id = 0"), 5).collect()] == [(0, 1, 7)]
    none = table(spark, unusable())
    assert ann.search(ann.build_index(none, 5), two, 5).collect() == []
    assert ann.search(ann.build_index(two, 5), none, 5).collect() == []
    assert topk.search(none, none, 5, 64.0).collect() == []


def test_blocks_spread_equal_rows(spark):
    rows = vectors.usable(table(spark, [(5, [1.0, 2.0])] * 1000))
    sizes = [len(bytes(r.ids)) // 8 for r in vectors.blocks(rows, 100).collect()]
    assert sum(sizes) == 1000 and max(sizes) < 200


def test_every_back_edge_is_weighed(monkeypatch):
    """Nodes in the middle of a dense cluster get more new edges from a batch than one round takes."""
    random = np.random.default_rng(3)
    rows = np.r_[0.02 * random.normal(size=(60, 24)), 0.5 * random.normal(size=(2500, 24))] + 1
    units = (rows / np.linalg.norm(rows, axis=1, keepdims=True)).astype(np.float32)
    prune, due, most = ann.robust_prune, set(), [0]

    def spied(units, nodes, candidates):
        seen = {(int(t), int(c)) for t, cs in zip(nodes, candidates) for c in cs}
        due.difference_update(seen)
        out = prune(units, nodes, candidates)
        if not spied.joined.issuperset(nodes.tolist()):
            assert not due
            spied.joined.update(nodes.tolist())
            if len(spied.joined) > len(nodes):
                due.update((int(t), int(k)) for k, ts in zip(nodes, out) for t in ts if t >= 0)
                most[0] = max(most[0], int(np.unique(out[out >= 0], return_counts=True)[1].max()))
        return out

    spied.joined = set()
    monkeypatch.setattr(ann, "robust_prune", spied)
    ann.build(units)
    assert not due and most[0] > 2 * ann.DEGREE


@pytest.mark.parametrize("dims", [1, 16, 64, 300])
@pytest.mark.parametrize("scale", [1.0, 1e3, 1e5, 1e6])
def test_shards_are_exact_at_every_scale(dims, scale):
    """Equal to whole-number products of all rows, ties included."""
    random = np.random.default_rng(dims)
    rows = np.floor(64 * scale * random.normal(size=(1500, dims)))
    rows[700:720] = rows[5]
    rows[:, dims // 2] = 3
    shard = topk.Shard(np.arange(1500) * 3, rows)
    whole = rows.astype(np.int64)
    for q in [*range(0, 40), 705]:
        scores = whole @ whole[q]
        order = [int(i) for i in np.lexsort((np.arange(1500), -scores)) if i != q][:20]
        ids, found, _ = shard.search(rows[q], 3 * q, 20)
        assert ids.tolist() == [3 * i for i in order] and found.tolist() == scores[order].tolist()


def test_scores_beyond_doubles_and_longs():
    random = np.random.default_rng(1)
    for scale in (2.0**27, 2.0**29, 2.0**45, 2.0**61):
        rows = np.floor(scale * random.uniform(-1, 1, size=(300, 3)))
        shard = topk.Shard(np.arange(300), rows)
        for q in range(10):
            exact_ = [min(max(sum(int(a) * int(b) for a, b in zip(row, rows[q])), -(2**63)), 2**63 - 1) for row in rows]
            order = sorted((i for i in range(300) if i != q), key=lambda i: (-exact_[i], i))[:7]
            ids, found, _ = shard.search(rows[q], q, 7)
            assert ids.tolist() == order and found.tolist() == [exact_[i] for i in order]


def test_postings_rule_out_most_rows():
    """Near rows are proven to be the best before most of the postings are processed."""
    rows = np.floor(64 * clustered(4000, 32, 7).astype(float))
    shard = topk.Shard(np.arange(4000), rows)
    scored = [shard.search(rows[q], q, 20)[2] for q in range(0, 4000, 100)]
    assert max(scored) <= topk.POSSIBLE * 4000


def recall_of(rows, k=5, step=17):
    """Recall of every step-th row's nearest by a single graph, by row."""
    units = ann._unit(rows)
    graph, entries = ann.build(units)
    assert ann.reached(graph, entries).all()
    asked = np.arange(0, len(rows), step)
    met, _ = ann.beam_search(units, graph, entries, units[asked], ann.QUERY_BEAM)
    exact_units = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    scores = exact_units[asked] @ exact_units.T
    scores[np.arange(len(asked)), asked] = -np.inf
    truth = np.argsort(-scores, axis=1, kind="stable")[:, :k]
    # what a search meets is scored in double precision
    got = [sorted((v for v in row if v >= 0 and v != q), key=lambda v: -of[v])[:k] for row, q, of in zip(met.tolist(), asked.tolist(), scores)]
    return asked, np.array([len(set(a) & set(b)) / k for a, b in zip(got, truth.tolist())])


@pytest.mark.parametrize("share, spread", [(0.5, 0.002), (0.5, 0.02), (0.5, 0.2), (0.9, 0.02), (0.9, 0.2)])
def test_recall_inside_and_outside_a_dense_cluster(share, spread):
    random = np.random.default_rng(int(spread * 1000))
    n, dims = 4096, 64
    inside = random.random(n) < share
    rows = np.where(inside[:, None], random.normal(size=dims) + spread * random.normal(size=(n, dims)), random.normal(size=(n, dims)))
    asked, recall = recall_of(rows)
    assert recall[inside[asked]].mean() >= 0.95
    assert recall[~inside[asked]].mean() >= 0.95


def test_lost_nodes_are_tied_to_near_ones():
    random = np.random.default_rng(5)
    units = ann._unit(random.normal(size=(400, 12)))
    graph = np.full((400, ann.DEGREE), -1, np.int64)
    graph[:200, 0] = np.roll(np.arange(200), 1)
    tied, entries = ann._tied(units, graph, np.array([0]))
    assert ann.reached(tied, entries).all() and (tied[:, : ann.DEGREE] == graph).all()


def test_scores_of_extreme_vectors(spark):
    rows = [(0, [1e200, 1e200]), (1, [1e200, 0.0]), (2, [1e-200, 1e-200]), (3, [1.0, 1.0])]
    df = spark.createDataFrame([(i, v) for i, v in rows], "vec_id long, embedding array<double>")
    found = ann.search(ann.build_index(df, 5), df.where("vec_id = 0"), 5).orderBy("rank").collect()
    assert [(r.vec_id, round(r.score, 12)) for r in found] == [(2, 1.0), (3, 1.0), (1, round(math.sqrt(0.5), 12))]
