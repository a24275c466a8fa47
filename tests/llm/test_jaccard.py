"""Components against brute force over all pairs."""

import random
import re

import numpy as np
import pytest

from tests.llm.fixtures import DOCUMENTS, documents, prose, with_clashes
from tillbook.llm import graph, jaccard
from tillbook.llm.graph import components
from tillbook.llm.shingles import BUFFER, LONG, draw_base, shingle_sets

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute_force(rows, width=4, percent=85):
    sets = [shingles(t, width) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[m][0] for m in range(len(rows)) if label[m] == label[k] and rows[m][0] is not None]
        out.append((i, len(sets[k]), min(ids) if sets[k] and ids else i))
    return sorted(out, key=repr)


def edited(choose, text, edits):
    words = text.split()
    for _ in range(edits):
        words[choose.randrange(len(words))] = f"w{choose.randrange(10**6)}"
    return " ".join(words)


def corpus(seed):
    """Copies, near copies at every distance, a chain, a passage that many share, and odd texts."""
    choose = random.Random(seed)
    passage = prose(choose, 30)
    bases = [" ".join(f"v{choose.randrange(400)}" for _ in range(choose.randint(5, 160))) for _ in range(25)]
    texts = [None, "", " \n\t", "one", "One", "one two three", "one two three four", "ONE two\tthree\nfour", "a b c d e", "a\x1cb c d e"]
    for base in bases:
        texts += [base, base.upper(), base + " "] + [edited(choose, base, k) for k in (1, 1, 2, 3, 5, 8)]
        texts.append(passage + " " + base)
    chain = bases[0]
    for _ in range(8):
        chain = edited(choose, chain, 2)
        texts.append(chain)
    texts += [passage, passage + " end"] * 3 + [edited(choose, passage, k % 4) for k in range(90)]
    ids = list(range(len(texts)))
    choose.shuffle(ids)
    return list(zip(ids, texts))


@pytest.mark.parametrize("light, percent", [(32, 85), (2, 85), (3, 60)])
def test_equals_brute_force(spark, monkeypatch, light, percent):
    monkeypatch.setattr(jaccard, "LIGHT", light)
    monkeypatch.setattr(jaccard, "MANY", 5 if light == 3 else 40)
    rows = corpus(light)
    rows += [(None, rows[20][1]), (None, None), (None, "only here and never with an id"), rows[30], (rows[31][0], rows[60][1])]
    df = with_clashes(documents(spark, [t for _, t in rows], [i for i, _ in rows]))
    found = jaccard.linked_components(df, 4, percent).collect()
    assert sorted(map(tuple, found), key=repr) == brute_force(rows, 4, percent)


def test_one_of_each_component_stays(spark):
    rows = corpus(5)
    rows += [(None, "a text without an id at all"), (None, "a text without an id at all"), rows[40], rows[40]]
    df = with_clashes(documents(spark, [t for _, t in rows], [i for i, _ in rows]))
    kept = jaccard.keep_one(df)
    assert kept.columns == df.columns
    expected = [i for i, n, c in brute_force(rows) if i is not None and c == i and n]
    none = [r for r in brute_force(rows) if r[1] == 0]
    found = kept.collect()
    assert sorted(r.doc_id for r in found if r.doc_id is not None and shingles(r.text, 4)) == sorted(set(expected))
    assert sum(not shingles(r.text, 4) for r in found) == len(none)
    assert sum(r.doc_id is None for r in found) == 1


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCUMENTS)
    assert jaccard.linked_components(none).collect() == []
    assert jaccard.keep_one(none).collect() == []


def test_long_texts_are_hashed_in_parts():
    choose = np.random.default_rng(1)
    words = [f"w{n}".encode() for n in choose.integers(0, 5000, 400_000)]
    text = b" ".join(words)
    assert len(text) > 2 * BUFFER
    (parts,) = shingle_sets([text], 4)
    assert len(parts) == len({tuple(words[i : i + 4]) for i in range(len(words) - 3)})
    short = b" ".join(words[:50])
    assert set(next(shingle_sets([short], 4))) <= set(parts)
    assert len(next(shingle_sets([b"x" * (3 * BUFFER)], 4))) == 1


def test_components(spark):
    links = [(1, 2), (2, 1), (3, 2), (5, 5), (9, 8), (8, 7), (20, 10)] + [(100 + i, 101 + i) for i in range(40)]
    found = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert found == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7, 10: 10, 20: 10} | {100 + i: 100 for i in range(41)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def thue_morse(letters):
    text = "a"
    while len(text) < letters:
        text += text.translate(str.maketrans("ab", "ba"))
    return text, text.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("letters", [1024, 4096, 65536])
def test_words_made_to_collide(spark, letters):
    """Polynomials over two to a power can't tell these words apart, whatever their base."""
    a, b = thue_morse(letters)
    rows = [(1, a), (2, b), (3, f"{a} x y z"), (4, f"{b} x y z"), (5, a), (6, f"one two three {a} four"), (7, f"one two three {b} four")]
    for base in (draw_base(), draw_base()):
        assert len({int(next(shingle_sets([t.encode()], 4, base))[0]) for t in (a, b)}) == 2
    df = documents(spark, [t for _, t in rows], [i for i, _ in rows])
    assert sorted(map(tuple, jaccard.linked_components(df).collect())) == brute_force(rows)


def test_hashes_are_those_of_the_polynomial():
    base, prime = draw_base(), 2**61 - 1
    words = ["a", "é", "word", "\x00\x01", "x" * LONG, "x" * (LONG - 1) + "y", "\xff" * 2000]
    from tillbook.llm.shingles import lowered_words, mix

    for text in ([" ".join(words).encode()], [w.encode() for w in words]):
        found = np.concatenate([h for _, _, _, h, _ in lowered_words(text, base)])
        values = []
        for word in (w.encode() for w in words):
            value = len(word)
            for k in range(0, len(word), 7):
                value = (value * base + int.from_bytes(word[k : k + 7], "little")) % prime
            values.append(value)
        assert found.tolist() == mix(np.array(values, np.uint64)).tolist()


@pytest.mark.parametrize("light, growth", [(2, 2), (16, 8)])
def test_a_passage_with_other_words_around_it(spark, monkeypatch, light, growth):
    """Rows that share a column with many others and link with few of them: by size, by words of their own, or not."""
    monkeypatch.setattr(jaccard, "LIGHT", light)
    monkeypatch.setattr(jaccard, "GROWTH", growth)
    monkeypatch.setattr(jaccard, "MANY", light)
    choose = random.Random(light)
    passage = [f"p{k}" for k in range(60)]
    other = passage[:40] + [f"q{k}" for k in range(25)]
    rows = []
    for i in range(160):
        base = choose.choice((passage, passage, other))
        own = [f"o{i}_{k}" for k in range(choose.choice((0, 2, 5, 6, 7, 9, 14)))]
        rows.append(base[choose.randrange(4) :] + own)
    for i in range(40):
        rows.append(rows[choose.randrange(160)][: -1 - choose.randrange(2)])
    rows = [(i, " ".join(words)) for i, words in enumerate(rows)]
    for percent in (85, 70):
        found = jaccard.linked_components(documents(spark, [t for _, t in rows], [i for i, _ in rows]), 4, percent).collect()
        assert sorted(map(tuple, found), key=repr) == brute_force(rows, 4, percent)


def test_overlaps_of_rows_with_many_pairs(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_PAIRS", 5)
    choose = np.random.default_rng(2)
    sets = {bytes([k]): np.unique(choose.integers(0, 200, choose.integers(1, 90))).astype(np.uint64) for k in range(60)}
    pairs = [(a, b) for a in sets for b in sets if a < b and (a == bytes([3]) or b == bytes([7]) or choose.random() < 0.05)]
    found = jaccard.overlaps(
        spark.createDataFrame(pairs, "a binary, b binary"), spark.createDataFrame([(k, v.tobytes()) for k, v in sets.items()], "fp binary, items binary")
    )
    got = sorted((bytes(r.a), bytes(r.b), r.shared) for r in found.collect())
    assert got == sorted((a, b, len(np.intersect1d(sets[a], sets[b]))) for a, b in pairs)


@pytest.mark.parametrize("sent, parts", [(1 << 20, 4), (3, 4), (3, 1)])
def test_lookups_in_parts(spark, monkeypatch, sent, parts):
    monkeypatch.setattr(jaccard, "SENT_COLUMNS", sent)
    monkeypatch.setattr(jaccard, "SENT_PARTS", parts)
    lookup = {c: 10 * c for c in range(-5, 5)}
    rows = spark.createDataFrame([(c, str(c)) for c in [*range(-9, 9), 3, 3]], "col long, name string")
    found = jaccard._looked_up(rows, spark.createDataFrame([*lookup.items()], "col long, value long"), "said")
    assert sorted((r.col, r.name, r.said) for r in found.collect()) == sorted([(c, str(c), lookup.get(c)) for c in [*range(-9, 9), 3, 3]])
    none = spark.createDataFrame([], "col long, value long")
    assert {r.said for r in jaccard._looked_up(rows, none, "said").collect()} == {None}
    cores = spark.createDataFrame([(b"x", np.arange(-9, 9).astype(np.int64).tobytes())], "core binary, items binary")
    masks = jaccard._marked(cores, spark.createDataFrame([(c,) for c in lookup], "col long")).collect()
    assert np.frombuffer(bytes(masks[0].heavy), bool).tolist() == [c in lookup for c in range(-9, 9)]


@pytest.mark.parametrize("task_links, steps", [(1 << 16, 2), (7, 100)])
def test_components_of_few_links_need_no_rounds(spark, monkeypatch, task_links, steps):
    choose = random.Random(task_links)
    links = [(choose.randrange(60), choose.randrange(60)) for _ in range(40)] + [(200 - i, 199 - i) for i in range(50)]
    label = {x: x for link in links for x in link}
    for a, b in links * len(links):
        label[a] = label[b] = min(label[a], label[b])
    done = []
    monkeypatch.setattr(graph, "TASK_LINKS", task_links)
    monkeypatch.setattr(graph, "cut", lambda df, cut=graph.cut: done.append(1) or cut(df))
    found = sorted(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert found == sorted((x, label[x]) for x in linked)
    assert len(done) <= steps


def test_small_results_are_written_in_few_files(spark, monkeypatch):
    """However many partitions the session's shuffles have: files and tasks grow with the rows."""
    files = {}

    def kept(df, name, *rows, written=jaccard.written):
        out = written(df, name, *rows)
        files[name] = max(files.get(name, 0), len(out.inputFiles()))
        return out

    monkeypatch.setattr(jaccard, "written", kept)
    monkeypatch.setattr(jaccard, "MANY", 20)
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    rows = corpus(7)
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = jaccard.linked_components(documents(spark, [t for _, t in rows], [i for i, _ in rows])).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(map(tuple, found), key=repr) == brute_force(rows)
    assert {"distinct_sets", "bounded", "links", "placed", "at_label", "large", "merged_cores"} <= set(files)
    assert {n: k for n, k in files.items() if k > 8 and n != "hits"} == {}


def test_cores_are_read_and_counted_once(spark, monkeypatch):
    """The incidence of heavy columns takes its rows, which come from texts, a single time; a column's count doesn't
    send a row for each of its cores."""
    read, common = spark.sparkContext.accumulator(0), list(range(1000, 1100))
    sets = [np.array([*common, *range(9000 + 10 * i, 9000 + 10 * i + i % 7)], np.uint64) for i in range(200)]
    rows = [(f"{i:03}".encode(), len(s), f"{i:03}".encode(), s.tobytes()) for i, s in enumerate(sets)]
    schema = "fp binary, n long, label binary, items binary"

    def run(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    links = jaccard._across(spark.createDataFrame(rows, schema).mapInArrow(run, schema), 85).collect()
    assert read.value == len(rows)
    label = {bytes(r[0]): {bytes(r[0])} for r in rows}
    for a, b in ((bytes(x.a), bytes(x.b)) for x in links):
        both = label[a] | label[b]
        label.update(dict.fromkeys(both, both))
    assert len(label[rows[0][0]]) == len(rows)

    sent, cores = [], spark.createDataFrame(rows, schema).coalesce(1)
    monkeypatch.setattr(type(cores), "groupBy", lambda df, *c, f=type(cores).groupBy: sent.append(df) or f(df, *c))
    counts = dict(map(tuple, jaccard._column_counts(cores).collect()))
    assert counts == dict.fromkeys(common, len(rows))
    assert sent[0].count() == len({int(c) for s in sets for c in s})


def test_a_pair_of_cores_comes_from_one_column(spark, monkeypatch):
    """Rows that share many leading columns make one pair for all of these."""
    monkeypatch.setattr(jaccard, "LIGHT", 100)
    sets = [np.array([*range(1000, 1100), 9000 + i], np.uint64) for i in range(40)]
    rows = [(f"{i:03}".encode(), len(s), f"{i:03}".encode(), s.tobytes()) for i, s in enumerate(sets)]
    df = spark.createDataFrame(rows, "fp binary, n long, label binary, items binary")
    seen, distinct = [], type(df).distinct
    monkeypatch.setattr(type(df), "distinct", lambda df: seen.append(df) or distinct(df))
    links = {(bytes(r.a), bytes(r.b)) for r in jaccard._across(df, 85).collect()}
    assert seen[0].columns == ["a", "b"] and seen[0].count() == len(sets) * (len(sets) - 1) // 2
    assert len({frozenset(x) for x in links if x[0] != x[1]}) == len(sets) * (len(sets) - 1) // 2
