"""Pieces against the library, and packings against their bounds."""

import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.fixtures import DOCUMENTS, documents, prose, with_clashes
from tillbook.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, capacity):
    """Sequences are gapless and fit."""
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def fewest(lengths, capacity):
    """The fewest bins, by trying all."""
    lengths = sorted(lengths, reverse=True)
    best = len(lengths)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + lengths[i] <= capacity and bins[k] not in bins[:k]:
                place(i + 1, [*bins[:k], bins[k] + lengths[i], *bins[k + 1 :]])
        place(i + 1, [*bins, lengths[i]])

    place(0, [])
    return best


def test_pieces_equal_the_library(spark):
    choose = random.Random(6)
    texts = [None, "", " \n", "word", prose(choose, 40), prose(choose, 40), prose(choose, 700), "don't <|endoftext|> stop", "x" * 5000]
    ids = [None, 1, 2, 3, 4, 4, 6, 7, 8]
    found = packing.token_pieces(with_clashes(documents(spark, texts, ids)), PATH, capacity=64, end_id=1, with_ids=True).collect()
    library = Tokenizer.from_file(PATH)
    expected = []
    for i, text in zip(ids, texts):
        tokens = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(tokens), 64)):
            part = tokens[at : at + 64]
            expected.append((i, piece, at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part)), part))
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("part_rows", [10_000, 40, 7])
def test_every_piece_is_packed_once(spark, part_rows):
    choose = random.Random(part_rows)
    lengths = [choose.choice((1, 2, 5, 30, 33, 34, 50, 64, 64, choose.randint(1, 64))) for _ in range(500)]
    items = spark.createDataFrame([(i // 2, n, "s") for i, n in enumerate(lengths)], "doc_id long, length long, sequence string")
    rows = packing.pack(items, 64, part_rows).collect()
    assert sorted((r.doc_id, r.length) for r in rows) == sorted((i // 2, n) for i, n in enumerate(lengths))
    used = check(rows, 64)
    bound = packing.lower_bound(np.array(lengths), 64)
    assert bound <= used <= bound + max(1, bound // 50)


def test_hot_length_and_repeated_rows(spark):
    items = spark.createDataFrame([(7, 1366)] * 400 + [(i, 30) for i in range(50)], "doc_id long, length long")
    assert check(packing.pack(items, 4096, 64).collect(), 4096) == 200


def test_bound_is_below_every_packing():
    choose = random.Random(3)
    for _ in range(60):
        lengths = [choose.randint(1, 20) for _ in range(9)]
        bins, offsets, free = packing.best_fit_decreasing(np.array(lengths), 20)
        best = fewest(lengths, 20)
        assert packing.lower_bound(np.array(lengths), 20) <= best <= len(free)
    assert packing.lower_bound(np.array([], np.int64), 20) == 0


def test_bound_sees_what_volume_does_not():
    assert packing.lower_bound(np.array([11] * 8), 20) == 8
    assert packing.lower_bound(np.array([7] * 8), 20) == 4


def test_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], DOCUMENTS), PATH).collect() == []


def test_lengths_out_of_range_fail(spark):
    for bad in (0, 65, None):
        with pytest.raises(Exception, match="lengths must be"):
            packing.pack(spark.createDataFrame([(bad,), (3,)], "length long"), 64).collect()


@pytest.mark.parametrize("low, high", [(1000, 2600), (900, 1500)])
def test_exchange_goes_on_while_it_saves(spark, low, high):
    """Lengths that no partition can pack to its bound."""
    choose = random.Random(low)
    lengths = [choose.randint(low, high) for _ in range(6000)]
    rows = packing.pack(spark.createDataFrame([(n,) for n in lengths], "length long"), 4096, 512).collect()
    assert len(rows) == len(lengths)
    used = check(rows, 4096)
    _, _, free = packing.best_fit_decreasing(np.array(lengths), 4096)
    assert used <= len(free) * 1.01
    assert not all(r.certified for r in rows)


def test_certified_sequences_and_clashing_columns(spark):
    items = spark.createDataFrame([(i, 64, "s", 1, True, 5, "x") for i in range(30)], "doc_id long, length long, _row string, offset long, _open boolean, sequence_id long, _part string")
    rows = packing.pack(items, 64, 8)
    assert rows.columns == ["doc_id", "length", "_row", "_open", "_part", "sequence_id", "offset", "certified"]
    assert all(r.certified and r.offset == 0 and (r._row, r._part) == ("s", "x") for r in rows.collect())
    assert rows.select("sequence_id").distinct().count() == 30
