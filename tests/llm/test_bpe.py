"""Encoding against the vocabulary's own library, and the round trip."""

import hashlib
import random
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.fixtures import DOCUMENTS, documents, with_clashes
from tillbook.llm import batch_bpe, bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " \t\n", "Hello world's it'll <|endoftext|>x<|startoftext|> y", "a\x1cb \x1d", "ΑΣ ΑΣΑ İstanbul ǅ", "été café", "x y​z　q",
    "½²Ⅷ ٣", "日本語テスト 한국어", "😀😀 👩‍👩‍👧", "_a_b__ ''s 's'S '", "</w> <w> x</w>y", "\x00\x01\x7f\x85", "<|endoftext|", "<|ENDOFTEXT|>", "İ I ı ß ẞ", "Á K",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts() -> list[str]:
    choose = random.Random(9)
    letters = ["".join(choose.choices("aeinorstlhd", k=choose.randint(1, 40))) for _ in range(3000)]
    signs = ["".join(choose.choices("!?.,-=*#'\"$%&@ ab1", k=choose.randint(1, 40))) for _ in range(1000)]
    wide = ["".join(chr(choose.choice((choose.randint(1, 0x24F), choose.randint(0x370, 0x52F), choose.randint(0x4E00, 0x9000)))) for _ in range(12)) for _ in range(1000)]
    return ODD + letters + signs + wide + ["the " * 5000 + "a" * 20000]


def test_trie_equals_the_library(library):
    data = texts()
    plain, batch = bpe.Encoder(PATH), batch_bpe.TrieEncoder(PATH)
    for text, ids, (same, decoded) in zip(data, plain.encode(data), batch.round_trip([t.encode() for t in data])):
        expected = library.encode(text, add_special_tokens=False).ids
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == expected, text[:50]
        assert same == ids
        assert decoded.decode() == library.decode(expected, skip_special_tokens=False) == plain.decode(ids)


def test_merging_equals_the_trie():
    data = [t.encode() for t in texts()]
    assert batch_bpe.BatchEncoder(PATH).encode(data) == batch_bpe.TrieEncoder(PATH).encode(data)
    assert batch_bpe.BatchEncoder(PATH).encode([None, b"", b" "]) == [b"", b"", b""]


def test_encoders_start_anew_when_full(monkeypatch):
    data = texts()[20:1500]
    expected = bpe.Encoder(PATH).encode(data)
    for module, names in ((bpe, ("KEPT_WORDS", "KEPT_PREFIXES", "KEPT_CHUNKS")), (batch_bpe, ("KEPT_WORDS", "KEPT_CHUNKS"))):
        for name in names:
            monkeypatch.setattr(module, name, 50)
    for small in (bpe.Encoder(PATH), batch_bpe.BatchEncoder(PATH), batch_bpe.TrieEncoder(PATH)):
        assert [small.encode([t if isinstance(small, bpe.Encoder) else t.encode()])[0] for t in data] == expected


def test_query_columns(spark, library):
    data = [None, *ODD, ODD[2]]
    ids = [None, *range(len(ODD)), 2]
    rows = batch_bpe.token_digests(with_clashes(documents(spark, data, ids)), PATH).collect()
    assert len(rows) == len(data)
    expected = []
    for i, text in zip(ids, data):
        found = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(found, skip_special_tokens=False)
        packed = struct.pack(f"<{len(found)}I", *found)
        expected.append((i, len(found), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(tuple, rows), key=repr) == sorted(expected, key=repr)


def test_ids_and_texts(spark, library):
    row = batch_bpe.encode_documents(documents(spark, [ODD[2]]), PATH).first()
    assert row.ids == library.encode(ODD[2], add_special_tokens=False).ids
    assert batch_bpe.encode_documents(spark.createDataFrame([], DOCUMENTS), PATH).collect() == []


def thue_morse(letters):
    text = "a"
    while len(text) < letters:
        text += text.translate(str.maketrans("ab", "ba"))
    return text, text.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("letters", [1024, 4096, 65536])
def test_words_made_to_collide(library, letters):
    a, b = thue_morse(letters)
    data = [a, b, f"the {a} and", f"the {b} and", "usual words"]
    for encoder in (batch_bpe.BatchEncoder(PATH), batch_bpe.TrieEncoder(PATH)):
        for texts_ in ([[t] for t in data], [data]):
            found = [ids for part in texts_ for ids in encoder.encode([t.encode() for t in part])]
            for text, ids in zip(data, found):
                assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == library.encode(text, add_special_tokens=False).ids


def test_equal_hashes_do_not_mix_words(library, monkeypatch):
    """With a hash that has two values only, bytes decide."""
    real = batch_bpe.lowered_words

    def poor(texts_):
        for buffer, starts, ends, hashes, borders in real(texts_):
            yield buffer, starts, ends, hashes % 2, borders

    monkeypatch.setattr(batch_bpe, "lowered_words", poor)
    monkeypatch.setattr(batch_bpe, "COMPARED", 100)
    data = texts()[:2000] + ["x" * 5000, "x" * 5000, "y" * 5000]
    encoder = batch_bpe.BatchEncoder(PATH)
    expected = [library.encode(t, add_special_tokens=False).ids for t in data]
    assert [list(struct.unpack(f"<{len(i) // 4}I", i)) for i in encoder.encode([t.encode() for t in data])] == expected


def test_encoders_start_anew_by_bytes(monkeypatch):
    monkeypatch.setattr(batch_bpe, "KEPT_BYTES", 1000)
    data = [t.encode() for t in texts()[20:600]]
    small = batch_bpe.TrieEncoder(PATH)
    assert [small.encode([t])[0] for t in data] == bpe.Encoder(PATH).encode([t.decode() for t in data])
