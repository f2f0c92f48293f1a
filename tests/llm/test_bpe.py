"""Encoding and decoding against the library the file is made for."""

import random

import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from mirrorwell.llm import bpe, queries
from tests.fixtures import DATA

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = bpe.Encoder(PATH)
SPECIAL = ["<|startoftext|>", "<|endoftext|>"]


def encoded(encoder, texts):
    ids, ends = encoder.encode(texts)
    return [ids[a:b].tolist() for a, b in zip(ends, ends[1:])]


def expected(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=600, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=12), st.sampled_from([*SPECIAL, " ", "\n", "'s", "'LL", "ΑΣ ", "İ", "é",
                                                                  "\x85", "\x1c", " ", "́", "１２", "don't"])), max_size=8))
def test_any_unicode(parts):
    texts = ["".join(parts), *parts, None]
    assert encoded(ENCODER, texts) == [expected(t) for t in texts]


@pytest.mark.parametrize("seed", range(4))
def test_long_words(seed):
    """No white space at all: one word of thousands of symbols, few and many letters."""
    pick = random.Random(seed)
    letters = ["a", "ab", "theinro", "aeiouthsrnldé日本"][seed]
    words = ["".join(pick.choice(letters) for _ in range(size)) for size in (1, 2, 5, 9, 64, 511, 513, 1024, 30_000)]
    assert encoded(ENCODER, words) == [expected(w) for w in words]


def test_leftmost_lowest():
    tree = bpe.RankTree([5, 3, 7, 3, 9])
    assert (tree.least, tree.leftmost()) == (3, 1)
    tree.put(1, 8)
    assert (tree.least, tree.leftmost()) == (3, 3)
    tree.put(3, bpe._NEVER)
    assert (tree.least, tree.leftmost()) == (5, 0)
    for leaf in range(5):
        tree.put(leaf, bpe._NEVER)
    assert tree.least == bpe._NEVER


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY_UNITS", 3)
    monkeypatch.setattr(bpe, "STRETCH", 10)
    small = bpe.Encoder(PATH)
    for texts in ([" ".join(f"word{i} again" for i in range(20))], ["a b", "c d\x1ce"], ["e f"]):
        assert encoded(small, texts) == [expected(t) for t in texts]
    assert len(small.units) <= 3


def test_rows(spark):
    """Null, empty, repeated and very long texts, and columns called as the operator's own."""
    texts = [None, "", "Hello  World", "Hello  World", " \n", "<|endoftext|>x", "so on and on " * 60_000]
    rows = [(i if i else None, t, "mine", 7) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, names int")
    out = bpe.decode_ids(bpe.encode_texts(docs, PATH), PATH).collect()
    assert len(out) == len(texts) and {r.names for r in out} == {7}
    for row, text in zip(sorted(out, key=lambda r: r.doc_id or 0), texts):
        assert row.text == text and row.ids == expected(text)
        assert row.decoded == LIBRARY.decode(row.ids, skip_special_tokens=False)
    empty = spark.createDataFrame([], docs.schema)
    assert bpe.decode_ids(bpe.encode_texts(empty, PATH), PATH).count() == 0


def test_odd_ids(spark):
    rows = [(1, [49407, None, 0, 99_999, -1]), (2, None), (3, [])]
    out = bpe.decode_ids(spark.createDataFrame(rows, "doc_id long, ids array<int>"), PATH).collect()
    assert [r.decoded for r in out] == ["<|endoftext|> !", "", ""]


def test_long_ids(spark):
    """Numbers beyond an int do not come round to a token's, and a column may be called like one of ours."""
    rows = [(1, [0, (1 << 32) + 1, None, 1, -(1 << 40)], 5)]
    out = bpe.decode_ids(spark.createDataFrame(rows, "i long, `my.ids` array<long>, Decoded int"), PATH, "my.ids")
    assert out.columns == ["i", "my.ids", "decoded"]
    assert out.first().decoded == "! \""


def test_decoding_needs_no_python_worker(spark):
    docs = spark.createDataFrame([(1, [0])], "doc_id long, ids array<int>")
    plan = bpe.decode_ids(docs, PATH)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "Python" not in plan


def test_wide_rows_are_encoded_a_few_at_a_time():
    texts = pa.array([f"{'so on and on ' * 16_000}{i}" for i in range(40)])
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    out = list(bpe._encoded(PATH, "text", ["text", "ids"])(iter([batch])))
    assert sum(len(b) for b in out) == 40
    assert max(len(b) for b in out) * len(texts[0].as_py()) < 2 << 20


def test_query_is_the_library(spark):
    import hashlib

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()}
    found = queries.op13_bpe(spark, DATA).collect()
    assert len(found) == len(texts)
    for row in found:
        ids = expected(texts[row.doc_id])
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
