import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from topic_tables.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOK = Tokenizer.from_file(PATH)
PIECES = ["a", "aaaa", " ", "  ", "\n", "<|endoftext|>", "é", "日本", "🎉", "'s", "123", "!!", "\x00", "\xa0", "ab" * 50]


def expected(text):
    return TOK.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=60), st.lists(st.sampled_from(PIECES)).map("".join)), max_size=6))
def test_encode_equals_library(texts):
    b = bpe.codec(PATH)
    ids, counts = b.encode(texts)
    parts = np.split(ids, np.cumsum(counts)[:-1]) if texts else []
    assert [p.tolist() for p in parts] == [expected(t) for t in texts]
    assert b.decode(ids.astype(np.int64), counts) == [TOK.decode(expected(t), skip_special_tokens=False) for t in texts]


def test_specials_as_plain_text():
    b = bpe.codec(PATH)
    ids, _ = b.encode(["x<|endoftext|>y"], special=False)
    assert 50256 not in ids.tolist()
    assert b.decode(ids.astype(np.int64), np.array([len(ids)])) == ["x<|endoftext|>y"]


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    b = bpe.ByteBpe(PATH)
    for text in ["one two three four", "five six", "one two"]:
        assert b.encode([text])[0].tolist() == expected(text)


def test_frame(spark):
    long = "word " * 50_000 + "<|endoftext|>" + "x" * 30_000
    rows = [(1, "", "a"), (2, None, "b"), (3, long, None), (3, long, None), (None, "café  au lait", "c")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    got = sorted(map(tuple, bpe.digests(bpe.decode(bpe.encode(df, PATH), PATH)).collect()), key=str)
    want = []
    for i, t, _ in rows:
        ids = expected(t)
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert sorted(map(tuple, bpe.digests(bpe.round_trip(df, PATH)).collect()), key=str) == got


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert bpe.digests(bpe.decode(bpe.encode(df, PATH), PATH)).count() == 0


@pytest.mark.parametrize("ids", [None, []])
def test_decode_nothing(spark, ids):
    df = spark.createDataFrame([(1, ids)], "doc_id bigint, ids array<int>")
    assert bpe.decode(df, PATH).collect()[0]["decoded"] == ""
