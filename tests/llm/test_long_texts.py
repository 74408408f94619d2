"""Very long words and runs of white space through the encoders."""

import random
import time

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from topic_tables.llm import bpe, token_files

PATH, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
TOK = Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(4)
    letters = "".join(rng.choices("etaoinshrdlu", k=200_000))
    return [letters, "a" * 200_000, "\n" * 1_000_000, " " * 1_000_000, "x" + " " * 400_000 + "\n" * 600_001 + "y", "a \n" + "\n" * 30_000 + " b" + "\t" * 25_000, "é日" * 20_000]


def expected(text):
    return TOK.encode(text, add_special_tokens=False).ids


def test_queue_equals_rounds(monkeypatch):
    rng = random.Random(5)
    words = ["".join(rng.choices(alphabet, k=rng.randint(1, 60))).encode() for alphabet in ("ab", "the", "aaab", "é日the", "0123") for _ in range(60)]
    b = bpe.ByteBpe(PATH)
    flat, counts = b.merge_words(words)
    monkeypatch.setattr(bpe, "LONG", 0)
    again, n = b.merge_words(words)
    assert (flat == again).all() and (counts == n).all()


def test_long_words_equal_the_library_in_bounded_time():
    b, start = bpe.codec(PATH), time.time()
    for text in texts():
        ids, counts = b.encode([text])
        assert ids.tolist() == expected(text)
        assert b.decode(ids.astype(np.int64), counts) == [text]
    assert time.time() - start < 60


def test_token_files_of_long_runs(spark):
    rows = [(i, t) for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = dict(map(tuple, token_files.count_tokens(df, RANKS).collect()))
    assert got == {i: len(expected(t)) for i, t in rows}


@pytest.mark.parametrize("name", ["pii", "mixing", "bpe"])
def test_pipeline_stages_take_long_runs(spark, name):
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts()[:5] + ["some plain words of a text"])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert dict(P.STAGES)[name](spark, docs, "").count() >= 1
