import math
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest

from topic_tables.llm import langid as L
from topic_tables.llm.text import fold

PATH = public_tokenizers.path("piece_bpe_32k.model")


def all_segmentations(word, prob, known):
    """Sum over all segmentations, by definition."""
    @lru_cache(None)
    def total(i):
        if i == len(word):
            return 1.0
        out = 0.0
        for j in range(i + 1, len(word) + 1):
            p = known.get(word[i:j])
            if p is not None:
                out += prob[p] * total(j)
            elif j == i + 1:
                out += L.FLOOR * total(j)
        return out
    return total(0)


def test_forward_sums_all_segmentations():
    lat = L.lattice(PATH)
    known = {p: i for i, p in enumerate(L.pieces(PATH)) if p}
    rng = np.random.default_rng(1)
    prob = np.zeros((lat.size + 2, 2))
    prob[:lat.size] = rng.random((lat.size, 2)) / lat.size
    prob[-1] = L.FLOOR
    words = ["the", "a", "ciónado", "日本語", "zzzqx", "überall", "the"]
    got = lat.score(words, prob)
    for k in range(2):
        want = [math.log(all_segmentations("▁" + w, prob[:, k], known)) for w in words]
        assert got[:, k] == pytest.approx(want)


def test_long_words_are_summed_over_all_segmentations():
    """In logarithms against exact arithmetic, also across the change of form."""
    from fractions import Fraction
    lat = L.lattice(PATH)
    known = {p: i for i, p in enumerate(L.pieces(PATH)) if p}
    rng = np.random.default_rng(2)
    prob = np.zeros((lat.size + 2, 2))
    prob[:lat.size] = rng.random((lat.size, 2)) / lat.size
    prob[-1] = L.FLOOR
    words = ["".join(rng.choice(list("etaoinshr語q"), n)) for n in (10, 38, 39, 40, 41, 81, 500)] + ["the" * 40]
    got = lat.score(words, prob)
    for k in range(2):
        for w, log in zip(words, got[:, k]):
            marked, total = "▁" + w, [Fraction(1)]
            for j in range(1, len(w) + 2):
                total.append(sum(total[i] * Fraction(prob[known[marked[i:j]], k] if marked[i:j] in known else (L.FLOOR if j - i == 1 else 0))
                                 for i in range(max(0, j - lat.longest), j)))
            want = total[-1]
            bits = want.denominator.bit_length() - want.numerator.bit_length()
            assert log == pytest.approx(math.log(want * 2 ** bits) - bits * math.log(2), abs=1e-7)


def test_long_words_count_in_the_fit(monkeypatch):
    """The two forms of the sums give the same probabilities."""
    lat = L.lattice(PATH)
    words, n = ["the", "thing", "internationalisation", "then" * 3], np.array([5, 2, 3, 1])
    plain = lat.fit(words, n)
    monkeypatch.setattr(L, "LONG", 2)
    assert lat.fit(words, n) == pytest.approx(plain, rel=1e-9, abs=1e-15)
    monkeypatch.undo()
    long = lat.fit(["a" * 45 + "über"], np.array([1]))
    assert sum(long[i] for i, p in enumerate(L.pieces(PATH)) if p and p in "über") > 1e-3


def test_long_words_stay_finite():
    lat = L.lattice(PATH)
    prob = np.full((lat.size + 2, 1), L.FLOOR)
    prob[lat.size] = 0
    assert np.isfinite(lat.score(["語" * 5000, "x" * 100_000], prob)).all()


def test_fit_raises_likelihood():
    lat = L.lattice(PATH)
    words, n = ["the", "thing", "other", "then"], np.array([5, 2, 3, 1])
    scores = []
    for rounds in (1, 2, 5):
        prob = np.zeros((lat.size + 2, 1))
        prob[:lat.size, 0] = lat.fit(words, n, rounds)
        prob[-1] = L.FLOOR
        scores.append(float(n @ lat.score(words, prob)[:, 0]))
    assert scores == sorted(scores)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = L.fit(docs, PATH, fold("doc_id", 4) != 2)
    got = {r["doc_id"]: r for r in L.predict(docs, model, PATH).collect()}
    truth = docs.where(fold("doc_id", 4) == 2).select("doc_id", "lang").collect()
    assert len(got) == docs.count() and len(truth) > 200
    assert sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in truth) >= 0.99 * len(truth)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_edges(spark):
    train = [(i, f"hello there friend number {'abc'[i % 3]} the of and", "en") for i in range(8)]
    train += [(20 + i, "guten tag mein freund und der die das", "de") for i in range(8)] + [(40, "nothing", None)]
    rows = [(100, None, None), (101, "", "xx"), (102, "123 !!! ___ ²", "en"), (103, "the friend " * 30_000, None), (103, "the friend " * 30_000, None),
            (None, "der freund", None)]
    schema = "doc_id bigint, text string, lang string, score int, lang_pred int, id string"
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in train + rows], schema)
    model = L.fit(df, PATH, fold("doc_id", 4) != 100)
    assert sorted(r["lang"] for r in model.collect()) == ["de", "en"] or "xx" not in {r["lang"] for r in model.collect()}
    got = L.predict(df, model, PATH).collect()
    assert len(got) == len(train) + len(rows)
    by = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got}
    assert by[100] == by[101] == by[102] == (L.UND, 0.0)
    assert by[103][0] == "en" and by[None][0] == "de"


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "abc", None)], "doc_id bigint, text string, lang string")
    model = L.fit(df, PATH, fold("doc_id", 4) != 2)
    assert [(r["lang_pred"], r["score"]) for r in L.predict(df, model, PATH).collect()] == [(L.UND, 0.0)]
    assert L.predict(df.limit(0), model, PATH).count() == 0
