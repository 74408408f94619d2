"""Documents stay rows: their tokens are cut, counted and looked up in lists, and
the model is fitted on the lists that the bags are kept as."""

import numpy as np
import pyarrow as pa
import pytest

from topic_tables import build_corpus, fit_plsa, fit_robust_plsa
from topic_tables.functions.tokens import coded_tokens
from topic_tables.operators import em, vocab as V
from topic_tables.operators.phi_files import Rows
from topic_tables.plans import catalog
from topic_tables.sources.tables import tokens_from_text

TEXTS = ["The cat, the CAT", None, "", "  ", "L'été à 東京 2024: Straße_über", "İstanbul ΟΔΟΣ ΟΔΟΣ. ΑΣΑ", "—word— word…", "١٢ ½ x² Ⅷ", "áb a_b é É",
         "ends", "starts", "🙂🙂", "null\x00byte\n\ttab", "ﬁ Ǆ ǅ ẞ", "word"]


def _texts(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id bigint, text string")
    return tokens_from_text(df, "id", "text")


def test_tokens_of_a_column_are_those_of_the_expression(spark):
    want = {r["row_id"]: list(r["tokens"]) for r in _texts(spark).collect()}
    for column in (pa.array(TEXTS, pa.string()), pa.array(["x y"] + TEXTS, pa.string()).slice(1), pa.array(TEXTS, pa.large_string())):
        doc, codes, distinct = coded_tokens(column)
        assert len(set(distinct.to_pylist())) == len(distinct)
        got = {i: [] for i in range(len(TEXTS))}
        for d, c in zip(doc.tolist(), codes.tolist()):
            got[d].append(distinct[c].as_py())
        assert got == want
    for none in ([], [None], ["", "?!"]):
        assert len(coded_tokens(pa.array(none, pa.string()))[0]) == 0


def test_a_row_a_document_is_written(spark, monkeypatch):
    docs, plans, cut, write = _texts(spark), {}, V.cut_lineage, V.write_bucketed

    def watched(how):
        def run(df, *more, **kw):
            plans[more[-1] if more else "state"] = df._jdf.queryExecution().executedPlan().toString()
            return how(df, *more, **kw)
        return run
    monkeypatch.setattr(V, "cut_lineage", watched(cut))
    monkeypatch.setattr(V, "write_bucketed", watched(write))
    raw = V.raw_pairs(docs)
    tokens = {r["row_id"]: set(r["tokens"]) for r in docs.collect() if r["tokens"]}
    assert {r["row_id"]: set(r["tokens"]) for r in raw.table.collect()} == tokens and raw.table.count() == len(tokens)
    assert raw.documents == len(tokens) and raw.pairs == sum(map(len, tokens.values()))
    assert "regexp" not in plans["rawpairs"]
    _, bags, _ = build_corpus(docs, 0)
    assert "collect_list(" not in plans["bags"] and "Generate " not in plans["bags"] and "MapInArrow" in plans["bags"]
    plan = em.document_rows(bags)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list(" not in plan and "FileScan parquet spark_catalog.default.tt_bags_" in plan


def test_bags_are_the_same_by_every_path(spark):
    docs = _texts(spark).unionByName(_texts(spark).where("row_id < 6"))
    plain = docs.select("row_id", "tokens", "name")                   # no text beside it
    got = []
    for source in (_texts(spark), _texts(spark).select("row_id", "tokens", "name"), docs, plain, V.token_rows(plain)):
        for limit in (None, "64"):
            if limit:
                spark.conf.set("topic_tables.broadcastLimitBytes", limit)
            try:
                vocab, bags, _ = build_corpus(source, 0)
                names = vocab.table.select("word_id", "token")
                got.append({(r["row_id"], r["part"], r["token"]): r["n"] for r in bags.join(names, "word_id").collect()})
            finally:
                spark.conf.unset("topic_tables.broadcastLimitBytes")
    assert got[0] and all(g == got[0] for g in got[:4]) and all(g == got[4] for g in got[4:])
    assert got[4] == {k: n * (2 if k[0] < 6 else 1) for k, n in got[0].items()}


def test_bags_stay_when_a_model_goes(spark):
    vocab, bags, _ = build_corpus(_texts(spark), 0)
    before = sorted(map(tuple, bags.collect()))
    for fit in (fit_plsa, fit_robust_plsa):
        fit(bags, vocab, 2, 2).release()
        assert sorted(map(tuple, bags.collect())) == before


@pytest.mark.parametrize("robust", [False, True])
def test_a_walk_in_place_gives_the_sums_of_one_by_words(robust, monkeypatch):
    rng, step = np.random.default_rng(5), em._Step(3, robust, 0.3 * robust, 0.01 * robust)
    sizes = rng.integers(0, 40, 300)
    doc, w = np.repeat(np.arange(300), sizes), rng.integers(0, 90, sizes.sum()).astype(np.int32)
    n, nu, t = rng.integers(1, 9, len(w)).astype(float), rng.random(len(w)), rng.random((300, 3))
    t[7] = np.nan
    source = Rows(rng.random((100, 3)), rng.random(100))
    source.phi[4], source.bg[4], nu[w == 4] = 0.0, 0.0, 0.0
    monkeypatch.setattr(em, "PAIRS_AT_ONCE", 700)
    for words in (True, False):
        got = step.walk(source, t, doc, w, n, nu, words)
        with monkeypatch.context() as m:
            m.setattr(Rows, "edges", np.array([0, 50, 100]))
            m.setattr(Rows, "load", lambda self, b: (self.phi[50 * b:50 * b + 50], self.bg[50 * b:50 * b + 50]))
            want = step.walk(source, t, doc, w, n, nu, words)
        for a, b in zip(got, want):
            assert a.shape == b.shape and np.allclose(a, b, rtol=1e-12, atol=1e-12)


def test_names_do_not_move_the_pairs(spark, monkeypatch):
    vocab, bags, _ = build_corpus(_texts(spark), 0)
    monkeypatch.setattr(catalog, "corpus", lambda *a: (None, vocab, bags))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = catalog.q_robust_mixture(spark, "")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning(word_id" not in plan and "BroadcastHashJoin" in plan


@pytest.mark.parametrize("held", [None, 60])
def test_tokens_are_added_up_in_the_pass_over_the_text(spark, monkeypatch, held):
    """Their sums are files of their own, so the lists are not read for them."""
    if held:
        monkeypatch.setattr(V, "SUMS_HELD", held)
    docs = _texts(spark)
    raw = V.raw_pairs(docs)
    got = {r["token"]: r["n"] for r in raw.token_sums().groupBy("token").sum("n").withColumnRenamed("sum(n)", "n").collect()}
    assert got == {r["token"]: r["n"] for r in V.token_counts(docs).collect()}
    plan = raw.token_sums()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sums" in plan and raw.sums.where("size(tokens) = 0").count() == 0
    V.release(raw.table)
    empty = V.raw_pairs(docs.where("row_id < 0").select("row_id", "tokens"))
    assert (empty.pairs, empty.documents) == (0, 0) and empty.token_sums().count() == empty.table.count() == 0


@pytest.mark.parametrize("part_rows", [None, "2"])
def test_a_robust_pass_writes_no_lists_but_the_noise(spark, monkeypatch, part_rows):
    """The lists stay in the bags; the last pass writes the words beside their
    noise, which is then read without the bags."""
    if part_rows:
        spark.conf.set("topic_tables.documentPartRows", part_rows)
    written, write = [], em.write_bucketed
    monkeypatch.setattr(em, "write_bucketed", lambda df, keys, buckets, label, **kw: written.append((label, write(df, keys, buckets, label, **kw))) or written[-1][1])
    monkeypatch.setattr(em, "drop", lambda *a: None)
    try:
        vocab, bags, _ = build_corpus(_texts(spark), 0)
    finally:
        spark.conf.unset("topic_tables.documentPartRows")
    assert bags._tt_split == bool(part_rows)
    model = fit_robust_plsa(bags, vocab, 2, 3, gamma=0.3, eps=0.01)
    passes = [t.where("word_id is null") for label, t in written if label == "pass"]
    assert "docrows" not in [label for label, _ in written] and [p.where("words is not null").count() > 0 for p in passes] == [False, False, True]
    assert all("ns" not in p.columns and p.where("us is null").count() == 0 for p in passes)
    known = {(r["row_id"], r["word_id"]) for r in bags.collect()}
    V.release(bags)
    noise = model.noise.collect()
    assert len(noise) == len(known) and {(r["row_id"], r["word_id"]) for r in noise} == known
    sums = {}
    for r in noise:
        sums[r["row_id"]] = sums.get(r["row_id"], 0.0) + r["p"]
    assert np.allclose(list(sums.values()), 1.0)
    model.release()


def test_packed_runs_come_back_from_any_slice():
    values, sizes = np.arange(9.0), np.array([2, 0, 3, 4])
    col = em._packed(values, sizes)
    assert em._unpacked(col).tolist() == values.tolist() and em._unpacked(col.slice(2, 1)).tolist() == [2.0, 3.0, 4.0]
