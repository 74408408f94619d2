"""The shuffle fallbacks used when a side is too large to broadcast give the
same model as the broadcast plans (salted joins for frequent keys)."""

import pytest

from topic_tables import build_vocab, fit_plsa, fit_robust_plsa, fold_in, to_bags


def _theta(m):
    return {r["row_id"]: list(r["theta"]) for r in m.theta.collect() if r["theta"] is not None}


def test_salted_shuffle_paths_match_broadcast(spark):
    docs = spark.createDataFrame(
        [(i, f"d{i}", (["the"] * 30 + ["w%d" % (i % 7), "v%d" % (i % 3), "u%d" % (i % 5)] * 2)) for i in range(40)],
        "row_id bigint, name string, tokens array<string>")
    vocab = build_vocab(docs, 0)
    ref_bags = to_bags(docs, vocab)
    ref = fit_plsa(ref_bags, vocab, 3, 3)
    ref_r = fit_robust_plsa(ref_bags, vocab, 2, 2)
    spark.conf.set("topic_tables.broadcastLimitBytes", "64")       # two words a block at K=2
    try:
        plan = to_bags(docs, vocab, materialise=False)._jdf.queryExecution().executedPlan().toString()
        assert "_salt" in plan
        bags = to_bags(docs, vocab)
        got = fit_plsa(bags, vocab, 3, 3)
        got_r = fit_robust_plsa(bags, vocab, 2, 2)
        fb = fold_in(docs, ref, 2)                 # table method (phi too big for row-local)
    finally:
        spark.conf.unset("topic_tables.broadcastLimitBytes")
    fr = fold_in(docs, ref, 2)
    for a, b in ((ref, got), (ref_r, got_r), (fr, fb)):
        ta, tb = _theta(a), _theta(b)
        assert set(ta) == set(tb)
        for key in ta:
            assert ta[key] == pytest.approx(tb[key], abs=1e-9)


def test_split_documents_match_unsplit(spark, golden):
    """Documents spread over several parts (as huge documents are) give the
    same θ, φ, β, ν and log-likelihood as single-part documents."""
    docs, vocab, bags = golden
    ref = fit_plsa(bags, vocab, 2, 3)
    ref_r = fit_robust_plsa(bags, vocab, 2, 3)
    spark.conf.set("topic_tables.documentPartRows", "2")
    try:
        split = to_bags(docs, vocab)
        assert split.where("part > 0").count() > 0
        got = fit_plsa(split, vocab, 2, 3)
        got_r = fit_robust_plsa(split, vocab, 2, 3)
        fb = fold_in(docs, ref, 2, method="table")
    finally:
        spark.conf.unset("topic_tables.documentPartRows")
    fr = fold_in(docs, ref, 2, method="row")
    for a, b in ((ref, got), (ref_r, got_r), (fr, fb)):
        ta, tb = _theta(a), _theta(b)
        assert set(ta) == set(tb)
        for key in ta:
            assert ta[key] == pytest.approx(tb[key], abs=1e-9)
    for x, y in zip(ref.history + ref_r.history, got.history + got_r.history):
        assert x[1] == pytest.approx(y[1], abs=1e-9)
    pa = {r["word_id"]: r["phi"] for r in ref.phi.collect()}
    for r in got.phi.collect():
        assert r["phi"] == pytest.approx(pa[r["word_id"]], abs=1e-9)
    na = {(r["row_id"], r["word_id"]): r["p"] for r in ref_r.noise.collect()}
    nb = {(r["row_id"], r["word_id"]): r["p"] for r in got_r.noise.collect()}
    assert set(na) == set(nb)
    for key in na:
        assert na[key] == pytest.approx(nb[key], abs=1e-9)
