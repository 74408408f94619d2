"""Priors over whole topics against numpy, and doc-topic lines without a shuffle of the text."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from topic_tables import fit_plsa
from topic_tables.operators.metrics import perplexity, topic_log_density
from topic_tables.operators.priors import Prior
from topic_tables.plans import catalog as C
from topic_tables.sources import text as T


def _phi(model):
    rows = sorted(model.phi.collect(), key=lambda r: r["word_id"])
    return np.array([r["phi"] for r in rows])


def test_a_prior_over_whole_topics(spark, golden, monkeypatch):
    docs, vocab, bags = golden
    monkeypatch.setattr(C, "OVERLAP", 4.0)
    prior = C.DistinctTopics()
    model = fit_plsa(bags, vocab, 2, 3, phi_prior=prior)
    phi = _phi(model)
    overlap = sum(phi[:, s] @ phi[:, t] for s in range(2) for t in range(s))
    flat = sum(p * math.log(phi[:, t].max() / p) for t in range(2) for p in phi[:, t] if p > 0)
    assert topic_log_density(model.phi, prior, 2, vocab.size) == pytest.approx(-4.0 * overlap - C.PEAK * flat, abs=1e-9)
    length = bags.agg(F.sum("n")).first()[0]
    want = math.exp(-(model.history[-1][1] - 4.0 * overlap - C.PEAK * flat) / length)
    assert perplexity(model, length) == pytest.approx(want, rel=1e-9)
    # the M-step takes the overlap off: topics share fewer words than without
    plain = _phi(fit_plsa(bags, vocab, 2, 3))
    assert overlap < plain[:, 0] @ plain[:, 1]
    # one update by hand, from state 0
    one, start = _phi(fit_plsa(bags, vocab, 2, 1, phi_prior=prior)), _phi(fit_plsa(bags, vocab, 2, 0))
    counts = np.zeros_like(start)
    for r in bags.collect():
        z = start[r["word_id"]] * 0.5
        counts[r["word_id"]] += r["n"] * z / z.sum()
    a = np.maximum(counts - 4.0 * start * (start.sum(axis=1, keepdims=True) - start), 0)
    np.testing.assert_allclose(one, a / a.sum(axis=0), atol=1e-12)


def test_a_prior_with_only_log_prob_is_still_refused(golden):
    docs, vocab, bags = golden

    class Whole(Prior):
        def log_prob(self, vec, size):
            return F.lit(0.0)
    with pytest.raises(TypeError):
        perplexity(fit_plsa(bags, vocab, 2, 1, phi_prior=Whole()), 15.0)


def test_doc_topic_lines_do_not_move_the_text(spark, golden):
    docs, vocab, bags = golden
    model = fit_plsa(bags, vocab, 2, 2, docs=docs)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = T.format_doc_topic(T.store_contents(docs, bags), model.theta_rows)
        plan = lines._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Bucketed: true" in plan
        assert sorted(r[0] for r in lines.collect()) == sorted(r[0] for r in T.format_doc_topic(docs, model.theta).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
