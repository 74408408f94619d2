"""Edge cases of SURVEY §7.1 (D-list) and properties of the model."""

import pytest
from pyspark.sql import functions as F

from topic_tables import SymmetricDirichlet, build_vocab, fit_plsa, fit_robust_plsa, fold_in, to_bags
from topic_tables.operators.metrics import model_checks
from topic_tables.sources import text as T


def _lines(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_bag_lines_java_split(spark):
    lines = _lines(spark, ["d1\ta::b::", "d2\t::", "d3\t", "d4\ta:b\tjunk", "d5\tx"])
    got = {r["name"]: list(r["tokens"]) for r in T.parse_bag_lines(lines).collect()}
    assert got == {"d1": ["a", "", "b"], "d2": [], "d4": ["a", "b"], "d5": ["x"]}
    strict = {r["name"] for r in T.parse_bag_lines(lines, exact_fields=True).collect()}
    assert strict == {"d1", "d2", "d5"}


def test_fixture_separator(spark):
    lines = _lines(spark, ["10027839\x01a:b:a", "1034\x01a:z:x:n", "", ""])
    got = T.parse_bag_lines(lines, field_sep="\x01", exact_fields=True).collect()
    assert sorted(r["name"] for r in got) == ["10027839", "1034"]


def test_threshold_strict(golden):
    docs, _, _ = golden
    sizes = {thr: build_vocab(docs, thr).size for thr in (0, 1, 2, 3)}
    assert sizes == {0: 6, 1: 5, 2: 3, 3: 1}


def test_doc_without_known_tokens_has_null_theta(spark, golden):
    docs, vocab, bags = golden
    m = fit_plsa(bags, vocab, 2, 2)
    q = spark.createDataFrame([(7, "q1", ["zzz"]), (8, "q2", ["a"])], "row_id bigint, name string, tokens array<string>")
    for method in ("row", "table"):
        theta = {r["row_id"]: r["theta"] for r in fold_in(q, m, 2, method=method).theta.collect()}
        assert set(theta) == {7, 8} and theta[7] is None and theta[8] is not None
    trained = fit_plsa(bags, vocab, 2, 2, docs=docs.unionByName(q.where("row_id = 7")))
    theta = {r["row_id"]: r["theta"] for r in trained.theta.collect()}
    assert set(theta) == {0, 1, 2, 3, 7} and theta[7] is None


def test_partition_count_does_not_matter(spark, golden):
    docs, vocab, _ = golden
    a = fit_plsa(to_bags(docs, vocab, partitions=1), vocab, 2, 3, partitions=1)
    b = fit_plsa(to_bags(docs, vocab, partitions=5), vocab, 2, 3, partitions=5)
    ta = {r["row_id"]: r["theta"] for r in a.theta.collect()}
    tb = {r["row_id"]: r["theta"] for r in b.theta.collect()}
    for k in ta:
        for x, y in zip(ta[k], tb[k]):
            assert x == pytest.approx(y, abs=1e-9)


def test_invariants_hold(golden):
    _, vocab, bags = golden
    m = fit_plsa(bags, vocab, 3, 4)
    c = model_checks(m).first()
    assert c["theta_negative"] == 0 and c["theta_bad_sum"] == 0
    assert c["phi_negative"] == 0 and c["phi_bad_sum"] == 0


def test_gamma_zero_and_eps_zero(golden):
    _, vocab, bags = golden
    m = fit_robust_plsa(bags, vocab, 2, 2, gamma=0.0, eps=0.01)
    assert all(r["p"] == 0.0 for r in m.background.collect())
    m = fit_robust_plsa(bags, vocab, 2, 2, gamma=0.3, eps=0.0)
    assert all(r["p"] == 0.0 for r in m.noise.collect())


def test_dead_topic_stays_zero(spark):
    docs = spark.createDataFrame([(0, "d", ["a"])], "row_id bigint, name string, tokens array<string>")
    vocab = build_vocab(docs, 0)
    m = fit_plsa(to_bags(docs, vocab), vocab, 2, 2, phi_prior=SymmetricDirichlet(0.2))
    assert list(m.phi.first()["phi"]) == [0.0, 0.0]       # every count is cut: no mass, no NaN


def test_theta_prior_keeps_simplex(golden):
    _, vocab, bags = golden
    m = fit_plsa(bags, vocab, 2, 3, theta_prior=SymmetricDirichlet(0.2), phi_prior=SymmetricDirichlet(1.5))
    for r in m.theta.collect():
        assert sum(r["theta"]) == pytest.approx(1.0, abs=1e-9)
        assert min(r["theta"]) >= 0


def test_empty_input(spark):
    docs = spark.createDataFrame([], "row_id bigint, name string, tokens array<string>")
    vocab = build_vocab(docs, 0)
    assert vocab.size == 0
    bags = to_bags(docs, vocab)
    m = fit_plsa(bags, vocab, 2, 2)
    assert m.theta.count() == 0


def test_build_corpus_matches_two_pass(spark, golden):
    from topic_tables import build_corpus, token_counts
    docs, vocab, bags = golden
    v2, b2, c2 = build_corpus(docs, 0)
    assert sorted(tuple(r) for r in v2.table.collect()) == sorted(tuple(r) for r in vocab.table.collect())
    assert sorted(tuple(r) for r in b2.collect()) == sorted(tuple(r) for r in bags.collect())
    assert sorted(tuple(r) for r in c2.collect()) == sorted(tuple(r) for r in token_counts(docs).collect())


def test_perplexity_with_priors_matches_direct_formula(golden):
    import math
    from topic_tables.operators.metrics import perplexity
    _, vocab, bags = golden
    a = 0.5
    m = fit_plsa(bags, vocab, 2, 2, theta_prior=SymmetricDirichlet(a), phi_prior=SymmetricDirichlet(a))
    n_total = bags.agg(F.sum("n")).first()[0]

    def logpdf(x):
        return -(len(x) * math.lgamma(a) - math.lgamma(len(x) * a)) + (a - 1) * sum(math.log(v + 1e-5) for v in x)
    thetas = [r["theta"] for r in m.theta.collect()]
    phis = [r["phi"] for r in m.phi.collect()]
    lp = sum(logpdf(t) for t in thetas) + sum(logpdf([row[k] for row in phis]) for k in range(2))
    want = math.exp(-(m.history[-1][1] + lp) / n_total)
    assert perplexity(m, n_total) == pytest.approx(want, rel=1e-9)
    plain = fit_plsa(bags, vocab, 2, 2)
    assert perplexity(plain, n_total) == pytest.approx(math.exp(-plain.history[-1][1] / n_total), rel=1e-12)


def test_robust_fold_in_background_modes(spark, golden):
    from topic_tables import robust_fold_in
    docs, vocab, bags = golden
    m = fit_robust_plsa(bags, vocab, 2, 2)
    q = spark.createDataFrame([(10, "q", ["a", "y", "y"]), (11, "r", ["x", "z"])],
                              "row_id bigint, name string, tokens array<string>")
    kept = robust_fold_in(q, m, 3, background="model")
    trained = {r["word_id"]: r["p"] for r in m.background.collect()}
    assert {r["word_id"]: r["p"] for r in kept.background.collect()} == pytest.approx(trained)
    for r in kept.theta.collect():
        assert sum(r["theta"]) == pytest.approx(1.0, abs=1e-12) and min(r["theta"]) >= 0
    refit = robust_fold_in(q, m, 3)
    bg = {r["word_id"]: r["p"] for r in refit.background.collect()}
    assert sum(bg.values()) == pytest.approx(1.0, abs=1e-12)
    assert bg != pytest.approx(trained)          # D8: re-estimated over the folded documents
