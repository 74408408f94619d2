"""Golden EM values on the 4-document fixture (independent NumPy derivation)."""

import pytest

from topic_tables import fit_plsa, fit_robust_plsa, fold_in
from topic_tables.operators.em import initial_phi

TOK = ["a", "b", "n", "x", "y", "z"]


def _theta(model):
    return {r["row_id"]: r["theta"] and list(r["theta"]) for r in model.theta.collect()}


def _phi(model):
    vocab = {r["word_id"]: r["token"] for r in model.vocab.table.collect()}
    rows = {vocab[r["word_id"]]: list(r["phi"]) for r in model.phi.collect()}
    return [[rows[t][k] for t in TOK] for k in range(2)]


def close(a, b, tol=1e-6):
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x == pytest.approx(y, abs=tol)


def test_vocab_order_and_counts(golden):
    _, vocab, _ = golden
    rows = sorted((r["word_id"], r["token"], r["n"]) for r in vocab.table.collect())
    assert rows == [(0, "a", 4), (1, "b", 1), (2, "n", 2), (3, "x", 3), (4, "y", 2), (5, "z", 3)]
    assert vocab.size == 6


def test_initial_phi(golden):
    _, vocab, _ = golden
    phi = {r["word_id"]: r["phi"] for r in initial_phi(vocab, 2, 13).collect()}
    close([phi[i][0] for i in range(6)], [0.112556, 0.227482, 0.217086, 0.115282, 0.084681, 0.242914])
    close([phi[i][1] for i in range(6)], [0.033547, 0.004460, 0.171504, 0.509747, 0.030133, 0.250611])


def test_plsa_two_iterations(golden):
    _, vocab, bags = golden
    m = fit_plsa(bags, vocab, 2, 2, 13)
    th = _theta(m)
    close(th[0], [0.950199, 0.049801])
    close(th[1], [0.504889, 0.495111])
    close(th[2], [0.436977, 0.563023])
    close(th[3], [0.436977, 0.563023])
    phi = _phi(m)
    close(phi[0], [0.391659, 0.118924, 0.114920, 0.053136, 0.168317, 0.153044])
    close(phi[1], [0.109043, 0.000767, 0.156554, 0.385205, 0.089216, 0.259215])


def test_plsa_ten_iterations_and_loglik(golden):
    _, vocab, bags = golden
    m = fit_plsa(bags, vocab, 2, 10, 13)
    th = _theta(m)
    close(th[0], [1.0, 0.0])
    close(th[1], [0.000026, 0.999974])
    close(th[2], [0.234527, 0.765473])
    expected = [-24.776407, -24.149756, -23.631931, -23.195591, -22.778199,
                -22.297528, -21.661174, -21.029905, -20.761785, -20.716523]
    got = [h[1] for h in m.history[1:]]
    close(got, expected, 1e-5)
    # PLSA log-likelihood never falls
    lls = [h[1] for h in m.history]
    assert all(b >= a - 1e-9 for a, b in zip(lls, lls[1:]))


def test_fold_in_query(spark, golden):
    _, vocab, bags = golden
    m = fit_plsa(bags, vocab, 2, 2, 13)
    q = spark.createDataFrame([(10, "q", ["a", "y", "y"])], "row_id bigint, name string, tokens array<string>")
    f = fold_in(q, m, 2)
    close(_theta(f)[10], [0.8388197421, 0.1611802579], 1e-8)


def test_robust_two_iterations(golden):
    _, vocab, bags = golden
    m = fit_robust_plsa(bags, vocab, 2, 2, 13, gamma=0.3, eps=0.01)
    th = _theta(m)
    close(th[0], [0.960748, 0.039252])
    close(th[1], [0.449183, 0.550817])
    close(th[2], [0.422082, 0.577918])
    phi = _phi(m)
    close(phi[0], [0.362082, 0.131077, 0.132397, 0.065632, 0.127189, 0.181623])
    close(phi[1], [0.081221, 0.000620, 0.155796, 0.424425, 0.063856, 0.274083])
    vocab_map = {r["word_id"]: r["token"] for r in m.vocab.table.collect()}
    bg = {vocab_map[r["word_id"]]: r["p"] for r in m.background.collect()}
    close([bg[t] for t in TOK], [0.391875, 0.053149, 0.100290, 0.092730, 0.240162, 0.121794])
    nu = {(r["row_id"], vocab_map[r["word_id"]]): r["p"] for r in m.noise.collect()}
    close([nu[(0, "a")], nu[(0, "b")]], [0.621566, 0.378434])
    close([nu[(1, t)] for t in "xyz"], [0.039459, 0.909171, 0.051370])
    close([nu[(2, t)] for t in "anxz"], [0.357565, 0.329868, 0.134768, 0.177798])
    close([h[1] for h in m.history], [-27.970810, -24.800742, -24.211724], 1e-5)


def test_robust_ten_iterations_loglik(golden):
    _, vocab, bags = golden
    m = fit_robust_plsa(bags, vocab, 2, 10, 13)
    assert m.history[-1][1] == pytest.approx(-21.265631, abs=1e-5)


def test_fold_in_row_and_table_methods_agree(spark, golden):
    from topic_tables import SymmetricDirichlet
    docs, vocab, bags = golden
    for prior in (None, SymmetricDirichlet(0.5)):
        m = fit_plsa(bags, vocab, 2, 2, 13, theta_prior=prior)
        q = spark.createDataFrame([(10, "q", ["a", "y", "y"]), (11, "r", ["x", "n", "b", "b"]), (12, "s", ["zzz"])],
                                  "row_id bigint, name string, tokens array<string>")
        a = _theta(fold_in(q, m, 3, method="row"))
        b = _theta(fold_in(q, m, 3, method="table"))
        assert set(a) == set(b) == {10, 11, 12} and a[12] is None and b[12] is None
        for key in (10, 11):
            close(a[key], b[key], 1e-12)


def test_fold_in_history_does_not_depend_on_the_method(spark, golden):
    """States 0..I either way, also where some documents are split."""
    docs, vocab, bags = golden
    m = fit_plsa(bags, vocab, 2, 2, 13)
    row = fold_in(docs, m, 3, compute_loglik=True, method="row").history
    table = fold_in(docs, m, 3, compute_loglik=True, method="table").history
    spark.conf.set("topic_tables.documentPartRows", "2")
    try:
        split = fold_in(docs, m, 3, compute_loglik=True, method="row").history
    finally:
        spark.conf.unset("topic_tables.documentPartRows")
    assert [h[0] for h in row] == [0, 1, 2, 3]
    for other in (table, split):
        assert [(i, s) for i, _, s in row] == [(i, s) for i, _, s in other]
        close([h[1] for h in row], [h[1] for h in other], 1e-9)
