"""φ in block files: no row of it passes the driver, a pass scans once whatever
the number of blocks, a fit can be resumed, folding in needs no table loop."""

import numpy as np
import pytest
from pyspark.sql.classic.dataframe import DataFrame
from pyspark.sql import functions as F

from topic_tables import build_vocab, fit_plsa, fit_robust_plsa, fold_in, to_bags
from topic_tables.operators import em, phi_files
from topic_tables.operators.phi_files import PhiFiles, write_phi
from topic_tables.operators.priors import SymmetricDirichlet
from topic_tables.operators.robust import robust_fold_in
from topic_tables.session import scratch_path
from topic_tables.sources.tables import load_table, tokens_from_text

from conftest import SF001


@pytest.fixture(scope="module")
def corpus(spark):
    docs = tokens_from_text(load_table(spark, SF001, "documents"), "doc_id", "text")
    vocab = build_vocab(docs, 15)
    return docs, vocab, to_bags(docs, vocab)


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("topic_tables.broadcastLimitBytes", "900")
    yield
    spark.conf.unset("topic_tables.broadcastLimitBytes")


def _theta(m):
    return {r["row_id"]: r["theta"] for r in m.theta.collect() if r["theta"] is not None}


def _phi(m):
    return {r["word_id"]: r["phi"] for r in m.phi.collect()}


def _noise(m):
    return {(r["row_id"], r["word_id"]): r["p"] for r in m.noise.collect()}


def _near(a, b, tol=1e-12):
    assert set(a) == set(b)
    for key in a:
        np.testing.assert_allclose(a[key], b[key], rtol=0, atol=tol)


def test_files_hold_what_was_written(spark, monkeypatch):
    rows = spark.createDataFrame([(i, [float(i), 1.0, i / 2]) for i in range(50) if not 10 <= i < 20], "word_id int, vec array<double>")
    spark.conf.set("topic_tables.broadcastLimitBytes", str(8 * 4 * 10))
    try:
        files = write_phi(rows, 50, 2, robust=True)
    finally:
        spark.conf.unset("topic_tables.broadcastLimitBytes")
    assert files.blocks == 5 and files.present == [0, 2, 3, 4]
    got = {r["word_id"]: (r["phi"], r["bg"]) for r in files.frame(spark).collect()}
    assert got == {i: ([float(i), 1.0], i / 2) if not 10 <= i < 20 else ([0.0, 0.0], 0.0) for i in range(50)}
    some = files.rows(np.array([0, 11, 20, 49]))
    assert some.phi.tolist() == [[0, 1], [0, 0], [20, 1], [49, 1]] and some.bg.tolist() == [0, 0, 10, 24.5]
    # a store that cannot be mapped is read a block at a time
    away = PhiFiles(**{k: v for k, v in files.__dict__.items() if k != "_held"})
    monkeypatch.setattr(phi_files, "open_folder", lambda uri, of=phi_files.open_folder: (*of(uri)[:2], False))
    again = away.rows(np.array([0, 11, 20, 49]))
    assert again.phi.tolist() == some.phi.tolist() and again.bg.tolist() == some.bg.tolist() and len(away._held) <= 2


@pytest.mark.parametrize("robust", [False, True])
def test_many_blocks_equal_one_without_phi_on_the_driver(spark, corpus, robust, monkeypatch, request):
    docs, vocab, bags = corpus
    fit = fit_robust_plsa if robust else fit_plsa
    one = fit(bags, vocab, 4, 3)
    request.getfixturevalue("small_blocks")
    widest = []
    collect = DataFrame.collect

    def seen(self):
        rows = collect(self)
        widest.append((len(rows), self.columns))
        return rows

    def refused(self):
        raise AssertionError("a table went to the driver")
    monkeypatch.setattr(DataFrame, "collect", seen)
    monkeypatch.setattr(DataFrame, "toArrow", refused)
    monkeypatch.setattr(DataFrame, "toPandas", refused)
    many = fit(bags, vocab, 4, 3)
    monkeypatch.undo()
    assert many.files.blocks > 20
    # block numbers, or a vector a task: no words and no cells of φ
    assert widest and all(columns in (["block"], ["vec"]) for _, columns in widest)
    assert all(n <= max(many.files.blocks, 64) for n, _ in widest)
    _near(_theta(one), _theta(many))
    _near(_phi(one), _phi(many))
    assert [h[1] for h in one.history] == pytest.approx([h[1] for h in many.history], abs=1e-8)
    if robust:
        _near(_noise(one), _noise(many))


@pytest.mark.parametrize("kind", ["plain", "robust", "prior", "split"])
def test_resumed_fit_equals_an_uninterrupted_one(spark, corpus, kind, monkeypatch):
    docs, vocab, bags = corpus
    if kind == "split":
        spark.conf.set("topic_tables.documentPartRows", "50")
        bags = to_bags(docs, vocab)
        spark.conf.unset("topic_tables.documentPartRows")

    def fit(iterations, **kw):
        if kind == "robust":
            return fit_robust_plsa(bags, vocab, 3, iterations, **kw)
        priors = dict(theta_prior=SymmetricDirichlet(0.9), phi_prior=SymmetricDirichlet(1.1)) if kind == "prior" else {}
        return fit_plsa(bags, vocab, 3, iterations, **priors, **kw)
    want = fit(5)
    folder = scratch_path(spark, "resume")
    advance = em.advance

    def lost(state, it, *more):
        if it == 3:
            raise RuntimeError("the driver is gone")
        return advance(state, it, *more)
    monkeypatch.setattr(em, "advance", lost)
    with pytest.raises(RuntimeError):
        fit(5, resume=folder)
    monkeypatch.undo()
    done = []
    monkeypatch.setattr(em, "advance", lambda state, it, *more: (done.append(it), advance(state, it, *more))[1])
    got = fit(5, resume=folder)
    assert done == [3, 4]
    _near(_theta(want), _theta(got))
    _near(_phi(want), _phi(got))
    assert [h[:1] + h[2:] for h in want.history] == [h[:1] + h[2:] for h in got.history]
    assert [h[1] for h in want.history] == pytest.approx([h[1] for h in got.history], abs=1e-8)
    if kind == "robust":
        _near(_noise(want), _noise(got))
    # a finished fit is taken as it is; one of other settings is refused
    done.clear()
    _near(_theta(want), _theta(fit(5, resume=folder)))
    assert done == []
    with pytest.raises(ValueError, match="other settings"):
        fit_plsa(bags, vocab, 2, 5, resume=folder)


def test_fold_in_with_a_large_phi(spark, corpus, small_blocks):
    docs, vocab, bags = corpus
    model = fit_plsa(bags, vocab, 4, 2)
    row, table = fold_in(docs, model, 4, compute_loglik=True), fold_in(docs, model, 4, compute_loglik=True, method="table")
    _near(_theta(row), _theta(table))
    assert [h[1] for h in row.history] == pytest.approx([h[1] for h in table.history], abs=1e-8)
    # from a model that is only a table, too
    model.files = None
    _near(_theta(fold_in(docs, model, 4)), _theta(row))
    rows = em.document_rows(bags)
    files = em.initial_files(model.phi, vocab, em._Step(4))
    plan = em.fold_rows(rows, files, em._Step(4), 10)._jdf.queryExecution().executedPlan().toString()
    assert isinstance(files, PhiFiles) and files.blocks > 20 and "Exchange" not in plan


@pytest.mark.parametrize("blocks", ["one", "many"])
def test_robust_fold_in_with_the_trained_background(spark, corpus, blocks, request):
    docs, vocab, bags = corpus
    model = fit_robust_plsa(bags, vocab, 3, 2)
    if blocks == "many":
        request.getfixturevalue("small_blocks")
    row, table = (robust_fold_in(docs, model, 4, "model", True, method=m) for m in ("auto", "table"))
    _near(_theta(row), _theta(table))
    _near(_noise(row), _noise(table))
    _near({r["word_id"]: r["p"] for r in row.background.collect()}, {r["word_id"]: r["p"] for r in model.background.collect()})
    assert [h[1] for h in row.history] == pytest.approx([h[1] for h in table.history], abs=1e-8)
    # a document alone gets what it gets among others
    alone = robust_fold_in(docs.where(F.col("row_id") == 5), model, 4, "model")
    _near(_theta(alone), {k: v for k, v in _theta(row).items() if k == 5})
