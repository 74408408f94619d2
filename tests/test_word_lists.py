"""Word sums made from the pairs by word equal those of the pass, and a fit
then writes no row of K sums a word and task."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from topic_tables import build_vocab, fit_plsa, to_bags
from topic_tables.operators import em
from topic_tables.operators import word_lists as L
from topic_tables.operators.priors import SymmetricDirichlet
from topic_tables.session import scratch_path


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, str(i), [f"w{(i * i + j * j) % 61}" for j in range(i % 13 + 2)] + ["often"] * (i % 3)) for i in range(150)]
    rows += [(500, "large", [f"w{j % 61}" for j in range(400)]), (501, "unknown", ["never"]), (None, "null", ["w1", "w2"])]
    docs = spark.createDataFrame(rows, "row_id bigint, name string, tokens array<string>")
    return docs, build_vocab(docs, 1)


def _values(model):
    theta = {r["row_id"]: r["theta"] for r in model.theta.where("row_id is not null").collect()}
    return theta, {r["word_id"]: r["phi"] for r in model.phi.collect()}


@pytest.mark.parametrize("kind", ["plain", "blocks", "slices", "split", "priors", "resume"])
def test_word_lists_give_the_same_fit(spark, corpus, monkeypatch, kind):
    docs, vocab = corpus
    if kind == "split":
        spark.conf.set("topic_tables.documentPartRows", "20")
    bags = to_bags(docs, vocab, 4)
    spark.conf.unset("topic_tables.documentPartRows")
    more = dict(theta_prior=SymmetricDirichlet(0.9), phi_prior=SymmetricDirichlet(1.1)) if kind == "priors" else {}
    want = fit_plsa(bags, vocab, 30, 3, docs=docs, **more)
    word_rows, write, built = [], em.write_bucketed, []

    def watched(df, keys, buckets, label, **kw):
        out = write(df, keys, buckets, label, **kw)
        if label == "pass":
            word_rows.append(out.where(F.col("word_id") >= 0).count())
        return out
    monkeypatch.setattr(em, "write_bucketed", watched)
    monkeypatch.setattr(em, "list_words", lambda *a: built.append(L.list_words(*a)) or built[-1])
    monkeypatch.setattr(L, "LEAST_BYTES", 0)
    monkeypatch.setattr(L, "PAIR_BYTES", 0)
    monkeypatch.setattr(L, "PAIRS_AT_ONCE", 50)
    monkeypatch.setattr(L, "PAIRS_A_ROW", 7)
    if kind == "blocks":
        spark.conf.set("topic_tables.broadcastLimitBytes", str(8 * 32 * 9))
        monkeypatch.setattr(L, "PAIRS_A_RUN", 40)
        monkeypatch.setattr(L, "HELD_BYTES", 100)
    if kind == "slices":
        monkeypatch.setattr(L, "PAIRS_A_RANGE", 10)
        monkeypatch.setattr(em._walks, "__defaults__", (60,))
    folder = scratch_path(spark, "resume") if kind == "resume" else None
    try:
        if folder:
            fit_plsa(bags, vocab, 30, 1, docs=docs, resume=folder)
        got = fit_plsa(bags, vocab, 30, 3, docs=docs, resume=folder, **more)
    finally:
        spark.conf.unset("topic_tables.broadcastLimitBytes")
    assert all(built) and set(word_rows) == {0}
    assert got.files.blocks == (1 if kind != "blocks" else -(-vocab.size // 9))
    for a, b in zip(_values(want), _values(got)):
        assert a.keys() == b.keys()
        assert all((a[i] is None and b[i] is None) or np.allclose(a[i], b[i], rtol=1e-9, atol=1e-13) for i in a)
    assert [h[1] for h in want.history] == pytest.approx([h[1] for h in got.history], abs=1e-8)
    assert [h[2] for h in want.history] == [h[2] for h in got.history]


def test_lists_are_kept_only_where_word_rows_take_more_room(spark, corpus, monkeypatch):
    docs, vocab = corpus
    bags = to_bags(docs, vocab, 4)
    rows = em.document_rows(bags)
    files = em.initial_files(em.initial_phi(vocab, 3), vocab, em._Step(3))
    assert L.list_words(rows, vocab, files, 4) is None
    monkeypatch.setattr(L, "LEAST_BYTES", 0)
    monkeypatch.setattr(L, "PAIR_BYTES", 1000)
    assert L.list_words(rows, vocab, files, 4) is None


@pytest.mark.parametrize("robust", [False, True])
def test_documents_of_many_topics_are_products(robust, monkeypatch):
    """The sums of :meth:`walk_documents` are those of the walk by words."""
    from topic_tables.operators.phi_files import Rows
    rng = np.random.default_rng(2)
    k, size = 12, 40
    step = em._Step(k, robust, 0.3 if robust else 0.0, 0.01 if robust else 0.0)
    phi, t = rng.random((size, k)), rng.random((30, k))
    phi[5], t[3], t[4] = 0.0, np.nan, 0.0
    doc = np.sort(rng.integers(0, 29, 500))
    doc = doc[doc != 7]
    w, n, nu = rng.integers(0, size, len(doc)), rng.integers(1, 4, len(doc)).astype(float), rng.random(len(doc))

    class Blocks(Rows):
        edges = np.array([0, 11, 30, size])

        def load(self, block):
            a, b = self.edges[block:block + 2]
            return self.phi[a:b], self.bg[a:b]

        def rows(self, words):
            return Rows(self.phi[words], self.bg[words])
    bg = rng.random(size)
    monkeypatch.setattr(em, "PAIRS_A_PRODUCT", 33)
    want, fresh, *_ = step.walk(Rows(phi, bg), t, doc, w, n, nu, True)
    for source in (Rows(phi, bg), Blocks(phi, bg)):
        got, new, words, _ = step.walk(source, t, doc, w, n, nu, False)
        assert len(words) == 0 and np.allclose(got, want, rtol=1e-12) and np.allclose(new, fresh, rtol=1e-12)


def test_theta_that_cannot_be_mapped_is_read_a_bucket_at_a_time(monkeypatch):
    rng = np.random.default_rng(4)
    edges, k = np.array([0, 10, 10, 25]), 9
    m, phi = rng.random((25, k)), rng.random((6, k))
    words, docs, n = rng.integers(0, 6, 90), rng.integers(0, 25, 90), np.ones(90)
    want = np.zeros((6, k))
    for w, d in zip(words, docs):
        want[w] += m[d] / (phi[w] @ m[d])
    monkeypatch.setattr(L, "PAIRS_AT_ONCE", 13)
    for mapped in (True, False):
        monkeypatch.setattr(L.ThetaFiles, "mapped", mapped)
        theta, got = L.ThetaFiles("unread", edges, k), np.zeros((6, k))
        theta._held = {i: m[edges[i]:edges[i + 1]] for i in range(3)}
        L._add_words(got, phi, theta, words, docs, n)
        assert np.allclose(got, want, rtol=1e-12)
