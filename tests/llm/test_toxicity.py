import numpy as np

from topic_tables.llm import toxicity as T
from topic_tables.llm.queries import op1_toxicity
from topic_tables.llm.text import fold

SF = "/root/testdata/sf0.1"


def test_value_is_the_machines_definition():
    rng = np.random.default_rng(0)
    m = T.Machine(0.3, rng.normal(size=50), rng.normal(size=(50, 4)), np.ones(50, bool))
    docs = [np.array([1, 4, 7]), np.array([], int), np.array([9, 30])]
    got = m.raw(np.concatenate(docs).astype(int), np.array([3, 0, 2]))
    for t, v in zip(docs, got):
        x = 1 / np.sqrt(max(1, len(t)))
        want = 0.3 + sum(m.weight[i] * x for i in t) + sum(m.factor[i] @ m.factor[j] * x * x for k, i in enumerate(t) for j in t[:k])
        assert np.isclose(v, want)


def _sampled(rng, n, rate, label, noise=3):
    docs, labels = [], []
    for _ in range(n):
        a, b = rng.random(2) < rate
        docs.append(np.unique(np.r_[[10] * int(a), [20] * int(b), rng.integers(100, 4000, noise)].astype(int)))
        labels.append(float(label(a, b)))
    return docs, np.array(labels)


def _right(docs, labels, learn, **kw):
    m = T.train(docs[:learn], labels[:learn], **kw)
    p = T.sigmoid(m.raw(np.concatenate([t[m.known[t]] for t in docs[learn:]]), np.array([int(m.known[t].sum()) for t in docs[learn:]])))
    return m, p > 0.5


def test_learns_an_interaction():
    """Neither term tells anything alone; one without the other is toxic."""
    docs, labels = _sampled(np.random.default_rng(1), 4000, 0.5, lambda a, b: a != b)
    m, right = _right(docs, labels, 3000, epochs=60)
    assert m.known[[10, 20]].all() and m.known.sum() < 30
    assert (right == labels[3000:].astype(bool)).mean() > 0.95


def test_learns_a_pair_of_harmless_terms():
    """Toxic only where both stand: as a term each is mostly clean."""
    rng = np.random.default_rng(2)
    docs, labels = _sampled(rng, 5000, 0.3, lambda a, b: a and b, noise=20)
    m, right = _right(docs, labels, 4000)
    assert m.known[[10, 20]].all()
    assert (right == labels[4000:].astype(bool)).mean() > 0.95


def test_pairs_of_noise_are_left_out():
    rng = np.random.default_rng(4)
    docs = [np.unique(rng.integers(0, 400, 40)) for _ in range(3000)]
    assert T.telling(docs, (rng.random(3000) < 0.06).astype(float)).sum() <= 8


def test_terms_that_tell_nothing_are_left_out():
    rng = np.random.default_rng(3)
    labels = (rng.random(1000) < 0.2).astype(float)
    docs = [np.unique(np.r_[[7] * int(y), rng.integers(50, 5000, 30)].astype(int)) for y in labels]
    known = T.telling(docs, labels)
    assert known[7] and known.sum() < 30


def test_held_out_quality(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").where(fold("doc_id", 5) == 0).select("doc_id", "toxic")
    rows = op1_toxicity(spark, SF).join(labels, "doc_id").collect()
    assert len(rows) > 500 and all(r["held_out"] for r in rows)
    y, s = np.array([r["toxic"] for r in rows]), np.array([r["score"] for r in rows])
    order = s.argsort()
    rank = np.empty(len(s))
    rank[order] = np.arange(1, len(s) + 1)
    auc = (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))
    pred = s >= 0.5
    print("auc", auc, "recall", pred[y == 1].mean(), "false", pred[y == 0].mean())
    assert auc > 0.95 and pred[y == 1].mean() > 0.85 and pred[y == 0].mean() < 0.02


def test_edges(spark):
    rows = [(i, f"you are a stupid idiot {i}" if i % 2 else f"a nice calm day {i}") for i in range(60)]
    rows += [(100, None), (101, ""), (102, "idiot " * 60_000), (102, "idiot " * 60_000), (None, "nice")]
    df = spark.createDataFrame([(i, t, 3, "x") for i, t in rows], "doc_id bigint, text string, score int, label string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(7, 1), (5, None), (None, 1), (999, 1)], "doc_id bigint, toxic int")
    m = T.fit(df, labels, fold("doc_id", 5) != 0)
    got = T.score(df, m).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r["score"] for r in got}
    assert by[100] == by[101] and by[102] > 0.5 > by[None]
    again = {r["doc_id"]: r["score"] for r in T.score(df, T.fit(df.repartition(5), labels, fold("doc_id", 5) != 0)).collect()}
    assert again == by


def test_no_labels(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert T.fit(df, none, fold("doc_id", 5) != 0) is None
    assert [r["score"] for r in T.score(df, None).collect()] == [0.0]
    assert T.score(df.limit(0), None).count() == 0
