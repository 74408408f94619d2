"""Ranking, reports and text round trips."""

import pytest

from topic_tables import fit_plsa
from topic_tables.operators.search import similar_docs, top_topics, top_words
from topic_tables.sources import text as T
from topic_tables.session import scratch_path


@pytest.mark.parametrize("doc_bytes,query_bytes", [(32 << 20, 8 << 20), (2000, 8 << 20), (900, 200)])
def test_similar_docs_matches_brute_force_with_ties(spark, doc_bytes, query_bytes):
    """In one block, in rings, and with rings and queries cut small."""
    import random
    rnd = random.Random(7)
    docs = [(i, f"d{i % 50:03d}", [rnd.random() for _ in range(3)]) for i in range(400)]
    docs += [(1000 + i, "dup", [0.2, 0.3, 0.5]) for i in range(30)]       # exact ties
    qs = [(q, f"q{q}", [rnd.random() for _ in range(3)]) for q in range(7)] + [(99, "qd", [0.2, 0.3, 0.5])]
    d = spark.createDataFrame(docs, "row_id bigint, name string, theta array<double>").repartition(5)
    q = spark.createDataFrame(qs, "query_id bigint, query_name string, theta array<double>")
    got = {(r["query_id"], r["rank"]): (r["row_id"], round(r["score"], 9)) for r in similar_docs(d, q, 20, doc_bytes, query_bytes).collect()}
    assert len(got) == 20 * len(qs)
    import math
    for qid, _, qv in qs:
        scored = []
        for rid, name, v in docs:
            s = sum(a * b for a, b in zip(qv, v)) / (math.sqrt(sum(a * a for a in qv)) * math.sqrt(sum(b * b for b in v)))
            scored.append((-round(s, 8), name, rid, s))
        scored.sort()
        for rank, (_, _, rid, s) in enumerate(scored[:20], 1):
            assert got[(qid, rank)][0] == rid
            assert got[(qid, rank)][1] == pytest.approx(s, abs=1e-9)


def test_rings_out_of_reach_are_not_scored(spark):
    """Clustered θ, as a topic model gives: the same hits from under half of the
    (query, ring) pairs; a document meets its own ring's queries only."""
    import numpy as np
    rng = np.random.default_rng(5)
    theta = rng.dirichlet([0.05] * 12, 4000)
    queries = rng.dirichlet([0.05] * 12, 60)
    d = spark.createDataFrame([(i, f"d{i % 97}", t.tolist()) for i, t in enumerate(theta)], "row_id bigint, name string, theta array<double>").repartition(6)
    q = spark.createDataFrame([(i, f"q{i}", t.tolist()) for i, t in enumerate(queries)], "query_id bigint, query_name string, theta array<double>")
    whole = similar_docs(d, q, 20)
    rings = similar_docs(d, q, 20, doc_block_bytes=20_000, query_block_bytes=3000)
    assert whole._tt_scored is None and 0 < rings._tt_scored[0] < rings._tt_scored[1] / 2
    a, b = ({(r["query_id"], r["rank"]): (r["row_id"], r["name"], round(r["score"], 9)) for r in x.collect()} for x in (whole, rings))
    assert a == b and len(a) == 60 * 20


def test_fewer_documents_than_n_and_negative_components(spark):
    import numpy as np
    rng = np.random.default_rng(6)
    d = spark.createDataFrame([(i, "d", v.tolist()) for i, v in enumerate(rng.normal(size=(15, 4)))] + [(90, "z", [0.0] * 4), (91, "n", None)],
                              "row_id bigint, name string, theta array<double>")
    q = d.where("row_id < 3 or row_id > 80").selectExpr("row_id as query_id", "name as query_name", "theta")
    a, b = (sorted((r["query_id"], r["rank"], r["row_id"]) for r in similar_docs(d, q, 20, size).collect()) for size in (32 << 20, 300))
    assert a == b and len(a) == 3 * 15


def test_repeated_query_names_rank_separately(spark):
    d = spark.createDataFrame([(1, "a", [1.0, 0.0]), (2, "b", [0.0, 1.0])], "row_id bigint, name string, theta array<double>")
    q = spark.createDataFrame([(1, "q", [1.0, 0.0]), (2, "q", [0.0, 1.0])], "query_id bigint, query_name string, theta array<double>")
    top = {(r["query_id"], r["rank"]): r["row_id"] for r in similar_docs(d, q, 1).collect()}
    assert top == {(1, 1): 1, (2, 1): 2}


def test_top_words_and_topics(golden):
    _, vocab, bags = golden
    m = fit_plsa(bags, vocab, 2, 2)
    tw = top_words(m, 3).collect()
    assert len(tw) == 6
    t0 = [r["token"] for r in sorted(tw, key=lambda r: (r["topic"], r["rank"])) if r["topic"] == 0]
    assert t0 == ["a", "y", "z"]
    tt = {(r["row_id"], r["rank"]): r["topic"] for r in top_topics(m.theta, 1).collect()}
    assert tt[(0, 1)] == 0 and tt[(1, 1)] == 0 and tt[(2, 1)] == 1


def test_topic_word_and_doc_topic_round_trip(spark, golden):
    docs, vocab, bags = golden
    m = fit_plsa(bags, vocab, 2, 2)
    p = scratch_path(spark, "tw")
    T.write_lines(T.format_topic_word(m.phi), p)
    back = {r["word_id"]: r["phi"] for r in T.read_topic_word(spark, p, 2).collect()}
    for r in m.phi.collect():
        assert back[r["word_id"]] == pytest.approx(r["phi"], abs=0)
    p2 = scratch_path(spark, "dt")
    T.write_lines(T.format_doc_topic(docs, m.theta), p2)
    rows = T.read_doc_topic(spark, p2, 2).collect()
    assert sorted(r["name"] for r in rows) == ["10027839", "1034", "1034", "10343751"]
    want = sorted(tuple(r["theta"]) for r in m.theta.collect())
    assert sorted(tuple(r["theta"]) for r in rows) == want


def test_preview_and_similarity_lines(spark):
    cells = spark.createDataFrame([(0, "a", 0.123456), (0, "b", 0.00005)], "topic int, token string, p double")
    assert [r["value"] for r in T.format_topic_preview(cells).collect()] == ["0\ta\t0.1235"]
    hits = spark.createDataFrame([("q", "d", 0.5)], "query_name string, name string, score double")
    assert T.format_similarity(hits).first()["value"] == "q\td\t0.5000"


def test_null_and_zero_vectors_never_rank(spark):
    d = spark.createDataFrame([(1, "a", [1.0, 0.0]), (2, "b", None), (3, "c", [0.0, 0.0])],
                              "row_id bigint, name string, theta array<double>")
    q = spark.createDataFrame([(1, "q", [1.0, 1.0]), (2, "z", [0.0, 0.0]), (3, "n", None)],
                              "query_id bigint, query_name string, theta array<double>")
    got = [(r["query_id"], r["row_id"]) for r in similar_docs(d, q, 5).collect()]
    assert got == [(1, 1)]
