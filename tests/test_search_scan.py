"""Vectors without clusters are scanned in files, with the hits of all pairs."""

import numpy as np
import pytest

from topic_tables.operators import search
from topic_tables.operators.search import similar_docs


def _brute(docs, queries, n):
    """Hits by all pairs: rounded score, then name (null first), then id."""
    out = []
    for qid, _, qv in queries:
        if qv is None or not any(qv):
            continue
        scored = [(-round(float(np.dot(qv, v) / np.linalg.norm(qv) / np.linalg.norm(v)), 8), name is not None, name or "", rid) for rid, name, v in docs if v is not None and any(v)]
        out += [(qid, rank, s[3], s[2] if s[1] else None) for rank, s in enumerate(sorted(scored)[:n], 1)]
    return sorted(out)


@pytest.mark.parametrize("width,block,at_once", [(24, 32 << 20, 8192), (24, 9000, 8192), (24, 9000, 16), (5, 4000, 16)])
def test_scan_of_vectors_without_clusters(spark, monkeypatch, width, block, at_once):
    monkeypatch.setattr(search, "DOCUMENTS_AT_ONCE", at_once)
    monkeypatch.setattr(search, "QUERIES_AT_ONCE", 7)
    monkeypatch.setattr(search, "CANDIDATES_AT_ONCE", 11 if at_once == 16 else 100_000)
    monkeypatch.setattr(search, "MOST_IN_REACH", 0.0 if width == 5 else search.MOST_IN_REACH)
    rng = np.random.default_rng(3)
    docs = [(i, None if i % 41 == 0 else f"d{i % 29}", v.tolist()) for i, v in enumerate(rng.normal(size=(300, width)))]
    docs += [(1000 + i, "same", docs[7][2]) for i in range(15)] + [(2000, "zero", [0.0] * width), (2001, "none", None)]
    queries = [(i, f"q{i}", v) for i, _, v in docs[:40]] + [(99, "zero", [0.0] * width), (98, "none", None), (97, "back", [-x for x in docs[7][2]])]
    d = spark.createDataFrame(docs, "row_id bigint, name string, theta array<double>").repartition(5)
    q = spark.createDataFrame(queries, "query_id bigint, query_name string, theta array<double>").repartition(3)
    hits = similar_docs(d, q, 20, doc_block_bytes=block)
    assert hits._tt_scored is None
    assert sorted((r["query_id"], r["rank"], r["row_id"], r["name"]) for r in hits.collect()) == _brute(docs, queries, 20)
