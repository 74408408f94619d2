import os
import random

import numpy as np
from pyspark import TaskContext

from topic_tables.llm import components as C


def least_reached(edges):
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return sorted((x, find(x)) for x in root)


def test_node_under_two_roots_is_one_row(spark):
    """After one round 5 hangs under 1 and under 2, and no root hangs."""
    edges = [(1, 10), (5, 10), (2, 11), (5, 11)]
    got = C.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert sorted((r["node"], r["component"]) for r in got) == [(x, 1) for x in (1, 2, 5, 10, 11)]


def test_every_node_of_random_chains_is_one_row(spark):
    rnd = random.Random(2)
    edges = []
    for k in range(100):
        chain = rnd.sample(range(100 * k, 100 * k + 100), rnd.randint(3, 8))
        edges += zip(chain, chain[1:])
    got = C.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert sorted((r["node"], r["component"]) for r in got) == least_reached(edges)


def test_chunk_pairs_of_one_bucket_are_spread_over_tasks(spark, monkeypatch, tmp_path):
    """Comparisons of two chunks leave the number of their task."""
    monkeypatch.setattr(C, "CHUNK", 8)
    seen = str(tmp_path)

    def linked(a, b):
        if b.size > 8:
            open(f"{seen}/{TaskContext.get().partitionId()}", "w").close()
        return np.abs(a - b) == 1

    index = spark.range(80).selectExpr("7L as key", "id as value")
    got = C.bucket_links(index, linked, "t", 3)
    nodes = C.components(got).collect()
    assert sorted((r["node"], r["component"]) for r in nodes) == [(i, 0) for i in range(80)]
    assert len(os.listdir(seen)) > 10                # 45 pairs of 10 chunks
