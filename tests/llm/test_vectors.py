import duckdb
import numpy as np
import pytest

from topic_tables.llm import vectors as V


def brute(ids, vecs, threshold=0.95):
    n = len(ids)
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vecs]
    root, links = list(range(n)), [0] * n

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if o else None for v, o in zip(vecs, ok)]
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                links[i] += 1
                links[j] += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i in range(n):
        if ids[i] is not None:
            least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return [(ids[i], links[i], least.get(find(i)), ids[i] == least.get(find(i))) for i in range(n)]


def rows_of(df):
    return sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in df.collect()), key=str)


def test_embeddings_equal_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = df.collect()
    want = sorted(brute([r["vec_id"] for r in rows], [r["embedding"] for r in rows]), key=str)
    assert rows_of(V.near_duplicates(df)) == want
    con = duckdb.connect()
    con.execute("CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/sf0.01/embeddings.parquet'")
    assert sorted(con.sql(V.ORACLE).fetchall(), key=str) == want


@pytest.mark.parametrize("cell_rows,block_bytes", [(500, 4 << 20), (20, 4 << 20), (20, 400), (10_000, 1000)])
def test_planted(spark, cell_rows, block_bytes):
    """Tight groups over many cells and split blocks; every pair is well inside
    the margin, so the result is the exact one."""
    rng = np.random.default_rng(2)
    vecs = []
    for size in (1, 2, 60, 5, 1, 30):
        base = rng.normal(size=16)
        vecs += [(base * rng.uniform(0.5, 3) + rng.normal(size=16) * 0.02).tolist() for _ in range(size)]
    vecs += [rng.normal(size=16).tolist() for _ in range(120)] + [vecs[5]] * 40
    order = rng.permutation(len(vecs))
    vecs = [vecs[i] for i in order]
    df = spark.createDataFrame(list(enumerate(vecs)), "vec_id bigint, embedding array<double>").repartition(7)
    assert rows_of(V.near_duplicates(df, cell_rows=cell_rows, block_bytes=block_bytes)) == sorted(brute(list(range(len(vecs))), vecs), key=str)


def test_recall_at_the_threshold(spark):
    """Pairs that lie just above the threshold, over many cells."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    d = rng.normal(size=x.shape)
    d -= (d * x).sum(1, keepdims=True) * x
    d /= np.linalg.norm(d, axis=1, keepdims=True)
    c = rng.uniform(0.951, 0.97, (1500, 1))
    y = c * x + np.sqrt(1 - c ** 2) * d
    vecs = np.r_[x, y].tolist()
    df = spark.createDataFrame(list(enumerate(vecs)), "vec_id bigint, embedding array<double>")
    got = V.near_duplicates(df, cell_rows=60).where("n_links > 0").count()
    print("recall", got / 3000)
    assert got >= 0.97 * 3000


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 2.0]), (8, [2.0, 4.0]), (9, [1.0, 2.0, 0.0]),
            (10, [1.0, 2.0, 0.0]), (7, [1.0, 2.0]), (None, [1.0, 2.01]), (11, [-1.0, -2.0]), (12, [1e-300, 2e-300]), (13, [1e300, 2e300])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id bigint, embedding array<double>, n_links int, h int")
    got = rows_of(V.near_duplicates(df))
    ids, vecs = [r[0] for r in rows], [None if r[1] is None else [x if x is None or abs(x) in (0, inf) or not 1e-200 > abs(x) else x * 1e300 for x in r[1]] for r in rows]
    vecs = [None if v is None else [x / 1e300 if x is not None and np.isfinite(x) and abs(x) > 1e200 else x for x in v] for v in vecs]
    assert got == sorted(brute(ids, vecs), key=str)


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert V.near_duplicates(df).count() == 0
