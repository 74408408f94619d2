import re
from collections import defaultdict

import duckdb
import pytest

from topic_tables.llm import mixing as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes):
    """Share by weight; what is above the ceiling is shared again."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        w = sum(weight[s] for s in names if s not in full)
        target = {s: 3.0 * sizes[s] if s in full else rest * weight[s] / w for s in names}
        above = {s for s in names if s not in full and target[s] > 3 * sizes[s]}
        if not above:
            return target
        full |= above


def check(rows, mix, block):
    docs = [tuple(r) for r in mix.documents.collect()]
    size = defaultdict(int)
    for _, s, t in rows:
        size[s] += len(WORD.findall(t or ""))
    target = brute_targets(size)
    assert sorted(((d[0], d[1], d[2]) for d in docs), key=str) == sorted(((i, s, len(WORD.findall(t or ""))) for i, s, t in rows), key=str)
    taken = defaultdict(int)
    for i, s, n, sn, goal, k in docs:
        assert sn == size[s] and goal == pytest.approx(target[s]) and 0 <= k <= 3 * n
        taken[s] += k
    for s in size:
        assert taken[s] == pytest.approx(target[s], abs=1.001)
    slots = mix.schedule.orderBy("slot", "no", "rank").collect()
    assert sum(r["words"] for r in slots) == sum(taken.values())
    ranks = defaultdict(list)
    for r in slots:
        ranks[r["no"]].append(r["rank"])
        assert 0 < r["words"] <= block
    assert all(sorted(v) == list(range(len(v))) for v in ranks.values())
    return docs, slots


ROWS = [(1, "b", "x " * 700), (2, "a", "y " * 90), (3, None, "z z"), (4, "c", None), (5, "c", ""), (6, "a", "y " * 90),
        (7, "d", "word"), (7, "d", "word"), (None, "e", "null id " * 40), (8, "b", "one two"), (8, "b", "one two")]


@pytest.mark.parametrize("block", [1, 7, 1024])
def test_small_sources(spark, block):
    df = spark.createDataFrame([(i, s, t, 1, 2) for i, s, t in ROWS], "doc_id bigint, source string, text string, size int, taken int")
    check(ROWS, M.mix(df, block_words=block), block)


def test_schedule_holds_every_source_in_its_share(spark):
    rows = [(i, "abc"[i % 3], "w " * (50 + i)) for i in range(60)]
    mix = M.mix(spark.createDataFrame(rows, "doc_id bigint, source string, text string").select("doc_id", "source", "text"), block_words=5)
    _, slots = check([(i, s, t) for i, s, t in rows], mix, 5)
    shares = {r["no"]: r["slots"] for r in mix.sources.collect()}
    n, got = len(slots), defaultdict(int)
    for k, r in enumerate(slots, 1):
        got[r["no"]] += 1
        assert all(abs(got[no] - k * s / n) <= 4 for no, s in shares.items())


def test_rerun_and_partitioning_agree(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    a = sorted(M.mix(df).documents.collect())
    assert a == sorted(M.mix(df.repartition(13, "text")).documents.collect())


def test_nothing(spark):
    empty = spark.createDataFrame([], "doc_id bigint, source string, text string")
    assert M.mix(empty).documents.count() == 0
    no_words = spark.createDataFrame([(1, "a", ""), (2, None, None)], "doc_id bigint, source string, text string")
    assert [(r["target"], r["taken"]) for r in M.mix(no_words).documents.collect()] == [(0.0, 0), (0.0, 0)]


def test_equals_sql(spark):
    from topic_tables.llm.queries import op3_mixing
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.01/documents.parquet'")
    want = con.sql(M.ORACLE).fetchall()
    cols = [c[0] for c in con.sql(M.ORACLE).description]
    got = [tuple(r[c] for c in cols) for r in op3_mixing(spark, "/root/testdata/sf0.01").collect()]
    assert sorted(got) == sorted(want)
