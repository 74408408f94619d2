import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from topic_tables.llm import queries as Q
from topic_tables.llm import resharding as R


def fewest(sizes, capacities):
    return sum(max(0, s - (capacities[i] if i < len(capacities) else 0)) for i, s in enumerate(sizes))


def test_flow_is_greatest_and_cheapest():
    # two ways from 0 to 3; the cheap one is narrow
    arcs = [(0, 1, 4, 1), (0, 2, 9, 5), (1, 3, 4, 1), (2, 3, 6, 1), (1, 2, 3, 0)]
    assert min(R.min_cost_flow(4, arcs, 0, 3)) >= 0
    flow = R.min_cost_flow(4, arcs, 0, 3)
    assert flow[2] + flow[3] == 10 and sum(f * a[3] for f, a in zip(flow, arcs)) == 4 * 2 + 6 * 6
    rng = random.Random(1)
    for _ in range(60):                        # against every assignment of unit supplies
        n, m = rng.randint(1, 3), rng.randint(1, 3)
        supply, room = [rng.randint(0, 2) for _ in range(n)], [rng.randint(0, 3) for _ in range(m)]
        cost = [[rng.randint(0, 4) for _ in range(m)] for _ in range(n)]
        units = [i for i in range(n) for _ in range(supply[i])]
        best = (0, 0)

        def place(k, left, sent, paid):
            nonlocal best
            if k == len(units):
                best = min(best, (-sent, paid))
                return
            place(k + 1, left, sent, paid)
            for j in range(m):
                if left[j]:
                    place(k + 1, left[:j] + [left[j] - 1] + left[j + 1:], sent + 1, paid + cost[units[k]][j])
        place(0, room, 0, 0)
        arcs = [(n + m, i, supply[i], 0) for i in range(n)] + [(i, n + j, 9, cost[i][j]) for i in range(n) for j in range(m)] + [(n + j, n + m + 1, room[j], 0) for j in range(m)]
        flow = R.min_cost_flow(n + m + 2, arcs, n + m, n + m + 1)
        assert (-sum(flow[:n]), sum(f * a[3] for f, a in zip(flow, arcs))) == best


def test_plans_move_the_fewest_bytes():
    rng = random.Random(2)
    for _ in range(100):
        sizes = [rng.randint(0, 1000) for _ in range(rng.randint(1, 9))]
        n = rng.randint(1, 9)
        plan = R.solve(sizes, n)
        assert sum(plan.capacities) == sum(sizes) and max(plan.capacities) - min(plan.capacities) <= 1
        assert plan.moved == fewest(sizes, plan.capacities)
        given = [rng.randint(0, 500) + sum(sizes) // n + 1 for _ in range(n)]
        assert R.solve(sizes, given).moved == fewest(sizes, given)
    with pytest.raises(ValueError):
        R.solve([5, 5], [4, 5])


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, shard int, slot string, doc string").repartition(3)


def check(spark, rows, n, **kw):
    old = R.write(frame(spark, rows), **kw)
    before = {(r["shard"], r["slot"]): r["doc"] for r in old.rows.collect()}
    out = R.reshard(old, n)
    have = out.rows.collect()
    assert sorted(map(str, (tuple(r["doc"]) for r in have))) == sorted(map(str, (tuple(r) for r in rows)))
    assert all(r["size"] == len((r["doc"]["text"] or "").encode()) + 16 for r in have)
    slots = {}
    for r in have:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(0 <= s < out.shards for s in slots)
    stays = sum(r["size"] for r in have if before.get((r["shard"], r["slot"])) == r["doc"])
    return old, out, have, stays


def test_rows_slots_and_moves(spark):
    rng = random.Random(3)
    rows = [(i, "é" * rng.randint(0, 60), 1, "s", "d") for i in range(3000)]
    rows += [(None, None, None, None, None), (None, "", 1, "", ""), (5, "same", 1, "s", "d"), (5, "same", 1, "s", "d")]
    total = sum(len((r[1] or "").encode()) + 16 for r in rows)
    for n in (40, 7, [total // 3] * 2 + [total]):
        old, out, have, stays = check(spark, rows, n, block_bytes=4000)
        sums = {}
        for r in have:
            sums[r["shard"]] = sums.get(r["shard"], 0) + r["size"]
        if isinstance(n, int):
            assert max(sums.values()) - min(sums.values()) < 300
            assert abs((total - stays) - out.moved_bytes) < 300 * n
        assert out.read_bytes < total or n == 7


def test_untouched_files_are_not_read(spark):
    rows = [(i, "x" * (i % 200), 1, "s", "d") for i in range(8000)]
    old, out, have, _ = check(spark, rows, 33, block_bytes=8000)
    total = sum(r["size"] for r in have)
    assert out.moved_bytes <= out.read_bytes < total / 4


def test_hot_ids_large_rows_few_and_none(spark):
    # one id holds most rows; some rows are larger than an equal share
    rows = [(7, f"text {i % 5}", 1, "s", "d") for i in range(900)] + [(i, "y" * 30, 1, "s", "d") for i in range(300)]
    rows += [(1, "long" * 9000, 1, "s", "d"), (2, "l" * 30000, 1, "s", "d"), (1, "z" * 30000, 1, "s", "d")]
    _, out, have, _ = check(spark, rows, 12)
    sums = {}
    for r in have:
        sums[r["shard"]] = sums.get(r["shard"], 0) + r["size"]
    rest = sorted(sums.values())[:-3]
    assert sorted(sums.values())[-3:] == [30016, 30016, 36016] and max(rest) - min(rest) < 100
    check(spark, [(1, "a", 1, "s", "d"), (2, None, 1, "s", "d")], 40)
    assert check(spark, [], 40)[2] == []


def test_query_equals_sql(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        out = Q.op11_resharding(spark, sf)
        have = sorted(tuple(r) for r in out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard").collect())
        texts = dict(map(tuple, spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()))
        assert all(r[2] == zlib.crc32((texts[r[0]] or "").encode()) for r in have) and len(have) == len(texts)
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
        assert sorted(con.execute(R.ORACLE).fetchall()) == have
