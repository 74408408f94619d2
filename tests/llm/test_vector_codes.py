import duckdb
import numpy as np
import pytest

from topic_tables.llm import queries as Q
from topic_tables.llm import vector_codes as V


def brute(rows, parts=16, entries=64, rounds=2):
    """Plain loops over (id, vector, label) rows."""
    kept = [r for r in rows if r[1] and all(x is not None and np.isfinite(x) for x in r[1])]
    if not kept:
        return []
    lengths = [len(r[1]) for r in kept]
    length = max(set(lengths), key=lambda n: (lengths.count(n), n))
    kept = [(i, [int(np.floor(256 * x)) for x in v], lab) for i, v, lab in kept if len(v) == length]
    w = length // parts
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[r[1][p * w:(p + 1) * w] for r in first] for p in range(parts)]

    def near(v):
        out = []
        for p in range(parts):
            x = v[p * w:(p + 1) * w]
            out.append(min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(books[p])))
        return out
    for _ in range(rounds):
        codes = [near(r[1]) for r in kept]
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [r[1][p * w:(p + 1) * w] for r, c in zip(kept, codes) if c[p][1] == e]
                if mine:
                    books[p] = books[p][:e] + [[sum(col) // len(mine) for col in zip(*mine)]] + books[p][e + 1:]
    out = []
    for i, v, lab in kept:
        c = near(v)
        out.append((i, "".join(f"{e:02x}" for _, e in c), sum(d for d, _ in c), lab))
    return [(i, code, err, sum(o[2] for o in out if o[3] == lab)) for i, code, err, lab in out]


def got(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int, code string").repartition(3)
    out, books = V.compress(df, **kw)
    return sorted(((r["id"], r["code"], r["error"], r["label_error"]) for r in out.collect()), key=str), books


def test_orchard_is_the_nearest_entry():
    rng = np.random.default_rng(1)
    for spread in (2, 40, 4000):           # few values: many ties and equal entries
        entries, x = rng.integers(-spread, spread, (64, 4)), rng.integers(-spread, spread, (3000, 4))
        book = V.Orchard(entries)
        at, d = book.nearest(x)
        full = ((x[:, None] - entries[None]) ** 2).sum(-1)
        assert (at == full.argmin(1)).all() and (d == full.min(1)).all()
    # tight clusters: the lists are left early
    entries = rng.integers(-4000, 4000, (64, 4))
    book = V.Orchard(entries)
    book.nearest(entries[rng.integers(0, 64, 1000)] + rng.integers(-20, 20, (1000, 4)))
    assert book.tried < 1000 * 16


def test_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in np.float32(rng.normal(size=32))], int(rng.integers(0, 3)) if i % 7 else None, "x") for i in range(150)]
    rows += [(200, None, 1, "x"), (201, [1.0, None] * 16, 1, "x"), (202, [float("nan")] * 32, 1, "x"), (203, [float("inf")] + [0.0] * 31, 2, "x"),
             (204, [], 1, "x"), (205, [1.0] * 16, 1, "x"), (None, [0.5] * 32, None, None), (3, rows[3][1], 1, "x"), (3, rows[3][1], 1, "x")]
    have, books = got(spark, rows)
    want = brute([r[:3] for r in rows])
    assert have == sorted(want, key=str)
    np.testing.assert_allclose(V.decode(have[0][1], books), books.entries[range(16), [int(have[0][1][2 * p:2 * p + 2], 16) for p in range(16)]].ravel() / 256)


def test_few_rows_salted_labels_and_refusals(spark):
    rows = [(1, [0.1] * 16, 1, ""), (2, [-0.1] * 16, None, "")]
    assert got(spark, rows)[0] == sorted(brute([r[:3] for r in rows]), key=str)
    assert got(spark, [])[0] == []
    with pytest.raises(ValueError):
        got(spark, [(1, [0.1] * 15, 1, "")])
    many = [(i, [float(i % 11)] * 16, 1 if i % 3 else i, "") for i in range(90)]
    spark.conf.set("topic_tables.broadcastLimitBytes", "100")
    try:
        assert got(spark, many, entries=4)[0] == sorted(brute([r[:3] for r in many], entries=4), key=str)
    finally:
        spark.conf.unset("topic_tables.broadcastLimitBytes")


def test_query_equals_sql_and_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    out = Q.op12_codes(spark, sf)
    have = sorted(tuple(r) for r in out.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect())
    assert [h[:4] for h in have] == sorted(brute([tuple(r) for r in rows]))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    assert sorted(con.sql(V.ORACLE).fetchall()) == have
