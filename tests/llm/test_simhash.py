import random

import numpy as np
import pytest
import xxhash

from topic_tables.llm import components as C
from topic_tables.llm import simhash as S


def brute_fingerprint(text, k=3):
    import re
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(ids, fps, bits):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                root[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i in range(len(fps)):
        groups.setdefault(find(i), []).append(ids[i])
    least = {g: min((x for x in m if x is not None), default=None) for g, m in groups.items()}
    return [least[find(i)] for i in range(len(fps))]


TEXTS = ["", None, "  \n\t", "One", "one", "a b", "A b c", "É a b C d", "x\x0by\x1cz\x85 q", "w " * 5000, "ß" * 70_000 + " end of it"]


def test_fingerprint_equals_definition():
    for t in TEXTS:
        assert S.fingerprint(t) & (2**64 - 1) == brute_fingerprint(t)


def test_fingerprint_hash_is_sparks(spark):
    got = spark.sql("select xxhash64('one two three') h").collect()[0]["h"]
    assert S.fingerprint("one TWO  three") == got


def signed(x):
    return x - 2**64 if x >= 2**63 else x


@pytest.mark.parametrize("chunk", [4, 2048])
def test_links_of_planted_fingerprints(spark, monkeypatch, chunk):
    """Chains, dense balls and random fingerprints; small chunks force the
    path of buckets that are cut."""
    monkeypatch.setattr(C, "CHUNK", chunk)
    rnd = random.Random(3)
    fps = [0, 2**64 - 1]
    for _ in range(12):
        x = rnd.getrandbits(64)
        for _ in range(rnd.randint(1, 30)):
            fps.append(x)
            for b in rnd.sample(range(64), rnd.randint(1, 5)):
                x ^= 1 << b
    base = rnd.getrandbits(64)
    fps += [base ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(a)]
    fps = list(dict.fromkeys(fps))
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp bigint")
    edges = C.bucket_links(S.variants(df), S.linked_within(3), "t", 3)
    comp = {r["node"]: r["component"] for r in C.components(edges).collect()}
    got = [comp.get(signed(x), signed(x)) for x in fps]
    assert got == brute_components([signed(x) for x in fps], fps, 3)


def test_near_duplicates(spark):
    base = [f"w{i}" for i in range(300)]
    near = base[:150] + ["other"] + base[151:]
    rows = [(10, " ".join(base)), (4, " ".join(base).upper()), (7, " ".join(near)), (7, " ".join(near)), (2, ""), (3, None), (None, "  ")]
    rows += [(100 + i, t) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id bigint, text string, fp string, component_id int")
    got = sorted(((r["doc_id"], r["fp"] & (2**64 - 1), r["component_id"]) for r in S.near_duplicates(df).collect()), key=str)
    fps = [brute_fingerprint(t) for _, t in rows]
    want = sorted(zip([i for i, _ in rows], fps, brute_components([i for i, _ in rows], fps, 3)), key=str)
    assert got == want


def test_documents_equal_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = df.select("doc_id", "text").collect()
    ids, fps = [r[0] for r in rows], [brute_fingerprint(r[1]) for r in rows]
    got = {r["doc_id"]: (r["fp"] & (2**64 - 1), r["component_id"]) for r in S.near_duplicates(df).collect()}
    assert got == {i: (f, c) for i, f, c in zip(ids, fps, brute_components(ids, fps, 3))}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert S.near_duplicates(df).count() == 0


def test_components_of_long_path_and_star(spark):
    n = 200
    path = [(i, i + 1) for i in range(n)]
    star = [(1000, 1001 + i) for i in range(500)]
    df = spark.createDataFrame([*path, *star, (5, 5)], "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in C.components(df).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, **{1000 + i: 1000 for i in range(501)}}


def test_forest_labels_are_least_members():
    rng = np.random.default_rng(0)
    for size in (1, 7, 700):
        near = rng.random((size, size)) < 1.2 / size
        near |= near.T
        label = C.forest(size, lambda i, j: near[i:j])
        for i in range(size):
            seen, todo = {i}, [i]
            while todo:
                for j in np.flatnonzero(near[todo.pop()]):
                    if j not in seen:
                        seen.add(j)
                        todo.append(j)
            assert label[i] == min(seen)
