import random
import re

import numpy as np
import pytest

from topic_tables.llm import passages as P


def split(text):
    """Lower-cased words of a line with their code point offsets."""
    return [("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m.group()), m.start(), m.end())
            for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]


def brute(rows, least_words=P.MIN_WORDS):
    """Components of all lines by exact Jaccard of their shingles; nothing of
    the operator's own cutting is used."""
    paras = []
    for i, text in rows:
        at = 0
        for number, line in enumerate((text or "").split("\n")):
            w = split(line)
            if len(w) >= max(1, least_words):
                alone = tuple(x[0] for x in w)
                s = frozenset(alone[k:k + 5] for k in range(len(alone) - 4)) or frozenset([alone])
                paras.append((i, number, at + w[0][1], at + w[-1][2], len(w), s))
            at += len(line) + 1
    root = list(range(len(paras)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(paras)):
        for b in range(a):
            s, t = paras[a][5], paras[b][5]
            if len(s & t) >= 0.8 * len(s | t) - 1e-9:
                root[max(find(a), find(b))] = min(find(a), find(b))
    groups = {}
    for k, p in enumerate(paras):
        groups.setdefault(find(k), []).append(p)
    out = set()
    for g in groups.values():
        ids = sorted({p[0] for p in g if p[0] is not None})
        if len(ids) > 1:
            first = min((p[0], p[1]) for p in g if p[0] is not None)
            out |= {(p[0], p[1], p[2], p[3], p[4], len(g), first[0], (p[0], p[1]) == first) for p in g}
    return out


def rows_of(df):
    return {(r["doc_id"], r["paragraph"], r["start"], r["end"], r["n_words"], r["component_size"], r["rep_id"], r["kept"])
            for r in df.where("unit = 'paragraph'").collect()}


def words(rnd, n):
    return ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 8))) for _ in range(n)]


def planted(seed=1, docs=60):
    rnd = random.Random(seed)
    shared = [words(rnd, 60) for _ in range(3)]
    rows = []
    for i in range(docs):
        w = words(rnd, rnd.randint(20, 200))
        if i % 4 == 0:
            at = rnd.randrange(len(w))
            w = w[:at] + shared[i % 3] + w[at:]
        rows.append((i, rnd.choice([" ", "  ", "\n"]).join(w)))
    return rows, shared


def test_words_and_offsets():
    text = "Ab  cd\té \x85x\n" + "w" * 200
    start, end, doc, h = P._words([None, text, ""])
    assert [text[a:b] for a, b in zip(start, end)] == ["Ab", "cd", "é", "\x85x", "w" * 200] and set(doc) == {1}
    assert P._words(["aB c"])[3].tolist() == P._words(["Ab  c"])[3].tolist()
    assert len(set(P._words(["a b aa bb " + "x" * 64 + " " + "x" * 65])[3].tolist())) == 6


def test_units_do_not_depend_on_the_batch():
    rows, _ = planted()
    texts = [t for _, t in rows] + [None, "", "short", "one two\n\nthree four five six seven eight nine"]
    u = P.units(texts, 1)
    for i, t in enumerate(texts):
        v, at = P.units([t], 1), u.doc == i
        for name in ("chunk", "number", "first", "n_words", "start", "end", "h"):
            assert getattr(u, name)[at].tolist() == getattr(v, name).tolist()
        per = [u.shingles[a:b].tolist() for a, b, mine in zip(u.offset, u.offset[1:], at) if mine]
        assert per == [v.shingles[a:b].tolist() for a, b in zip(v.offset, v.offset[1:])]


def test_passages_inside_other_lines(spark):
    rows, shared = planted()
    got = P.repeated(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r["doc_id"] for r in got} == {i for i, _ in rows if i % 4 == 0}
    texts, inner = dict(rows), [set(x) for x in shared]
    for r in got:
        w = set(split_words(texts[r["doc_id"]][r["start"]:r["end"]]))
        assert any(w <= x for x in inner)


def test_each_run_of_50_words_holds_a_chunk():
    rnd = random.Random(4)
    for _ in range(300):
        run = words(rnd, 3 * P.WINDOW + P.MIN_WORDS)
        a, b = (P.units([" ".join(words(rnd, rnd.randint(0, 60)) + run + words(rnd, rnd.randint(0, 60)))]) for _ in range(2))
        assert set(a.h[a.chunk].tolist()) & set(b.h[b.chunk].tolist())


def split_words(text):
    return [x[0] for x in split(text)]


@pytest.mark.parametrize("least_words", [1, 8])
def test_lines_of_any_length_equal_brute_force(spark, least_words):
    """Equal lines of 1 to 60 words, among others, in any letter case."""
    rnd = random.Random(3)
    shared = [words(rnd, n) for n in (1, 2, 4, 5, 6, 7, 8, 9, 12, 15, 20, 30, 40, 50, 60) for _ in range(4)]
    rows = []
    for i in range(50):
        lines = [words(rnd, rnd.randint(1, 40)) for _ in range(3)] + rnd.sample(shared, 6)
        rnd.shuffle(lines)
        rows.append((i, "\n".join(rnd.choice([" ", "\t", "  "]).join(w).upper() if rnd.random() < 0.3 else " ".join(w) for w in lines)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert rows_of(P.repeated(df, least_words=least_words)) == brute(rows, least_words)


def test_similar_lines(spark):
    """Lines at a similarity of 0.8 or a little more; recall of the links."""
    rnd = random.Random(8)
    rows = []
    for i in range(300):
        w = words(rnd, rnd.randint(13, 60))
        v = w[:-1] + words(rnd, 1)                     # one shingle of ten or more differs
        rows += [(2 * i, " ".join(words(rnd, 12)) + "\n" + " ".join(w)), (2 * i + 1, " ".join(v) + "\n" + " ".join(words(rnd, 9)))]
    got, want = rows_of(P.repeated(spark.createDataFrame(rows, "doc_id bigint, text string"))), brute(rows)
    assert len(want) == 600 and got <= want and len(got) >= 0.95 * len(want)


@pytest.mark.parametrize("block", [2048, 4])
def test_near_copies_and_large_buckets(spark, monkeypatch, block):
    """Many variants of one passage; a small bound forces the path of blocks."""
    monkeypatch.setattr(P, "BLOCK", block)
    rnd = random.Random(5)
    base = words(rnd, 120)
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(rnd.randrange(3)):
            w[rnd.randrange(len(w))] = words(rnd, 1)[0]
        rows.append((i, " ".join(w)))
    rows += [(100 + i, " ".join(base)) for i in range(30)] + [(200 + i, " ".join(words(rnd, 80))) for i in range(10)]
    got = rows_of(P.repeated(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)))
    want = brute(rows)
    # equality but for pairs that no band holds (3 bands: under 1 % at 0.8)
    assert len(got ^ want) <= 0.02 * len(want) and {r[0] for r in got} == {r[0] for r in want}


def test_runs_and_removals(spark):
    """A repeated line of 20 words is no removal by itself; three in a row are."""
    rnd = random.Random(2)
    lines = [" ".join(words(rnd, 20)) for _ in range(3)]
    rows = [(1, lines[0] + "\n" + " ".join(words(rnd, 12)) + "\n" + lines[1]), (2, "\n".join(lines)), (3, "x\n" + "\n".join(lines))]
    got = {(r["doc_id"], r["paragraph"]): (r["run_words"], r["kept"], r["removed"])
           for r in P.repeated(spark.createDataFrame(rows, "doc_id bigint, text string")).where("unit = 'paragraph'").collect()}
    assert got == {(1, 0): (20, True, False), (1, 2): (20, True, False), (2, 0): (60, False, True), (2, 1): (60, False, True),
                   (2, 2): (60, True, False), (3, 1): (60, False, True), (3, 2): (60, False, True), (3, 3): (60, False, True)}


def test_band_recall():
    rng = np.random.default_rng(0)
    bands, hits, pairs = P.bands_for(), 0, 3000
    assert bands == 3
    for _ in range(pairs):
        common = rng.integers(0, 2**63, 8).astype(np.uint64)
        a, b = (np.r_[common, rng.integers(0, 2**63, 1).astype(np.uint64)] for _ in range(2))     # 8 / 10
        ka, kb = (P.band_keys(s, np.array([0, len(s)]), bands) for s in (a, b))
        hits += any(x[0] == y[0] for x, y in zip(ka, kb))
    assert hits / pairs > 0.98


def test_edges(spark):
    long = " ".join(words(random.Random(9), 40_000))
    rows = [(1, None), (2, ""), (3, "w " * 30_000), (4, "w " * 30_000), (5, long), (6, long), (6, long), (None, long), (7, "few words here")]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id bigint, text string, h int, number string")
    got = P.repeated(df).collect()
    assert rows_of(P.repeated(df)) == brute(rows) and {r["doc_id"] for r in got} == {3, 4, 5, 6, None}
    assert {r["rep_id"] for r in got} == {3, 5} and {r["unit"] for r in got} == {"paragraph"}
    # the same two rows of document 6, each an occurrence
    assert sorted(r["component_size"] for r in got) == [2, 2, 4, 4, 4, 4]
    one = spark.createDataFrame([(1, long + " " + long)], "doc_id bigint, text string")
    assert P.repeated(one).count() == 0 and P.repeated(df.limit(0)).count() == 0
