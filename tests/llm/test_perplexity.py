import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from topic_tables.llm import perplexity as P


def brute_counts(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    hit = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)


TEXTS = [None, "", " \n\t", "one", "a b c a b c", "a a a a a", "x\nx\n\n \n \nx y\nx", "# $%\x85 é\x1f é <|>", "a b c d a b c\n" * 30, "w " * 70_000, "ü" * 150_000]


def test_base_counts():
    for t in TEXTS:
        assert P.base_counts(t)[1] == brute_counts(t)


class Brute:
    """Modified Kneser-Ney by its definition, in dictionaries."""

    def __init__(self, words):
        self.c = {P.ORDER: Counter()}
        for w, n in words.items():
            s = P.START * (P.ORDER - 1) + w + P.END
            for i in range(P.ORDER - 1, len(s)):
                self.c[P.ORDER][s[i - P.ORDER + 1:i + 1]] += n
        for k in range(P.ORDER - 1, 0, -1):
            self.c[k] = Counter()
            for g, n in self.c[k + 1].items():
                self.c[k][g[1:]] += n if g[1] == P.START else 1
        self.d = {}
        for k, c in self.c.items():
            n = Counter(c.values())
            y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
            ds = []
            for m, usual in ((1, 0.5), (2, 1.0), (3, 1.5)):
                v = m - (m + 1) * y * n[m + 1] / n[m] if n[m] else None
                ds.append(v if n[1] and v is not None and v > 0 else usual)
            self.d[k] = ds
        self.by = {k: defaultdict(list) for k in self.c}
        for k, c in self.c.items():
            for g, n in c.items():
                self.by[k][g[:-1]].append(n)

    def p(self, g):
        k = len(g)
        if not k:
            return 1 / 65536
        ns = self.by[k].get(g[:-1])
        if not ns:
            return self.p(g[1:])
        off = lambda n: self.d[k][min(n, 3) - 1]
        n = self.c[k].get(g, 0)
        return (max(n - off(n), 0) / sum(ns) if n else 0) + min(1, sum(map(off, ns)) / sum(ns)) * self.p(g[1:])

    def word(self, w):
        s = P.START * (P.ORDER - 1) + w + P.END
        return sum(math.log(self.p(s[i - P.ORDER + 1:i + 1])) for i in range(P.ORDER - 1, len(s)))


def test_model_equals_definition(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("lang in ('en', 'de')").select("lang", "text")
    words = defaultdict(Counter)
    for r in docs.collect():
        words[r["lang"]].update(P.WORD.findall(r["text"] or ""))
    alpha, gamma = P.kneser_ney(P.top_grams(docs))
    model = P._sorted_arrays(alpha, 0), P._sorted_arrays(gamma, 1)
    for lang, c in words.items():
        brute = Brute(c)
        some = [*list(c)[:150], "qqqq", "日本", "the" * 10, ""]
        assert P.word_scores(model, lang, some) == pytest.approx([brute.word(w) for w in some], rel=1e-4)


def test_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = {r["doc_id"]: r for r in P.quality(df).collect()}
    text = {r["doc_id"]: r for r in df.collect()}
    assert rows.keys() == text.keys()
    for i, r in rows.items():
        c = brute_counts(text[i]["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == c
        assert r["base_failed"] == (c[0] < 50 or 100 * c[4] > 50 * c[0])
        assert not (r["kept"] and r["base_failed"])
    # the bands, from the perplexities of all rows that pass the base rules
    for lang in {r["model_lang"] for r in rows.values()}:
        x = sorted(round(math.log(r["perplexity"]), 3) for r in rows.values() if r["model_lang"] == lang and not r["base_failed"])
        below, mid, above = (x[math.ceil(q * len(x) - 1e-9) - 1] for q in (P.TAIL, 0.5, 1 - P.TAIL))
        low, high = mid - P.BAND * max(mid - below, P.LEAST_WIDTH), mid + P.BAND * max(above - mid, P.LEAST_WIDTH)
        for r in rows.values():
            loss = math.log(r["perplexity"])
            if r["model_lang"] == lang and not r["base_failed"] and min(abs(loss - low), abs(loss - high)) > 1e-6:
                assert r["kept"] == (low <= loss <= high)


def test_edges(spark):
    rows = [(i, t, l) for i, t in enumerate(TEXTS) for l in ("en", None)] + [(None, "null id", "en"), (1, "", "en"), (1, "", "en")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, lang string, n_words int, kept string")
    got = P.quality(df).collect()
    assert len(got) == len(rows)
    assert all(np.isfinite(r["perplexity"]) and r["perplexity"] > 0 for r in got)
    assert P.quality(df.limit(0)).count() == 0


def test_more_languages_than_models(spark, monkeypatch):
    monkeypatch.setattr(P, "MAX_LANGS", 1)
    df = spark.createDataFrame([(i, "some words in a text " * 20, lang) for i, lang in enumerate("aabcd")], "doc_id bigint, text string, lang string")
    assert sorted(r["model_lang"] for r in P.quality(df).collect()) == ["", "", "", "a", "a"]


def test_small_memory_gives_the_same(spark, monkeypatch):
    model = P.Scorer(({("", 1): (np.array([1], np.uint64), np.array([0.5], np.float32))}, {}))
    whole = model.total("", [["a", "b"], ["c"], ["a", "c", "d"]])
    monkeypatch.setattr(P, "CACHE_WORDS", 0)
    one = P.Scorer(model.model)
    assert [one.total("", [w])[0] for w in (["a", "b"], ["c"], ["a", "c", "d"])] == pytest.approx(whole)
