import numpy as np
import pytest

from topic_tables.llm import perplexity as P


def test_every_gram_is_kept(spark):
    """20,000 different symbols, each a word."""
    df = spark.createDataFrame([("zh", " ".join(chr(0x4E00 + i) for i in range(k, k + 5000))) for k in range(0, 20_000, 5000)], "lang string, text string")
    alpha, gamma = P.kneser_ney(P.top_grams(df))
    kept = P._sorted_arrays(alpha, 0), P._sorted_arrays(gamma, 1)
    for table, arrays in zip((alpha, gamma), kept):
        want = {(r["lang"], r["k"]): r["count"] for r in table.groupBy("lang", "k").count().collect()}
        assert {key: len(h) for key, (h, _) in arrays.items()} == want
        assert all((np.diff(h.astype(object)) > 0).all() for h, _ in arrays.values())
    assert want[("zh", 5)] == 20_001 and len(kept[0][("zh", 1)][0]) == 20_001


def test_every_language_has_a_model(spark):
    langs = [f"l{i:02d}" for i in range(14)]
    df = spark.createDataFrame([(i, "some words in a text " * 20, x) for i, x in enumerate([*langs, None])], "doc_id bigint, text string, lang string")
    assert sorted(r["model_lang"] for r in P.quality(df).collect()) == ["", *langs]


def test_model_in_tables_gives_the_same(spark, monkeypatch):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    more = [(-1, None, "en"), (-2, "", None), (-3, "日本 words\nand 😀 more", "xx"), (-3, "ü" * 50_000, "de"), (None, "one two " * 40, None)]
    df = df.unionByName(spark.createDataFrame(more, df.schema)).repartition(5)
    monkeypatch.setattr(P, "WORDS_AT_ONCE", 500)

    def rows():
        return sorted((tuple(r) for r in P.quality(df).collect()), key=lambda r: (str(r[0]), r[1:6]))
    want = rows()
    monkeypatch.setattr(P, "MODEL_ENTRIES", 0)
    monkeypatch.setattr(P, "CHUNK_CHARS", 100_000)
    got = rows()
    assert [r[:-1] for r in got] == [r[:-1] for r in want] and len(got) == df.count()
    assert [r[-1] for r in got] == pytest.approx([r[-1] for r in want], rel=1e-5)
