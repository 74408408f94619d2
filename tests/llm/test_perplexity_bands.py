"""The bands against numpy, and against junk and the labelled rows."""

import random

import numpy as np
from pyspark.sql import functions as F

from topic_tables.llm import perplexity as P


def test_bands_equal_numpy(spark):
    rng = np.random.default_rng(1)
    rows = [(lang, float(x), bool(rng.random() < 0.1)) for lang, n in (("a", 400), ("b", 37), ("c", 1)) for x in np.round(rng.gamma(3, 0.2, n), 3)]
    df = spark.createDataFrame(rows, "model_lang string, loss double, base_failed boolean")
    got = {r["model_lang"]: (r["low"], r["high"]) for r in P.bands_of(df, 3.0).collect()}
    for lang in "abc":
        x = np.sort([v for key, v, failed in rows if key == lang and not failed])
        if not len(x):
            continue
        below, middle, above = (x[int(np.ceil(q * len(x) - 1e-9)) - 1] for q in (0.1, 0.5, 0.9))
        want = middle - 3 * max(middle - below, P.LEAST_WIDTH), middle + 3 * max(above - middle, P.LEAST_WIDTH)
        np.testing.assert_allclose(got[lang], want, atol=1e-9)


def test_mashed_keys_go_and_prose_stays(spark):
    rng = random.Random(2)
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang = 'en'").select("doc_id", "text", "lang").collect()]
    mash = [(10_000 + i, " ".join("".join(rng.choices("qwertyuiopasdfghjklzxcvbnm", k=rng.randint(2, 9))) for _ in range(300)), "en") for i in range(25)]
    df = spark.createDataFrame(docs + mash, "doc_id bigint, text string, lang string")
    got = {r["doc_id"]: r for r in P.quality(df).collect()}
    assert not any(got[i]["kept"] or got[i]["base_failed"] for i, _, _ in mash)
    passed = [i for i, _, _ in docs if not got[i]["base_failed"]]
    assert sum(got[i]["kept"] for i in passed) >= 0.95 * len(passed)


def test_labelled_rows(spark):
    """Of documents that pass the base rules: good ones stay, some bad ones go."""
    sf = "/root/testdata/sf0.1"
    rows = P.quality(spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("not base_failed")
    rate = {r["quality"]: r["kept"] for r in rows.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert rate[1] >= 0.99 and rate[0] <= 0.8


def test_border_characters_in_texts(spark):
    """U+0002 and U+0003 in a text are symbols like any other to the base rules;
    to the model they look like word borders.  Nothing is lost by them."""
    words = [f"word{i}" for i in range(60)]
    rows = [(i, " ".join(words), "en") for i in range(20)] + [(90, " ".join(w + "\x02\x03" for w in words), "en"), (91, "\x02 \x03 " * 60, "en")]
    got = {r["doc_id"]: r for r in P.quality(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert len(got) == 22 and got[90]["n_words"] == 60 and got[90]["word_chars"] == got[0]["word_chars"] + 120 and got[91]["n_words"] == 120
    assert all(np.isfinite(r["perplexity"]) for r in got.values()) and got[91]["base_failed"] and not got[90]["kept"]
