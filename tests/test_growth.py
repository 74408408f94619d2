"""What a fit writes and shuffles grows no faster than its pairs."""

import pytest
from pyspark.sql import functions as F

from topic_tables.operators import em
from topic_tables.operators import vocab as V
from topic_tables.operators.robust import fit_robust_plsa
from topic_tables.operators.vocab import bag_buckets, build_corpus
from topic_tables.sources.tables import tokens_from_text

WORDS = ["alpha", "beta", "Straße", "ÉTÉ", "x1", "中文"]


def _texts(spark, rows=40):
    data = [(i, None if i == 3 else "" if i == 4 else ", ".join(f"{WORDS[j % 6]} {'w%d' % (i * j % 17)}" for j in range(i % 9 + 1))) for i in range(rows)]
    return tokens_from_text(spark.createDataFrame(data, "id bigint, text string"), "id", "text")


def test_word_rows_of_a_pass_stay_in_proportion_to_the_pairs(spark):
    """A pass writes at most a row a word and bucket.  Vocabularies grow about
    as the root of the pairs, so buckets of fixed size gave a power of 1.5."""
    for pairs, words in ((200_000_000, 400_000), (1_000_000_000, 900_000), (4_000_000_000, 1_000_000)):
        rows = bag_buckets(spark, pairs, 1000, words) * words
        assert rows <= pairs / 15 < bag_buckets(spark, pairs, 1000) * words
    # the noise of a bucket fits a task, however large the vocabulary is
    assert bag_buckets(spark, 4_000_000_000, 1000, 50_000_000) >= 250
    # documents still bound a bucket, and small tables are as before
    assert bag_buckets(spark, 40_000_000, 5_000_000, 900_000) >= 50
    assert bag_buckets(spark, 1000, 10, 900_000) == bag_buckets(spark, 1000, 10)


def test_the_vocabulary_counts_for_the_buckets(spark, monkeypatch):
    monkeypatch.setattr(V, "PAIRS_PER_BUCKET", 2)
    monkeypatch.setattr(V, "PAIRS_A_WORD", 1)
    vocab, bags, _ = build_corpus(_texts(spark), 0)
    pairs = bags.count()
    assert vocab.size > 2 and bags._tt_buckets == max(-(-pairs // vocab.size), min(spark.sparkContext.defaultParallelism, -(-pairs // V.PAIRS_TO_SPREAD)))
    assert bags._tt_rows.count() == 38


def test_tokens_of_a_text_are_written_as_one_string(spark):
    docs = _texts(spark)
    raw = V.raw_pairs(docs)
    assert raw.written.schema["tokens"].dataType.typeName() == "string"
    want = {r["row_id"]: sorted(set(r["tokens"])) for r in docs.collect() if r["tokens"]}
    assert {r["row_id"]: sorted(r["tokens"]) for r in raw.table.collect()} == want
    assert {r["id"]: r["w"] for r in raw.by_document().select(F.col("row_id").alias("id"), "w").collect()} == {k: len(v) for k, v in want.items()}
    V.release(raw.table)


@pytest.mark.parametrize("limit", [None, "64"])
def test_any_token_of_a_list_is_kept(spark, limit):
    """Tokens that are given may hold what separates those of a text, or be empty."""
    docs = spark.createDataFrame([(1, ["a\nb", "a", "", "a\nb"]), (2, ["b", "\n", "a\nb"])], "row_id bigint, tokens array<string>")
    if limit:
        spark.conf.set("topic_tables.broadcastLimitBytes", limit)
    try:
        vocab, bags, counts = build_corpus(docs, 0)
    finally:
        spark.conf.unset("topic_tables.broadcastLimitBytes")
    assert {r["token"]: r["n"] for r in counts.collect()} == {"a\nb": 3, "a": 1, "": 1, "b": 1, "\n": 1}
    named = bags.join(vocab.table.select("word_id", "token"), "word_id")
    assert {(r["row_id"], r["token"], r["n"]) for r in named.collect()} == {(1, "a\nb", 2.0), (1, "a", 1.0), (1, "", 1.0), (2, "b", 1.0), (2, "\n", 1.0), (2, "a\nb", 1.0)}


def test_the_words_beside_the_last_noise_are_packed(spark, monkeypatch):
    written, write = [], em.write_bucketed
    monkeypatch.setattr(em, "write_bucketed", lambda df, keys, buckets, label, **kw: written.append((label, df.schema)) or write(df, keys, buckets, label, **kw))
    vocab, bags, _ = build_corpus(_texts(spark), 0)
    model = fit_robust_plsa(bags, vocab, 2, 2, gamma=0.3, eps=0.01)
    assert {s["words"].dataType.typeName() for label, s in written if label == "pass"} == {"binary"}
    got = {(r["row_id"], r["word_id"]): r["p"] for r in model.noise.collect()}
    # the same fit, whose noise is read beside the lists of the bags
    state = em.initial_state(bags, em.initial_phi(vocab, 2), vocab, em._Step(2, True, 0.3, 0.01))
    for it in range(2):
        state, *_ = em.advance(state, it, bags._tt_buckets, vocab, None, None, False, False)
    want = {(r["row_id"], r["word_id"]): r["p"] for r in em.noise_pairs(state.rows().join(state.theta(), ["row_id", "part"])).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    model.release()
