"""The corpus pass: counts are made where a document's row is, ids that repeat
or are null are added up, and the plans hold no copy or hash of every pair."""

from collections import Counter

from topic_tables import build_corpus, corpus_stats
from topic_tables.operators import vocab as V


def _docs(spark):
    rows = [(1, "1", ["a", "b", "a"]), (1, "1", ["a", "c"]), (None, "n", ["a", "d"]), (None, "n", ["d"]), (2, "2", []),
            (3, "3", None), (4, "4", [f"w{i % 40}" for i in range(100)]), (5, "5", ["é", "b", "b"])]
    return rows, spark.createDataFrame(rows, "row_id bigint, name string, tokens array<string>")


def _bags(vocab, bags):
    return {(r["row_id"], r["token"]): r["n"] for r in bags.join(vocab.table.select("word_id", "token"), "word_id").collect()}


def test_counts_are_added_up_over_rows_of_one_id(spark):
    rows, docs = _docs(spark)
    want = Counter((i, t) for i, _, tokens in rows for t in tokens or [])
    for share in (None, "10"):
        if share:
            spark.conf.set("topic_tables.documentPartRows", share)
        try:
            vocab, bags, counts = build_corpus(docs, 0)
        finally:
            spark.conf.unset("topic_tables.documentPartRows")
        assert _bags(vocab, bags) == want and bags.count() == len(want)
        assert bags._tt_split == bool(share)
        assert {r["token"]: r["n"] for r in counts.collect()} == Counter(t for _, _, tokens in rows for t in tokens or [])
        assert _bags(vocab, V.to_bags(docs, vocab)) == want


def test_small_runs_of_tokens(spark, monkeypatch):
    rows, docs = _docs(spark)
    monkeypatch.setattr(V, "TOKENS_AT_ONCE", 3)
    monkeypatch.setattr(V, "PAIRS_A_BATCH", 2)
    batches = [b for b in V._token_counts_of(docs.where("row_id is not null").select("row_id", "tokens").toArrow().to_batches())]
    got = Counter()
    for b in batches:
        for row, token, n, _ in zip(*(c.to_pylist() for c in b.columns)):
            got[row, token] += n
    assert got == Counter((i, t) for i, _, tokens in rows if i is not None for t in tokens or [])
    assert sum(sum(b.column(3).to_pylist()) for b in batches) == sum(b.num_rows for b in batches)


def test_no_copy_of_the_pairs_for_a_count(spark):
    _, docs = _docs(spark)
    vocab, bags, _ = build_corpus(docs, 0)
    stats = corpus_stats(bags)
    assert "Expand" not in stats._jdf.queryExecution().executedPlan().toString()
    r = stats.first()
    assert (r["n_words"], r["n_docs"], r["n_pairs"], r["collection_length"]) == (45, 3, 47, 111.0)
    none = corpus_stats(bags.limit(0)).first()
    assert (none["n_words"], none["n_docs"], none["n_pairs"], none["collection_length"]) == (0, 0, 0, None)


def test_tokens_are_not_shuffled_by_the_text_pass(spark, monkeypatch):
    _, docs = _docs(spark)
    plans, cut = [], V.cut_lineage

    def watched(df, label="state"):
        if label == "rawpairs":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df, label)
    monkeypatch.setattr(V, "cut_lineage", watched)
    build_corpus(docs, 0)
    assert plans and "Exchange" not in plans[0] and "HashAggregate" not in plans[0]
