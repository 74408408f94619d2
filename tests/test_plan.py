"""Physical plan of one EM pass: the pairs are never exchanged."""

import pytest

from topic_tables import build_vocab, to_bags
from topic_tables.operators.em import _Step, em_pass, initial_phi, initial_state, next_theta, word_counts
from topic_tables.session import write_bucketed
from topic_tables.sources.tables import load_table, tokens_from_text

from conftest import SF001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_auto_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def _corpus(spark):
    docs = tokens_from_text(load_table(spark, SF001, "documents"), "doc_id", "text")
    vocab = build_vocab(docs, 15)
    return vocab, to_bags(docs, vocab)


@pytest.mark.parametrize("k,robust", [(4, False), (100, False), (4, True)])
@pytest.mark.parametrize("limit", [None, "900"])
def test_no_exchange_of_pairs(spark, no_auto_broadcast, k, robust, limit):
    """Also where φ is far larger than the broadcast limit (many word blocks)."""
    vocab, bags = _corpus(spark)
    if limit:
        spark.conf.set("topic_tables.broadcastLimitBytes", limit)
    try:
        step = _Step(k, robust, 0.3 if robust else 0.0, 0.01 if robust else 0.0)
        state = initial_state(bags, initial_phi(vocab, k), vocab, step)
        assert state.hot is None             # no huge document at this size
        assert (state.files.blocks > 20) == bool(limit)
        plan = _plan(em_pass(step, state.rows(), state.theta(), state.files, True))
        assert "Exchange" not in plan and "ShuffledHashJoin [row_id" in plan and "Bucketed: true" in plan
        # one scan of the rows and one of θ, however many blocks
        assert plan.count("Scan parquet") == 2
    finally:
        spark.conf.unset("topic_tables.broadcastLimitBytes")


def test_m_step_moves_only_word_sums(spark, no_auto_broadcast):
    vocab, bags = _corpus(spark)
    step = _Step(4)
    state = initial_state(bags, initial_phi(vocab, 4), vocab, step)
    passed = write_bucketed(em_pass(step, state.rows(), state.theta(), state.files, True), ["row_id", "part"], bags._tt_buckets, "pass", prepartitioned=True)
    assert "Exchange" not in _plan(next_theta(step, passed, state.theta(), state.hot, None))
    words = _plan(word_counts(step, passed))
    assert words.count("Exchange") == 1 and "Exchange hashpartitioning(word_id" in words


def test_split_documents_move_only_their_sums(spark, no_auto_broadcast):
    spark.conf.set("topic_tables.documentPartRows", "50")
    try:
        vocab, bags = _corpus(spark)
        step = _Step(4)
        state = initial_state(bags, initial_phi(vocab, 4), vocab, step)
        assert state.hot is not None
        assert "Exchange" not in _plan(em_pass(step, state.rows(), state.theta(), state.files, True))
    finally:
        spark.conf.unset("topic_tables.documentPartRows")


def test_scan_prunes_columns(spark):
    docs = tokens_from_text(load_table(spark, SF001, "documents"), "doc_id", "text")
    p = _plan(docs)
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p
