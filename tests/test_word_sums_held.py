"""A task's word sums are added up over its walks, also where φ has many
blocks: a word leaves a task once unless the sums outgrow their bound."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from topic_tables import build_vocab, to_bags
from topic_tables.operators import em
from topic_tables.operators.joins import hot_keys, lookup_join


@pytest.mark.parametrize("held", [None, 600, 60])
def test_a_word_leaves_a_task_once(spark, monkeypatch, held):
    docs = spark.createDataFrame([(i, str(i), [f"w{(i * j) % 23}" for j in range(1, 12)]) for i in range(300)],
                                 "row_id bigint, name string, tokens array<string>")
    vocab = build_vocab(docs, 0)
    bags = to_bags(docs, vocab, 2)
    step = em._Step(4)
    monkeypatch.setattr(em._walks, "__defaults__", (50,))
    want = em.state0_counts(bags, vocab, 4)
    want = {r["word_id"]: r["vec"] for r in want.collect()}
    spark.conf.set("topic_tables.broadcastLimitBytes", "200")
    if held:
        monkeypatch.setattr(em, "HELD_BYTES", held)
    try:
        state = em.initial_state(bags, em.initial_phi(vocab, 4), vocab, step)
        assert state.files.blocks > 3
        words = em.em_pass(step, state.rows(), state.theta(), state.files, True).where("word_id >= 0")
        rows = words.select("word_id", "vec", F.spark_partition_id().alias("task")).collect()
    finally:
        spark.conf.unset("topic_tables.broadcastLimitBytes")
    if held != 60:
        assert len(rows) == len({(r["word_id"], r["task"]) for r in rows})
    got = {}
    for r in rows:
        got[r["word_id"]] = got.get(r["word_id"], 0) + np.array(r["vec"][:4])
    assert set(got) == set(want) and all(np.allclose(got[w], want[w], rtol=1e-12) for w in want)


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_hot_keys_are_salted_without_a_join(spark, kind):
    big = spark.range(2000).select(F.when(F.col("id") % 50 == 0, F.col("id")).when(F.col("id") % 50 == 1, None)
                                   .otherwise(F.lit(2 ** 40 + 7)).cast(kind).alias("h"), F.col("id").alias("row"))
    side = big.select("h").where("h is not null").distinct().withColumn("v", F.xxhash64("h"))
    hot = hot_keys(big.groupBy("h").agg(F.count(F.lit(1)).alias("n")), "h", "n", 16)
    got = lookup_join(big, side, "h", 1 << 62, "row", hot)
    assert "LeftOuter" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert got.where("v = xxhash64(h)").count() == got.select("row").distinct().count() == got.count() == 1960
    assert lookup_join(big, side, "h", 1 << 62, "row", hot, "left").count() == 2000
