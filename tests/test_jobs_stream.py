"""Batch jobs (F6/F7) and the streaming fold-in on the sf0.001 tables."""

from pyspark.sql import functions as F

from conftest import SF001
from topic_tables.plans.jobs import search_job, train_job
from topic_tables.session import scratch_path
from topic_tables.sources.tables import load_table, tokens_from_text
from topic_tables.streaming.fold_in_stream import start_search_stream


def test_train_and_search_jobs(spark):
    docs = tokens_from_text(load_table(spark, SF001, "documents"), "doc_id", "text")
    tw, dt = scratch_path(spark, "tw"), scratch_path(spark, "dt")
    trained = train_job(docs, 3, 2, 15, topic_word_path=tw, doc_topic_path=dt)
    assert spark.read.text(tw).count() > 0
    assert spark.read.text(dt).count() == docs.count()
    q = tokens_from_text(load_table(spark, SF001, "benchmark"), "item_id", "text")
    sim, rep_t, rep_d = scratch_path(spark, "sim"), scratch_path(spark, "rt"), scratch_path(spark, "rd")
    hits = search_job(trained, q, 3, 5, sim, rep_t, rep_d)
    n_q = trained.model.theta.count() and q.count()
    assert hits.groupBy("query_id").count().where(F.col("count") > 5).count() == 0
    assert spark.read.text(sim).count() == hits.count() <= 5 * n_q
    assert spark.read.text(rep_t).count() == 3 * 30
    assert spark.read.text(rep_d).count() == trained.model.theta.where("theta is not null").count()


def test_streaming_fold_in(spark):
    docs = tokens_from_text(load_table(spark, SF001, "documents"), "doc_id", "text")
    trained = train_job(docs, 3, 2, 15)
    dtheta = trained.model.theta.join(docs.select("row_id", "name"), "row_id")
    bench = load_table(spark, SF001, "benchmark")
    src = scratch_path(spark, "stream-src")
    bench.write.parquet(src)
    stream = spark.readStream.schema(bench.schema).parquet(src)
    out, ck = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ck")
    _ckdir = spark.sparkContext.getCheckpointDir()
    _root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_ckdir)
    _fs = _root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    before = {st.getPath().getName() for st in _fs.listStatus(_root)}
    q = start_search_stream(stream, trained.model, dtheta, out, ck, iterations=2, n=3,
                            id_col="item_id", trigger_once=True)
    q.awaitTermination(300)
    res = spark.read.parquet(out)
    assert res.count() > 0
    # each micro-batch deleted its own bag and θ tables
    ckdir = spark.sparkContext.getCheckpointDir()
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(ckdir)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [st.getPath().getName() for st in fs.listStatus(root)]
    assert not any(nm.startswith(("bags-", "folded-", "docrows-", "stream-batch-")) and nm not in before for nm in names)
    assert res.groupBy("query_id").count().where(F.col("count") > 3).count() == 0


def test_load_model_round_trip(spark):
    import pytest
    from topic_tables import fold_in
    from topic_tables.plans.jobs import load_model
    docs = tokens_from_text(load_table(spark, SF001, "documents"), "doc_id", "text")
    tw, dt, vp = scratch_path(spark, "tw"), scratch_path(spark, "dt"), scratch_path(spark, "vocab")
    trained = train_job(docs, 3, 2, 15, topic_word_path=tw, doc_topic_path=dt, vocab_path=vp)
    loaded = load_model(spark, tw, vp, 3, dt)
    assert loaded.docs.count() == docs.count()
    q = tokens_from_text(load_table(spark, SF001, "benchmark"), "item_id", "text")
    a = {r["row_id"]: r["theta"] for r in fold_in(q, trained.model, 3).theta.collect()}
    b = {r["row_id"]: r["theta"] for r in fold_in(q, loaded.model, 3).theta.collect()}
    assert set(a) == set(b) and len(a) > 0
    for key in a:
        assert (a[key] is None) == (b[key] is None) and (a[key] is None or a[key] == pytest.approx(b[key], abs=1e-12))
    hits = search_job(loaded, q, 3, 5)
    assert hits.count() > 0


def test_replayed_batch_does_not_double(spark):
    from topic_tables.streaming.fold_in_stream import search_batch
    docs = tokens_from_text(load_table(spark, SF001, "documents"), "doc_id", "text")
    model = train_job(docs, 3, 2, 15).model
    dtheta = model.theta.join(docs.select("row_id", "name"), "row_id")
    out = scratch_path(spark, "replayed")
    bench = load_table(spark, SF001, "benchmark")
    counts = []
    for epoch in (0, 0, 1):
        search_batch(bench, epoch, model, dtheta, out, iterations=2, n=3, id_col="item_id")
        counts.append(spark.read.parquet(out).count())
    assert counts[0] == counts[1] and counts[2] == 2 * counts[0] > 0
