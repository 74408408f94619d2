"""Ids of text reads, strict readers, buckets, cleanup, ranking and tokens."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from topic_tables import SymmetricDirichlet, Prior, build_vocab, fit_plsa, fit_robust_plsa, fold_in, robust_fold_in, to_bags, tokens_from_text
from topic_tables.operators.metrics import perplexity
from topic_tables.operators.search import similar_docs, top_topics
from topic_tables.operators.vocab import bag_buckets
from topic_tables.session import ensure_checkpoint_dir, scratch_path
from topic_tables.sources import text as T


def test_row_ids_of_a_read_hold(spark):
    """The same read under two split sizes joins every name with its θ."""
    lines = spark.range(5000).select(F.concat_ws("\t", F.concat(F.lit("n"), "id"), F.lit("a:b"), F.concat(F.lit("0:0."), F.col("id"), F.lit(";1:0.5"))).alias("value"))
    path = scratch_path(spark, "ids")
    T.write_lines(lines.repartition(3), path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    dt = T.read_doc_topic(spark, path, 2)
    docs, theta = dt.select("row_id", "name"), dt.select("row_id", "theta")
    want = {f"n{i}": float(f"0.{i}") for i in range(5000)}
    try:
        for size in ("1000", "100000000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = {r["name"]: r["theta"][0] for r in docs.join(theta, "row_id").collect()}
            assert got == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("line", ["2\t0\t0.5", "-1\t0\t0.5", "0\t0", "0\tx\t0.5", "zz"])
def test_topic_word_reader_refuses(spark, line):
    df = spark.createDataFrame([("0\t0\t1.0",), (line,)], "value string")
    with pytest.raises(PySparkException):
        T.parse_topic_word_lines(df, 2).collect()


@pytest.mark.parametrize("cells", ["2:0.5", "0:0.5;-1:0.5", "0", "0:x", "0:0.5;"])
def test_doc_topic_reader_refuses(spark, cells):
    df = spark.createDataFrame([(f"d\ta:b\t{cells}",)], "value string")
    with pytest.raises(PySparkException):
        T.parse_doc_topic_lines(df, 2).collect()


def test_doc_topic_line_without_cells(spark):
    df = spark.createDataFrame([("d\ta:b\t",), ("e\tx",)], "value string")
    assert [(r["name"], r["theta"]) for r in T.parse_doc_topic_lines(df, 2).collect()] == [("d", None), ("e", None)]


def test_tokens_of_any_script(spark):
    df = spark.createDataFrame([(1, "L'été à 東京 2024: Straße_über"), (2, "主题 模型"), (3, None)], "id bigint, text string")
    got = {r["row_id"]: list(r["tokens"]) for r in tokens_from_text(df, "id", "text").collect()}
    assert got == {1: ["l", "été", "à", "東京", "2024", "straße", "über"], 2: ["主题", "模型"], 3: []}


def test_bucket_count_follows_the_documents(spark, golden):
    docs, vocab, bags = golden
    huge = type(vocab)(vocab.table, vocab.size, vocab.token_bytes, 4_800_000_000)
    assert to_bags(docs, huge)._tt_buckets == 1
    assert bag_buckets(spark, 40_000_000, 10) >= 10 and bag_buckets(spark, 1_000_000, 1_000_000) >= 10


def test_null_names_rank_first_however_rows_are_dealt(spark):
    rows = [(i, None if i % 3 == 0 else f"n{i:02d}", [1.0, 2.0]) for i in range(30)]
    d = spark.createDataFrame(rows, "row_id bigint, name string, theta array<double>")
    q = spark.createDataFrame([(1, "q", [2.0, 4.0])], "query_id bigint, query_name string, theta array<double>")
    for parts, size in ((1, 32 << 20), (30, 200)):
        got = similar_docs(d.repartition(parts), q, 5, doc_block_bytes=size).orderBy("rank").collect()
        assert [r["row_id"] for r in got] == [0, 3, 6, 9, 12]


def test_search_by_many_blocks(spark):
    import random
    rnd = random.Random(3)
    d = spark.createDataFrame([(i, f"d{i}", [rnd.random() for _ in range(4)]) for i in range(300)], "row_id bigint, name string, theta array<double>")
    q = spark.createDataFrame([(i, f"q{i}", [rnd.random() for _ in range(4)]) for i in range(50)], "query_id bigint, query_name string, theta array<double>")

    def rows(df):
        return sorted((r["query_id"], r["rank"], r["row_id"], round(r["score"], 12)) for r in df.collect())
    assert rows(similar_docs(d, q, 5)) == rows(similar_docs(d, q, 5, doc_block_bytes=2000, query_block_bytes=1000))


def test_checkpoint_folder_is_shared_or_named(spark):
    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    Context._tt_shipped = True

    class Session:
        sparkContext, conf = Context(), Conf()
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session())


def test_workers_find_the_package_from_anywhere(tmp_path):
    """A driver that only has the package on its own path, in another folder."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
import __spark_entry__
print("ROWS", __spark_entry__.queries()["similar_vectors"](spark, "/root/testdata/sf0.001").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS" in out.stdout, out.stderr[-2000:]


def _left(spark):
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext.getCheckpointDir())
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {s.getPath().getName() for s in fs.listStatus(root)}, {t.name for t in spark.catalog.listTables() if t.name.startswith("tt_")}


def test_release_leaves_nothing(spark, golden):
    docs, vocab, bags = golden
    for prior in (None, SymmetricDirichlet(1.5)):
        before = _left(spark)
        fit_plsa(bags, vocab, 2, 2, theta_prior=prior, phi_prior=prior).release()
        assert _left(spark) == before
    m = fit_robust_plsa(bags, vocab, 2, 2)
    p = fit_plsa(bags, vocab, 2, 2)
    before = _left(spark)
    robust_fold_in(docs, m, 4).release()
    fit_robust_plsa(bags, vocab, 2, 2).release()
    fold_in(docs, p, 2, method="row").release()
    fold_in(docs, p, 2, method="table").release()
    assert _left(spark) == before


def test_phi_prior_needs_cells(golden):
    _, vocab, bags = golden

    class Whole(Prior):
        def log_prob(self, vec, size):
            return F.lit(-5.0)

    class Cells(Prior):
        def cell_log_term(self, cell):
            return -cell

    with pytest.raises(TypeError):
        perplexity(fit_plsa(bags, vocab, 2, 2, phi_prior=Whole()), 10.0)
    plain, with_cells = fit_plsa(bags, vocab, 2, 2), fit_plsa(bags, vocab, 2, 2, phi_prior=Cells())
    assert perplexity(with_cells, 10.0) == pytest.approx(perplexity(plain, 10.0) * 2.718281828459045 ** 0.2)
    assert perplexity(fit_plsa(bags, vocab, 2, 2, theta_prior=Whole()), 10.0) > perplexity(plain, 10.0)


def test_wide_model_equals_numpy(spark):
    """K=100 against a direct computation."""
    import numpy as np
    from topic_tables import initial_phi
    docs = spark.createDataFrame([(i, f"d{i}", [f"w{(i * j) % 17}" for j in range(1, 12)]) for i in range(20)], "row_id bigint, name string, tokens array<string>")
    vocab = build_vocab(docs, 0)
    bags = to_bags(docs, vocab)
    m = fit_plsa(bags, vocab, 100, 3)
    n = np.zeros((20, vocab.size))
    for r in bags.collect():
        n[r["row_id"], r["word_id"]] = r["n"]
    phi = np.array([r["phi"] for r in initial_phi(vocab, 100).orderBy("word_id").collect()])
    theta = np.full((20, 100), 0.01)
    for _ in range(3):
        z = theta @ phi.T
        r = np.where(n > 0, n / z, 0)
        new_theta, new_phi = theta * (r @ phi), phi * (r.T @ theta)
        theta, phi = new_theta / new_theta.sum(1, keepdims=True), new_phi / new_phi.sum(0)
    got = {r["row_id"]: r["theta"] for r in m.theta.collect()}
    assert np.allclose([got[i] for i in range(20)], theta, atol=1e-10)
    assert np.allclose([r["phi"] for r in m.phi.orderBy("word_id").collect()], phi, atol=1e-10)


def test_top_topics_cut(golden):
    _, vocab, bags = golden
    m = fit_plsa(bags, vocab, 4, 2)
    assert top_topics(m.theta, 3).groupBy("row_id").count().where("count <> 3").count() == 0
