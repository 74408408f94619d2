"""Session helpers: building a local session for tests/bench, finding the shared
checkpoint folder that the cluster names in ``spark.checkpoint.dir``, and
sending the package's code to the executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: Files that a task of a write may have open, where its rows are not sorted.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"

JIT_FLAGS = os.environ.get("TOPIC_TABLES_JVM_FLAGS", "")


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "topic_tables") -> SparkSession:
    """A local session for tests and the bench (the UI stays off)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Extra JVM flags (e.g. -XX:-DontCompileHugeMethods so the K-wide
        # generated methods get JIT-compiled; it pays off only when a plan
        # runs long enough to amortise the compile).
        .config("spark.driver.extraJavaOptions", JIT_FLAGS)
        .config("spark.executor.extraJavaOptions", JIT_FLAGS)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    file system); we only pick our own folder when nothing is configured,
    which happens in local tests.
    """
    ship_package(spark)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="topic-tables-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the executors, once an application, so that
    functions which run there find it whatever their working folder is."""
    sc = spark.sparkContext
    if getattr(sc, "_tt_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(here)
    archive = os.path.join(tempfile.mkdtemp(prefix="topic-tables-code-"), f"{os.path.basename(here)}.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), root))
    sc.addPyFile(archive)
    sc._tt_shipped = True


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{label}-{uuid.uuid4().hex}"


@contextmanager
def _two_writers(spark: SparkSession):
    """Writes in which a task has at most two files open need no sort of their rows."""
    before = spark.conf.get(WRITERS)
    spark.conf.set(WRITERS, "2")
    try:
        yield
    finally:
        spark.conf.set(WRITERS, before)


def cut_lineage(df: DataFrame, label: str = "state") -> DataFrame:
    """Materialise ``df`` as parquet in the shared checkpoint folder and read
    it back, cutting the lineage.  Where the frame names a boolean column as its
    ``_tt_flag``, rows that have it set are kept in files of their own, so that
    a filter on it reads only those.

    One job (an eager ``checkpoint()`` of an unpersisted plan runs it twice:
    once for the action and once more to write the files).  Never
    ``localCheckpoint``: its blocks die with the executor that holds them,
    while these files survive executor loss.  The parquet read also gives the
    next step column pruning and filter pushdown.
    """
    spark = df.sparkSession
    path, flag = scratch_path(spark, label), getattr(df, "_tt_flag", None)
    if flag:
        with _two_writers(spark):
            df.write.mode("overwrite").partitionBy(flag).parquet(path)
        out = spark.read.schema(df.schema).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)
        out = spark.read.parquet(path)
    out._tt_path = path
    return out


def write_bucketed(df: DataFrame, keys: list[str], buckets: int, label: str,
                   prepartitioned: bool = False) -> DataFrame:
    """Write ``df`` as a parquet table bucketed on ``keys`` under the shared
    checkpoint folder and read it back.

    A bucketed scan reports ``HashPartitioning(keys, buckets)``, so later joins
    and aggregations on ``keys`` shuffle only the *other* side.  The table is
    durable: a lost executor costs a re-read, never a recompute of the lineage.
    With ``prepartitioned`` the caller guarantees ``df`` is already hash
    partitioned on ``keys`` into ``buckets`` parts, so each task writes one
    bucket and no extra shuffle is planned.  As a task's rows are of one bucket,
    they are not sorted by it before the write (more writers in a task would be).
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    name = f"tt_{label}_{uuid.uuid4().hex[:12]}"
    src = df if prepartitioned else df.repartition(buckets, *keys)
    with _two_writers(spark):
        (src.write.mode("overwrite")
           .bucketBy(buckets, *keys)
           .option("path", path)
           .saveAsTable(name))
    out = spark.table(name)
    out._tt_path, out._tt_table, out._tt_buckets = path, name, buckets
    return out


def open_bucketed(spark: SparkSession, path: str, schema, keys: list[str], buckets: int) -> DataFrame:
    """The table that :func:`write_bucketed` left at ``path``, also in another
    application, whose catalog does not know it."""
    name = f"tt_again_{uuid.uuid4().hex[:12]}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({', '.join(keys)}) INTO {buckets} BUCKETS LOCATION '{path}'")
    out = spark.table(name)
    out._tt_path, out._tt_table, out._tt_buckets = path, name, buckets
    return out


def release(df: DataFrame | None) -> None:
    """Delete an intermediate table written by :func:`cut_lineage` or
    :func:`write_bucketed` once nothing reads it any more (EM keeps only the
    current state, so a 100 TB corpus does not leave one pair-sized table per
    iteration behind).  DataFrames not written by us are left alone."""
    if df is None:
        return
    path = getattr(df, "_tt_path", None)
    if path is None:
        return
    spark = df.sparkSession
    name = getattr(df, "_tt_table", None)
    if name:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)
    df._tt_path = None


def drop_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files that nothing refers to any more, which
    it finds out when the driver's JVM collects its garbage."""
    spark.sparkContext._jvm.System.gc()


def default_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
