"""Connected components, and links inside buckets without all their pairs."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topic_tables.session import cut_lineage, release

#: Members of a bucket that one piece of work holds; longer buckets are cut.
CHUNK = 2048
#: Pairs of chunks are dealt to a task each, up to so many tasks.
MOST_TASKS = 10_000
#: Up to so many members a bucket is compared by shifting whole batches.
SHORT = 12

EDGES = "a bigint, b bigint"
Linked = Callable[[np.ndarray, np.ndarray], np.ndarray]


def forest(size: int, near: Callable[[int, int], np.ndarray], block: int = 512) -> np.ndarray:
    """Label of every member: the smallest member it reaches.  ``near(i, j)``
    gives the boolean rows i..j against all members."""
    label = np.arange(size, dtype=np.int32)
    rows = [np.packbits(near(i, min(size, i + block)), axis=1) for i in range(0, size, block)]
    while True:
        new = label.copy()
        for k, packed in enumerate(rows):
            hit = np.unpackbits(packed, axis=1, count=size).astype(bool)
            at = slice(k * block, k * block + len(hit))
            new[at] = np.minimum(new[at], np.where(hit, label, size).min(axis=1))
        low = new[new]
        # a label that fell pulls its former holder along
        np.minimum.at(low, label, new)
        low = low[low]
        if (low == label).all():
            return label
        label = low


def links_in_runs(keys: np.ndarray, values: np.ndarray, linked: Linked) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links inside the runs of equal keys of sorted arrays; a long run gives
    a spanning forest of its links, a short one its links."""
    out = []
    if not len(keys):
        return out
    run_starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[run_starts, len(keys)])
    short = np.repeat(sizes <= SHORT, sizes)
    for d in range(1, min(SHORT, len(keys))):
        i = np.flatnonzero((keys[:-d] == keys[d:]) & short[:-d])
        if not len(i):
            break
        i = i[linked(values[i], values[i + d])]
        out.append((values[i], values[i + d]))
    for k in np.flatnonzero(sizes > SHORT):
        v = values[run_starts[k]:run_starts[k] + sizes[k]]
        out.append(forest_links(v, linked))
    return out


def forest_links(v: np.ndarray, linked: Linked) -> tuple[np.ndarray, np.ndarray]:
    label = forest(len(v), lambda i, j: linked(v[i:j, None], v[None, :]))
    i = np.flatnonzero(label != np.arange(len(v)))
    return v[label[i]], v[i]


def _edge_batch(parts, key=None, chunk=None, members=None):
    a = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
    b = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int64)
    if len(a):
        ab = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
        a, b = ab[:, 0], ab[:, 1]
    extra = 1 if members is not None else 0
    return pa.RecordBatch.from_arrays([
        pa.array(np.r_[a, np.zeros(extra, np.int64)]), pa.array(np.r_[b, np.zeros(extra, np.int64)]),
        pa.array([None] * len(a) + [key] * extra, pa.int64()), pa.array([None] * len(a) + [chunk] * extra, pa.int32()),
        pa.array([None] * len(a) + [members] * extra, pa.binary())], ["a", "b", "key", "chunk", "members"])


def bucket_links(index: DataFrame, linked: Linked, label: str, partitions: int | None = None) -> DataFrame:
    """Links ``(a, b)`` between values that share a bucket and pass ``linked``.

    ``index(key bigint, value bigint)`` is shuffled and sorted by key once and
    streamed through numpy; the values of a run are compared there, and what
    leaves it keeps every component but not every pair.  A run beyond
    ``CHUNK`` members is cut: its chunks are rows of their own, and the pairs
    of chunks are dealt by (key, chunk, chunk), to as many tasks as there are
    pairs, so neither one task nor one row ever holds an unbounded bucket.
    """
    dealt = index.repartition(partitions, "key") if partitions else index.repartition("key")

    def run(batches):
        keys = values = np.zeros(0, np.int64)
        cut, chunks = None, 0                # key of a run that was cut, and its chunks so far
        for batch in chain(batches, [None]):
            if batch is not None:
                keys = np.r_[keys, batch.column(0).to_numpy(zero_copy_only=False)]
                values = np.r_[values, batch.column(1).to_numpy(zero_copy_only=False)]
            if not len(keys):
                continue
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            last = len(keys) if batch is None else int(starts[-1])   # the last run may go on
            starts = starts[starts < last]
            ends = np.r_[starts[1:], last][:len(starts)]
            whole = np.ones(last, bool)
            for s, e in zip(starts, ends):
                if e - s >= CHUNK or (s == 0 and keys[0] == cut):
                    whole[s:e] = False
                    n = chunks if s == 0 and keys[0] == cut else 0
                    for at in range(s, e, CHUNK):
                        v = values[at:min(e, at + CHUNK)]
                        yield _edge_batch([forest_links(v, linked)], int(keys[s]), n + (at - s) // CHUNK, v.tobytes())
            if last:
                cut = None
                parts = links_in_runs(keys[:last][whole], values[:last][whole], linked)
                if parts:
                    yield _edge_batch(parts)
            keys, values = keys[last:], values[last:]
            while len(keys) >= CHUNK:
                if cut != keys[0]:
                    cut, chunks = int(keys[0]), 0
                v = values[:CHUNK]
                yield _edge_batch([forest_links(v, linked)], cut, chunks, v.tobytes())
                keys, values, chunks = keys[CHUNK:], values[CHUNK:], chunks + 1

    found = cut_lineage(dealt.sortWithinPartitions("key", "value").select("key", "value")
                        .mapInArrow(run, "a bigint, b bigint, key bigint, chunk int, members binary"), label)
    cut = found.where("members is not null").select("key", "chunk", "members")
    ids = cut.select("key", "chunk")
    pairs = cut_lineage(ids.join(ids.withColumnRenamed("chunk", "chunk2"), "key").where("chunk < chunk2"), label + "-pairs")
    tasks = min(pairs.count(), MOST_TASKS)
    links = found.where("members is null").select("a", "b")
    if not tasks:
        return links.distinct()
    other = cut.select("key", F.col("chunk").alias("chunk2"), F.col("members").alias("members2"))
    # a given number of partitions: small rows, much work, so they are not to be merged
    both = (pairs.join(cut, ["key", "chunk"]).join(other, ["key", "chunk2"])
            .repartition(tasks, "key", "chunk", "chunk2").select("members", "members2"))

    def across(batches):
        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                v = np.unique(np.r_[np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)])
                a, b = forest_links(v, linked)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return links.unionByName(both.mapInArrow(across, EDGES)).distinct()


def _stars(edges: DataFrame, label: str) -> DataFrame:
    """Every node's larger neighbours, hung under its smallest one."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    low = cut_lineage(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), label + "-low")
    return both.where("v > u").join(low, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))


def _small_stars(edges: DataFrame, label: str) -> DataFrame:
    """Every node and its smaller neighbours, hung under the smallest of them."""
    low = cut_lineage(edges.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("m")), label + "-low")
    down = edges.select(F.col("b").alias("u"), F.col("a").alias("v")).join(low, "u")
    return (down.select(F.col("m").alias("a"), F.col("v").alias("b"))
            .unionByName(low.select(F.col("m").alias("a"), F.col("u").alias("b"))))


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``(node, component)`` of every node of ``edges(a, b)``, a <> b; the
    component is its smallest node.

    Alternating stars: each round hangs larger neighbours, then smaller ones,
    under the smallest neighbour; the number of rounds grows with the logarithm
    of the longest path.  Each round is written to the shared checkpoint
    folder, so lineage stays short and a lost executor costs one round.
    """
    now = cut_lineage(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                      .where("a <> b").distinct(), label)
    while True:
        large = cut_lineage(_stars(now, label).where("a <> b").distinct(), label)
        small = cut_lineage(_small_stars(large, label).where("a <> b").distinct(), label)
        release(now)
        release(large)
        now = small
        # Stars only: nobody hangs under a node that hangs itself, or under two.
        hung = now.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
            now.select(F.col("a").alias("node"), F.col("a").alias("root")))
        if hung.groupBy("node").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").isEmpty():
            break
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
