"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into two 32-bit segments.  Fingerprints at three
or fewer differing bits agree, but for at most one bit, on one segment, so that
segment's variant without that bit (one wildcard of 32) is equal.  Each
distinct fingerprint is indexed under its 64 variants; an equality join over
the variants finds every such pair, the bit distance is verified, and links
are joined into components.

Rows: a null text counts as the empty text (fingerprint zero, linked like any
other).  Equal fingerprints are one class whatever their number; the index
holds distinct fingerprints only.  A null id never becomes a component's name
unless all its ids are null.  Other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topic_tables.llm.components import bucket_links, components
from topic_tables.llm.text import column, slices
from topic_tables.session import cut_lineage

SEED = 42
BITS = 64
WORD_BYTES = re.compile(rb"[^\x20\x09-\x0D]+")
#: Hashes whose bits are counted at once.
RUN = 200_000


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Signed 64-bit SimHash of a text's word shingles (repeats included)."""
    words = WORD_BYTES.findall((text or "").encode("utf-8", "surrogatepass").lower())   # bytes: only A-Z change
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist())), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for k in range(0, n, RUN):
        part = hashes[k:k + RUN]
        ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(id, fp bigint)`` of every row; no shuffle."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in slices(batches, 1):
            fp = [fingerprint(t, shingle) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64())], ["id", "fp"])

    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"id {id_type}, fp bigint"))


def variants(fps: DataFrame) -> DataFrame:
    """``(key, value)``: each fingerprint under its 64 one-wildcard segment variants."""
    segment = "(shiftrightunsigned(fp, 32 * cast(j div 32 as int)) & 4294967295L)"
    return (fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(BITS - 1))).alias("j"))
            .select(F.expr(f"shiftleft(cast(j as bigint), 32) | ({segment} & ~shiftleft(1L, j % 32))").alias("key"),
                    F.col("fp").alias("value")))


def linked_within(bits: int):
    if bits > 3:
        raise ValueError("two segments find pairs at up to 3 differing bits")

    def linked(a, b):
        return np.bitwise_count(np.bitwise_xor(a, b).view(np.uint64)) <= bits
    return linked


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    bits: int = 3) -> DataFrame:
    """``(id, fp, component_id, root)`` of every row: the component is the
    smallest id reachable over links of at most ``bits`` differing bits, and
    root a fingerprint that names it whatever the ids."""
    marked = cut_lineage(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = cut_lineage(marked.groupBy("fp").agg(F.min("id").alias("low")), "distinct-fp")
    edges = bucket_links(variants(distinct), linked_within(bits), "simhash-links")
    nodes = components(edges, "simhash").select(F.col("node").alias("fp"), "component")
    classes = cut_lineage(nodes.join(distinct, "fp"), "simhash-classes")
    named = cut_lineage(classes.groupBy("component").agg(F.min("low").alias("least")), "simhash-names")
    moved = classes.join(named, "component").select("fp", "least", F.col("component").alias("root"))
    of_fp = cut_lineage(distinct.join(moved, "fp", "left").select("fp", F.coalesce("least", "low").alias("component_id"), F.coalesce("root", "fp").alias("root")),
                        "simhash-map")
    return marked.join(of_fp, "fp").select(F.col("id").alias(id_col), "fp", "component_id", "root")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, bits: int = 3) -> DataFrame:
    """The rows, with their columns, of one document of each component: the
    one with the smallest id (null last), one row of it if it is repeated."""
    near = near_duplicates(docs.select(column(id_col).alias("id"), column(text_col).alias("text")), "id", "text", shingle, bits)
    near = cut_lineage(near, "simhash-rows")
    best = near.groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "fp")).alias("best")).select("best.id", "best.fp")
    rows = near.groupBy("id").agg(F.count(F.lit(1)).alias("rows"))
    keep = best.join(rows.withColumnRenamed("id", "id2"), F.col("id").eqNullSafe(F.col("id2"))).drop("id2")
    keep = cut_lineage(keep, "simhash-keep")
    names = docs.columns
    at, text_at = names.index(id_col), names.index(text_col)
    safe = docs.toDF(*(f"c{i}" for i in range(len(names))))
    once = safe.join(keep.where("rows = 1").select("id"), F.col(f"c{at}").eqNullSafe(F.col("id")), "left_semi")
    # Rows of a repeated id are told apart by their own fingerprints.
    more = keep.where("rows > 1").select("id", "fp")
    again = safe.join(more.select("id").distinct(), F.col(f"c{at}").eqNullSafe(F.col("id")), "left_semi")

    def mark(batches):
        for b in slices(batches, text_at):
            fp = [fingerprint(t, shingle) for t in b.column(text_at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fp, pa.int64())], [*b.schema.names, "mark"])

    marked = again.mapInArrow(mark, T.StructType([*again.schema.fields, T.StructField("mark", T.LongType())]))
    marked = marked.join(more.withColumnRenamed("id", "id2"), F.col(f"c{at}").eqNullSafe(F.col("id2")) & (F.col("mark") == F.col("fp")), "left_semi")
    marked = marked.dropDuplicates([f"c{at}", "mark"]).drop("mark")
    return once.unionByName(marked).toDF(*names)


def hex_fingerprint(fp):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
