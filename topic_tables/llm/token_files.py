"""Token counts of documents in flat, unindexed token files.

A token file holds the ids of document after document, each closed by an
end-of-document id, and nothing else.  Files are cut into blocks of a fixed
number of bytes; each block is searched for separators in one vectorised pass
and gives the tokens before its first separator, those after its last, and the
documents between.  A prefix scan over a file's blocks then stitches documents
that cross block borders and numbers them.

Rows: a null text is a document without tokens, like the empty text.  Repeated
rows and ids are documents of their own.  Files are named by the task attempt
that wrote them, and only files that a finished task reported are read, so a
lost executor leaves no half file in the result.  An empty table writes no
file.  Other columns are not read.
"""

from __future__ import annotations

import base64
import re
import uuid
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topic_tables.llm.text import slices
from topic_tables.session import cut_lineage, scratch_path

#: Bytes of a block; a multiple of the width of an id.
BLOCK_BYTES = 4 << 20
#: White space (the Unicode property) in long runs.
LONG_BLANK = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]{20000,}")
WIDTH = 2                # bytes of an id, little-endian


@lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("flat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), len(ranks)


def encode(enc, text: str) -> list[int]:
    """Ids of a text.  The encoder's pattern recurses over a run of white space,
    so a long run is handed over as the piece that the pattern makes of it: all
    of it at the end of the text, else all but its last character."""
    ids, at = [], 0
    for run in LONG_BLANK.finditer(text):
        end = run.end() - (run.end() < len(text))
        ids += enc.encode_ordinary(text[at:run.start()]) + enc._encode_single_piece(text[run.start():end])
        at = end
    return ids + enc.encode_ordinary(text[at:])


def _open(folder: str):
    """File system and path of a folder URI (a bare path is local)."""
    if folder.startswith("file:"):
        folder = "/" + folder[5:].lstrip("/")
    if "://" in folder:
        return pafs.FileSystem.from_uri(folder)
    return pafs.LocalFileSystem(), folder


def write(docs: DataFrame, folder: str, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write token files, one a task, and return ``(file, bytes, ordinal, id)``:
    which document stands where.  The separator is the first id past the
    vocabulary, so no text can hold it."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        enc, end = _encoding(ranks_path)
        fs, base = _open(folder)
        name, out, done, size = f"{uuid.uuid4().hex}.bin", None, 0, 0
        for b in slices(batches, 1):
            if out is None:
                fs.create_dir(base, recursive=True)
                out = fs.open_output_stream(f"{base}/{name}")
            parts = []
            for text in b.column(1).to_pylist():
                parts += [np.array(encode(enc, text or ""), f"<u{WIDTH}"), np.array([end], f"<u{WIDTH}")]
            data = np.concatenate(parts).tobytes()
            out.write(data)
            size += len(data)
            yield pa.RecordBatch.from_arrays([pa.array([name] * b.num_rows), pa.array([None] * b.num_rows, pa.int64()),
                                              pa.array(np.arange(done, done + b.num_rows)), b.column(0)], ["file", "bytes", "ordinal", "id"])
            done += b.num_rows
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([size]), pa.array([None], pa.int64()), pa.array([None], b.column(0).type)],
                                             ["file", "bytes", "ordinal", "id"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return cut_lineage(rows.mapInArrow(run, f"file string, bytes bigint, ordinal bigint, id {id_type}"), "token-manifest")


def scan_blocks(files: DataFrame, folder: str, end: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(file, block, separators, head, tail, inner)`` for ``files(file, bytes)``:
    tokens before a block's first separator, after its last, and of the
    documents between.  Without a separator head and tail are the block."""
    if block_bytes % WIDTH:
        raise ValueError("blocks must hold whole ids")
    blocks = files.where("bytes > 0").select("file", "bytes", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("bytes") - 1) / block_bytes))).alias("block"))
    blocks = blocks.select("file", "block", (F.col("block") * block_bytes).alias("offset"),
                           F.least(F.lit(block_bytes).cast("bigint"), F.col("bytes") - F.col("block") * block_bytes).alias("length"))

    def run(batches):
        fs, base = _open(folder)
        for b in batches:
            for file, block, offset, length in zip(*(c.to_pylist() for c in b.columns)):
                with fs.open_input_file(f"{base}/{file}") as f:
                    ids = np.frombuffer(f.read_at(length, offset), f"<u{WIDTH}")
                at = np.flatnonzero(ids == end)
                head, tail = (int(at[0]), len(ids) - 1 - int(at[-1])) if len(at) else (len(ids), len(ids))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file]), pa.array([block]), pa.array([len(at)]), pa.array([head]), pa.array([tail]),
                     pa.array([np.diff(at) - 1], pa.list_(pa.int64()))], ["file", "block", "separators", "head", "tail", "inner"])

    return cut_lineage(blocks.repartition("file", "block").mapInArrow(
        run, "file string, block bigint, separators bigint, head bigint, tail bigint, inner array<bigint>"), "token-blocks")


def stitch(blocks: DataFrame) -> DataFrame:
    """``(file, ordinal, n_tokens)`` of every document; tokens after a file's
    last separator are one more document if there are any."""
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    narrow = (blocks.select("file", "block", "separators", "head", "tail")
              .withColumn("first", F.coalesce(F.sum("separators").over(before), F.lit(0)))
              # blocks since the last one with a separator belong together
              .withColumn("open", F.coalesce(F.sum((F.col("separators") > 0).cast("int")).over(order), F.lit(0)))
              .withColumn("since", F.sum("tail").over(Window.partitionBy("file", "open").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("carried", F.coalesce(F.lag("since").over(order), F.lit(0)))
              .withColumn("final", F.lead("block").over(order).isNull()))
    ends = narrow.where("separators > 0").select("file", F.col("first").alias("ordinal"), (F.col("carried") + F.col("head")).alias("n_tokens"))
    rest = narrow.where("final and since > 0").select("file", (F.col("first") + F.col("separators")).alias("ordinal"), F.col("since").alias("n_tokens"))
    inner = (blocks.where("separators > 1").select("file", "block", F.posexplode("inner").alias("i", "n_tokens"))
             .join(narrow.select("file", "block", "first"), ["file", "block"])
             .select("file", (F.col("first") + 1 + F.col("i")).alias("ordinal"), "n_tokens"))
    return ends.unionByName(rest).unionByName(inner)


def count_tokens(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text",
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Write ``docs`` as token files in the shared checkpoint folder, scan them
    and return ``(id, n_tokens)`` of every row."""
    spark: SparkSession = docs.sparkSession
    folder = scratch_path(spark, "token-files")
    manifest = write(docs, folder, ranks_path, id_col, text_col)
    files = manifest.where("bytes is not null").select("file", "bytes")
    scanned = scan_blocks(files, folder, _encoding(ranks_path)[1], block_bytes)
    fs, base = _open(folder)
    if fs.get_file_info(base).type != pafs.FileType.NotFound:
        fs.delete_dir(base)                    # the scan is written: nothing reads the tokens again
    counted = stitch(scanned)
    return (manifest.where("ordinal is not null").select("file", "ordinal", "id").join(counted, ["file", "ordinal"])
            .select(F.col("id").alias(id_col), "n_tokens"))
