import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from topic_tables.llm import token_files as T
from topic_tables.llm.queries import op10_token_counts
from topic_tables.session import scratch_path

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOK = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
TOK.encode_special_tokens = True


def tokens(text):
    return len(TOK.encode(text or "", add_special_tokens=False).ids)


def test_documents(spark):
    want = {r["doc_id"]: tokens(r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = op10_token_counts(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(want) and {r["doc_id"]: r["n_tokens"] for r in rows} == want


@pytest.mark.parametrize("block", [2, 6, 64, 1 << 20])
def test_edges_over_block_borders(spark, block):
    rows = [(1, None), (2, ""), (3, "a"), (4, "hello world " * 300), (4, "hello world " * 300), (None, "x<|endoftext|>y"), (5, "")]
    df = spark.createDataFrame([(i, t, "f", 9) for i, t in rows], "doc_id bigint, text string, file string, ordinal int").coalesce(2)
    got = sorted(((r["doc_id"], r["n_tokens"]) for r in T.count_tokens(df, RANKS, block_bytes=block).collect()), key=str)
    assert got == sorted(((i, tokens(t)) for i, t in rows), key=str)


@pytest.mark.parametrize("block", [2, 8, 4096])
def test_foreign_files(spark, tmp_path, block):
    """Files of any origin: no separator, only separators, an open end."""
    files = {"a.bin": [5, 6, 7], "b.bin": [9, 9], "c.bin": [1, 9, 9, 2, 3, 9, 4, 4], "d.bin": [], "e.bin": [1] * 999 + [9]}
    for name, ids in files.items():
        (tmp_path / name).write_bytes(np.array(ids, "<u2").tobytes())
    table = spark.createDataFrame([(n, 2 * len(x)) for n, x in files.items()], "file string, bytes bigint")
    got = sorted(map(tuple, T.stitch(T.scan_blocks(table, str(tmp_path), 9, block)).collect()))
    assert got == [("a.bin", 0, 3), ("b.bin", 0, 0), ("b.bin", 1, 0), ("c.bin", 0, 1), ("c.bin", 1, 0), ("c.bin", 2, 2), ("c.bin", 3, 2), ("e.bin", 0, 999)]


def test_half_files_are_not_read(spark):
    folder = scratch_path(spark, "half")
    fs, base = T._open(folder)
    fs.create_dir(base)
    with fs.open_output_stream(f"{base}/lost-attempt.bin") as f:
        f.write(b"\x01\x00\x02")
    manifest = T.write(spark.createDataFrame([(1, "one two")], "doc_id bigint, text string"), folder, RANKS)
    assert [r["file"] for r in manifest.where("bytes is not null").collect()] != ["lost-attempt.bin"]
    assert manifest.where("bytes is not null").count() == 1


def test_empty_table(spark):
    assert T.count_tokens(spark.createDataFrame([], "doc_id bigint, text string"), RANKS).count() == 0


def test_block_width():
    with pytest.raises(ValueError):
        T.scan_blocks(None, "", 0, 3)
