"""The registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topic_tables.llm import bpe, collocations, langid, mixing, passages, perplexity, pii, resharding, simhash, token_files, toxicity, vector_codes, vectors
from topic_tables.llm.text import fold, read

BYTE_BPE = "byte_bpe_50k.json"
BYTE_BPE_RANKS = "byte_bpe_50k.tiktoken"
PIECES = "piece_bpe_32k.model"


def op1_toxicity(spark, sf_dir) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    machine = toxicity.fit(docs, labels, fold("doc_id", 5) != 0)
    scored = toxicity.score(docs, machine)
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_perplexity(spark, sf_dir) -> DataFrame:
    return perplexity.quality(read(spark, sf_dir, "documents"))


def op3_mixing(spark, sf_dir) -> DataFrame:
    rows = mixing.mix(read(spark, sf_dir, "documents")).documents
    return rows.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


def op4_bpe(spark, sf_dir) -> DataFrame:
    return bpe.digests(bpe.round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE)))


def op5_langid(spark, sf_dir) -> DataFrame:
    docs, path = read(spark, sf_dir, "documents"), public_tokenizers.path(PIECES)
    model = langid.fit(docs, path, fold("doc_id", 4) != 2)
    found = langid.predict(docs, model, path)
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op6_simhash(spark, sf_dir) -> DataFrame:
    near = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return near.select("doc_id", simhash.hex_fingerprint("fp").alias("fingerprint"), "component_id")


def op7_vectors(spark, sf_dir) -> DataFrame:
    return vectors.near_duplicates(read(spark, sf_dir, "embeddings"))


def op8_pii(spark, sf_dir) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return pii.digests(pii.find(docs, pii.fit(docs)))


def op9_passages(spark, sf_dir) -> DataFrame:
    return passages.repeated(read(spark, sf_dir, "documents"))


def op10_token_counts(spark, sf_dir) -> DataFrame:
    return token_files.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE_RANKS))


def op11_resharding(spark, sf_dir) -> DataFrame:
    rows = resharding.reshard(resharding.write(read(spark, sf_dir, "documents"))).rows
    return rows.select("doc.doc_id", "size", F.crc32(F.coalesce("doc.text", F.lit("")).cast("binary")).alias("text_crc32"), F.lit("bytes").alias("law"),
                       "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op12_codes(spark, sf_dir) -> DataFrame:
    rows, books = vector_codes.compress(read(spark, sf_dir, "embeddings"))
    return rows.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(books.sha256() if books else None).cast("string").alias("codebooks_sha256"))


def op13_collocations(spark, sf_dir) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_toxicity, op2_perplexity, op3_mixing, op4_bpe, op5_langid, op6_simhash, op7_vectors,
                                    op8_pii, op9_passages, op10_token_counts, op11_resharding, op12_codes, op13_collocations)}


def oracle_sql() -> dict[str, str]:
    return {"op3_mixing": mixing.ORACLE, "op7_vectors": vectors.ORACLE, "op11_resharding": resharding.ORACLE, "op12_codes": vector_codes.ORACLE, "op13_collocations": collocations.ORACLE}
