"""The corpus pipeline: stages over ``documents``, each one an operator of
``topic_tables.llm``.  Every stage is ``f(spark, docs, sf_dir) -> DataFrame``;
its result is written as Parquet and read again as the next stage's docs.  All
but the last return the columns of their docs.

  langid    rows without an identified language go
  simhash   one document of each near-duplicate component stays
  pii       personal data in the texts is replaced by the name of its kind
  mixing    documents stand as often as the mix takes them
  bpe       token number and digests of each document of the mix
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topic_tables.llm import bpe, langid, mixing, pii, queries, simhash
from topic_tables.llm.text import fold, read
from topic_tables.session import cut_lineage


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows a changed text."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(queries.PIECES)
    return langid.identified(docs, langid.fit(docs, path, fold("doc_id", 4) != 2), path)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(pii.redacted(docs, pii.fit(docs)))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(mixing.mixed(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.round_trip(docs, public_tokenizers.path(queries.BYTE_BPE)))


STAGES = [("langid", identify), ("simhash", deduplicate), ("pii", redact), ("mixing", mix), ("bpe", encode)]

#: Trained models and merge rounds have no SQL form; tests compare the stages
#: with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut_lineage(docs, name)
    return docs
