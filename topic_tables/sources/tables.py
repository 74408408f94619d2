"""Turning parquet tables into token documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: a token is a maximal run of letters and decimal or other digits of any script, lower-cased.
TOKEN_PATTERN = r"[\p{L}\p{N}]+"


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokens_from_text(df: DataFrame, id_col: str, text_col: str, name_col: str | None = None) -> DataFrame:
    """``docs(row_id bigint, name string, tokens array<string>)`` from a text column.

    The id column is the document identity (names may repeat); only the id and
    text columns are read, so the parquet scan prunes everything else.  The text
    is kept beside the frame for passes that count tokens (``functions/tokens.py``).
    """
    name = F.col(name_col).cast("string") if name_col else F.col(id_col).cast("string")
    toks = F.transform(F.regexp_extract_all(F.col(text_col), F.lit(TOKEN_PATTERN), 0), lambda t: F.lower(t))
    row_id = F.col(id_col).cast("bigint").alias("row_id")
    out = df.select(row_id, name.alias("name"), F.coalesce(toks, F.array().cast("array<string>")).alias("tokens"))
    out._tt_text = df.select(row_id, F.col(text_col).cast("string").alias("text"))
    return out


def conversation_tokens(conversations: DataFrame) -> DataFrame:
    """Token rows ``(row_id, token)`` with one document per conversation.

    Bags only need counts, so the turns are never gathered into one row: each
    turn is exploded where it is read and the counts are merged by the
    (partially aggregated) bag builder.
    """
    toks = F.regexp_extract_all(F.col("text"), F.lit(TOKEN_PATTERN), 0)
    rows = conversations.select(F.col("conv_id").cast("bigint").alias("row_id"), F.explode(toks).alias("t"))
    return rows.select("row_id", F.lower("t").alias("token"))


def conversation_names(conversations: DataFrame) -> DataFrame:
    return (conversations.select(F.col("conv_id").cast("bigint").alias("row_id")).distinct()
            .select("row_id", F.col("row_id").cast("string").alias("name")))
