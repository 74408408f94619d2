"""Small helpers that several operators share."""

from __future__ import annotations

import re

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topic_tables.session import ensure_checkpoint_dir

#: A word is a maximal run of characters other than space, \t, \n, \v, \f, \r.
WORD_CLASS = r"[^\x20\x09-\x0D]+"
WORD = re.compile(WORD_CLASS)
#: A run of letters (no digits, no underscore).
LETTERS = re.compile(r"[^\W\d_]+")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def column(name: str) -> Column:
    """The column of exactly that name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def fold(id_col: str, salt: int) -> Column:
    """crc32 of the id's text modulo ``salt``, the split that the contracts name
    (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % salt


def share(id_col: str) -> Column:
    """A deterministic number in [0, 1) from the id, independent of the split."""
    h = F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("sample"))
    return F.pmod(h, F.lit(1 << 30)) / float(1 << 30)


def slices(batches, text_at: int, limit: int = 4_000_000):
    """Cut Arrow batches into runs of rows with about ``limit`` text bytes, so
    that what an operator builds for a run stays small whatever the batch size.
    A single longer text makes a run of its own."""
    for batch in batches:
        col = batch.column(text_at)
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(col), 0).to_pylist()
        cuts, acc = [0], 0
        for i, s in enumerate(sizes):
            if acc and acc + s > limit:
                cuts.append(i)
                acc = 0
            acc += s
        cuts.append(batch.num_rows)
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def gather_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start..start+length-1 of every range, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
