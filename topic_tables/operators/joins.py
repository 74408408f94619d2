"""Key lookups of a large table against a keyed side table.

The side table is broadcast only when its size is *proven* below a limit
(exact row count times a per-row byte bound).  Otherwise the join shuffles on
(key, salt): keys that hold more than 1/P of the big side are split over
several salts, and only those keys' side rows are replicated.  The hot-key
list has at most P entries (P hot keys already cover all rows), so that list
itself is safe to write into the plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_LIMIT = 256 * 1024 * 1024


def broadcast_limit(spark) -> int:
    v = spark.conf.get("topic_tables.broadcastLimitBytes", None)
    return int(v) if v else DEFAULT_BROADCAST_LIMIT


def hot_keys(weights: DataFrame, key: str, weight: str, partitions: int,
             share: float | None = None) -> DataFrame:
    """Keys whose weight exceeds ``share`` (default total/partitions), with
    their salt count ceil(weight/share) capped at ``partitions``.  With the
    default share there are at most ``partitions`` such keys."""
    if share is None:
        total = weights.agg(F.sum(weight).alias("t")).first()["t"] or 0
        if total <= 0:
            return weights.select(key).limit(0).withColumn("salts", F.lit(1))
        share = float(total) / partitions
    return (weights.where(F.col(weight) > share)
            .select(key, F.least(F.lit(partitions),
                                 F.ceil(F.col(weight) / F.lit(share)).cast("int")).alias("salts")))


def lookup_join(big: DataFrame, side: DataFrame, key: str, side_bytes: int,
                spread_col: str, hot: DataFrame | None = None, how: str = "inner") -> DataFrame:
    """Join ``big`` to ``side`` on ``key``.

    ``side_bytes`` is an upper bound on the side's in-memory size; ``hot`` is the
    (key, salts) table from :func:`hot_keys`; ``spread_col`` is a column of
    ``big`` used to spread one hot key over its salts (a document id).
    """
    limit = broadcast_limit(big.sparkSession)
    if side_bytes <= limit:
        return big.join(F.broadcast(side), key, how)
    if hot is None:
        return big.join(side.hint("shuffle_hash"), key, how)
    kind = big.schema[key].dataType
    salts = {r[0]: r[1] for r in hot.select(key, "salts").where(F.col(key).isNotNull()).collect()}   # a row a hot key
    if not salts:
        return big.join(side.hint("shuffle_hash"), key, how)
    # The list is written into the expressions, so no row of either side is joined to it.
    is_hot = F.col(key).isin([F.lit(k).cast(kind) for k in salts])
    count = F.element_at(F.create_map(*(c for k, n in salts.items() for c in (F.lit(k).cast(kind), F.lit(n)))), F.col(key))
    big_s = big.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(spread_col), count).cast("int")).otherwise(F.lit(0)))
    side_s = side.withColumn("_salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), count - 1)).otherwise(F.array(F.lit(0)))))
    return big_s.join(side_s.hint("shuffle_hash"), [key, "_salt"], how).drop("_salt")
