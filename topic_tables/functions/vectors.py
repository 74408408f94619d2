"""Fixed-width vector arithmetic on ``array<double>`` columns.

When the width K is known and small (up to 32) the expressions are unrolled
into K scalar terms, which stay inside whole-stage codegen; wider vectors take
the higher-order forms (``aggregate``/``zip_with``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def k_sum(terms: list[Column]) -> Column:
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def dot(a, b, k: int | None = None) -> Column:
    a, b = _c(a), _c(b)
    if k is not None and k <= 32:
        return k_sum([a[i] * b[i] for i in range(k)])
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def norm(a, k: int | None = None) -> Column:
    return F.sqrt(dot(a, a, k))


def cosine(a, b, k: int | None = None) -> Column:
    """Cosine of two vectors; null when either has zero length."""
    den = norm(a, k) * norm(b, k)
    return F.when(den > 0, dot(a, b, k) / den)


def hash_uniform(seed: int, topic, token) -> Column:
    """Deterministic uniform value in (0, 1) for a (seed, topic, token) cell.

    u = (h + 1) / 4294967297 with h the first 8 hex digits of
    md5("seed:topic:token").  Independent of vocabulary order and of the
    engine, so DuckDB reproduces it exactly.
    """
    s = F.concat_ws(":", F.lit(str(seed)), _c(topic).cast("string"), _c(token))
    h = F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint")
    return (h.cast("double") + F.lit(1.0)) / F.lit(4294967297.0)


def top_n_of_array(a, n: int) -> Column:
    """Top-n (topic, p) entries of a probability vector, ranked by p rounded
    to 8 digits (descending) and then by topic (ascending); row-local."""
    a = _c(a)
    idx = F.transform(a, lambda x, i: F.struct(
        (-F.round(x, 8)).alias("key"), i.alias("topic"), x.alias("p")))
    return F.slice(F.array_sort(idx), 1, n)
