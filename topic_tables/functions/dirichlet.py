"""Symmetric Dirichlet log-density as a Column expression.

log Dir(x | alpha) = -log B + (alpha - 1) * sum_i log(x_i + 1e-5),
log B = m * lgamma(alpha) - lgamma(m * alpha), m = len(x).
The two log-gamma constants depend only on (alpha, m) and are computed once on
the driver; the per-row work is a single fused expression.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: offset that keeps log(x) finite at x = 0 for alpha < 1.
SMALL_VALUE = 0.00001


def dirichlet_log_beta(alpha: float, m: int) -> float:
    return m * math.lgamma(alpha) - math.lgamma(m * alpha)


def dirichlet_logpdf(x, alpha: float, m: int) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    log_sum = F.aggregate(x, F.lit(0.0), lambda s, v: s + F.log(v + F.lit(SMALL_VALUE)))
    return F.lit(-dirichlet_log_beta(alpha, m)) + F.lit(alpha - 1.0) * log_sum
