"""Column-expression helpers (all JVM-side, no Python UDFs)."""

from topic_tables.functions.vectors import (  # noqa: F401
    cosine, dot, hash_uniform, k_sum, norm, top_n_of_array,
)
from topic_tables.functions.dirichlet import dirichlet_log_beta, dirichlet_logpdf  # noqa: F401
