"""DuckDB SQL for the correctness oracle.

Builds plain ANSI-style CTE chains over the pre-registered parquet views: the
tokeniser, the vocabulary, the bags and I unrolled EM iterations in long form
(row_id, token, topic, value).  Nothing here runs on Spark; it is the
independent statement of what each registered query must return.
"""

from __future__ import annotations

from dataclasses import dataclass

# Token pattern and the hashed-uniform initialisation constants.
TOKEN_PATTERN = r"[\p{L}\p{N}]+"
HASH_DENOMINATOR = 4294967297


def tokens_cte(name: str, table: str, id_col: str, text_col: str = "text") -> str:
    return (f"{name} AS (SELECT row_id, lower(t) AS token FROM ("
            f"SELECT CAST({id_col} AS BIGINT) AS row_id, "
            f"unnest(regexp_extract_all({text_col}, '{TOKEN_PATTERN}')) AS t FROM {table}))")


def vocab_ctes(threshold: int, tok: str = "tok") -> list[str]:
    return [
        f"tc AS (SELECT token, CAST(count(*) AS BIGINT) AS n FROM {tok} GROUP BY token)",
        f"vocab AS (SELECT token, CAST(row_number() OVER (ORDER BY token) - 1 AS INTEGER) AS word_id, n "
        f"FROM tc WHERE n > {threshold})",
    ]


def bags_cte(name: str, tok: str) -> str:
    return (f"{name} AS (SELECT t.row_id, t.token, CAST(count(*) AS DOUBLE) AS n "
            f"FROM {tok} t JOIN vocab v ON t.token = v.token GROUP BY t.row_id, t.token)")


def topics_cte(k: int) -> str:
    return f"tp AS (SELECT CAST(range AS INTEGER) AS topic FROM range({k}))"


def phi0_ctes(seed: int) -> list[str]:
    return [
        "u0 AS (SELECT tp.topic, v.token, "
        f"(CAST(CAST(('0x' || substr(md5('{seed}:' || CAST(tp.topic AS VARCHAR) || ':' || v.token), 1, 8)) AS BIGINT) AS DOUBLE) + 1.0)"
        f" / CAST({HASH_DENOMINATOR} AS DOUBLE) AS u FROM vocab v JOIN tp ON true)",
        "f0 AS (SELECT topic, token, u / sum(u) OVER (PARTITION BY topic) AS p FROM u0)",
    ]


@dataclass
class EMSpec:
    k: int
    iterations: int
    prefix: str = ""          # names: {prefix}t{i}, {prefix}f{i}, ...
    bags: str = "bags"
    phi0: str = "f0"          # frozen φ when freeze_phi
    freeze_phi: bool = False
    robust: bool = False
    gamma: float = 0.0
    eps: float = 0.0
    theta_alpha: float | None = None   # symmetric Dirichlet on θ (None = no prior)
    theta_shift: float | None = None   # count shift for a custom θ prior
    phi_alpha: float | None = None
    phi_overlap: float | None = None   # weight of the overlap of a word's topics
    background: str | None = None      # table of a background that stays as it is


def em_ctes(s: EMSpec) -> list[str]:
    p, k = s.prefix, s.k
    out = [f"{p}t0 AS (SELECT d.row_id, tp.topic, CAST(1.0 AS DOUBLE) / {k} AS p "
           f"FROM (SELECT DISTINCT row_id FROM {s.bags}) d JOIN tp ON true)"]
    if s.robust:
        out.append(f"{p}nu0 AS (SELECT row_id, token, 1.0 / sum(n) OVER (PARTITION BY row_id) AS p FROM {s.bags})")
        if s.background is None:
            out.append(f"{p}bg0 AS (SELECT token, 1.0 / (SELECT count(*) FROM vocab) AS p FROM vocab)")
    phi_name = (lambda i: s.phi0) if s.freeze_phi else (lambda i: s.phi0 if i == 0 else f"{p}f{i}")
    bg_name = (lambda i: s.background) if s.background else (lambda i: f"{p}bg{i}")
    g, e = s.gamma, s.eps
    for i in range(s.iterations + 1):
        f = phi_name(i)
        out.append(f"{p}q{i} AS (SELECT b.row_id, b.token, f.topic, b.n, f.p * t.p AS q, t.p AS tp_old, f.p AS fp_old "
                   f"FROM {s.bags} b JOIN {f} f ON f.token = b.token "
                   f"JOIN {p}t{i} t ON t.row_id = b.row_id AND t.topic = f.topic)")
        if s.robust:
            out.append(f"{p}z{i} AS (SELECT m.row_id, m.token, m.n, bg.p AS bgp, nu.p AS nup, "
                       f"(m.mix + {g} * bg.p + {e} * nu.p) / (1 + {g} + {e}) AS z FROM "
                       f"(SELECT row_id, token, any_value(n) AS n, sum(q) AS mix FROM {p}q{i} GROUP BY row_id, token) m "
                       f"JOIN {bg_name(i)} bg ON bg.token = m.token "
                       f"JOIN {p}nu{i} nu ON nu.row_id = m.row_id AND nu.token = m.token)")
        else:
            out.append(f"{p}z{i} AS (SELECT row_id, token, any_value(n) AS n, sum(q) AS z "
                       f"FROM {p}q{i} GROUP BY row_id, token)")
        out.append(f"{p}ll{i} AS (SELECT {i} AS iteration, sum(CASE WHEN z > 0 THEN n * ln(z) END) AS loglik "
                   f"FROM {p}z{i})")
        if i == s.iterations:
            break
        out.append(f"{p}c{i} AS (SELECT q.row_id, q.token, q.topic, q.tp_old, q.fp_old, "
                   f"CASE WHEN z.z > 0 THEN q.n * q.q / z.z ELSE 0 END AS c "
                   f"FROM {p}q{i} q JOIN {p}z{i} z ON z.row_id = q.row_id AND z.token = q.token)")
        # θ update (with optional prior: shift, positive cut, keep old when all cut)
        shift = None
        if s.theta_alpha is not None:
            shift = s.theta_alpha - 1.0
        if s.theta_shift is not None:
            shift = s.theta_shift
        if shift is None:
            out.append(f"{p}t{i + 1} AS (SELECT row_id, topic, s / sum(s) OVER (PARTITION BY row_id) AS p FROM "
                       f"(SELECT row_id, topic, sum(c) AS s FROM {p}c{i} GROUP BY row_id, topic))")
        else:
            out.append(f"{p}t{i + 1} AS (SELECT row_id, topic, CASE WHEN sum(a) OVER (PARTITION BY row_id) > 0 "
                       f"THEN a / sum(a) OVER (PARTITION BY row_id) ELSE o END AS p FROM "
                       f"(SELECT row_id, topic, greatest(sum(c) + ({shift}), 0) AS a, max(tp_old) AS o "
                       f"FROM {p}c{i} GROUP BY row_id, topic))")
        if not s.freeze_phi:
            if s.phi_overlap is not None:
                src = (f"(SELECT token, topic, greatest(s - {s.phi_overlap!r} * o * (sum(o) OVER (PARTITION BY token) - o), 0) AS a FROM "
                       f"(SELECT token, topic, sum(c) AS s, max(fp_old) AS o FROM {p}c{i} GROUP BY token, topic))")
                out.append(f"{p}f{i + 1} AS (SELECT token, topic, CASE WHEN sum(a) OVER (PARTITION BY topic) > 0 "
                           f"THEN a / sum(a) OVER (PARTITION BY topic) ELSE 0 END AS p FROM {src})")
            elif s.phi_alpha is None:
                out.append(f"{p}f{i + 1} AS (SELECT token, topic, CASE WHEN sum(s) OVER (PARTITION BY topic) > 0 "
                           f"THEN s / sum(s) OVER (PARTITION BY topic) ELSE 0 END AS p FROM "
                           f"(SELECT token, topic, sum(c) AS s FROM {p}c{i} GROUP BY token, topic))")
            else:
                a1 = s.phi_alpha - 1.0
                src = (f"(SELECT v.token, tp.topic, greatest(coalesce(x.s, 0) + ({a1}), 0) AS a FROM vocab v JOIN tp ON true "
                       f"LEFT JOIN (SELECT token, topic, sum(c) AS s FROM {p}c{i} GROUP BY token, topic) x "
                       f"ON x.token = v.token AND x.topic = tp.topic)")
                out.append(f"{p}f{i + 1} AS (SELECT token, topic, CASE WHEN sum(a) OVER (PARTITION BY topic) > 0 "
                           f"THEN a / sum(a) OVER (PARTITION BY topic) ELSE 0 END AS p FROM {src})")
        if s.robust and s.background is None:
            out.append(f"{p}bg{i + 1} AS (SELECT token, CASE WHEN sum(b) OVER () > 0 AND {g} <> 0 "
                       f"THEN b / sum(b) OVER () ELSE 0 END AS p FROM "
                       f"(SELECT token, sum(CASE WHEN z > 0 THEN n * {g} * bgp / z ELSE 0 END) AS b FROM {p}z{i} GROUP BY token))")
        if s.robust:
            out.append(f"{p}nu{i + 1} AS (SELECT row_id, token, CASE WHEN sum(w) OVER (PARTITION BY row_id) > 0 "
                       f"THEN w / sum(w) OVER (PARTITION BY row_id) ELSE 0 END AS p FROM "
                       f"(SELECT row_id, token, CASE WHEN z > 0 THEN {e} * nup * n / z ELSE 0 END AS w FROM {p}z{i}))")
    return out


def with_query(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select
