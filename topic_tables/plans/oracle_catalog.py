"""DuckDB oracle SQL for every registered query (same columns and types)."""

from __future__ import annotations

from topic_tables.plans import catalog as C
from topic_tables.plans.oracle import (
    TOKEN_PATTERN, EMSpec, bags_cte, em_ctes, phi0_ctes, tokens_cte, topics_cte, vocab_ctes, with_query,
)

K, I = C.K, C.ITERATIONS
# Fixed value: the offset under the logarithm of the Dirichlet density.
OFFSET = 1e-5


def _log_density(alpha: float, size: str, total: str) -> str:
    """Symmetric Dirichlet log density from the summed logs of its cells."""
    return f"(lgamma({size} * {alpha!r}) - {size} * lgamma({alpha!r}) + ({alpha - 1.0!r}) * {total})"


def _base(extra_tok: list[str] | None = None) -> list[str]:
    ctes = [tokens_cte("tok", "documents", "doc_id")] + vocab_ctes(C.THRESHOLD) + [bags_cte("bags", "tok"), topics_cte(K)]
    ctes += phi0_ctes(C.SEED)
    return ctes + (extra_tok or [])


def _plsa(**kw) -> list[str]:
    return em_ctes(EMSpec(K, I, **kw))


def _robust(**kw) -> list[str]:
    return em_ctes(EMSpec(K, I, robust=True, gamma=C.GAMMA, eps=C.EPS, **kw))


def _theta_sel(t: str, id_name: str = "row_id", table: str = "documents", key: str = "doc_id") -> str:
    """Every document, with nulls where no word is known."""
    return (f"SELECT d.row_id AS {id_name}, t.topic, round(t.p, 6) AS p FROM "
            f"(SELECT DISTINCT CAST({key} AS BIGINT) AS row_id FROM {table}) d LEFT JOIN {t} t ON t.row_id = d.row_id")


def _phi_sel(f: str) -> str:
    return f"SELECT topic, token, round(p, 6) AS p FROM {f}"


_BENCH = [tokens_cte("qtok", "benchmark", "item_id"), bags_cte("qbags", "qtok")]
_DOCS_NAMES = "dn AS (SELECT CAST(doc_id AS BIGINT) AS row_id, CAST(doc_id AS VARCHAR) AS name FROM documents)"


def _search(q_theta: str, d_theta: str, with_qname: bool, score: str = "round(h.score, 6)") -> str:
    """Top-n cosine ranking in long form (all pairs are fine for the oracle)."""
    qname = ", CAST(h.query_id AS VARCHAR) AS query_name" if with_qname else ""
    return (
        f"qn AS (SELECT row_id, sqrt(sum(p * p)) AS nr FROM {q_theta} GROUP BY row_id), "
        f"dnr AS (SELECT row_id, sqrt(sum(p * p)) AS nr FROM {d_theta} GROUP BY row_id), "
        f"dots AS (SELECT q.row_id AS query_id, d.row_id, sum(q.p * d.p) AS dp FROM {q_theta} q "
        f"JOIN {d_theta} d ON q.topic = d.topic GROUP BY q.row_id, d.row_id), "
        f"sc AS (SELECT x.query_id, x.row_id, dn.name, x.dp / (qn.nr * dnr.nr) AS score FROM dots x "
        f"JOIN qn ON qn.row_id = x.query_id JOIN dnr ON dnr.row_id = x.row_id JOIN dn ON dn.row_id = x.row_id "
        f"WHERE qn.nr > 0 AND dnr.nr > 0), "
        f"rk AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 8) DESC, name, row_id) AS rnk FROM sc) "
        f"SELECT h.query_id{qname}, CAST(h.rnk AS INTEGER) AS rank, h.row_id, h.name, {score} AS score "
        f"FROM rk h WHERE h.rnk <= {C.TOP_DOCS}")


def build() -> dict[str, str]:
    s: dict[str, str] = {}
    tok_only = [tokens_cte("tok", "documents", "doc_id")]
    s["token_counts"] = with_query(tok_only + ["tc AS (SELECT token, CAST(count(*) AS BIGINT) AS n FROM tok GROUP BY token)"],
                                   "SELECT token, n FROM tc")
    s["vocab_pruned"] = with_query(tok_only + vocab_ctes(C.THRESHOLD)[:1], f"SELECT token, n FROM tc WHERE n > {C.THRESHOLD}")
    s["vocab_index"] = with_query(tok_only + vocab_ctes(C.THRESHOLD), "SELECT token, word_id, n FROM vocab")
    b = tok_only + vocab_ctes(C.THRESHOLD) + [bags_cte("bags", "tok")]
    s["bag_of_words"] = with_query(b, "SELECT row_id, token, n FROM bags")
    s["corpus_stats"] = with_query(b, "SELECT CAST(count(DISTINCT token) AS BIGINT) AS n_words, "
                                      "CAST(count(DISTINCT row_id) AS BIGINT) AS n_docs, CAST(count(*) AS BIGINT) AS n_pairs, "
                                      "CAST(sum(n) AS DOUBLE) AS collection_length, "
                                      "(SELECT CAST(count(*) AS BIGINT) FROM vocab) AS vocab_size FROM bags")
    base = _base()
    s["init_phi"] = with_query(base, _phi_sel("f0"))
    p0 = base + em_ctes(EMSpec(K, 0))
    s["word_mixture"] = with_query(p0, "SELECT row_id, token, round(z, 6) AS z FROM z0")
    p1 = base + em_ctes(EMSpec(K, 1))
    s["responsibilities"] = with_query(p1, "SELECT row_id, token, topic, round(c, 6) AS c FROM c0")
    s["topic_word_counts"] = with_query(p1, "SELECT topic, token, round(sum(c), 6) AS c FROM c0 GROUP BY topic, token")
    plsa = base + _plsa()
    s["plsa_theta"] = with_query(plsa, _theta_sel(f"t{I}"))
    s["plsa_phi"] = with_query(plsa, _phi_sel(f"f{I}"))
    s["plsa_loglik"] = with_query(plsa, " UNION ALL ".join(
        f"SELECT CAST(iteration AS INTEGER) AS iteration, round(loglik, 3) AS loglik FROM ll{i}" for i in range(I + 1)))
    s["plsa_perplexity"] = with_query(plsa, f"SELECT (SELECT sum(n) FROM bags) AS collection_length, round(loglik, 3) AS loglik, "
                                            f"round(exp(-loglik / (SELECT sum(n) FROM bags)), 6) AS perplexity FROM ll{I}")
    fold = plsa + _BENCH + em_ctes(EMSpec(K, I, prefix="g", bags="qbags", phi0=f"f{I}", freeze_phi=True))
    s["fold_in"] = with_query(fold, _theta_sel(f"gt{I}", "query_id", "benchmark", "item_id"))
    cos = plsa + em_ctes(EMSpec(K, I, prefix="h", bags="bags", phi0=f"f{I}", freeze_phi=True))
    s["cosine_sim"] = with_query(cos, f"SELECT d.row_id, round(sum(a.p * b.p) / (sqrt(sum(a.p * a.p)) * sqrt(sum(b.p * b.p))), 6) AS cosine "
                                      f"FROM (SELECT DISTINCT CAST(doc_id AS BIGINT) AS row_id FROM documents) d LEFT JOIN t{I} a ON a.row_id = d.row_id "
                                      f"LEFT JOIN ht{I} b ON a.row_id = b.row_id AND a.topic = b.topic GROUP BY d.row_id")
    srch = fold + [_DOCS_NAMES]
    sq = _search(f"gt{I}", f"t{I}", with_qname=False)
    s["similar_docs"] = "WITH " + ",\n".join(srch) + ",\n" + sq
    conv = plsa + [tokens_cte("ctok", "conversations", "conv_id"), bags_cte("cbags", "ctok"), _DOCS_NAMES] + \
        em_ctes(EMSpec(K, I, prefix="v", bags="cbags", phi0=f"f{I}", freeze_phi=True))
    s["fold_in_search"] = "WITH " + ",\n".join(conv) + ",\n" + _search(f"vt{I}", f"t{I}", with_qname=True)
    s["similar_vectors"] = (
        "WITH ev AS (SELECT CAST(vec_id AS BIGINT) AS row_id, CAST(vec_id AS VARCHAR) AS name, "
        "CAST(unnest(embedding) AS DOUBLE) AS p, unnest(range(len(embedding))) AS topic FROM embeddings), "
        "dn AS (SELECT DISTINCT row_id, name FROM ev), "
        + _search("ev", "ev", with_qname=False).replace("SELECT h.query_id, CAST", "SELECT h.query_id, CAST")
        .replace(", h.name, round(h.score, 6) AS score", ", round(h.score, 6) AS score"))
    s["top_words"] = with_query(plsa, f"SELECT CAST(topic AS INTEGER) AS topic, CAST(rnk AS INTEGER) AS rank, token, round(p, 6) AS p FROM "
                                      f"(SELECT *, row_number() OVER (PARTITION BY topic ORDER BY round(p, 8) DESC, token) AS rnk FROM f{I}) "
                                      f"WHERE rnk <= {C.TOP_WORDS}")
    best = (f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY round(p, 8) DESC, topic) AS rnk FROM t{I}) "
            f"WHERE rnk <= {C.TOP_TOPICS})")
    s["top_topics"] = with_query(plsa, f"SELECT d.row_id, CAST(rnk AS INTEGER) AS rank, topic, round(p, 6) AS p FROM "
                                       f"(SELECT DISTINCT CAST(doc_id AS BIGINT) AS row_id FROM documents) d LEFT JOIN {best} b ON b.row_id = d.row_id")
    s["model_checks"] = with_query(plsa, (
        f"SELECT a.theta_negative, a.theta_bad_sum, round(a.theta_max_dev, 6) AS theta_max_dev, "
        f"b.phi_negative, b.phi_bad_sum, round(b.phi_max_dev, 6) AS phi_max_dev FROM "
        f"(SELECT CAST(sum(neg) AS BIGINT) AS theta_negative, CAST(sum(CASE WHEN abs(s - 1) >= 1e-5 THEN 1 ELSE 0 END) AS BIGINT) AS theta_bad_sum, "
        f"max(abs(s - 1)) AS theta_max_dev FROM (SELECT row_id, sum(p) AS s, sum(CASE WHEN p < 0 THEN 1 ELSE 0 END) AS neg FROM t{I} GROUP BY row_id)) a, "
        f"(SELECT CAST(sum(neg) AS BIGINT) AS phi_negative, CAST(sum(CASE WHEN abs(s - 1) >= 1e-5 THEN 1 ELSE 0 END) AS BIGINT) AS phi_bad_sum, "
        f"max(abs(s - 1)) AS phi_max_dev FROM (SELECT topic, sum(p) AS s, sum(CASE WHEN p < 0 THEN 1 ELSE 0 END) AS neg FROM f{I} GROUP BY topic)) b"))
    rb = base + _robust()
    s["noise_init"] = with_query(rb, "SELECT row_id, token, round(p, 6) AS p FROM nu0")
    s["robust_mixture"] = with_query(rb, "SELECT row_id, token, round(z, 6) AS z FROM z0")
    s["robust_theta"] = with_query(rb, _theta_sel(f"t{I}"))
    s["robust_phi"] = with_query(rb, _phi_sel(f"f{I}"))
    s["robust_background"] = with_query(rb, f"SELECT token, round(p, 6) AS p FROM bg{I}")
    s["robust_noise"] = with_query(rb, f"SELECT row_id, token, round(p, 6) AS p FROM nu{I}")
    s["robust_loglik"] = with_query(rb, " UNION ALL ".join(
        f"SELECT CAST(iteration AS INTEGER) AS iteration, round(loglik, 3) AS loglik FROM ll{i}" for i in range(I + 1)))
    rf = rb + _BENCH + em_ctes(EMSpec(K, I, prefix="g", bags="qbags", phi0=f"f{I}", freeze_phi=True, robust=True,
                                      gamma=C.GAMMA, eps=C.EPS))
    s["robust_fold_in"] = with_query(rf, _theta_sel(f"gt{I}", "query_id", "benchmark", "item_id"))
    rm = rb + _BENCH + em_ctes(EMSpec(K, I, prefix="g", bags="qbags", phi0=f"f{I}", freeze_phi=True, robust=True,
                                      gamma=C.GAMMA, eps=C.EPS, background=f"bg{I}"))
    s["robust_fold_in_model"] = with_query(rm, _theta_sel(f"gt{I}", "query_id", "benchmark", "item_id"))
    s["robust_fold_in_noise"] = with_query(rm, f"SELECT row_id AS query_id, token, round(p, 6) AS p FROM gnu{I}")
    density = _log_density(C.ALPHA, str(K), f"sum(ln(p + {OFFSET!r}))")
    s["dirichlet_logpdf"] = with_query(plsa, f"SELECT d.row_id, round({density}, 6) AS logpdf "
                                             f"FROM (SELECT DISTINCT CAST(doc_id AS BIGINT) AS row_id FROM documents) d "
                                             f"LEFT JOIN t{I} t ON t.row_id = d.row_id GROUP BY d.row_id")
    both = base + _plsa(theta_alpha=C.ALPHA, phi_alpha=C.ALPHA)
    of_theta = f"(SELECT sum(x) FROM (SELECT {density} AS x FROM t{I} GROUP BY row_id))"
    topic = _log_density(C.ALPHA, "(SELECT count(*) FROM vocab)", f"sum(ln(p + {OFFSET!r}))")
    of_phi = f"(SELECT sum(x) FROM (SELECT {topic} AS x FROM f{I} GROUP BY topic))"
    length = "(SELECT sum(n) FROM bags)"

    def perplexity(extra: str) -> str:
        return (f"SELECT {length} AS collection_length, round(loglik, 3) AS loglik, "
                f"round(exp(-(loglik + {extra}) / {length}), 6) AS perplexity FROM ll{I}")
    s["perplexity_priors"] = with_query(both, perplexity(f"{of_theta} + {of_phi}"))
    s["perplexity_custom_phi"] = with_query(plsa, perplexity(f"(SELECT sum(-{C.PHI_PENALTY!r} * p * p) FROM f{I})"))
    apart = base + _plsa(phi_overlap=C.OVERLAP)
    overlap = f"(SELECT sum(x) FROM (SELECT (sum(p) * sum(p) - sum(p * p)) / 2 AS x FROM f{I} GROUP BY token))"
    flat = f"(SELECT sum(p * ln(m / p)) FROM (SELECT p, max(p) OVER (PARTITION BY topic) AS m FROM f{I}) WHERE p > 0)"
    s["topic_prior_phi"] = with_query(apart, _phi_sel(f"f{I}"))
    s["topic_prior_perplexity"] = with_query(apart, perplexity(f"-{C.OVERLAP!r} * {overlap} - {C.PEAK!r} * {flat}"))
    kw = C.K_WIDE
    wide = ([tokens_cte("tok", "documents", "doc_id")] + vocab_ctes(C.THRESHOLD) + [bags_cte("bags", "tok"), topics_cte(kw)]
            + phi0_ctes(C.SEED) + em_ctes(EMSpec(kw, I)))
    s["plsa_k100_theta"] = with_query(wide, _theta_sel(f"t{I}"))
    s["plsa_k100_loglik"] = with_query(wide, " UNION ALL ".join(
        f"SELECT CAST(iteration AS INTEGER) AS iteration, round(loglik, 3) AS loglik FROM ll{i}" for i in range(I + 1)))
    s["theta_prior"] = with_query(base + _plsa(theta_alpha=C.ALPHA), _theta_sel(f"t{I}"))
    s["phi_prior"] = with_query(base + _plsa(phi_alpha=C.ALPHA), _phi_sel(f"f{I}"))
    s["custom_prior"] = with_query(base + _plsa(theta_shift=C.CUSTOM_SHIFT), _theta_sel(f"t{I}"))
    dtok = ("dt AS (SELECT CAST(doc_id AS VARCHAR) AS name, list_transform(coalesce(regexp_extract_all(text, '" + TOKEN_PATTERN + "'), []), lambda x: lower(x)) AS toks "
            "FROM documents)")
    s["read_bags"] = with_query([dtok], "SELECT name, CAST(len(toks) AS BIGINT) AS n_tokens, array_to_string(toks, ':') AS contents "
                                        "FROM dt WHERE len(toks) > 0")
    s["word_table"] = with_query(tok_only + vocab_ctes(C.THRESHOLD)[:1], "SELECT token || chr(9) || CAST(n AS VARCHAR) AS line FROM tc")
    s["phi_long"] = with_query(plsa, f"SELECT f.topic, v.word_id, round(f.p, 6) AS p FROM f{I} f JOIN vocab v ON v.token = f.token WHERE f.p > 0")
    s["phi_roundtrip"] = s["plsa_phi"]
    s["theta_roundtrip"] = with_query(plsa + [_DOCS_NAMES], f"SELECT dn.name, t.topic, round(t.p, 6) AS p FROM dn LEFT JOIN t{I} t ON dn.row_id = t.row_id")
    s["theta_sparse"] = with_query(plsa + [dtok.replace("dt AS (SELECT", "dt AS (SELECT CAST(doc_id AS BIGINT) AS row_id,")],
                                   f"SELECT dt.name, array_to_string(dt.toks, ':') AS contents, "
                                   f"CAST(count(x.p) OVER (PARTITION BY dt.row_id) AS INTEGER) AS n_cells, x.topic, round(x.p, 6) AS p "
                                   f"FROM dt LEFT JOIN (SELECT * FROM t{I} WHERE p > 0) x ON x.row_id = dt.row_id")
    s["topic_preview"] = with_query(plsa, f"SELECT CAST(topic AS VARCHAR) || chr(9) || token || chr(9) || printf('%.4f', p) AS line "
                                          f"FROM f{I} WHERE p >= 1e-4")
    s["doc_preview"] = with_query(plsa + [_DOCS_NAMES], f"SELECT dn.name || chr(9) || CAST(topic AS VARCHAR) || chr(9) || printf('%.4f', p) AS line "
                                                        f"FROM t{I} t JOIN dn ON dn.row_id = t.row_id WHERE p >= 1e-4")
    # a bag line without any token has no second field and is not read back
    read = f"dr AS (SELECT CAST(doc_id AS VARCHAR) AS name, CAST(doc_id AS BIGINT) AS row_id FROM documents WHERE regexp_matches(text, '{TOKEN_PATTERN}'))"
    s["train_files"] = with_query(plsa + [read], (
        f"SELECT 'topic-word' AS kind, CAST(v.word_id AS VARCHAR) AS key, f.topic, round(f.p, 6) AS p FROM f{I} f JOIN vocab v ON v.token = f.token WHERE f.p > 0 "
        f"UNION ALL SELECT 'doc-topic', dr.name, t.topic, round(t.p, 6) FROM dr LEFT JOIN (SELECT * FROM t{I} WHERE p > 0) t ON t.row_id = dr.row_id"))
    ranked = "WITH " + ",\n".join(srch) + ",\n" + _search(f"gt{I}", f"t{I}", with_qname=False, score="h.score")
    word_rows = (f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY round(p, 8) DESC, token) AS rnk FROM f{I}) WHERE rnk <= {C.TOP_WORDS}")
    s["search_files"] = "WITH similar_ AS (" + ranked + "),\n" + with_query(plsa + [_DOCS_NAMES], (
        "SELECT 'similar' AS kind, CAST(query_id AS VARCHAR) AS a, name AS b, round(score, 4) AS p FROM similar_ "
        f"UNION ALL SELECT 'topic', CAST(topic AS VARCHAR), token, round(p, 4) FROM ({word_rows}) "
        f"UNION ALL SELECT 'document', dn.name, CAST(topic AS VARCHAR), round(p, 6) FROM {best} b JOIN dn ON dn.row_id = b.row_id"))[5:]
    return s
