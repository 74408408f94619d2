"""PLSA: fit (C9) and fold-in."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topic_tables.operators.em import (TopicModel, _Step, column_totals, document_rows, fold_rows, initial_files, initial_phi,
                                       run_em, with_all_documents)
from topic_tables.operators.priors import Prior, is_active
from topic_tables.operators.vocab import Vocabulary, pairs_of, rows_of, to_bags
from topic_tables.session import cut_lineage, release


def fit_plsa(bags: DataFrame, vocab: Vocabulary, k: int, iterations: int, seed: int = 13,
             theta_prior: Prior | None = None, phi_prior: Prior | None = None,
             compute_loglik: bool = True, partitions: int | None = None, docs: DataFrame | None = None,
             resume: str | None = None) -> TopicModel:
    """Fit PLSA from hashed-uniform φ and θ = 1/K; both updates of an
    iteration use the previous θ and φ.  With ``docs`` every document has a θ
    row, null where no word is known (D5).  ``resume``: a folder in the shared
    store that records every iteration; a fit of the same settings that finds
    records there goes on after the last one."""
    phi0 = initial_phi(vocab, k, seed)
    return run_em(bags, vocab, phi0, k, iterations, theta_prior=theta_prior, phi_prior=phi_prior,
                  compute_loglik=compute_loglik, docs=docs, resume=resume)


def fold_in(docs: DataFrame, model: TopicModel, iterations: int, compute_loglik: bool = False,
            partitions: int | None = None, method: str = "auto") -> TopicModel:
    """θ of new documents with φ frozen, from θ = 1/K.  Documents are bagged
    with the *model's* vocabulary (tokens stored as strings, D4); one without
    a known word keeps a row with θ null (D5).

    With φ frozen every document is independent, so all iterations run beside
    the document's row, in one job, however large φ is: a run of documents
    takes the φ rows of its own words once.  Documents that are split over
    parts, and priors (which are column expressions), take the table loop.  The
    history holds the states 0..iterations either way.  ``method="table"`` forces
    the table loop.
    """
    step = _Step(model.k)

    def by_table(some: DataFrame, loglik: bool) -> TopicModel:
        return run_em(some, model.vocab, model.phi, model.k, iterations, freeze_phi=True,
                      theta_prior=model.theta_prior, compute_loglik=loglik)
    return fold_documents(docs, model, step, iterations, by_table, compute_loglik, partitions, method)


def fold_documents(docs: DataFrame, model: TopicModel, step: _Step, iterations: int, by_table, compute_loglik: bool,
                   partitions: int | None, method: str) -> TopicModel:
    """Fold-in with all parameters of words frozen; ``by_table(bags, loglik)``
    is the loop for what cannot be folded row by row."""
    bags = to_bags(docs, model.vocab, partitions)
    if method == "table" or is_active(model.theta_prior):
        out = by_table(bags, compute_loglik)
        out.theta = with_all_documents(out.theta, docs)
        out.scratch.append(bags)
        return out
    whole, split = bags, None
    if bags._tt_split:
        parts = rows_of(bags).where("part > 0").select("row_id").distinct()
        whole, split = (pairs_of(rows_of(bags).join(parts, "row_id", how), bags) for how in ("left_anti", "left_semi"))
        whole._tt_split, split._tt_split = False, True
    files, scratch = model.files, [bags]
    if files is None or files.robust < step.robust:
        bg = model.background.select("word_id", F.col("p").alias("bg")) if step.robust else None
        files = initial_files(model.phi, model.vocab, step, bg)
        scratch.append(files.frame(docs.sparkSession))
    rows = document_rows(whole)
    folded = cut_lineage(fold_rows(rows, files, step, iterations), "folded")
    release(rows)
    scratch.append(folded)
    theta, noise = folded.select("row_id", "theta"), None
    if step.robust:
        pairs = folded.select("row_id", "nu_sum", F.explode(F.arrays_zip("words", "us")).alias("w"))
        p = F.when(F.col("nu_sum") > 0, F.col("w.us") / F.col("nu_sum")).otherwise(F.lit(0.0))
        noise = pairs.select("row_id", F.col("w.words").alias("word_id"), p.alias("p"))
    history = np.zeros((iterations + 1, 2))
    if compute_loglik:
        history += column_totals(folded.select(F.col("stats").alias("vec")), 2 * (iterations + 1)).reshape(-1, 2)
    if split is not None:
        rest = by_table(split, compute_loglik)
        theta = theta.unionByName(rest.theta)
        noise = noise.unionByName(rest.noise) if step.robust else None
        scratch += rest.scratch
        if compute_loglik:
            history += np.array([[ll, skipped] for _, ll, skipped in rest.history])
    out = TopicModel(k=model.k, vocab=model.vocab, phi=model.phi, theta=with_all_documents(theta, docs), background=model.background if step.robust else None,
                     noise=noise, gamma=step.gamma, eps=step.eps, theta_prior=model.theta_prior, scratch=scratch)
    if compute_loglik:
        out.history = [(i, float(ll), int(round(skipped))) for i, (ll, skipped) in enumerate(history)]
    return out
