"""Robust PLSA: topics + background β + per-document noise ν.

p(w|d) = (Σ_t φ_tw θ_dt + γ β_w + ε ν_dw) / (1 + γ + ε)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topic_tables.operators.em import TopicModel, _Step, initial_phi, run_em
from topic_tables.operators.plsa import fold_documents
from topic_tables.operators.priors import Prior
from topic_tables.operators.vocab import Vocabulary, to_bags

# Default background and noise weights.
DEFAULT_GAMMA = 0.3
DEFAULT_EPS = 0.01


def fit_robust_plsa(bags: DataFrame, vocab: Vocabulary, k: int, iterations: int, seed: int = 13,
                    gamma: float = DEFAULT_GAMMA, eps: float = DEFAULT_EPS,
                    theta_prior: Prior | None = None, phi_prior: Prior | None = None,
                    compute_loglik: bool = True, partitions: int | None = None, docs: DataFrame | None = None,
                    resume: str | None = None) -> TopicModel:
    """R11.  With ``docs`` every document has a θ row, null where no word is
    known (D5).  ``resume`` as in :func:`fit_plsa`."""
    phi0 = initial_phi(vocab, k, seed)
    return run_em(bags, vocab, phi0, k, iterations, robust=True, gamma=gamma, eps=eps,
                  theta_prior=theta_prior, phi_prior=phi_prior, compute_loglik=compute_loglik, docs=docs, resume=resume)


def robust_fold_in(docs: DataFrame, model: TopicModel, iterations: int, background: str = "refit",
                   compute_loglik: bool = False, partitions: int | None = None, method: str = "auto") -> TopicModel:
    """R12.  φ frozen; θ and ν re-estimated.  ``background="refit"`` (default)
    re-estimates β over the folded-in documents starting from 1/V, as the
    reference does, which couples the documents and takes the table loop.
    ``"model"`` keeps the trained β: documents are independent, and all
    iterations of θ and ν run beside the document's row, in one job (priors and
    split documents excepted, see :func:`fold_in`)."""
    step = _Step(model.k, True, model.gamma, model.eps)
    kept = background == "model"
    bg0 = model.background.select("word_id", F.col("p").alias("bg")) if kept else None

    def by_table(some: DataFrame, loglik: bool, every: DataFrame | None = None) -> TopicModel:
        return run_em(some, model.vocab, model.phi, model.k, iterations, robust=True, gamma=model.gamma,
                      eps=model.eps, background0=bg0, freeze_phi=True, freeze_background=kept,
                      theta_prior=model.theta_prior, compute_loglik=loglik, docs=every)
    if kept:
        return fold_documents(docs, model, step, iterations, by_table, compute_loglik, partitions, method)
    bags = to_bags(docs, model.vocab, partitions)
    out = by_table(bags, compute_loglik, docs)
    out.scratch.append(bags)
    return out
