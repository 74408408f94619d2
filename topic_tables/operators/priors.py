"""Priors on θ and φ.

A prior contributes (a) a log-density term to the perplexity and (b) an
adjustment of the expected counts before the positive cut and the
normalisation of the M-step.  Both are Column expressions, so user-defined
priors run inside the same fused JVM stage as the built-in ones.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from topic_tables.functions.dirichlet import SMALL_VALUE, dirichlet_log_beta, dirichlet_logpdf


class Prior:
    """Extension point (E6).  Subclass and override both methods.

    ``adjust(count, old)`` receives one expected-count cell and the previous
    probability of the same cell; the engine then applies ``greatest(·, 0)``
    (E5, the positive cut) and normalises.  ``log_prob(vec, size)`` returns the
    log prior of one probability vector of length ``size``.  A prior on φ
    should override ``log_norm`` and ``cell_log_term`` instead, so that the
    vector of a topic (V cells) is never gathered; perplexity refuses one that
    overrides only ``log_prob``.
    """

    #: True when ``adjust`` can give positive mass to a cell whose count is 0
    #: (then every vocabulary word must take part in the φ update).
    adds_mass: bool = False

    def __repr__(self) -> str:
        return f"{type(self).__name__}({', '.join(f'{k}={v!r}' for k, v in sorted(self.__dict__.items()))})"

    def adjust(self, count: Column, old: Column) -> Column:  # pragma: no cover - interface
        return count

    def adjust_topics(self, counts: Column, old: Column) -> Column:
        """The K counts of one word (or document) at once, for a prior in which
        the topics of a word depend on each other."""
        return F.zip_with(counts, old, lambda c, o: self.adjust(c, o))

    def by_cells(self) -> bool:
        """Whether the log prior is the constant plus a sum over cells; a
        class that overrides only ``log_prob`` has whole vectors instead."""
        kind = type(self)
        return kind.cell_log_term is not Prior.cell_log_term or kind.log_norm is not Prior.log_norm or kind.log_prob is Prior.log_prob

    def log_norm(self, size: int) -> float:
        """Constant part of the log prior of a vector of length ``size``."""
        return 0.0

    def cell_log_term(self, cell: Column) -> Column:
        """Per-cell part of the log prior (summed over the vector's cells)."""
        return F.lit(0.0)

    def log_prob(self, vec: Column, size: int) -> Column:
        """Log prior of one vector: the constant plus the summed cell terms."""
        return F.lit(self.log_norm(size)) + F.aggregate(vec, F.lit(0.0), lambda s, x: s + self.cell_log_term(x))


class TopicPrior(Prior):
    """A prior on φ whose log density is no sum over cells, such as one that
    measures a topic against its own largest cell, or topics against each
    other.  It is taken in rounds over the words: each round names some arrays
    that every word contributes and how they are aggregated, and sees what the
    rounds before gave.  The words' arrays are aggregated where the words are,
    position by position; no topic's V cells are gathered."""

    def gather(self, phi: Column, before: list[dict[str, list[float]]]) -> dict[str, tuple[str, Column]] | None:
        """``{name: ("sum" | "min" | "max", array column)}`` of the next round,
        made from a word's K cells; None after the last one."""
        return None

    def log_density(self, rounds: list[dict[str, list[float]]], k: int, size: int) -> float:
        """Log prior of φ (K topics, ``size`` words) from all rounds."""
        raise NotImplementedError

    def by_cells(self) -> bool:
        return False


class Uniform(Prior):
    """No prior; counts untouched, log prior 0."""


class SymmetricDirichlet(Prior):
    """Counts += alpha − 1 on every cell, log density of Dir(alpha)."""

    def __init__(self, alpha: float):
        self.alpha = float(alpha)
        self.adds_mass = self.alpha > 1.0

    def adjust(self, count: Column, old: Column) -> Column:
        return count + F.lit(self.alpha - 1.0)

    def log_norm(self, size: int) -> float:
        return -dirichlet_log_beta(self.alpha, size)

    def cell_log_term(self, cell: Column) -> Column:
        return F.lit(self.alpha - 1.0) * F.log(cell + F.lit(SMALL_VALUE))

    def log_prob(self, vec: Column, size: int) -> Column:
        return dirichlet_logpdf(vec, self.alpha, size)


def is_active(prior: Prior | None) -> bool:
    return prior is not None and not isinstance(prior, Uniform)
