"""Log-likelihood, perplexity and model invariants."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topic_tables.operators.em import TopicModel
from topic_tables.operators.priors import TopicPrior, is_active


def loglik_history(spark: SparkSession, model: TopicModel) -> DataFrame:
    """(iteration, loglik, skipped): log-likelihood of the state after
    ``iteration`` updates; ``skipped`` counts pairs with zero mixture (D6)."""
    return spark.createDataFrame(model.history, "iteration int, loglik double, skipped bigint")


def perplexity(model: TopicModel, collection_length: float) -> float:
    """exp(−(LL + Σ_d log p(θ_d) + log p(φ)) / Σ n) of the final state."""
    ll = model.history[-1][1]
    extra = 0.0
    if is_active(model.theta_prior):
        extra += model.theta.where(F.col("theta").isNotNull()).agg(
            F.sum(model.theta_prior.log_prob(F.col("theta"), model.k)).alias("s")).first()["s"] or 0.0
    if is_active(model.phi_prior):
        # log p(φ) = Σ_t log p(φ_t·), each over the V cells of a topic row:
        # K normalising constants plus one summed term per cell, so no topic
        # row is ever gathered in one place.
        pr = model.phi_prior
        if isinstance(pr, TopicPrior):
            return math.exp(-(ll + extra + topic_log_density(model.phi, pr, model.k, model.vocab.size)) / collection_length)
        if not pr.by_cells():
            raise TypeError("a prior on phi needs log_norm and cell_log_term: a topic's V cells are never gathered for log_prob")
        cells = F.aggregate("phi", F.lit(0.0), lambda a, x: a + pr.cell_log_term(x))
        extra += model.k * pr.log_norm(model.vocab.size)
        extra += model.phi.agg(F.sum(cells).alias("s")).first()["s"] or 0.0
    return math.exp(-(ll + extra) / collection_length)


def topic_log_density(phi: DataFrame, prior: TopicPrior, k: int, size: int) -> float:
    """E6 for priors over whole topics.  What reaches the driver is one number
    a position of the arrays that the prior names."""
    def entries_of(name: str, array):
        return F.transform(array, lambda x, i: F.struct(F.lit(name).alias("name"), i.alias("at"), x.cast("double").alias("x")))
    rounds: list[dict[str, list[float]]] = []
    while (asked := prior.gather(F.col("phi"), rounds)) is not None:
        entries = F.flatten(F.array(*(entries_of(name, array) for name, (_, array) in asked.items())))
        rows = (phi.select(F.explode(entries).alias("e")).groupBy("e.name", "e.at")
                .agg(F.sum("e.x").alias("sum"), F.min("e.x").alias("min"), F.max("e.x").alias("max"))).collect()
        rounds.append({name: [r[how] for r in sorted((r for r in rows if r["name"] == name), key=lambda r: r["at"])] for name, (how, _) in asked.items()})
    return prior.log_density(rounds, k, size)


def model_checks(model: TopicModel, tol: float = 1e-5) -> DataFrame:
    """F8: one row of invariant violations: negative cells and rows whose sum
    is off 1 by ``tol`` or more, with the worst deviation, for θ and φ."""
    th = model.theta.where(F.col("theta").isNotNull())

    def total(v):
        return F.aggregate(v, F.lit(0.0), lambda a, x: a + x)

    def negative(v):
        return F.size(F.filter(v, lambda x: x < 0))
    th_sum, th_neg = total("theta"), negative("theta")
    a = th.agg(F.sum(th_neg).cast("bigint").alias("theta_negative"),
               F.sum(F.when(F.abs(th_sum - 1) >= tol, 1).otherwise(0)).cast("bigint").alias("theta_bad_sum"),
               F.max(F.abs(th_sum - 1)).alias("theta_max_dev"))
    neg = model.phi.agg(F.sum(negative("phi")).cast("bigint").alias("phi_negative"))
    sums = model.phi.select(F.posexplode("phi").alias("topic", "p")).groupBy("topic").agg(F.sum("p").alias("s"))
    dev = F.abs(F.col("s") - 1)
    devs = sums.agg(F.sum(F.when(dev >= tol, 1).otherwise(0)).cast("bigint").alias("phi_bad_sum"), F.max(dev).alias("phi_max_dev"))
    b = _one_row(neg, devs)
    return _one_row(a, b)


def _one_row(a: DataFrame, b: DataFrame) -> DataFrame:
    """Glue two one-row aggregates side by side on a constant key."""
    a1 = a.withColumn("_one", F.lit(1))
    b1 = b.withColumn("_one", F.lit(1))
    return a1.join(F.broadcast(b1), "_one").drop("_one")
