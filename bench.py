"""Bench: vocabulary + bags, PLSA and Robust PLSA iterations, fold-in, search.

Prints one JSON line.  Inputs: $BENCH_SF_DIR (default /root/testdata/sf0.1),
threshold 15; PLSA K=8, K=32 and K=100, 5 iterations; Robust K=8, 5 iterations;
fold-in of all `benchmark` items, 10 iterations; top-20 search of those items
against every document.  ``value`` is the sum of the whole steps; the
``*_per_iter`` entries are a step's seconds over its iterations.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from topic_tables.operators.plsa import fit_plsa, fold_in  # noqa: E402
from topic_tables.operators.robust import fit_robust_plsa  # noqa: E402
from topic_tables.operators.search import similar_docs, top_words  # noqa: E402
from topic_tables.operators.vocab import build_corpus  # noqa: E402
from topic_tables.session import local_session  # noqa: E402
from topic_tables.sources.tables import load_table, tokens_from_text  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    iters = int(os.environ.get("BENCH_ITERATIONS", "5"))
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8, app="topic_tables_bench")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    q, per_iter = {}, {}

    def timed(name, work):
        t = time.time()
        out = work()
        q[name] = time.time() - t
        return out

    def fitted(name, fit):
        def work():
            model = fit()
            model.theta.count()
            return model
        model = timed(name, work)
        per_iter[f"{name}_per_iter"] = q[name] / iters
        return model

    docs = tokens_from_text(load_table(spark, sf_dir, "documents"), "doc_id", "text")
    vocab, bags, _ = timed("vocab_bags", lambda: build_corpus(docs, 15))
    m8 = fitted("plsa_k8", lambda: fit_plsa(bags, vocab, 8, iters, compute_loglik=False))
    fitted("plsa_k32", lambda: fit_plsa(bags, vocab, 32, iters, compute_loglik=False))
    fitted("plsa_k100", lambda: fit_plsa(bags, vocab, 100, iters, compute_loglik=False))
    fitted("robust_k8", lambda: fit_robust_plsa(bags, vocab, 8, iters, compute_loglik=False))

    queries = tokens_from_text(load_table(spark, sf_dir, "benchmark"), "item_id", "text")

    def fold():
        folded = fold_in(queries, m8, 10)
        folded.theta.count()
        return folded
    folded = timed("fold_in", fold)

    doc_theta = m8.theta.join(docs.select("row_id", "name"), "row_id")
    qt = folded.theta.select(F.col("row_id").alias("query_id"), F.col("row_id").cast("string").alias("query_name"), "theta")
    timed("top20_search", lambda: similar_docs(doc_theta, qt, 20).count())
    timed("top_words", lambda: top_words(m8, 30).count())

    total = sum(q.values())          # whole steps; the per-iteration figures are not added again
    q |= per_iter
    print(json.dumps({"metric": "topic_model_bench_total", "value": round(total, 3), "unit": "sec",
                      "queries": {k: round(v, 3) for k, v in q.items()}, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
