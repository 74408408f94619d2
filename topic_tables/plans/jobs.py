"""The two batch jobs (F6, F7) as plain functions over DataFrames.

train_job:  documents → vocabulary (threshold) → bags → PLSA fit → files
            (topic-word, doc-topic; token strings kept in the vocabulary
            table so later jobs reuse the same words, D4)
search_job: fitted model + query documents → fold-in → top-n similar
            documents → similarity / topic / document reports

Output paths are explicit arguments (D15); nothing is derived by rewriting
paths.  All writes are Spark writes from the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topic_tables.operators.em import TopicModel
from topic_tables.operators.plsa import fit_plsa, fold_in
from topic_tables.operators.priors import Prior
from topic_tables.operators.search import similar_docs, top_words
from topic_tables.operators.vocab import build_corpus
from topic_tables.session import release
from topic_tables.sources import text as T


@dataclass
class TrainResult:
    model: TopicModel
    docs: DataFrame


def train_job(docs: DataFrame, k: int, iterations: int, rare_token_threshold: int = 15, seed: int = 13,
              theta_prior: Prior | None = None, phi_prior: Prior | None = None,
              topic_word_path: str | None = None, doc_topic_path: str | None = None,
              vocab_path: str | None = None) -> TrainResult:
    """F6.  ``docs(row_id, name, tokens)`` (from read_bags or tokens_from_text)."""
    vocab, bags, _ = build_corpus(docs, rare_token_threshold)
    model = fit_plsa(bags, vocab, k, iterations, seed, theta_prior=theta_prior, phi_prior=phi_prior, docs=docs)
    if topic_word_path:
        T.write_lines(T.format_topic_word(model.phi), topic_word_path)
    if doc_topic_path:
        contents = T.store_contents(docs, bags)
        T.write_lines(T.format_doc_topic(contents, model.theta_rows), doc_topic_path)
        release(contents)
    if vocab_path:
        model.vocab.table.write.mode("overwrite").parquet(vocab_path)
    return TrainResult(model, docs)


def load_model(spark, topic_word_path: str, vocab_path: str, k: int,
               doc_topic_path: str | None = None) -> TrainResult:
    """Read a model written by :func:`train_job` back (F7's first step): φ from
    the topic-word file (A3), the vocabulary with its token strings (D4), and
    optionally the documents' θ from the doc-topic file (A2).  Every word of
    the vocabulary gets a φ row (cells missing from the file are 0)."""
    from topic_tables.operators.vocab import Vocabulary
    vt = spark.read.parquet(vocab_path)
    stats = vt.agg(F.count(F.lit(1)).alias("v"), F.sum(F.octet_length("token")).alias("b"), F.sum("n").alias("o")).first()
    vocab = Vocabulary(vt, int(stats["v"] or 0), int(stats["b"] or 0), int(stats["o"] or 0))
    phi = T.read_topic_word(spark, topic_word_path, k)
    phi = (vt.select("word_id").join(phi, "word_id", "left")
           .select("word_id", F.coalesce("phi", F.array_repeat(F.lit(0.0), k)).alias("phi")))
    if doc_topic_path:
        dt = T.read_doc_topic(spark, doc_topic_path, k)
        docs, theta = dt.select("row_id", "name", "tokens"), dt.select("row_id", "theta")
    else:
        docs = spark.createDataFrame([], "row_id bigint, name string, tokens array<string>")
        theta = spark.createDataFrame([], "row_id bigint, theta array<double>")
    return TrainResult(TopicModel(k=k, vocab=vocab, phi=phi, theta=theta), docs)


def search_job(trained: TrainResult, queries: DataFrame, iterations: int, n: int = 20,
               similarity_path: str | None = None, topics_report_path: str | None = None,
               docs_report_path: str | None = None, words_per_topic: int = 30,
               topics_per_doc: int = 20) -> DataFrame:
    """fold queries into the model and rank every document per query."""
    model = trained.model
    folded = fold_in(queries, model, iterations)
    names = queries.select("row_id", "name").dropDuplicates(["row_id"]) if "name" in queries.columns else None
    qt = folded.theta
    qt = (qt.join(names, "row_id") if names is not None else qt.withColumn("name", F.col("row_id").cast("string")))
    qt = qt.select(F.col("row_id").alias("query_id"), F.col("name").alias("query_name"), "theta")
    dt = model.theta.join(trained.docs.select("row_id", "name"), "row_id")       # documents without θ never rank
    hits = similar_docs(dt, qt, n)
    if similarity_path:
        T.write_lines(T.format_similarity(hits), similarity_path)
    if topics_report_path:
        tw = top_words(model, words_per_topic)
        T.write_lines(tw.select(F.concat_ws("\t", F.col("topic").cast("string"), "token",
                                            F.format_string("%.4f", "p")).alias("value")), topics_report_path)
    if docs_report_path:
        T.write_lines(T.format_doc_report(trained.docs, model.theta, topics_per_doc), docs_report_path)
    return hits
