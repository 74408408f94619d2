"""Fold-in and search for a stream of query documents.

A fitted model is frozen, so each micro-batch of queries is independent of
every other: ``foreachBatch`` runs the batch fold-in and the top-n search on
that micro-batch (with the documents' θ table as the static side) and writes
the hits to the batch's own folder ``epoch=<n>`` of the sink table.  The
streaming source is any Structured Streaming reader of (row_id, name, text)
rows, e.g. ``spark.readStream.parquet``.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topic_tables.operators.em import TopicModel
from topic_tables.operators.plsa import fold_in
from topic_tables.operators.search import similar_docs
from topic_tables.session import cut_lineage, release
from topic_tables.sources.tables import tokens_from_text


def search_batch(batch: DataFrame, epoch: int, model: TopicModel, doc_theta: DataFrame, out_path: str,
                 iterations: int = 10, n: int = 20, id_col: str = "row_id", text_col: str = "text") -> None:
    """Fold one micro-batch in, rank the documents and write the hits.  A
    replayed batch overwrites its own folder, so hits never double."""
    # read once: the batch's source is not evaluated again for its names
    docs = cut_lineage(tokens_from_text(batch, id_col, text_col), "stream-batch")
    folded = fold_in(docs, model, iterations)
    qt = folded.theta.join(docs.select("row_id", "name"), "row_id").select(
        F.col("row_id").alias("query_id"), F.col("name").alias("query_name"), "theta")
    similar_docs(doc_theta, qt, n).write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/epoch={epoch}")
    # The batch's own tables are not needed once its hits are out.
    folded.release()
    release(docs)


def start_search_stream(stream: DataFrame, model: TopicModel, doc_theta: DataFrame, out_path: str,
                        checkpoint_path: str, iterations: int = 10, n: int = 20,
                        id_col: str = "row_id", text_col: str = "text", trigger_once: bool = False):
    """Start the query; returns the StreamingQuery.  ``doc_theta`` is
    (row_id, name, theta) of the ranked documents."""
    run = partial(search_batch, model=model, doc_theta=doc_theta, out_path=out_path, iterations=iterations, n=n,
                  id_col=id_col, text_col=text_col)
    writer = stream.writeStream.foreachBatch(lambda batch, epoch: run(batch, epoch)).option("checkpointLocation", checkpoint_path)
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
