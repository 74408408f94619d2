"""Delimited text formats of the topic-model files.

Layouts (fields separated by a tab unless stated):
  documents     name  tok:tok:...            (the test corpus uses \\001)
  topic-word    topic  word_index  p         (p > 0 only)
  doc-topic     name  tok:tok:...  t:p;t:p   (p > 0 only)
  similarity    query  doc  p%.4f
  preview       topic  token  p%.4f          (p >= 1e-4)
  word table    word  num

Splitting follows java.lang.String.split: trailing empty fields are dropped
and inner ones kept.  Reads use ``spark.read.text`` so the files split across
tasks like any other text source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topic_tables.functions.vectors import top_n_of_array
from topic_tables.operators.vocab import buckets_of
from topic_tables.session import cut_lineage, write_bucketed


def _quote(sep: str) -> str:
    return "\\Q" + sep + "\\E"


def _java_split(s: Column, sep: str) -> Column:
    """String.split(sep) semantics: drop trailing empty pieces; a string made
    only of separators gives []; the empty string gives [""]."""
    q = _quote(sep)
    stripped = F.regexp_replace(s, "(" + q + ")+$", "")
    return (F.when((stripped == "") & (s != ""), F.array().cast("array<string>"))
            .otherwise(F.split(stripped, q, -1)))


def parse_bag_lines(lines: DataFrame, field_sep: str = "\t", token_sep: str = ":",
                    exact_fields: bool = False) -> DataFrame:
    """``value`` lines → ``docs(row_id, name, tokens)``; keep lines with at
    least 2 fields (exactly 2 with ``exact_fields``)."""
    f = _java_split(F.col("value"), field_sep)
    keep = (F.size("f") == 2) if exact_fields else (F.size("f") >= 2)
    return (lines.select(f.alias("f")).where(keep)
            .select(F.monotonically_increasing_id().alias("row_id"),
                    F.get(F.col("f"), 0).alias("name"),
                    _java_split(F.get(F.col("f"), 1), token_sep).alias("tokens")))


def read_bags(spark: SparkSession, path: str, field_sep: str = "\t", token_sep: str = ":",
              exact_fields: bool = False) -> DataFrame:
    """A1.  Row ids depend on how files are split, so the parsed table is
    written once: every later use sees the same ids."""
    return cut_lineage(parse_bag_lines(spark.read.text(path), field_sep, token_sep, exact_fields), "bag-lines")


def parse_doc_topic_lines(lines: DataFrame, k: int) -> DataFrame:
    """A2: ``name \\t contents \\t t:p;t:p`` → (row_id, name, tokens, theta[K]).

    A topic outside 0..K-1 or a malformed cell fails the read; a line without
    cells has θ null (a document without known words)."""
    f = _java_split(F.col("value"), "\t")
    cells = F.transform(F.split(F.get(F.col("f"), 2), ";", -1), lambda e: F.split(e, ":", -1))
    good = F.forall(cells, lambda c: (F.size(c) == 2) & c[0].try_cast("int").between(0, k - 1) & c[1].try_cast("double").isNotNull())
    entries = F.map_from_entries(F.transform(cells, lambda c: F.struct(c[0].cast("int"), c[1].cast("double"))))
    m = (F.when(F.coalesce(F.get(F.col("f"), 2), F.lit("")) == "", F.lit(None))
         .when(F.coalesce(good, F.lit(False)), entries)
         .otherwise(F.raise_error(F.concat(F.lit(f"bad cell or topic outside 0..{k - 1}: "), F.get(F.col("f"), 2)))))
    theta = F.when(F.col("m").isNotNull(), F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda t: F.coalesce(F.col("m")[t], F.lit(0.0))))
    return (lines.select(f.alias("f")).where(F.size("f") >= 2)
            .select(F.monotonically_increasing_id().alias("row_id"), F.get(F.col("f"), 0).alias("name"),
                    _java_split(F.get(F.col("f"), 1), ":").alias("tokens"), m.alias("m"))
            .select("row_id", "name", "tokens", theta.alias("theta")))


def read_doc_topic(spark: SparkSession, path: str, k: int) -> DataFrame:
    """A2, written once so that row ids hold (see :func:`read_bags`)."""
    return cut_lineage(parse_doc_topic_lines(spark.read.text(path), k), "doc-topic-lines")


def parse_topic_word_lines(lines: DataFrame, k: int) -> DataFrame:
    """A3: ``topic \\t word_index \\t p`` → phi(word_id, phi[K]); missing cells 0.

    A topic outside 0..K-1 or a malformed line fails the read.  Cells are
    summed by (word, topic), then a word's at most K cells make its row."""
    f = F.split(F.col("value"), "\t", -1)
    cells = lines.where("value <> ''").select("value", F.get(f, 0).try_cast("int").alias("topic"), F.get(f, 1).try_cast("int").alias("word_id"),
                                              F.get(f, 2).try_cast("double").alias("p"))
    good = F.col("topic").between(0, k - 1) & F.col("word_id").isNotNull() & F.col("p").isNotNull()
    topic = F.when(F.coalesce(good, F.lit(False)), F.col("topic")).otherwise(
        F.raise_error(F.concat(F.lit(f"bad line or topic outside 0..{k - 1}: "), F.col("value"))).cast("int"))
    summed = cells.select("word_id", topic.alias("topic"), "p").groupBy("word_id", "topic").agg(F.sum("p").alias("p"))
    m = F.map_from_entries(F.collect_list(F.struct("topic", "p")))
    return summed.groupBy("word_id").agg(m.alias("m")).select(
        "word_id", F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda t: F.coalesce(F.col("m")[t], F.lit(0.0))).alias("phi"))


def read_topic_word(spark: SparkSession, path: str, k: int) -> DataFrame:
    return parse_topic_word_lines(spark.read.text(path), k)


def _num(c: Column) -> Column:
    return c.cast("string")


def format_topic_word(phi: DataFrame) -> DataFrame:
    """A4: one line per positive cell of phi(word_id, phi[K])."""
    cells = phi.select("word_id", F.posexplode("phi").alias("topic", "p")).where(F.col("p") > 0)
    return cells.select(F.concat_ws("\t", _num(F.col("topic")), _num(F.col("word_id")), _num(F.col("p"))).alias("value"))


def store_contents(docs: DataFrame, bags: DataFrame) -> DataFrame:
    """``(row_id, part, name, tokens)`` bucketed like the bags: one shuffle of
    the text when it is read, and none in whatever joins it with a model's θ."""
    return write_bucketed(docs.select("row_id", F.lit(0).alias("part"), "name", "tokens"), ["row_id", "part"], buckets_of(bags), "contents")


def _beside(docs: DataFrame, theta: DataFrame, how: str) -> DataFrame:
    """Documents and their θ: by bucket where both are stored so
    (:func:`store_contents`, ``TopicModel.theta_rows``), else by row id."""
    if "part" in docs.columns and "part" in theta.columns:
        return docs.join(theta.hint("shuffle_hash"), ["row_id", "part"], how)
    return docs.join(theta, "row_id", how)


def format_doc_topic(docs: DataFrame, theta: DataFrame) -> DataFrame:
    """A5: ``name \\t contents \\t t:p;...`` for positive θ cells (docs keyed by row_id)."""
    th = F.array_join(F.transform(
        F.filter(F.transform("theta", lambda x, i: F.struct(i.alias("t"), x.alias("p"))), lambda s: s["p"] > 0),
        lambda s: F.concat(s["t"].cast("string"), F.lit(":"), s["p"].cast("string"))), ";")
    j = _beside(docs, theta, "left")
    return j.select(F.concat_ws("\t", F.col("name"), F.array_join("tokens", ":"),
                                F.coalesce(th, F.lit(""))).alias("value"))


def format_similarity(hits: DataFrame) -> DataFrame:
    """``query \\t doc \\t %.4f``."""
    return hits.select(F.concat_ws("\t", F.col("query_name"), F.col("name"),
                                   F.format_string("%.4f", F.col("score"))).alias("value"))


def format_topic_preview(cells: DataFrame) -> DataFrame:
    """A7 input: (topic, token, p) → ``topic \\t token \\t %.4f`` for p >= 1e-4."""
    return cells.where(F.col("p") >= 1e-4).select(
        F.concat_ws("\t", F.col("topic").cast("string"), F.col("token"),
                    F.format_string("%.4f", F.col("p"))).alias("value"))


def format_doc_preview(docs: DataFrame, theta: DataFrame) -> DataFrame:
    """A7, the θ half: (name, topic, p) → ``name \\t topic \\t %.4f`` for p >= 1e-4."""
    cells = theta.select("row_id", F.posexplode("theta").alias("topic", "p")).where(F.col("p") >= 1e-4)
    return cells.join(docs.select("row_id", "name"), "row_id").select(
        F.concat_ws("\t", F.col("name"), F.col("topic").cast("string"), F.format_string("%.4f", F.col("p"))).alias("value"))


def format_doc_report(docs: DataFrame, theta: DataFrame, n: int) -> DataFrame:
    """F7's document report: ``name \\t contents \\t (p,topic);...`` with the n
    best topics; the line is made from the θ row, without a group."""
    tops = F.array_join(F.transform(top_n_of_array("theta", n), lambda e: F.format_string("(%s,%d)", e["p"].cast("string"), e["topic"])), ";")
    return _beside(docs, theta.where("theta is not null"), "inner").select(
        F.concat_ws("\t", "name", F.array_join("tokens", ":"), tops).alias("value"))


def format_word_table(counts: DataFrame) -> DataFrame:
    """``word \\t num``."""
    return counts.select(F.concat_ws("\t", F.col("token"), F.col("n").cast("string")).alias("value"))


def write_lines(lines: DataFrame, path: str) -> None:
    lines.write.mode("overwrite").text(path)
