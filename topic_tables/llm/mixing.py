"""Mixing sources to target weights by a low-discrepancy source schedule.

Slot i of the schedule has the golden-ratio point frac(i / phi).  The points
are mapped through the sources' cumulative weights, so every stretch of the
schedule holds each source in nearly its share.  Within a source, documents
are shuffled (by a digest of their id) into one stream of words that is cut
into equal blocks; the r-th slot of a source takes block r of the stream, which
starts again when it ends.  The last slot of a source is cut at its target.

DataFrame operations only.  Prefix sums run over (source, digest prefix) or
(source, stretch of slots) groups with the groups' totals added, so no source
is ever ordered in one task.

Rows: a null text has size 0 and takes nothing; documents without words stay,
with 0.  A null source is a source of its own, after all others.  Repeated rows
and repeated ids are rows of their own.  Without any word every target is 0;
an empty table gives an empty table.  Columns other than id, text and source
are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topic_tables.llm.text import WORD_CLASS, column
from topic_tables.session import cut_lineage

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: A source gives at most so many times its own size.
MAX_REPEAT = 3
BLOCK_WORDS = 1024
#: Hex digits of the digest that name a group of the shuffled order.
DIGITS = 3
#: Slots whose ranks are counted together.
STRETCH = 1 << 16
#: Cells of [0, 1) through which points and cumulative weights are joined.
CELLS = 4096
GOLDEN = 0.6180339887498949


@dataclass
class Mix:
    sources: DataFrame   # source, no, weight, source_size, target, words (whole words to take), blocks, slots
    schedule: DataFrame  # slot, no, rank, block, words: the schedule in order
    documents: DataFrame  # id, source, size, source_size, target, taken


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_CLASS)), F.lit(0)).cast("bigint")


def _sources(sized: DataFrame, weights, max_repeat: int, block_words: int) -> DataFrame:
    """Targets by weight with a ceiling: a source whose ceiling per weight is
    low enough is at its ceiling, and the others share the rest by weight."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cyc = F.array(*map(F.lit, weights))
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    s = s.withColumn("no", F.row_number().over(by_name) - 1)
    s = s.withColumn("weight", F.element_at(cyc, (F.col("no") % len(weights) + 1).cast("int")))
    s = s.withColumn("ceiling", max_repeat * F.col("source_size"))
    tight = Window.orderBy(F.col("ceiling") / F.col("weight"), "no")
    before = tight.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    s = (s.withColumn("left", F.sum("source_size").over(whole) - F.coalesce(F.sum("ceiling").over(before), F.lit(0)))
         .withColumn("rest", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
         .withColumn("level", F.col("left") / F.col("rest"))
         .withColumn("full", F.col("ceiling") <= F.col("weight") * F.col("level")))
    # Ceilings bind on a prefix of that order; the first source past it sets the level.
    s = s.withColumn("open_level", F.min(F.when(~F.col("full"), F.struct(F.col("ceiling") / F.col("weight"), "no", "level"))).over(whole)["level"])
    s = s.withColumn("target", F.when(F.col("full"), F.col("ceiling").cast("double")).otherwise(F.col("weight") * F.col("open_level")))
    words = F.least(F.col("ceiling"), F.floor(F.col("target") + 1e-6))
    s = s.withColumn("words", words).withColumn("blocks", F.ceil(F.col("source_size") / block_words))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("words") / F.col("source_size"))).otherwise(0)
    rest = F.col("words") - passes * F.col("source_size")
    return s.withColumn("slots", passes * F.col("blocks") + F.ceil(rest / block_words)).select(
        "source", "no", "weight", "source_size", "target", "words", "blocks", F.col("slots").cast("bigint").alias("slots"))


def _ranks(points: DataFrame, group: str, order: str, stretch: Column) -> DataFrame:
    """``rank`` from 0 of every row in its group, by ``order``; stretches of
    the order are counted first, so a group is never ranked in one task."""
    points = points.withColumn("stretch", stretch)
    totals = points.groupBy(group, "stretch").count()
    ahead = Window.partitionBy(group).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    offset = totals.select(group, "stretch", F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("offset"))
    inside = Window.partitionBy(group, "stretch").orderBy(order)
    ranked = points.withColumn("r", F.row_number().over(inside) - 1)
    return ranked.join(offset, [group, "stretch"]).withColumn("rank", F.col("r") + F.col("offset")).drop("r", "offset", "stretch")


def _schedule(sources: DataFrame, block_words: int) -> DataFrame:
    spark = sources.sparkSession
    live = sources.where("slots > 0")
    n = live.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    ahead = Window.orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    bounds = live.withColumn("ahead", F.coalesce(F.sum("slots").over(ahead), F.lit(0)))
    low, high = F.col("ahead") / F.lit(max(1, n)), (F.col("ahead") + F.col("slots")) / F.lit(max(1, n))
    cells = bounds.select("no", "slots", "source_size", "words", "blocks", low.alias("low"),
                          F.when(F.col("ahead") + F.col("slots") == n, F.lit(2.0)).otherwise(high).alias("high"))
    last = F.least(F.floor(F.col("high") * CELLS), F.lit(CELLS - 1))
    cells = cells.withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") * CELLS), last)))
    # frac(i * golden) from two parts of i, so that large i lose no digits
    wide, step = F.floor(F.col("id") / STRETCH), (GOLDEN * STRETCH) % 1.0
    point = (wide * F.lit(step)) % 1.0 + ((F.col("id") % STRETCH) * F.lit(GOLDEN)) % 1.0
    points = spark.range(n).select(F.col("id").alias("slot"), (point % 1.0).alias("u")).withColumn(
        "cell", F.floor(F.col("u") * CELLS))
    dealt = points.join(cells, "cell").where("low <= u and u < high").select("slot", "no")
    ranked = cut_lineage(_ranks(dealt, "no", "slot", F.floor(F.col("slot") / STRETCH)), "slots")
    # N points fill N slots but for a few a source: what is left closes the schedule.
    got = ranked.groupBy("no").agg(F.count(F.lit(1)).alias("got"))
    short = live.join(got, "no", "left").withColumn("got", F.coalesce("got", F.lit(0))).where("got < slots")
    closing = short.select(F.lit(n).alias("slot"), "no", F.explode(F.sequence("got", F.col("slots") - 1)).alias("rank"))
    slots = ranked.select("slot", "no", "rank").unionByName(closing).join(
        live.select("no", "source_size", "words", "blocks", "slots"), "no").where("rank < slots")
    at = F.floor(F.col("rank") / F.col("blocks")) * F.col("source_size") + (F.col("rank") % F.col("blocks")) * block_words
    length = F.least(F.lit(block_words), F.col("source_size") - (F.col("rank") % F.col("blocks")) * block_words,
                     F.col("words") - at)
    return slots.select("slot", "no", "rank", (F.col("rank") % F.col("blocks")).alias("block"), length.cast("bigint").alias("words"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, max_repeat: int = MAX_REPEAT, block_words: int = BLOCK_WORDS) -> Mix:
    sized = cut_lineage(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")).alias("key")), "sized")
    sources = cut_lineage(_sources(sized, weights, max_repeat, block_words), "sources")
    schedule = cut_lineage(_schedule(sources, block_words), "schedule")

    numbered = sized.join(sources.select(F.col("source").alias("name"), "no", "source_size", "target"),
                          F.col("source").eqNullSafe(F.col("name"))).drop("name")
    numbered = numbered.withColumn("stretch", F.substring("key", 1, DIGITS))
    totals = cut_lineage(numbered.groupBy("no", "stretch").agg(F.sum("size").alias("n")), "stretches")
    ahead = Window.partitionBy("no").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("no", "stretch", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("no", "stretch").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = (numbered.withColumn("upto", F.sum("size").over(inside)).join(offsets, ["no", "stretch"])
              .withColumn("start", F.col("upto") - F.col("size") + F.col("offset"))
              .select("id", "source", "size", "no", "source_size", "target", "start"))
    placed = cut_lineage(placed, "placed")

    pieces = placed.where("size > 0").select(
        "id", "no", "start", "size",
        F.explode(F.sequence(F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words))).alias("block"))
    takes = schedule.groupBy("no", "block", "words").agg(F.count(F.lit(1)).alias("times"))
    end = F.col("block") * block_words + F.col("words")
    overlap = F.least(F.col("start") + F.col("size"), end) - F.greatest(F.col("start"), F.col("block") * block_words)
    taken = (pieces.join(takes, ["no", "block"]).groupBy("no", "start")   # a start is one document's
             .agg(F.sum(F.col("times") * F.greatest(overlap, F.lit(0))).alias("taken")))
    out = placed.join(taken.withColumn("some", F.lit(True)), (placed["no"] == taken["no"]) & (placed["start"] == taken["start"]) & (placed["size"] > 0), "left")
    documents = out.select(placed["id"].alias(id_col), placed["source"].alias(source_col), "size", "source_size", "target",
                           F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"))
    return Mix(sources, schedule, documents)


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself, with the columns of docs: a document stands as often as
    the mix takes it whole, and once more up to the last word of a partial take.
    A source's stream is taken whole until its last pass, which ends within it,
    so a partial take is always the beginning of a text; it is cut out as it
    stands, line breaks and all.  What repeated equal rows take is shared among
    them."""
    names = docs.columns
    plan = mix(docs.select(column(id_col).alias("id"), column(text_col).alias("text"), column(source_col).alias("source")),
               "id", "text", "source", **options).documents
    plan = cut_lineage(plan.groupBy("id", "source", "size").agg(F.sum("taken").alias("total"), F.count(F.lit(1)).alias("rows")).where("total > 0"), "mix-plan")
    safe = docs.toDF(*(f"c{i}" for i in range(len(names))))
    an_id, text, source = (F.col(f"c{names.index(c)}") for c in (id_col, text_col, source_col))
    safe = safe.withColumn("words", word_count(text))
    same = an_id.eqNullSafe(F.col("id")) & source.eqNullSafe(F.col("source")) & (F.col("words") == F.col("size"))
    once = safe.join(plan.where("rows = 1"), same).withColumn("taken", F.col("total"))
    again = safe.join(plan.where("rows > 1"), same)
    nth = F.row_number().over(Window.partitionBy("id", "source", "size").orderBy(F.xxhash64(text)))
    again = again.withColumn("nth", nth).withColumn("taken", (
        F.floor(F.col("total") * F.col("nth") / F.col("rows")) - F.floor(F.col("total") * (F.col("nth") - 1) / F.col("rows"))).cast("bigint")).drop("nth")
    rest = F.col("taken") % F.col("size")
    copies = F.floor(F.col("taken") / F.col("size"))
    out = once.unionByName(again).where("taken > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), copies + (rest > 0).cast("int"))))
    # every match starts at a word, so that long white space is read once
    blank = "[\\x20\\x09-\\x0D]*"
    gaps = F.regexp_extract_all(text, F.lit(WORD_CLASS + blank), F.lit(0))
    last = F.regexp_extract(F.element_at(gaps, F.greatest(rest, F.lit(1)).cast("int")), WORD_CLASS, 0)
    cut = F.concat(F.regexp_extract(text, "^" + blank, 0), F.array_join(F.slice(gaps, 1, F.greatest(rest - 1, F.lit(0)).cast("int")), ""), last)
    cell = F.when(F.col("copy") <= copies, text).otherwise(cut)
    return out.select(*((cell if c == text_col else F.col(f"c{i}")).alias(c) for i, c in enumerate(names)))


ORACLE = """
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
                  md5(coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS no
       FROM d GROUP BY source),
s1 AS (SELECT *, [5, 2, 1][no % 3 + 1] AS weight, 3 * source_size AS ceiling FROM s0),
s2 AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(ceiling) OVER w, 0))::DOUBLE
                 / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
       FROM s1 WINDOW w AS (ORDER BY ceiling / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s3 AS (SELECT *, ceiling <= weight * level AS full_ FROM s2),
s4 AS (SELECT source, source_size, CASE WHEN full_ THEN ceiling::DOUBLE ELSE weight *
          (SELECT arg_min(level, ceiling / weight * 1000 + no / 1e6) FROM s3 WHERE NOT full_) END AS target FROM s3),
p AS (SELECT d.*, s4.source_size, s4.target, least(3 * s4.source_size, floor(s4.target + 1e-6)::BIGINT) AS words,
             sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS start
      FROM d JOIN s4 ON d.source IS NOT DISTINCT FROM s4.source),
t AS (SELECT *, unnest([0, 1, 2]) AS pass FROM p)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       sum(greatest(0, least(size, words - (pass * source_size + start))))::BIGINT AS taken
FROM t GROUP BY doc_id, size, source_size, target, start, source
"""
