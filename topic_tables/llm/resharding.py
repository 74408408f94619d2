"""Minimum-cost-flow resharding.

A layout holds its rows in shards, ``shard=<k>/`` folders of files; a file is a
block of rows, and a shard's blocks hold its rows from the largest to the
smallest.  From the shard sizes and the new capacities a flow network is solved
on the driver (a few arcs a shard: staying is free, a byte that moves costs 1),
so that the fewest bytes move.  The flow says where each shard's byte stream is
cut.  A row goes where it starts, and as the cuts lie among a shard's small
rows, the shards come out near their capacities.

Rows that stay are the first ones of their shard and keep their slots; rows
that come in are appended.  Files whose rows all stay are not touched: only the
blocks from the first cut on are read and written anew.  Cuts become row
numbers from the slim size column of the blocks that hold a cut, so texts are
routed without being sorted or joined again.

Without given capacities shards are made equal.  A row larger than an equal
share (there are fewer of those than shards) has a shard of its own, and the
other shards share the rest.

Rows: a null text has no bytes and counts 16.  Null, empty and repeated ids are
ids like any other; equal rows are told apart by their place in the input.  An
empty table gives an empty layout.  All columns are carried along inside one
struct, so their names cannot clash with those of the layout.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topic_tables.llm.text import column
from topic_tables.operators.joins import lookup_join
from topic_tables.session import cut_lineage, default_partitions, release, scratch_path

OLD_SHARDS, NEW_SHARDS = 32, 40
#: Bytes that a row counts besides its text.
ROW_BYTES = 16
#: Bytes of a file, about.
BLOCK_BYTES = 128 << 20


# ------------------------------------------------------------------------- flow
def min_cost_flow(nodes: int, arcs: list[tuple[int, int, int, int]], source: int, sink: int) -> list[int]:
    """Flow of each arc ``(from, to, capacity, cost)`` of a greatest flow of the
    least cost (costs of 0 and more).  Shortest paths with potentials; all paths
    of one length are filled together."""
    out: list[list[int]] = [[] for _ in range(nodes)]
    to, left, cost = [], [], []
    for u, v, c, w in arcs:
        for a, b, room, price in ((u, v, c, w), (v, u, 0, -w)):
            out[a].append(len(to))
            to.append(b)
            left.append(room)
            cost.append(price)
    high = [0] * nodes
    while True:
        far = [None] * nodes
        heap = [(0, source)]
        while heap:
            d, u = heapq.heappop(heap)
            if far[u] is not None:
                continue
            far[u] = d
            for e in out[u]:
                if left[e] and far[to[e]] is None:
                    heapq.heappush(heap, (d + cost[e] + high[u] - high[to[e]], to[e]))
        if far[sink] is None:
            return [left[2 * i + 1] for i in range(len(arcs))]
        high = [h + (far[sink] if f is None else min(f, far[sink])) for h, f in zip(high, far)]
        tried, path, on = [0] * nodes, [], {source}
        u = source
        while True:                                        # fill every path of this length
            if u == sink:
                room = min(left[e] for e in path)
                for e in path:
                    left[e] -= room
                    left[e ^ 1] += room
                u, path, on = source, [], {source}
            step = next((k for k in range(tried[u], len(out[u])) if left[out[u][k]] and to[out[u][k]] not in on
                         and cost[out[u][k]] + high[u] - high[to[out[u][k]]] == 0), None)
            if step is not None:
                tried[u] = step
                path.append(out[u][step])
                u = to[path[-1]]
                on.add(u)
            elif path:
                on.discard(u)
                u = to[path.pop() ^ 1]
                tried[u] += 1
            else:
                break


@dataclass
class Plan:
    capacities: list[int]                       # of the new shards
    cuts: dict[int, list[tuple[int, int]]]      # old shard -> (byte, new shard) from there on
    stay: dict[int, int]                        # old shard -> bytes that stay

    @property
    def moved(self) -> int:
        return self._moved

    _moved: int = 0


def solve(sizes: list[int], new: int | list[int], large: list[tuple[int, int]] = ()) -> Plan:
    """The plan for old shard sizes and new capacities, or a number of equal
    shards.  ``large``: (size, shard) of every row above an equal share, in the
    order of the rows; they are the first rows of their shards."""
    total, old = sum(sizes), len(sizes)
    n = new if isinstance(new, int) else len(new)
    alone: list[tuple[int, int]] = []
    rest = total
    if isinstance(new, int):
        for size, shard in sorted(large, key=lambda x: (-x[0], x[1])):
            if size * (n - len(alone)) <= rest:
                break
            alone.append((size, shard))
            rest -= size
    mine: dict[int, int] = {}                              # new shard -> the row it holds alone
    movers, cuts, base = [], {i: [] for i in range(old)}, [0] * old
    for size, shard in alone:
        if shard < n and shard not in mine:
            mine[shard] = size
            cuts[shard].append((0, shard))
        else:
            movers.append((size, shard, base[shard]))
        base[shard] += size
    free = sorted((j for j in range(n) if j not in mine), key=lambda j: (sizes[j] if j < old else 0, j))
    for (size, shard, at), j in zip(movers, free):
        mine[j] = size
        cuts[shard].append((at, j))
    supply = [s - b for s, b in zip(sizes, base)]
    if isinstance(new, int):
        open_ = [j for j in range(n) if j not in mine]
        room = [0] * n
        for k, j in enumerate(open_):
            room[j] = rest // len(open_) + (k < rest % len(open_))
    else:
        room = list(new)
        if sum(room) < total:
            raise ValueError("the new capacities hold fewer bytes than there are")
    # source -> old shards -> (stay | wire) -> new shards -> sink
    source, sink, wire = old + n, old + n + 1, old + n + 2
    arcs = [(source, i, supply[i], 0) for i in range(old)] + [(old + j, sink, room[j], 0) for j in range(n)]
    stays = [(i, old + i, supply[i], 0) for i in range(min(old, n))]
    sends, gets = [(i, wire, supply[i], 1) for i in range(old)], [(wire, old + j, room[j], 0) for j in range(n)]
    flow = min_cost_flow(old + n + 3, arcs + stays + sends + gets, source, sink)[len(arcs):]
    keep, send, get = flow[:len(stays)], flow[len(stays):len(stays) + old], flow[len(stays) + old:]
    stay, j = {}, 0
    get = list(get)
    for i in range(old):
        here = keep[i] if i < len(keep) else 0
        if here:
            cuts[i].append((base[i], i))
        stay[i] = base[i] + here if here else (mine.get(i, 0) if cuts[i] and cuts[i][0] == (0, i) else 0)
        at, due = base[i] + here, send[i]
        while due:
            while not get[j]:
                j += 1
            part = min(due, get[j])
            cuts[i].append((at, j))
            at, due, get[j] = at + part, due - part, get[j] - part
    return Plan([mine.get(j, room[j]) for j in range(n)], cuts, stay, sum(send) + sum(s for s, _, _ in movers))


# ----------------------------------------------------------------------- layouts
@dataclass
class Layout:
    """Rows ``(shard, slot, size, doc)`` in files, and what was moved to get there."""

    spark: SparkSession
    shards: int
    rows: DataFrame
    path: str | None = None                 # of a layout that can be resharded
    blocks: DataFrame | None = None         # shard, block, n, bytes, least, first_row, first_byte
    moved_bytes: int = 0
    read_bytes: int = 0                     # of the blocks written anew
    scratch: tuple = ()


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + ROW_BYTES


def hash_shard(id_col: Column, shards: int) -> Column:
    """The shard that a digest of the id names."""
    digest = F.md5(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(shards)).cast("int")


def write(docs: DataFrame, shards: int = OLD_SHARDS, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> Layout:
    """Lay rows out in shards by a digest of their id."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(text_bytes(column(text_col)))).first()[0] or 0
    parts = max(default_partitions(spark), -(-total // block_bytes))
    rows = docs.select(F.struct(*map(column, docs.columns)).alias("doc"), hash_shard(column(id_col), shards).alias("shard"), text_bytes(column(text_col)).alias("size"),
                       F.col(f"`{id_col}`").alias("id"), F.xxhash64(column(text_col)).alias("h"), F.monotonically_increasing_id().alias("place"))
    by = ("shard", F.col("size").desc(), "id", "h", "place")
    path = scratch_path(spark, "shards")
    (rows.repartitionByRange(parts, *by).sortWithinPartitions(*by).select("shard", "size", "doc", F.spark_partition_id().alias("block"))
     .write.partitionBy("shard").parquet(path))
    return _opened(spark, path, shards, docs)


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def _opened(spark: SparkSession, path: str, shards: int, docs: DataFrame) -> Layout:
    schema = docs.select(F.lit(0).cast("bigint").alias("size"), F.struct(*map(column, docs.columns)).alias("doc"), F.lit(0).alias("block"), F.lit(0).alias("shard")).schema
    rows = _read(spark, path, schema)
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"), F.min("size").alias("least"))
    blocks = cut_lineage(blocks.withColumns({"first_row": F.coalesce(F.sum("n").over(before), F.lit(0)), "first_byte": F.coalesce(F.sum("bytes").over(before), F.lit(0))}), "blocks")
    placed = _placed(rows, blocks).select("shard", F.col("row").alias("slot"), "size", "doc")
    out = Layout(spark, shards, placed, path, blocks)
    out._schema = schema
    return out


def _placed(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """Rows with their number in their shard: that of their block and their
    index in the file.  There is one entry a file, broadcast if it is small."""
    key = F.shiftleft(F.col("shard").cast("bigint"), 32) + F.col("block")
    firsts = blocks.select(key.alias("key"), "first_row")
    numbered = rows.select("shard", "size", "doc", "block", F.col("_metadata.row_index").alias("index")).withColumn("key", key)
    joined = lookup_join(numbered, firsts, "key", 32 * blocks.count(), "index")
    return joined.select("shard", "size", "doc", (F.col("first_row") + F.col("index")).alias("row"))


def _any(conditions: list[Column]) -> Column:
    """A balanced tree of ORs; false without conditions."""
    while len(conditions) > 1:
        conditions = [reduce(Column.__or__, conditions[i:i + 2]) for i in range(0, len(conditions), 2)]
    return conditions[0] if conditions else F.lit(False)


def reshard(layout: Layout, new: int | list[int] = NEW_SHARDS) -> Layout:
    """Move the fewest bytes into new shards and write the affected files anew."""
    spark, blocks = layout.spark, layout.blocks
    n = new if isinstance(new, int) else len(new)
    sizes = [0] * layout.shards
    for r in blocks.groupBy("shard").agg(F.sum("bytes").alias("b")).collect():
        sizes[r["shard"]] = r["b"]
    raw = _read(spark, layout.path, layout._schema)
    large = []
    if isinstance(new, int):                   # fewer rows than shards
        big = raw.where(F.col("size") * n > sum(sizes)).select("shard", "block", F.col("_metadata.row_index").alias("index"), "size")
        large = [(r["size"], r["shard"]) for r in sorted(big.collect(), key=lambda r: (r["shard"], r["block"], r["index"]))]
    plan = solve(sizes, new, large)

    # byte cuts -> row numbers, from the sizes in the blocks that hold a cut
    cuts = [(i, at, j) for i, places in plan.cuts.items() for at, j in places]
    cut = spark.createDataFrame(cuts, "shard int, at bigint, target int")
    held = cut.join(blocks, "shard").where((F.col("at") >= F.col("first_byte")) & (F.col("at") < F.col("first_byte") + F.col("bytes")))
    held = cut_lineage(held.select("shard", "block", "at", "target", "first_row", "first_byte"), "cuts")
    slim = raw.select("shard", "block", F.col("_metadata.row_index").alias("index"), "size").join(F.broadcast(held.select("shard", "block").distinct()), ["shard", "block"])
    to_here = Window.partitionBy("shard", "block").orderBy("index")
    slim = slim.withColumn("start", F.sum("size").over(to_here) - F.col("size"))
    found = (slim.join(F.broadcast(held), ["shard", "block"]).groupBy("shard", "at", "target", "first_row")
             .agg(F.sum((F.col("start") + F.col("first_byte") < F.col("at")).cast("bigint")).alias("n"))).collect()
    starts = {(r["shard"], r["at"], r["target"]): r["first_row"] + r["n"] for r in found}
    counts = {r["shard"]: (r["n"], r["m"]) for r in blocks.groupBy("shard").agg(F.sum("n").alias("n"), F.max("block").alias("m")).collect()}

    # runs of rows: (shard, first row, rows, target, first slot)
    stays, moves = {}, []
    for i in sorted(plan.cuts):
        rows = counts.get(i, (0, 0))[0]
        at = [(starts.get((i, byte, j), rows), j) for byte, j in plan.cuts[i]]
        for (low, j), high in zip(at, [a for a, _ in at[1:]] + [rows]):
            if j == i:
                stays[i] = high
            elif high > low:
                moves.append([i, low, high - low, j])
    filled = {j: stays.get(j, 0) for j in range(n)}
    for move in moves:
        move.append(filled[move[3]])
        filled[move[3]] += move[2]

    # a shard's blocks before the first one that gives rows away are left as they are
    border = {r["shard"]: r["b"] for r in blocks.join(F.broadcast(spark.createDataFrame([(i, stays.get(i, 0)) for i in plan.cuts], "shard int, stay bigint")), "shard")
              .where(F.col("first_row") + F.col("n") > F.col("stay")).groupBy("shard").agg(F.min("block").alias("b")).collect()}
    whole = _any([(F.col("shard") == i) & (F.col("block") < border.get(i, m + 1)) for i, (_, m) in counts.items()])
    touched = _any([(F.col("shard") == i) & (F.col("block") >= b) for i, b in border.items()])
    runs = {i: [(0, stays[i], i, 0)] if stays.get(i) else [] for i in counts}
    for i, low, rows, j, slot in moves:
        runs[i].append((low, rows, j, slot))
    route = spark.createDataFrame([(i, [tuple(r) for r in rs]) for i, rs in runs.items()], "shard int, runs array<struct<low: bigint, n: bigint, target: int, slot: bigint>>")
    read_bytes = blocks.where(touched).agg(F.sum("bytes").alias("b"), F.sum("n").alias("n")).first()
    path = scratch_path(spark, "reshards")
    step = max(1, BLOCK_BYTES * (read_bytes["n"] or 0) // max(1, read_bytes["b"] or 0))
    # at most one entry a shard and three a cut: small whatever the rows are
    dealt = (_placed(raw.where(touched), blocks).join(F.broadcast(route), "shard")
             .withColumn("run", F.filter("runs", lambda r: (F.col("row") >= r["low"]) & (F.col("row") < r["low"] + r["n"]))[0])
             .select(F.col("run.target").alias("shard"), (F.col("run.slot") + F.col("row") - F.col("run.low")).alias("slot"), "size", "doc")
             .repartition("shard", F.floor(F.col("slot") / step)).sortWithinPartitions("shard", "slot"))
    dealt.write.partitionBy("shard").parquet(path)
    release(held)
    fresh_schema = layout.rows.select("slot", "size", "doc", "shard").schema
    kept = _placed(raw.where(whole), blocks).select("shard", F.col("row").alias("slot"), "size", "doc")
    rows = kept.unionByName(_read(spark, path, fresh_schema).select("shard", "slot", "size", "doc"))
    out = Layout(spark, n, rows, moved_bytes=plan.moved, read_bytes=read_bytes["b"] or 0)
    out.plan, out.moves = plan, [tuple(m) for m in moves]
    return out


_SIZES = f"""s AS (SELECT doc_id, text, coalesce(strlen(text), 0) + {ROW_BYTES} AS size, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % {OLD_SHARDS} AS old FROM documents),
o AS (SELECT *, sum(size) OVER q - size AS start FROM s WINDOW q AS (PARTITION BY old ORDER BY size DESC, doc_id ROWS UNBOUNDED PRECEDING)),
g AS (SELECT *, row_number() OVER z AS k, sum(size) OVER z - size AS before FROM o WINDOW z AS (ORDER BY size DESC, old, start ROWS UNBOUNDED PRECEDING)),
alone AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY old ORDER BY k) = 1 AS stays FROM g
  WHERE k < {NEW_SHARDS} AND size * ({NEW_SHARDS} - k + 1) > (SELECT sum(size) FROM s) - before),
j AS (SELECT n AS shard, coalesce(b, 0) AS b, coalesce(a.own, 0) AS own, coalesce(h.held, 0) AS held FROM range({NEW_SHARDS}) t(n)
  LEFT JOIN (SELECT old, sum(size) AS b FROM s GROUP BY old) x ON x.old = n
  LEFT JOIN (SELECT old, sum(size) AS own FROM alone GROUP BY old) a ON a.old = n
  LEFT JOIN (SELECT old, sum(size) AS held FROM alone WHERE stays GROUP BY old) h ON h.old = n),
movers AS (SELECT m.doc_id, f.shard FROM (SELECT doc_id, row_number() OVER (ORDER BY k) AS i FROM alone WHERE NOT stays) m
  JOIN (SELECT shard, row_number() OVER (ORDER BY b, shard) AS i FROM j WHERE held = 0) f USING (i)),
c AS (SELECT *, held > 0 OR shard IN (SELECT shard FROM movers) AS closed FROM j),
r AS (SELECT *, CASE WHEN closed THEN 0 ELSE rest // m + (CASE WHEN row_number() OVER (PARTITION BY closed ORDER BY shard) <= rest % m THEN 1 ELSE 0 END) END AS room
  FROM c, (SELECT sum(b) - sum(own) AS rest, count(*) FILTER (NOT closed) AS m FROM c)),
w AS (SELECT *, least(b - own, room) AS keep FROM r),
e AS MATERIALIZED (SELECT *, sum(b - own - keep) OVER (ORDER BY shard) - (b - own - keep) AS sent, sum(room - keep) OVER (ORDER BY shard) - (room - keep) AS got FROM w),
p AS (SELECT g.doc_id, g.text, g.size, g.old, g.start, CASE WHEN g.k <= (SELECT count(*) FROM alone) THEN coalesce(v.shard, g.old)
    WHEN g.start - e.own < e.keep THEN g.old ELSE d.shard END AS shard
  FROM g JOIN e ON e.shard = g.old LEFT JOIN movers v USING (doc_id)
  LEFT JOIN e d ON e.sent + g.start - e.own - e.keep >= d.got AND e.sent + g.start - e.own - e.keep < d.got + d.room - d.keep)"""

#: For unique ids.
ORACLE = f"""WITH {_SIZES},
t AS (SELECT list(list_reduce([n] || range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS t FROM range(256) x(n)),
crc AS (SELECT doc_id, xor(4294967295, list_reduce([4294967295] || list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT),
  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS crc FROM s, t)
SELECT p.doc_id, size, crc AS text_crc32, 'bytes' AS law, shard::INT AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY old <> shard, old, start) - 1 AS slot, NULL::INT AS grown_shard
FROM p JOIN crc ON crc.doc_id = p.doc_id
"""
