"""Repeated passages by MinHash banding of paragraphs.

A paragraph is a line of the text (cut at \\n), whole, of ``least_words`` words
or more.  Paragraphs of five words or more get the set of their five-word
shingles (ASCII letters lower-cased); bands are tuned for recall: with one row
a band, three bands find a pair at similarity 0.8 with probability 0.992.
Paragraphs that collide are verified by exact Jaccard similarity; shorter ones
are compared for equal words.  Links make components, and the first occurrence
of a component is kept.

A passage that is copied into the middle of another line is no paragraph
there.  So each text is also cut where the hash of two neighbouring words is the
lowest of any ``WINDOW`` words, the same way wherever a passage stands, and a
chunk runs from each cut to the first one ``MIN_WORDS`` words or more behind it.
Chunks are compared for equal words, and are reported where no reported
paragraph holds them.  As cuts are never more than ``WINDOW`` words apart, each
shared run of ``3 * WINDOW + MIN_WORDS`` (50) words or more holds one.

One shuffle and sort of (band key, unit hash) finds repeated and colliding
units.  Occurrences are then looked up by hash, without their shingles; a hash
with more occurrences than an equal share is salted.  Equal units are one node
however often they occur.  A bucket of up to ``BLOCK`` paragraphs is compared in
one piece, a longer one block by block, and each leaves a spanning forest.

``run_words`` counts the words of the unbroken run of reported units around an
occurrence, and ``removed`` marks what a cut should take out: occurrences in
runs of over ``CUT_WORDS`` words, but for the kept one of each component.

Rows: a null text counts as the empty text and has no paragraphs.  A null id
is an id like any other, but does not count as a second document.  Repetition
inside one document alone is not reported.  Other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topic_tables.llm.components import components, forest
from topic_tables.llm.text import gather_ranges, slices
from topic_tables.operators.joins import hot_keys, lookup_join
from topic_tables.session import cut_lineage, default_partitions, release

#: Any so many words of a text hold a cut.
WINDOW = 14
MIN_WORDS = 8
SHINGLE = 5
SIMILARITY = 0.8
RECALL = 0.99
#: Longest bucket that is compared in one piece.
BLOCK = 2048
#: Runs of more words are cut out where they stand again.
CUT_WORDS = 50
#: Lookups grow with the input, so they are never broadcast, at any size.
SHUFFLED = 1 << 62
#: Hashes of lines are kept apart from those of chunks.
LINE = np.uint64(0xD6E8FEB86659FD93)
MIX = np.uint64(0x9E3779B97F4A7C15)
FAR = np.uint64(2**64 - 1)
POWERS = 64


def bands_for(similarity: float = SIMILARITY, recall: float = RECALL) -> int:
    """Bands of one row that reach the recall at the similarity."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity)) if similarity < 1 else 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _scan(texts: list[str | None]):
    """Start, end, document, hash and line of every word of all texts; lines
    are counted through all texts."""
    flat = "\n".join(t or "" for t in texts)
    code = np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter((len(t or "") + 1 for t in texts), np.int64, len(texts))
    begin = np.cumsum(sizes) - sizes
    black = np.r_[False, (code != 0x20) & ((code < 9) | (code > 13)), False]
    edge = np.flatnonzero(black[1:] != black[:-1])
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return start, end, start, np.zeros(0, np.uint64), start
    low = np.where((code >= 65) & (code <= 90), code + 32, code).astype(np.uint64) + np.uint64(1)
    length = end - start
    inside = np.arange(len(code)) - np.repeat(np.r_[0, start], np.diff(np.r_[0, start, len(code)]))
    power = np.cumprod(np.r_[np.uint64(1), np.full(POWERS - 1, MIX)], dtype=np.uint64)
    term = low * power[inside % POWERS] + (inside // POWERS).astype(np.uint64) * low
    term[~black[1:-1]] = 0
    h = _mix(np.add.reduceat(term, start) + length.astype(np.uint64))
    doc = np.searchsorted(begin, start, side="right") - 1
    breaks = np.r_[0, np.cumsum(code == 10)]
    return start - begin[doc], end - begin[doc], doc, h, breaks[start] - breaks[begin[doc]]


def _words(texts: list[str | None]):
    return _scan(texts)[:4]


def _chained(h: np.ndarray, first: np.ndarray, last: np.ndarray, salt: np.uint64) -> np.ndarray:
    """One hash a unit of the words first..last-1, in their order."""
    count = last - first
    offset = np.r_[0, np.cumsum(count)]
    at = gather_ranges(first, count)
    turn = (np.arange(len(at)) - np.repeat(offset[:-1], count) + 1).astype(np.uint64)
    return _mix(np.add.reduceat(_mix(h[at] + MIX * turn), offset[:-1]) + count.astype(np.uint64) + salt)


@dataclass
class Units:
    """Paragraphs and chunks of some texts; ``first`` is the first word's number
    in its text, ``offset`` bounds each unit's shingles (none: equal words only)."""

    doc: np.ndarray
    chunk: np.ndarray
    number: np.ndarray
    first: np.ndarray
    n_words: np.ndarray
    start: np.ndarray
    end: np.ndarray
    h: np.ndarray
    offset: np.ndarray
    shingles: np.ndarray


def _cuts(h: np.ndarray, doc: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Words where a text is cut: the lowest hash of a word and the one before
    in any ``WINDOW`` words of a text; of equal neighbours the first."""
    n = len(h) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    pair = np.where(same, _mix(h + MIX * np.r_[np.uint64(0), h[:-1]]) | np.uint64(1), FAR)
    low = np.lib.stride_tricks.sliding_window_view(pair, WINDOW).min(axis=1)
    low[doc[:n] != doc[WINDOW - 1:]] = 0                       # not all of one text
    around = np.r_[np.zeros(WINDOW - 1, np.uint64), low, np.zeros(WINDOW - 1, np.uint64)]
    top = np.lib.stride_tricks.sliding_window_view(around, WINDOW).max(axis=1)
    return np.flatnonzero((pair == top) & (pair != FAR) & np.r_[True, pair[1:] != pair[:-1]])


def units(texts: list[str | None], least_words: int = MIN_WORDS) -> Units:
    start, end, doc, h, line = _scan(texts)
    n = len(h)
    if not n:
        z = np.zeros(0, np.int64)
        return Units(z, z.astype(bool), z, z, z, z, z, z.astype(np.uint64), np.zeros(1, np.int64), z.astype(np.uint64))
    same = np.r_[False, doc[1:] == doc[:-1]]
    begin = np.searchsorted(doc, doc, side="left")

    first = np.flatnonzero(~same | np.r_[True, line[1:] != line[:-1]])
    last = np.r_[first[1:], n]
    long = last - first >= least_words
    first, last = first[long], last[long]

    cut = _cuts(h, doc, same)
    upto = np.r_[cut, n][np.searchsorted(cut, cut + MIN_WORDS)]
    ends = (upto < n) & (doc[np.minimum(upto, n - 1)] == doc[cut])
    c_first, c_last, c_number = cut[ends], upto[ends], (np.arange(len(cut)) - np.searchsorted(doc[cut], doc[cut], side="left"))[ends]

    shingle = np.zeros(max(n - SHINGLE + 1, 0), np.uint64)
    for k in range(SHINGLE):
        shingle = (shingle + h[k:n - SHINGLE + 1 + k]) * MIX if len(shingle) else shingle
    count = np.r_[np.maximum(last - first - SHINGLE + 1, 0), np.zeros(len(c_first), np.int64)]
    whole = [_chained(h, a, b, salt) for a, b, salt in ((first, last, LINE), (c_first, c_last, np.uint64(0))) if len(a)]
    a, b = np.r_[first, c_first], np.r_[last, c_last]
    return Units(doc[a], np.arange(len(a)) >= len(first), np.r_[line[first], c_number], a - begin[a], b - a, start[a], end[b - 1],
                 np.concatenate(whole) if whole else h[:0], np.r_[0, np.cumsum(count)], _mix(shingle)[gather_ranges(a, count)])


def band_keys(shingles: np.ndarray, offset: np.ndarray, bands: int) -> list[np.ndarray]:
    """Smallest hash of each paragraph under each band's permutation."""
    out = []
    for k in range(bands):
        low = np.minimum.reduceat(_mix(shingles ^ np.uint64(int(MIX) * (2 * k + 1) % 2**64)), offset[:-1])
        out.append((low // np.uint64(16) * np.uint64(16) + np.uint64(k)).view(np.int64))
    return out


def _segments(docs: DataFrame, id_col: str, text_col: str, least_words: int) -> DataFrame:
    """One row a unit; ``row`` tells documents of one id apart."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        row = TaskContext.get().partitionId() << 36
        for b in slices(batches, 1):
            u = units(b.column(1).to_pylist(), least_words)
            if len(u.doc):
                data = pa.Array.from_buffers(pa.binary(), len(u.doc), [None, pa.py_buffer((u.offset * 4).astype(np.int32)),
                                                                       pa.py_buffer((u.shingles >> np.uint64(32)).astype(np.uint32))])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(u.doc)), pa.array(row + u.doc), pa.array(u.chunk),
                     *(pa.array(x.astype(np.int32)) for x in (u.number, u.first, u.start, u.end, u.n_words)), pa.array(u.h.view(np.int64)), data],
                    ["id", "row", "chunk", "number", "first", "start", "end", "n_words", "h", "shingles"])
            row += b.num_rows

    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"id {id_type}, row bigint, chunk boolean, number int, first int, start int, end int, n_words int, h bigint, shingles binary"))


def _sets(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Packed shingles of a binary column, and their offsets."""
    offset = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1] // 4
    data = col.buffers()[2]
    flat = np.frombuffer(data, np.uint32, offset[-1])[offset[0]:] if data is not None and offset[-1] else np.zeros(0, np.uint32)
    return flat, offset - offset[0]


def _distinct_sets(segments: DataFrame) -> DataFrame:
    """``(h, shingles)`` of paragraphs with shingles, each once a batch, so that
    a common line is not shuffled by its occurrences."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                yield b.take(pa.array(np.unique(b.column(0).to_numpy(), return_index=True)[1]))
    return segments.where(F.octet_length("shingles") > 0).select("h", "shingles").mapInArrow(run, "h bigint, shingles binary")


def _index(segments: DataFrame, bands: int) -> DataFrame:
    """``(key, h, n)`` for each band, or for the hash of a unit without
    shingles; equal units of a batch are one row."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            h, first, n = np.unique(b.column(0).to_numpy(), return_index=True, return_counts=True)
            flat, offset = _sets(b.column(1).take(pa.array(first)))
            some = np.diff(offset) > 0
            for keys, of in ((band_keys(flat.astype(np.uint64), np.r_[offset[:-1][some], len(flat)], bands) if some.any() else [], some),
                             ([_mix(h[~some].view(np.uint64)).view(np.int64) // 16 * 16], ~some)):
                for key in keys:
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(h[of]), pa.array(n[of])], ["key", "h", "n"])
    return segments.select("h", "shingles").mapInArrow(run, "key bigint, h bigint, n bigint")


def _collisions(index: DataFrame) -> DataFrame:
    """Rows ``(h, key, n)``: key is null for a unit that occurs ``n`` times, else
    a bucket with two or more units that this one is in."""
    def emit(keys, h, n, cut):
        """Rows of whole runs; ``cut``: key of a run that began before."""
        if not len(keys):
            return
        fresh = np.r_[True, (keys[1:] != keys[:-1]) | (h[1:] != h[:-1])]
        at = np.flatnonzero(fresh)
        times = np.add.reduceat(n, at)
        key, one = keys[at], h[at]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[starts, len(key)])
        members = np.repeat(sizes, sizes)
        if cut is not None:
            members[key == cut] = BLOCK
        again = np.flatnonzero((times > 1) & (key.view(np.uint64) % np.uint64(16) == 0))
        more = np.flatnonzero(members > 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[one[again], one[more]]), pa.array([None] * len(again) + key[more].tolist(), pa.int64()),
             pa.array(np.r_[times[again], np.ones(len(more), np.int64)])], ["h", "key", "n"])

    def run(batches):
        keys = h = n = np.zeros(0, np.int64)
        cut = None
        for b in batches:
            keys, h, n = (np.r_[old, b.column(i).to_numpy(zero_copy_only=False)] for i, old in enumerate((keys, h, n)))
            if not len(keys):
                continue
            open_at = int(np.searchsorted(keys, keys[-1], side="left"))          # the last run may go on
            yield from emit(keys[:open_at], h[:open_at], n[:open_at], cut)
            if open_at:
                cut = None
            keys, h, n = keys[open_at:], h[open_at:], n[open_at:]
            if len(keys) > BLOCK and h[0] != h[-1]:
                # a long run: hand on all but its last paragraph, which may repeat
                cut = keys[0]
                upto = int(np.searchsorted(h, h[-1], side="left"))
                yield from emit(keys[:upto], h[:upto], n[:upto], cut)
                keys, h, n = keys[upto:], h[upto:], n[upto:]
            elif len(keys) > BLOCK:
                keys, h, n = keys[:1], h[:1], np.array([n.sum()])                # one paragraph, again and again
        yield from emit(keys, h, n, cut)

    return (index.repartition("key").sortWithinPartitions("key", "h").select("key", "h", "n")
            .mapInArrow(run, "h bigint, key bigint, n bigint"))


def similar_sets(sets: list[np.ndarray], similarity: float):
    """``near(i, j)`` over shingle sets for :func:`components.forest`."""
    sizes = np.array([len(s) for s in sets])
    flat, starts = np.concatenate(sets), np.cumsum(sizes) - sizes
    order = np.argsort(flat, kind="stable")
    row, ranked = np.repeat(np.arange(len(sets)), sizes)[order], flat[order]

    def near(i, j):
        hit = np.zeros((j - i, len(sets)), bool)
        for k in range(i, j):
            a, b = np.searchsorted(ranked, sets[k], "left"), np.searchsorted(ranked, sets[k], "right")
            common = np.zeros(len(sets), np.int64)
            for x, y in zip(a, b):
                common[row[x:y]] += 1
            hit[k - i] = common >= similarity * (sizes[k] + sizes - common) - 1e-9
        return hit
    return near


def _verified(members: DataFrame, similarity: float) -> DataFrame:
    """Links ``(a, b)`` of rows ``(key, low, high, h, shingles)``: a spanning
    forest of each group's pairs that reach the similarity.  Groups stream
    through sorted; one holds two blocks at most."""
    def links(h, sets):
        h, first = np.unique(np.array(h, np.int64), return_index=True)
        distinct = [np.unique(np.frombuffer(sets[i], np.uint32)).astype(np.int64) for i in first]
        label = forest(len(h), similar_sets(distinct, similarity))
        child = np.flatnonzero(label != np.arange(len(h)))
        return h[label[child]], h[child]

    def run(batches):
        group, h, sets = None, [], []
        for b in chain(batches, [None]):
            out = []
            for *now, one, packed in zip(*(c.to_pylist() for c in b.columns)) if b is not None else [(None, 0, b"")]:
                if now != group:
                    if len(h) > 1:
                        out.append(links(h, sets))
                    group, h, sets = now, [], []
                h.append(one)
                sets.append(packed)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], ["a", "b"])

    return (members.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
            .select("key", "low", "high", "h", "shingles").mapInArrow(run, "a bigint, b bigint"))


def _dealt(buckets: DataFrame) -> DataFrame:
    """Members of buckets ``(key, h)`` as groups ``(key, low, high)``: one for a
    bucket of a block, one for each pair of blocks of a longer bucket."""
    parts = (buckets.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts")).where("parts > 1"))
    parts = cut_lineage(parts, "parts")
    all_of = buckets.join(parts, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("bigint")))
    return (all_of.withColumn("side", F.pmod(F.xxhash64("h"), F.col("parts")))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
            .select("key", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "h"))


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
             least_words: int = MIN_WORDS) -> DataFrame:
    """One row an occurrence of a paragraph or chunk whose component stands in
    two or more documents: ``(id, unit, paragraph, start, end, n_words,
    component, component_size, rep_id, kept, run_words, removed)``; offsets are
    code points, ``paragraph`` is the line's (or the chunk's) number."""
    parts = default_partitions(docs.sparkSession)
    segments = cut_lineage(_segments(docs, id_col, text_col, least_words), "paragraphs")
    hits = cut_lineage(_collisions(_index(segments, bands_for(similarity))), "collisions")
    times = cut_lineage(hits.groupBy("h").agg(F.max("n").alias("n")), "wanted")
    hot = cut_lineage(hot_keys(times, "h", "n", parts), "hot-paragraphs")

    # equal units are one node; only paragraphs in buckets are compared
    buckets = cut_lineage(hits.where("key is not null").select("key", "h").distinct(), "buckets")
    sets = (_distinct_sets(segments)
            .join(buckets.select("h").distinct(), "h", "left_semi").groupBy("h").agg(F.min("shingles").alias("shingles")))
    edges = cut_lineage(_verified(_dealt(buckets).join(cut_lineage(sets, "sets"), "h"), similarity), "passage-links")
    nodes = components(edges, "passages").select(F.col("node").alias("h"), "component")
    of_h = cut_lineage(times.join(nodes, "h", "left").select("h", F.coalesce("component", "h").alias("component")), "passage-map")
    placed = cut_lineage(lookup_join(segments.drop("shingles"), of_h, "h", SHUFFLED, "row", hot), "placed")
    release(segments)

    by_component = placed.groupBy("component").agg(
        F.count(F.lit(1)).alias("component_size"), F.min("id").alias("rep_id"), F.max("id").alias("last"),
        F.min(F.struct("id", "number")).alias("kept_at")).where("rep_id <> last")
    sizes = cut_lineage(by_component.select("component", "component_size", "rep_id", F.col("kept_at.number").alias("kept_number")), "passage-sizes")
    hot = cut_lineage(hot_keys(sizes, "component", "component_size", parts), "hot-components")
    found = lookup_join(placed, sizes, "component", SHUFFLED, "row", hot)

    # within a document: chunks inside a reported paragraph go, the rest make runs
    order = Window.partitionBy("row").orderBy("first", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    upto = F.col("first") + F.col("n_words")
    inside = F.coalesce(F.max(F.when(~F.col("chunk"), upto)).over(order) >= upto, F.lit(False))
    found = found.withColumn("inside", inside).where(~(F.col("chunk") & F.col("inside")))
    apart = F.coalesce(F.max(upto).over(order) < F.col("first"), F.lit(True)).cast("int")
    found = found.withColumn("apart", apart).withColumn("run", F.sum("apart").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy("row", "run")
    kept = F.col("id").eqNullSafe(F.col("rep_id")) & (F.col("number") == F.col("kept_number"))
    found = found.withColumn("run_words", F.max(upto).over(run) - F.min("first").over(run)).withColumn("kept", kept)
    return found.select(
        F.col("id").alias(id_col), F.when(F.col("chunk"), "chunk").otherwise("paragraph").alias("unit"), F.col("number").alias("paragraph"), "start", "end",
        "n_words", "component", "component_size", "rep_id", "kept", "run_words", ((F.col("run_words") > CUT_WORDS) & ~F.col("kept")).alias("removed"))
