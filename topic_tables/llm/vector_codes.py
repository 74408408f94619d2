"""Vector code compression: codebooks by k-means, nearest entries by Orchard search.

A vector becomes integers floor(256 * x) and is cut into equal consecutive
parts; every part position has a codebook, and a vector's code is the index of
the nearest entry in each.  A codebook keeps, for every entry, the list of all
entries sorted by their distance from it.  A search stands at some entry and
walks its list: an entry that is nearer to the vector becomes the place to
stand and its own list is walked, entries already tried are marked and skipped,
and the walk ends where the list is beyond twice the current distance, since by
the triangle inequality no entry from there on can be as near.  All searches of
an Arrow batch take their steps together in numpy.  Arithmetic is in integers,
so the result is exact and does not depend on the partitions.

Codebooks start from the vectors of the smallest ids.  A round sends the
codebooks (parts x entries x width integers) to the tasks, and each task sends
back one sum and count an entry, which Spark adds up.

Rows: a vector that is null, empty or holds a null or a non-finite component is
dropped, and so is one whose length is not the commonest (of equally common
lengths the greatest).  Repeated rows and ids are rows of their own; null ids
come last among the starting vectors.  With fewer vectors than entries the
codebooks are shorter.  Null labels are one label.  An empty table gives an
empty table.  Components of 65,536 and more in magnitude count as 65,536, which
keeps squared distances within 64 bits.  Columns other than id, vector and
label are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topic_tables.llm.text import column
from topic_tables.operators.joins import broadcast_limit, hot_keys, lookup_join
from topic_tables.session import cut_lineage, default_partitions, release

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Integers beyond this saturate.
MOST = 1 << 24
#: Rows whose searches step together.
ROWS_AT_ONCE = 8192


class Orchard:
    """Nearest entry of one codebook, ties to the lower index."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries = np.ascontiguousarray(entries, np.int64)
        k = len(entries)
        apart = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(-1)
        self.order = np.argsort(apart, axis=1, kind="stable")
        self.far = np.c_[np.take_along_axis(apart, self.order, 1), np.full(k, np.iinfo(np.int64).max)]
        self.by_first = np.argsort(entries[:, 0], kind="stable") if entries.shape[1] else np.zeros(k, int)
        self.tried = 0                     # distances taken, for tests

    def start(self, x: np.ndarray) -> np.ndarray:
        if not x.shape[1]:
            return np.zeros(len(x), np.int64)
        at = np.searchsorted(self.entries[self.by_first, 0], x[:, 0])
        return self.by_first[np.minimum(at, len(self.entries) - 1)]

    def apart(self, x: np.ndarray, entry: np.ndarray) -> np.ndarray:
        self.tried += len(x)
        gap = x - self.entries[entry]
        return np.einsum("ij,ij->i", gap, gap)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of every row of ``x``."""
        now = self.start(x)
        best = self.apart(x, now)
        at = np.zeros(len(x), np.int64)
        marked = np.zeros((len(x), len(self.entries)), bool)
        marked[np.arange(len(x)), now] = True
        live = np.arange(len(x))
        while len(live):
            live = live[self.far[now[live], at[live]] <= 4 * best[live]]
            entry = self.order[now[live], at[live]]
            at[live] += 1
            new = ~marked[live, entry]
            i, entry = live[new], entry[new]
            marked[i, entry] = True
            d = self.apart(x[i], entry)
            nearer = (d < best[i]) | ((d == best[i]) & (entry < now[i]))
            j = i[nearer]
            now[j], best[j], at[j] = entry[nearer], d[nearer], 0
        return now, best


@dataclass
class Codebooks:
    entries: np.ndarray            # parts x entries x width, int64

    @property
    def parts(self) -> int:
        return self.entries.shape[0]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry of every row and part, squared distances likewise)."""
        books = [Orchard(e) for e in self.entries]
        x = x.reshape(len(x), self.parts, -1)
        code, error = np.zeros((len(x), self.parts), np.int64), np.zeros((len(x), self.parts), np.int64)
        for a in range(0, len(x), ROWS_AT_ONCE):
            for p, book in enumerate(books):
                code[a:a + ROWS_AT_ONCE, p], error[a:a + ROWS_AT_ONCE, p] = book.nearest(x[a:a + ROWS_AT_ONCE, p])
        return code, error


def _rows(col: pa.Array) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(col), -1)


def integers(df: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """``(id, label, vec array<int>)`` of the usable vectors, written."""
    x = F.col("vec")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = F.transform(x, lambda v: F.greatest(F.least(F.floor(v * F.lit(float(SCALE))), F.lit(MOST)), F.lit(-MOST)).cast("int"))
    usable = (df.select(column(id_col).alias("id"), column(label_col).alias("label"), column(vec_col).cast("array<double>").alias("vec"))
              .where((F.size("vec") > 0) & finite))
    rows = cut_lineage(usable.select("id", "label", whole.alias("vec")), "codes-vectors")
    lengths = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.col("count").desc(), F.col("n").desc()).limit(1).collect()
    out = rows.where(F.size("vec") == lengths[0]["n"]) if lengths else rows
    out._tt_path, out._tt_length = rows._tt_path, lengths[0]["n"] if lengths else 0
    return out


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks of the rows of :func:`integers`; None without rows."""
    if rows._tt_length % parts:
        raise ValueError(f"vectors of {rows._tt_length} components cannot be cut into {parts} equal parts")
    first = rows.orderBy(F.col("id").asc_nulls_last(), "vec").limit(entries).select("vec").collect()
    if not first:
        return None
    start = np.array([r["vec"] for r in first], np.int64)
    books = Codebooks(np.ascontiguousarray(start.reshape(len(start), parts, -1).transpose(1, 0, 2)))
    for _ in range(rounds):
        books = _moved(rows, books)
    return books


def _moved(rows: DataFrame, books: Codebooks) -> Codebooks:
    """Every entry replaced by the floor of its parts' mean."""
    shared = rows.sparkSession.sparkContext.broadcast(books)
    parts, k, width = books.entries.shape

    def run(batches):
        books = shared.value
        sums = np.zeros((parts, k, width + 1), np.int64)
        for b in batches:
            if b.num_rows:
                x = _rows(b.column(0))
                code, _ = books.assign(x)
                x = x.reshape(len(x), parts, width)
                for p in range(parts):
                    np.add.at(sums[p, :, :width], code[:, p], x[:, p])
                    sums[p, :, width] += np.bincount(code[:, p], minlength=k)
        used = np.flatnonzero(sums[:, :, width].ravel())
        flat = sums.reshape(-1, width + 1)[used]
        ends = np.arange(len(used) + 1, dtype=np.int32) * (width + 1)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.ravel()))], ["entry", "sums"])

    partial = rows.select("vec").mapInArrow(run, "entry int, sums array<bigint>")
    totals = (partial.select("entry", F.posexplode("sums").alias("at", "x")).groupBy("entry", "at").agg(F.sum("x").alias("x"))
              .groupBy("entry").agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("xs"))).collect()
    shared.destroy()
    out = books.entries.reshape(-1, width).copy()
    for row in totals:                     # at most parts x entries rows
        sums = np.array([x["x"] for x in row["xs"]], np.int64)
        out[row["entry"]] = sums[:-1] // sums[-1]
    return Codebooks(out.reshape(books.entries.shape))


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """``(id, label, code, error)`` of the rows of :func:`integers`."""
    shared = rows.sparkSession.sparkContext.broadcast(books)
    types = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("id", "label"))

    def run(batches):
        books = shared.value
        digits = np.array([f"{i:02x}" for i in range(256)])
        for b in batches:
            if b.num_rows:
                code, error = books.assign(_rows(b.column(2)))
                text = ["".join(c) for c in digits[code]]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string()), pa.array(error.sum(1))], ["id", "label", "code", "error"])

    return rows.select("id", "label", "vec").mapInArrow(run, f"{types}, code string, error bigint")


def compress(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks | None]:
    """Codes of all usable vectors and the codebooks to decode them with:
    ``(id, label, code, error, label_error)``."""
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    spark = df.sparkSession
    rows = integers(df, id_col, vec_col, label_col)
    books = train(rows, parts, entries, rounds)
    if books is None:
        label = rows.schema["label"].dataType.simpleString()
        return spark.createDataFrame([], f"{rows.schema['id'].name} {rows.schema['id'].dataType.simpleString()}, label {label}, code string, error bigint, label_error bigint"), None
    coded = cut_lineage(encode(rows, books), "codes")
    release(rows)
    # null labels are one label; its rows may be many, so they are salted where the labels are not broadcast
    keyed = coded.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("")))
    sums = cut_lineage(keyed.groupBy("key").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("rows")), "codes-labels")
    size = sums.agg(F.sum(F.octet_length("key") + 48).alias("b")).first()["b"] or 0
    hot = hot_keys(sums, "key", "rows", default_partitions(spark)) if size > broadcast_limit(spark) else None
    out = lookup_join(keyed, sums.select("key", "label_error"), "key", size, "code", hot)
    return out.select("id", "label", "code", "error", "label_error"), books


def decode(code: str, books: Codebooks) -> np.ndarray:
    """The vector that a code stands for, as its integers over the scale."""
    entry = [int(code[i:i + 2], 16) for i in range(0, len(code), 2)]
    return np.concatenate([books.entries[p, e] for p, e in enumerate(entry)]) / SCALE


def _assigned(name: str, book: str) -> str:
    return f"""{name} AS (SELECT vec_id, part, any_value(v) AS v, min({{'d': d, 'entry': entry}}) AS m FROM (
  SELECT p.vec_id, p.part, p.v, c.entry, list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
  FROM p JOIN {book} c USING (part)) GROUP BY vec_id, part)"""


def _next(name: str, old: str, assigned: str) -> str:
    return f"""{name} AS (SELECT c.part, c.entry, coalesce(n.v, c.v) AS v FROM {old} c LEFT JOIN (
  SELECT part, entry, list(x ORDER BY pos) AS v FROM (
    SELECT part, m.entry AS entry, pos, floor(sum(v[pos + 1])::DOUBLE / count(*))::BIGINT AS x
    FROM {assigned}, range(256) t(pos) WHERE pos < len(v) GROUP BY part, m.entry, pos) GROUP BY part, entry) n
  ON n.part = c.part AND n.entry = c.entry)"""


#: For vectors of up to 4,096 components.
ORACLE = f"""
WITH k AS (SELECT vec_id, label, embedding AS e FROM embeddings WHERE embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT vec_id, part, list_transform(e[part * (len(e) // {PARTS}) + 1 : (part + 1) * (len(e) // {PARTS})], lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM k, range({PARTS}) t(part)),
c0 AS (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, v FROM p
  WHERE vec_id IN (SELECT vec_id FROM k ORDER BY vec_id LIMIT {ENTRIES})),
{_assigned("a0", "c0")},
{_next("c1", "c0", "a0")},
{_assigned("a1", "c1")},
{_next("c2", "c1", "a1")},
{_assigned("a2", "c2")},
books AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c2),
r AS (SELECT vec_id, string_agg(format('{{:02x}}', m.entry), '' ORDER BY part) AS code, sum(m.d)::BIGINT AS error FROM a2 GROUP BY vec_id)
SELECT r.vec_id, code, error, (sum(error) OVER (PARTITION BY k.label))::BIGINT AS label_error, codebooks_sha256
FROM r JOIN k USING (vec_id), books
"""
