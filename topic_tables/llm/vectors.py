"""Embedding near-duplicates inside the cells of a spherical k-means.

Centres are fitted on a bounded sample; every vector goes to the cell of its
nearest centre (its home) and, if it lies near the border of a cell with a
lower number, to that cell too.  Inside a cell, cosines are taken block by
block in double precision; a pair counts in the lower of its two homes, so it
counts once.  What leaves a block is the number of links of each vector and a
spanning forest of the links, never all pairs.

Borders: with centres c and c', a vector's distance to the plane between them
is (x.c - x.c') / |c - c'|.  Two vectors at the threshold differ along a given
direction by about sin(angle) / sqrt(dimension); a vector visits cells whose
border is nearer than ``MARGIN`` times that.  Pairs apart by more than the
margin across a border are what the method may miss.

Exact copies are counted together before they are dealt out.  A cell with more
rows than a block holds is split by the vectors' hashes, and each pair of its
blocks is a group of its own.  Equal vectors share a 64-bit hash as their name.

Rows: vectors that are null, empty, zero or hold a null or non-finite component
link with nothing (0 links, their own component).  Vectors of different lengths
are never compared; the centres serve the most common length, the others have a
cell each.  Repeated ids are rows of their own.  An empty table gives an empty
table.  Other columns are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topic_tables.llm.components import components, forest
from topic_tables.llm.text import share
from topic_tables.session import cut_lineage

THRESHOLD = 0.95
MARGIN = 2.5
#: Vectors of a cell on average, and most cells.
CELL_ROWS, MOST_CELLS = 500, 2048
#: Bound of the fit: numbers held in the sample, and vectors for each centre.
FIT_VALUES, FIT_EACH = 8_000_000, 50
FIT_ROUNDS = 10
#: Bytes of vectors in a block.
BLOCK_BYTES = 4 << 20
SEED = 5


def fit_centres(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means of unit rows; an empty cell takes the row that fits worst."""
    rng = np.random.default_rng(SEED)
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(FIT_ROUNDS):
        home, best = np.zeros(len(x), np.int64), np.zeros(len(x))
        for a in range(0, len(x), 8192):
            s = x[a:a + 8192] @ centres.T
            home[a:a + 8192], best[a:a + 8192] = s.argmax(1), s.max(1)
        order = np.argsort(home, kind="stable")
        cells, starts = np.unique(home[order], return_index=True)
        sums = np.add.reduceat(x[order], starts, axis=0)
        for c in np.setdiff1d(np.arange(k), cells):
            worst = int(best.argmin())
            best[worst] = 2.0
            cells, sums = np.r_[cells, c], np.vstack([sums, x[worst]])
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres[cells] = np.where(norm > 0, sums / np.maximum(norm, 1e-300), centres[cells])
    return centres


class Cells:
    """Homes and visits of unit vectors."""

    def __init__(self, centres: np.ndarray, threshold: float, margin: float):
        self.centres = centres
        gaps = np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 0))
        self.reach = margin * np.sqrt(1 - threshold ** 2) / np.sqrt(centres.shape[1]) * gaps

    def of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, cell and whether it is the row's home, for every place a row goes."""
        s = x @ self.centres.T
        home = s.argmax(1)
        near = s[np.arange(len(x)), home][:, None] - s <= self.reach[home]
        near &= np.arange(len(self.centres))[None, :] < home[:, None]
        row, cell = np.nonzero(near)
        return np.r_[np.arange(len(x)), row], np.r_[home, cell], np.r_[np.ones(len(x), bool), np.zeros(len(row), bool)]


def matrix(col: pa.Array) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """``(length, rows, values)`` for each length among a list column's rows."""
    sizes = np.diff(col.offsets.to_numpy())
    flat = col.values.to_numpy(zero_copy_only=False)
    first = col.offsets.to_numpy()[:-1]
    out = []
    for n in np.unique(sizes):
        at = np.flatnonzero(sizes == n)
        out.append((int(n), at, flat[first[at][:, None] + np.arange(n)[None, :]].astype(np.float64)))
    return out


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)       # no overflow or underflow in the norm
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _places(spark, rows: DataFrame, cells: "Cells | None", dim: int, salts: dict | None):
    """The mapper that deals vectors to cells: counts only without ``salts``."""
    shared = spark.sparkContext.broadcast((cells, dim, salts))

    def run(batches):
        cells, dim, salts = shared.value
        count: Counter = Counter()
        for b in batches:
            if not b.num_rows:
                continue
            hashes = b.column(0).to_numpy()
            _, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
            times = np.bincount(inverse)
            b, hashes = b.take(pa.array(first)), hashes[first]
            for n, at, values in matrix(b.column(1)):
                if n == dim and cells is not None:
                    row, cell, home = cells.of(unit(values))
                else:
                    row, cell, home = np.arange(len(at)), np.zeros(len(at), np.int64), np.ones(len(at), bool)
                if salts is None:
                    count.update({(n, int(c)): int(m) for c, m in zip(*np.unique(cell, return_counts=True))})
                    continue
                parts = np.array([salts.get((n, int(c)), 1) for c in cell])
                side = (hashes[at][row].view(np.uint64) % parts.astype(np.uint64)).astype(np.int64)
                again = np.repeat(np.arange(len(row)), parts)                       # a row for each block of its cell
                other = np.arange(len(again)) - np.repeat(np.cumsum(parts) - parts, parts)
                low, high = np.minimum(side[again], other), np.maximum(side[again], other)
                for k in range(0, len(again), 4096):
                    s = slice(k, k + 4096)
                    src = at[row[again[s]]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(src), n)), pa.array(cell[again[s]]), pa.array(low[s]), pa.array(high[s]), pa.array(side[again[s]]),
                         pa.array(home[again[s]]), pa.array(hashes[src]), pa.array(times[src]), b.column(1).take(pa.array(src))],
                        ["dim", "cell", "low", "high", "side", "home", "h", "n", "vec"])
        if salts is None and count:
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in count]), pa.array([k[1] for k in count]), pa.array(list(count.values()))], ["dim", "cell", "n"])
    return run


def block_links(key, table: pa.Table, threshold: float) -> pa.Table:
    """Link counts and a spanning forest of one pair of blocks (or of one)."""
    low, high = key[2].as_py(), key[3].as_py()
    table = table.combine_chunks()
    h, n = table["h"].to_numpy(), table["n"].to_numpy()
    uniq, first, inverse = np.unique(h, return_index=True, return_inverse=True)
    n = np.bincount(inverse, weights=n).astype(np.int64)
    vec = table["vec"].combine_chunks()
    x = unit(matrix(vec.take(pa.array(first)))[0][2])
    home, side = table["home"].to_numpy(zero_copy_only=False)[first], table["side"].to_numpy()[first]
    links = np.zeros(len(uniq), np.int64)
    index = np.arange(len(uniq))

    def near(i, j):
        hit = x[i:j] @ x.T >= threshold
        hit &= home[i:j, None] | home[None, :]
        hit[np.arange(j - i), index[i:j]] = False
        if low != high:
            hit &= side[i:j, None] != side[None, :]
        links[i:j] = hit @ n
        return hit

    label = forest(len(uniq), near)
    child = np.flatnonzero(label != index)
    counted = np.flatnonzero(links)
    return pa.table({"a": np.r_[uniq[label[child]], uniq[counted]], "b": pa.array([*uniq[child].tolist(), *[None] * len(counted)], pa.int64()),
                     "links": np.r_[np.zeros(len(child), np.int64), links[counted]]})


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD,
                    margin: float = MARGIN, cell_rows: int = CELL_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(id, n_links, component_id, kept)`` of every row; of each component the
    row whose id names it is kept."""
    spark = vectors.sparkSession
    v = F.col(vec_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    valid = v.isNotNull() & (F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).alias("id"), v.alias("vec"), F.coalesce(valid, F.lit(False)).alias("valid"), F.xxhash64(v).alias("h"))
    names = cut_lineage(rows.select("id", "h", "valid"), "vector-names")
    copies = cut_lineage(names.where("valid").groupBy("h").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n")), "vector-copies")
    lengths = rows.where("valid").groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    dim, total = (lengths[0][0], copies.count()) if lengths else (0, 0)
    vecs = rows.where("valid").select("h", "vec")

    k = max(1, min(MOST_CELLS, total // cell_rows))
    cells = None
    if dim and k > 1:
        want = min(FIT_VALUES // dim, FIT_EACH * k)
        all_rows = lengths[0][1]
        sample = rows.where(F.col("valid") & (F.size("vec") == dim) & (share("h") * all_rows < want)).select("vec").toArrow()
        col = sample["vec"].combine_chunks()
        if len(col) >= 2 * k:
            x = unit(matrix(col)[0][2])
            x = x[np.lexsort(x.T[:4])]          # one order however Spark returns them
            cells = Cells(fit_centres(x, k), threshold, margin)
    counts = vecs.mapInArrow(_places(spark, vecs, cells, dim, None), "dim bigint, cell bigint, n bigint").groupBy("dim", "cell").agg(F.sum("n").alias("n"))
    salts = {(r["dim"], r["cell"]): -(-r["n"] * r["dim"] * 4 // block_bytes) for r in counts.collect()}      # a row a cell
    salts = {c: s for c, s in salts.items() if s > 1}
    vec_type = rows.schema["vec"].dataType.simpleString()
    dealt = vecs.mapInArrow(_places(spark, vecs, cells, dim, salts),
                            f"dim bigint, cell bigint, low bigint, high bigint, side bigint, home boolean, h bigint, n bigint, vec {vec_type}")

    def work(key, table):
        return block_links(key, table, threshold)

    found = cut_lineage(dealt.groupBy("dim", "cell", "low", "high").applyInArrow(work, "a bigint, b bigint, links bigint"), "vector-links")
    links = found.where("b is null").groupBy(F.col("a").alias("h")).agg(F.sum("links").alias("links"))
    nodes = components(found.where("b is not null").select("a", "b").distinct(), "vectors").select(F.col("node").alias("h"), "component")
    named = cut_lineage(nodes.join(copies, "h").groupBy("component").agg(F.min("low").alias("least")), "vector-components")
    of = copies.join(links, "h", "left").join(nodes.join(named, "component").select("h", "least"), "h", "left")
    of = cut_lineage(of.select("h", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("least", "low").alias("least")), "vector-map")
    out = names.where("valid").select("id", "h").join(of, "h").select("id", "links", "least").unionByName(
        names.where("not valid").select("id", F.lit(0).cast("bigint").alias("links"), F.col("id").alias("least")))
    return out.select(F.col("id").alias(id_col), F.col("links").cast("bigint").alias("n_links"), F.col("least").alias("component_id"),
                      F.col("id").eqNullSafe(F.col("least")).alias("kept"))


#: All pairs, exactly: what the cells find as long as no pair lies across a border.
ORACLE = f"""
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
g AS (SELECT * FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                        AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b
      ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= {THRESHOLD}),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT vec_id, n_links, component_id, vec_id = component_id AS kept FROM (
  SELECT v.vec_id, coalesce(c.n, 0) AS n_links, least(v.vec_id, coalesce(m.low, v.vec_id)) AS component_id
  FROM v LEFT JOIN (SELECT a, count(*) AS n FROM l GROUP BY a) c ON c.a = v.vec_id
         LEFT JOIN (SELECT a, min(b) AS low FROM r GROUP BY a) m ON m.a = v.vec_id)
"""
