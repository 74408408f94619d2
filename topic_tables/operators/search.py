"""Similarity search and top-n reports.

similar_docs: exact top-n documents per query by cosine of topic vectors.
  The documents' unit vectors are written to files in the shared checkpoint
  folder, in the order that decides between equal scores.  A task scans them
  for a block of queries with matrix products, and looks only at scores above a
  query's n-th best so far.

  More documents than one block are first cut into cells around sampled
  centres, and a cell into rings by the angle to its centre.  With a query's
  angle to the centre, a ring's angles bound the best cosine that any document
  of the ring can have.  Some queries are scanned to see how many documents
  stand in rings that their bounds leave in reach; where those are few, a first
  round scores each query against the rings of the best bounds that hold n
  documents, and a second round goes on only to rings whose bound reaches the
  n-th score so far.  Ring and queries meet in one task (long rings and many
  queries in several), which emits the top-n of each query.

  A final row_number per query picks the global top-n, so no (document, query)
  pair table exists and no vector of a document passes the driver but the
  sampled centres.

Ranking order everywhere (D11): score rounded to 8 digits descending, then the
label (name / token / topic) ascending with null first, then row_id.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topic_tables.functions.vectors import top_n_of_array
from topic_tables.operators.joins import lookup_join
from topic_tables.operators.phi_files import open_folder
from topic_tables.session import cut_lineage, release, scratch_path

HITS = "query_id bigint, row_id bigint, name string, score double"
#: Bytes of vectors in a block of documents, and of queries.
DOC_BLOCK_BYTES = 32 << 20
QUERY_BLOCK_BYTES = 8 << 20
#: Scores that a task holds at once.
SCORES_AT_ONCE = 1_000_000
#: Queries and documents of one matrix product of a scan.
QUERIES_AT_ONCE, DOCUMENTS_AT_ONCE = 512, 8192
#: Scores near a query's n-th best that are taken in doubles at once.
CANDIDATES_AT_ONCE = 100_000
#: Dimensions from which on a scan looks at products of singles first.
NARROW = 16
#: Queries that are scanned to see whether rings pay, and the share of the
#: documents in reach up to which they do.
QUERIES_TRIED, MOST_IN_REACH = 64, 0.25
#: Cells of more than one block of documents: as many as blocks, in these bounds.
LEAST_CELLS, MOST_CELLS = 32, 1024
#: Rings of equal angles between 0 and 180 degrees.
RINGS = 64
#: What angles may be off by.
SLACK = 1e-6


def _unit(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of a block, and which rows have one."""
    col = table[name].combine_chunks()
    m = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), -1) if len(col) else np.zeros((0, 1))
    norm = np.linalg.norm(m, axis=1) if len(m) else np.zeros(0)
    ok = norm > 0
    return m[ok] / norm[ok, None], ok


def _leading(query: np.ndarray, r8: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """Where the first n of each query stand, best score and first place first."""
    order = np.lexsort((place, -r8, query))
    starts = np.flatnonzero(np.r_[True, np.diff(query[order]) != 0])[:len(order)]
    return order[np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)])) < n]


def block_top(docs: pa.Table, queries: pa.Table, n: int) -> pa.Table:
    """Top-n documents of the block for each query of the block."""
    docs = docs.take(pc.sort_indices(docs, sort_keys=[("name", "ascending"), ("row_id", "ascending")], null_placement="at_start"))
    (d, ok), (q, okq) = _unit(docs, "vec"), _unit(queries, "qvec")
    docs, qid = docs.filter(pa.array(ok)), queries["query_id"].filter(pa.array(okq))
    of, at, got = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    step = max(1, SCORES_AT_ONCE // max(1, len(d)))
    for low in range(0, len(q) if len(d) else 0, step):
        scores = q[low:low + step] @ d.T                     # queries x documents
        r8 = np.round(scores, 8)
        m = min(n, len(d))
        best = -np.partition(-r8, m - 1, axis=1)[:, m - 1]    # the n-th best; ties with it may win
        row, col = np.nonzero(r8 >= best[:, None])
        lead = _leading(row, r8[row, col], col, n)
        of.append(row[lead] + low), at.append(col[lead]), got.append(scores[row[lead], col[lead]])
    of, at = np.concatenate(of), np.concatenate(at)
    return pa.table({"query_id": qid.take(pa.array(of)), "row_id": docs["row_id"].take(pa.array(at)),
                     "name": docs["name"].take(pa.array(at)).cast(pa.string()), "score": pa.array(np.concatenate(got))})


def similar_docs(doc_theta: DataFrame, query_theta: DataFrame, n: int = 20, doc_block_bytes: int = DOC_BLOCK_BYTES,
                 query_block_bytes: int = QUERY_BLOCK_BYTES) -> DataFrame:
    """F2+F3.  doc_theta(row_id, name, theta), query_theta(query_id, query_name, theta)
    → (query_id, query_name, rank, row_id, name, score).  Null and zero θ never rank."""
    docs = doc_theta.where(F.col("theta").isNotNull()).select("row_id", "name", "theta")
    queries = query_theta.where(F.col("theta").isNotNull()).select("query_id", "theta")
    n_d, n_q = _blocks(docs, doc_block_bytes), _blocks(queries, query_block_bytes)
    vectors = write_vectors(docs, n_d)
    cand, scored = None, None
    if n_d > 1:
        cand, scored = _pruned(docs, queries, n, n_d, doc_block_bytes, query_block_bytes, vectors)
    if cand is None:
        cand = cut_lineage(_scan(vectors, queries, n, n_q), "hits")
    release(vectors.frame)
    w = Window.partitionBy("query_id").orderBy(F.round("score", 8).desc(), F.col("name").asc_nulls_first(), F.col("row_id"))
    top = cand.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    names = query_theta.select("query_id", "query_name")
    out = top.join(names, "query_id").select("query_id", "query_name", F.col("rank").cast("int"),
                                             "row_id", "name", "score")
    out._tt_scored = scored
    return out


def _blocks(df: DataFrame, limit: int) -> int:
    size = df.agg(F.sum(F.size("theta") * 8 + 64).alias("b")).first()["b"] or 0
    return int(max(1, -(-size // limit)))


# --------------------------------------------------------------- vectors in files
@dataclass
class Vectors:
    """Unit vectors of documents, in the order of their names and ids, as
    files: ``<number>`` holds the vectors, ``<number>.rows`` ids and names."""

    uri: str
    width: int
    files: list                   # (number, documents), in order
    frame: DataFrame | None = None

    def __getstate__(self):
        return {**self.__dict__, "frame": None}

    def load(self, number: int, count: int) -> np.ndarray:
        fs, base, local = open_folder(self.uri)
        if local:
            return np.memmap(f"{base}/{number}", np.float64, "r", shape=(count, self.width)).view(np.ndarray)
        with fs.open_input_file(f"{base}/{number}") as f:
            return np.frombuffer(f.readall(), np.float64).reshape(count, self.width)

    def rows(self, number: int) -> pa.Table:
        fs, base, _ = open_folder(self.uri)
        with fs.open_input_file(f"{base}/{number}.rows") as f:
            return pa.ipc.open_file(f).read_all()


def write_vectors(docs: DataFrame, parts: int) -> Vectors:
    """``(row_id, name, theta)`` as files; null and zero vectors are left out."""
    uri = scratch_path(docs.sparkSession, "vectors")

    def run(batches):
        fs, base, _ = open_folder(uri)
        number, tag = TaskContext.get().partitionId(), uuid.uuid4().hex
        fs.create_dir(base, recursive=True)
        rows, width = [], 0
        with fs.open_output_stream(f"{base}/.{number}-{tag}") as f:
            for b in batches:
                m, ok = _unit(pa.Table.from_batches([b]), "theta")
                if len(m):
                    if width not in (0, m.shape[1]):
                        raise ValueError("vectors of unequal length")
                    width = m.shape[1]
                    f.write(np.ascontiguousarray(m).tobytes())
                    rows.append(b.select(["row_id", "name"]).filter(pa.array(ok)))
        if not rows:
            fs.delete_file(f"{base}/.{number}-{tag}")
            return
        rows = pa.Table.from_batches(rows)
        with fs.open_output_stream(f"{base}/.{number}-{tag}.rows") as f, pa.ipc.new_file(f, rows.schema) as w:
            w.write_table(rows)
        for end in ("", ".rows"):
            fs.move(f"{base}/.{number}-{tag}{end}", f"{base}/{number}{end}")
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([len(rows)], pa.int64()), pa.array([width], pa.int32())], ["number", "n", "width"])

    dealt = docs.select("row_id", "name", "theta").repartitionByRange(parts, "name", "row_id").sortWithinPartitions("name", "row_id")
    got = sorted(tuple(r) for r in dealt.mapInArrow(run, "number int, n bigint, width int").collect())     # a row a file
    if len({width for _, _, width in got}) > 1:
        raise ValueError("vectors of unequal length")
    frame = docs.limit(0)
    frame._tt_path = uri
    return Vectors(uri, got[0][2] if got else 0, [(number, n) for number, n, _ in got], frame)


class _Best:
    """The n best documents of each of some queries, while files are read in order."""

    def __init__(self, queries: np.ndarray, n: int):
        self.q, self.n = queries, n
        # In few dimensions a product costs less than to look twice.
        self.narrow = queries.shape[1] < NARROW
        self.q32 = queries if self.narrow else queries.astype(np.float32)
        self.margin = 0.0 if self.narrow else (queries.shape[1] + 8) * 2.0 ** -23    # what a product of singles may be off by
        self.least = np.full(len(queries), -np.inf)                       # the n-th best rounded score
        self.of, self.place, self.r8, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0)

    def add(self, docs: np.ndarray, single: np.ndarray, first: int) -> None:
        """Documents from place ``first`` on.  As places grow, one that equals
        the n-th best score comes behind it."""
        scores = self.q32 @ single.T
        low = self.least + 4e-9 - self.margin
        if len(docs) > self.n and np.isneginf(self.least).any():
            low = np.maximum(low, np.partition(scores, len(docs) - self.n, axis=1)[:, len(docs) - self.n] - 1e-8 - 2 * self.margin)
        found = np.flatnonzero(scores > low.astype(scores.dtype)[:, None])
        for a in range(0, len(found), CANDIDATES_AT_ONCE):
            of, at = np.divmod(found[a:a + CANDIDATES_AT_ONCE], len(docs))
            exact = scores[of, at] if self.narrow else np.einsum("ij,ij->i", self.q[of], docs[at])
            r8 = np.round(exact, 8)
            new = r8 > self.least[of]
            if new.any():
                self._keep(of[new], at[new] + first, r8[new], exact[new])

    def _keep(self, *new: np.ndarray) -> None:
        of, place, r8, score = (np.r_[a, b] for a, b in zip((self.of, self.place, self.r8, self.score), new))
        lead = _leading(of, r8, place, self.n)
        self.of, self.place, self.r8, self.score = of[lead], place[lead], r8[lead], score[lead]
        ends = np.cumsum(np.bincount(self.of, minlength=len(self.q)))
        full = np.diff(np.r_[0, ends]) == self.n
        self.least[full] = self.r8[ends[full] - 1]


def _top_of(vectors: Vectors, files: list, queries: pa.Table, n: int):
    """Hits of a block of queries among some of the files."""
    q, ok = _unit(queries, "qvec")
    qid = queries["query_id"].filter(pa.array(ok)).combine_chunks()
    if not len(q) or not files:
        return
    groups = [_Best(q[a:a + QUERIES_AT_ONCE], n) for a in range(0, len(q), QUERIES_AT_ONCE)]
    first, starts = 0, []
    for number, count in files:
        m = vectors.load(number, count)
        starts.append(first)
        for a in range(0, count, DOCUMENTS_AT_ONCE):
            docs = m[a:a + DOCUMENTS_AT_ONCE]
            single = docs if groups[0].narrow else docs.astype(np.float32)
            for g in groups:
                g.add(docs, single, first + a)
        first += count
    of = np.concatenate([g.of + i * QUERIES_AT_ONCE for i, g in enumerate(groups)])
    place, score = np.concatenate([g.place for g in groups]), np.concatenate([g.score for g in groups])
    file = np.searchsorted(starts, place, "right") - 1
    for i in np.unique(file).tolist():
        rows, here = vectors.rows(files[i][0]), np.flatnonzero(file == i)
        for a in range(0, len(here), 50_000):
            at = here[a:a + 50_000]
            hit = rows.take(pa.array(place[at] - starts[i])).combine_chunks()
            yield pa.RecordBatch.from_arrays([qid.take(pa.array(of[at])), *(hit[c].combine_chunks().cast(t) for c, t in (("row_id", pa.int64()), ("name", pa.string()))), pa.array(score[at])],
                                             ["query_id", "row_id", "name", "score"])


def _scan(vectors: Vectors, queries: DataFrame, n: int, n_q: int) -> DataFrame:
    """Every query against every document.  A task takes a block of queries
    through all files or, where the blocks are fewer than the cores, some."""
    spark = queries.sparkSession
    cores, rows = spark.sparkContext.defaultParallelism, queries.count()
    blocks = max(n_q, min(4 * cores, -(-rows // QUERIES_AT_ONCE)), 1)
    spans = max(1, min(len(vectors.files), -(-cores // blocks)))
    asked = queries.select("query_id", F.col("theta").alias("qvec"), F.explode(F.sequence(F.lit(0), F.lit(spans - 1))).alias("span"))

    def run(batches):
        batches = [b for b in batches if b.num_rows]
        if batches:
            table = pa.Table.from_batches(batches)
            for span in pc.unique(table["span"]).to_pylist():
                files = [f for i, f in enumerate(vectors.files) if i * spans // len(vectors.files) == span]
                yield from _top_of(vectors, files, table.filter(pc.equal(table["span"], span)), n)
    dealt = asked.repartition(blocks) if spans == 1 else asked.repartitionByRange(blocks * spans, "span", F.xxhash64("query_id"))
    return dealt.mapInArrow(run, HITS)


# ------------------------------------------------------------- rings and bounds
def _angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1.0, 1.0))


def _matrix(col: pa.Array) -> np.ndarray:
    m = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), -1)
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norm > 0, norm, 1.0)


class Rings:
    """Centres, and for each ring its number, cell, documents and angles."""

    def __init__(self, centres: np.ndarray, stats: list):
        self.centres = centres
        self.ring = np.array([r["ring"] for r in stats], np.int64)
        self.n = np.array([r["n"] for r in stats], np.int64)
        self.near, self.far = (_angle(np.array([r[c] for r in stats])) for c in ("high", "low"))

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The greatest cosine that each query can have with each ring."""
        angle = _angle(queries @ self.centres.T)[:, self.ring // RINGS]
        gap = np.maximum(angle - self.far, self.near - angle) - SLACK
        return np.where(gap > 0, np.cos(np.maximum(gap, 0)), 1.0)

    def first(self, bounds: np.ndarray, n: int) -> list[np.ndarray]:
        """For each query the rings of the best bounds that hold n documents."""
        out = []
        for b in bounds:
            order = np.argsort(-b, kind="stable")
            before = np.cumsum(self.n[order]) - self.n[order]
            out.append(order[before < n])
        return out


def _pruned(docs: DataFrame, queries: DataFrame, n: int, n_d: int, doc_block_bytes: int, query_block_bytes: int, vectors: Vectors):
    """Candidates, and (query, ring) pairs scored and in all; no candidates
    where the rings in reach of some queries hold most of the documents."""
    spark = docs.sparkSession
    nonzero = F.exists("theta", lambda x: x != 0)
    docs, queries = docs.where(nonzero), queries.where(nonzero)
    sample = docs.orderBy(F.xxhash64("row_id", F.lit("centre")), "row_id").limit(min(MOST_CELLS, max(LEAST_CELLS, n_d))).select("theta").collect()
    if not sample:
        return spark.createDataFrame([], HITS), (0, 0)
    centres = np.unique(np.array([r["theta"] for r in sample], np.float64), axis=0)
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    width = centres.shape[1] * 8 + 64

    def place(batches):
        for b in batches:
            if b.num_rows:
                cosine = _matrix(b.column(2)) @ centres.T
                cell = cosine.argmax(axis=1)
                best = cosine[np.arange(len(cell)), cell]
                ring = cell * RINGS + np.minimum((_angle(best) / (np.pi / RINGS)).astype(np.int64), RINGS - 1)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ring), pa.array(best)], ["row_id", "name", "vec", "ring", "cosine"])
    vector = docs.schema["theta"].dataType.simpleString()
    placed = cut_lineage(docs.select("row_id", "name", F.col("theta").alias("vec")).mapInArrow(place, f"row_id bigint, name string, vec {vector}, ring bigint, cosine double"), "rings")
    # at most cells x rings rows
    stats = placed.groupBy("ring").agg(F.count(F.lit(1)).alias("n"), F.min("cosine").alias("low"), F.max("cosine").alias("high")).orderBy("ring").collect()
    rings = Rings(centres, stats)
    if _in_reach(rings, vectors, queries, n) > MOST_IN_REACH:
        release(placed)
        return None, None
    shared = spark.sparkContext.broadcast(rings)

    def first(batches):
        rings = shared.value
        for b in batches:
            for a in range(0, b.num_rows, 500):
                part = b.slice(a, 500)
                got = rings.first(rings.bounds(_matrix(part.column(1))), n)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([rings.ring[g].tolist() for g in got], pa.list_(pa.int64()))], ["query_id", "qvec", "rings"])

    def more(batches):
        rings = shared.value
        for b in batches:
            for a in range(0, b.num_rows, 500):
                part = b.slice(a, 500)
                bounds = rings.bounds(_matrix(part.column(1)))
                least = part.column(3).to_numpy(zero_copy_only=False)
                rows = []
                for q, seen in enumerate(part.column(2).to_pylist()):
                    reach = bounds[q] >= (-2.0 if np.isnan(least[q]) else least[q] - 1e-7)
                    rows.append(np.setdiff1d(rings.ring[reach], seen).tolist())
                yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(rows, pa.list_(pa.int64()))], ["query_id", "qvec", "rings"])

    schema = f"query_id bigint, qvec {queries.schema['theta'].dataType.simpleString()}, rings array<bigint>"
    visits = cut_lineage(queries.select("query_id", F.col("theta").alias("qvec")).mapInArrow(first, schema), "visits")
    one = cut_lineage(_scored(placed, visits, n, doc_block_bytes // width, query_block_bytes // width), "hits")
    w = Window.partitionBy("query_id").orderBy(F.round("score", 8).desc())
    nth = one.withColumn("rank", F.row_number().over(w)).where(F.col("rank") == n).select("query_id", F.round("score", 8).alias("least"))
    again = cut_lineage(visits.join(nth, "query_id", "left").select("query_id", "qvec", "rings", "least").mapInArrow(more, schema), "visits")
    two = cut_lineage(_scored(placed, again, n, doc_block_bytes // width, query_block_bytes // width), "hits")
    count = visits.unionByName(again).agg(F.sum(F.size("rings")).alias("n")).first()["n"] or 0
    scored = int(count), visits.count() * len(stats)
    for table in (placed, visits, again):
        release(table)
    shared.destroy()
    return one.unionByName(two), scored


def _in_reach(rings: Rings, vectors: Vectors, queries: DataFrame, n: int) -> float:
    """The share of the documents that stand in rings in reach of a query, by some queries."""
    some = queries.orderBy(F.xxhash64("query_id", F.lit("reach")), "query_id").limit(QUERIES_TRIED).collect()
    q = np.array([r["theta"] for r in some], np.float64).reshape(len(some), -1)
    q /= np.linalg.norm(q, axis=1, keepdims=True) if len(q) else 1.0
    if not len(q):
        return 0.0
    tried = queries.sparkSession.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "query_id bigint, theta array<double>")
    got = _scan(vectors, tried, n, 1).groupBy("query_id").agg(F.slice(F.sort_array(F.collect_list("score"), False), 1, n).alias("s")).collect()
    least = np.full(len(q), -2.0)
    for r in got:
        if len(r["s"]) == n:
            least[r["query_id"]] = round(r["s"][-1], 8) - 1e-7
    reach = rings.bounds(q) >= least[:, None]
    return float((reach * rings.n).sum() / (len(q) * rings.n.sum()))


def _scored(placed: DataFrame, visits: DataFrame, n: int, doc_rows: int, query_rows: int) -> DataFrame:
    """The top-n of each query in each ring it visits.  A ring of many
    documents is cut into parts, one of many queries into groups."""
    asked = visits.select("query_id", "qvec", F.explode("rings").alias("ring"))
    sizes = {r["ring"]: r["n"] for r in placed.groupBy("ring").agg(F.count(F.lit(1)).alias("n")).collect()}
    wanted = {r["ring"]: r["n"] for r in asked.groupBy("ring").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not wanted:
        return placed.sparkSession.createDataFrame([], HITS)
    cuts = [(ring, -(-sizes[ring] // max(1, doc_rows)), -(-q // max(1, query_rows))) for ring, q in wanted.items()]
    cuts = F.broadcast(placed.sparkSession.createDataFrame(cuts, "ring bigint, parts bigint, groups bigint"))   # a row a ring

    def every(count: str):
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(count) - 1))
    left = (placed.join(cuts, "ring").withColumn("part", F.pmod(F.xxhash64("row_id"), F.col("parts"))).withColumn("group", every("groups"))
            .select("ring", "part", "group", "row_id", "name", "vec"))
    right = (asked.join(cuts, "ring").withColumn("group", F.pmod(F.xxhash64("query_id"), F.col("groups"))).withColumn("part", every("parts"))
             .select("ring", "part", "group", "query_id", "qvec"))

    def work(a: pa.Table, b: pa.Table) -> pa.Table:
        return block_top(a, b, n)
    return left.groupBy("ring", "part", "group").cogroup(right.groupBy("ring", "part", "group")).applyInArrow(work, HITS)


def top_words(model, n: int = 30) -> DataFrame:
    """top-n tokens per topic (topic, rank, token, p).  The row_number
    filter plans a partial WindowGroupLimit before the shuffle, so each map
    task sends at most n rows per topic."""
    named = lookup_join(model.phi, model.vocab.table.select("word_id", "token"), "word_id",
                        model.vocab.side_bytes(), spread_col="word_id")
    cells = named.select("token", F.posexplode("phi").alias("topic", "p"))
    w = Window.partitionBy("topic").orderBy(F.round("p", 8).desc(), F.col("token"))
    return (cells.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
            .select(F.col("topic").cast("int"), F.col("rank").cast("int"), "token", "p"))


def top_topics(theta: DataFrame, n: int = 20) -> DataFrame:
    """top-n topics per document, row-local (no shuffle); one null row for
    a document without θ."""
    tops = theta.select("row_id", F.posexplode_outer(top_n_of_array("theta", n)).alias("pos", "e"))
    return tops.select("row_id", (F.col("pos") + 1).cast("int").alias("rank"),
                       F.col("e.topic").cast("int").alias("topic"), F.col("e.p").alias("p"))
