"""φ as array files in the shared checkpoint folder.

A word block is a range of word ids whose rows (K values, and β for the robust
model) fit a bound.  Each block is one file of doubles, row after row, written
by the task that the block's rows are shuffled to and read by the tasks that
need it: mapped into memory where the folder is a local or mounted one, else
read a block at a time.  No row of φ passes the driver, which knows only where
the files are.  A file is written under a name of its own and then moved into
place, so a repeated task leaves the same file.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topic_tables.operators.joins import broadcast_limit
from topic_tables.session import scratch_path

#: Bytes of a block of φ.
BLOCK_BYTES = 64 << 20


def open_folder(uri: str) -> tuple[pafs.FileSystem, str, bool]:
    """File system and path of a folder, and whether it can be mapped."""
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    if "://" in uri:
        return (*pafs.FileSystem.from_uri(uri), False)
    return pafs.LocalFileSystem(), uri, True


@dataclass
class Rows:
    """Rows of φ and β that are held in memory, as one block."""

    phi: np.ndarray
    bg: np.ndarray

    @property
    def edges(self) -> np.ndarray:
        return np.array([0, len(self.phi)])

    def load(self, block: int) -> tuple[np.ndarray, np.ndarray]:
        return self.phi, self.bg


@dataclass
class PhiFiles:
    uri: str
    size: int                     # words
    k: int
    robust: bool
    block: int                    # words of a block
    present: list                 # blocks with a row; all others are 0
    _held: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_held": {}}

    @property
    def edges(self) -> np.ndarray:
        return np.r_[np.arange(0, max(self.size, 1), self.block), max(self.size, 1)]

    @property
    def blocks(self) -> int:
        return len(self.edges) - 1

    def load(self, block: int) -> tuple[np.ndarray, np.ndarray]:
        """(φ rows, β) of a block."""
        if block in self._held:
            return self._held[block]
        low, high = self.edges[block:block + 2].tolist()
        width = self.k + self.robust
        if block not in self.present:
            m = np.zeros((high - low, width))
        else:
            fs, base, local = open_folder(self.uri)
            if local:
                m = np.memmap(f"{base}/{block}", np.float64, "r", shape=(high - low, width)).view(np.ndarray)
            else:
                self._held.clear()             # one block at a time
                with fs.open_input_file(f"{base}/{block}") as f:
                    m = np.frombuffer(f.readall(), np.float64).reshape(high - low, width)
        self._held[block] = m[:, :self.k], (m[:, self.k] if self.robust else np.zeros(high - low))
        return self._held[block]

    def rows(self, words: np.ndarray) -> Rows:
        """The rows of sorted word ids."""
        phi, bg, edges = np.empty((len(words), self.k)), np.empty(len(words)), self.edges
        cut = np.searchsorted(words, edges)
        for b in np.flatnonzero(np.diff(cut)).tolist():
            m, g = self.load(b)
            at = words[cut[b]:cut[b + 1]] - edges[b]
            phi[cut[b]:cut[b + 1]], bg[cut[b]:cut[b + 1]] = m[at], g[at]
        return Rows(phi, bg)

    def frame(self, spark: SparkSession) -> DataFrame:
        """``(word_id, phi[, bg])`` of all words, a task a block."""
        def run(batches):
            edges = self.edges
            for batch in batches:
                for b in batch.column(0).to_pylist():
                    m, g = self.load(b)
                    for a in range(0, len(m), 5000):
                        part = np.ascontiguousarray(m[a:a + 5000])
                        ends = pa.array(np.arange(len(part) + 1, dtype=np.int32) * self.k)
                        cols = [pa.array((np.arange(a, a + len(part)) + edges[b]).astype(np.int32)), pa.ListArray.from_arrays(ends, pa.array(part.ravel())), pa.array(np.array(g[a:a + 5000]))]
                        yield pa.RecordBatch.from_arrays(cols[:3 if self.robust else 2], ["word_id", "phi", "bg"][:3 if self.robust else 2])
        if not self.size:
            return spark.createDataFrame([], "word_id int, phi array<double>" + (", bg double" if self.robust else ""))
        out = spark.range(0, self.blocks, 1, self.blocks).mapInArrow(run, "word_id int, phi array<double>" + (", bg double" if self.robust else ""))
        out._tt_path = self.uri
        return out


def words_of_block(spark: SparkSession, k: int) -> int:
    return max(1, min(broadcast_limit(spark), BLOCK_BYTES) // (8 * (k + 2)))


def write_phi(rows: DataFrame, size: int, k: int, robust: bool = False, over: np.ndarray | None = None, partial: bool = False) -> PhiFiles:
    """Write ``(word_id, vec)`` as block files; ``vec`` is K wide, with β behind
    for the robust model.  ``over``: totals to divide by (0 gives 0, D7).  Of
    ``partial`` rows a word may have several, which are added up."""
    spark = rows.sparkSession
    uri, block, width = scratch_path(spark, "phi-files"), words_of_block(spark, k), k + robust
    by = np.ones(width) if over is None else np.where(over > 0, 1.0 / np.where(over > 0, over, 1.0), 0.0)
    whole = over is not None
    n_blocks = -(-max(size, 1) // block)

    def run(batches):
        fs, base, _ = open_folder(uri)
        now, m = None, None

        def done():
            fs.create_dir(base, recursive=True)
            name = f"{base}/.{now}-{uuid.uuid4().hex}"
            with fs.open_output_stream(name) as f:
                f.write(m.tobytes())
            fs.move(name, f"{base}/{now}")
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32())], ["block"])
        for b in batches:
            ids, vec = b.column(0).to_numpy(), b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            if partial and len(ids):
                starts = np.flatnonzero(np.r_[True, np.diff(ids) != 0])
                ids, vec = ids[starts], np.add.reduceat(vec, starts, axis=0)
            cuts = np.r_[0, np.flatnonzero(np.diff(ids // block)) + 1, len(ids)]
            for x, y in zip(cuts[:-1], cuts[1:]):
                if x == y:
                    continue
                mine = int(ids[x]) // block
                if mine != now:
                    if now is not None:
                        yield done()
                    now, m = mine, np.zeros((min(block, size - mine * block), width))
                part = np.where(by > 0, vec[x:y] / np.where(by > 0, over, 1.0), 0.0) if whole else vec[x:y]
                if partial:
                    m[ids[x:y] - now * block] += part
                else:
                    m[ids[x:y] - now * block] = part
        if now is not None:
            yield done()

    dealt = rows.select("word_id", "vec", F.floor(F.col("word_id") / block).cast("int").alias("block")).repartition(n_blocks, "block")
    present = dealt.sortWithinPartitions("word_id").select("word_id", "vec").mapInArrow(run, "block int").collect()
    return PhiFiles(uri, size, k, robust, block, sorted(r["block"] for r in present))
