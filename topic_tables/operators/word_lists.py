"""Word sums from the pairs by word.

A pass over document rows writes a row of K sums a word and task.  With many
words, topics and tasks these rows take far more room than the pairs.  There the
pairs are written once more, dealt by ranges of word ids, as runs of (word,
document, n), and a task adds up the words of its range: φ of the range is part
of one block file, and θ is read from array files, one a bucket of documents,
in the order of the documents.  So an iteration writes about one row of K sums
a word, and θ once.  A range with more pairs than a task should have is dealt
to several tasks, whose rows are added up.

  places     (row_id, part, bucket, pos)      the number of a document
  lists      (range, slice, words, docs, ns)  runs of pairs, packed
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topic_tables.operators.arrays import _lists, _packed, _rows, _unpacked, _walks
from topic_tables.operators.phi_files import PhiFiles, open_folder
from topic_tables.operators.vocab import Vocabulary
from topic_tables.session import cut_lineage, drop_shuffles, release, scratch_path, write_bucketed

#: Bytes of word rows of a pass from which on word lists are thought of.
LEAST_BYTES = 64 << 20
#: What a pair takes in the lists, about.
PAIR_BYTES = 8
#: Pairs that a range of words should have, and most words of it.
PAIRS_A_RANGE = 8_000_000
MOST_WORDS = 1 << 16
#: Pairs of a row of the lists, of a run of a task, and of one matrix step.
PAIRS_A_ROW = 1024
PAIRS_A_RUN = 1 << 20
PAIRS_AT_ONCE = 20_000
#: Bytes of word sums that a task holds before it hands them on.
HELD_BYTES = 128 << 20


@dataclass
class ThetaFiles:
    """θ as array files, one a bucket of documents; without ``uri`` θ is 1/K."""

    uri: str | None
    edges: np.ndarray              # number of the first document of each bucket, and the end
    k: int
    frame: DataFrame | None = None
    _held: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "frame": None, "_held": {}}

    @property
    def mapped(self) -> bool:
        return self.uri is None or open_folder(self.uri)[2]

    def load(self, bucket: int) -> np.ndarray:
        if bucket not in self._held:
            shape = int(self.edges[bucket + 1] - self.edges[bucket]), self.k
            fs, base, local = open_folder(self.uri) if self.uri else (None, None, True)
            if self.uri is None:
                m = np.broadcast_to(np.full(self.k, 1.0 / self.k), shape)
            elif local:
                m = np.memmap(f"{base}/{bucket}", np.float64, "r", shape=shape).view(np.ndarray)
            else:
                self._held.clear()             # one bucket at a time
                with fs.open_input_file(f"{base}/{bucket}") as f:
                    m = np.frombuffer(f.readall(), np.float64).reshape(shape)
            self._held[bucket] = m
        return self._held[bucket]


def _add_words(held: np.ndarray, phi: np.ndarray, theta: ThetaFiles, words: np.ndarray, docs: np.ndarray, n: np.ndarray) -> None:
    """Add Σ_d r θ_dt of some pairs to their words' sums.  Where all files can
    be mapped, a word's θ rows are a matrix, with which its mixtures and its
    sums are products; else one file is held after the other."""
    bucket = np.searchsorted(theta.edges, docs, "right") - 1
    order = np.argsort(words, kind="stable") if theta.mapped else np.lexsort((words, bucket))
    words, docs, n, bucket = words[order], docs[order], n[order], bucket[order]
    breaks = [] if theta.mapped else np.flatnonzero(np.diff(bucket)) + 1
    cut = np.unique(np.r_[np.arange(0, len(words), PAIRS_AT_ONCE), breaks].astype(np.int64)).tolist()
    for a, end in zip(cut, [*cut[1:], len(words)]):
        w, d, of, count = words[a:end], docs[a:end], bucket[a:end], n[a:end]
        t = np.empty((len(w), theta.k))
        for i in np.unique(of).tolist():
            at = np.flatnonzero(of == i)
            t[at] = theta.load(i)[d[at] - theta.edges[i]]
        starts = np.flatnonzero(np.r_[True, np.diff(w) != 0])
        runs = [(int(i), slice(x, y)) for i, x, y in zip(w[starts], starts.tolist(), [*starts[1:].tolist(), len(w)])]
        z = np.empty(len(w))
        for i, x in runs:
            np.dot(t[x], phi[i], out=z[x])
        r = np.where(z > 0, count / np.where(z > 0, z, 1.0), 0.0)
        for i, x in runs:
            held[i] += np.dot(r[x], t[x])


@dataclass
class WordLists:
    table: DataFrame
    places: DataFrame
    edges: np.ndarray              # first document of each bucket, and the end
    ranges: np.ndarray             # first word of each range, and the end

    def release(self) -> None:
        release(self.table)
        release(self.places)

    def theta_files(self, theta: DataFrame | None, k: int) -> ThetaFiles:
        """``(row_id, part, theta)`` as files; a null θ has no mixture and is 0."""
        if theta is None:
            return ThetaFiles(None, self.edges, k)
        uri, edges = scratch_path(self.table.sparkSession, "theta-files"), self.edges

        def run(batches):
            fs, base, _ = open_folder(uri)
            fs.create_dir(base, recursive=True)
            held = {}
            for b in batches:
                buckets, pos = b.column(0).to_numpy(), b.column(1).to_numpy()
                ok = b.column(2).is_valid()
                t = np.zeros((b.num_rows, k))
                if b.num_rows > b.column(2).null_count:
                    t[ok.to_numpy(zero_copy_only=False)] = _rows(b.column(2).filter(ok), k)
                for bucket in np.unique(buckets).tolist():
                    m = held.setdefault(bucket, [np.zeros((int(edges[bucket + 1] - edges[bucket]), k)), 0])
                    here = buckets == bucket
                    m[0][pos[here]] = t[here]
                    m[1] += int(here.sum())
            for bucket, (m, count) in held.items():
                if count != len(m):
                    raise ValueError(f"{count} of {len(m)} documents of bucket {bucket} in one task")
                name = f"{base}/.{bucket}-{uuid.uuid4().hex}"
                with fs.open_output_stream(name) as f:
                    f.write(memoryview(m).cast("B"))
                fs.move(name, f"{base}/{bucket}")
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32())], ["bucket"])

        placed = theta.select("row_id", "part", "theta").join(self.places.hint("shuffle_hash"), ["row_id", "part"]).select("bucket", "pos", "theta")
        placed.mapInArrow(run, "bucket int").collect()          # a row a bucket
        frame = self.table.limit(0)
        frame._tt_path = uri
        return ThetaFiles(uri, edges, k, frame)

    def sums(self, theta: ThetaFiles, files: PhiFiles) -> DataFrame:
        """(word_id, vec): K sums φ_tw Σ_d r θ_dt and a 0; a word of a range
        that was dealt to several tasks has several rows."""
        k, ranges, kind = files.k, self.ranges, _number(self.edges)

        def run(batches):
            waiting, held = {}, {}

            def phi(i):
                block = int(ranges[i]) // files.block
                return files.load(block)[0][int(ranges[i]) - block * files.block:int(ranges[i + 1]) - block * files.block]

            def add(i):
                if i not in held:
                    held[i] = np.zeros((int(ranges[i + 1] - ranges[i]), k))
                _add_words(held[i], phi(i), theta, *(np.concatenate(x) for x in zip(*waiting.pop(i))))

            def hand_on():
                while held:
                    i, m = held.popitem()
                    used = np.flatnonzero(m.any(axis=1))
                    for a in range(0, len(used), 5000):
                        at = used[a:a + 5000]
                        yield pa.RecordBatch.from_arrays([pa.array((at + ranges[i]).astype(np.int32)), _lists(np.c_[m[at] * phi(i)[at], np.zeros(len(at))])], ["word_id", "vec"])
            count = 0
            for b in batches:
                if not b.num_rows:
                    continue
                of = b.column(0).to_numpy()
                cuts = np.r_[0, np.flatnonzero(np.diff(of)) + 1, len(of)]
                for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                    rows = b.slice(x, y - x)
                    words = _unpacked(rows.column(1), np.uint16).astype(np.int64)
                    waiting.setdefault(int(of[x]), []).append((words, _unpacked(rows.column(2), kind).astype(np.int64), _unpacked(rows.column(3))))
                    count += len(words)
                    if count >= PAIRS_A_RUN:
                        for i in list(waiting):
                            add(i)
                        count = 0
                        if sum(m.nbytes for m in held.values()) > HELD_BYTES:
                            yield from hand_on()
            for i in list(waiting):
                add(i)
                if sum(m.nbytes for m in held.values()) > HELD_BYTES:
                    yield from hand_on()
            yield from hand_on()

        return self.table.select("range", "words", "docs", "ns").mapInArrow(run, "word_id int, vec array<double>")


def _number(edges: np.ndarray):
    return np.int32 if edges[-1] < 2 ** 31 else np.int64


def list_words(rows: DataFrame, vocab: Vocabulary, files: PhiFiles, buckets: int) -> WordLists | None:
    """The pairs of document rows by word, or None where a pass's word rows
    would not take twice their room."""
    spark, row = rows.sparkSession, 8 * (files.k + 1)
    if buckets * files.size * row <= LEAST_BYTES:
        return None
    pairs = rows.where("row_id is not null").agg(F.sum(F.size("words"))).first()[0] or 0
    if min(buckets * files.size, pairs) * row <= 2 * (PAIR_BYTES * pairs + files.size * row):
        return None
    place = Window.partitionBy("bucket").orderBy("row_id", "part")
    numbered = (rows.where("row_id is not null").select("row_id", "part", F.pmod(F.hash("row_id", "part"), F.lit(buckets)).alias("bucket"))
                .withColumn("pos", F.row_number().over(place) - 1))
    places = write_bucketed(numbered, ["row_id", "part"], buckets, "places")
    sizes = np.zeros(buckets, np.int64)
    for r in places.groupBy("bucket").count().collect():          # a row a bucket
        sizes[r["bucket"]] = r["count"]
    edges = np.r_[0, np.cumsum(sizes)]

    # ranges of words, each in one block
    wanted = max(-(-pairs // PAIRS_A_RANGE), 2 * spark.sparkContext.defaultParallelism)
    width = max(1, min(MOST_WORDS, files.block, -(-files.size // wanted)))
    a_block = -(-files.block // width)
    ranges = np.array([w for low in files.edges[:-1].tolist() for w in range(low, min(low + files.block, files.size), width)] + [files.size])
    of = F.floor(F.col("word_id") / files.block) * a_block + F.floor(F.col("word_id") % files.block / width)
    share = pairs / max(vocab.occurrences, 1)
    slices = np.ones(len(ranges) - 1, np.int64)
    for r in vocab.table.groupBy(of.cast("int").alias("range")).agg(F.sum("n").alias("n")).collect():      # a row a range
        slices[r["range"]] = max(1, -(-int(r["n"] * share) // (2 * PAIRS_A_RANGE)))
    kind = _number(edges)

    def deal(batches):
        for turn, b in enumerate(_walks(batches)):
            counts = b.column(2).value_lengths().to_numpy(zero_copy_only=False)
            buckets, pos = b.column(4).to_numpy(), b.column(5).to_numpy()
            w = b.column(2).flatten().to_numpy()
            order = np.argsort(w, kind="stable")
            docs = np.repeat((edges[buckets] + pos).astype(kind), counts)[order]
            w, n = w[order], b.column(3).flatten().to_numpy(zero_copy_only=False)[order]
            cut = np.searchsorted(w, ranges)
            own = np.flatnonzero(np.diff(cut))
            starts = np.concatenate([np.arange(cut[i], cut[i + 1], PAIRS_A_ROW) for i in own]) if len(own) else np.zeros(0, np.int64)
            size = np.diff(np.r_[starts, len(w)])
            i = np.searchsorted(cut, starts, "right") - 1
            small = (w - np.repeat(ranges[i], size)).astype(np.uint16)
            part = (int(buckets[0]) * 7919 + turn) % slices[i] if len(i) else i
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(part.astype(np.int32)), _packed(small, size, np.uint16), _packed(docs, size, kind), _packed(n, size)],
                                             ["range", "slice", "words", "docs", "ns"])

    placed = rows.join(places.hint("shuffle_hash"), ["row_id", "part"]).select("row_id", "part", "words", "ns", "bucket", "pos")
    dealt = placed.mapInArrow(deal, "range int, slice int, words binary, docs binary, ns binary")
    table = cut_lineage(dealt.repartition(int(slices.sum()), "range", "slice"), "wordlists")
    drop_shuffles(spark)
    return WordLists(table, places, edges, ranges)
