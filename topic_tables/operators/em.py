"""Expectation–maximisation for PLSA and Robust PLSA on tables.

State between iterations lives in files and tables, never in driver matrices:

  document rows  (row_id, part, words, ns)         one list a document and part,
                 bucketed by (row_id, part)        (part > 0 only for huge documents)
  theta          (row_id, part, theta[K], nu_sum[, us])  bucketed in the same way
                 (us: unnormalised noise of the row's words, as packed doubles;
                 a robust fit's last pass writes the words beside it, packed)
  phi            array files by word block (phi_files.py), with β behind

One iteration is one pass over the document rows joined with θ (co-located, so
neither the pairs nor θ move).  A task takes its pairs in the order of their
words and walks the block files that hold them.  It computes from the
*previous* state only, in numpy over Arrow batches whose width is K:

  z = Σ_t φ_tw θ_dt   [robust: (z + γβ_w + εν_dw) / (1 + γ + ε)],  r = n / z
  S_dt = θ_dt Σ_w r φ_tw     one row a document and part: θ' ∝ S
  C_tw = φ_tw Σ_d r θ_dt     one row a word and task: φ' ∝ C after a merge
  ν'_dw ∝ ε ν_dw r           (robust) written beside the document's sums

and writes both kinds of rows, and its topic totals, as one bucketed table.
Only word rows (and the partial sums of huge documents) are shuffled: they are
added up a word and written as the next block files.  Where they would take
more room than the pairs, the pairs are kept a second time, by word, and the
word sums are made there from files of θ (word_lists.py).  The cost of a plan
does not depend on K: there is no column per topic.

The driver sees one vector of K topic totals per task, the numbers of the
blocks, and one log-likelihood number per iteration.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from topic_tables.functions.vectors import hash_uniform
from topic_tables.operators.arrays import PAIRS_A_WALK, _lists, _packed, _rows, _unpacked, _walks
from topic_tables.operators.phi_files import PhiFiles, write_phi
from topic_tables.operators.priors import Prior, is_active
from topic_tables.operators.run_record import Run
from topic_tables.operators.vocab import Vocabulary, buckets_of, rows_of
from topic_tables.operators.word_lists import WordLists, list_words
from topic_tables.session import cut_lineage, drop_shuffles, release, write_bucketed

#: Pairs whose K-wide products a task holds at once.
PAIRS_AT_ONCE = 20_000
#: Pairs whose φ rows are held for products a document.
PAIRS_A_PRODUCT = 8192
#: Topics up to which a walk in one block holds a share of each for all its pairs.
NARROW = 8
#: Bytes of word sums that a task holds before it hands them on.
HELD_BYTES = 256 << 20
#: ``word_id`` of the row that holds a task's topic totals.
TOTALS = -1

PASS_SCHEMA = "row_id bigint, part int, word_id int, vec array<double>, words binary, us binary"
PAIR_COLUMNS = {"row_id": "bigint", "part": "int", "word_id": "int", "n": "double", "z": "double", "r": "double", "c": "array<double>", "nu": "double"}


@dataclass
class TopicModel:
    k: int
    vocab: Vocabulary
    phi: DataFrame                      # word_id, phi array<double>
    theta: DataFrame                    # row_id, theta array<double> (null: no known word)
    history: list = field(default_factory=list)   # (iteration, loglik, skipped)
    background: DataFrame | None = None  # word_id, p
    noise: DataFrame | None = None       # row_id, word_id, p
    gamma: float = 0.0
    eps: float = 0.0
    theta_prior: Prior | None = None
    phi_prior: Prior | None = None
    #: φ (and β) as the fit left them
    files: PhiFiles | None = None
    #: (row_id, part, theta), bucketed like the bags, of documents with a known word
    theta_rows: DataFrame | None = None
    #: intermediate tables this model's DataFrames read; :meth:`release` drops them
    scratch: list = field(default_factory=list)

    @property
    def robust(self) -> bool:
        return self.background is not None

    def release(self) -> None:
        """Delete the tables behind this model (not its bags or vocabulary)."""
        for table in self.scratch:
            release(table)
        self.scratch = []


def with_all_documents(theta: DataFrame, docs: DataFrame | None) -> DataFrame:
    """Documents without a known word keep a row, with θ null."""
    if docs is None:
        return theta
    return docs.select("row_id").distinct().join(theta, "row_id", "left")


# ------------------------------------------------------------------ vector sums
def sum_vectors(df: DataFrame, keys: list[str], width: int) -> DataFrame:
    """``(keys..., vec)`` summed over rows of equal keys: one shuffle and sort,
    then runs are added up in numpy (a run's sum is all that is carried on)."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*keys).schema) + ", vec array<double>"

    def run(batches):
        held_key, held = None, None
        for b in batches:
            if not b.num_rows:
                continue
            cols = [c.to_numpy(zero_copy_only=False) for c in b.columns[:-1]]
            m = _rows(b.column(len(keys)), width)
            new = np.zeros(len(m), bool)
            new[0] = True
            for c in cols:
                new[1:] |= c[1:] != c[:-1]
            at = np.flatnonzero(new)
            sums = np.add.reduceat(m, at, axis=0)
            got = [c[at] for c in cols]
            first = tuple(c[0] for c in got)
            if held_key == first:
                sums[0] += held
            elif held_key is not None:
                got = [np.r_[np.array([h], c.dtype), c] for h, c in zip(held_key, got)]
                sums = np.vstack([held, sums])
            held_key, held = tuple(c[-1] for c in got), sums[-1]
            if len(sums) > 1:
                yield pa.RecordBatch.from_arrays([*(pa.array(c[:-1]) for c in got), _lists(sums[:-1])], [*keys, "vec"])
        if held_key is not None:
            yield pa.RecordBatch.from_arrays([*(pa.array([h]) for h in held_key), _lists(held[None, :])], [*keys, "vec"])

    return df.select(*keys, "vec").repartition(*keys).sortWithinPartitions(*keys).select(*keys, "vec").mapInArrow(run, schema)


def column_totals(df: DataFrame, width: int) -> np.ndarray:
    """Sum of the ``vec`` column: one partial vector per task reaches the driver."""
    def run(batches):
        total = np.zeros(width)
        for b in batches:
            if b.num_rows:
                total += _rows(b.column(0), width).sum(axis=0)
        yield pa.RecordBatch.from_arrays([_lists(total[None, :])], ["vec"])
    parts = df.select("vec").mapInArrow(run, "vec array<double>").collect()
    return np.sum([r["vec"] for r in parts], axis=0) if parts else np.zeros(width)


# --------------------------------------------------------------- φ and documents
def initial_phi(vocab: Vocabulary, k: int, seed: int = 13) -> DataFrame:
    """u(seed, t, token) per cell, rows of each topic normalised to 1."""
    topics = F.sequence(F.lit(0), F.lit(k - 1))
    u = cut_lineage(vocab.table.select("word_id", F.transform(topics, lambda t: hash_uniform(seed, t, F.col("token"))).alias("vec")), "phi0")
    out = _over(u, column_totals(u, k)).select("word_id", F.col("vec").alias("phi"))
    out._tt_source, out._tt_seed = u, seed
    return out


def _over(counts: DataFrame, totals: np.ndarray) -> DataFrame:
    """Each topic's counts over its total; a topic without mass stays 0."""
    by = F.lit([float(1.0 if t > 0 else 0.0) for t in totals]), F.lit([float(t if t > 0 else 1.0) for t in totals])
    return counts.withColumn("vec", F.zip_with(F.zip_with("vec", by[1], lambda c, t: c / t), by[0], lambda c, on: c * on))


def document_rows(bags: DataFrame, own: bool = False) -> DataFrame:
    """The bags as lists.  Lists are bounded: huge documents come in parts.
    The rows that the bags are kept as are read where they are, and written
    again only for a table of one's ``own``; of other pairs they are collected,
    which their bucketing makes a local step."""
    rows = rows_of(bags)
    if rows is None:
        lists = bags.groupBy("row_id", "part").agg(F.array_sort(F.collect_list(F.struct("word_id", "n"))).alias("ws"))
        rows, own = lists.select("row_id", "part", F.col("ws.word_id").alias("words"), F.col("ws.n").alias("ns")), True
    else:
        own = own or not bags._tt_stored
    rows = rows.select("row_id", "part", "words", "ns")        # not the bags' own table, which is theirs to drop
    return write_bucketed(rows, ["row_id", "part"], buckets_of(bags), "docrows", prepartitioned=True) if own else rows


def hot_documents(bags: DataFrame) -> DataFrame | None:
    """(row_id, np) of documents split over several parts, or None."""
    if not getattr(bags, "_tt_split", True):
        return None
    rows = rows_of(bags)
    hot = cut_lineage((bags if rows is None else rows).where(F.col("part") > 0).groupBy("row_id").agg((F.max("part") + 1).alias("np")), "hotdocs")
    if hot.isEmpty():
        release(hot)
        return None
    return hot


# ----------------------------------------------------------------------- kernel
@dataclass
class _Step:
    """One EM configuration; methods run inside tasks."""

    k: int
    robust: bool = False
    gamma: float = 0.0
    eps: float = 0.0

    @property
    def width(self) -> int:
        return self.k + 3            # topics, log-likelihood, skipped pairs, noise normaliser

    def flat(self, b: pa.RecordBatch):
        """Pairs of a batch of document rows, as flat arrays."""
        words = b.column(2)
        sizes = words.value_lengths().to_numpy(zero_copy_only=False)
        theta = b.column(4)
        t = np.full((b.num_rows, self.k), np.nan)      # a null θ has no mixture
        ok = theta.is_valid().to_numpy(zero_copy_only=False)
        if ok.any():
            t[ok] = _rows(theta.filter(theta.is_valid()), self.k)
        doc = np.repeat(np.arange(b.num_rows), sizes)
        w = words.flatten().to_numpy()
        n = b.column(3).flatten().to_numpy(zero_copy_only=False)
        nu = np.zeros(len(w))
        if self.robust:
            us = np.ones(len(w)) if b.column(5).null_count else _unpacked(b.column(5))       # state 0 has none
            nu = self.noise(us, b.column(6).to_numpy(zero_copy_only=False).astype(float)[doc])
        return sizes, t, doc, w, n, nu

    @staticmethod
    def noise(us: np.ndarray, total: np.ndarray) -> np.ndarray:
        return np.where(total > 0, us / np.where(total > 0, total, 1.0), 0.0)

    def mixture(self, f, t, bg, nu):
        z = np.einsum("ij,ij->i", f, t)
        return (z + self.gamma * bg + self.eps * nu) / (1.0 + self.gamma + self.eps) if self.robust else z

    def walk(self, source, t, doc, w, n, nu, want_words: bool):
        """(document sums, new noise, words, word sums) of flat pairs.  The
        pairs are taken in the order of their words, block by block; where φ is
        one block and the sums of its words are few, as they stand.  For the
        documents' sums of many topics alone they stay in the documents' order."""
        if not want_words and self.k > NARROW:
            return self.walk_documents(source, t, doc, w, n, nu)
        if len(source.edges) == 2 and (not want_words or (self.k <= NARROW and source.edges[1] <= 2 * len(w))):
            return self.walk_in_place(source, t, doc, w, n, nu, want_words)
        sums, fresh = np.zeros((len(t), self.width)), np.zeros(len(w))
        order = np.argsort(w, kind="stable")
        edges = source.edges
        cut = np.searchsorted(w[order], edges)
        words, counts = [], []
        for block in np.flatnonzero(np.diff(cut)).tolist():
            phi, back = source.load(block)
            for a in range(cut[block], cut[block + 1], PAIRS_AT_ONCE):
                at = order[a:min(a + PAIRS_AT_ONCE, cut[block + 1])]
                here, d, count = w[at] - edges[block], doc[at], n[at]
                f, td, bg = phi[here], t[d], back[here]
                z = self.mixture(f, td, bg, nu[at])
                good = z > 0
                r = np.where(good, count / np.where(good, z, 1.0), 0.0)
                td = np.where(good[:, None], td, 0.0)
                fresh[at] = self.eps * nu[at] * r
                by_doc = np.argsort(d, kind="stable")
                starts = np.flatnonzero(np.r_[True, np.diff(d[by_doc]) != 0])
                of = d[by_doc][starts]
                rows = np.empty((len(at), self.width))
                rows[:, :self.k] = r[:, None] * f * td
                rows[:, self.k] = np.where(good, count * np.log(np.where(good, z, 1.0)), 0.0)
                rows[:, self.k + 1] = ~good
                rows[:, self.k + 2] = fresh[at]
                sums[of] += np.add.reduceat(rows[by_doc], starts, axis=0)
                if want_words:
                    starts = np.flatnonzero(np.r_[True, np.diff(here) != 0])
                    first = here[starts]
                    c = np.add.reduceat(np.c_[r[:, None] * td, r], starts, axis=0)
                    words.append(first + edges[block])
                    counts.append(np.c_[c[:, :self.k] * phi[first], c[:, self.k] * self.gamma * back[first]])
        if not words:
            return sums, fresh, np.zeros(0, np.int64), np.zeros((0, self.k + 1))
        words, counts = np.concatenate(words), np.concatenate(counts)
        starts = np.flatnonzero(np.r_[True, np.diff(words) != 0])
        return sums, fresh, words[starts], np.add.reduceat(counts, starts, axis=0)


    def walk_documents(self, source, t, doc, w, n, nu):
        """:meth:`walk` without word sums: the φ rows of a document's words are
        a matrix, with which its mixtures and its sums are products."""
        if len(source.edges) > 2:
            own, w = np.unique(w, return_inverse=True)
            source = source.rows(own)
        phi, back = source.load(0)
        lost = np.isnan(t).any(axis=1)
        t = np.where(lost[:, None], 0.0, t)
        sums, fresh = np.zeros((len(t), self.width)), np.zeros(len(w))
        ends = np.r_[0, np.cumsum(np.bincount(doc, minlength=len(t)))]
        for a in range(0, len(w), PAIRS_A_PRODUCT):
            s = slice(a, min(a + PAIRS_A_PRODUCT, len(w)))
            low, high = int(doc[a]), int(doc[s.stop - 1]) + 1
            f, z, of = phi[w[s]], np.zeros(s.stop - a), doc[s] - low
            cuts = (np.clip(ends[low:high + 1], a, s.stop) - a).tolist()
            runs = [(low + i, slice(x, y)) for i, (x, y) in enumerate(zip(cuts[:-1], cuts[1:])) if y > x]
            for i, x in runs:
                np.dot(f[x], t[i], out=z[x])
            if self.robust:
                z = np.where(lost[doc[s]], 0.0, (z + self.gamma * back[w[s]] + self.eps * nu[s]) / (1.0 + self.gamma + self.eps))
            good = z > 0
            safe = np.where(good, z, 1.0)
            r = np.where(good, n[s] / safe, 0.0)
            fresh[s] = self.eps * nu[s] * r
            for i, x in runs:
                sums[i, :self.k] += np.dot(r[x], f[x])
            for at, column in ((self.k, np.where(good, n[s] * np.log(safe), 0.0)), (self.k + 1, ~good), (self.k + 2, fresh[s])):
                sums[low:high, at] += np.bincount(of, column, high - low)
        sums[:, :self.k] *= t
        return sums, fresh, np.zeros(0, np.int64), np.zeros((0, self.k + 1))

    def walk_in_place(self, source, t, doc, w, n, nu, want_words: bool):
        """:meth:`walk` in one block, in the order of the documents."""
        phi, back = source.load(0)
        sums, r = np.zeros((len(t), self.width)), np.zeros(len(w))
        shares = np.empty((self.k, len(w) if want_words else 0))
        for a in range(0, len(w), PAIRS_AT_ONCE):
            s = slice(a, a + PAIRS_AT_ONCE)
            d, f, td = doc[s], phi[w[s]], t[doc[s]]
            z = self.mixture(f, td, back[w[s]] if self.robust else 0.0, nu[s])
            good = z > 0
            safe = np.where(good, z, 1.0)
            r[s] = np.where(good, n[s] / safe, 0.0)
            if not good.all():
                td = np.where(good[:, None], td, 0.0)
            td = r[s, None] * td
            rows = np.empty((len(d), self.width))
            rows[:, :self.k] = f * td
            rows[:, self.k] = np.where(good, n[s] * np.log(safe), 0.0)
            rows[:, self.k + 1] = ~good
            rows[:, self.k + 2] = self.eps * nu[s] * r[s]
            starts = np.flatnonzero(np.r_[True, np.diff(d) != 0])
            sums[d[starts]] += np.add.reduceat(rows, starts, axis=0)
            if want_words:
                shares[:, s] = td.T
        fresh = self.eps * nu * r
        if not want_words:
            return sums, fresh, np.zeros(0, np.int64), np.zeros((0, self.k + 1))
        words = np.flatnonzero(np.bincount(w, minlength=len(phi)))
        counts = np.stack([np.bincount(w, c, len(phi))[words] for c in (*shares, r)], axis=1)
        counts[:, :self.k] *= phi[words]
        counts[:, self.k] *= self.gamma * back[words]
        return sums, fresh, words, counts


def _joined(rows: DataFrame, theta: DataFrame, robust: bool) -> DataFrame:
    """Document rows beside their θ; both are bucketed by (row_id, part)."""
    cols = ["row_id", "part", "words", "ns", "theta", *(["us", "nu_sum"] if robust else [])]
    return rows.join(theta.hint("shuffle_hash"), ["row_id", "part"]).select(*cols)


def em_pass(step: _Step, rows: DataFrame, theta: DataFrame, files: PhiFiles, want_words: bool, keep_lists: bool = False, want_totals: bool = False) -> DataFrame:
    """Document rows, word rows and topic totals (see the module's head), the
    totals also without word rows if they are asked for; with
    ``keep_lists`` the document rows carry their words beside their noise.  A
    word row carries the key of a document of its task, so that a task's rows
    stay in one bucket.  A task holds its word sums over all its walks, as an
    array of all words where ``HELD_BYTES`` allow, else as sorted runs that are
    merged, and handed on before the end only where they outgrow that."""
    width = step.k + 1
    most = max(1, HELD_BYTES // (8 * width))     # word rows

    def word_rows(last, words, counts):
        for i in range(0, len(words), 5000):
            at, vec = words[i:i + 5000], counts[i:i + 5000]
            yield pa.RecordBatch.from_arrays([pa.array([last[0]] * len(at), pa.int64()), pa.array([last[1]] * len(at), pa.int32()),
                                              pa.array(at.astype(np.int32)), _lists(vec), pa.nulls(len(at), pa.binary()), pa.nulls(len(at), pa.binary())],
                                             ["row_id", "part", "word_id", "vec", "words", "us"])

    def merged(runs):
        words, counts = (np.concatenate(x) for x in zip(*runs))
        order = np.argsort(words, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(words[order]) != 0])
        return words[order][starts], np.add.reduceat(counts[order], starts, axis=0)

    def run(batches):
        held = np.zeros((files.size, width)) if want_words and (files.blocks == 1 or files.size <= most) else None
        used = np.zeros(files.size if held is not None else 0, bool)
        totals, last, runs = np.zeros(width), None, []
        for b in _walks(batches):
            sizes, *flat = step.flat(b)
            sums, fresh, words, counts = step.walk(files, *flat, want_words)
            last = b.column(0)[-1].as_py(), b.column(1)[-1].as_py()
            kept = [_packed(flat[2], sizes, np.int32) if keep_lists else pa.nulls(b.num_rows, pa.binary()),
                    _packed(fresh, sizes) if step.robust else pa.nulls(b.num_rows, pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.nulls(b.num_rows, pa.int32()), _lists(sums), *kept],
                                             ["row_id", "part", "word_id", "vec", "words", "us"])
            if want_totals:
                totals[:step.k] += sums[:, :step.k].sum(axis=0)
            else:
                totals += counts.sum(axis=0)
            if held is not None:
                held[words] += counts
                used[words] = True
            elif len(words):
                runs.append((words, counts))
                if sum(len(w) for w, _ in runs) > most:
                    runs = [merged(runs)]
                    if 2 * len(runs[0][0]) > most:
                        yield from word_rows(last, *runs.pop())
        if want_words and last is not None:
            if held is not None:
                yield from word_rows(last, np.flatnonzero(used), held[used])
            elif runs:
                yield from word_rows(last, *merged(runs))
        if (want_words or want_totals) and last is not None:
            yield from word_rows(last, np.array([TOTALS]), totals[None, :])

    return _joined(rows, theta, step.robust).mapInArrow(run, PASS_SCHEMA)


def pair_view(step: _Step, rows: DataFrame, theta: DataFrame, files: PhiFiles, columns: tuple = tuple(PAIR_COLUMNS)) -> DataFrame:
    """Every pair of a state: (row_id, part, word_id, n, z, r, c[K], nu), or
    those ``columns`` of it."""
    def run(batches):
        for b in _walks(batches, PAIRS_AT_ONCE):
            _, t, doc, w, n, nu = step.flat(b)
            words, place = np.unique(w, return_inverse=True)
            source = files.rows(words)
            for a in range(0, len(w), PAIRS_AT_ONCE):
                s = slice(a, a + PAIRS_AT_ONCE)
                f, td = source.phi[place[s]], t[doc[s]]
                z = step.mixture(f, td, source.bg[place[s]], nu[s])
                good = z > 0
                r = np.where(good, n[s] / np.where(good, z, 1.0), 0.0)
                make = {"row_id": lambda: b.column(0).take(pa.array(doc[s])), "part": lambda: b.column(1).take(pa.array(doc[s])),
                        "word_id": lambda: pa.array(w[s].astype(np.int32)), "n": lambda: pa.array(n[s]), "z": lambda: pa.array(z, from_pandas=True),
                        "r": lambda: pa.array(r), "c": lambda: _lists(np.where(good[:, None], r[:, None] * f * td, 0.0)), "nu": lambda: pa.array(nu[s])}
                yield pa.RecordBatch.from_arrays([make[name]() for name in columns], list(columns))

    return _joined(rows, theta, step.robust).mapInArrow(run, ", ".join(f"{name} {PAIR_COLUMNS[name]}" for name in columns))


def noise_pairs(rows: DataFrame) -> DataFrame:
    """(row_id, word_id, p) of ``(row_id, part, words, us, nu_sum)``; the words
    are a list or, out of a pass, packed."""
    def lists(b):
        if pa.types.is_list(b.column(2).type):
            return b
        sizes = pc.binary_length(b.column(2)).to_numpy(zero_copy_only=False) // 4
        ends = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
        return b.set_column(2, "words", pa.ListArray.from_arrays(ends, pa.array(_unpacked(b.column(2), np.int32))))

    def run(batches):
        for b in _walks((lists(b) for b in batches if b.num_rows), PAIRS_AT_ONCE):
            doc = np.repeat(np.arange(b.num_rows), b.column(2).value_lengths().to_numpy(zero_copy_only=False))
            w = b.column(2).flatten()
            us = np.ones(len(w)) if b.column(3).null_count else _unpacked(b.column(3))
            p = _Step.noise(us, b.column(4).to_numpy(zero_copy_only=False).astype(float)[doc])
            for a in range(0, len(w), PAIRS_AT_ONCE):
                s = slice(a, a + PAIRS_AT_ONCE)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(doc[s])), w[s], pa.array(p[s])], ["row_id", "word_id", "p"])

    return rows.select("row_id", "part", "words", "us", "nu_sum").mapInArrow(run, "row_id bigint, word_id int, p double")


# ----------------------------------------------------------------------- M-step
def _slice(col: str, k: int):
    return F.slice(col, 1, k)


def _adjusted(counts, old, prior: Prior | None):
    """E2/E3 + E5: the prior on every cell, then the positive cut."""
    if not is_active(prior):
        return counts
    return F.transform(prior.adjust_topics(counts, old), lambda c: F.greatest(c, F.lit(0.0)))


def _document_sums(step: _Step, passed: DataFrame, hot: DataFrame | None) -> DataFrame:
    """(row_id, part, vec): each document's sums over its parts, on every part."""
    one = passed.where("word_id is null")
    if hot is None:
        return one.select("row_id", "part", "vec", "us")
    one = one.select("row_id", "part", "vec")
    cold = one.join(hot.select("row_id"), "row_id", "left_anti")
    merged = sum_vectors(one.join(hot.select("row_id"), "row_id", "left_semi"), ["row_id"], step.width).join(hot, "row_id")
    warm = merged.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("np") - 1)))
    return cold.select("row_id", "part", "vec").unionByName(warm.select("row_id", F.col("part").cast("int"), "vec"))


def next_theta(step: _Step, passed: DataFrame, theta: DataFrame | None, hot: DataFrame | None, prior: Prior | None, noise: bool = False) -> DataFrame:
    """(row_id, part, theta, nu_sum) and, where no document is split and
    it is asked for, the row's ``noise``.  A prior needs the old θ."""
    sums = _document_sums(step, passed, hot)
    s = _slice("vec", step.k)
    if is_active(prior):
        sums = sums.join(theta.select("row_id", "part", F.col("theta").alias("old")), ["row_id", "part"])
        s = _adjusted(s, F.col("old"), prior)
    sums = sums.withColumn("s", s)
    total = F.aggregate("s", F.lit(0.0), lambda a, x: a + x)
    new = F.when(F.col("total") > 0, F.transform("s", lambda x: x / F.col("total")))
    if is_active(prior):
        new = new.otherwise(F.col("old"))
    return sums.withColumn("total", total).select("row_id", "part", new.alias("theta"), F.col("vec")[step.k + 2].alias("nu_sum"), *(["us"] if noise else []))


def word_counts(step: _Step, passed: DataFrame) -> DataFrame:
    """(word_id, vec): K expected counts and the background's."""
    return sum_vectors(passed.where("word_id >= 0").select("word_id", "vec"), ["word_id"], step.k + 1)


def next_phi(step: _Step, passed: DataFrame, files: PhiFiles, prior: Prior | None, vocab: Vocabulary, freeze_phi: bool, sums: DataFrame | None = None) -> PhiFiles:
    """C7/R9 (+E3): the next φ, written by the tasks that add up its words;
    ``sums``: word rows that do not stand in the pass."""
    k, spark = step.k, passed.sparkSession
    totals = column_totals(passed.where(F.col("word_id") == TOTALS), k + 1)
    if step.gamma == 0:
        totals[k] = 0.0
    if sums is not None and not is_active(prior):
        return write_phi(sums.select("word_id", _slice("vec", k).alias("vec")), vocab.size, k, False, totals[:k], partial=True)
    raw = word_counts(step, passed if sums is None else sums)
    vec = F.col("vec") if step.robust else _slice("vec", k)
    if freeze_phi:
        # Only the background moves (robust fold-in); words absent from the folded documents get β = 0.
        bg = F.coalesce(F.element_at("vec", k + 1) / float(totals[k] or 1.0), F.lit(0.0)) * float(totals[k] > 0)
        rows = files.frame(spark).select("word_id", "phi").join(raw, "word_id", "left")
        return write_phi(rows.select("word_id", F.concat("phi", F.array(bg)).alias("vec")), vocab.size, k, step.robust)
    if not is_active(prior):
        return write_phi(raw.select("word_id", vec.alias("vec")), vocab.size, k, step.robust, totals[:k + step.robust])
    every = vocab.table.select("word_id").join(raw, "word_id", "left") if prior.adds_mass else raw
    every = every.join(files.frame(spark).select("word_id", F.col("phi").alias("old")), "word_id", "left")
    zero = F.array_repeat(F.lit(0.0), k)
    adjusted = _adjusted(F.coalesce(_slice("vec", k), zero), F.coalesce("old", zero), prior)
    bg = F.array(F.coalesce(F.element_at("vec", k + 1), F.lit(0.0)))
    counts = cut_lineage(every.select("word_id", F.concat(adjusted, bg).alias("vec")), "counts")
    totals[:k] = column_totals(counts, k + 1)[:k]
    out = write_phi(counts.select("word_id", vec.alias("vec")), vocab.size, k, step.robust, totals[:k + step.robust])
    release(counts)
    return out


# ------------------------------------------------------------------------- loop
@dataclass
class State:
    """What an iteration leaves.  θ stands in the pass as its rows are, unless
    a document is split or a prior needs the old θ beside the sums; the robust
    model's new noise always stands there."""

    step: _Step
    files: PhiFiles
    rows_table: DataFrame | None = None
    theta_table: DataFrame | None = None
    passed: DataFrame | None = None
    hot: DataFrame | None = None
    keep_lists: bool = False             # the pass that leads on from here writes the words too
    words: WordLists | None = None       # the pairs by word, where word sums are made from them

    def rows(self) -> DataFrame:
        return self.rows_table

    def theta(self, noise: bool = True) -> DataFrame:
        """θ and, for the robust model, the ``noise`` of the same rows."""
        noise = noise and self.step.robust
        if self.theta_table is None:
            return next_theta(self.step, self.passed, None, None, None, noise)
        if not noise:
            return self.theta_table
        if self.passed is None:
            return self.theta_table.withColumn("us", F.lit(None).cast("binary"))
        fresh = self.passed.where("word_id is null").select("row_id", "part", "us")
        return self.theta_table.join(fresh.hint("shuffle_hash"), ["row_id", "part"])

    def tables(self) -> list:
        return [self.rows_table, self.theta_table, self.passed, self.hot]


def initial_state(bags: DataFrame, phi0: DataFrame, vocab: Vocabulary, step: _Step, background0: DataFrame | None = None, own: bool = False) -> State:
    """State 0: θ = 1/K (C2); robust adds ν = 1/Σn on each distinct word (R1, as
    u = 1, not written, with normaliser Σn) and β = 1/V (R2)."""
    rows = document_rows(bags, own)
    hot = hot_documents(bags)
    total = F.aggregate("ns", F.lit(0.0), lambda a, x: a + x) if step.robust else F.lit(0.0)
    mass = rows.select("row_id", "part", total.alias("nu_sum"))
    if hot is not None and step.robust:
        whole = mass.join(hot.select("row_id"), "row_id", "left_semi").groupBy("row_id").agg(F.sum("nu_sum").alias("whole"))
        mass = mass.join(whole, "row_id", "left").select("row_id", "part", F.coalesce("whole", "nu_sum").alias("nu_sum"))
    theta = write_bucketed(mass.select("row_id", "part", F.array_repeat(F.lit(1.0 / step.k), step.k).alias("theta"), "nu_sum"),
                           ["row_id", "part"], buckets_of(bags), "theta", prepartitioned=hot is None or not step.robust)
    return State(step, initial_files(phi0, vocab, step, background0), rows, theta, None, hot)


def initial_files(phi0: DataFrame, vocab: Vocabulary, step: _Step, background0: DataFrame | None = None) -> PhiFiles:
    """φ (and β) given as a table, as block files."""
    vec = F.col("phi")
    if step.robust:
        bg = background0 if background0 is not None else vocab.table.select("word_id", F.lit(1.0 / max(vocab.size, 1)).alias("bg"))
        phi0 = phi0.select("word_id", "phi").join(bg.select("word_id", "bg"), "word_id")
        vec = F.concat("phi", F.array("bg"))
    return write_phi(phi0.select("word_id", vec.alias("vec")), vocab.size, step.k, step.robust)


def state0_pairs(bags: DataFrame, vocab: Vocabulary, k: int, seed: int = 13, robust: bool = False,
                 gamma: float = 0.0, eps: float = 0.0, columns: tuple = tuple(PAIR_COLUMNS)) -> DataFrame:
    """Per-pair view of state 0: (row_id, part, word_id, n, z, r, c[K], nu), or
    those ``columns`` of it."""
    step = _Step(k, robust, gamma, eps)
    state = initial_state(bags, initial_phi(vocab, k, seed), vocab, step)
    return pair_view(step, state.rows(), state.theta(), state.files, columns)


def state0_counts(bags: DataFrame, vocab: Vocabulary, k: int, seed: int = 13) -> DataFrame:
    """C6 of state 0: (word_id, vec[K])."""
    step = _Step(k)
    state = initial_state(bags, initial_phi(vocab, k, seed), vocab, step)
    passed = cut_lineage(em_pass(step, state.rows(), state.theta(), state.files, True), "pass")
    return word_counts(step, passed).select("word_id", _slice("vec", k).alias("vec"))


def advance(state: State, it: int, buckets: int, vocab: Vocabulary, theta_prior: Prior | None, phi_prior: Prior | None,
            freeze_phi: bool, freeze_background: bool) -> tuple[State, float, int]:
    """One iteration: the next state, and the log-likelihood and skipped pairs
    of the one before."""
    step = state.step
    want_words = not freeze_phi or (step.robust and not freeze_background)
    seen = Observation(f"loglik-{it}-{uuid.uuid4().hex[:8]}")
    is_doc, vec = F.col("word_id").isNull(), F.col("vec")
    by_word = state.words if want_words else None
    out = em_pass(step, state.rows(), state.theta(), state.files, want_words and not by_word, state.keep_lists, by_word is not None).observe(
        seen, F.sum(F.when(is_doc, vec[step.k])).alias("ll"), F.sum(F.when(is_doc, vec[step.k + 1])).alias("sk"))
    passed = write_bucketed(out, ["row_id", "part"], buckets, "pass", prepartitioned=True)
    sums, theta_files = None, None
    if by_word:
        theta_files = by_word.theta_files(state.theta(False) if it else None, step.k)
        sums = by_word.sums(theta_files, state.files)
    files = next_phi(step, passed, state.files, phi_prior, vocab, freeze_phi, sums) if want_words else state.files
    if by_word:
        release(theta_files.frame)
        drop_shuffles(passed.sparkSession)
    new = State(step, files, state.rows_table, None, passed, state.hot, words=state.words)
    if state.hot is not None or is_active(theta_prior):
        theta = next_theta(step, passed, state.theta(False), state.hot, theta_prior)
        new.theta_table = write_bucketed(theta, ["row_id", "part"], buckets, "theta", prepartitioned=state.hot is None)
        if not step.robust:
            release(passed)
            new.passed = None
    return new, float(seen.get["ll"] or 0.0), int(round(seen.get["sk"] or 0.0))


def drop(old: State, new: State | None, spark) -> None:
    """Delete what the old state has and the new one does not."""
    kept = [] if new is None else new.tables()
    for table in old.tables():
        if table is not None and not any(table is t for t in kept):
            release(table)
    if new is None or new.files is not old.files:
        release(old.files.frame(spark))


def run_em(bags: DataFrame, vocab: Vocabulary, phi0: DataFrame, k: int, iterations: int, *,
           robust: bool = False, gamma: float = 0.0, eps: float = 0.0, background0: DataFrame | None = None,
           freeze_phi: bool = False, theta_prior: Prior | None = None, phi_prior: Prior | None = None,
           compute_loglik: bool = True, freeze_background: bool = False, docs: DataFrame | None = None,
           resume: str | None = None) -> TopicModel:
    """The EM driver loop (C8/R10).  ``bags`` must come from :func:`to_bags`;
    ``freeze_phi`` gives fold-in (C10/R12), and only then the background can be
    frozen.  ``resume`` names a folder in which every finished iteration is
    recorded: a fit that finds records there goes on after the last one."""
    if freeze_background and not freeze_phi:
        raise ValueError("the background is frozen only with phi")
    spark = bags.sparkSession
    step = _Step(k, robust, float(gamma), float(eps))
    buckets = buckets_of(bags)
    run = Run(spark, resume, {"k": k, "robust": robust, "gamma": float(gamma), "eps": float(eps), "words": vocab.size, "seed": getattr(phi0, "_tt_seed", None), "freeze_phi": freeze_phi,
                              "theta_prior": repr(theta_prior), "phi_prior": repr(phi_prior), **({"noise": "packed"} if robust else {})}) if resume else None
    found = run.last() if run else None
    if found:
        done, history, tables, files = found
        state = State(step, PhiFiles(**files), **tables)
        buckets = next(t for t in state.tables() if t is not None)._tt_buckets
    else:
        state, done, history = initial_state(bags, phi0, vocab, step, background0, run is not None), 0, []
        if run:
            run.record(0, history, state)
    release(getattr(phi0, "_tt_source", None))
    if done < iterations and not freeze_phi and not robust:
        state.words = list_words(state.rows(), vocab, state.files, buckets)
    for it in range(done, iterations):
        state.keep_lists = robust and not run and it + 1 == iterations
        new, loglik, skipped = advance(state, it, buckets, vocab, theta_prior, phi_prior, freeze_phi, freeze_background)
        history.append((it, loglik, skipped))
        if run:
            run.record(it + 1, history, new)
        drop(state, new, spark)
        state = new

    if state.words:
        state.words.release()
    if compute_loglik:
        total = column_totals(em_pass(step, state.rows(), state.theta(), state.files, False), step.width)
        history.append((iterations, float(total[k]), int(round(total[k + 1]))))

    theta, phi = state.theta(False), state.files.frame(spark)
    theta_rows = theta.where("part = 0").select("row_id", "part", "theta")
    mine = with_all_documents(theta_rows.select("row_id", "theta"), docs)
    model = TopicModel(k=k, vocab=vocab, phi=phi.select("word_id", "phi"), theta=mine, history=history, gamma=float(gamma), eps=float(eps),
                       theta_prior=theta_prior, phi_prior=phi_prior, files=state.files, theta_rows=theta_rows, scratch=[phi, state.theta_table, state.passed, state.hot])
    if robust:
        model.background = phi.select("word_id", F.col("bg").alias("p"))
        if state.passed is None or run:
            lists = state.rows().join(state.theta().hint("shuffle_hash"), ["row_id", "part"])
        else:          # the model's own table, so its bags may go
            lists = state.passed.where("word_id is null").select("row_id", "part", "words", "us", F.col("vec")[k + 2].alias("nu_sum"))
            if state.theta_table is not None:
                lists = lists.drop("nu_sum").join(state.theta_table.select("row_id", "part", "nu_sum").hint("shuffle_hash"), ["row_id", "part"])
        model.noise = noise_pairs(lists)
    if (robust and state.passed is None) or run:
        model.scratch.append(state.rows_table)     # read by the noise, or by a later resume
    else:
        release(state.rows_table)
    return model


# --------------------------------------------------------------- row-wise fold-in
def fold_rows(rows: DataFrame, files: PhiFiles, step: _Step, iterations: int) -> DataFrame:
    """With φ (and β) frozen a document stands alone, so all iterations run
    where its row is: (row_id, theta, words, us, nu_sum, stats) with the
    log-likelihood and the skipped pairs of the states 0..iterations one after
    the other.  A run of documents takes the φ rows of its own words from the
    block files once; how many blocks there are does not matter."""
    k, pairs = step.k, max(1000, min(PAIRS_A_WALK, (4 << 20) // step.k))

    def run(batches):
        for b in _walks(batches, pairs):
            words = b.column(2)
            sizes = words.value_lengths().to_numpy(zero_copy_only=False)
            doc, n = np.repeat(np.arange(b.num_rows), sizes), b.column(3).flatten().to_numpy(zero_copy_only=False)
            own, place = np.unique(words.flatten().to_numpy(), return_inverse=True)
            source = files.rows(own)
            theta, stats = np.full((b.num_rows, k), 1.0 / k), []
            us, norm = np.ones(len(n)), np.bincount(doc, n, b.num_rows)
            for it in range(iterations + 1):
                nu = step.noise(us, norm[doc]) if step.robust else us
                sums, fresh, _, _ = step.walk(source, theta, doc, place, n, nu, False)
                stats.append(sums[:, k:k + 2])
                if it < iterations:
                    total = sums[:, :k].sum(axis=1, keepdims=True)
                    theta = np.where(total > 0, sums[:, :k] / np.where(total > 0, total, 1.0), np.nan)
                    us, norm = fresh, sums[:, k + 2]
            out = pa.array([None if np.isnan(t[0]) else t.tolist() for t in theta], pa.list_(pa.float64()))
            offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
            noise = [pa.ListArray.from_arrays(offsets, pa.array(own[place].astype(np.int32))), pa.ListArray.from_arrays(offsets, pa.array(us))]
            yield pa.RecordBatch.from_arrays([b.column(0), out, *noise, pa.array(norm), _lists(np.concatenate(stats, axis=1))],
                                             ["row_id", "theta", "words", "us", "nu_sum", "stats"])

    return rows.select("row_id", "part", "words", "ns").mapInArrow(
        run, "row_id bigint, theta array<double>, words array<int>, us array<double>, nu_sum double, stats array<double>")
