"""Toxicity by a factorization machine over hashed terms.

A document's terms are its distinct words and word beginnings, hashed into
``BUCKETS``; the machine adds a weight for each term and an inner product of
factors for each pair of terms, which learns pairs such as an insult beside a
group mention.  It is fitted by AdaGrad on a bounded sample of labelled rows;
every whole text is scored.

Rows: a null text has no terms, like the empty text, and gets the score of the
bias alone.  Labels that are null, or of ids that no document has, teach
nothing; a document with several labels counts as often.  Without any labelled
row every score is 0.  Equal texts get equal scores.  Score inputs are the text
only; other columns are not read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topic_tables.llm.text import LETTERS, share, slices
from topic_tables.session import cut_lineage

BUCKETS = 1 << 18
PREFIXES = (3, 5, 7)
#: Bound of the fit: labelled rows, by a digest of the id.
FIT_ROWS = 6000
#: A term counts once it stands in so many fitted documents and tells labels
#: apart, by itself or together with another term; other terms would only let
#: the machine learn documents by heart.
LEAST_DOCS = 5
LEAST_CHI = 10.0
#: A pair counts once each of its four cells (both terms, one, none) holds so
#: many fitted documents, and at least a hundredth of them, and its labels differ
#: by so much, as a chi-square of one degree, from the sum of what its two terms
#: do.
PAIR_DOCS = 20
PAIR_CHI = 40.0
#: Terms whose pairs are counted together.
PAIR_BLOCK = 1024
RANK = 8
EPOCHS = 15
RATE = 0.3
DECAY = 1e-4
SEED = 7
#: A Python worker forgets its hashed words beyond this number.
CACHE_WORDS = 150_000


def word_terms(word: str) -> list[int]:
    """Buckets of a lower-case word: itself and its beginnings."""
    raw = [b"w" + word.encode("utf-8", "surrogatepass")]
    raw += [b"%d" % k + word[:k].encode("utf-8", "surrogatepass") for k in PREFIXES if len(word) >= k]
    return [zlib.crc32(r) % BUCKETS for r in raw]


class Terms:
    """Distinct term buckets of texts; words are hashed once a worker."""

    def __init__(self):
        self.cache: dict[str, list[int]] = {}

    def of(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        if len(self.cache) > CACHE_WORDS:
            self.cache = {}
        out: list[int] = []
        for w in set(LETTERS.findall(text.lower())):
            t = self.cache.get(w)
            if t is None:
                t = self.cache[w] = word_terms(w)
            out += t
        return np.unique(np.array(out, np.int32))


@dataclass
class Machine:
    bias: float
    weight: np.ndarray    # BUCKETS
    factor: np.ndarray    # BUCKETS x RANK
    known: np.ndarray     # terms that the fit has seen often enough

    def raw(self, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Machine's value for documents whose known terms lie one after the other."""
        x = 1.0 / np.sqrt(np.maximum(sizes, 1.0))
        doc = np.repeat(np.arange(len(sizes)), sizes)
        v = self.factor[at]
        linear = np.bincount(doc, self.weight[at], len(sizes))
        both = np.zeros(len(sizes))
        for f in range(v.shape[1]):
            both += np.bincount(doc, v[:, f], len(sizes)) ** 2 - np.bincount(doc, v[:, f] ** 2, len(sizes))
        return self.bias + linear * x + 0.5 * both * x * x


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def _chi(hits: np.ndarray, seen: np.ndarray, p: float) -> np.ndarray:
    """What a cell of so many documents and hits adds to a chi-square."""
    return (hits - seen * p) ** 2 / np.maximum(seen * p * (1 - p), 1e-12)


def telling(terms: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Terms frequent enough whose documents differ from the others in their
    labels by a chi-square of at least ``LEAST_CHI``, and the terms of pairs
    that do so only together (``PAIR_CHI``): a pair may matter though neither
    of its terms tells anything.  Pairs with a term that is in already are not
    searched: any frequent word beside an insult would qualify."""
    doc = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
    flat = np.concatenate(terms)
    seen = np.bincount(flat, minlength=BUCKETS).astype(float)
    hits = np.bincount(flat, labels[doc], BUCKETS)
    n, p, every = len(labels), float(labels.mean()), float(labels.sum())
    alone = _chi(hits, seen, p) + _chi(every - hits, n - seen, p)
    known = (seen >= LEAST_DOCS) & (alone >= LEAST_CHI)
    if not 0 < p < 1:
        return known
    least = max(PAIR_DOCS, n // 100)
    often = np.flatnonzero((seen >= 2 * least) & (n - seen >= 2 * least) & ~known)
    place = np.full(BUCKETS, -1)
    place[often] = np.arange(len(often))
    in_doc = np.zeros((n, len(often)), np.uint8)           # at most FIT_ROWS long
    mine = place[flat] >= 0
    in_doc[doc[mine], place[flat[mine]]] = 1
    toxic = in_doc[labels > 0]
    blocks = [slice(k, k + PAIR_BLOCK) for k in range(0, len(often), PAIR_BLOCK)]
    for i, x in enumerate(blocks):
        for y in blocks[i:]:
            both, hit = ((m[:, x].T.astype(np.float32) @ m[:, y].astype(np.float32)).astype(float) for m in (in_doc, toxic))
            sx, sy, hx, hy = seen[often[x], None], seen[often[y]][None], hits[often[x], None], hits[often[y]][None]
            counts = both, sx - both, sy - both, n - sx - sy + both
            rates = [h / np.maximum(m, 1) for h, m in zip((hit, hx - hit, hy - hit, every - hx - hy + hit), counts)]
            # how far the pair is from the sum of what its terms do
            apart = (rates[0] - rates[1] - rates[2] + rates[3]) ** 2 / (p * (1 - p) * sum(1 / np.maximum(m, 1) for m in counts))
            pair = (np.minimum.reduce(counts) >= least) & (apart >= PAIR_CHI)
            known[often[x][pair.any(axis=1)]] = True
            known[often[y][pair.any(axis=0)]] = True
    return known


def train(terms: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS) -> Machine:
    """Fit on documents in a fixed order; AdaGrad over small batches."""
    known = telling(terms, labels)
    terms = [t[known[t]] for t in terms]
    rng = np.random.default_rng(SEED)
    used = np.flatnonzero(known)
    place = np.zeros(BUCKETS, np.int64)
    place[used] = np.arange(len(used))
    terms = [place[t] for t in terms]
    share_of = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3))
    m = Machine(float(np.log(share_of / (1 - share_of))), np.zeros(len(used)), rng.normal(0, 0.01, (len(used), RANK)), known)
    g_w, g_v, g_b = np.full(len(used), 1e-8), np.full((len(used), RANK), 1e-8), 1e-8
    for _ in range(epochs):
        order = rng.permutation(len(terms))
        for k in range(0, len(order), 32):
            batch = order[k:k + 32]
            sizes = np.array([len(terms[i]) for i in batch])
            at = np.concatenate([terms[i] for i in batch])
            x = 1.0 / np.sqrt(np.maximum(sizes, 1.0))
            err = sigmoid(m.raw(at, sizes)) - labels[batch]
            doc = np.repeat(np.arange(len(batch)), sizes)
            uniq, inv = np.unique(at, return_inverse=True)
            step = (err * x)[doc]
            grad = np.bincount(inv, step, len(uniq)) + DECAY * m.weight[uniq]
            v = m.factor[at]
            total = np.stack([np.bincount(doc, v[:, f], len(batch)) for f in range(RANK)], 1)
            pull = (err * x * x)[doc, None] * (total[doc] - v)
            grad_v = np.stack([np.bincount(inv, pull[:, f], len(uniq)) for f in range(RANK)], 1) + DECAY * m.factor[uniq]
            g_w[uniq] += grad ** 2
            g_v[uniq] += grad_v ** 2
            g_b += err.sum() ** 2
            m.weight[uniq] -= RATE * grad / np.sqrt(g_w[uniq])
            m.factor[uniq] -= 0.1 * RATE * grad_v / np.sqrt(g_v[uniq])
            m.bias -= 0.1 * RATE * err.sum() / np.sqrt(g_b)
    weight, factor = np.zeros(BUCKETS, np.float32), np.zeros((BUCKETS, RANK), np.float32)
    weight[used], factor[used] = m.weight, m.factor
    return Machine(m.bias, weight, factor, known)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> Machine | None:
    """Machine fitted on at most about ``FIT_ROWS`` labelled rows of ``learn``."""
    known = labels.where(learn & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    n = known.count()
    sample = cut_lineage(known.where(share(id_col) * n < FIT_ROWS).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")), "toxic-sample")
    # about FIT_ROWS short rows: a proven bound for the broadcast
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(sample), "id")

    def run(batches):
        terms = Terms()
        for b in slices(batches, 1):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([terms.of(t) for t in b.column(1).to_pylist()], pa.list_(pa.int32())), b.column(2)],
                                             ["id", "terms", "label"])

    id_type = sample.schema["id"].dataType.simpleString()
    table = rows.select("id", "text", "label").mapInArrow(run, f"id {id_type}, terms array<int>, label int").toArrow()
    if not table.num_rows:
        return None
    terms = table["terms"].combine_chunks()
    cuts = terms.offsets.to_numpy()
    flat = terms.values.to_numpy()
    found = sorted(((i, y, flat[a:b]) for i, y, a, b in zip(table["id"].to_pylist(), table["label"].to_pylist(), cuts, cuts[1:])),
                   key=lambda r: (str(r[0]), r[1], r[2].tobytes()))     # one order however Spark returns them
    return train([t for _, _, t in found], np.array([float(y) for _, y, _ in found]))


def score(docs: DataFrame, machine: Machine | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score)`` of every row; no shuffle.  The machine's size is fixed
    by ``BUCKETS`` and ``RANK``."""
    id_type = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches):
        terms, m = Terms(), shared.value
        for b in slices(batches, 1):
            if m is None:
                p = np.zeros(b.num_rows)
            else:
                found = [t[m.known[t]] for t in (terms.of(x) for x in b.column(1).to_pylist())]
                p = sigmoid(m.raw(np.concatenate(found), np.array([len(t) for t in found])))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p)], ["id", "score"])

    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"id {id_type}, score double").withColumnRenamed("id", id_col))
