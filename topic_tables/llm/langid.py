"""Language identification by segmentation-marginalised unigrams.

The vocabulary is fixed and public (sentencepiece pieces); each language has a
probability for every piece.  A word's probability in a language is the sum
over all its segmentations into pieces, by the forward algorithm; a text's is
the product over its words.  Probabilities are fitted by expectation
maximisation (forward and backward) on the word counts of a bounded sample of
documents.  Words of more than ``LONG`` characters are summed in logarithms, as
their probabilities leave the range of a double.

Rows: a null text, or one without a letter, gives ``und`` with score 0.  Equal
texts get equal answers, ties go to the first language in code point order.
Rows with a null language teach nothing; without any labelled text every
document is ``und``.  Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topic_tables.llm.text import LETTERS, column, share, slices
from topic_tables.session import cut_lineage

UND = "und"
#: A document under this score is not identified.
LEAST_SCORE = 0.5
#: Bound of the fit: documents of each language.
FIT_DOCS = 3000
ROUNDS = 3
#: Probability of a piece or character that a language's sample does not hold.
FLOOR = 1e-7
#: Longer words are summed in logarithms.
LONG = 40
#: Characters of words that are taken together.
CHARS_AT_ONCE = 200_000
#: A Python worker forgets its scored words beyond this number.
CACHE_WORDS = 150_000
MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=2)
def pieces(path: str) -> list[str]:
    """Pieces of the vocabulary that are text, in id order (others empty)."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return ["" if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) else sp.id_to_piece(i)
            for i in range(sp.get_piece_size())]


class Lattice:
    """Finds pieces in words; all words of one length at once."""

    def __init__(self, path: str):
        by_len: dict[int, list[tuple[np.uint64, int]]] = {}
        for i, p in enumerate(pieces(path)):
            if p:
                h = np.uint64(0)
                with np.errstate(over="ignore"):
                    for c in p:
                        h = h * MIX + np.uint64(ord(c) + 1)
                by_len.setdefault(len(p), []).append((h, i))
        self.size = len(pieces(path))
        self.longest = max(by_len)
        self.tables = {n: (np.array([h for h, _ in sorted(v)]), np.array([i for _, i in sorted(v)])) for n, v in by_len.items()}

    def edges(self, words: list[str]) -> list[np.ndarray]:
        """For words of one length: ``[l-1][word, start]`` is the id of the
        piece of l characters there; ``size`` for none, ``size + 1`` for a
        single character that is no piece."""
        n = len(words[0])
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), n).astype(np.uint64) + np.uint64(1)
        out, h = [], np.zeros((len(words), n), np.uint64)
        for l in range(1, min(n, self.longest) + 1):
            h = h[:, :n - l + 1] * MIX + code[:, l - 1:]
            ids = np.full(h.shape, self.size if l > 1 else self.size + 1)
            if l in self.tables:
                keys, of = self.tables[l]
                at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                ids = np.where(keys[at] == h, of[at], ids)
            out.append(ids)
        return out

    def forward(self, edges: list[np.ndarray], prob: np.ndarray) -> list[np.ndarray]:
        """Forward sums after each character; prob has a row for each id."""
        n = edges[0].shape[1]
        a = [np.ones((edges[0].shape[0], prob.shape[1]))]
        for j in range(1, n + 1):
            a.append(sum(a[j - l] * prob[edges[l - 1][:, j - l]] for l in range(1, min(j, len(edges)) + 1)))
        return a

    def backward(self, edges: list[np.ndarray], prob: np.ndarray) -> list[np.ndarray]:
        n = edges[0].shape[1]
        b: list = [None] * n + [np.ones((edges[0].shape[0], prob.shape[1]))]
        for j in range(n - 1, -1, -1):
            b[j] = sum(b[j + l] * prob[edges[l - 1][:, j]] for l in range(1, min(n - j, len(edges)) + 1))
        return b

    def log_sums(self, edges: list[np.ndarray], prob: np.ndarray, back: bool = False) -> np.ndarray:
        """Logarithms of the forward (or backward) sums at each place,
        ``[place, word, language]``.  The last few sums are kept as numbers,
        over a scale of their own for each word and language."""
        n, reach = edges[0].shape[1], len(edges)
        size = edges[0].shape[0], prob.shape[1]
        out, scale = np.zeros((n + 1, *size)), np.zeros(size)
        last = [np.ones(size)]                                # nearest place first
        for j in range(1, n + 1):
            at = (lambda l: n - j) if back else (lambda l: j - l)
            now = sum(last[l - 1] * prob[edges[l - 1][:, at(l)]] for l in range(1, min(j, reach) + 1))
            last = [now, *last[:reach - 1]]
            if j % 8 == 0:                                    # 8 steps stay within 1e-7 ** 8
                top = np.maximum.reduce(last)
                last, scale = [x / top for x in last], scale + np.log(top)
            out[n - j if back else j] = np.log(np.maximum(last[0], 1e-300)) + scale
        return out

    def runs(self, words: list[str]):
        """Places in ``words`` of words of one length, in runs of bounded size."""
        by_len: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_len.setdefault(len(w), []).append(i)
        for n, at in by_len.items():
            step = max(1, CHARS_AT_ONCE // n)
            for k in range(0, len(at), step):
                yield n, at[k:k + step]

    def score(self, words: list[str], prob: np.ndarray) -> np.ndarray:
        """Log probability ``[word, language]`` of every word."""
        marked = ["▁" + w for w in words]
        out = np.zeros((len(words), prob.shape[1]))
        for n, at in self.runs(marked):
            edges = self.edges([marked[i] for i in at])
            out[at] = np.log(self.forward(edges, prob)[-1]) if n <= LONG else self.log_sums(edges, prob)[-1]
        return out

    def fit(self, words: list[str], counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
        """Piece probabilities (and the two rows of ``edges``) after EM."""
        marked, counts = ["▁" + w for w in words], np.asarray(counts, float)
        prob = np.full((self.size + 2, 1), 1.0 / self.size)
        prob[self.size:, 0] = 0, FLOOR
        for _ in range(rounds):
            got = np.zeros(self.size + 2)
            for n, at in self.runs(marked):
                edges, c = self.edges([marked[i] for i in at]), counts[at]
                if n <= LONG:
                    a, b = self.forward(edges, prob), self.backward(edges, prob)
                    each = c / a[-1][:, 0]
                    for l, ids in enumerate(edges, 1):
                        for s in range(ids.shape[1]):
                            np.add.at(got, ids[:, s], each * a[s][:, 0] * prob[ids[:, s], 0] * b[s + l][:, 0])
                else:
                    a, b = self.log_sums(edges, prob)[:, :, 0], self.log_sums(edges, prob, back=True)[:, :, 0]
                    for l, ids in enumerate(edges, 1):
                        for s in range(ids.shape[1]):
                            np.add.at(got, ids[:, s], c * prob[ids[:, s], 0] * np.exp(np.minimum(a[s] + b[s + l] - a[n], 50.0)))
            got = got[:self.size]
            prob[:self.size, 0] = np.maximum(got / max(got.sum(), 1e-300), FLOOR)
        return prob[:self.size, 0]


@lru_cache(maxsize=2)
def lattice(path: str) -> Lattice:
    return Lattice(path)


def words_of(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


def fit(docs: DataFrame, path: str, learn: Column, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang") -> DataFrame:
    """``(lang, probs array<double>)`` from the rows of ``learn`` with a
    language: at most about ``FIT_DOCS`` documents of each, by a digest of the
    id, and all their words."""
    rows = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"),
                       share(id_col).alias("share"))
    sizes = cut_lineage(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")), "lang-sizes")
    sample = rows.join(sizes, "lang").where(F.col("share") * F.col("rows") < FIT_DOCS).select("lang", "text")

    def count(batches):
        for b in slices(batches, 1):
            got: dict[str, Counter] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                got.setdefault(lang, Counter()).update(words_of(text))
            flat = [(lang, w, n) for lang, c in got.items() for w, n in c.items()]
            if flat:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*flat)], ["lang", "word", "n"])

    counts = sample.mapInArrow(count, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))

    def em(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("word")
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "probs": [lattice(path).fit(pdf["word"].tolist(), pdf["n"].to_numpy())]})

    return counts.groupBy("lang").applyInPandas(em, "lang string, probs array<double>")


def predict(docs: DataFrame, model: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
            carry: tuple[str, ...] = ()) -> DataFrame:
    """``(id, lang_pred, score)`` of every row, and the columns to carry (an
    empty id column: those alone).  The score is the posterior of the predicted language under an even prior.  The
    model is one row a language, whose length is the vocabulary's."""
    spark = docs.sparkSession
    rows = sorted((r["lang"], r["probs"]) for r in model.collect())
    langs = [lang for lang, _ in rows]
    size = lattice(path).size
    prob = np.zeros((size + 2, len(langs)))
    for k, (_, p) in enumerate(rows):
        prob[:size, k] = p
    prob[size + 1] = FLOOR
    shared = spark.sparkContext.broadcast(prob)
    out = [c for c in (id_col, *carry) if c]
    types = {c: docs.schema[c].dataType.simpleString() for c in out}
    names = [f"c{i}" for i in range(len(out))]       # own names: the table's may clash

    def run(batches):
        lat, seen, table = lattice(path), {}, np.zeros((0, len(langs)))
        for b in slices(batches, 0, 2_000_000):
            if len(seen) > CACHE_WORDS:
                seen, table = {}, np.zeros((0, len(langs)))
            known, pred, score = len(seen), [], []
            at = []
            for text in b.column(0).to_pylist():
                words = words_of(text)
                letters = any(c.isalpha() for w in words for c in w)
                at.append([seen.setdefault(w, len(seen)) for w in words] if letters else [])
            if len(seen) > known and langs:
                table = np.r_[table, lat.score(list(seen)[known:], shared.value)]
            for ids in at:
                if not ids or not langs:
                    pred.append(UND)
                    score.append(0.0)
                    continue
                total = table[ids].sum(axis=0)
                best = int(total.argmax())
                pred.append(langs[best])
                score.append(float(1 / np.exp(total - total[best]).sum()))
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                                             [*names, "lang_pred", "score"])

    schema = ", ".join(f"{n} {t}" for n, t in zip(names, types.values()))
    found = docs.select(F.col(text_col).cast("string").alias("text"), *(column(c).alias(n) for n, c in zip(names, out)))
    found = found.mapInArrow(run, f"{schema}, lang_pred string, score double")
    return found.select(*(F.col(n).alias(c) for n, c in zip(names, out)), "lang_pred", "score")


def identified(docs: DataFrame, model: DataFrame, path: str, text_col: str = "text", least_score: float = LEAST_SCORE) -> DataFrame:
    """The rows, with their columns, whose language is predicted with at least
    that score."""
    found = predict(docs, model, path, "", text_col, tuple(docs.columns))
    safe = found.toDF(*(f"c{i}" for i in range(len(docs.columns))), "lang_pred", "score")
    kept = safe.where((F.col("lang_pred") != UND) & (F.col("score") >= least_score))
    return kept.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)))
