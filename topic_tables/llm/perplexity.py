"""Quality rules and an n-gram perplexity band for each language.

Base rules count words, symbols, repeated lines and repeated word windows.  The
model is a modified Kneser-Ney model of the characters of words (order 5, a
word with its start and end): Spark counts the n-grams of every text, takes
continuation counts, discounts and context masses from them, and the model is
kept as arrays sorted by hash.  A document's perplexity is taken per character
over its whole text; a language's band is set around the median of its
documents, on each side by how far that side's tail lies from it.  Words, rather than runs of words, are modelled because the word
n-grams of a corpus alone are larger than the corpus.

Model size: every n-gram is kept, and every language has a model.  A model of
up to ``MODEL_ENTRIES`` entries is broadcast.  A larger one stays in tables:
the probability of each n-gram is found by joins, documents are coded by the
words of their chunk, and a chunk's n-grams are joined with their
probabilities and brought to its documents.

Rows: a null text has no words and fails the base rules, like the empty text.
A null language is the empty one.  Equal rows get equal answers; an empty
table gives an empty table.  Only id, text and language are read.
"""

from __future__ import annotations

import uuid
from collections import Counter
from itertools import batched

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topic_tables.llm.text import WORD, slices
from topic_tables.session import cut_lineage

ORDER = 5
START, END = "\x02", "\x03"
#: Entries (n-grams and contexts of all languages, 12 bytes each) up to which
#: the model is broadcast; hash shards by which its arrays are packed.
MODEL_ENTRIES = 8_000_000
SHARD_BITS = 6
#: If set, only so many frequent languages have models, the others one together.
MAX_LANGS = None
OTHERS = ""
#: Distinct words after which a task hands on its n-gram counts; words whose
#: symbols are in arrays at once; scored words that a worker keeps.
FLUSH_WORDS = 200_000
WORDS_AT_ONCE = 40_000
CACHE_WORDS = 150_000
#: N-grams whose probability a worker keeps.
KNOWN_GRAMS = 1_000_000
CACHE_CHARS = 64
#: Text of the documents that are scored together from tables.
CHUNK_CHARS = 8_000_000
#: Band of log perplexity: below and above the median by so many times the
#: distance of the lower and the upper quantile of this share.
BAND = 3.0
TAIL = 0.1
LEAST_WIDTH = 0.02
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIX = np.uint64(0x9E3779B97F4A7C15)


# ------------------------------------------------------------------ base rules
def base_counts(text: str | None) -> tuple[list[str], tuple[int, int, int, int, int]]:
    """The words, and (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    if not text:
        return [], (0, 0, 0, 0, 0)
    words = WORD.findall(text)
    lines = Counter(line for line in text.split("\n") if WORD.search(line))
    return words, (len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)),
                   lines.total() - len(lines), repeated_words(words))


def repeated_words(words: list[str], window: int = 3) -> int:
    """Words inside windows that occur twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids: dict[str, int] = {}
    w = np.array([ids.setdefault(x, len(ids)) for x in words], np.int64)
    if len(ids) == len(words):
        return 0
    key, span = w[:n], len(ids)
    for k in range(1, window):
        if span * len(ids) >= 2 ** 62:          # number the windows so far anew
            key = np.unique(key, return_inverse=True)[1]
            span = len(words)
        key, span = key * len(ids) + w[k:n + k], span * len(ids)
    order = np.argsort(key, kind="stable")
    twin = key[order[1:]] == key[order[:-1]]
    hit = np.zeros(n, bool)
    hit[order[1:][twin]] = True
    hit[order[:-1][twin]] = True
    covered = np.zeros(len(words), bool)
    for k in range(window):
        covered[k:n + k] |= hit
    return int(covered.sum())


# ---------------------------------------------------------------------- counts
def _codes(words: list[str], counts) -> tuple[np.ndarray, np.ndarray, np.ndarray, str]:
    """Code points of padded words, the places of their symbols, and weights."""
    pad = START * (ORDER - 1)
    flat = "".join(pad + w + END for w in words)
    code = np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + ORDER) - lengths - 1
    each = lengths + 1
    ends = np.cumsum(each)
    at = np.arange(int(ends[-1])) + np.repeat(starts - (ends - each), each)
    return code, at, np.repeat(np.asarray(counts), each), flat


def _hashes(code: np.ndarray, at: np.ndarray, back: int, n: int) -> np.ndarray:
    """Hash of the n symbols that end ``back`` before each place."""
    h = np.zeros(len(at), np.uint64)
    for k in range(n - 1, -1, -1):
        h = (h + code[at - back - k] + np.uint64(1)) * MIX
    return h ^ (h >> np.uint64(29))


def gram_hash(grams: list[str]) -> np.ndarray:
    """The same hash for given strings of one length."""
    if not grams or not grams[0]:
        return np.zeros(len(grams), np.uint64)
    code = np.frombuffer("".join(grams).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = len(grams[0])
    return _hashes(code, np.arange(n - 1, len(code), n), 0, n)


def top_grams(docs: DataFrame) -> DataFrame:
    """``(lang, gram, n)`` of every n-gram of the highest order, over all rows
    of ``docs(lang, text)``; each task adds up before the shuffle."""
    def flush(words: dict[str, Counter]):
        for lang, part in ((lang, part) for lang, c in words.items() for part in batched(c.items(), WORDS_AT_ONCE)):
            code, at, weight, flat = _codes(*zip(*part))
            _, first, inverse = np.unique(_hashes(code, at, 0, ORDER), return_index=True, return_inverse=True)
            n = np.bincount(inverse, weights=weight).astype(np.int64)
            grams = [flat[p - ORDER + 1:p + 1] for p in at[first].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n)), pa.array(grams), pa.array(n)], ["lang", "gram", "n"])

    def run(batches):
        words: dict[str, Counter] = {}
        for b in slices(batches, 1, 2_000_000):
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if text:
                    found = WORD.findall(text)
                    if found:
                        words.setdefault(lang, Counter()).update(found)
            if sum(map(len, words.values())) > FLUSH_WORDS:
                yield from flush(words)
                words = {}
        yield from flush(words)

    return docs.select("lang", "text").mapInArrow(run, "lang string, gram string, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def kneser_ney(top: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``grams(lang, k, gram, n, alpha)`` and ``contexts(lang, k, gram, n, gamma)``:
    p(symbol | context of length k-1) = alpha + gamma * p(symbol | shorter context)."""
    longer = (top.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(ORDER - 1))))
              .groupBy("lang", "k", F.expr(f"substring(gram, {ORDER} - k)").alias("g")).agg(F.sum("n").alias("n")))
    # Below the highest order a gram counts the symbols seen before it; one
    # that starts a word has nothing before it and keeps its own count.
    lower = longer.groupBy("lang", "k", F.expr("substring(g, 2)").alias("gram")).agg(F.sum("n").alias("s"), F.count(F.lit(1)).alias("c"))
    lower = lower.select("lang", "k", "gram", F.when(F.col("gram").startswith(START), F.col("s")).otherwise(F.col("c")).alias("n"))
    grams = cut_lineage(lower.unionByName(top.select("lang", F.lit(ORDER).alias("k"), "gram", "n")), "grams")

    def of(m):
        return F.sum((F.col("n") == m).cast("double")).alias(f"n{m}")
    d = grams.groupBy("lang", "k").agg(*(of(m) for m in (1, 2, 3, 4)))
    y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))
    for m, usual in ((1, 0.5), (2, 1.0), (3, 1.5)):     # usual: for too few counts
        value = m - (m + 1) * y * F.col(f"n{m + 1}") / F.nullif(F.col(f"n{m}"), F.lit(0.0))
        ok = (F.col("n1") > 0) & (value > 0)
        d = d.withColumn(f"d{m}", F.when(ok, value).otherwise(F.lit(usual)))
    d = cut_lineage(d.select("lang", "k", "d1", "d2", "d3"), "discounts")      # one row a language and order
    grams = cut_lineage(grams.join(d, ["lang", "k"]).withColumn(
        "d", F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3")))
        .select("lang", "k", "gram", F.expr("substring(gram, 1, k - 1)").alias("context"), "n", "d"), "discounted")
    mass = grams.groupBy("lang", "k", "context").agg(F.sum("n").alias("total"), F.sum("d").alias("kept_back"))
    mass = cut_lineage(mass, "mass")
    alpha = grams.join(mass, ["lang", "k", "context"]).select(
        "lang", "k", "gram", "n", (F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total")).alias("value"))
    gamma = mass.select("lang", "k", F.col("context").alias("gram"), F.col("total").alias("n"),
                        F.least(F.col("kept_back") / F.col("total"), F.lit(1.0)).alias("value"))
    return alpha, gamma


def _sorted_arrays(table: DataFrame, shift: int) -> dict:
    """``{(lang, k): (hashes, values)}`` of every row; ``shift``: the length of
    a gram is k minus it."""
    def run(batches):
        for b in batches:
            k = b.column(1).to_numpy(zero_copy_only=False)
            grams = b.column(2).to_pylist()
            h = np.zeros(len(grams), np.uint64)
            for n in np.unique(k[k > shift]):
                at = np.flatnonzero(k == n)
                h[at] = gram_hash([grams[i] for i in at])
            shard = (h >> np.uint64(64 - SHARD_BITS)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(shard), pa.array(h.view(np.int64)), b.column(3)],
                                             ["lang", "k", "shard", "h", "value"])
    hashed = table.select("lang", "k", "gram", "value").mapInArrow(run, "lang string, k int, shard int, h bigint, value double")

    def pack(key, t):
        h = t["h"].to_numpy().view(np.uint64)
        order = np.argsort(h)
        return pa.table({"lang": [key[0].as_py()], "k": pa.array([key[1].as_py()], pa.int32()), "shard": pa.array([key[2].as_py()], pa.int32()),
                         "hashes": [h[order].tobytes()], "probs": [t["value"].to_numpy()[order].astype(np.float32).tobytes()]})

    # one row a language, order and shard; shards are ranges of the hash
    rows = hashed.groupBy("lang", "k", "shard").applyInArrow(pack, "lang string, k int, shard int, hashes binary, probs binary").collect()
    parts: dict = {}
    for r in sorted(rows, key=lambda r: r["shard"]):
        parts.setdefault((r["lang"], r["k"]), []).append(r)
    return {key: (np.concatenate([np.frombuffer(r["hashes"], np.uint64) for r in found]),
                  np.concatenate([np.frombuffer(r["probs"], np.float32) for r in found])) for key, found in parts.items()}


# --------------------------------------------------------------------- scoring
def _look(table, h: np.ndarray, missing: float) -> np.ndarray:
    if table is None:
        return np.full(len(h), missing)
    keys, values = table
    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    return np.where(keys[at] == h, values[at], missing)


def symbol_logs(model: tuple[dict, dict], lang: str, code: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Natural log probability of the symbol at each place, given those before."""
    alpha, gamma = model
    p = np.full(len(at), 1.0 / 65536)
    for k in range(1, ORDER + 1):
        context = _hashes(code, at, 1, k - 1) if k > 1 else np.zeros(len(at), np.uint64)
        p = _look(alpha.get((lang, k)), _hashes(code, at, 0, k), 0.0) + _look(gamma.get((lang, k)), context, 1.0) * p
    return np.log(np.maximum(p, 1e-30))


def word_scores(model: tuple[dict, dict], lang: str, words: list[str], known: dict | None = None) -> np.ndarray:
    """Natural log probability of each word with its end.  Each distinct
    n-gram is looked up once; ``known`` keeps those of a language, sorted."""
    code, at, word, _ = _codes(words, range(len(words)))
    grams, first, inverse = np.unique(_hashes(code, at, 0, ORDER), return_index=True, return_inverse=True)
    keys, logs = (known or {}).get(lang, (np.zeros(0, np.uint64), np.zeros(0)))
    place = np.minimum(np.searchsorted(keys, grams), max(0, len(keys) - 1))
    seen = keys[place] == grams if len(keys) else np.zeros(len(grams), bool)
    out = np.zeros(len(grams))
    out[seen] = logs[place[seen]]
    out[~seen] = symbol_logs(model, lang, code, at[first[~seen]])
    if known is not None and not seen.all():
        if sum(len(k) for k, _ in known.values()) > KNOWN_GRAMS:
            known.clear()
            keys, logs = keys[:0], logs[:0]
        keys, logs = np.r_[keys, grams[~seen]], np.r_[logs, out[~seen]]
        order = np.argsort(keys, kind="stable")
        known[lang] = keys[order], logs[order]
    return np.bincount(word, weights=out[inverse], minlength=len(words))


class Scorer:
    """Word scores of one worker, kept up to a bound."""

    def __init__(self, model):
        self.model, self.seen, self.table, self.known = model, {}, {}, {}

    def total(self, lang: str, lists: list[list[str]]) -> list[float]:
        seen = self.seen.setdefault(lang, {})
        table = self.table.get(lang, np.zeros(0))
        if sum(map(len, self.seen.values())) > CACHE_WORDS:
            self.seen, self.table = {}, {}
            seen, table = self.seen.setdefault(lang, {}), np.zeros(0)
        known = len(seen)
        at = [[seen.setdefault(w, len(seen)) for w in words] for words in lists]
        if len(seen) > known:
            new = list(seen)[known:]
            parts = [word_scores(self.model, lang, new[k:k + WORDS_AT_ONCE], self.known) for k in range(0, len(new), WORDS_AT_ONCE)]
            table = np.concatenate([table, *parts])
            if any(len(w) > CACHE_CHARS * 1000 for w in new):     # do not hold on to huge words
                self.seen[lang] = {}
                self.table[lang] = np.zeros(0)
                return [float(table[a].sum()) for a in at]
        self.table[lang] = table
        return [float(table[a].sum()) if a else 0.0 for a in at]


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def gram_logs(alpha: DataFrame, gamma: DataFrame) -> DataFrame:
    """``(lang, gram, log)`` of every n-gram of the highest order.  The suffix
    and the context of an n-gram are rows too, so the joins lose none."""
    p = None
    for k in range(1, ORDER + 1):
        here = alpha.where(F.col("k") == k).select("lang", "gram", "value", F.expr(f"substring(gram, 1, {k - 1})").alias("context"),
                                                   F.expr("substring(gram, 2)").alias("shorter"))
        mass = gamma.where(F.col("k") == k).select("lang", F.col("gram").alias("context"), F.col("value").alias("gamma"))
        here = here.join(mass, ["lang", "context"])
        if p is None:
            here = here.withColumn("p", F.lit(1.0 / 65536))
        else:
            here = here.join(p.withColumnRenamed("gram", "shorter"), ["lang", "shorter"])
        p = cut_lineage(here.select("lang", "gram", (F.col("value") + F.col("gamma") * F.col("p")).alias("p")), "gram-p")
    return p.select("lang", "gram", F.log(F.greatest("p", F.lit(1e-30))).alias("log"))


def _scored_by_broadcast(rows: DataFrame, alpha: DataFrame, gamma: DataFrame) -> DataFrame:
    """``rows(id, lang, text)`` with counts and loss; the model is broadcast."""
    model = rows.sparkSession.sparkContext.broadcast((_sorted_arrays(alpha, 0), _sorted_arrays(gamma, 1)))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches):
        scorer = Scorer(model.value)
        for b in slices(batches, 2, 2_000_000):
            langs, lists, counts = b.column(1).to_pylist(), [], []
            for text in b.column(2).to_pylist():
                words, c = base_counts(text)
                lists.append(words)
                counts.append(c)
            score = np.zeros(len(lists))
            for one in sorted(set(langs)):
                at = [i for i, x in enumerate(langs) if x == one]
                score[at] = scorer.total(one, [lists[i] for i in at])
            symbols = np.array([c[1] + c[0] for c in counts], float)     # characters and word ends
            loss = np.where(symbols > 0, -score / np.maximum(symbols, 1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *(pa.array(x, pa.int64()) for x in zip(*counts)), pa.array(loss)],
                ["id", "model_lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "loss"])

    return rows.select("id", "lang", "text").mapInArrow(
        run, f"id {id_type}, model_lang string, n_words bigint, word_chars bigint, n_symbols bigint, "
             "n_dup_lines bigint, n_repeat_words bigint, loss double")

def _scored_by_join(rows: DataFrame, alpha: DataFrame, gamma: DataFrame) -> DataFrame:
    """The same from tables: documents coded by the words of their chunk, and
    the chunk's n-grams joined with their logs."""
    id_type = rows.schema["id"].dataType.simpleString()
    counts_type = ", ".join(f"{c} bigint" for c in COUNTS)

    def code(batches):
        for b in slices(batches, 2, CHUNK_CHARS):
            langs, texts = np.array([x.as_py() for x in b.column(1)], object), b.column(2)
            for one in sorted(set(langs)):
                at = np.flatnonzero(langs == one)
                chunk, ids, places, times, counts = uuid.uuid4().int >> 65, {}, [], [], []
                for i in at.tolist():
                    words, c = base_counts(texts[i].as_py())
                    found = Counter(ids.setdefault(w, len(ids)) for w in words)
                    places.append(np.fromiter(found.keys(), np.int32, len(found)).tobytes())
                    times.append(np.fromiter(found.values(), np.int32, len(found)).tobytes())
                    counts.append(c)
                extra = 1 if ids else 0                 # the row of the chunk's words
                none = [None] * extra
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk] * (len(at) + extra), pa.int64()), pa.array([one] * (len(at) + extra), pa.string()),
                     pa.concat_arrays([b.column(0).take(pa.array(at)), pa.nulls(extra, b.column(0).type)]),
                     *(pa.array([*x, *none], pa.int64()) for x in zip(*counts)), pa.array(places + none, pa.binary()), pa.array(times + none, pa.binary()),
                     pa.array([None] * len(at) + ["\n".join(ids)] * extra, pa.string())],
                    ["chunk", "model_lang", "id", *COUNTS, "places", "times", "words"])

    coded = cut_lineage(rows.select("id", "lang", "text").mapInArrow(
        code, f"chunk bigint, model_lang string, id {id_type}, {counts_type}, places binary, times binary, words string"), "coded")

    def spell(batches):
        for b in batches:
            for chunk, lang, words in zip(*(c.to_pylist() for c in b.columns)):
                for part in batched(words.split("\n"), WORDS_AT_ONCE):
                    flat_code, at, _, flat = _codes(part, range(len(part)))
                    h, first = np.unique(_hashes(flat_code, at, 0, ORDER), return_index=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([chunk] * len(h), pa.int64()), pa.array([lang] * len(h), pa.string()),
                         pa.array([flat[p - ORDER + 1:p + 1] for p in at[first].tolist()], pa.string()), pa.array(h.view(np.int64))],
                        ["chunk", "lang", "gram", "h"])

    needed = coded.where("words is not null").select("chunk", "model_lang", "words").mapInArrow(
        spell, "chunk bigint, lang string, gram string, h bigint")
    logs = needed.join(gram_logs(alpha, gamma), ["lang", "gram"]).select("chunk", "h", "log")

    def add(left, right):
        left = left.combine_chunks()
        is_words = left["words"].is_valid()
        docs, words = left.filter(pc.invert(is_words)), left["words"].filter(is_words).to_pylist()
        keys, first = np.unique(right["h"].to_numpy().view(np.uint64), return_index=True)
        values, scores = right["log"].to_numpy()[first], []
        for part in batched(words[0].split("\n") if words else [], WORDS_AT_ONCE):
            flat_code, at, word, _ = _codes(part, range(len(part)))
            found = _look((keys, values), _hashes(flat_code, at, 0, ORDER), np.nan)
            scores.append(np.bincount(word, weights=found, minlength=len(part)))
        score = np.concatenate([np.zeros(0), *scores])
        if np.isnan(score).any():
            raise ValueError("an n-gram of the corpus has no probability")
        total = np.array([score[np.frombuffer(p, np.int32)] @ np.frombuffer(t, np.int32) for p, t in zip(docs["places"].to_pylist(), docs["times"].to_pylist())], float)
        symbols = docs["word_chars"].to_numpy() + docs["n_words"].to_numpy()
        loss = np.where(symbols > 0, -total / np.maximum(symbols, 1), 0.0)
        return docs.select(["id", "model_lang", *COUNTS]).append_column("loss", pa.array(loss))

    return coded.groupBy("chunk").cogroup(logs.groupBy("chunk")).applyInArrow(
        add, f"id {id_type}, model_lang string, {counts_type}, loss double")


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            band: float = BAND) -> DataFrame:
    """One row a document: id, base counts, base_failed, kept, model_lang, perplexity."""
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(OTHERS))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), lang.alias("lang"))
    if MAX_LANGS is not None:
        common = [r[0] for r in docs.where(F.col(lang_col).isNotNull()).groupBy(lang.alias("l")).count()
                  .orderBy(F.desc("count"), "l").limit(MAX_LANGS).collect()]
        rows = rows.withColumn("lang", F.when(F.col("lang").isin(common), F.col("lang")).otherwise(F.lit(OTHERS)))
    top = cut_lineage(top_grams(rows.select("lang", "text")), "top-grams")
    alpha, gamma = (cut_lineage(t, "model") for t in kneser_ney(top))
    small = alpha.count() + gamma.count() <= MODEL_ENTRIES
    scored = (_scored_by_broadcast if small else _scored_by_join)(rows, alpha, gamma)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    scored = cut_lineage(scored.withColumn("base_failed", failed), "scored")
    bands = cut_lineage(bands_of(scored, band), "bands")                  # a row a language
    judged = scored.join(bands, "model_lang", "left")
    inside = F.coalesce(F.col("loss").between(F.col("low"), F.col("high")), F.lit(True))
    return judged.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", (~F.col("base_failed") & inside).alias("kept"), "model_lang",
                         F.exp("loss").alias("perplexity"))


def bands_of(scored: DataFrame, band: float, tail: float = TAIL) -> DataFrame:
    """``(model_lang, low, high)`` of the loss, from every document that passes
    the base rules; losses are counted in steps of 0.001 first.  The quantiles
    are exact: the first step that so many documents do not exceed."""
    steps = scored.where("not base_failed").groupBy("model_lang", F.round("loss", 3).alias("x")).agg(F.count(F.lit(1)).alias("rows"))
    steps = cut_lineage(steps, "loss-steps")
    order, total = Window.partitionBy("model_lang").orderBy("x"), Window.partitionBy("model_lang")
    steps = steps.withColumn("upto", F.sum("rows").over(order)).withColumn("all", F.sum("rows").over(total))

    def quantile(q):
        return F.min(F.when(F.col("upto") >= q * F.col("all"), F.col("x")))
    at = steps.groupBy("model_lang").agg(quantile(tail).alias("below"), quantile(0.5).alias("middle"), quantile(1 - tail).alias("above"))
    least = F.lit(LEAST_WIDTH)
    return at.select("model_lang", (F.col("middle") - band * F.greatest(F.col("middle") - F.col("below"), least)).alias("low"),
                     (F.col("middle") + band * F.greatest(F.col("above") - F.col("middle"), least)).alias("high"))
