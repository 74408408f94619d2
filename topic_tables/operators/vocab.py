"""Vocabulary and bags of words.

docs(row_id, name, tokens)  ──explode──▶  token rows (row_id, token)
token rows ──count──▶ token_counts(token, n) ──n > threshold──▶ pruned
pruned ──dense index in token order──▶ vocab(token, word_id, n)
token rows ⋈ vocab ──count per (row_id, word_id)──▶ bags(row_id, word_id, n)
"""

from __future__ import annotations

from dataclasses import dataclass

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from topic_tables.functions.tokens import coded_tokens
from topic_tables.operators.joins import broadcast_limit, hot_keys, lookup_join
from topic_tables.operators.phi_files import open_folder
from topic_tables.session import cut_lineage, default_partitions, release, write_bucketed


def token_rows(docs: DataFrame) -> DataFrame:
    """(row_id, token) for every token occurrence; accepts docs or token rows."""
    if "token" in docs.columns:
        return docs.select("row_id", "token")
    return docs.select("row_id", F.explode("tokens").alias("token"))


def token_counts(docs: DataFrame) -> DataFrame:
    """B1: total occurrences per token (partial aggregation on the map side)."""
    return token_rows(docs).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def prune(counts: DataFrame, rare_token_threshold: int = 2) -> DataFrame:
    """B2: keep tokens seen strictly more than ``rare_token_threshold`` times."""
    return counts.where(F.col("n") > F.lit(rare_token_threshold))


@dataclass
class Vocabulary:
    table: DataFrame       # token string, word_id int, n bigint
    size: int              # V
    token_bytes: int       # sum of token lengths in bytes, for broadcast size bounds
    occurrences: int = 0   # Σ n: in-vocabulary token occurrences of the corpus

    def side_bytes(self, per_row: int = 48) -> int:
        return self.token_bytes + per_row * self.size


def index_tokens(pruned: DataFrame, partitions: int | None = None) -> Vocabulary:
    """Dense ids 0..V-1 in token (binary) order, without a single-task sort.

    Range-partition by token and sort inside each partition, materialise once
    (so the sampled bounds and row positions are fixed), then add to each
    row's in-partition position the number of rows in earlier partitions.
    Only one (count, bytes) row per partition reaches the driver.
    """
    spark = pruned.sparkSession
    p = partitions or default_partitions(spark)
    ranged = cut_lineage(
        pruned.repartitionByRange(p, "token").sortWithinPartitions("token")
        .select("token", "n", F.spark_partition_id().alias("pid"),
                F.monotonically_increasing_id().alias("mid")))
    per_part = ranged.groupBy("pid").agg(F.count(F.lit(1)).alias("c"),
                                         F.sum(F.octet_length("token")).alias("b"),
                                         F.sum("n").alias("o")).collect()
    occurrences = sum((r["o"] or 0) for r in per_part)
    per_part = sorted((r["pid"], r["c"], r["b"] or 0) for r in per_part)
    offsets, run = [], 0
    for pid, c, _ in per_part:
        offsets.append((pid, run))
        run += c
    size, token_bytes = run, sum(b for _, _, b in per_part)
    off = spark.createDataFrame(offsets or [(0, 0)], "pid int, off bigint")
    local = F.col("mid") - F.shiftleft(F.col("pid").cast("bigint"), 33)
    # A projection of the materialised ranged table plus a P-row broadcast:
    # cheap to re-evaluate, so it is not written a second time.
    table = (ranged.join(F.broadcast(off), "pid")
             .select("token", (F.col("off") + local).cast("int").alias("word_id"), "n"))
    return Vocabulary(table, size, token_bytes, occurrences)


def build_vocab(docs: DataFrame, rare_token_threshold: int = 2, partitions: int | None = None) -> Vocabulary:
    return index_tokens(prune(token_counts(docs), rare_token_threshold), partitions)


# Size of one bag bucket: so many document-word pairs, and so many documents
# (a bucket's θ rows are the hash table of a join: 100,000 of K=100 are 80 MB).
PAIRS_PER_BUCKET = 4_000_000
DOCUMENTS_PER_BUCKET = 100_000
# A pass writes up to one row a word and bucket: a bucket holds so many pairs a
# word, that these rows grow no faster than the pairs, up to the most that the
# noise in the hash table of a robust pass (8 bytes a pair) leaves room for.
PAIRS_A_WORD = 16
MOST_PAIRS_PER_BUCKET = 16_000_000
# Small tables are spread over the cores only from so many pairs a bucket on.
PAIRS_TO_SPREAD = 20_000
# A document's pairs in one part, which is one list while the model is fitted.
PAIRS_PER_PART = 100_000
# Tokens that a task counts together, and pairs of a batch that it hands on.
TOKENS_AT_ONCE = 1 << 20
PAIRS_A_BATCH = 100_000
# Bytes of tokens whose sums a task holds before it hands them on.
SUMS_HELD = 64 << 20
# Between the tokens of a text where they are written as one string: never in a token.
GAP = "\n"


def bag_buckets(spark, pairs: int, documents: int, words: int = 0) -> int:
    """Bucket count of a bag table, from the documents being bagged and the
    words of the vocabulary."""
    def ceil(a, b):
        return -(-a // b)
    spread = min(spark.sparkContext.defaultParallelism, ceil(pairs, PAIRS_TO_SPREAD))
    full = max(PAIRS_PER_BUCKET, min(PAIRS_A_WORD * words, MOST_PAIRS_PER_BUCKET))
    return max(1, spread, ceil(pairs, full), ceil(documents, DOCUMENTS_PER_BUCKET))


def buckets_of(bags: DataFrame) -> int:
    """Bucket count of a table from :func:`to_bags` (kept beside it)."""
    return getattr(bags, "_tt_buckets", None) or default_partitions(bags.sparkSession)


def _runs_of(sizes: np.ndarray):
    """Documents in runs of about ``TOKENS_AT_ONCE``, as (first, end)."""
    run = np.cumsum(sizes) // TOKENS_AT_ONCE
    cuts = np.r_[0, np.flatnonzero(np.diff(run)) + 1, len(sizes)]
    return zip(cuts[:-1].tolist(), cuts[1:].tolist())


def _counted(doc: np.ndarray, codes: np.ndarray, width: int):
    """(document, code, n) of each distinct token of a document, in order."""
    key, n = np.unique(doc.astype(np.int64) * width + codes, return_counts=True)
    return key // width, key % width, n


def _counted_lists(part: pa.RecordBatch, sizes: np.ndarray):
    """The distinct tokens of each document of ``(row_id, tokens)``."""
    coded = part.column(1).flatten().dictionary_encode("encode")
    doc = np.repeat(np.arange(part.num_rows, dtype=np.int64), sizes)
    return *_counted(doc, coded.indices.to_numpy(zero_copy_only=False), max(len(coded.dictionary), 1)), coded.dictionary


def _token_counts_of(batches):
    """``(row_id, token, n, size)``: each distinct token of a document; ``size``
    is the document's number of them, on the first, and 0 on the others."""
    for batch in batches:
        sizes = pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
        for a, b in _runs_of(sizes):
            part = batch.slice(a, b - a)
            doc, code, n, dictionary = _counted_lists(part, sizes[a:b])
            first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, int)
            size = np.zeros(len(doc), np.int32)
            size[first] = np.diff(np.r_[first, len(doc)])
            for i in range(0, len(doc), PAIRS_A_BATCH):
                at = slice(i, i + PAIRS_A_BATCH)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(doc[at])), dictionary.take(pa.array(code[at])), pa.array(n[at]), pa.array(size[at])],
                    ["row_id", "token", "n", "size"])


def _list_rows(ids: pa.Array, doc: np.ndarray, *columns: pa.Array) -> list:
    """Flat values in the order of their documents → a row a document."""
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    ends = pa.array(np.r_[first, len(doc)].astype(np.int32))
    return [ids.take(pa.array(doc[first])), *(pa.ListArray.from_arrays(ends, c) for c in columns)]


def _added(runs: list) -> tuple[pa.Array, np.ndarray]:
    """The tokens of runs of (tokens, counts), each once, with their sums."""
    coded = pa.concat_arrays([tokens for tokens, _ in runs]).dictionary_encode("encode")
    n = np.bincount(coded.indices.to_numpy(zero_copy_only=False), np.concatenate([n for _, n in runs]), len(coded.dictionary))
    return coded.dictionary, n.astype(np.int64)


def _split(tokens: pa.Array) -> pa.Array:
    """Lists of tokens, of what :func:`_document_counts` wrote."""
    return tokens if pa.types.is_list(tokens.type) else pc.split_pattern(tokens, GAP)


def _token_lists(rows: DataFrame) -> DataFrame:
    """The same in Spark: the rows with ``tokens`` as an array."""
    return rows if rows.schema["tokens"].dataType.typeName() == "array" else rows.withColumn("tokens", F.split("tokens", GAP))


def _document_counts(batches, counted, joined: bool = False):
    """``(row_id, tokens, ns, sums)``: a row a document, of its distinct tokens,
    and (``sums``) the tokens of the task's documents, added up while they take
    ``SUMS_HELD``, as lists of at most ``PAIRS_A_BATCH`` without a row id.  The
    tokens of a row are one string, ``joined`` by ``GAP``, where none holds it."""
    names = ["row_id", "tokens", "ns", "sums"]

    def written(lists):
        return pc.binary_join(lists, GAP) if joined else lists

    def sum_rows(kind, tokens, total):
        for i in range(0, len(total), PAIRS_A_BATCH):
            part = total[i:i + PAIRS_A_BATCH]
            ends = pa.array([0, len(part)], pa.int32())
            words, ns = (pa.ListArray.from_arrays(ends, c) for c in (tokens.slice(i, len(part)), pa.array(part)))
            yield pa.RecordBatch.from_arrays([pa.nulls(1, kind), written(words), ns, pa.array([True])], names)

    held, kind = [], None
    for batch in batches:
        kind = batch.column(0).type
        for ids, doc, code, n, dictionary in counted(batch):
            if not len(doc):
                continue
            own, words, ns = _list_rows(ids, doc, dictionary.take(pa.array(code)), pa.array(n.astype(np.int64)))
            yield pa.RecordBatch.from_arrays([own, written(words), ns, pa.array(np.zeros(len(own), bool))], names)
            held.append((dictionary, np.bincount(code, n, len(dictionary)).astype(np.int64)))
            if dictionary.nbytes > SUMS_HELD:
                yield from sum_rows(kind, *held.pop())
            elif sum(d.nbytes for d, _ in held) > SUMS_HELD:
                held = [_added(held)]
                if 2 * held[0][0].nbytes > SUMS_HELD:
                    yield from sum_rows(kind, *held.pop())
    if held:
        yield from sum_rows(kind, *_added(held))


def _of_lists(batch: pa.RecordBatch):
    sizes = pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    for a, b in _runs_of(sizes):
        part = batch.slice(a, b - a)
        yield part.column(0), *_counted_lists(part, sizes[a:b])


def _of_texts(batch: pa.RecordBatch):
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    for a, b in _runs_of(sizes // 6):           # a token and the gap behind it
        part = batch.slice(a, b - a)
        doc, codes, dictionary = coded_tokens(part.column(1))
        yield part.column(0), *_counted(doc, codes, max(len(dictionary), 1)), dictionary


def _token_sums(batches):
    """``(token, n)`` of lists of tokens, added up over each batch."""
    for b in batches:
        coded = _split(b.column(0)).flatten().dictionary_encode("encode")
        if len(coded):
            n = np.bincount(coded.indices.to_numpy(zero_copy_only=False), b.column(1).flatten().to_numpy(zero_copy_only=False), len(coded.dictionary))
            yield pa.RecordBatch.from_arrays([coded.dictionary, pa.array(n.astype(np.int64))], ["token", "n"])


@dataclass
class RawPairs:
    """Written token counts of documents, in vocabulary or not."""

    table: DataFrame       # row_id, tokens, ns (a row of the documents each; an id may stand on several) or row_id, token, n
    pairs: int             # tokens, distinct in a row
    documents: int         # rows (or, of pairs, about the ids) that have a token
    sums: DataFrame | None = None   # tokens, ns: added up over runs of documents
    written: DataFrame | None = None    # table and sums as they are written, with the flag ``sums``

    @property
    def listed(self) -> bool:
        return "tokens" in self.table.columns

    @property
    def rows(self) -> DataFrame:
        """The documents' rows as they are written."""
        return self.table if self.written is None else self.written.where(~F.col("sums")).drop("sums")

    def by_document(self) -> DataFrame:
        """(row_id, rows, w): the rows an id stands on, and its pairs."""
        if self.listed:
            return self.rows.groupBy("row_id").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size("ns")).alias("w"))
        return self.table.groupBy("row_id").agg(F.lit(1).cast("bigint").alias("rows"), F.count(F.lit(1)).alias("w"))

    def token_sums(self) -> DataFrame:
        """(token, n), in partial sums."""
        if self.listed:
            return self.written.where("sums").select("tokens", "ns").mapInArrow(_token_sums, "token string, n bigint")
        return self.table.select("token", "n")


def raw_pairs(docs: DataFrame) -> RawPairs:
    """One pass over the text.  Documents are counted where their row is, from
    their text where the documents come from :func:`tokens_from_text`, so no
    token is a row, shuffled or hashed in the JVM; token rows are grouped."""
    obs = Observation(f"raw-{uuid.uuid4().hex[:8]}")
    if "token" in docs.columns:
        raw = token_rows(docs).groupBy("row_id", "token").agg(F.count(F.lit(1)).alias("n"))
        pairs, documents = F.count(F.lit(1)), F.approx_count_distinct("row_id")
    else:
        text = getattr(docs, "_tt_text", None)
        source, counted = (docs.select("row_id", "tokens"), _of_lists) if text is None else (text, _of_texts)
        joined = text is not None          # GAP stands in no token that is cut from a text
        schema = f"row_id {docs.schema['row_id'].dataType.simpleString()}, tokens {'string' if joined else 'array<string>'}, ns array<bigint>, sums boolean"
        raw = source.mapInArrow(lambda batches: _document_counts(batches, counted, joined), schema)
        pairs, documents = F.sum(F.when(~F.col("sums"), F.size("ns"))), F.count(F.when(~F.col("sums"), 1))
    raw = raw.observe(obs, pairs.alias("c"), documents.alias("d"))
    raw._tt_flag = "sums" if "sums" in raw.columns else None
    raw = cut_lineage(raw, "rawpairs")
    table, sums, written = raw, None, None
    if "sums" in raw.columns:
        lists, written = _token_lists(raw), raw
        table, sums = lists.where(~F.col("sums")).drop("sums"), lists.where("sums").select("tokens", "ns")
        table._tt_path = raw._tt_path
    return RawPairs(table, obs.get.get("c") or 0, obs.get.get("d") or 0, sums, written)


def to_bags(docs: DataFrame, vocab: Vocabulary, partitions: int | None = None, materialise: bool = True) -> DataFrame:
    """Drop out-of-vocabulary tokens and count each (document, word).

    Result: ``bags(row_id, part, word_id, n)``, the pairs of a parquet table
    ``(row_id, part, words, ns)`` (kept beside it) that is bucketed by (row_id,
    part) under the checkpoint folder, so every EM step joins θ and aggregates
    per document without moving the pairs.

    * The vocabulary lookup is made in the tasks, from a file of the
      vocabulary, when its size bound allows, else by a salted shuffle join.
    * A document is counted where its row is; counts of an id that stands on
      several rows are added up.
    * A document with more pairs than an average bucket (or a list should
      hold) is split into parts by hashing the word; all others have part 0.
    * The number of buckets comes from the pairs and documents found here.
    """
    if not materialise:
        joined = _known(token_rows(docs), vocab, partitions)
        pairs = joined.groupBy("row_id", "word_id").agg(F.count(F.lit(1)).cast("double").alias("n"))
        return pairs.select("row_id", F.lit(0).alias("part"), "word_id", "n")
    raw = raw_pairs(docs)
    out = bucket_pairs(raw, vocab, partitions)
    release(raw.table)
    return out


def rows_of(bags: DataFrame) -> DataFrame | None:
    """``(row_id, part, words, ns)`` that the bags of :func:`to_bags` are the pairs of."""
    return getattr(bags, "_tt_rows", None)


def pairs_of(rows: DataFrame, like: DataFrame) -> DataFrame:
    """The bags of document rows, with the rows beside them; ``like`` is the
    bucketed table that the rows are, or are taken from."""
    out = rows.select("row_id", "part", F.explode(F.arrays_zip("words", "ns")).alias("w")).select(
        "row_id", "part", F.col("w.words").alias("word_id"), F.col("w.ns").alias("n"))
    out._tt_rows, out._tt_buckets, out._tt_stored = rows, like._tt_buckets, rows is like
    return out


def _lists_of(pairs: DataFrame) -> DataFrame:
    lists = pairs.groupBy("row_id", "part").agg(F.array_sort(F.collect_list(F.struct("word_id", "n"))).alias("ws"))
    return lists.select("row_id", "part", F.col("ws.word_id").alias("words"), F.col("ws.n").alias("ns"))


class _Words:
    """The vocabulary's tokens and ids, read by a task from their file."""

    _held: tuple = (None, None, None)

    def __init__(self, uri: str):
        self.uri = uri

    def arrays(self):
        if _Words._held[0] != self.uri:
            fs, base, _ = open_folder(self.uri)
            names = sorted(i.path for i in fs.get_file_info(pafs.FileSelector(base)) if i.path.endswith(".parquet"))
            table = pa.concat_tables([pq.read_table(name, columns=["token", "word_id"], filesystem=fs) for name in names])
            _Words._held = (self.uri, table["token"].cast(pa.string()).combine_chunks(), table["word_id"].to_numpy())
        return _Words._held[1:]


def _known_lists(batches, vocabulary: _Words):
    """Document rows of tokens → document rows of the ids of known words."""
    for b in batches:
        if not b.num_rows:
            continue
        tokens, ids = vocabulary.arrays()
        lists = _split(b.column(1))
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        coded = lists.flatten().dictionary_encode("encode")
        place = pc.index_in(coded.dictionary.cast(pa.string()), value_set=tokens).to_numpy(zero_copy_only=False)
        known = np.isfinite(place.astype(float))
        word = np.full(len(place), -1, np.int64)
        word[known] = ids[place[known].astype(np.int64)]
        words = word[coded.indices.to_numpy(zero_copy_only=False)]
        doc = np.repeat(np.arange(b.num_rows, dtype=np.int64), sizes)
        at = np.flatnonzero(words >= 0)
        if len(at):
            at = at[np.argsort(doc[at] * (int(ids.max()) + 1) + words[at], kind="stable")]
            rows = _list_rows(b.column(0), doc[at], pa.array(words[at].astype(np.int32)), pa.array(b.column(2).flatten().to_numpy(zero_copy_only=False)[at].astype(float)))
            yield pa.RecordBatch.from_arrays(rows, ["row_id", "words", "ns"])


def _known(rows: DataFrame, vocab: Vocabulary, partitions: int | None) -> DataFrame:
    """Token rows of known tokens, with their word ids."""
    spark = rows.sparkSession
    hot = None
    if vocab.side_bytes() > broadcast_limit(spark):
        # Only the shuffle fallback needs the frequent-token list.
        hot = hot_keys(vocab.table, "token", "n", partitions or default_partitions(spark))
    return lookup_join(rows, vocab.table.select("token", "word_id"), "token", vocab.side_bytes(), spread_col="row_id", hot=hot)


def bucket_pairs(raw: RawPairs, vocab: Vocabulary, p: int | None = None) -> DataFrame:
    """Token counts → the bag table bucketed by (row_id, part).

    A document's words are looked up where its row is.  Only ids that stand on
    several rows, or may have more pairs than a bucket's share or a list should
    hold, are taken apart first: their counts are added up, and the large ones
    are spread over parts by hashing the word."""
    spark = raw.table.sparkSession
    p = p or bag_buckets(spark, raw.pairs, raw.documents, vocab.size)
    forced = spark.conf.get("topic_tables.documentPartRows", None)
    share = float(forced) if forced else min(max(float(raw.pairs) / p, 1000.0), float(PAIRS_PER_PART))
    seen = Observation(f"apart-{uuid.uuid4().hex[:8]}")
    apart = cut_lineage(raw.by_document().where((F.col("rows") > 1) | (F.col("w") > F.lit(share))).select(F.col("row_id").alias("id"))
                        .observe(seen, F.count(F.lit(1)).alias("c")), "apart")
    n_apart, n_hot, scratch = seen.get.get("c") or 0, 0, [apart]
    beside = raw.listed and vocab.side_bytes() <= broadcast_limit(spark)
    if beside:
        scratch.append(cut_lineage(vocab.table.select("token", "word_id"), "words"))
        words = _Words(scratch[-1]._tt_path)

    def pairs(rows: DataFrame) -> DataFrame:
        if raw.listed:
            rows = _token_lists(rows).select("row_id", F.explode(F.arrays_zip("tokens", "ns")).alias("t")).select("row_id", F.col("t.tokens").alias("token"), F.col("t.ns").alias("n"))
        return _known(rows.select("row_id", "token", "n"), vocab, p).select("row_id", "word_id", F.col("n").cast("double").alias("n"))

    def lists(rows: DataFrame) -> DataFrame:
        if not beside:
            return _lists_of(pairs(rows).withColumn("part", F.lit(0)).repartition(p, "row_id", "part"))
        schema = f"row_id {rows.schema['row_id'].dataType.simpleString()}, words array<int>, ns array<double>"
        found = rows.select("row_id", "tokens", "ns").mapInArrow(lambda batches: _known_lists(batches, words), schema)
        return found.select("row_id", F.lit(0).alias("part"), "words", "ns")
    if n_apart:
        ids = F.broadcast(apart) if n_apart * 32 <= broadcast_limit(spark) else apart
        same = F.col("row_id").eqNullSafe(F.col("id"))
        added = cut_lineage(pairs(raw.rows.join(ids, same, "left_semi")).groupBy("row_id", "word_id").agg(F.sum("n").alias("n")), "added")
        counted = Observation(f"hot-{uuid.uuid4().hex[:8]}")
        hot = cut_lineage(added.groupBy(F.col("row_id").alias("id")).agg(F.count(F.lit(1)).alias("w")).where(F.col("w") > F.lit(share))
                          .select("id", F.ceil(F.col("w") / F.lit(share)).cast("int").alias("salts"))
                          .observe(counted, F.count(F.lit(1)).alias("n_hot")), "hotdocs")
        n_hot = counted.get.get("n_hot") or 0
        scratch += [added, hot]
        part = F.when(F.col("salts").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(F.col("word_id")), F.col("salts")).cast("int"))
        some = added.join(F.broadcast(hot) if n_hot * 32 <= broadcast_limit(spark) else hot, same, "left").select("row_id", part.alias("part"), "word_id", "n")
        src = lists(raw.rows.join(ids, same, "left_anti")).unionByName(_lists_of(some))
    else:
        src = lists(raw.rows)
    rows = write_bucketed(src, ["row_id", "part"], p, "bags")
    out = pairs_of(rows, rows)
    out._tt_path, out._tt_table, out._tt_split = rows._tt_path, rows._tt_table, n_hot > 0
    for table in scratch:
        release(table)
    return out


def build_corpus(docs: DataFrame, rare_token_threshold: int = 2,
                 partitions: int | None = None) -> tuple[Vocabulary, DataFrame, DataFrame]:
    """B1–B4 with one pass over the text: (vocabulary, bags, token_counts).

    The documents are tokenised once into counts of their tokens, where their
    rows are, and written; token counts, the vocabulary and the bucketed bags
    are all derived from that pair table, so the tokeniser never runs twice
    over the corpus.
    """
    raw = raw_pairs(docs)
    counts = cut_lineage(raw.token_sums().groupBy("token").agg(F.sum("n").cast("bigint").alias("n")), "tokencounts")
    vocab = index_tokens(prune(counts, rare_token_threshold), partitions)
    bags = bucket_pairs(raw, vocab, partitions)
    release(raw.table)
    return vocab, bags, counts


def corpus_stats(bags: DataFrame) -> DataFrame:
    """Vocabulary actually used, documents, pairs, collection length.
    Words and documents are grouped apart, so no pair is copied for a count."""
    words = bags.groupBy("word_id").agg(F.count(F.lit(1)).alias("pairs"), F.sum("n").alias("length")).agg(
        F.count("word_id").alias("n_words"), F.coalesce(F.sum("pairs"), F.lit(0)).alias("n_pairs"), F.sum("length").alias("collection_length"))
    documents = bags.groupBy("row_id").agg(F.lit(1).alias("one")).agg(F.count("row_id").alias("n_docs"))
    return words.crossJoin(documents).select("n_words", "n_docs", "n_pairs", "collection_length")
