"""Byte-level BPE encoding and decoding in batched numpy merge rounds.

A batch of texts is cut into pre-tokens; its distinct pre-tokens lie as byte
symbols one after the other in one flat array.  Each round looks up every
adjacent pair by binary search over the sorted pair keys, takes the
lowest rank of each word, and merges that pair wherever it stands in the word.
Words without a mergeable pair leave the array, so rounds shrink.  A round looks
at a whole word for one rank, so a word of more than ``LONG`` bytes takes its
merges from a queue of ranks instead; the result is the same.

Rows: a null text counts as the empty text (no tokens).  Equal rows give equal
rows; an empty table gives an empty table.  Columns other than id and text are
not read, so their names cannot clash.
"""

from __future__ import annotations

import heapq
import json
from functools import lru_cache
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topic_tables.llm.text import gather_ranges, slices

#: A Python worker forgets its merged pre-tokens beyond either bound.
CACHE_WORDS = 200_000
CACHE_CHARS = 4_000_000
#: Words of more bytes are merged from a queue.
LONG = 2000
FAR = np.int64(1) << 40


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in the vocabulary
    file: itself for printable Latin-1, else the next one from U+0100 on."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    chars, extra = {b: chr(b) for b in keep}, 0x100
    for b in range(256):
        if b not in chars:
            chars[b], extra = chr(extra), extra + 1
    return [chars[b] for b in range(256)]


class ByteBpe:
    """Encoder and decoder of one vocabulary file (``tokenizers`` JSON)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        chars = byte_chars()
        to_byte = {c: b for b, c in enumerate(chars)}
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int32)
        order = np.argsort(left << 32 | right, kind="stable")
        self.keys = (left << 32 | right)[order]
        self.ranks, self.made = order.astype(np.int64), made[order]
        self.byte_ids = np.array([vocab[c] for c in chars], np.int32)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        pieces = {i: bytes(to_byte[c] for c in t) for t, i in vocab.items()}
        pieces |= {i: t.encode() for t, i in self.special.items()}
        table = [pieces.get(i, b"") for i in range(max(pieces) + 1)]
        self.piece_len = np.array([len(p) for p in table], np.int64)
        self.piece_at = np.cumsum(self.piece_len) - self.piece_len
        self.piece_bytes = np.frombuffer(b"".join(table), np.uint8)
        self.split = regex.compile(public_tokenizers.PATTERN)
        self.special_split = (regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
                              if self.special else None)
        self.by_pair: dict | None = None
        self.forget()

    def forget(self) -> None:
        """Empty the memory of merged pre-tokens."""
        self.seen: dict[str, int] = {}
        self.seen_chars = 0
        self.flat, self.counts = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def merge_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one flat array, and the number for each word."""
        long = [i for i, w in enumerate(words) if len(w) > LONG]
        if long:
            flat, counts = self.merge_words([b"" if len(w) > LONG else w for w in words])
            parts = np.split(flat, np.cumsum(counts)[:-1])
            for i in long:
                parts[i] = self.merge_long(words[i])
            return np.concatenate(parts), np.array([len(p) for p in parts])
        sizes = np.array([len(w) for w in words], np.int64)
        sym = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym) > 1:
            inside = word[:-1] == word[1:]
            key = sym[:-1].astype(np.int64) << 32 | sym[1:]
            at = np.searchsorted(self.keys, key)
            at[at == len(self.keys)] = 0
            rank = np.where(inside & (self.keys[at] == key), self.ranks[at], FAR)
            heads = np.flatnonzero(np.r_[True, ~inside])        # first symbol of each word left
            low = np.minimum.reduceat(np.r_[rank, FAR], heads)  # a word's last symbol pairs with nothing
            lengths = np.diff(np.r_[heads, len(sym)])
            low_here = np.repeat(low, lengths)
            active = low_here < FAR
            if not active.any():
                break
            hit = (rank == low_here[:-1]) & active[:-1]
            # Equal symbols in a row: every other hit counts, from the left.
            index = np.arange(len(hit))
            fresh = hit & ~np.r_[False, hit[:-1]]
            since = np.maximum.accumulate(np.where(fresh, index, 0))
            hit &= ((index - since) & 1) == 0
            sym = sym.copy()
            chosen = np.flatnonzero(hit)
            sym[chosen] = self.made[at[chosen]]
            keep = np.ones(len(sym), bool)
            keep[chosen + 1] = False
            idle = keep & ~active
            if idle.any():
                done.append((word[idle], sym[idle]))
            keep &= active
            sym, word = sym[keep], word[keep]
        done.append((word, sym))
        word = np.concatenate([w for w, _ in done])
        sym = np.concatenate([s for _, s in done])
        order = np.argsort(word, kind="stable")
        return sym[order], np.bincount(word, minlength=len(words))

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged symbol) of pairs of symbols."""
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], FAR), self.made[at]

    def merge_long(self, word: bytes) -> np.ndarray:
        """Ids of one word: the pair of the lowest rank, the leftmost of equal
        ones, is merged until none is left."""
        sym = self.byte_ids[np.frombuffer(word, np.uint8)]
        if self.by_pair is None:
            self.by_pair = dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.made.tolist())))
        ranks, _ = self.pairs(sym[:-1], sym[1:])
        at = np.flatnonzero(ranks < FAR)
        queue = list(zip(ranks[at].tolist(), at.tolist(), sym[at].tolist(), sym[at + 1].tolist()))
        heapq.heapify(queue)
        n = len(sym)
        sym, after, before = sym.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        while queue:
            _, i, a, b = heapq.heappop(queue)
            j = after[i]
            if sym[i] != a or j >= n or sym[j] != b:
                continue                       # one of them was merged meanwhile
            sym[i], sym[j] = self.by_pair[a << 32 | b][1], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for x, y in ((before[i], i), (i, k)):
                if x >= 0 and y < n:
                    found = self.by_pair.get(sym[x] << 32 | sym[y])
                    if found:
                        heapq.heappush(queue, (found[0], x, sym[x], sym[y]))
        return np.array([s for s in sym if s >= 0], np.int32)

    def encode(self, texts: list[str | None], special: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and the number of ids of each text.  With ``special`` the
        strings of added tokens become their ids, else they are plain text."""
        if len(self.seen) > CACHE_WORDS or self.seen_chars > CACHE_CHARS:
            self.forget()
        seen, known = self.seen, len(self.seen)
        order: list[int] = []
        per_text = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            before = len(order)
            parts = self.special_split.split(text) if special and text and self.special_split else [text or ""]
            for j, part in enumerate(parts):
                if j % 2:
                    order.append(-1 - self.special[part])
                elif part:
                    order += [seen.setdefault(w, len(seen)) for w in self.split.findall(part)]
            per_text[i] = len(order) - before
        if len(seen) > known:
            new = [w.encode("utf-8", "surrogatepass") for w in islice(seen, known, None)]
            flat, counts = self.merge_words(new)
            self.seen_chars += sum(map(len, new))
            self.flat, self.counts = np.r_[self.flat, flat], np.r_[self.counts, counts]
        at = np.array(order, np.int64)
        extra = np.unique(at[at < 0])
        flat, lengths = np.r_[self.flat, (-1 - extra).astype(np.int32)], np.r_[self.counts, np.ones(len(extra), np.int64)]
        at[at < 0] = len(seen) + np.searchsorted(extra, at[at < 0])
        if not len(at):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        starts = np.cumsum(lengths) - lengths
        ids = flat[gather_ranges(starts[at], lengths[at])]
        cuts = np.r_[0, np.cumsum(lengths[at])][np.r_[0, np.cumsum(per_text)]]
        return ids.astype(np.int32), np.diff(cuts)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The text of each run of ids."""
        lengths = self.piece_len[ids]
        data = self.piece_bytes[gather_ranges(self.piece_at[ids], lengths)].tobytes()
        cuts = np.r_[0, np.cumsum(lengths)][np.r_[0, np.cumsum(counts)]]
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=2)
def codec(path: str) -> ByteBpe:
    return ByteBpe(path)


def _list(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(ids))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
           special: bool = True) -> DataFrame:
    """``(id, ids array<int>)`` of every row; no shuffle."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        bpe = codec(path)
        for b in slices(batches, 1):
            ids, counts = bpe.encode(b.column(1).to_pylist(), special)
            yield pa.RecordBatch.from_arrays([b.column(0), _list(ids, counts)], ["id", "ids"])

    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"id {id_type}, ids array<int>").withColumnRenamed("id", id_col))


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", special: bool = True) -> DataFrame:
    """``(id, ids, decoded)`` of every row: encoded, and decoded from the ids,
    in one pass, so that a task needs one Python worker."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        bpe = codec(path)
        for b in slices(batches, 1):
            ids, counts = bpe.encode(b.column(1).to_pylist(), special)
            text = bpe.decode(ids.astype(np.int64), counts)
            yield pa.RecordBatch.from_arrays([b.column(0), _list(ids, counts), pa.array(text, pa.string())], ["id", "ids", "decoded"])

    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"id {id_type}, ids array<int>, decoded string").withColumnRenamed("id", id_col))


def decode(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id, ids, decoded)``: the text of every row's ids (null ids: empty)."""
    id_type = tokens.schema[id_col].dataType.simpleString()

    def run(batches):
        bpe = codec(path)
        for batch in batches:
            for b in (batch.slice(k, 500) for k in range(0, batch.num_rows, 500)):
                col = b.column(1)
                counts = np.array([len(x) if x is not None else 0 for x in col], np.int64)
                text = bpe.decode(col.flatten().to_numpy(zero_copy_only=False).astype(np.int64), counts)
                yield pa.RecordBatch.from_arrays([b.column(0), col, pa.array(text, pa.string())],
                                                 ["id", "ids", "decoded"])

    return (tokens.select(F.col(id_col).alias("id"), F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("ids"))
            .mapInArrow(run, f"id {id_type}, ids array<int>, decoded string").withColumnRenamed("id", id_col))


def digests(decoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Token number and SHA-256 digests of the ids and of the decoded text."""
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded.select(id_col, F.size("ids").cast("bigint").alias("n_tokens"),
                          F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
