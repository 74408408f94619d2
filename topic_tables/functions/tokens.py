"""Tokens of a column of texts in one go: what ``sources.tables.TOKEN_PATTERN``
and a lower-casing of each token give, without a row or a string per token."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa

# TOKEN_PATTERN in Python, where a word character is a letter, a digit of any kind or "_".
_TOKEN = re.compile(r"[^\W_]+")

# Of a UTF-8 byte: its lower case, whether it may stand in a token (1 or 0), and those that may not.
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_INSIDE = bytes(c >= 128 or chr(c).isalnum() for c in range(256))
_GAPS = bytes(c for c in range(256) if not _INSIDE[c])


def coded_tokens(text: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The tokens of an Arrow column of texts: (place of the text, code) of each
    token, and the distinct tokens.  ASCII is cut and lower-cased byte by byte;
    of runs with other characters each distinct one is taken once."""
    if not len(text) or text.null_count == len(text):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), pa.array([], pa.string())
    text = text.cast(pa.large_binary()).fill_null(b"")
    ends = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    data = memoryview(text.buffers()[2] or b"")[ends[0]:ends[-1]].tobytes()
    ends = ends - ends[0]
    inside = np.frombuffer(data.translate(_INSIDE), bool)
    cut = np.zeros(len(data) + 1, bool)
    cut[ends] = True                               # no run goes on in the next text
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:-1]
    last[:-1] &= ~inside[1:] | cut[1:-1]
    first = np.flatnonzero(first)
    offsets = np.r_[0, np.cumsum(np.flatnonzero(last) + 1 - first)]
    runs = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data.translate(_LOWER, _GAPS))])
    doc = np.repeat(np.arange(len(text)), np.diff(np.searchsorted(first, ends)))
    coded = runs.dictionary_encode()
    codes, distinct = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
    at = np.frombuffer(distinct.buffers()[1], np.int64)[distinct.offset:distinct.offset + len(distinct) + 1]
    wide = np.r_[0, np.cumsum(np.frombuffer(distinct.buffers()[2] or b"", np.uint8) >= 128)][at]
    other = wide[1:] > wide[:-1]
    plain = distinct.filter(pa.array(~other)).cast(pa.string())
    if not other.any():
        return doc, codes, plain
    found = b"\n".join(distinct.filter(pa.array(other)).to_pylist()).decode(errors="replace").split("\n")
    tokens = [[r.lower()] if r.isalnum() else [t.lower() for t in _TOKEN.findall(r)] for r in found]
    every = pa.concat_arrays([plain, pa.array([t for ts in tokens for t in ts], pa.string())]).dictionary_encode()
    sizes = np.ones(len(distinct), np.int64)        # tokens of a run, one behind the other in ``every``
    sizes[other] = [len(ts) for ts in tokens]
    starts = np.empty(len(distinct), np.int64)
    starts[~other] = np.arange(len(plain))
    starts[other] = len(plain) + np.cumsum(sizes[other]) - sizes[other]
    n = sizes[codes]
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(doc, n), every.indices.to_numpy()[np.repeat(starts[codes], n) + within].astype(np.int64), every.dictionary
