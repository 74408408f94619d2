"""Numbers in Arrow columns, and runs of document rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Pairs of document rows that walk the block files together.
PAIRS_A_WALK = 1 << 19


def _rows(col: pa.Array, width: int) -> np.ndarray:
    """Equal-length list column → matrix."""
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _lists(m: np.ndarray) -> pa.Array:
    n, width = m.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(np.ascontiguousarray(m).ravel()))


def _packed(values: np.ndarray, sizes: np.ndarray, kind=np.float64) -> pa.Array:
    """Runs of numbers → one binary value a run."""
    ends = np.r_[0, np.cumsum(sizes) * np.dtype(kind).itemsize].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values, kind))])


def _unpacked(col: pa.Array, kind=np.float64) -> np.ndarray:
    """What :func:`_packed` packed, as one array."""
    col = col.cast(pa.large_binary())
    ends = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    return np.frombuffer(memoryview(col.buffers()[2])[int(ends[0]):int(ends[-1])], kind)


def _walks(batches, pairs: int = PAIRS_A_WALK):
    """Document rows in runs of about so many pairs."""
    for batch in batches:
        sizes = batch.column(2).value_lengths().to_numpy(zero_copy_only=False) if batch.num_rows else np.zeros(0)
        run = (np.cumsum(sizes) - 1) // pairs
        cuts = np.r_[0, np.flatnonzero(np.diff(run)) + 1, batch.num_rows]
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if b > a:
                yield batch.slice(a, b - a)
