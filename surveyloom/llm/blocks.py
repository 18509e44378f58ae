"""Numpy columns packed in binary cells, so that a shuffle moves arrays and not rows."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

#: Where the C library can, it hands freed memory back.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Hand memory of freed arrays back to the system: a worker stays between tasks, beside the heap of its executor."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def lean_batches(f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``f`` for ``mapInArrow``, giving memory back at its end."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from f(rows)
        finally:
            give_back()

    return batches


def lean_group(f: Callable) -> Callable:
    """``f`` for ``applyInPandas``, giving memory back after each group."""

    def group(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        try:
            return f(key, rows)
        finally:
            give_back()

    return group


MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Scatters 64-bit numbers (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, lengths) of the runs of equal values."""
    if not len(sorted_values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))
    return starts, np.diff(np.append(starts, len(sorted_values)))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges [start, start + length), one range after the other."""
    if not len(lengths):
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(ends[-1]) - np.repeat(ends - lengths - starts, lengths)


def gaps(ascending: np.ndarray) -> bytes:
    """Ascending numbers from 0 on, a byte for each step; 255 carries on to the next byte."""
    steps = np.diff(ascending, prepend=0)
    more = steps // 255
    out = np.full(len(steps) + int(more.sum()), 255, np.uint8)
    out[np.cumsum(more + 1) - 1] = steps % 255
    return out.tobytes()


def from_gaps(raw: bytes) -> np.ndarray:
    steps = np.frombuffer(raw, np.uint8)
    return np.cumsum(steps, dtype=np.int64)[steps != 255]


def texts(batch_column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; a null is empty."""
    return [x or b"" for x in batch_column.cast(pa.binary()).to_pylist()]


def portions(sizes: list[int], most: int) -> Iterator[slice]:
    """Slices of consecutive items whose sizes add up to about ``most``."""
    start = held = 0
    for i, n in enumerate(sizes):
        held += n
        if held >= most:
            yield slice(start, i + 1)
            start, held = i + 1, 0
    if start < len(sizes):
        yield slice(start, len(sizes))
