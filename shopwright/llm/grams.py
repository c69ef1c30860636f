"""Words and word n-grams of whole Arrow batches as 64-bit hashes, without a loop per text.

All arithmetic is modulo 2^64. A word's hash is a polynomial over randomised
bytes, taken from one running sum over the batch; it does not depend on where
the word stands.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

BATCH_ROWS = 512
SLICE_BYTES = 1_000_000
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_ALL = np.arange(256)
SPACE_WORD = ~(((_ALL >= 9) & (_ALL <= 13)) | (_ALL == 32))
ALNUM_WORD = (
    ((_ALL >= 48) & (_ALL <= 57)) | ((_ALL >= 65) & (_ALL <= 90)) | ((_ALL >= 97) & (_ALL <= 122)) | (_ALL >= 128)
)
LOWER = np.where((_ALL >= 65) & (_ALL <= 90), _ALL + 32, _ALL).astype(np.uint8)

_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Jobs inside send at most ``rows`` rows at once to Python; the setting then goes back.

    Rows hold whole texts or whole sets, so Spark's 10,000 would fill both sides of the pipe.
    Only jobs that run inside are affected, and results do not depend on it.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def give_back() -> None:
    """Return freed memory to the system, as Python workers live on for later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        made = []
        for base in (_BASE, _BASE_INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            made.append(np.cumprod(steps, dtype=np.uint64))
        _powers = (made[0], made[1])
    return _powers


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """The words of some consecutive texts.

    ``data`` is the lower-cased text, ``start`` and ``end`` the words' byte
    places in it, ``first`` the number of the first word of every text plus the
    total at the end, ``hashes`` one hash per word.
    """

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    def string(self, lo: int, hi: int) -> bytes:
        """Words lo to hi - 1, with single spaces."""
        return b" ".join(self.data[self.start[i] : self.end[i]].tobytes() for i in range(lo, hi))


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> Words:
    """Words of the texts data[offsets[i]:offsets[i + 1]]; offsets start at 0."""
    n = len(data)
    data = LOWER[data]
    inside = is_word[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < n]
    begins[heads] = inside[heads]
    ends = np.zeros(n, bool)
    if n:
        ends[:-1] = inside[:-1] & (~inside[1:] | begins[1:])
        ends[-1] = inside[-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = _power_tables(n + 1)
    running = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[data] * up[:n], out=running[1:])
    hashes = mixed((running[end] - running[start]) * down[start] + (end - start).astype(np.uint64))
    return Words(data, start, end, np.searchsorted(start, offsets), hashes)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """One hash per place where n words stand in a row, texts' ends ignored."""
    count = max(0, len(hashes) - n + 1)
    out = np.full(count, n, np.uint64)
    for i in range(n):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[i : i + count]
    return mixed(out)


def slices(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of consecutive runs of texts.

    A run has about SLICE_BYTES or a single text; nulls count as empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    if not len(column):
        return
    _, ends, body = column.buffers()
    offsets = np.frombuffer(ends, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + SLICE_BYTES, "right")) - 1)
        hi = min(hi, len(column))
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi
