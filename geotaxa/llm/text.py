"""Whole-text helpers shared by the operators of this subpackage.

Texts reach Python as Arrow batches.  The helpers work on the UTF-8 buffer of
a whole batch at once: words and gram hashes are numpy arrays over that
buffer, never per-row Python objects.  ``pieces`` cuts a batch into row ranges
of a few MB, so the arrays stay small; one text is never cut.

Null texts count as empty everywhere.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

PIECE_BYTES = 2 << 20

_U = np.uint64
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
# Any fixed odd base and any fixed byte values do; these come from one seed.
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, size=256, dtype=np.uint64)


class Local:
    """Holds what each task makes for itself: empty again when sent with code."""

    def __init__(self) -> None:
        self.value = None

    def __reduce__(self):
        return Local, ()


_powers = Local()


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers.value is None or len(_powers.value[0]) < n:
        out = []
        for base in (_BASE, _INVERSE):
            p = np.full(max(n, 1 << 16), base, dtype=_U)
            p[0] = 1
            out.append(np.cumprod(p, dtype=_U))
        _powers.value = (out[0], out[1])
    return _powers.value


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (shift, xor, multiply): every input bit reaches every output bit."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


def buffer_of(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(offsets, kind, n + 1, column.offset * kind().itemsize).astype(np.int64)
    buf = np.frombuffer(data, np.uint8, off[-1] - off[0], off[0]) if data is not None else np.zeros(0, np.uint8)
    return buf, off - off[0]


def pieces(buf: np.ndarray, off: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges (lo, hi, bytes, offsets) of about ``limit`` bytes, whole texts only."""
    gc.collect()  # tables that earlier tasks of this worker made for themselves
    n, lo = len(off) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def word_spans(buf: np.ndarray, off: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every run of non-separator bytes; words end with their text."""
    if len(buf) == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    word = ~space[buf]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    full = off[:-1] < off[1:]
    at = off[:-1][full]
    first[at] = word[at]
    at = off[1:][full] - 1
    last[at] = word[at]
    s = np.flatnonzero(first)
    e = np.flatnonzero(last) + 1
    return s, e, np.searchsorted(off[1:], s, "right")


class Spans:
    """64-bit hashes of byte ranges of one buffer, each in constant time."""

    def __init__(self, buf: np.ndarray):
        power, self.inverse = _power_tables(len(buf) + 1)
        self.sums = np.zeros(len(buf) + 1, _U)
        np.cumsum(_BYTE[buf] * power[:len(buf)], dtype=_U, out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.inverse[start]
        return mix(h + (end - start).astype(_U) * _U(0xD6E8FEB86659FD93))


def text_hash(words: np.ndarray, k: int, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles, row by row, and the row of each.  A row
    with 1 to k - 1 words has one shingle, its whole word sequence."""
    n = len(counts)
    begin = np.concatenate([[0], np.cumsum(counts)])
    size = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    row = np.repeat(np.arange(n), size)
    at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + begin[row]
    width = np.minimum(counts, k)[row]
    h = np.zeros(len(row), _U)
    for j in range(k):
        has = j < width
        w = words[np.where(has, at + j, 0)] if len(words) else h
        h = np.where(has, mix(h * _U(0x9E3779B97F4A7C15) + w + _U(j + 1)), h)
    return h, row


def hash_share(wanted: int, available: int):
    """True for about ``wanted`` of ``available`` rows, by a hash of the doc_id."""
    share = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(1 << 31)) / F.lit(float(1 << 31))
    return share < wanted / max(available, 1)


def hash_sample(rows, wanted: int, available: int):
    """About ``wanted`` of ``available`` rows (the same in every run), by a hash
    of the doc_id; twice as many is the bound."""
    return rows.where(hash_share(wanted, available)).limit(2 * wanted)


def read_documents(spark, sf_dir: str, *columns: str):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)
