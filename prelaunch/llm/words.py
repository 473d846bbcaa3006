"""Vectorised words and word shingles of Arrow string columns.

A batch's UTF-8 buffer is read as one numpy byte array. Words are runs of
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z are lower-cased (ASCII letters, ASCII digits and every
non-ASCII character); they never cross a row. A word is identified by a 64-bit polynomial hash of its bytes, so no
Python object is made per word. Work goes in slices of at most ``SLICE_BYTES`` of text (a longer single text is one
slice), which bounds memory whatever the batch size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

SLICE_BYTES = 1 << 20
BATCH_BYTES = 8 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, with the session's Arrow batches limited to ``BATCH_BYTES``: long texts by the ten thousand would fill a
    Python worker. A smaller setting stays."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(re.sub(r"\D", "", conf.get(key)) or 0) > BATCH_BYTES or re.search("[kmgt]", conf.get(key), re.I):
        conf.set(key, str(BATCH_BYTES))
    return df


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of uint64 values (public splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def _fold() -> np.ndarray:
    """Byte -> lower-cased byte of a word, 0 for what separates words."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    keep = np.zeros(256, bool)
    keep[48:58] = keep[97:123] = keep[128:] = True
    keep[65:91] = True
    t[~keep] = 0
    return t


FOLD = _fold()
VALUE = _byte_values()
_POW = np.ones(1, np.uint64)
_INV = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n at least."""
    global _POW, _INV
    if len(_POW) < n:
        size = max(n, 1 << 16)
        step = np.full(size, _BASE, np.uint64)
        step[0] = 1
        _POW = np.cumprod(step, dtype=np.uint64)
        step = np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        step[0] = 1
        _INV = np.cumprod(step, dtype=np.uint64)
    return _POW, _INV


def utf8(col) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    if col.null_count:
        col = pc.fill_null(col, "")
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset: col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    buf = col.buffers()[2] if len(col) else None
    data = np.frombuffer(buf, np.uint8) if buf is not None else np.zeros(0, np.uint8)
    return data[off[0]: off[-1]], off - off[0]


def slices(data: np.ndarray, off: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges (first, last, bytes, offsets) of about ``most`` bytes."""
    first, n = 0, len(off) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(off, off[first] + most, "right")) - 1)
        yield first, last, data[off[first]: off[last]], off[first: last + 1] - off[first]
        first = last


def row_slices(col, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, pa.Array]]:
    """Row ranges (first, last, slice) of a string column with about ``most`` bytes of text each, without copying, so
    that what is made from a slice stays small whatever the batch."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    width = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
    off = np.zeros(len(width) + 1, np.int64)
    np.cumsum(width, out=off[1:])
    first = 0
    while first < len(col):
        last = max(first + 1, int(np.searchsorted(off, off[first] + most, "right")) - 1)
        yield first, last, col.slice(first, last - first)
        first = last


def spans(low: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs of non-zero bytes) and, per row, the index of its first word."""
    inside = low != 0
    n = len(low)
    first = np.zeros(n + 1, bool)
    first[off] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | first[:n]))
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, off)


def span_hash(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span; equal bytes hash alike anywhere."""
    pw, inv = _powers(len(low) + 1)
    total = np.zeros(len(low) + 1, np.uint64)
    np.cumsum(VALUE[low] * pw[: len(low)], out=total[1:])
    return mix((total[ends] - total[starts]) * inv[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts, ends of all words, and per row the index of its first word (one more at the end)."""
    low = FOLD[data]
    starts, ends, rows = spans(low, off)
    return span_hash(low, starts, ends), starts, ends, rows


def shingle_hashes(words: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every k consecutive words of each row (a row of fewer words, but not none, is one shingle) and the
    row offsets into them; repeats inside a row are kept."""
    n_words = np.diff(rows)
    n_sh = np.where(n_words >= k, n_words - k + 1, (n_words > 0).astype(n_words.dtype))
    off = np.zeros(len(rows), np.int64)
    np.cumsum(n_sh, out=off[1:])
    # position of each shingle's first word
    at = np.repeat(rows[:-1] - off[:-1], n_sh) + np.arange(off[-1])
    end = np.repeat(rows[1:], n_sh)
    h = np.zeros(off[-1], np.uint64)
    padded = np.concatenate([words, np.zeros(k, np.uint64)])
    for j in range(k):
        h = h * np.uint64(0xC2B2AE3D27D4EB4F) + np.where(at + j < end, padded[at + j] | np.uint64(1), np.uint64(0))
    return mix(h), off


def distinct_per_row(h: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each row, and the new offsets."""
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    out = np.zeros(len(off), np.int64)
    np.cumsum(np.bincount(row[new], minlength=len(off) - 1), out=out[1:])
    return h[new], out
