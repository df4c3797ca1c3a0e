"""Vectorised text work inside Arrow tasks: words, hashes, windows.

Everything here takes the UTF-8 bytes of a batch of texts and works on numpy
arrays, in chunks of bounded size (a longer single text is a chunk of its own).
Hashes are 64 bits wide and do not depend on the session, task or batch, so
the same words get the same hash on every executor and in every rerun.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# by value, like ``common.by_value``; a name of another module here would have to be imported by the tasks
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK = 1 << 20  # bytes of text worked on at once


def mix(x):
    """Finaliser that spreads every input bit over all output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_table(lower: bool):
    """A random 64-bit number per byte; with ``lower``, A-Z count as a-z."""
    t = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    if lower:
        t[65:91] = t[97:123]
    return t


def space_table():
    t = np.zeros(256, dtype=bool)
    t[[9, 10, 11, 12, 13, 32]] = True
    return t


_BASE = 0xD1342543DE82EF95  # odd, so it has an inverse modulo 2**64


def powers(n: int):
    """(base**i, base**-i) modulo 2**64 for i < n.  Nothing is kept: this module
    travels with the tasks, and what it holds would stay until a worker collects
    its garbage."""
    out = []
    for b in (_BASE, pow(_BASE, -1, 1 << 64)):
        a = np.full(n, b, dtype=np.uint64)
        a[:1] = 1
        out.append(np.multiply.accumulate(a))
    return out[0], out[1]


def utf8(column) -> tuple:
    """(bytes, offsets) of an Arrow string column; null is the empty text."""
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    a = pc.fill_null(a.cast(pa.large_string()), "")
    off = np.frombuffer(a.buffers()[1], dtype=np.int64)[a.offset:a.offset + len(a) + 1]
    data = a.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, off


def chunks(off, limit: int = CHUNK):
    """Row ranges of at most ``limit`` bytes each, or of one longer text."""
    n, lo = len(off) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def find_words(raw, off):
    """Words of the rows between ``off[0]`` and ``off[-1]``: (bytes, starts,
    ends, words per row); starts and ends count from ``off[0]``."""
    base = int(off[0])
    b = raw[base:int(off[-1])]
    n = len(b)
    if not n:
        z = np.zeros(0, dtype=np.int64)
        return b, z, z, np.zeros(len(off) - 1, dtype=np.int64)
    word = ~space_table()[b]
    edge = np.zeros(n + 1, dtype=bool)  # a row begins here
    edge[off - base] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:n]
    last = word.copy()
    last[:-1] &= ~word[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    at = np.searchsorted(starts, off - base)
    return b, starts, ends, np.diff(at)


def hash_spans(b, starts, ends, lower: bool = True):
    """64-bit hash of every span of the bytes."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    up, down = powers(len(b) + 1)
    sums = np.zeros(len(b) + 1, dtype=np.uint64)
    np.cumsum(byte_table(lower)[b] * up[:len(b)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def ahead(a, j: int, fill: int = 0):
    """The array moved j places to the front, filled up at the end."""
    out = np.full(len(a), fill, dtype=a.dtype)
    if j < len(a):
        out[:len(a) - j] = a[j:]
    return out


def shingles(word_hash, counts, k: int):
    """(hash, row) of every k-word window; a row with fewer words, but at least
    one, has a single window of all its words."""
    n = len(word_hash)
    row_end = np.cumsum(counts)
    row_of = np.repeat(np.arange(len(counts)), counts)
    left = row_end[row_of] - np.arange(n)  # words from here to the row's end
    h = np.full(n, k, dtype=np.uint64)
    for j in range(k):
        part = ahead(word_hash, j)
        part[left <= j] = np.uint64(0)
        h = mix(h * np.uint64(_BASE) + part)
    short = (counts[row_of] < k) & (left == counts[row_of])
    keep = (left >= k) | short
    return h[keep], row_of[keep]


def distinct_per_row(h, row, rows: int):
    """Distinct hashes of each row, sorted: (hashes, rows, number per row)."""
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    if len(h):
        keep = np.ones(len(h), dtype=bool)
        keep[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        h, row = h[keep], row[keep]
    return h, row, np.bincount(row, minlength=rows).astype(np.int64)


def planes(a, width: int | None = None) -> bytes:
    """The lowest ``width`` bytes of an integer array, all lowest bytes first and
    so on, so that Spark's shuffle compression sees constant high bytes as runs."""
    a = np.ascontiguousarray(a)
    return a.view(np.uint8).reshape(len(a), a.dtype.itemsize)[:, :width].T.tobytes()


def unplanes(data, dtype, count: int, width: int | None = None):
    dtype = np.dtype(dtype)
    width = width or dtype.itemsize
    out = np.zeros((count, dtype.itemsize), dtype=np.uint8)
    out[:, :width] = np.frombuffer(data, dtype=np.uint8, count=count * width).reshape(width, count).T
    return out.view(dtype).reshape(count)


def top_bucket(h, buckets: int):
    """Bucket of a hash by range, so that buckets keep the order of hashes."""
    return ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
