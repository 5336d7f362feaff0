"""Helpers that work on whole Arrow columns of UTF-8 text with numpy.

A text column is one byte buffer plus row offsets. Spans of bytes (words,
pre-tokens, windows) are hashed all at once: with prefix sums ``c`` of
``T[byte] * P**i`` modulo 2**64, the span ``[s, e)`` has the value
``(c[e] - c[s]) * P**-s``, which depends on its bytes only. No Python code
runs per word.
"""

from __future__ import annotations

import ctypes
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T

#: Bytes handled at once; temporaries take about 60 bytes for each of them.
CHUNK_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): all output bits depend on all input bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_powers: dict[int, np.ndarray] = {}


def powers(n: int, base: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` modulo 2**64, kept for the largest ``n`` of a small size."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            have = np.full(size, np.uint64(base), np.uint64)
            have[0] = 1
            have = np.cumprod(have, dtype=np.uint64)
        if size <= 4 * CHUNK_BYTES:
            _powers[base] = have
    return have[:n]


_INT_BASE = int(_BASE)
_INT_INVERSE = pow(_INT_BASE, -1, 1 << 64)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans ``data[starts:ends]`` (equal bytes, equal hash)."""
    n = len(data)
    with np.errstate(over="ignore"):
        c = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_VALUE[data] * powers(n, _INT_BASE), out=c[1:])
        h = (c[ends] - c[starts]) * powers(n + 1, _INT_INVERSE)[starts]
        return mix(h + (ends - starts).astype(np.uint64) * _M2)


def hash_windows(values: np.ndarray, width: int) -> np.ndarray:
    """Hashes of every ``width`` consecutive uint64 values (one result per start)."""
    n = len(values)
    if n < width:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(n - width + 1, np.uint64)
        for k in range(width):
            out *= _BASE
            out += values[k:n - width + 1 + k]
        return mix(out + np.uint64(width))


def utf8_column(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of an Arrow string or binary column; a null row is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        kind = np.int32
    else:
        column, kind = column.cast(pa.large_binary()), np.int64
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type)
                                  or pa.types.is_large_binary(column.type) else "")
    n = len(column)
    _valid, offsets, data = column.buffers()
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offs = np.frombuffer(offsets, kind, count=n + 1, offset=column.offset * kind().itemsize)
    offs = offs.astype(np.int64)
    if data is None or offs[-1] == offs[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    base = offs[0]
    return np.frombuffer(data, np.uint8, count=offs[-1] - base, offset=base), offs - base


def chunks(data: np.ndarray, offsets: np.ndarray, limit: int = CHUNK_BYTES, cut=None):
    """Yield ``(rows, starts, a, b)``: segments of rows that lie in ``data[a:b]``.

    ``rows`` are row numbers, ``starts`` the segment starts relative to ``a``.
    Empty rows have no segment. A row above ``limit`` is divided where
    ``cut(data, lo, hi)`` gives a place (None: it stays whole).
    """
    rows, starts, a = [], [], 0
    for row in range(len(offsets) - 1):
        s, end = int(offsets[row]), int(offsets[row + 1])
        while s < end:
            e = end
            if end - s > limit and cut is not None:
                e = cut(data, s + 1, s + limit) or end
            if rows and e - a > limit:
                yield np.array(rows), np.array(starts), a, s
                rows, starts = [], []
            if not rows:
                a = s
            rows.append(row)
            starts.append(s - a)
            s = e
    if rows:
        yield np.array(rows), np.array(starts), a, int(offsets[-1])


def cut_before_space(data: np.ndarray, lo: int, hi: int) -> int | None:
    """The last place in ``[lo, hi)`` where a space follows a byte that is no white space."""
    part = data[lo - 1:hi]
    at = np.flatnonzero((part[1:] == 32) & (part[:-1] > 32))
    return lo + int(at[-1]) if len(at) else None


def words_of(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray,
             fold: np.ndarray | None = None, cut=None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words (maximal runs of bytes with ``is_word``) of all rows.

    Returns the words' hashes, row numbers, and byte starts and ends in
    ``data``. ``fold`` maps bytes before hashing (lower case).
    """
    out = []
    for rows, starts, a, b in chunks(data, offsets, cut=cut):
        part = data[a:b]
        w = is_word[part]
        first = np.zeros(len(part), bool)
        first[starts] = True
        begin = w.copy()
        begin[1:] &= ~w[:-1] | first[1:]
        stop = np.zeros(len(part), bool)
        stop[:-1] = w[:-1] & (~w[1:] | first[1:])
        stop[-1] = w[-1]
        s, e = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        h = hash_spans(part if fold is None else fold[part], s, e)
        r = rows[np.searchsorted(starts, s, "right") - 1]
        out.append((h, r, s + a, e + a))
    if not out:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z, z
    return tuple(np.concatenate(x) for x in zip(*out))


def cut_at_non_word(is_word: np.ndarray):
    """A ``cut`` for :func:`words_of`: after the last byte that belongs to no word."""
    def cut(data: np.ndarray, lo: int, hi: int) -> int | None:
        at = np.flatnonzero(~is_word[data[lo - 1:hi - 1]])
        return lo + int(at[-1]) if len(at) else None
    return cut


def lower_ascii() -> np.ndarray:
    fold = np.arange(256, dtype=np.uint8)
    fold[65:91] += 32
    return fold


class HashTable:
    """uint64 keys to int32 values in numpy arrays (open addressing, at most half full)."""

    def __init__(self, capacity: int):
        self.bits = max(4, int(2 * capacity - 1).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.values = np.zeros(1 << self.bits, np.int32)
        self.capacity, self.count = capacity, 0

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The keys' values, -1 where there is none (0 is no key)."""
        out = np.full(len(keys), -1, np.int32)
        slot = self._slots(keys)
        left = np.arange(len(keys))
        mask = len(self.keys) - 1
        while len(left):
            at = slot if len(left) == len(keys) else slot[left]
            there = self.keys[at]
            hit = there == keys[left]
            out[left[hit]] = self.values[at[hit]]
            left = left[~hit & (there != 0)]
            slot[left] = (slot[left] + 1) & mask
        return out

    def insert(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add distinct keys that are not in the table."""
        slot = self._slots(keys)
        left = np.arange(len(keys))
        mask = len(self.keys) - 1
        while len(left):
            at = slot[left]
            free = self.keys[at] == 0
            self.keys[at[free]] = keys[left[free]]
            done = self.keys[at] == keys[left]
            self.values[at[done]] = values[left[done]]
            left = left[~done]
            slot[left] = (slot[left] + 1) & mask
        self.count += len(keys)


def row_sums(rows: np.ndarray, weights: np.ndarray | None, n: int) -> np.ndarray:
    """Sums (or counts) by row number, as int64."""
    return np.bincount(rows, weights=weights, minlength=n).astype(np.int64)


def bounds(sorted_rows: np.ndarray, n: int) -> np.ndarray:
    """Where each of the rows 0..n-1 begins in an ascending array of row numbers, and its end."""
    return np.searchsorted(sorted_rows, np.arange(n + 1))


def trim() -> None:
    """Give freed memory back to the system: a worker that waits for its next task then holds little."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def slices(batch, column: int, limit: int = 2 * CHUNK_BYTES):
    """Parts of a record batch with about ``limit`` bytes in a text column (one row at least)."""
    _data, offsets = utf8_column(batch.column(column))
    a = 0
    while a < batch.num_rows:
        b = int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1
        b = min(max(b, a + 1), batch.num_rows)
        yield batch.slice(a, b - a)
        a = b
    trim()


@contextmanager
def arrow_rows(spark, rows: int):
    """Jobs inside send at most ``rows`` rows at once to Python; the session's setting returns after."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def map_batches(df, fn, fields: list[tuple[str, str]], text: str | None = None):
    """``df`` with columns added by ``fn(RecordBatch) -> list of arrays`` in map tasks.

    An input column with the name of an added one gives way to it. With
    ``text``, batches are divided so that this column stays small in memory.
    """
    added = T.StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in fields))
    names = {f.name.lower() for f in added.fields}
    keep = [i for i, c in enumerate(df.columns) if c.lower() not in names]
    schema = T.StructType([df.schema.fields[i] for i in keep] + added.fields)
    at = None if text is None else df.columns.index(text)

    def run(batches):
        for whole in batches:
            for batch in ([whole] if at is None else slices(whole, at)):
                if batch.num_rows:
                    new = fn(batch)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(i) for i in keep]
                        + [pa.array(x) if isinstance(x, np.ndarray) else x for x in new],
                        names=[batch.schema.names[i] for i in keep] + [f.name for f in added.fields])
    return df.mapInArrow(run, schema)
