"""Vectorised hashing of words and byte windows over the texts of one Arrow table.

All functions work on the UTF-8 buffer of a whole column at once, so the cost
per byte is a few numpy passes.  Hashes are polynomial sums modulo 2**64 over
random per-byte values, finished by a bit mixer; equal strings always get equal
hashes, on every machine and in every task.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import zstandard

U = np.uint64
_BASE = 0x9E3779B97F4A7C13  # odd, 3 modulo 8
_INVERSE = pow(_BASE, -1, 2**64)
_rng = np.random.default_rng(20240)
BYTE_VALUES = _rng.integers(0, 2**64, 256, dtype=np.uint64) | U(1)
BYTE_VALUES_2 = _rng.integers(0, 2**64, 256, dtype=np.uint64) | U(1)

SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
SPACE_WORDS = ~SPACES  # [^\x20\x09-\x0D]+

ALNUM_WORDS = np.ones(256, bool)  # [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing
ALNUM_WORDS[0x00:0x30] = False
ALNUM_WORDS[0x3A:0x61] = False
ALNUM_WORDS[0x7B:0x80] = False

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse up to n, kept for later calls."""
    if len(_powers[0]) <= n:
        size = max(n + 1, 2 * len(_powers[0]))
        for k, base in enumerate((_BASE, _INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all output bits (in place)."""
    h ^= h >> U(32)
    h *= U(0xD6E8FEB86659FD93)
    h ^= h >> U(29)
    h *= U(0xC2B2AE3D27D4EB4F)
    h ^= h >> U(32)
    return h


def prefix_sums(values: np.ndarray) -> np.ndarray:
    p, _ = _power(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * p[: len(values)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for arrays of spans."""
    _, q = _power(len(sums))
    return mix((sums[end] - sums[start]) * q[start] + (end - start).astype(np.uint64))


def each_width(sums: np.ndarray, width: int) -> np.ndarray:
    """span_hash of every run of ``width`` consecutive values, without index arrays."""
    n = len(sums) - width
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = sums[width:] - sums[:-width]
    h *= _power(len(sums))[1][:n]
    h += U(width)
    return mix(h)


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start, start + 1, ... (count of them) for each pair, end to end."""
    return np.repeat(start - np.cumsum(count) + count, count) + np.arange(count.sum())


def rolling(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = prefix_sums(values)
    _, q = _power(len(sums))
    return mix((sums[width:] - sums[:-width]) * q[:n])


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (OSError, AttributeError):  # a C library without it
    _trim = None


def give_back() -> None:
    """Return the memory of the last group's arrays to the system: workers live on between tasks and stages."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


class Texts:
    """Buffers of one string column: ``buf`` bytes, ``off`` document offsets."""

    def __init__(self, column: pa.ChunkedArray | pa.Array):
        column = column.cast(pa.large_string())
        arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        if isinstance(arr, pa.ChunkedArray):
            arr = pa.concat_arrays(arr.chunks) if arr.num_chunks else pa.array([], pa.large_string())
        arr = arr.fill_null("")
        self.n = len(arr)
        if not self.n:
            self.buf, self.off = np.zeros(0, np.uint8), np.zeros(1, np.int64)
            return
        buffers = arr.buffers()
        off = np.frombuffer(buffers[1], np.int64)[arr.offset : arr.offset + self.n + 1]
        data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
        self.buf = data[off[0] : off[-1]]
        self.off = off - off[0]

    def lower(self) -> Texts:
        """A-Z to a-z; other bytes stay."""
        self.buf = LOWER[self.buf]
        return self

    def bytes_of(self, i: int) -> bytes:
        return self.buf[self.off[i] : self.off[i + 1]].tobytes()

    def words(self, table: np.ndarray) -> Words:
        return Words(self, table)


class Words:
    """Word spans of all texts: ``start``/``end`` byte offsets, ``first`` word index per text."""

    def __init__(self, texts: Texts, table: np.ndarray):
        buf, off = texts.buf, texts.off
        n = len(buf)
        inside = table[buf]
        if n:
            before = np.zeros(n, bool)
            before[1:] = inside[:-1]
            edges = off[(off > 0) & (off < n)]
            before[edges] = False
            after = np.zeros(n, bool)
            after[:-1] = inside[1:]
            after[edges - 1] = False
            self.start = np.flatnonzero(inside & ~before)
            self.end = np.flatnonzero(inside & ~after) + 1
        else:
            self.start = self.end = np.zeros(0, np.int64)
        self.texts = texts
        self.n = len(self.start)
        self.first = np.searchsorted(self.start, off)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(texts.n), self.count)

    def hashes(self) -> np.ndarray:
        sums = prefix_sums(BYTE_VALUES[self.texts.buf])
        return span_hash(sums, self.start, self.end)

    def windows(self, values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word index, hash) of every ``width``-word window inside one text."""
        h = rolling(values, width)
        at = np.flatnonzero(self.doc[: len(h)] == self.doc[width - 1 :]) if len(h) else np.zeros(0, np.int64)
        return at, h[at]


def covered(starts: np.ndarray, widths, n: int) -> np.ndarray:
    """Mask of the n places inside any span [start, start + width)."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, starts, 1)
    np.add.at(d, starts + widths, -1)
    return np.cumsum(d[:-1]) > 0


# --- packed sorted arrays ----------------------------------------------------


def pack(*columns: np.ndarray) -> bytes:
    """Columns of equal length as compressed byte planes; the first one ascending, kept as differences."""
    n = len(columns[0])
    parts = [np.array([n, len(columns)], np.int64).tobytes()]
    for k, c in enumerate(columns):
        c = np.ascontiguousarray(c)
        if k == 0 and n:
            c = np.diff(c, prepend=c.dtype.type(0))
        parts.append(c.dtype.str.encode().ljust(8))
        parts.append(np.ascontiguousarray(c.view(np.uint8).reshape(n, -1).T).tobytes() if n else b"")
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, k = np.frombuffer(raw, np.int64, 2)
    at, out = 16, []
    for i in range(k):
        kind = np.dtype(raw[at : at + 8].decode().strip())
        at += 8
        c = np.frombuffer(raw, np.uint8, int(n) * kind.itemsize, at).reshape(kind.itemsize, n)
        at += int(n) * kind.itemsize
        c = np.ascontiguousarray(c.T).view(kind).reshape(n)
        out.append(np.cumsum(c, dtype=kind) if i == 0 else c)
    return out


def slices(batch: pa.RecordBatch, column: str, most: int = 2 << 20):
    """Consecutive rows of a batch with about ``most`` bytes of text together, or one longer text."""
    if not batch.num_rows:
        return
    off = Texts(batch[column]).off
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(off, off[begin] + most, side="right")) - 1)
        yield batch.slice(begin, end - begin)
        begin = end
