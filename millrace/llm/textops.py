"""NumPy text kernels shared by the corpus operators.

They work on the raw UTF-8 buffers of Arrow string columns: a slice of documents is one byte array and
an array of offsets, so tokenising and hashing cost a few vector passes and no Python object per word.
A null text has no bytes. Words and lines are told apart by XXH64. Runs of elements (bytes, or words by their hash) have
polynomial sums modulo 2**64, which give the hash of any run from one prefix sum; two long runs can be made to collide
there without a search, so such hashes only find candidates of runs of over some hundred elements, whose content is compared.

A slice is at most 256 KiB of texts, or one longer text: a worker needs about 100 bytes of memory for each byte of the
longest text (a text of 10 MB about 1 GB), and what it needs besides does not depend on the texts.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard

from millrace.llm.xxh64 import xxh64

U = np.uint64
_ODD = 0x9E3779B97F4A7C15
_INV = pow(_ODD, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}
#: Powers that a worker keeps: one more than the bytes of a slice.
KEPT_POWERS = (1 << 18) + 1

#: Whitespace that separates words: space, tab, \n, \v, \f and \r.
IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
#: ASCII letters and digits and every byte of a non-ASCII character.
IS_ALNUM = np.zeros(256, bool)
IS_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * U(0xD1342543DE82EF95)) | U(1)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse; those of slices of the usual size are kept."""

    def made(base: int, size: int) -> np.ndarray:
        p = np.full(size, U(base))
        p[0] = 1
        return np.cumprod(p, dtype=np.uint64)

    if n > KEPT_POWERS:
        return made(_ODD, n), made(_INV, n)
    if not _powers:
        _powers["up"], _powers["down"] = made(_ODD, KEPT_POWERS), made(_INV, KEPT_POWERS)
    return _powers["up"][:n], _powers["down"][:n]


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same for mapInArrow(), after which the worker hands its memory back; idle workers would keep it."""

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(it)
        finally:
            hand_back()

    return task


def hand_back() -> None:
    """Return freed memory to the system, where the C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        return


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums from which span_hash() gets the hash of any run of values."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values))[0], out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((sums[end] - sums[start]) * powers(len(sums))[1][start])


def strings(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (one more than rows) and bytes of a string or binary column; nulls have no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column) or offsets is None:
        return np.zeros(len(column) + 1, np.int64), np.zeros(0, np.uint8)
    offs = np.frombuffer(offsets, np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if column.null_count:
        lens = np.where(np.asarray(column.is_valid()), np.diff(offs), 0)
        if (lens != np.diff(offs)).any():
            return strings(column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b""))
    return offs, buf


def longs(column: pa.Array, null: int = np.iinfo(np.int64).max) -> np.ndarray:
    return np.asarray(column.cast(pa.int64()).fill_null(null))


def slices(offs: np.ndarray, limit: int = 1 << 18):
    """Row ranges (lo, hi) of at most `limit` bytes each, or of one row that is longer."""
    lo, rows = 0, len(offs) - 1
    while lo < rows:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        yield lo, min(hi, rows)
        lo = min(hi, rows)


def text_slices(column: pa.Array, limit: int = 1 << 18):
    """(lo, hi, bytes, offsets from 0) for the slices of a text column."""
    offs, data = strings(column)
    for lo, hi in slices(offs, limit):
        yield lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]


def word_bounds(buf: np.ndarray, offs: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of the words of a slice, and the first word of each document (one more than documents)."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    w = is_word[buf]
    s, e = w.copy(), w.copy()
    s[1:] &= ~w[:-1]
    e[:-1] &= ~w[1:]
    heads = offs[:-1][np.diff(offs) > 0]
    tails = offs[1:][np.diff(offs) > 0] - 1
    s[heads] = w[heads]
    e[tails] = w[tails]
    starts, ends = np.flatnonzero(s), np.flatnonzero(e) + 1
    return starts, ends, np.searchsorted(starts, offs)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return xxh64(buf, starts, ends)


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of every run, one run after another."""
    total = int(lens.sum())
    out = np.ones(total, np.int64)
    heads = np.cumsum(lens) - lens
    some = lens > 0
    s, h, n = starts[some], heads[some], lens[some]
    if total:
        out[h[0]] = s[0]
        out[h[1:]] = s[1:] - (s[:-1] + n[:-1] - 1)
    return np.cumsum(out)


def merge_runs(keys: list[np.ndarray], start: np.ndarray, end: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Union of [start, end) ranges within equal keys; touching ranges become one. Sorted by keys and start."""
    if not len(start):
        return keys, start, end
    o = np.lexsort((start, *reversed(keys)))
    keys, start, end = [k[o] for k in keys], start[o], end[o]
    new = np.ones(len(start), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    group = np.cumsum(new) - 1
    wide = int(end.max()) + 1
    reach = np.maximum.accumulate(end + group * wide)  # the furthest end so far, within the key
    fresh = new.copy()
    fresh[1:] |= start[1:] + group[1:] * wide > reach[:-1]
    head = np.flatnonzero(fresh)
    last = np.append(head[1:], len(start)) - 1
    return [k[head] for k in keys], start[head], reach[last] - group[last] * wide


def pack(*arrays: np.ndarray) -> bytes:
    """Columns of numbers as one compressed value, for shuffles of many small rows."""
    head = [np.array([len(arrays)], np.int64).tobytes()]
    head += [a.dtype.str.encode().ljust(8) + np.array([len(a)], np.int64).tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(head + [np.ascontiguousarray(a).tobytes() for a in arrays]))


def unpack(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    at, out = 8 + 16 * n, []
    for i in range(n):
        kind = np.dtype(raw[8 + 16 * i : 16 + 16 * i].decode().strip())
        size = int(np.frombuffer(raw, np.int64, 1, 16 + 16 * i)[0])
        out.append(np.frombuffer(raw, kind, size, at))
        at += size * kind.itemsize
    return out


def unpack_all(blobs: list[bytes]) -> list[np.ndarray]:
    """The columns of several packed values, joined."""
    parts = [unpack(b) for b in blobs]
    return [np.concatenate(x) for x in zip(*parts, strict=True)]
