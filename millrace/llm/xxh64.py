"""XXH64 of many byte strings at once."""

from __future__ import annotations

import numpy as np
import xxhash

U = np.uint64
#: Fixed values of the XXH64 algorithm.
P1, P2, P3, P4, P5 = (U(x) for x in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
#: Longer strings are hashed one by one.
LONG = 256


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << U(r)) | (x >> U(64 - r))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotl(acc + lane * P2, 31) * P1


def xxh64(buf: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 42) -> np.ndarray:
    """Hashes of buf[start:end]; strings of one length are hashed together, lane by lane."""
    n = len(buf)
    padded = np.zeros(n + 8, np.uint8)
    padded[:n] = buf
    lanes = np.ndarray((n + 1,), "<u8", padded, 0, (1,)).copy()
    lens = end - start
    out = np.empty(len(start), np.uint64)
    order = np.argsort(np.minimum(lens, LONG + 1).astype(np.uint16), kind="stable")
    cuts = np.searchsorted(lens[order], np.arange(LONG + 2))
    for size in np.flatnonzero(np.diff(cuts)).tolist():
        o = order[cuts[size] : cuts[size + 1]]
        out[o] = _equal_sized(lanes, start[o], size, U(seed))
    raw = None
    for i in order[cuts[LONG + 1] :].tolist():
        raw = raw or padded.tobytes()
        out[i] = xxhash.xxh64_intdigest(raw[start[i] : end[i]], seed)
    return out


def _equal_sized(lanes: np.ndarray, at: np.ndarray, size: int, seed: np.uint64) -> np.ndarray:
    with np.errstate(over="ignore"):
        at, left = at.copy(), size
        if size >= 32:
            v = [np.full(len(at), x, np.uint64) for x in (seed + P1 + P2, seed + P2, seed, seed - P1)]
            while left >= 32:
                v = [_round(x, lanes[at + 8 * i]) for i, x in enumerate(v)]
                at += 32
                left -= 32
            h = _rotl(v[0], 1) + _rotl(v[1], 7) + _rotl(v[2], 12) + _rotl(v[3], 18)
            for x in v:
                h = (h ^ _round(U(0), x)) * P1 + P4
        else:
            h = np.full(len(at), seed + P5, np.uint64)
        h += U(size)
        while left >= 8:
            h = _rotl(h ^ _round(U(0), lanes[at]), 27) * P1 + P4
            at += 8
            left -= 8
        if left >= 4:
            h = _rotl(h ^ ((lanes[at] & U(0xFFFFFFFF)) * P1), 23) * P2 + P3
            at += 4
            left -= 4
        while left:
            h = _rotl(h ^ ((lanes[at] & U(0xFF)) * P5), 11) * P1
            at += 1
            left -= 1
        h ^= h >> U(33)
        h *= P2
        h ^= h >> U(29)
        h *= P3
        return h ^ (h >> U(32))
