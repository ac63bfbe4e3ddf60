"""Vectorised word and span hashing over many texts at once (numpy).

Texts are laid end to end in one byte array. A span's hash is a polynomial in
an odd base modulo 2**64, read off a prefix sum, then mixed.
"""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15
BASE_INV = pow(BASE, -1, 1 << 64)
CHUNK_BYTES = 1 << 21
#: for :func:`pieces`; a hash pass takes about 50 bytes of arrays per byte
PIECE_BYTES = 1 << 19
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    if n:
        p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


class SpanHash:
    """Hashes of spans of one byte array."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=self.prefix[1:])
        self.inverse = powers(BASE_INV, n + 1)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.prefix[end] - self.prefix[start]) * self.inverse[start]
        return mix64(h ^ ((end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def chunks(sizes, limit: int = CHUNK_BYTES):
    """Consecutive index ranges whose sizes sum to at most ``limit`` (a larger
    single item forms its own range)."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if len(sizes) > start:
        yield start, len(sizes)


def encode(texts) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts]


def pieces(texts, limit: int = PIECE_BYTES):
    """(lo, hi, encoded texts) of consecutive texts that sum to at most ``limit``
    bytes (a larger single one is a piece of its own). No more than a piece is
    encoded at a time, so a worker's memory does not grow with its batch."""
    lo, raw, total = 0, [], 0
    for i, t in enumerate(texts):
        (b,) = encode((t,))
        if raw and total + len(b) > limit:
            yield lo, i, raw
            lo, raw, total = i, [], 0
        raw.append(b)
        total += len(b)
    if raw:
        yield lo, lo + len(raw), raw


def words(raw: list[bytes]):
    """Word hashes of ASCII-lower-cased texts, words being runs of bytes other
    than space and \\t..\\r: (hashes, offsets), text i having
    ``hashes[offsets[i]:offsets[i + 1]]``."""
    joined = np.frombuffer((b" ".join(raw) + b" ").translate(_LOWER), np.uint8)
    lengths = np.fromiter(map(len, raw), np.int64, len(raw))
    begin = np.concatenate(([0], np.cumsum(lengths + 1)))
    inside = (joined != 32) & ((joined < 9) | (joined > 13))
    edge = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return SpanHash(joined).spans(start, end), np.searchsorted(start, begin)


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Distinct hashes of runs of ``k`` words; of the whole if it is shorter."""
    n = len(hashes)
    if n == 0:
        return hashes
    k = min(k, n)
    h = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        h *= np.uint64(BASE)
        h += hashes[i:n - k + 1 + i]
    return np.unique(mix64(h))
