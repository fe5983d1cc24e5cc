"""Sets of hashed word shingles, computed without a loop over words."""

from __future__ import annotations

import hashlib

import numpy as np

_LOW = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.default_rng(4).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_M = 0x9E3779B97F4A7C15
_INVERSE = pow(_M, -1, 1 << 64)
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Shingler:
    """Maps UTF-8 texts to sorted arrays of distinct 64-bit shingle hashes.

    A-Z are lower-cased; words are runs of bytes other than the six ASCII white
    spaces. A word's hash is a polynomial over its bytes, read off prefix sums
    over the whole text; a shingle mixes the hashes of ``size`` words in
    sequence. With fewer words the whole sequence is the only shingle; a text
    without words has none.
    """

    def __init__(self, size: int):
        self.size = size
        self.up, self.down = _powers(_M, 1 << 16), _powers(_INVERSE, 1 << 16)

    def words(self, b: bytes) -> np.ndarray:
        a = np.frombuffer(b.translate(_LOW), np.uint8)
        if len(a) >= len(self.up):
            n = 1 << (len(a) + 1).bit_length()
            self.up, self.down = _powers(_M, n), _powers(_INVERSE, n)
        word = np.zeros(len(a) + 2, np.int8)
        word[1:-1] = ~_SPACE[a]
        edge = np.flatnonzero(word[1:] != word[:-1])
        start, end = edge[::2], edge[1::2]
        total = np.zeros(len(a) + 1, np.uint64)
        np.cumsum(_BYTE[a] * self.up[: len(a)], out=total[1:])
        h = (total[end] - total[start]) * self.down[start]
        return _mix(h + (end - start).astype(np.uint64))

    def __call__(self, b: bytes) -> np.ndarray:
        w = self.words(b)
        k = min(self.size, len(w))
        if not k:
            return w
        n = len(w) - k + 1
        h = np.full(n, k, np.uint64)
        for i in range(k):
            h = _mix(h * np.uint64(_M) + w[i : i + n])
        h.sort()
        return h[np.concatenate([[True], h[1:] != h[:-1]])]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def set_key(s: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit halves of a digest of a sorted set."""
    d = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)
