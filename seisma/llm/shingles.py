"""Shingle hashes of texts by array operations.

A word's hash is a polynomial over random byte values modulo 2^64, taken from
running sums over the whole text, so no word is touched one by one; shingle
hashes combine word or character hashes and are mixed.  Equal shingles get
equal hashes; different ones collide with probability about 2^-64.
"""

from __future__ import annotations

import numpy as np

_RANDOM = np.random.default_rng(20240131)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_RANDOM.integers(1, 1 << 62)) * 8 + 5
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = [np.uint64(int(x) | 1) for x in _RANDOM.integers(1, 1 << 63, 8, dtype=np.uint64)]
_powers: dict[str, np.ndarray] = {}

#: A-Z fold, ASCII white space becomes the space.
FOLD = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))
_SPACE = 32


def _power(name: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        have[0] = 1
        have = _powers[name] = np.multiply.accumulate(have)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX[0]
    h = (h ^ (h >> np.uint64(29))) * _MIX[1]
    return h ^ (h >> np.uint64(32))


def word_hashes(folded: bytes) -> np.ndarray:
    """Hashes of the space-separated words of a folded text, in order."""
    a = np.frombuffer(folded, np.uint8)
    word = np.zeros(len(a) + 2, dtype=bool)
    word[1:-1] = a != _SPACE
    edge = np.flatnonzero(word[1:] != word[:-1])
    start, end = edge[::2], edge[1::2]
    sums = np.zeros(len(a) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[a] * _power("up", _BASE, len(a)), out=sums[1:])
    h = (sums[end] - sums[start]) * _power("down", _INVERSE, len(a) + 1)[start]
    return mix(h + (end - start).astype(np.uint64) * _MIX[2])


def word_shingles(raw: bytes | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; fewer words are one shingle, no words none."""
    w = word_hashes(raw.translate(FOLD)) if raw else np.zeros(0, dtype=np.uint64)
    if not len(w):
        return w
    n = min(k, len(w))
    h = np.zeros(len(w) - n + 1, dtype=np.uint64)
    for i in range(n):
        h += w[i : len(w) - n + 1 + i] * _MIX[(i + 3) % 8] * np.uint64(2 * i + 1)
    return np.unique(mix(h + np.uint64(n)))


def char_shingles(codes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-character windows of an array of code points, in order."""
    n = len(codes) - k + 1
    if n < 1:
        return np.zeros(0, dtype=np.uint64)
    h = np.zeros(n, dtype=np.uint64)
    c = mix(codes.astype(np.uint64) * _MIX[3] + _MIX[4])
    for i in range(k):
        h = h * _MIX[5] + c[i : n + i]
    return mix(h)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
