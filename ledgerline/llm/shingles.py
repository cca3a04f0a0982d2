"""Hashed word shingles of a text: what the similarity join and its verification see."""

from __future__ import annotations

import numpy as np
import xxhash

SIZE = 4
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_M = np.random.default_rng(41).integers(1, 2**63, 8, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads all bits of 64-bit numbers (a bijection)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, size: int = SIZE) -> np.ndarray:
    """The sorted distinct hashes of runs of ``size`` words (A-Z lowered); a shorter text is one run, an empty one has none."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(h) < size:
        whole = np.uint64(len(h))
        for x in h:
            whole = mix(np.array([whole]) * _M[7] + x)[0]
        return np.array([whole], np.uint64)
    n = len(h) - size + 1
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out += mix(h[k : k + n] + _M[k]) * _M[k]
    return np.unique(mix(out))
