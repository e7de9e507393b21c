"""Words, 64-bit word hashes and shingle sets of one text, in numpy.

A word is a run of bytes other than space and \\t..\\r, which is what `bytes.split()` cuts at. Sets are held as
sorted arrays of 64-bit hashes; two different shingles get the same hash with a chance of 2^-64.
"""

from __future__ import annotations

import numpy as np
import xxhash

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_EMPTY = np.empty(0, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the whole word."""
    x = (x ^ (x >> np.uint64(31))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


def word_hashes(text: bytes | None, lower: bool = True) -> np.ndarray:
    """Hashes of the words in order; `lower` maps A-Z to a-z first."""
    if not text:
        return _EMPTY
    words = (text.lower() if lower else text).split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-word windows in order; a shorter, not empty sequence is one window of its own length."""
    n = len(hashes)
    if n == 0:
        return _EMPTY
    width, out = min(n, k), max(1, n - k + 1)
    code = np.full(out, width, np.uint64)
    for i in range(width):
        code = mix(code + hashes[i : i + out])
    return code


def signed(values: np.ndarray) -> np.ndarray:
    """The same bits as Spark's long."""
    return values.view(np.int64)


def set_key(shingle_set: np.ndarray) -> int:
    """64-bit hash of a sorted set, as a signed long."""
    return xxhash.xxh3_64_intdigest(shingle_set.tobytes()) - (1 << 63)
