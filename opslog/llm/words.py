"""Words of whole batches of texts as 64-bit hashes, without a loop over words.

A word is a run of letters, digits and combining marks of any script, lower-cased one
character at a time. Everything else separates words.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 2**64)
STEP = np.uint64(0xD6E8FEB86659FD93)
#: Characters handled at once; a longer text is handled alone and whole.
BATCH_CHARS = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash: spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _codes() -> np.ndarray:
    """For each character the code of its folded form, 0 where it separates words."""
    folded = np.zeros(0x110000, np.uint64)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalnum() or (c > 0x2FF and unicodedata.category(ch)[0] == "M"):
            low = ch.lower()
            folded[c] = ord(low) if len(low) == 1 else c
    return np.where(folded, mix(folded + np.uint64(BASE)) | np.uint64(1), np.uint64(0))


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        row = np.full(max(n, BATCH_CHARS + 1), base, np.uint64)
        row[0] = 1
        have = _powers[base] = np.cumprod(row, dtype=np.uint64)
    return have[:n]


def characters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(code of each character, 0 between words; where each text begins).

    One separator follows every text.
    """
    texts = [t or "" for t in texts]
    raw = ("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass")
    begins = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begins[1:])
    return _codes()[np.frombuffer(raw, np.uint32)], begins


def words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, pointers): words of text i are ``hash[ptr[i]:ptr[i + 1]]``."""
    return words_of(*characters(texts))


def words_of(value: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(value)
    inside = np.zeros(n + 2, np.int8)
    inside[1:-1] = value != 0
    edges = np.flatnonzero(np.diff(inside))
    first, last = edges[::2], edges[1::2]
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(value * powers(BASE, n), out=sums[1:])
    hashes = mix((sums[last] - sums[first]) * powers(BASE_INVERSE, n + 1)[first])
    return hashes, np.searchsorted(first, begins)


def grams_of(value: np.ndarray, begins: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``n`` characters inside words, and pointers as in :func:`words`."""
    size = max(0, len(value) - n + 1)
    inside = np.ones(size, bool)
    code = np.zeros(size, np.uint64)
    for j in range(n):
        part = value[j:j + size]
        inside &= part != 0
        code = code * STEP + part
    at = np.flatnonzero(inside)
    return mix(code[at]), np.searchsorted(at, begins)


def shingles(hashes: np.ndarray, ptr: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``k`` words of each text; a text with 1 to k-1 words has one."""
    counts = np.diff(ptr)
    rows = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    out_ptr = np.zeros(len(ptr), np.int64)
    np.cumsum(rows, out=out_ptr[1:])
    if not out_ptr[-1]:
        return np.zeros(0, np.uint64), out_ptr
    at = np.arange(out_ptr[-1]) + np.repeat(ptr[:-1] - out_ptr[:-1], rows)
    end = np.repeat(ptr[1:], rows)
    padded = np.concatenate([hashes, np.zeros(k, np.uint64)])
    value = np.zeros(len(at), np.uint64)
    for j in range(k):
        value = value * STEP + np.where(at + j < end, padded[at + j], np.uint64(j + 1))
    return mix(value), out_ptr
