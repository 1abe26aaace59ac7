"""Word shingles of whole texts as sorted arrays of 64-bit hashes, in numpy."""

from __future__ import annotations

import re

import numpy as np

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
#: A-Z to a-z, byte by byte: bytes beyond ASCII are not touched.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SIZE = 5

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x100000001B3 * 2 + 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly; one-to-one."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


LETTER = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)
_powers = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """Powers of the base, modulo 2 to the 64."""
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(
            np.concatenate([[1], np.full(max(n, 1 << 16) - 1, _BASE)]).astype(np.uint64), dtype=np.uint64
        )
    return _powers[:n]


def word_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash per word of ``data``: a polynomial over random letters, by sums from the end."""
    letters = LETTER[np.frombuffer(data, dtype=np.uint8)]
    size = ends - starts
    top = int(size.max(initial=0))
    if top <= 64:
        total = np.zeros(len(starts), dtype=np.uint64)
        for k in range(top):  # the k-th letter of all words that have one
            has = np.flatnonzero(size > k)
            total[has] = total[has] * np.uint64(_BASE) + letters[starts[has] + k]
    else:
        inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        at = np.repeat(starts, size) + inner
        terms = letters[at] * powers(top)[np.repeat(size, size) - 1 - inner]
        total = np.add.reduceat(terms, np.cumsum(size) - size)
    return mix(total + size.astype(np.uint64) * _STEP)


def words_at(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of ``data``."""
    raw = np.frombuffer(data, dtype=np.uint8)
    inside = np.zeros(len(raw) + 2, dtype=np.int8)
    inside[1:-1] = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def window_hashes(words: np.ndarray, size: int = SIZE) -> np.ndarray:
    """A hash per run of ``size`` words; fewer words make one run."""
    if len(words) == 0:
        return words
    size = min(size, len(words))
    reach = len(words) - size + 1
    total = np.full(reach, size, dtype=np.uint64)
    for k in range(size):
        total = mix(total * _STEP + words[k : k + reach])
    return total


def shingle_set(text: str | None, size: int = SIZE) -> np.ndarray:
    """Distinct shingles of a whole text, sorted; A-Z count as a-z."""
    data = (text or "").encode("utf-8", "replace").translate(LOWER)
    starts, ends = words_at(data)
    if len(starts) == 0:
        return np.zeros(0, dtype=np.uint64)
    return np.unique(window_hashes(word_hashes(data, starts, ends), size))
