"""Array kernels for words and word shingles of a UTF-8 text."""

from __future__ import annotations

import numpy as np

from . import windows as W

#: White space that parts words: tab to carriage return, and space.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions where the words begin and end."""
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~_SPACE[raw]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_values(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word."""
    if not len(begin):
        return np.empty(0, np.uint64)
    sums = W.prefix_sums(W.BYTE_VALUES[raw])
    down = W._power("down", W._INVERSE, int(begin[-1]) + 1)
    return W.mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct hashes of the ``words``-word shingles, A-Z lower-cased; all of a shorter text is one."""
    raw = _LOWER[np.frombuffer(text, np.uint8)]
    value = word_values(raw, *word_spans(raw))
    if not len(value):
        return value
    n = min(words, len(value))
    total = np.zeros(len(value) - n + 1, np.uint64)
    for i in range(n):
        total = W.mix(total * np.uint64(0x9E3779B97F4A7C15) + value[i : len(value) - n + 1 + i])
    return np.unique(W.mix(total + np.uint64(n)))
