"""Character classes and their n-gram codes, on UTF-8 bytes.

A byte falls into one of 64 classes: 0 is the edge of a text, 1-26 letters without case, 27 digits, 28
white space, 29 stops, 30 other signs, 31 the first bytes of longer characters and 32-63 their later bytes by
their low five bits. A table over n-grams therefore has 64**n entries at most, whatever the input.
"""

from __future__ import annotations

import numpy as np

CLASSES = 64


def _table() -> np.ndarray:
    t = np.full(256, 30, np.int32)
    t[:32] = 28
    t[32] = 28
    for k in range(26):
        t[65 + k] = t[97 + k] = 1 + k
    t[48:58] = 27
    t[[ord(c) for c in ".,;:!?"]] = 29
    t[192:] = 31
    t[128:192] = 32 + (np.arange(128, 192) & 31)
    return t


TABLE = _table()


def codes(text: str | None, n: int) -> np.ndarray:
    """The code of the n-gram that ends at each byte; what lies before the text is class 0."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    c = TABLE[raw]
    out = c.copy()
    for k in range(1, n):
        out[k:] += c[:-k] << (6 * k)
    return out


def joined(texts: list[str | None], n: int) -> tuple[np.ndarray, np.ndarray]:
    """codes() of several texts one after another, and how many each has."""
    found = [codes(t, n) for t in texts]
    return np.concatenate(found) if found else np.zeros(0, np.int32), np.array([len(f) for f in found], np.int64)


def sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of runs of the given lengths."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]
