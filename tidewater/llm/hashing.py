"""Vectorised hashes of the words of a byte string."""

from __future__ import annotations

import numpy as np

_BASE = np.uint32(0x9E3779B1)
_INVERSE = np.uint32(pow(int(_BASE), -1, 1 << 32))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint32), "down": np.ones(1, np.uint32)}


def _power(which: str, n: int) -> np.ndarray:
    have = _powers[which]
    if len(have) < n:
        base = _BASE if which == "up" else _INVERSE
        size = max(n, 2 * len(have), 1 << 16)
        have = np.cumprod(np.r_[np.uint32(1), np.full(size - 1, base, np.uint32)], dtype=np.uint32)
        _powers[which] = have
    return have[:n]


def word_spans(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of anything but ASCII white space."""
    space = np.ones(len(raw) + 2, bool)
    np.take(_SPACE, np.frombuffer(raw, np.uint8), out=space[1:-1])
    edges = np.flatnonzero(space[1:] != space[:-1])
    return edges[::2], edges[1::2]


def word_hashes(raw: bytes) -> np.ndarray:
    """A 32-bit hash per word, as uint64: a polynomial in an odd base, from prefix sums over the whole text."""
    start, end = word_spans(raw)
    if not len(start):
        return np.empty(0, np.uint64)
    sums = np.zeros(len(raw) + 1, np.uint32)
    values = np.frombuffer(raw, np.uint8) * _power("up", len(raw))
    np.cumsum(values, dtype=np.uint32, out=sums[1:])
    h = (sums[end] - sums[start]) * _power("down", len(raw))[start]
    return h.astype(np.uint64) + ((end - start).astype(np.uint64) << np.uint64(32))
