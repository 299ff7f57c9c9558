"""Two-stage suffix sorting of a byte array, by numpy.

Type B suffixes are smaller than their successor, type A ones larger.  Only
type B is sorted directly, eight symbols at a time, and only as long as ties
last; type A is induced by one scan over the first-symbol buckets in rising
order: a finished bucket, read from front to back, yields in the right order
the larger suffixes that precede its members.

Symbol 0 ends a string.  Suffixes are ordered by their first ``depth`` symbols
or up to the end of their string; those equal that far come in any order.
"""

from __future__ import annotations

import numpy as np


def smaller_than_successor(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is type B; decided for a run of one symbol by what follows the run."""
    edge = np.flatnonzero(t[1:] != t[:-1])
    length = np.diff(np.r_[-1, edge, len(t) - 1])
    return np.repeat(np.r_[t[edge] < t[edge + 1], False], length)


def eights(t: np.ndarray) -> np.ndarray:
    """Per position the next eight symbols as one big-endian integer; zeros follow the end."""
    x = np.r_[t, np.zeros(64, np.uint8)].astype(np.uint64)
    for n in (1, 2, 4):
        x[:-n] = x[:-n] << np.uint64(8 * n) | x[n:]
    return x


def ends(t: np.ndarray) -> np.ndarray:
    """Symbols from each position to the end of its string."""
    zero = np.flatnonzero(t == 0)
    return (np.repeat(zero, np.diff(np.r_[-1, zero])) - np.arange(len(t))).astype(np.int32)


def direct_sort(at: np.ndarray, x: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes ``at`` in order of their first ``depth`` symbols."""
    at = at[np.argsort(x[at], kind="stable")]
    group = np.cumsum(np.r_[0, x[at[1:]] != x[at[:-1]]]) if len(at) else np.empty(0, np.int64)
    done, slots = 8, np.arange(len(at))
    while done < depth and len(slots):
        same = group[1:] == group[:-1]
        tied = (np.r_[same, False] | np.r_[False, same]) & (left[at[slots]] >= done)
        slots, group = slots[tied], group[tied]
        here = at[slots]
        key = x[here + done]
        order = np.lexsort((key, group))
        at[slots] = here[order]
        key, g = key[order], group[order]
        group = np.cumsum(np.r_[0, (g[1:] != g[:-1]) | (key[1:] != key[:-1])]) if len(g) else g
        done += 8
    return at


def sort(t: np.ndarray, depth: int, x: np.ndarray | None = None, left: np.ndarray | None = None) -> np.ndarray:
    """The suffix array of ``t`` (uint8, last symbol 0)."""
    if not len(t):
        return np.empty(0, np.int64)
    x = eights(t) if x is None else x
    left = ends(t) if left is None else left
    small = smaller_than_successor(t)
    direct = direct_sort(np.flatnonzero(small & (t != 0)), x, left, depth)
    cut = np.searchsorted(t[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    for c in range(256):
        if c == 0:
            bucket = np.flatnonzero(t == 0)
        else:
            parts = waiting[c]
            wave = np.concatenate(parts) if parts else np.empty(0, np.int64)
            parts = [wave]
            while len(wave):                              # the same symbol before a larger suffix: larger again
                wave = wave[wave > 0] - 1
                wave = wave[t[wave] == c]
                parts.append(wave)
            bucket = np.concatenate([*parts, direct[cut[c]:cut[c + 1]]])
        waiting[c] = []
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        symbol = t[before]
        larger = symbol > c
        before, symbol = before[larger], symbol[larger]
        order = np.argsort(symbol, kind="stable")
        before, symbol = before[order], symbol[order]
        at = np.flatnonzero(np.r_[True, symbol[1:] != symbol[:-1]]) if len(symbol) else []
        for lo, hi in zip(at, [*at[1:], len(symbol)]):
            waiting[symbol[lo]].append(before[lo:hi])
    return np.concatenate(out)


def common_prefixes(order: np.ndarray, x: np.ndarray, cap: int) -> np.ndarray:
    """Of each suffix in ``order`` and the one before it, the common prefix up to ``cap`` symbols; the first has 0."""
    out = np.zeros(len(order), np.int32)
    live = np.arange(1, len(order))
    for done in range(0, cap, 8):
        differ = x[order[live] + done] ^ x[order[live - 1] + done]
        stop = differ != 0
        d = differ[stop]
        zeros = np.full(len(d), 7, np.int32)
        for n in range(7):                                # equal leading bytes of the eight
            zeros[(zeros == 7) & (d >> np.uint64(56 - 8 * n) != 0)] = n
        out[live[stop]] = done + zeros
        live = live[~stop]
    out[live] = cap
    return np.minimum(out, cap)
