"""Anchored runs: a compact way to ship every fixed-length window of a text.

Every window of a text is given to one anchor, the smallest hash among the grams
inside it (the leftmost on ties), which depends on the window's content alone:
equal windows have equal anchors at equal offsets wherever they stand.
Consecutive windows with the same anchor form a run, so one row per run stands
for all its windows.
"""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
#: Bits of a window's hash that hold its position inside a block; longer texts are taken in several blocks.
POSITION_BITS = 28
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]))
        _powers = tuple(np.cumprod(np.r_[np.uint64(1), np.full(size - 1, b, np.uint64)], dtype=np.uint64) for b in (_BASE, _INVERSE))
    return _powers[0][:n], _powers[1][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the polynomial hashes over all bits (in place)."""
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def span_hashes(data: np.ndarray, starts: np.ndarray | slice, ends: np.ndarray | slice) -> np.ndarray:
    """64-bit hashes of data[start:end] for many spans, from one prefix sum."""
    up, down = powers(len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(up[1:] * (data.astype(np.uint64) + np.uint64(1)), out=prefix[1:])
    return mixed((prefix[ends] - prefix[starts]) * down[starts])


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def runs(hashes: np.ndarray, width: int, bits: int = POSITION_BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and anchor position of each run of windows of ``width`` grams.

    Windows are taken in blocks whose grams have positions of ``bits`` bits; blocks overlap by a window, so a text of
    any length has the same anchors.
    """
    n = len(hashes) - width + 1
    if n < 1:
        none = np.zeros(0, np.int64)
        return none, none, none
    low, step = np.uint64((1 << bits) - 1), (1 << bits) - width + 1
    at = np.zeros(n, np.int64)
    for a in range(0, n, step):
        part = hashes[a : a + step + width - 1]
        packed = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        at[a : a + step] = (window_minima(packed, width) & low).astype(np.int64) + a
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return first, np.diff(np.r_[first, len(at)]), at[first]
