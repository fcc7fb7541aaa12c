"""Words of a batch of texts as 64-bit hashes, with array operations only.

A word is a maximal run of bytes other than space and 0x09-0x0D; A-Z count as
a-z.  The hash is a polynomial over the ring of 64-bit integers (per-byte
values from a table), taken from running sums, then mixed.
"""

from __future__ import annotations

import numpy as np

from .common import mix64

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"): ord("Z") + 1] += 32
_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[_LOWER]
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse for positions below ``n``."""
    size = 1 << max(16, int(n).bit_length())
    if size not in _powers:
        _powers.clear()
        tables = []
        for base in (_BASE, _INVERSE):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            tables.append(np.cumprod(p, dtype=np.uint64))
        _powers[size] = (tables[0], tables[1])
    return _powers[size]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the n+1 word offsets of the n texts."""
    h, _, _, at = word_spans(data, offsets)
    return h, at


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, byte starts, byte ends, word offsets of the texts)."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, np.zeros(len(offsets), np.int64)
    edge = np.empty(n + 1, bool)  # position where a word may begin or end
    inside = np.empty(n + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_not(_SPACE[data], out=inside[1:-1])
    edge[:] = inside[1:] != inside[:-1]
    starts_flag = edge & inside[1:]
    ends_flag = edge & inside[:-1]
    cut = offsets[(offsets > 0) & (offsets < n)]
    cut = cut[inside[cut] & inside[cut + 1]]  # two texts meet without white space
    starts_flag[cut] = True
    ends_flag[cut] = True
    starts, ends = np.flatnonzero(starts_flag), np.flatnonzero(ends_flag)
    power, inverse = _power_tables(n)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_VALUE[data] * power[:n], out=sums[1:])
    h = mix64((sums[ends] - sums[starts]) * inverse[starts])
    return h, starts, ends, np.searchsorted(starts, offsets)


_STEP = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
                                0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)]


def shingle_hashes(h: np.ndarray, at: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the ``width``-word shingles of each text.

    A text of fewer words is one shingle of all of them; one without words
    has none.
    """
    if not 1 <= width <= len(_STEP):
        raise ValueError(f"shingle width must be 1 to {len(_STEP)}")
    n = len(h)
    total = np.zeros(n + width, np.uint64)
    for j in range(width):
        part = total[: n]
        part[: n - j] += mix64(h[j:] + np.uint64(j + 1)) * _STEP[j]
    total = mix64(total[:n])
    short = np.flatnonzero((np.diff(at) > 0) & (np.diff(at) < width))
    out = []
    counts = np.diff(at)
    none = np.zeros(0, np.uint64)
    for i in range(len(at) - 1):
        m = counts[i]
        out.append(np.unique(total[at[i]: at[i] + m - width + 1]) if m >= width else none)
    for i in short:  # another formula, so that no longer text's shingle equals it
        own = h[at[i]: at[i + 1]]
        parts = mix64(own + np.arange(1, len(own) + 1, dtype=np.uint64) * _STEP[-1])
        out[i] = mix64(np.add.reduce(parts, keepdims=True) + np.uint64(len(own)))
    return out
