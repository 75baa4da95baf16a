"""Anchors of all fixed-length windows of many texts, by whole-array operations.

Every window of `width` bytes is given to one of its k-grams: that of least rank (some bits of its hash), of equals the leftmost. The choice
depends on the window's bytes alone, so equal windows, wherever they stand, have equal anchors at equal places.
"""

from __future__ import annotations

import numpy as np

from folio.llm.common import _M1, _powers, mix

#: Low bits of a key that hold a position, those above hold the rank; texts are taken in pieces that fit, so that a piece's arrays stay in the cache.
PLACE = 15


def _least(key: np.ndarray, w: int) -> np.ndarray:
    """The least of key[i:i+w] for each i."""
    m, size = key, 1
    while 2 * size <= w:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    return np.minimum(m[: len(key) - w + 1], m[w - size : w - size + len(key) - w + 1]) if size < w else m


def _pieces(off: np.ndarray, width: int, most: int) -> list[tuple[int, int]]:
    """(start, end) of pieces of at most `most` bytes that together hold every window: whole texts, or parts of a long one that overlap."""
    out, n, at = [], int(off[-1]), 0
    while n - at >= width:
        end = int(off[np.searchsorted(off, at + most, "right") - 1])
        to = end if end > at else at + most
        if to - at >= width:
            out.append((at, to))
        at = to if end > at else to - width + 1
    return out


def contexts(raw: np.ndarray, off: np.ndarray, width: int, k: int) -> tuple[np.ndarray, ...]:
    """(first window start, last window start, anchor, hash of the anchor's k-gram, hash of the run's bytes) of each run of windows with one anchor.

    Positions are those in raw; windows do not cross the borders `off` of the texts. Hashes depend on nothing but the bytes."""
    most = 1 << max(PLACE, (2 * width).bit_length())
    up, down = _powers(most + 1)
    # Written again for each piece: sums (hashes of ranges are their differences), hashes and keys.
    sums, buf, key, places = np.zeros(most + 1, np.uint64), np.empty(most, np.uint64), np.empty(most, np.uint32), np.arange(most, dtype=np.uint32)
    out: list[tuple[np.ndarray, ...]] = []
    for base, to in _pieces(off, width, most):
        n = to - base
        h, g = buf[:n], buf[: n - k + 1]
        np.add(raw[base:to], np.uint64(1), out=h)
        np.multiply(h, up[:n], out=h)
        np.cumsum(h, out=sums[1 : n + 1])
        np.subtract(sums[k : n + 1], sums[: n - k + 1], out=g)
        np.multiply(g, down[: n - k + 1], out=g)
        rank = g >> np.uint64(32)
        np.bitwise_xor(rank, g, out=rank)
        np.multiply(rank, _M1, out=rank)
        np.right_shift(rank, np.uint64(32), out=rank)
        packed = key[: len(g)]
        packed[:] = rank
        packed &= np.uint32(2**32 - most)
        packed |= places[: len(g)]
        at = _least(packed, width - k + 1)
        at &= np.uint32(most - 1)
        first = np.append(True, at[1:] != at[:-1])
        i, j = np.searchsorted(off, [base, to], "left")
        begin = np.clip(off[max(i - 1, 0) : j] - base, 0, n)
        end = np.append(begin[1:], n)
        if len(begin) > 1:
            # Windows that would cross a border belong to no run.
            a, b = np.maximum(end - width + 1, begin), np.minimum(end, len(at))
            cover = np.zeros(len(at) + 1, np.int32)
            np.add.at(cover, a[a < b], 1)
            np.add.at(cover, b[a < b], -1)
            whole = np.cumsum(cover[:-1]) == 0
            first |= np.append(True, ~whole[:-1])
            first &= whole
            lo = np.flatnonzero(first)
            last = whole & np.append(first[1:] | ~whole[1:], True)
            hi = np.flatnonzero(last)
        else:
            lo = np.flatnonzero(first)
            hi = np.append(lo[1:], len(at)) - 1
        if len(lo):
            s, e, a = lo, hi + width, at[lo].astype(np.int64)
            size = (e - s).astype(np.uint64)
            out.append((lo + base, hi + base, a + base, mix(g[a]), mix((sums[e] - sums[s]) * down[s] + mix(size))))
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out))


def runs(raw: np.ndarray, off: np.ndarray, width: int, k: int) -> tuple[np.ndarray, ...]:
    """contexts() without the hash of the bytes."""
    return contexts(raw, off, width, k)[:4]
