"""Tests of rings against points and rings, whole Arrow batches at a time; used inside tasks only."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

#: Pairs of sides compared at a time: bounds the memory of a task whatever the rings' lengths.
AT_ONCE = 1 << 20


class Sides(NamedTuple):
    """Sides (ax, ay) to (bx, by), ring after ring: how many a ring has, and where its first one is."""

    n: np.ndarray
    start: np.ndarray
    ax: np.ndarray
    ay: np.ndarray
    bx: np.ndarray
    by: np.ndarray


def sides(batch) -> Sides:
    """From an Arrow list array of (x, y); no ring is null or empty."""
    n = batch.value_lengths().to_numpy(zero_copy_only=False).astype("int64")
    x, y = (c.to_numpy(zero_copy_only=False).astype("float64", copy=False) for c in batch.flatten().flatten())
    end = np.cumsum(n)
    after = np.arange(1, len(x) + 1)
    after[end - 1] = end - n
    return Sides(n, end - n, x, y, x[after], y[after])


def taken(s: Sides, k: np.ndarray) -> Sides:
    """The sides of rings k, in this order."""
    n = s.n[k]
    end = np.cumsum(n)
    at = np.repeat(s.start[k] - (end - n), n) + np.arange(n.sum())
    return Sides(n, end - n, s.ax[at], s.ay[at], s.bx[at], s.by[at])


def hold(x: np.ndarray, y: np.ndarray, s: Sides) -> np.ndarray:
    """Whether each ring holds its point, by the even-odd rule."""
    if not len(x):
        return np.zeros(0, bool)
    px, py = np.repeat(x, s.n), np.repeat(y, s.n)
    with np.errstate(all="ignore"):
        crosses = (s.ay > py) != (s.by > py)
        right = px < s.ax + (py - s.ay) * (s.bx - s.ax) / (s.by - s.ay)
    return np.add.reduceat((crosses & right).astype("int64"), s.start) % 2 == 1


def _reaching(own: Sides, other: Sides) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the own sides that reach the other ring's box; how many these are in each ring, and where they begin."""
    box = [f.reduceat(c, other.start) for f, c in ((np.fmin, other.ax), (np.fmax, other.ax), (np.fmin, other.ay), (np.fmax, other.ay))]
    x0, x1, y0, y1 = (np.repeat(v, own.n) for v in box)
    keep = (np.maximum(own.ax, own.bx) >= x0) & (np.minimum(own.ax, own.bx) <= x1) & (np.maximum(own.ay, own.by) >= y0) & (np.minimum(own.ay, own.by) <= y1)
    n = np.add.reduceat(keep.astype("int64"), own.start)
    return np.flatnonzero(keep), n, np.cumsum(n) - n


def meet(a: Sides, b: Sides) -> np.ndarray:
    """Whether each ring of a has a point in common with its ring of b, touching counts: sides that meet, or a corner of
    one inside the other. Only sides that reach the other's box are compared."""
    if not len(a.n):
        return np.zeros(0, bool)
    (ka, na, sa), (kb, nb, sb) = _reaching(a, b), _reaching(b, a)
    end = np.cumsum(na * nb)
    begin, out = end - na * nb, np.zeros(len(a.n), bool)
    for lo in range(0, int(end[-1]), AT_ONCE):
        hi = min(lo + AT_ONCE, int(end[-1]))
        p = np.repeat(np.arange(len(out)), np.clip(np.minimum(end, hi) - np.maximum(begin, lo), 0, None))
        local = np.arange(lo, hi) - begin[p]
        i, j = ka[sa[p] + local // nb[p]], kb[sb[p] + local % nb[p]]
        out[p[_segments_meet([c[i] for c in a[2:]], [c[j] for c in b[2:]])]] = True
    return out | hold(a.ax[a.start], a.ay[a.start], b) | hold(b.ax[b.start], b.ay[b.start], a)


def _segments_meet(s: list[np.ndarray], t: list[np.ndarray]) -> np.ndarray:
    (sax, say, sbx, sby), (tax, tay, tbx, tby) = s, t
    span = lambda a, b, c, d: (np.maximum(a, b) >= np.minimum(c, d)) & (np.maximum(c, d) >= np.minimum(a, b))
    side = lambda px, py, qx, qy, rx, ry: np.sign((qx - px) * (ry - py) - (qy - py) * (rx - px))
    apart = (side(sax, say, sbx, sby, tax, tay) * side(sax, say, sbx, sby, tbx, tby) > 0) | (side(tax, tay, tbx, tby, sax, say) * side(tax, tay, tbx, tby, sbx, sby) > 0)
    return span(sax, sbx, tax, tbx) & span(say, sby, tay, tby) & ~apart
