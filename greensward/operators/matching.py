"""For each box the best of the boxes that it overlaps, without trying all of them."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: Boxes to a cell of the index, and how many are tried at a time at most.
CELL, BLOCK = 16, 4096


def best_match(box: np.ndarray, size: np.ndarray, other: np.ndarray, least: float, value: np.ndarray | None = None, exact: Callable[[int, int], float] | None = None) -> np.ndarray:
    """For each box the place of the best of ``other`` that covers ``least`` of its ``size``, or -1.

    The best has the largest share, the first place on ties; with ``value`` the
    largest value, any on ties. ``exact`` gives what a pair shares where boxes
    only tell which may meet. Others lie in cells by their corner; what a cell
    can share at most is known from the ranges of its corners, so cells are
    tried in that order until none can be better. Where many overlap few are
    tried, and the result is that of all pairs.
    """
    n, m = len(box), len(other)
    best, found = np.full(n, -np.inf), np.full(n, -1)
    if not n or not m:
        return found
    low = other[:, :2].min(0)
    wide = other[:, :2].max(0) - low
    c = max(float(np.sqrt(wide[0] * wide[1] * CELL / m)), float(wide.max()) * CELL / m) or 1.0
    place = np.floor((other[:, :2] - low) / c).astype(np.int64)
    nx, ny = place.max(0) + 1
    code = place[:, 0] * ny + place[:, 1]
    order = np.argsort(code, kind="stable")
    cells, first, count = np.unique(code[order], return_index=True, return_counts=True)
    lo, hi = np.minimum.reduceat(other[order], first), np.maximum.reduceat(other[order], first)
    top = None if value is None else np.maximum.reduceat(value[order], first)
    lookup = np.full(nx * ny, -1)
    lookup[cells] = np.arange(len(cells))
    lookup = lookup.reshape(nx, ny)
    side = (other[:, 2:] - other[:, :2]).max(0)
    z = np.where(size > 0, size, 1).astype(np.float64)
    mine = np.clip(np.floor((box[:, :2] - low) / c), -1, [nx, ny]).astype(np.int64)
    key = mine[:, 0] * (ny + 2) + mine[:, 1]
    by_key = np.argsort(key, kind="stable")
    for ids in np.split(by_key, np.flatnonzero(np.diff(key[by_key])) + 1):
        a, b = box[ids].min(0), box[ids].max(0)
        start = np.clip(np.floor((a[:2] - side - low) / c), 0, [nx, ny]).astype(np.int64)
        stop = np.clip(np.floor((b[2:] - low) / c) + 1, 0, [nx, ny]).astype(np.int64)
        g = lookup[start[0] : stop[0], start[1] : stop[1]].ravel()
        g = g[g >= 0]
        w, h = (np.minimum(b[i + 2], hi[g, i + 2]) - np.maximum(a[i], lo[g, i]) for i in (0, 1))
        most = np.where((w > 0) & (h > 0), w * h, 0).astype(np.float64)
        small = z[ids].min()
        may = (most > 0) & (most >= least * small)
        g, share = g[may], most[may] / small
        bound = share if value is None else top[g]
        rank = np.lexsort((-share, -bound))
        g, bound = g[rank], bound[rank]
        upto = np.cumsum(count[g])
        k, step = 0, 2 * CELL
        while k < len(g):
            todo = ids[best[ids] <= bound[k] if value is None else best[ids] < bound[k]]
            if not len(todo):
                break
            end = max(int(np.searchsorted(upto, (upto[k - 1] if k else 0) + step, side="right")), k + 1)
            at = np.concatenate([order[first[i] : first[i] + count[i]] for i in g[k:end].tolist()])
            k, step = end, min(2 * step, BLOCK)
            for s in range(0, len(todo), 256):
                for q in range(0, len(at), BLOCK):
                    _better(todo[s : s + 256], at[q : q + BLOCK], box, size, z, other, least, value, exact, best, found)
    return found


def _better(ids, at, box, size, z, other, least, value, exact, best, found) -> None:
    """Tries the others ``at`` for the boxes ``ids``."""
    b, t = box[ids][:, None], other[at][None]
    w = np.minimum(b[..., 2], t[..., 2]) - np.maximum(b[..., 0], t[..., 0])
    h = np.minimum(b[..., 3], t[..., 3]) - np.maximum(b[..., 1], t[..., 1])
    over = np.where((w > 0) & (h > 0), w * h, 0).astype(np.float64)
    if exact is not None:
        may = (over > 0) & (over >= least * size[ids][:, None]) & (over / z[ids][:, None] >= best[ids][:, None])
        for i, j in np.argwhere(may):
            over[i, j] = exact(int(ids[i]), int(at[j]))
        over[~may] = 0
    good = (over > 0) & (over >= least * size[ids][:, None])
    score = np.where(good, over / z[ids][:, None] if value is None else value[at][None], -np.inf)
    s = score.max(1)
    one = np.where(score == s[:, None], at[None], len(other)).min(1)
    new = (s > best[ids]) | ((s == best[ids]) & (s > -np.inf) & (one < found[ids]))
    best[ids[new]], found[ids[new]] = s[new], one[new]
