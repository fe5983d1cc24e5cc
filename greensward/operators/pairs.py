"""Counts and ranks over all pairs of a series' points, without holding the pairs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Slopes held at once, and cells of a histogram of slopes.
HELD, CELLS = 1 << 20, 4096


def rises(y: np.ndarray) -> tuple[int, np.ndarray]:
    """How many pairs i < j have ``y[i] < y[j]``, counted by halves that come back sorted, and ``y`` sorted."""
    if len(y) <= 64:
        return int(np.triu(y[:, None] < y[None, :], 1).sum()), np.sort(y)
    half = len(y) // 2
    (a, left), (b, right) = rises(y[:half]), rises(y[half:])
    return a + b + int(np.searchsorted(left, right, side="left").sum()), np.sort(np.concatenate([left, right]), kind="stable")


def kendall_s(day: np.ndarray, value: np.ndarray) -> int:
    """Rising pairs less falling ones, of points on different days."""
    up = np.lexsort((-value, day))
    down = np.lexsort((value, day))
    return rises(value[up])[0] - rises(-value[down])[0]


def slopes(x: np.ndarray, y: np.ndarray, held: int = HELD) -> Iterator[np.ndarray]:
    """The slopes of all pairs with ``x[i] < x[j]``, some rows at a time; ``x`` ascends."""
    step = max(1, held // max(len(x), 1))
    for s in range(0, len(x), step):
        dx, dy = x[None, s:] - x[s : s + step, None], y[None, s:] - y[s : s + step, None]
        some = dx > 0
        yield dy[some] / dx[some]


def slope_ranks(x: np.ndarray, y: np.ndarray, ranks: list[int], held: int = HELD) -> list[float]:
    """The slopes at these places (from 0) of the order of all slopes.

    Where they are more than ``held``, each pass over them makes a histogram of
    the range that holds a rank, until the cell with it is small or of one value.
    """
    n = len(x)
    if n * (n - 1) // 2 <= held:
        every = np.sort(np.concatenate([*slopes(x, y, held), np.zeros(0)]))
        return [float(every[r]) for r in ranks]
    ends = [(m.min(), m.max()) for m in slopes(x, y, held) if len(m)]
    low, high = min(a for a, _ in ends), max(b for _, b in ends)
    return [_rank(x, y, r, low, high, held) for r in ranks]


def _rank(x: np.ndarray, y: np.ndarray, rank: int, low: float, high: float, held: int) -> float:
    below = 0
    while low < high:
        edges = np.linspace(low, high, CELLS + 1)
        edges[-1] = np.nextafter(high, np.inf)
        count, first, last = np.zeros(CELLS, np.int64), np.full(CELLS, np.inf), np.full(CELLS, -np.inf)
        for m in slopes(x, y, held):
            m = m[(m >= low) & (m <= high)]
            cell = np.searchsorted(edges, m, side="right") - 1
            count += np.bincount(cell, minlength=CELLS)
            np.minimum.at(first, cell, m)
            np.maximum.at(last, cell, m)
        upto = below + np.cumsum(count)
        k = int(np.searchsorted(upto, rank, side="right"))
        low, high, below, inside = float(first[k]), float(last[k]), int(upto[k] - count[k]), int(count[k])
        if inside <= held:
            few = np.sort(np.concatenate([m[(m >= low) & (m <= high)] for m in slopes(x, y, held)]))
            return float(few[rank - below])
    return low
