"""Rasters brought from one coordinate system to another, tile by tile."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greensward.operators.batches import in_groups
from greensward.operators.grid import Grid
from greensward.operators.regions import TILE

#: Points along each side of a tile by which its place on the target is found, target cells around it for safety, and cells in work at a time.
SIDE, MARGIN, STRIP = 33, 2, 1 << 20

#: Side of the largest tile that many images go through together, and how many at a time.
SMALL, IMAGES = 32, 1024

#: Takes x and y as arrays and gives x and y.
Mapping = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def target_cells(r0: int, r1: int, c0: int, c1: int, source: Grid, target: Grid, to_source: Mapping, to_target: Mapping, nearest: bool) -> Iterator[tuple[np.ndarray, ...]]:
    """Row and column of the target cells whose source cell lies in rows ``r0`` to ``r1`` and columns ``c0`` to ``c1``, the row and column of that cell in there, and where between it and the next they lie."""
    u = np.linspace(0.0, 1.0, SIDE)
    ends = (source.left + c0 * source.res, source.left + (c1 + 1) * source.res), (source.top - r0 * source.res, source.top - (r1 + 1) * source.res)
    x = np.concatenate([ends[0][0] + u * (ends[0][1] - ends[0][0])] * 2 + [np.full(SIDE, e) for e in ends[0]])
    y = np.concatenate([np.full(SIDE, e) for e in ends[1]] + [ends[1][0] + u * (ends[1][1] - ends[1][0])] * 2)
    tx, ty = to_target(x, y)
    left, right = ((f(tx) - target.left) / target.res for f in (np.min, np.max))
    top, bottom = ((target.top - f(ty)) / target.res for f in (np.max, np.min))
    first, last = max(int(np.floor(left)) - MARGIN, 0), min(int(np.ceil(right)) + MARGIN, target.width)
    low, high = max(int(np.floor(top)) - MARGIN, 0), min(int(np.ceil(bottom)) + MARGIN, target.height)
    if first >= last:
        return
    step = max(1, STRIP // (last - first))
    for s in range(low, high, step):
        tr, tc = (g.ravel() for g in np.meshgrid(np.arange(s, min(s + step, high)), np.arange(first, last), indexing="ij"))
        sx, sy = to_source(target.left + (tc + 0.5) * target.res, target.top - (tr + 0.5) * target.res)
        fr, fc = (source.top - sy) / source.res, (sx - source.left) / source.res
        if not nearest:
            fr, fc = fr - 0.5, fc - 0.5
        br, bc = np.floor(fr).astype(np.int64), np.floor(fc).astype(np.int64)
        mine = (br >= r0) & (br < r1) & (bc >= c0) & (bc < c1)
        tr, tc, br, bc, fr, fc = (a[mine] for a in (tr, tc, br, bc, fr, fc))
        yield tr, tc, br - r0, bc - c0, fr - br, fc - bc


def read_cells(dense: np.ndarray, br: np.ndarray, bc: np.ndarray, fr: np.ndarray, fc: np.ndarray, nearest: bool) -> np.ndarray:
    """Values of one window of cells, or of many along the first axis; nan where nothing is."""
    if nearest:
        return dense[..., br, bc]
    total = weight = np.zeros((*dense.shape[:-2], len(br)))
    for dr in (0, 1):
        for dc in (0, 1):
            tap = dense[..., br + dr, bc + dc]
            w = np.abs(1 - dr - fr) * np.abs(1 - dc - fc)
            w = np.where(np.isnan(tap) | (w <= 1e-12), 0.0, w)
            total, weight = total + w * np.nan_to_num(tap), weight + w
    return np.divide(total, weight, out=np.full(weight.shape, np.nan), where=weight > 0)


def warp_tile(row: np.ndarray, col: np.ndarray, v: np.ndarray, rows: tuple[int, int], cols: tuple[int, int], source: Grid, target: Grid, to_source: Mapping, to_target: Mapping, nearest: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``row, col, value`` of the target cells whose source cell (of bilinear taps the upper left one) lies in a tile.

    ``rows`` and ``cols`` are the tile's first row and column and those behind
    its last; the cells given may lie one row and column further on.
    """
    r0, r1, c0, c1 = max(rows[0], int(row.min()) - 1), min(rows[1], int(row.max()) + 1), max(cols[0], int(col.min()) - 1), min(cols[1], int(col.max()) + 1)
    dense = np.full((r1 - r0 + 1, c1 - c0 + 1), np.nan)
    inside = (row >= r0) & (row <= r1) & (col >= c0) & (col <= c1)
    dense[row[inside] - r0, col[inside] - c0] = v[inside]
    for tr, tc, br, bc, fr, fc in target_cells(r0, r1, c0, c1, source, target, to_source, to_target, nearest):
        value = read_cells(dense, br, bc, fr, fc, nearest)
        good = ~np.isnan(value)
        yield tr[good], tc[good], value[good]


def warp(raster: DataFrame, source: Grid, target: Grid, by: list[str], to_source: Mapping, to_target: Mapping, value: str = "v", *, nearest: bool = False, tile: int = TILE) -> DataFrame:
    """``by, row, col`` and the value on a grid of another coordinate system.

    Every target cell's centre is mapped back to the source by ``to_source`` and
    takes the value of the cell there (``nearest``; class bands must) or the
    mean of the four centres around it by their weights, where those that are
    missing, null or not finite are left out and the others weigh more.
    ``to_target`` only finds where a tile comes to lie.

    A task has one tile of the source and, but for ``nearest``, the first row and
    column of the tiles behind it; it makes the target cells whose (upper left)
    source cell is its own, so each is made once and nothing is shuffled after
    that. Small tiles go through a task many images at a time, and where their
    target cells lie is worked out once for them. A source cell must come once.
    """
    own = lambda c: F.floor(F.col(c) / tile)
    near = lambda c: F.explode(F.array_distinct(F.array(F.floor((F.col(c) - 1) / tile), own(c))))
    v = F.col(value).cast("double")
    cells = raster.select(*by, F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), v.alias("_v")).where(F.abs("_v") < F.lit(float("inf")))
    # a centre half a cell outside the first row still has taps in it; the nearest cell is in the tile itself
    dealt = cells.withColumn("_tr", (own if nearest else near)("row")).withColumn("_tc", (own if nearest else near)("col"))
    kinds = dict(cells.dtypes)

    small = tile <= SMALL

    def many(table: pa.Table, first: np.ndarray) -> pa.Table:
        row, col, v, tr, tc = (table.column(c).to_numpy() for c in ("row", "col", "_v", "_tr", "_tc"))
        stop, parts = np.append(first[1:], len(row)), []

        def alone(g: int) -> None:
            """An image's tile that is large enough to be read where it has cells only."""
            at = slice(first[g], stop[g])
            rows, cols = ((int(t[at][0]) * tile, (int(t[at][0]) + 1) * tile) for t in (tr, tc))
            parts.extend((np.full(len(f[0]), first[g]), *f) for f in warp_tile(row[at], col[at], v[at], rows, cols, source, target, to_source, to_target, nearest))

        def together(g: np.ndarray, plan: list[tuple[np.ndarray, ...]]) -> None:
            """The same tile of many images."""
            n = (stop - first)[g]
            at, r0, c0 = np.arange(n.sum()) + np.repeat(first[g] - np.cumsum(n) + n, n), int(tr[first[g[0]]]) * tile, int(tc[first[g[0]]]) * tile
            dense = np.full((len(g), tile + 1, tile + 1), np.nan)
            dense[np.repeat(np.arange(len(g)), n), row[at] - r0, col[at] - c0] = v[at]
            for to_row, to_col, *place in plan:
                value = read_cells(dense, *place, nearest)
                image, k = np.nonzero(~np.isnan(value))
                parts.append((first[g[image]], to_row[k], to_col[k], value[image, k]))

        if small:
            order = np.lexsort((tc[first], tr[first]))
            cuts = np.flatnonzero((np.diff(tr[first[order]]) != 0) | (np.diff(tc[first[order]]) != 0)) + 1
            for g in np.split(order, cuts) if len(order) else []:
                r0, c0 = int(tr[first[g[0]]]) * tile, int(tc[first[g[0]]]) * tile
                plan = list(target_cells(r0, r0 + tile, c0, c0 + tile, source, target, to_source, to_target, nearest))
                step = max(1, min(IMAGES, STRIP // max([1, *(len(p[0]) for p in plan)])))
                for s in range(0, len(g), step):
                    together(g[s : s + step], plan)
        else:
            for g in range(len(first)):
                alone(g)
        of, r, c, w = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, k) for i, k in enumerate((np.int64, np.int64, np.int64, np.float64)))
        key = table.select(by).take(pa.array(of))
        return pa.table({**{b: key.column(b) for b in by}, "row": pa.array(r), "col": pa.array(c), value: pa.array(w)})

    schema = ", ".join([*(f"{b} {kinds[b]}" for b in by), "row bigint", "col bigint", f"{value} double"])
    # images first: in the order of tiles nearly all rows would be equal by the sort's first key
    return in_groups(dealt, [*by, "_tr", "_tc"], many, schema)
