"""A common grid, rasters brought onto it, windows, and cells that an area touches."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greensward.operators.spatial import point_in_ring


@dataclass(frozen=True)
class Grid:
    """Cells of ``res`` metres: row 0 is the northern one, centres lie half a cell inside."""

    left: float
    top: float
    res: float
    width: int
    height: int

    @classmethod
    def over(cls, west: float, south: float, east: float, north: float, res: float) -> Grid:
        """The grid of whole cells that covers a box, with its edges on multiples of ``res``."""
        left, top = math.floor(west / res) * res, math.ceil(north / res) * res
        right, bottom = math.ceil(east / res) * res, math.floor(south / res) * res
        return cls(left, top, res, round((right - left) / res), round((top - bottom) / res))

    def x(self, col: Column) -> Column:
        return self.left + (col + 0.5) * self.res

    def y(self, row: Column) -> Column:
        return self.top - (row + 0.5) * self.res

    def inside(self, row: Column, col: Column) -> Column:
        return row.between(0, self.height - 1) & col.between(0, self.width - 1)

    def cells(self, points: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
        """``points`` with the ``row, col`` of the cell that holds them; those outside go."""
        row, col = F.floor((self.top - F.col(y)) / self.res), F.floor((F.col(x) - self.left) / self.res)
        return points.withColumns({"row": row, "col": col}).where(self.inside(F.col("row"), F.col("col")))


def reproject(raster: DataFrame, source: Grid, target: Grid, by: list[str], value: str = "v", *, nearest: bool = False) -> DataFrame:
    """``by, row, col`` and the value on another grid of the same projection.

    A cell takes the value of the source cell that holds its centre, if
    ``nearest`` (class bands must), or the mean of the four centres around it by
    their weights; those that are missing or null are left out and the others
    weigh more. Source cells go out to the target cells that they reach, so the
    work is a local explosion and one aggregation by target cell, whatever the
    size of the grids.
    """
    reach = source.res * (0.5 if nearest else 1.0)
    sx, sy = source.x(F.col("col")), source.y(F.col("row"))
    span = lambda lo, hi, n: F.sequence(F.greatest(F.ceil(lo - 1e-9), F.lit(0)).cast("long"), F.least(F.floor(hi + 1e-9), F.lit(n - 1)).cast("long"))
    rows = raster.where(F.col(value).isNotNull()).select(*by, value, "row", "col", sx.alias("sx"), sy.alias("sy"))
    low_c, high_c = ((F.col("sx") + k * reach - target.left) / target.res - 0.5 for k in (-1, 1))
    low_r, high_r = ((target.top - F.col("sy") + k * reach) / target.res - 0.5 for k in (-1, 1))
    rows = rows.where((F.floor(high_c + 1e-9) >= F.greatest(F.ceil(low_c - 1e-9), F.lit(0))) & (F.ceil(low_c - 1e-9) < target.width) & (F.floor(high_r + 1e-9) >= F.greatest(F.ceil(low_r - 1e-9), F.lit(0))) & (F.ceil(low_r - 1e-9) < target.height))
    rows = rows.withColumn("tc", F.explode(span(low_c, high_c, target.width))).withColumn("tr", F.explode(span(low_r, high_r, target.height)))
    tx, ty = target.x(F.col("tc")), target.y(F.col("tr"))
    keys = [*by, F.col("tr").alias("row"), F.col("tc").alias("col")]
    if nearest:
        # half open cells: a centre on an edge belongs to the cell to the east or south
        mine = (F.floor((tx - source.left) / source.res) == F.col("col")) & (F.floor((source.top - ty) / source.res) == F.col("row"))
        return rows.where(mine).select(*keys, value)
    w = F.greatest(1 - F.abs(tx - F.col("sx")) / source.res, F.lit(0.0)) * F.greatest(1 - F.abs(ty - F.col("sy")) / source.res, F.lit(0.0))
    rows = rows.withColumn("w", w).where(F.col("w") > 1e-12)
    return rows.groupBy(*keys).agg((F.sum(F.col("w") * F.col(value)) / F.sum("w")).alias(value))


def crop_window(bbox: tuple[float, float, float, float], left: float, top: float, res: float, width: int, height: int) -> tuple[int, int, int, int]:
    """``row_off, col_off, rows, cols`` of a box (west, south, east, north) in a raster, rounded to cells and kept inside; an error if they don't meet."""
    west, south, east, north = bbox
    west, east, south, north = max(west, left), min(east, left + width * res), max(south, top - height * res), min(north, top)
    if west >= east or south >= north:
        raise ValueError("the box doesn't meet the raster")
    col, row = round((west - left) / res), round((top - north) / res)
    return row, col, min(round((north - south) / res), height - row), min(round((east - west) / res), width - col)


def crop(cells: DataFrame, window: tuple[int, int, int, int]) -> DataFrame:
    """The cells of a window, counted from its corner."""
    row, col, rows, cols = window
    inside = F.col("row").between(row, row + rows - 1) & F.col("col").between(col, col + cols - 1)
    return cells.where(inside).withColumns({"row": F.col("row") - row, "col": F.col("col") - col})


def touches_ring(x: Column, y: Column, res: float, ring: list[tuple[float, float]]) -> Column:
    """Whether the cell of side ``res`` around a centre meets the area of a ring: its centre lies inside, or an edge crosses the cell."""
    out, half = point_in_ring(x, y, ring), res / 2
    for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1], strict=True):
        dx, dy = x1 - x0, y1 - y0
        near = (x + half >= min(x0, x1)) & (x - half <= max(x0, x1)) & (y + half >= min(y0, y1)) & (y - half <= max(y0, y1))
        out = out | (near & (F.abs((x - x0) * dy - (y - y0) * dx) <= half * (abs(dx) + abs(dy))))
    return out


def clip(cells: DataFrame, x: Column, y: Column, res: float, ring: list[tuple[float, float]], all_touched: bool = True) -> DataFrame:
    """The cells of an area: all that it touches, or those whose centres lie inside. A box around it is tried first."""
    xs, ys = [p[0] for p in ring], [p[1] for p in ring]
    half = res / 2 if all_touched else 0.0
    box = x.between(min(xs) - half, max(xs) + half) & y.between(min(ys) - half, max(ys) + half)
    return cells.where(box & (touches_ring(x, y, res, ring) if all_touched else point_in_ring(x, y, ring)))
