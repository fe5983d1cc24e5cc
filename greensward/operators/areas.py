"""Areas of many rings on a grid, by scanlines: cells inside, cells touched, clips and zones."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from greensward.operators.grid import Grid
from greensward.operators.regions import annotate_landcover
from greensward.operators.shapes import BLOCK, union_runs
from greensward.plans.scratch import Scratch

EDGE = ("x0", "y0", "x1", "y1")

#: Columns of the blocks in which polygons' runs meet a raster: few, as a run is tried against all cells of its block.
NARROW = 8

#: Rows of edges in work at a time.
STRIP = 1 << 20


def ring_edges(rings: DataFrame, by: list[str], ring: str = "ring") -> DataFrame:
    """``by, x0, y0, x1, y1``: the edges of rings, arrays of points (x, y), closed or not.

    Parts and holes are rings like any other: what lies in an odd number of them
    is inside. Rings of any length are rows here, never one expression.
    """
    p = F.filter(ring, lambda q: q["x"].isNotNull() & q["y"].isNotNull())
    # zipped with itself one corner on; an expression of the index would work the whole ring out again for each edge
    pair = F.arrays_zip(p.alias("a"), F.concat(F.slice(p, 2, F.size(p)), F.slice(p, 1, 1)).alias("b"))
    e = rings.where(F.size(p) > 1).select(*by, F.explode(pair).alias("_e"))
    e = e.select(*by, F.col("_e.a.x").alias("x0"), F.col("_e.a.y").alias("y0"), F.col("_e.b.x").alias("x1"), F.col("_e.b.y").alias("y1"))
    return e.where((F.col("x0") != F.col("x1")) | (F.col("y0") != F.col("y1")))


def _rows(low: Column, high: Column, grid: Grid) -> Column:
    """The rows from ``low`` to ``high`` that the grid has; null if there are none."""
    a, b = F.greatest(low, F.lit(0).cast("long")), F.least(high, F.lit(grid.height - 1).cast("long"))
    return F.when(a <= b, F.sequence(a, b))


def _in_blocks(spans: DataFrame, by: list[str], grid: Grid) -> DataFrame:
    """Spans ``row, c0, c1`` kept to the grid and cut where blocks of columns end."""
    s = spans.withColumns({"c0": F.greatest("c0", F.lit(0).cast("long")), "c1": F.least("c1", F.lit(grid.width - 1).cast("long"))}).where("c0 <= c1")
    s = s.withColumn("block", F.explode(F.sequence(F.floor(F.col("c0") / BLOCK), F.floor(F.col("c1") / BLOCK))))
    return s.select(*by, "row", "block", F.greatest("c0", F.col("block") * BLOCK).alias("c0"), F.least("c1", (F.col("block") + 1) * BLOCK - 1).alias("c1"))


def inside_runs(edges: DataFrame, by: list[str], grid: Grid) -> DataFrame:
    """``by, row, block, c0, c1`` of the cells whose centres lie inside, by the even-odd rule.

    Each edge crosses the middle lines of the rows between its ends (the lower
    end counts, the upper one doesn't). A row's crossings in order are the two
    ends of its spans in turn; a centre on a left end is inside. Crossings
    before the same centre cancel in pairs, in each task already, so what is
    shuffled and sorted is bounded by the grid, however many edges there are.
    """
    low, high = F.least("y0", "y1"), F.greatest("y0", "y1")
    first, last = F.floor((grid.top - high) / grid.res - 0.5) + 1, F.floor((grid.top - low) / grid.res - 0.5)
    at = edges.select(*by, *EDGE, F.explode(_rows(first, last, grid)).alias("row"))
    y = grid.y(F.col("row"))
    x = (F.col("x1") - F.col("x0")) * (y - F.col("y0")) / (F.col("y1") - F.col("y0")) + F.col("x0")
    # the first column whose centre isn't left of the crossing, on the grid or just behind it
    c0 = F.least(F.greatest(F.ceil((x - grid.left) / grid.res - 0.5), F.lit(0).cast("long")), F.lit(grid.width).cast("long"))
    ends = at.select(*by, "row", c0.alias("c0")).groupBy(*by, "row", "c0").agg((F.count(F.lit(1)) % 2).alias("odd")).where("odd = 1")
    line = Window.partitionBy(*by, "row").orderBy("c0")
    spans = ends.select(*by, "row", "c0", F.row_number().over(line).alias("k"), (F.lead("c0").over(line) - 1).alias("c1")).where("k % 2 = 1")
    return _in_blocks(spans.select(*by, "row", "c0", "c1"), by, grid)


def edge_runs(edges: DataFrame, by: list[str], grid: Grid) -> DataFrame:
    """``by, row, block, c0, c1`` of the cells that edges meet, their borders included; several edges' runs may overlap."""
    low, high = F.least("y0", "y1"), F.greatest("y0", "y1")
    at = edges.select(*by, *EDGE, F.explode(_rows(F.ceil((grid.top - high) / grid.res) - 1, F.floor((grid.top - low) / grid.res), grid)).alias("row"))
    dy = F.col("y1") - F.col("y0")
    north, south = grid.top - F.col("row") * grid.res, grid.top - (F.col("row") + 1) * grid.res
    x_at = lambda y: F.try_divide((F.col("x1") - F.col("x0")) * (y - F.col("y0")), dy) + F.col("x0")
    # where the edge comes into the row's band and leaves it
    upper, lower = F.least(F.greatest("y0", "y1"), north), F.greatest(F.least("y0", "y1"), south)
    ends = [F.coalesce(x_at(y), F.col(c)) for c, y in (("x0", upper), ("x1", lower))]
    a, b = F.least(*ends), F.greatest(*ends)
    spans = at.select(*by, "row", (F.ceil((a - grid.left) / grid.res) - 1).alias("c0"), F.floor((b - grid.left) / grid.res).alias("c1"))
    return _in_blocks(spans, by, grid)


def area_runs(edges: DataFrame, by: list[str], grid: Grid, all_touched: bool = True) -> DataFrame:
    """Runs of the cells of areas that don't meet: those inside, and with ``all_touched`` those that an edge meets."""
    inside = inside_runs(edges, by, grid)
    if not all_touched:
        return union_runs(inside, by)
    touched = edge_runs(edges, by, grid)
    if not by:  # the edges of one area may be far more than its grid has runs
        touched = touched.distinct()
    return union_runs(inside.unionByName(touched), by)


def clip_to(cells: DataFrame, runs: DataFrame) -> DataFrame:
    """The cells (row, col) that lie in runs, as a semi-join on row and block of columns."""
    keyed = cells.withColumn("_block", F.floor(F.col("col") / BLOCK))
    r = runs.select(F.col("row").alias("_row"), F.col("block").alias("_b"), F.col("c0").alias("_c0"), F.col("c1").alias("_c1"))
    return keyed.join(r, (F.col("row") == F.col("_row")) & (F.col("_block") == F.col("_b")) & F.col("col").between(F.col("_c0"), F.col("_c1")), "left_semi").drop("_block")


def cells_of(runs: DataFrame, by: list[str], raster: DataFrame, values: list[str], block: int = BLOCK) -> DataFrame:
    """``by, row, col`` and the ``values`` of the raster's cells in each area's runs, which are cut into blocks of ``block`` columns; a cell comes once for each area that holds it."""
    r = raster.select(F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), *values).withColumn("block", F.floor(F.col("col") / block))
    return runs.join(r, ["row", "block"]).where(F.col("col").between(F.col("c0"), F.col("c1"))).select(*by, "row", "col", *values)


def polygon_edges(rings: pa.Array, to_raster: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, ...]:
    """Of polygons, arrays of rings of points (x, y): the place of the polygon and ``x0, y0, x1, y1`` of each edge, as ``ring_edges`` has them, each corner brought to the raster's system once."""
    ring = pc.list_flatten(rings)
    points = pc.list_flatten(ring)
    of_ring = np.asarray(pc.list_parent_indices(ring))
    polygon = np.asarray(pc.list_parent_indices(rings))[of_ring]
    part = dict(zip((f.name for f in points.type), points.flatten()))
    x, y = (np.asarray(part[c].cast(pa.float64()).fill_null(np.nan)) for c in "xy")
    there = np.isfinite(x) & np.isfinite(y)
    of_ring, polygon, x, y = of_ring[there], polygon[there], x[there], y[there]
    first = np.flatnonzero(np.diff(of_ring, prepend=-1))
    behind = np.arange(1, len(x) + 1)
    behind[np.append(first[1:], len(x))[: len(first)] - 1] = first
    edge = np.flatnonzero((x != x[behind]) | (y != y[behind]))
    x, y = to_raster(x, y)
    return polygon[edge], x[edge], y[edge], x[behind[edge]], y[behind[edge]]


def runs_of_edges(polygon: np.ndarray, x0: np.ndarray, y0: np.ndarray, x1: np.ndarray, y1: np.ndarray, grid: Grid, all_touched: bool = True) -> tuple[np.ndarray, ...]:
    """``polygon, row, c0, c1`` by the rules of ``inside_runs`` and ``edge_runs``, in runs that don't meet."""
    low, high, wide = np.minimum(y0, y1), np.maximum(y0, y1), grid.width + 1

    def over(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The edge and the row of each row of the grid from ``first`` to ``last``."""
        first, last = np.maximum(first, 0).astype(np.int64), np.minimum(last, grid.height - 1).astype(np.int64)
        n = np.maximum(last - first + 1, 0)
        e = np.repeat(np.arange(len(n)), n)
        return e, np.arange(len(e)) - np.repeat(np.cumsum(n) - n, n) + first[e]

    e, row = over(np.floor((grid.top - high) / grid.res - 0.5) + 1, np.floor((grid.top - low) / grid.res - 0.5))
    y = grid.top - (row + 0.5) * grid.res
    x = (x1[e] - x0[e]) * (y - y0[e]) / (y1[e] - y0[e]) + x0[e]
    c = np.clip(np.ceil((x - grid.left) / grid.res - 0.5), 0, grid.width).astype(np.int64)
    # a line is a row of a polygon; crossings before the same centre cancel in pairs
    at, count = np.unique((polygon[e] * grid.height + row) * wide + c, return_counts=True)
    at = at[count % 2 == 1]
    start, stop = at[::2], at[1::2] - 1
    inside = start % wide < grid.width
    start, stop = start[inside], stop[inside]
    if all_touched:
        e, row = over(np.ceil((grid.top - high) / grid.res) - 1, np.floor((grid.top - low) / grid.res))
        north, south, dy = grid.top - row * grid.res, grid.top - (row + 1) * grid.res, (y1 - y0)[e]
        flat, slope = dy == 0, np.where(dy == 0, 1.0, dy)
        ends = [np.where(flat, f[e], (x1 - x0)[e] * (y - y0[e]) / slope + x0[e]) for f, y in ((x0, np.minimum(high[e], north)), (x1, np.maximum(low[e], south)))]
        c0 = np.maximum(np.ceil((np.minimum(*ends) - grid.left) / grid.res) - 1, 0).astype(np.int64)
        c1 = np.minimum(np.floor((np.maximum(*ends) - grid.left) / grid.res), grid.width - 1).astype(np.int64)
        some = c0 <= c1
        line = ((polygon[e] * grid.height + row) * wide)[some]
        start, stop = np.concatenate([start, line + c0[some]]), np.concatenate([stop, line + c1[some]])
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(stop[order])
    # a column stands between lines, so runs of two lines never meet
    new = np.flatnonzero(np.append(True, start[1:] > reach[:-1] + 1)) if len(start) else np.zeros(0, np.int64)
    start, reach = start[new], reach[np.append(new[1:], len(start))[: len(new)] - 1]
    return start // wide // grid.height, start // wide % grid.height, start % wide, reach % wide


def polygon_runs(alerts: DataFrame, by: list[str], grids: list[Grid], to_raster: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]], all_touched: bool = True, block: int = NARROW) -> DataFrame:
    """``by, grid, row, block, c0, c1``: the cells that polygons have on each of ``grids`` (by its place in the list), many polygons at a time; nothing is shuffled. Each polygon has a row without a grid, too."""
    kinds = dict(alerts.dtypes)
    columns = {"grid": pa.int32(), **dict.fromkeys(("row", "block", "c0", "c1"), pa.int64())}

    def many(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.select(by).columns, *(pa.nulls(len(batch), t) for t in columns.values())], names=[*by, *columns])
            polygon, *edge = polygon_edges(batch.column("rings"), to_raster)
            for g, grid in enumerate(grids):
                rows = np.minimum(np.abs(edge[3] - edge[1]) / grid.res, grid.height) + 2
                strip = np.cumsum(rows) // STRIP
                s = 0
                while s < len(polygon):
                    # whole polygons, of which names of lines must fit 64 bits
                    e = min(int(np.searchsorted(strip, strip[s], "right")), int(np.searchsorted(polygon, polygon[s] + max(1, (1 << 62) // (grid.height * (grid.width + 1))))))
                    e = int(np.searchsorted(polygon, polygon[e - 1], "right"))
                    p, row, c0, c1 = runs_of_edges(polygon[s:e] - polygon[s], *(c[s:e] for c in edge), grid, all_touched)
                    n = c1 // block - c0 // block + 1
                    k = np.repeat(np.arange(len(n)), n)
                    b = np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n) + c0[k] // block
                    key = batch.select(by).take(pa.array(p[k] + polygon[s]))
                    found = np.full(len(k), g, np.int32), row[k], b, np.maximum(c0[k], b * block), np.minimum(c1[k], (b + 1) * block - 1)
                    yield pa.RecordBatch.from_arrays([*key.columns, *map(pa.array, found)], names=[*by, *columns])
                    s = e

    return alerts.select(*by, "rings").mapInArrow(many, ", ".join([*(f"{b} {kinds[b]}" for b in by), "grid int, row bigint, block bigint, c0 bigint, c1 bigint"]))


def annotate_polygons(alerts: DataFrame, by: list[str], collections: dict[str, tuple[DataFrame, Grid]], to_raster: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]] = lambda x, y: (x, y), all_touched: bool = True) -> DataFrame:
    """Land cover of polygons on rasters of any grid and coordinate system: ``by`` and class, group and natural share for each collection.

    ``alerts`` has ``by`` and ``rings``; each collection is a table ``row, col,
    code`` and its grid. Corners go to the raster's system by ``to_raster``, and
    the polygons' cells there come from scanlines as runs. Of the raster only
    blocks of columns that a run needs are kept; where they are small, they go
    to the runs, so places that very many polygons hold aren't one task's.
    Polygons without a cell have nulls.
    """
    scratch = Scratch(alerts.sparkSession, "zones")
    runs = scratch.put(polygon_runs(alerts, by, [grid for _, grid in collections.values()], to_raster, all_touched), "runs")
    kept, out = [runs], runs.where("grid is null").select(*by)
    for g, (name, (raster, _)) in enumerate(collections.items()):
        mine = runs.where(F.col("grid") == g)
        needed = scratch.put(mine.select("row", "block").distinct(), "needed")
        block = {"row": F.col("row").cast("long"), "block": F.floor(F.col("col") / NARROW)}
        codes = scratch.put(raster.select("row", "col", "code").withColumns(block).join(scratch.small(needed), ["row", "block"], "left_semi").drop("block"), "codes")
        kept.append(codes)
        cells = cells_of(mine.repartition(*by), by, scratch.small(codes), ["code"], NARROW)
        found = annotate_landcover(cells, by, "code", name)
        out = out.join(found.select(*by, *[F.col(c).alias(f"{c}_{name}") for c in found.columns if c not in by]), by, "left")
    scratch.keep(*kept)
    return out
