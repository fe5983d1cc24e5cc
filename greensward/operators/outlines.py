"""Outlines of labelled regions: closed rings around them and their holes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greensward.operators.batches import in_groups
from greensward.operators.graph import connected_components, joined_nearby
from greensward.operators.regions import TILE
from greensward.plans.scratch import Scratch

#: Sides of a cell against the clock (below, right, above, left): the step to the neighbour, and where the side starts from the cell's upper left corner.
_STEP = np.array([(1, 0), (0, 1), (-1, 0), (0, -1)])
_START = np.array([(1, 0), (1, 1), (0, 1), (0, 0)])


def trace_tile(row: np.ndarray, col: np.ndarray, region: np.ndarray, own: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Chains of directed sides of the ``own`` cells: region, first side, the side behind the last, and the corners of each.

    A side stands between a cell and a neighbour that isn't of its region, with
    the cell on its left. At its end the chain turns to the diagonal cell if
    that is of the region, else goes straight on to the next cell's side, else
    turns around its own cell: so a region that touches itself in a point has
    one ring around it and its own ring for each hole. Sides are numbered by cell
    (``row * width + col``) times 4; a closed chain ends with its first side.
    The cells around the own ones must be there, and chains that go on to them end there.
    """
    key = row.astype(np.int64) * width + col
    order = np.argsort(key)
    key, row, col, region, own = key[order], row[order].astype(np.int64), col[order].astype(np.int64), region[order], own[order]

    def near(cell: np.ndarray, side: np.ndarray) -> np.ndarray:
        """Place of the neighbour of the same region, or -1."""
        c = col[cell] + _STEP[side, 1]
        k = key[cell] + _STEP[side, 0] * width + _STEP[side, 1]
        at = np.minimum(np.searchsorted(key, k), len(key) - 1)
        return np.where((key[at] == k) & (c >= 0) & (region[at] == region[cell]), at, -1)

    cell, side = (x.ravel() for x in np.meshgrid(np.flatnonzero(own), np.arange(4), indexing="ij"))
    edge = near(cell, side) < 0
    cell, side = cell[edge], side[edge]
    turn = (side + 1) % 4
    ahead = near(cell, turn)
    # the diagonal cell may be there though the one ahead isn't
    r, c = (x[cell] + _STEP[side, i] + _STEP[turn, i] for i, x in enumerate((row, col)))
    at = np.minimum(np.searchsorted(key, r * width + c), len(key) - 1)
    across = np.where((key[at] == r * width + c) & (c >= 0) & (region[at] == region[cell]), at, -1)
    to = np.where(across >= 0, across, np.where(ahead >= 0, ahead, cell))
    to_side = np.where(across >= 0, (side + 3) % 4, np.where(ahead >= 0, side, turn))
    name, name_to = key[cell] * 4 + side, key[to] * 4 + to_side
    by_name = np.argsort(name)
    place = np.minimum(np.searchsorted(name[by_name], name_to), max(len(name) - 1, 0))
    follows = np.where(own[to], by_name[place], -1) if len(name) else place
    behind = np.full(len(name), -1)
    behind[follows[follows >= 0]] = np.flatnonzero(follows >= 0)
    corner = (row[cell] + _START[side, 0]) * (2 * width) + col[cell] + _START[side, 1]
    bends = (behind < 0) | (side != side[behind])
    seen = np.zeros(len(name), bool)
    nexts, heads, chains = follows.tolist(), [], []
    for first in [*np.flatnonzero(behind < 0).tolist(), *by_name.tolist()]:
        if not seen[first]:
            path, k = [], first
            while k >= 0 and not seen[k]:
                seen[k] = True
                path.append(k)
                k = nexts[k]
            heads.append((first, path[-1]))
            p = np.array(path)
            chains.append(corner[p[bends[p]]])
    a, b = np.array(heads, np.int64).reshape(-1, 2).T
    return region[cell[a]], name[a], name_to[b], chains


def closed_rings(corners: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rings one behind the other, of which ``first`` tells the starts: closed, from the smallest corner on, those on straight lines left out; how many corners each has then, and its area in cells, below 0 for holes."""

    def turns(first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the corners before and behind each one."""
        before, behind, last = np.arange(n) - 1, np.arange(n) + 1, np.append(first[1:], n) - 1
        before[first], behind[last] = last, first
        return before, behind

    y, x = -(corners // (2 * width)), corners % (2 * width)
    before, behind = turns(first, len(corners))
    bend = (x[before] - x) * (y[behind] - y) != (y[before] - y) * (x[behind] - x)
    count = np.add.reduceat(bend, first, dtype=np.int64)
    corners, y, x = corners[bend], y[bend], x[bend]
    first = np.cumsum(count) - count
    _, behind = turns(first, len(corners))
    twice = np.add.reduceat(x * y[behind] - x[behind] * y, first)
    at = np.flatnonzero(corners == np.repeat(np.minimum.reduceat(corners, first), count))
    smallest = at[np.searchsorted(at, first)] - first
    k = np.arange(int((count + 1).sum())) - np.repeat(np.cumsum(count + 1) - count - 1, count + 1)
    return corners[np.repeat(first, count + 1) + (np.repeat(smallest, count + 1) + k) % np.repeat(count, count + 1)], count + 1, twice // 2


def outlines(cells: DataFrame, image: str = "img", width: int = 1 << 20, tile: int = TILE) -> DataFrame:
    """``image, region, cells, ring`` of each ring: ``ring`` closed corners (row, col), ``cells`` its area, below 0 for holes.

    ``cells`` has ``image, row, col, region`` as ``label_regions`` leaves it. Rings
    run against the clock around a region and with it around holes, seen with
    north (row 0) up. A task chains the sides of one tile, which it sees with a
    border of one cell; chains that leave their tile are then joined to rings by
    the components of their ends, in squares of ``TILE`` x ``TILE`` cells first, so a task holds a tile, or one ring of it;
    small ones are worked on many at a time.
    """
    spark = cells.sparkSession
    scratch = Scratch(spark, "outlines")
    around = lambda c: F.array_distinct(F.array(*(F.floor((F.col(c) + k) / tile) for k in (-1, 0, 1))))
    dealt = cells.select(F.col(image).alias("img"), F.col("row").cast("long"), F.col("col").cast("long"), F.col("region").cast("long"))
    dealt = dealt.withColumn("_tr", F.explode(around("row"))).withColumn("_tc", F.explode(around("col")))

    def trace(table: pa.Table, first: np.ndarray) -> pa.Table:
        """Tiles with their borders below one another, where they don't meet; what is found goes back to its tile."""
        row, col, region, tr, tc = (table.column(c).to_numpy() for c in ("row", "col", "region", "_tr", "_tc"))
        own = (row // tile == tr) & (col // tile == tc)
        wide = tile + 4
        down = np.repeat(np.arange(len(first)) * wide, np.diff(np.append(first, len(row))))
        found, head, after, chains = trace_tile(row - tr * tile + 1 + down, col - tc * tile + 1, region, own, wide)
        up, left = tr[first] * tile - 1, tc[first] * tile - 1

        def placed(at: np.ndarray, of: np.ndarray, columns: int, whole: int) -> np.ndarray:
            return (at // columns - of * wide + up[of]) * whole + at % columns + left[of]

        of = head // (4 * wide * wide)
        lengths = np.array([len(c) for c in chains], np.int64)
        flat = placed(np.concatenate(chains), np.repeat(of, lengths), 2 * wide, 2 * width) if chains else np.zeros(0, np.int64)
        head, after = (placed(k // 4, of, wide, width) * 4 + k % 4 for k in (head, after))
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        img = table.column("img").take(pa.array(first[of]))
        return pa.table({"img": img, "region": pa.array(found, pa.int64()), "head": pa.array(head, pa.int64()), "after": pa.array(after, pa.int64()), "corners": pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int64()))})

    kind = dict(dealt.dtypes)["img"]
    chain = f"img {kind}, region bigint, head bigint, after bigint, corners array<bigint>"
    chains = scratch.put(in_groups(dealt, ["img", "_tr", "_tc"], trace, chain), "chains")
    open_ = chains.where("head <> after")
    ends = joined_nearby(open_.select("img", F.col("head").alias("src"), F.col("after").alias("dst")), width, TILE, 4)
    ring_of = connected_components(ends, scratch=scratch)
    ring_of = scratch.put(ring_of.select(F.col("id.img").alias("_img"), F.col("id.cell").alias("_edge"), F.col("component.cell").alias("ring")), "rings")
    parts = open_.join(ring_of, (F.col("img") == F.col("_img")) & (F.col("head") == F.col("_edge"))).drop("_img", "_edge")

    def close(table: pa.Table, first: np.ndarray) -> pa.Table:
        head, after, lists = (table.column(c).to_pylist() for c in ("head", "after", "corners"))
        rings: list[list[int]] = []
        for s, e in zip(first.tolist(), [*first[1:].tolist(), len(head)]):
            place = {head[k]: k for k in range(s, e)}
            k, corners = place[min(place)], []
            for _ in range(s, e):
                corners += lists[k]
                k = place[after[k]]
            rings.append(corners)
        one = table.take(pa.array(first))
        return pa.table({"img": one.column("img"), "region": one.column("region"), "head": one.column("head"), "after": one.column("head"), "corners": pa.array(rings, pa.list_(pa.int64()))})

    closed = chains.where("head = after").unionByName(scratch.put(in_groups(parts, ["img", "ring"], close, chain), "joined"))

    def finish(batches):
        for b in batches:
            if b.num_rows:
                lists = b.column("corners")
                ends = np.asarray(lists.offsets)
                flat, count, area = closed_rings(np.asarray(lists.flatten()), (ends - ends[0])[:-1].astype(np.int64), width)
                point = pa.StructArray.from_arrays([pa.array(flat // (2 * width)), pa.array(flat % (2 * width))], names=["row", "col"])
                rings = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32)), point)
                yield pa.RecordBatch.from_arrays([b.column("img"), b.column("region"), pa.array(area), rings], names=["img", "region", "cells", "ring"])

    out = closed.select("img", "region", "corners").mapInArrow(finish, f"img {kind}, region bigint, cells bigint, ring array<struct<row:bigint,col:bigint>>")
    return out.withColumnRenamed("img", image)


def polygons(rings: DataFrame, image: str = "img", left: float = 0.0, top: float = 0.0, res: float = 20.0) -> DataFrame:
    """``image, region, rings``: the outer ring of each region and then its holes, as points (x, y) in metres."""
    point = lambda p: F.struct((left + p["col"] * res).alias("x"), (top - p["row"] * res).alias("y"))
    one = F.struct((F.col("cells") < 0).alias("hole"), F.col("ring")[0].alias("first"), F.transform("ring", point).alias("ring"))
    return rings.groupBy(image, "region").agg(F.transform(F.array_sort(F.collect_list(one)), lambda r: r["ring"]).alias("rings"))


def simple_ring(points: np.ndarray, tolerance: float) -> np.ndarray:
    """A closed ring without the corners that lie within ``tolerance`` of the lines between those kept (Douglas and Peucker's rule).

    The ring is cut at its first corner and the one farthest from it, which stay;
    so does the one farthest from their line, so a ring keeps three corners.
    """
    p = points[:-1]
    n = len(p)
    if n <= 3:
        return points
    far = int(((p - p[0]) ** 2).sum(1).argmax())
    keep = np.zeros(n + 1, bool)
    keep[[0, far, n]] = True
    closed = np.concatenate([p, p[:1]])

    def off(a: int, b: int) -> np.ndarray:
        """Distance of the corners between a and b from the stretch a to b."""
        start, line, q = closed[a], closed[b] - closed[a], closed[a + 1 : b]
        t = np.clip((q - start) @ line / max(float(line @ line), 1e-300), 0.0, 1.0)
        return np.sqrt(((q - start - t[:, None] * line) ** 2).sum(1))

    todo = [(0, far), (far, n)]
    while todo:
        a, b = todo.pop()
        if b - a > 1:
            d = off(a, b)
            k = a + 1 + int(d.argmax())
            if d.max() > tolerance:
                keep[k] = True
                todo += [(a, k), (k, b)]
    if keep[:n].sum() < 3:
        sides = [(a + 1 + int(d.argmax()), float(d.max())) for a, b in ((0, far), (far, n)) if b - a > 1 for d in [off(a, b)]]
        keep[max(sides, key=lambda s: s[1])[0]] = True
    return closed[keep]


def simplify(shapes: DataFrame, tolerance: float = 12.0, rings: str = "rings") -> DataFrame:
    """Polygons whose rings keep only the corners that they need to stay within ``tolerance`` metres; rings stay closed, and none goes."""
    point = pa.struct([("x", pa.float64()), ("y", pa.float64())])

    @F.arrow_udf("array<array<struct<x:double,y:double>>>")
    def simple(column: pa.Array) -> pa.Array:
        out = []
        for polygon in column.to_pylist():
            done = [simple_ring(np.array([(p["x"], p["y"]) for p in ring]), tolerance) for ring in polygon or []]
            out.append(None if polygon is None else [[{"x": x, "y": y} for x, y in ring.tolist()] for ring in done])
        return pa.array(out, pa.list_(pa.list_(point)))

    return shapes.withColumn(rings, simple(F.col(rings)))
