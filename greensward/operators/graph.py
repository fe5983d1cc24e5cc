"""Connected components by repeated contraction, as joins and aggregations."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greensward.operators.batches import in_groups
from greensward.plans.scratch import Scratch


def smallest_joined(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes the smallest one that the edges ``a`` to ``b`` join it to."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        for at in (a, b, label[a], label[b]):
            np.minimum.at(new, at, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def joined_nearby(edges: DataFrame, width: int, side: int, scale: int = 1) -> DataFrame:
    """Edges ``src, dst`` that join the same nodes as ``edges`` (``img`` and two numbers, of cells times ``scale``), as structs of ``img`` and ``cell``.

    The edges of one square of ``side`` x ``side`` cells are joined in a task,
    many squares at a time, and each node gets one edge to the smallest that it
    is joined to there. So a component that squares don't cut is a star, which
    the component search has in one round.
    """
    place = F.floor(F.col("src") / scale)
    dealt = edges.withColumn("_pr", F.floor(place / width / side)).withColumn("_pc", F.floor(place % width / side))

    def star(table: pa.Table, first: np.ndarray) -> pa.Table:
        group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(table))))
        cells, code = np.unique(np.concatenate([table.column(c).to_numpy() for c in ("src", "dst")]), return_inverse=True)
        nodes, at = np.unique(np.tile(group, 2) * len(cells) + code, return_inverse=True)
        low = smallest_joined(len(nodes), at[: len(table)], at[len(table) :])
        leaf = np.flatnonzero(low != np.arange(len(nodes)))
        img = table.column("img").take(pa.array(first[nodes[leaf] // len(cells)]))
        return pa.table({"img": img, "src": pa.array(cells[nodes[leaf] % len(cells)]), "dst": pa.array(cells[nodes[low[leaf]] % len(cells)])})

    kind = dict(edges.dtypes)["img"]
    stars = in_groups(dealt, ["img", "_pr", "_pc"], star, f"img {kind}, src bigint, dst bigint")
    return stars.select(*[F.struct("img", F.col(c).alias("cell")).alias(c) for c in ("src", "dst")])


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", scratch: Scratch | None = None) -> DataFrame:
    """``(id, component)`` for every endpoint of ``edges``; component is its smallest id.

    Each round points every node at the smallest of itself and its neighbours,
    follows the pointers to local minima by doubling, renames both ends of
    every edge to these, and drops loops and repeats. At least half of the
    nodes go in a round; the pointers of all rounds are then followed
    backwards. Aggregations combine before the shuffle and the
    joins are plain equi-joins, so a node with very many edges is dealt with by
    partial aggregation and by splitting skewed joins. Null ends and loops are
    left out; an empty input gives an empty result. Tables go to ``scratch`` if
    one is given, whose owner then decides when they go.
    """
    scratch = scratch or Scratch(edges.sparkSession, "components")
    e = edges.select(F.col(src).alias("u"), F.col(dst).alias("v"))
    e = e.where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
    e = scratch.put(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    steps: list[DataFrame] = []
    while not e.isEmpty():
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        step = both.groupBy("u").agg(F.min("v").alias("v"))
        step = scratch.put(step.select(F.col("u").alias("id"), F.least("u", "v").alias("up")), "pointers")
        moved = True
        while moved:  # pointers lead down to a local minimum; the length halves each time
            hop = step.select(F.col("id").alias("up"), F.col("up").alias("top"))
            far = step.join(hop, "up", "left").select("id", F.coalesce("top", "up").alias("up"), (F.col("top") != F.col("up")).alias("moved"))
            far = scratch.put(far, "jumped")
            moved = not far.where("moved").isEmpty()
            scratch.drop(step)
            step = far
        a = step.select(F.col("id").alias("u"), F.col("up").alias("a"))
        b = step.select(F.col("id").alias("v"), F.col("up").alias("b"))
        new = e.join(a, "u").join(b, "v").where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        last, e = e, scratch.put(new.distinct(), "edges")
        scratch.drop(last)
        steps.append(step)
    if not steps:
        return e.select(F.col("u").alias("id"), F.col("v").alias("component"))
    out = steps[-1]
    for step in reversed(steps[:-1]):
        later = out.select(F.col("id").alias("up"), F.col("up").alias("top"))
        out = scratch.put(step.join(later, "up", "left").select("id", F.coalesce("top", "up").alias("up")), "labels")
    return out.select("id", F.col("up").alias("component"))
