"""Exact quantiles of groups of any size, by histograms that close in on the ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from greensward.plans.scratch import Scratch

#: Cells of a histogram; a cell of at most so many different values is sorted.
CELLS, SORTED = 4096, 50_000


def finite(v: Column) -> Column:
    """The value, null if it is NaN or infinite."""
    return F.when(F.abs(v) < F.lit(float("inf")), v)


def exact_quantiles(values: DataFrame, by: list[str], value: str, shares: list[float], *, cells: int = CELLS, most: int = SORTED) -> DataFrame:
    """``by`` and ``q0, q1, ...``, the quantiles of ``shares`` with linear interpolation.

    Nulls and values that aren't finite are no data; groups without a value have no row.

    A quantile lies between two ranks. Every rank starts with its group's whole
    range; a histogram of the range tells the cell that holds the rank and how
    many values lie below it, and the cell's own smallest and largest values are
    the next range, until it has one value or few enough to be sorted. So no task
    gathers a group: what is shuffled are counts of cells, and at the end the
    counted values of one cell for each rank.
    """
    scratch = Scratch(values.sparkSession, "quantiles")
    v = F.col("v")
    rows = values.select(*by, finite(F.col(value).cast("double")).alias("v")).where("v is not null")
    rows = scratch.put(rows, "values")
    ends = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    ranks = F.array(*[F.struct(F.lit(i).alias("q"), F.lit(k).alias("upper"), (F.floor(F.lit(p) * (F.col("n") - 1)) + k).alias("rank")) for i, p in enumerate(shares) for k in (0, 1)])
    ask = ends.select(*by, "n", "lo", "hi", F.inline(ranks)).where(F.col("rank") < F.col("n")).withColumns({"below": F.lit(0).cast("long"), "m": F.col("n")})
    ask = scratch.put(ask, "ranks")
    state = [*by, "q", "upper", "rank", "n"]
    same = lambda a, b: _all([F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in by])
    while not (wide := ask.where((F.col("m") > most) & (F.col("lo") < F.col("hi")))).isEmpty():
        ranges = scratch.put(wide.select(*by, "lo", "hi").distinct(), "ranges")
        inside = rows.alias("r").join(scratch.small(ranges).alias("k"), same("r", "k") & v.between(F.col("lo"), F.col("hi")))
        # halves keep a range wider than the largest double; its ends always fall into two cells, so every round shrinks it
        half = F.when(F.col("hi") - F.col("lo") < F.lit(float("inf")), F.lit(1.0)).otherwise(0.5)
        cell = F.least(F.floor((v * half - F.col("lo") * half) / (F.col("hi") * half - F.col("lo") * half) * cells), F.lit(cells - 1))
        hist = inside.select(*[F.col(f"r.{c}") for c in by], "lo", "hi", "v", cell.alias("cell")).groupBy(*by, "lo", "hi", "cell")
        hist = hist.agg(F.count(F.lit(1)).alias("m"), F.min("v").alias("first"), F.max("v").alias("last"))
        before = Window.partitionBy(*by, "lo", "hi").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        hist = scratch.put(hist.withColumn("before", F.coalesce(F.sum("m").over(before), F.lit(0))), "cells")
        near = wide.alias("w").join(hist.alias("h"), same("w", "h") & (F.col("w.lo") == F.col("h.lo")) & (F.col("w.hi") == F.col("h.hi")))
        at = F.col("rank") - F.col("below")
        near = near.where((at >= F.col("before")) & (at < F.col("before") + F.col("h.m")))
        near = near.select(*[F.col(f"w.{c}") for c in state], F.col("first").alias("lo"), F.col("last").alias("hi"), (F.col("below") + F.col("before")).alias("below"), F.col("h.m").alias("m"))
        rest = ask.where((F.col("m") <= most) | (F.col("lo") == F.col("hi")))
        ask = scratch.put(near.unionByName(rest.select(*state, "lo", "hi", "below", "m")), "ranks")
    open_ = ask.where("lo < hi")
    ranges = scratch.small(scratch.put(open_.select(*by, "lo", "hi").distinct(), "last"))
    inside = rows.alias("r").join(ranges.alias("k"), same("r", "k") & v.between(F.col("lo"), F.col("hi")))
    counted = inside.select(*[F.col(f"r.{c}") for c in by], "lo", "hi", "v").groupBy(*by, "lo", "hi", "v").agg(F.count(F.lit(1)).alias("m"))
    upto = Window.partitionBy(*by, "lo", "hi").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    counted = counted.withColumn("upto", F.sum("m").over(upto))
    at = F.col("rank") - F.col("below")
    found = open_.alias("w").join(counted.alias("h"), same("w", "h") & (F.col("w.lo") == F.col("h.lo")) & (F.col("w.hi") == F.col("h.hi")))
    found = found.where((at < F.col("upto")) & (at >= F.col("upto") - F.col("h.m"))).select(*[F.col(f"w.{c}") for c in state], "v")
    found = found.unionByName(ask.where("lo = hi").select(*state, F.col("lo").alias("v")))
    pick = lambda i, k: F.max(F.when((F.col("q") == i) & (F.col("upper") == k), F.col("v")))
    out = found.groupBy(*by, "n").agg(*[pick(i, k).alias(f"v{i}_{k}") for i in range(len(shares)) for k in (0, 1)])
    place = [F.lit(p) * (F.col("n") - 1) for p in shares]
    low = lambda i: F.col(f"v{i}_0")
    between = [low(i) + (F.coalesce(F.col(f"v{i}_1"), low(i)) - low(i)) * (x - F.floor(x)) for i, x in enumerate(place)]
    return out.select(*by, *[c.alias(f"q{i}") for i, c in enumerate(between)])


def with_quantiles(stats: DataFrame, values: DataFrame, by: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """``stats`` of the groups ``by``, null ones among them, with a column for each of the ``shares``; null for groups without a value."""
    q = exact_quantiles(values, by, value, list(shares.values()))
    q = q.select(*[F.col(c).alias(f"_by_{c}") for c in by], *[F.col(f"q{i}").alias(n) for i, n in enumerate(shares)])
    return stats.join(q, _all([F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]), "left").drop(*[f"_by_{c}" for c in by])


def _all(conditions: list):
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out
