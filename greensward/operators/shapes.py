"""Overlap of true shapes: cells of an alert as runs of columns by row."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from greensward import config

#: Runs are cut where a block of so many columns ends, so two runs that meet are of one block.
BLOCK = 1024


def runs(cells: DataFrame, by: list[str], block: int = BLOCK) -> DataFrame:
    """``by, row, block, c0, c1``: unbroken columns of each row, both ends included, none over the end of a block of columns. Repeated cells count once."""
    cut = F.floor(F.col("col") / block)
    one = cells.select(*by, F.col("row").cast("long").alias("row"), cut.alias("block"), F.col("col").cast("long").alias("col")).distinct()
    island = F.col("col") - F.row_number().over(Window.partitionBy(*by, "row", "block").orderBy("col"))
    return one.withColumn("_island", island).groupBy(*by, "row", "block", "_island").agg(F.min("col").alias("c0"), F.max("col").alias("c1")).drop("_island")


def sizes(shapes: DataFrame, by: list[str]) -> DataFrame:
    """``by, size``: cells of each shape."""
    return shapes.groupBy(*by).agg(F.sum(F.col("c1") - F.col("c0") + 1).alias("size"))


def shape_pairs(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """``on, a_id, b_id, overlap``: pairs of shapes with common cells, and how many.

    Both sides are runs with ``on, id, row, block, c0, c1``. Rows and blocks of
    columns are the keys of a plain join, and the common part of two runs is one
    subtraction; shapes whose boxes meet but whose cells don't have no row.
    """
    named = lambda d, p: d.select(*on, "row", "block", *[F.col(c).alias(f"{p}_{c}") for c in ("id", "c0", "c1")])
    meet = (F.col("a_c0") <= F.col("b_c1")) & (F.col("b_c0") <= F.col("a_c1"))
    j = named(a, "a").join(named(b, "b"), [*on, "row", "block"]).where(meet)
    common = F.least("a_c1", "b_c1") - F.greatest("a_c0", "b_c0") + 1
    return j.groupBy(*on, "a_id", "b_id").agg(F.sum(common).alias("overlap"))


def union_runs(shapes: DataFrame, by: list[str]) -> DataFrame:
    """``by, row, block, c0, c1``: what any of the shapes of ``by`` covers, in runs that don't meet."""
    line = Window.partitionBy(*by, "row", "block").orderBy("c0", "c1")
    before = F.max("c1").over(line.rowsBetween(Window.unboundedPreceding, -1))
    opened = shapes.withColumn("_new", F.when(F.col("c0") <= before + 1, 0).otherwise(1))
    opened = opened.withColumn("_island", F.sum("_new").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    return opened.groupBy(*by, "row", "block", "_island").agg(F.min("c0").alias("c0"), F.max("c1").alias("c1")).drop("_island")


def stretches(shapes: DataFrame, width: int = 1 << 21) -> DataFrame:
    """``date, id, x0, y0, x1, y1, starts, ends``: each shape as one row, as ``persistence.fold_tracks`` takes it.

    Cells are numbered by row, ``width`` to a row; a stretch ends before ``ends``.
    The box is in cells, rows as y. A row holds one alert's runs, which an alert's
    largest area bounds.
    """
    run = F.struct((F.col("row") * width + F.col("c0")).alias("a"), (F.col("row") * width + F.col("c1") + 1).alias("b"))
    box = [F.min("c0").alias("x0"), F.min("row").alias("y0"), (F.max("c1") + 1).alias("x1"), (F.max("row") + 1).alias("y1")]
    one = shapes.groupBy("date", "id").agg(*box, F.array_sort(F.collect_list(run)).alias("_runs"))
    return one.select("date", "id", "x0", "y0", "x1", "y1", F.col("_runs.a").alias("starts"), F.col("_runs.b").alias("ends"))


def ranked(shapes: DataFrame) -> DataFrame:
    """Shapes with ``rank``, the number of their date among all dates."""
    dates = shapes.select("date").distinct().withColumn("rank", F.row_number().over(Window.orderBy("date")))
    return shapes.join(F.broadcast(dates), "date")  # a row for each date


def union_share(shapes: DataFrame, back: int = 1) -> DataFrame:
    """``date, id, share`` of a shape's cells that the union of the observation ``back`` dates before covers; 0 without one."""
    now = ranked(shapes)
    before = union_runs(now.select((F.col("rank") + back).alias("rank"), "row", "block", "c0", "c1"), ["rank"])
    hit = shape_pairs(now.withColumn("id", F.struct("date", "id")), before.withColumn("id", F.lit(0)), ["rank"]).select("a_id.date", "a_id.id", "overlap")
    return sizes(shapes, ["date", "id"]).join(hit, ["date", "id"], "left").select("date", "id", (F.coalesce("overlap", F.lit(0)) / F.col("size")).alias("share"))


def strict_shapes(shapes: DataFrame, least: float = config.MIN_OVERLAP, previous: int = 1) -> DataFrame:
    """``date, id`` of shapes whose overlap with the union of each of the ``previous`` observations reaches ``least``."""
    kept = None
    for k in range(1, previous + 1):
        good = union_share(shapes, k).where(F.col("share") >= least).select("date", "id")
        kept = good if kept is None else kept.join(good, ["date", "id"], "left_semi")
    return kept


def with_previous(shapes: DataFrame, least: float = config.MIN_OVERLAP) -> DataFrame:
    """``rank, date, a_id, b_id, overlap, size``: a shape and each one of the observation before that covers ``least`` of it."""
    now = ranked(shapes)
    pairs = shape_pairs(now, now.withColumn("rank", F.col("rank") + 1), ["rank"])
    size = sizes(now, ["rank", "date", "id"]).withColumnRenamed("id", "a_id")
    return pairs.join(size, ["rank", "a_id"]).where(F.col("overlap") >= least * F.col("size")).select("rank", "date", "a_id", "b_id", "overlap", "size")
