"""Connected regions of alert cells and what lies inside them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from greensward import config
from greensward.functions.detection import landcover_group
from greensward.operators.batches import in_groups
from greensward.operators.graph import connected_components, joined_nearby, smallest_joined
from greensward.plans.scratch import Scratch

#: Cells of a side of the tiles that regions are labelled in.
TILE = 1024


def label_tile(row: np.ndarray, col: np.ndarray, width: int) -> np.ndarray:
    """For each cell the smallest ``row * width + col`` of its 4-connected region among these cells."""
    key = row.astype(np.int64) * width + col
    order = np.argsort(key)
    k = key[order]
    pairs = []
    for step in (1, width):
        at = np.minimum(np.searchsorted(k, k + step), len(k) - 1)
        here = np.flatnonzero(k[at] == k + step)
        pairs.append((here, at[here]))
    label = smallest_joined(len(k), *(np.concatenate([p[i] for p in pairs]) for i in (0, 1)))
    out = np.empty(len(k), np.int64)
    out[order] = k[label]
    return out


def label_regions(cells: DataFrame, image: str = "img", width: int = 1 << 20, tile: int = TILE) -> DataFrame:
    """``cells`` with ``region``: the smallest ``row * width + col`` of its 4-connected region in its image.

    A task labels the cells of one tile of ``tile`` x ``tile``, or of small ones
    many at a time, so its size is bounded. Only cells on the edges of tiles are then joined to their
    neighbours, and the pairs of labels found there, few beside the cells, are
    joined in squares of ``TILE`` x ``TILE`` cells first and then go to the
    component search.
    """
    at = {"_tr": F.floor(F.col("row") / tile), "_tc": F.floor(F.col("col") / tile)}
    names, schema = cells.columns, StructType([*cells.schema.fields, StructField("_local", LongType())])

    def label(table: pa.Table, first: np.ndarray) -> pa.Table:
        """Tiles below one another, a column and a row apart."""
        row, col, tr, tc = (table.column(c).to_numpy().astype(np.int64) for c in ("row", "col", "_tr", "_tc"))
        wide = tile + 1
        down = np.repeat(np.arange(len(first)) * wide, np.diff(np.append(first, len(row))))
        found = label_tile(row - tr * tile + down, col - tc * tile, wide)
        found = (found // wide - down + tr * tile) * width + found % wide + tc * tile
        return table.select(names).append_column("_local", pa.array(found, pa.int64()))

    scratch = Scratch(cells.sparkSession, "regions")
    local = scratch.put(in_groups(cells.withColumns(at), [image, "_tr", "_tc"], label, schema), "tiles")
    pairs = None
    for axis in ("row", "col"):
        side = local.select(F.col(image).alias("img"), "row", "col", F.col("_local").alias("src"))
        upper = side.where(F.col(axis) % tile == tile - 1).withColumn(axis, F.col(axis) + 1)
        lower = side.where(F.col(axis) % tile == 0).withColumnRenamed("src", "dst")
        found = upper.join(lower, ["img", "row", "col"]).select("img", "src", "dst")
        pairs = found if pairs is None else pairs.unionByName(found)
    joined = scratch.put(connected_components(joined_nearby(pairs, width, TILE), scratch=scratch).select(F.col("id.img").alias("_img"), F.col("id.cell").alias("_cell"), F.col("component.cell").alias("_region")), "joined")
    scratch.keep(local, joined)
    out = local.join(scratch.small(joined), (F.col(image) == F.col("_img")) & (F.col("_local") == F.col("_cell")), "left")
    return out.withColumn("region", F.coalesce("_region", "_local")).select(*names, "region")


def area_ha(n: Column, res: float = 20.0) -> Column:
    return n * res * res / 1e4


def area_filter(regions: DataFrame, low: float = config.MIN_AREA_HA, high: float = config.MAX_AREA_HA) -> DataFrame:
    """Both ends included, on unrounded areas."""
    return regions.where(F.col("area_ha").between(low, high))


def zonal_max(cells: DataFrame, by: list[str], value: str) -> DataFrame:
    return cells.groupBy(*by).agg(F.coalesce(F.max(value), F.lit(1)).alias(value))


def zonal_mode(cells: DataFrame, by: list[str], code: str) -> DataFrame:
    """The most frequent code above 0, the smallest on ties; 0 if there is none."""
    n = cells.groupBy(*by, code).agg(F.count(F.lit(1)).alias("n"))
    best = F.max(F.when(F.col(code) > 0, F.struct("n", (-F.col(code)).alias("neg"))))
    return n.groupBy(*by).agg(F.coalesce(-best["neg"], F.lit(0)).cast("int").alias("mode"))


def annotate_landcover(cells: DataFrame, by: list[str], code: str, collection: str = "10m") -> DataFrame:
    """Dominant class, its group and the share of natural cells among those with a class."""
    seen = cells.groupBy(*by, code).agg(F.count(F.lit(1)).alias("n"))
    some = F.col(code) != 0
    # count and class, the smaller before, in one number: a struct's maximum would have all rows sorted
    best = F.max(F.when(some, F.col("n") * (1 << 32) + ((1 << 31) - 1 - F.col(code).cast("long")))).alias("_best")
    natural = landcover_group(F.col(code), collection) == "natural"
    share = F.try_divide(F.sum(F.when(some & natural, F.col("n")).otherwise(0)).cast("double"), F.sum(F.when(some, F.col("n"))))
    zones = seen.groupBy(*by).agg(best, F.bround(share, 3).alias("lc_natural_frac"))
    zones = zones.withColumn("lc_class", ((1 << 31) - 1 - F.pmod("_best", F.lit(1 << 32))).cast("int"))
    return zones.select(*by, "lc_class", F.when(F.col("lc_class").isNotNull(), landcover_group(F.col("lc_class"), collection)).alias("lc_group"), "lc_natural_frac")


def annotate_all(cells: DataFrame, by: list[str], codes: dict[str, str], default: str = "10m") -> DataFrame:
    """``annotate_landcover`` for each collection whose code column is there, in columns with its suffix; the default one again without a suffix.

    Unknown collections and missing columns are skipped; an alert that one
    collection misses has nulls there.
    """
    out, done = cells.select(*by).distinct(), []
    for collection, code in codes.items():
        if collection in config.LANDCOVER_GROUPS and code in cells.columns:
            a = annotate_landcover(cells, by, code, collection)
            out = out.join(a.select(*by, *[F.col(c).alias(f"{c}_{collection}") for c in a.columns if c not in by]), by, "left")
            done.append(collection)
    if default in done:
        out = out.withColumns({c: F.col(f"{c}_{default}") for c in ("lc_class", "lc_group", "lc_natural_frac")})
    return out


def natural_filter(alerts: DataFrame, least: float = config.NATURAL_FRACTION) -> DataFrame:
    """Alerts whose natural share is at least ``least``; an unknown share counts as 0."""
    return alerts.where(F.coalesce("lc_natural_frac", F.lit(0.0)) >= least)


def alert_summary(alerts: DataFrame) -> DataFrame:
    """Counts by confidence and total area; zeros without alerts."""
    level = lambda k: F.count_if(F.col("confidence") == k)
    return alerts.agg(F.count(F.lit(1)).alias("n_alerts"), F.bround(F.coalesce(F.sum("area_ha"), F.lit(0.0)), 2).alias("total_area_ha"), level(1).alias("n_low"), level(2).alias("n_medium"), level(3).alias("n_high"))
