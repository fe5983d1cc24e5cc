"""Composites and monthly baselines: aggregation of a pixel's observations over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greensward.functions.detection import confidence, zscore


def composite(obs: DataFrame, value: Column, how: str, by: list[str]) -> DataFrame:
    """Median, mean or population spread of the values that are there; groups without one are null."""
    agg = {"median": F.median, "mean": F.avg, "std": F.stddev_pop}
    if how not in agg:
        raise ValueError(f"unknown composite {how!r}")
    return obs.groupBy(*by).agg(agg[how](value).alias("value"), F.count(value).alias("n_obs"))


def season(date: Column) -> Column:
    """Wet from November to April, else dry."""
    return F.when(F.month(date).isin(11, 12, 1, 2, 3, 4), "wet").otherwise("dry")


def monthly_baseline(obs: DataFrame, values: dict[str, Column], *, center: str = "median", min_obs_std: int = 2, min_dates: int = 1, years: tuple[int, ...] | None = None, max_cloud: float | None = None) -> DataFrame:
    """``month, pixel`` with ``<index>_center, <index>_std, <index>_n``: all indices in one pass.

    ``years`` and ``max_cloud`` (of ``cloud_cover``, strict) choose the
    observations; months with under ``min_dates`` dates are left out. A pixel's
    observations of one month are few, so their median is taken as it is.
    """
    if years is not None:
        obs = obs.where(F.year("obs_date").isin(*years))
    if max_cloud is not None:
        obs = obs.where(F.col("cloud_cover") < max_cloud)
    if min_dates > 1:
        dates = obs.select(F.month("obs_date").alias("_month"), "obs_date").distinct().groupBy("_month").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") >= min_dates)
        obs = obs.join(F.broadcast(dates.select("_month")), F.month("obs_date") == F.col("_month"), "left_semi")  # twelve rows at most
    aggs = []
    for name, v in values.items():
        n = F.count(v)
        aggs += [(F.median(v) if center == "median" else F.avg(v)).alias(f"{name}_center"), F.when(n >= min_obs_std, F.stddev_pop(v)).alias(f"{name}_std"), n.alias(f"{name}_n")]
    return obs.groupBy(F.month("obs_date").alias("month"), "pixel").agg(*aggs)


def against_baseline(obs: DataFrame, base: DataFrame, values: dict[str, Column], spi: float = 0.0) -> DataFrame:
    """Observations with z-score, change and confidence against their pixel's month."""
    o = obs.withColumns(values).withColumn("month", F.month("obs_date")).join(base, ["month", "pixel"], "left")
    z = {n: zscore(F.col(n), F.col(f"{n}_center"), F.col(f"{n}_std")) for n in values}
    d = {n: F.col(n) - F.col(f"{n}_center") for n in values}
    return o.withColumns({f"z_{n}": c for n, c in z.items()} | {f"delta_{n}": c for n, c in d.items()}).withColumn("confidence", confidence(z, d, spi))


def scene_guard(detected: DataFrame, scene: str, most: float, denominator: str = "all") -> DataFrame:
    """Keep the scenes whose share of alerts isn't above ``most``; of all pixels, or of valid ones."""
    base = F.count(F.lit(1)) if denominator == "all" else F.count_if(F.col("valid"))
    share = F.try_divide(F.count_if(F.col("confidence") > 0), base)
    good = detected.groupBy(scene).agg(share.alias("share")).where(F.coalesce(F.col("share") <= most, F.lit(True))).select(scene)
    return detected.join(good, scene, "left_semi")


def guard_shares(detected: DataFrame, scene: str, most: float) -> DataFrame:
    """``mode, scene, n`` of the scenes that pass the guard by each denominator, in one pass."""
    n, alerts = F.count(F.lit(1)), F.count_if(F.col("confidence") > 0)
    passes = lambda base: F.coalesce(F.try_divide(alerts, base) <= most, F.lit(True))
    both = F.array(F.struct(F.lit("all").alias("mode"), passes(n).alias("keep")), F.struct(F.lit("valid").alias("mode"), passes(F.count_if(F.col("valid"))).alias("keep")))
    return detected.groupBy(scene).agg(n.alias("n"), both.alias("b")).select(F.inline("b"), scene, "n").where("keep").select("mode", scene, "n")


def clear_gate(obs: DataFrame, scene: str, clear: Column, least: float) -> DataFrame:
    """``scene, clear_pct, n`` of the scenes that are clear enough."""
    share = 100.0 * F.count_if(F.coalesce(clear, F.lit(False))) / F.count(F.lit(1))
    return obs.groupBy(scene).agg(share.alias("clear_pct"), F.count(F.lit(1)).alias("n")).where(F.col("clear_pct") >= least)


def mosaic(obs: DataFrame, value: Column, rank: Column, by: list[str], last: bool = False) -> DataFrame:
    """The first (or last) value that is there, by rank."""
    pick = F.max if last else F.min
    return obs.where(value.isNotNull()).groupBy(*by).agg(pick(F.struct(rank.alias("r"), value.alias("v"))).alias("p")).select(*by, F.col("p.v").alias("value"))


def cap_dates(obs: DataFrame, value: str, by: str, limit: float = 1.0) -> DataFrame:
    """Clip ``value`` to [-limit, limit] on the dates that have one above it; other dates stay as they are.

    The dates' maxima, a row each, are joined back, so no date is gathered in one task.
    """
    over = obs.groupBy(F.col(by).alias("cap_key")).agg(F.max(value).alias("top")).where(F.col("top") > limit)
    v = F.col(value)
    clipped = F.when(F.col("top").isNotNull() & v.isNotNull(), F.greatest(F.least(v, F.lit(limit)), F.lit(-limit))).otherwise(v)
    return obs.join(over, F.col(by) == F.col("cap_key"), "left").withColumn(value, clipped).drop("cap_key", "top")


def coverage(base: DataFrame, n: str, by: str, grid_cells: int) -> DataFrame:
    """Most observations of a cell, and the share of the whole grid that has one."""
    seen = 100.0 * F.count_if(F.col(n) > 0) / F.lit(grid_cells)
    return base.groupBy(by).agg(F.max(n).alias("max_obs"), F.round(seen, 6).alias("pct_covered"))
