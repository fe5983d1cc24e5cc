"""Profiles, verdicts, year ranking and sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from greensward.operators.quantiles import finite, with_quantiles
from greensward.operators.spatial import utm_inverse

#: Fixed limits of the verdict: fail and warn.
FAIL = {"out_of_range": 0.01, "high": 0.02, "low": 0.05}
WARN = {"out_of_range": 0.001, "high": 0.005, "kurtosis": 10.0, "nodata": 0.15}


def profile(values: DataFrame, by: list[str], value: str = "v") -> DataFrame:
    """Moments, percentiles and shares; null, 0 and values that aren't finite are no data. Moments are of the population, kurtosis in excess.

    Percentiles come from histograms (``exact_quantiles``), so groups may be of any size.
    """
    values = values.withColumn(value, finite(F.when(F.col(value) != 0, F.col(value))))
    v = F.col(value)
    share = lambda c: F.round(F.try_divide(F.count_if(c), F.count(v)), 6)
    r = lambda c: F.round(c, 6)
    out = values.groupBy(*by).agg(
        F.count(v).alias("n"),
        r(F.lit(1.0) - F.count(v) / F.count(F.lit(1))).alias("nodata"),
        r(F.avg(v)).alias("mean"), r(F.stddev_pop(v)).alias("std"), r(F.min(v)).alias("min"), r(F.max(v)).alias("max"),
        share((v < -1) | (v > 1)).alias("out_of_range"), share(v > 0.95).alias("high"), share(v < -0.95).alias("low"), share(F.abs(v) < 0.005).alias("near_zero"),
        F.round(F.skewness(v), 4).alias("skew"), F.round(F.kurtosis(v), 4).alias("kurtosis"),
    )
    shares = {"median": 0.5, "p01": 0.01, "p99": 0.99}
    return with_quantiles(out, values, by, value, shares).withColumns({n: r(F.col(n)) for n in shares})


def verdict(profiles: DataFrame, by: list[str]) -> DataFrame:
    """``by, overall, issues, warnings`` from the means of a group's profiles, one for each file; files without a figure are left out of its mean."""
    c = F.col
    means = profiles.groupBy(*by).agg(*[F.avg(k).alias(k) for k in (*FAIL, "kurtosis", "nodata")])
    issues = F.array_compact(F.array(*[F.when(c(k) > x, F.lit(k)) for k, x in FAIL.items()]))
    warn = {k: (c(k) > x) & (c(k) <= FAIL[k] if k in FAIL else F.lit(True)) for k, x in WARN.items()}
    warnings = F.array_compact(F.array(*[F.when(x, F.lit(k)) for k, x in warn.items()]))
    return means.select(*by, F.when(F.size(issues) > 0, "FAIL").otherwise("PASS").alias("overall"), F.array_join(issues, ",").alias("issues"), F.array_join(warnings, ",").alias("warnings"))


def coverage_counts(scenes: DataFrame, keys: list[str]) -> DataFrame:
    """Scenes and dates by year, by tile, or by both."""
    return scenes.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("obs_date").alias("n_dates"))


def landcover_checks(cells: DataFrame, code: str) -> DataFrame:
    """Share of valid cells and the checks on a class histogram."""
    n = cells.groupBy(F.col(code).alias("code")).agg(F.count(F.lit(1)).alias("n"))
    valid = F.lit(1.0) - F.sum(F.when(F.col("code") == 0, F.col("n")).otherwise(0)) / F.sum("n")
    out = n.agg(
        F.round(valid, 4).alias("valid_frac"), F.count(F.lit(1)).alias("n_classes"), (valid > 0.5).alias("has_valid_data"),
        F.bool_and(F.col("code").between(0, 62)).alias("plausible_classes"), F.bool_or(F.col("code").isin(3, 4, 12)).alias("vegetation_present"),
    )
    return out.withColumn("passed", F.col("has_valid_data") & F.col("plausible_classes") & F.col("vegetation_present"))


def parse_oni(text: Column) -> Column:
    """The rows of a climate index table as an array of (year, seq, anom) structs, in order.

    A row is a season, a year and an anomaly between white space; rows end at
    line ends or bars. What has other fields, a header or a note, is left out.
    """
    rows = F.transform(F.split(text, "[\\n|]"), lambda line: F.filter(F.split(line, "\\s+"), lambda f: f != ""))
    read = F.transform(rows, lambda f: F.struct(F.get(f, F.lit(0)).alias("season"), F.try_to_number(F.get(f, F.lit(1)), F.lit("9999")).cast("int").alias("year"), F.get(f, F.lit(-1) + F.size(f)).try_cast("double").alias("anom"), F.size(f).alias("k")))
    good = F.filter(read, lambda r: (r["k"] >= 3) & (F.length(r["season"]) == 3) & r["year"].isNotNull() & r["anom"].isNotNull())
    return F.transform(good, lambda r, i: F.struct(r["year"].alias("year"), i.alias("seq"), r["anom"].alias("anom")))


def rank_years(oni: DataFrame, rain: DataFrame, *, max_severity: float = 1.5, w_enso: float = 1.0, w_rain: float = 0.5, n: int = 5) -> DataFrame:
    """``year, peak, severity, annual, precip_z, score, eligible, recent, least`` with the choice of the ``n`` most recent eligible and the ``n`` lowest scores.

    The peak is the first anomaly of the largest size; rain counts only for
    years with all 12 months, its z against those years if there are two.
    """
    peak = F.max_by("anom", F.struct(F.abs("anom"), -F.col("seq")))
    o = oni.groupBy("year").agg(peak.alias("peak")).withColumn("severity", F.abs("peak"))
    r = rain.groupBy("year").agg(F.sum("mm").alias("annual"), F.countDistinct("month").alias("months")).where("months = 12").select("year", "annual")
    every = Window.partitionBy()
    sd = F.stddev_pop("annual").over(every)
    z = F.when((F.count("annual").over(every) >= 2) & (sd > 0), (F.col("annual") - F.avg("annual").over(every)) / sd)
    out = o.join(r.withColumn("precip_z", z), "year", "left")
    out = out.withColumn("score", w_enso * F.col("severity") + w_rain * F.coalesce(F.abs("precip_z"), F.lit(0.0))).withColumn("eligible", F.col("severity") < max_severity)
    recent = F.col("eligible") & (F.row_number().over(Window.partitionBy("eligible").orderBy(F.desc("year"))) <= n)
    least = F.row_number().over(Window.orderBy("score", F.desc("year"))) <= n
    return out.withColumns({"recent": recent, "least": least})


def stratified_sample(rows: DataFrame, strata: list[str], key: Column, n: int = 15) -> DataFrame:
    """At most ``n`` rows of each stratum by the order of ``key``; null is a stratum."""
    return rows.withColumn("rn", F.row_number().over(Window.partitionBy(*strata).orderBy(key))).where(F.col("rn") <= n).drop("rn")


def bounded_sample(rows: DataFrame, by: list[str], key: Column, most: int = 50_000) -> DataFrame:
    """At most ``most`` rows of each group, those with the smallest ``key``; exactly all of a smaller group.

    With a hash of what tells rows apart as the key this is uniform without
    replacement, and the same for any partitioning. Each task keeps the smallest
    of its own rows before anything is shuffled (the limit on ``row_number`` is
    worked out on both sides), so a group is never gathered. Of equal keys any
    may stay, so the key should be one.
    """
    place = F.row_number().over(Window.partitionBy(*by).orderBy("_key"))
    return rows.withColumn("_key", key).withColumn("_place", place).where(F.col("_place") <= most).drop("_key", "_place")


def sample_sheet(sample: DataFrame, order: Column) -> DataFrame:
    """The sheet that a person fills in: numbered alerts with the middle of their box in degrees to six decimals, and an empty verdict.

    The sample is bounded by its strata, so one task numbers it. Columns that
    alerts lack are empty.
    """
    lon, lat = utm_inverse((F.col("x0") + F.col("x1")) / F.lit(2.0), (F.col("y0") + F.col("y1")) / F.lit(2.0))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in sample.columns else F.lit("")
    fields = ("source_file", "detection_date", "confidence", "lc_group", "lc_natural_frac", "clearing_type", "persistence_status", "area_ha")
    number = (F.row_number().over(Window.orderBy(order)) - 1).alias("sample_id")
    return sample.select(number, *[text(c).alias(c) for c in fields], F.round(lat, 6).alias("centroid_lat"), F.round(lon, 6).alias("centroid_lon"), F.lit("").alias("verdict"), F.lit("").alias("notes"))


def commission_error(verdicts: DataFrame, tier: str = "tier", verdict: str = "verdict") -> DataFrame:
    """FP / (TP + FP) by tier."""
    fp, tp = F.count_if(F.col(verdict) == "FP"), F.count_if(F.col(verdict) == "TP")
    return verdicts.groupBy(tier).agg(F.try_divide(fp, tp + fp).alias("commission_error"))


def histogram(values: DataFrame, value: str, low: float, high: float, bins: int) -> DataFrame:
    """``bucket, n``: exact counts of equal bins; 0 is below the range, ``bins + 1`` above it, nulls are left out."""
    return values.where(F.col(value).isNotNull()).groupBy(F.width_bucket(F.col(value), F.lit(low), F.lit(high), F.lit(bins)).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
