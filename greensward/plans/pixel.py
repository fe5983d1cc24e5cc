"""Queries over pixel observations, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greensward.functions import indices as ix
from greensward.functions.detection import clearing
from greensward.operators import composites, quality, series, spatial
from greensward.plans.registry import registry
from greensward.sources import scenes
from greensward.sources.observations import OBS_SQL, observations, table

QUERIES, SQL, query = registry()

_FORMULA = {
    "ndvi": "(nir - red) / nullif(nir + red, 0)",
    "evi2": "2.5::DOUBLE * (nir - red) / nullif(nir + 2.4::DOUBLE * red + 1, 0)",
    "ndmi": "(nir08 - swir16) / nullif(nir08 + swir16, 0)",
    "nbr": "(nir08 - swir22) / nullif(nir08 + swir22, 0)",
    "savi": "1.5::DOUBLE * (nir - red) / nullif(nir + red + 0.5::DOUBLE, 0)",
    "bsi": "((swir16 + red) - (nir + blue)) / nullif((swir16 + red) + (nir + blue), 0)",
}
_SCL = "scl IN (2, 4, 5, 6, 7, 11)"


for _n, _f in _FORMULA.items():
    query(f"idx_{_n}", f"WITH {OBS_SQL} SELECT obs_id, round({_f}, 6) AS value FROM obs")(lambda spark, d, n=_n: observations(spark, d).select("obs_id", F.round(ix.index_column(n), 6).alias("value")))


@query("idx_dnbr", f"WITH {OBS_SQL} SELECT obs_id, round((nir08 - swir22) / nullif(nir08 + swir22, 0) - (nir - swir22) / nullif(nir + swir22, 0), 6) AS value FROM obs")
def idx_dnbr(spark, d) -> DataFrame:
    c = F.col
    return observations(spark, d).select("obs_id", F.round(ix.dnbr(ix.nbr(c("nir08"), c("swir22")), ix.nbr(c("nir"), c("swir22"))), 6).alias("value"))


for _n, _clear, _sql in (("mask_scl", lambda: ix.clear_scl(F.col("scl")), _SCL), ("mask_qa_landsat", lambda: ix.clear_landsat(F.col("qa")), "(qa & 24) = 0"), ("mask_qa_hls", lambda: ix.clear_hls(F.col("qa")), "(qa & 14) = 0")):
    query(_n, f"WITH {OBS_SQL} SELECT obs_id, CASE WHEN {_sql} THEN round(nir, 6) END AS value FROM obs")(lambda spark, d, c=_clear: observations(spark, d).select("obs_id", ix.masked(F.round("nir", 6), c()).alias("value")))


@query("reflectance_scale", f"""WITH {OBS_SQL}, s AS (SELECT obs_id, nullif(dn, 0)::DOUBLE AS raw, obs_date, CASE obs_id % 3 WHEN 0 THEN 's2' WHEN 1 THEN 'landsat' ELSE 'hls' END AS sensor FROM obs)
SELECT obs_id, CASE WHEN raw IS NOT NULL THEN round(greatest(raw * CASE WHEN sensor = 'landsat' THEN 2.75e-5 ELSE 1e-4 END
  + CASE WHEN sensor = 'landsat' THEN -0.2::DOUBLE WHEN sensor = 's2' AND obs_date >= DATE '1998-01-25' THEN -0.1::DOUBLE ELSE 0.0::DOUBLE END, 0.0::DOUBLE), 8) END AS value FROM s""")
def reflectance_scale(spark, d) -> DataFrame:
    k = F.col("obs_id") % 3
    sensor = F.when(k == 0, "s2").when(k == 1, "landsat").otherwise("hls")
    scale, offset = ix.scale_offset(sensor, F.col("obs_date"), cutoff="1998-01-25")
    return observations(spark, d).select("obs_id", F.round(ix.reflectance(F.col("dn"), scale, offset), 8).alias("value"))


@query("reflectance_own", f"""WITH {OBS_SQL}, s AS (SELECT obs_id, nullif(dn, 0)::DOUBLE AS raw, obs_date, CASE WHEN scl % 3 = 0 THEN 0.0002::DOUBLE END AS own, CASE WHEN scl % 6 = 0 THEN -0.05::DOUBLE END AS off, CASE WHEN scl % 4 = 1 THEN 3 + qa % 3 END AS level FROM obs)
SELECT obs_id, CASE WHEN raw IS NOT NULL THEN round(greatest(raw * coalesce(own, 1e-4::DOUBLE) + CASE WHEN own IS NOT NULL THEN coalesce(off, 0.0::DOUBLE) WHEN coalesce(level >= 4, obs_date >= DATE '1998-01-25') THEN -0.1::DOUBLE ELSE 0.0::DOUBLE END, 0.0::DOUBLE), 8) END AS value FROM s""")
def reflectance_own(spark, d) -> DataFrame:
    """A scene's own scale and offset, then its processing baseline, then the date."""
    c = F.col
    own = F.when(c("scl") % 3 == 0, 0.0002), F.when(c("scl") % 6 == 0, -0.05)
    level = F.when(c("scl") % 4 == 1, 3.0 + c("qa") % 3)
    scale, offset = ix.scale_offset(F.lit("s2"), c("obs_date"), level, "1998-01-25", own)
    return observations(spark, d).select("obs_id", F.round(ix.reflectance(c("dn"), scale, offset), 8).alias("value"))


def _month(date="obs_date"):
    return F.trunc(F.col(date), "month")


@query("clear_pct_gate", f"""WITH {OBS_SQL}, g AS (SELECT CAST(date_trunc('month', obs_date) AS DATE) AS scene, 100.0::DOUBLE * count(*) FILTER ({_SCL}) / count(*) AS pct, count(*) AS n FROM obs GROUP BY 1)
SELECT scene, round(pct, 6) AS clear_pct, n FROM g WHERE pct >= 50""")
def clear_pct_gate(spark, d) -> DataFrame:
    obs = observations(spark, d).withColumn("scene", _month())
    return composites.clear_gate(obs, "scene", ix.clear_scl(F.col("scl")), 50.0).withColumn("clear_pct", F.round("clear_pct", 6))


_NDVI_CLEAR = f"CASE WHEN {_SCL} THEN {_FORMULA['ndvi']} END"
for _how, _agg in (("median", "median"), ("mean", "avg"), ("std", "stddev_pop")):
    query(f"composite_{_how}", f"WITH {OBS_SQL} SELECT pixel, round({_agg}({_NDVI_CLEAR}), 6) AS value, count({_NDVI_CLEAR}) AS n_obs FROM obs GROUP BY pixel")(
        lambda spark, d, how=_how: composites.composite(observations(spark, d), ix.masked(ix.index_column("ndvi"), ix.clear_scl(F.col("scl"))), how, ["pixel"]).withColumn("value", F.round("value", 6))
    )


@query("composite_seasonal", f"WITH {OBS_SQL} SELECT CASE WHEN month(obs_date) IN (11, 12, 1, 2, 3, 4) THEN 'wet' ELSE 'dry' END AS season, pixel, round(median({_NDVI_CLEAR}), 6) AS value, count({_NDVI_CLEAR}) AS n_obs FROM obs GROUP BY 1, 2")
def composite_seasonal(spark, d) -> DataFrame:
    obs = observations(spark, d).withColumn("season", composites.season(F.col("obs_date")))
    return composites.composite(obs, ix.masked(ix.index_column("ndvi"), ix.clear_scl(F.col("scl"))), "median", ["season", "pixel"]).withColumn("value", F.round("value", 6))


_NAMES = ("ndmi", "nbr", "evi2")


def _clear_values() -> dict:
    return {n: ix.masked(ix.index_column(n), ix.clear_scl(F.col("scl"))) for n in _NAMES}


def _baseline(spark, d) -> DataFrame:
    return composites.monthly_baseline(observations(spark, d).where(F.col("obs_date") < F.lit("2000-01-01").cast("date")), _clear_values())


def _detected(spark, d, spi: float = 0.0) -> DataFrame:
    obs = observations(spark, d).where(F.col("obs_date") >= F.lit("2000-01-01").cast("date"))
    return composites.against_baseline(obs, _baseline(spark, d), _clear_values(), spi)


_V = {n: f"CASE WHEN {_SCL} THEN {_FORMULA[n]} END" for n in _NAMES}
_BASE_SQL = "base AS (SELECT month(obs_date) AS month, pixel, " + ", ".join(f"median({v}) AS {n}_center, CASE WHEN count({v}) >= 2 THEN stddev_pop({v}) END AS {n}_std, count({v}) AS {n}_n" for n, v in _V.items()) + " FROM obs WHERE obs_date < DATE '2000-01-01' GROUP BY 1, 2)"
_Z_SQL = "det AS (SELECT *, " + ", ".join(f"({n} - {n}_center) / CASE WHEN {n}_std > 0.01 THEN {n}_std ELSE 0.01::DOUBLE END AS z_{n}, {n} - {n}_center AS d_{n}" for n in _NAMES) + f" FROM (SELECT *, month(obs_date) AS month, {', '.join(f'{v} AS {n}' for n, v in _V.items())} FROM obs WHERE obs_date >= DATE '2000-01-01') o LEFT JOIN base USING (month, pixel))"


def _confidence_sql(widen: float) -> str:
    c = lambda n, z, x: f"coalesce(z_{n} < {z - widen}::DOUBLE AND d_{n} < {x}::DOUBLE, false)"
    return f"CASE WHEN {c('ndmi', -3.0, -0.2)} AND {c('nbr', -3.0, -0.2)} THEN 3 WHEN {c('ndmi', -2.5, -0.15)} OR {c('nbr', -2.5, -0.15)} THEN 2 WHEN {' OR '.join(c(n, -2.0, -0.15) for n in _NAMES)} THEN 1 ELSE 0 END"


@query("baseline_monthly", f"WITH {OBS_SQL}, {_BASE_SQL} SELECT month::INT AS month, pixel, round(ndmi_center, 6) AS center, round(ndmi_std, 6) AS std, ndmi_n AS n_obs FROM base")
def baseline_monthly(spark, d) -> DataFrame:
    return _baseline(spark, d).select("month", "pixel", F.round("ndmi_center", 6).alias("center"), F.round("ndmi_std", 6).alias("std"), F.col("ndmi_n").alias("n_obs"))


@query("baseline_missing", f"""WITH {OBS_SQL}, have AS (SELECT DISTINCT month(obs_date) AS month, 'ndmi' AS index_name FROM obs UNION SELECT DISTINCT month(obs_date), 'nbr' FROM obs)
SELECT i.n AS index_name, m::INT AS month FROM (VALUES ('ndmi'), ('nbr'), ('evi2')) i(n), range(1, 13) t(m) WHERE NOT EXISTS (SELECT 1 FROM have h WHERE h.index_name = i.n AND h.month = m)""")
def baseline_missing(spark, d) -> DataFrame:
    """The months of all observations have baselines of two indices."""
    have = observations(spark, d).select(F.month("obs_date").alias("month")).distinct()
    return scenes.missing_baselines(have.select(F.explode(F.array(F.lit("ndmi"), F.lit("nbr"))).alias("index_name"), "month"), list(_NAMES))


@query("zscore_delta", f"WITH {OBS_SQL}, {_BASE_SQL}, {_Z_SQL} SELECT obs_id, round(z_ndmi, 6) AS z, round(d_ndmi, 6) AS delta FROM det")
def zscore_delta(spark, d) -> DataFrame:
    return _detected(spark, d).select("obs_id", F.round("z_ndmi", 6).alias("z"), F.round("delta_ndmi", 6).alias("delta"))


for _n, _spi, _w in (("detect_confidence", 0.0, 0.0), ("detect_drought", -1.5, 0.5)):
    query(_n, f"WITH {OBS_SQL}, {_BASE_SQL}, {_Z_SQL} SELECT confidence, count(*) AS n FROM (SELECT ({_confidence_sql(_w)})::TINYINT AS confidence FROM det) GROUP BY 1")(
        lambda spark, d, s=_spi: _detected(spark, d, s).groupBy("confidence").agg(F.count(F.lit(1)).alias("n"))
    )


@query("clearing_type", f"""WITH {OBS_SQL}, {_BASE_SQL}, {_Z_SQL}, c AS (SELECT nbr_center - nbr AS dn, nbr AS post, {_FORMULA['bsi']} AS bsi FROM det)
SELECT (CASE WHEN dn > 0.27::DOUBLE AND post < 0.1::DOUBLE THEN 1 WHEN bsi > 0.1::DOUBLE AND dn > 0.05::DOUBLE THEN 2 WHEN dn > 0.1::DOUBLE THEN 3 ELSE 0 END)::INT AS clearing, count(*) AS n FROM c GROUP BY 1""")
def clearing_type(spark, d) -> DataFrame:
    """The state before is the month's baseline."""
    return _detected(spark, d).groupBy(clearing(F.col("nbr_center") - F.col("nbr"), F.col("nbr"), ix.index_column("bsi")).alias("clearing")).agg(F.count(F.lit(1)).alias("n"))


@query("scene_guard", f"""WITH {OBS_SQL}, {_BASE_SQL}, {_Z_SQL}, c AS (SELECT CAST(date_trunc('month', obs_date) AS DATE) AS scene, ({_confidence_sql(0.0)}) > 0 AS alert, z_ndmi IS NOT NULL AS valid FROM det),
g AS (SELECT scene, count(*) AS n, coalesce(count(*) FILTER (alert)::DOUBLE / count(*) <= 0.07::DOUBLE, true) AS keep_all, coalesce(count(*) FILTER (alert)::DOUBLE / nullif(count(*) FILTER (valid), 0) <= 0.07::DOUBLE, true) AS keep_valid FROM c GROUP BY 1)
SELECT 'all' AS mode, scene, n FROM g WHERE keep_all UNION ALL SELECT 'valid', scene, n FROM g WHERE keep_valid""")
def scene_guard(spark, d) -> DataFrame:
    """Both denominators, at a limit of 7 % that these tables cross."""
    det = _detected(spark, d).select(_month().alias("scene"), "confidence", F.col("z_ndmi").isNotNull().alias("valid"))
    return composites.guard_shares(det, "scene", 0.07)


for _n, _last, _o in (("mosaic_first", False, "ASC"), ("mosaic_last", True, "DESC")):
    query(_n, f"WITH {OBS_SQL}, r AS (SELECT CAST(date_trunc('month', obs_date) AS DATE) AS scene, pixel, round(nir, 6) AS v, row_number() OVER (PARTITION BY date_trunc('month', obs_date), pixel ORDER BY obs_id {_o}, round(nir, 6) {_o}) AS rn FROM obs WHERE {_SCL}) SELECT scene, pixel, v AS value FROM r WHERE rn = 1")(
        lambda spark, d, last=_last: composites.mosaic(observations(spark, d).withColumn("scene", _month()), ix.masked(F.round("nir", 6), ix.clear_scl(F.col("scl"))), F.col("obs_id"), ["scene", "pixel"], last)
    )


@query("grid_snap", """WITH p AS (SELECT p_partkey AS id, p_retailprice AS x, (p_size * 7.3)::DOUBLE AS y FROM part),
k AS (SELECT id, x, y, floor((x - 900) / 20) AS i, floor(y / 20) AS j FROM p),
s AS (SELECT id, CASE WHEN abs(x - (900 + (i + 0.5::DOUBLE) * 20)) <= 7 THEN i END AS col, CASE WHEN abs(y - (j + 0.5::DOUBLE) * 20) <= 7 THEN j END AS "row" FROM k)
SELECT id, "row"::BIGINT AS "row", col::BIGINT AS col FROM s WHERE "row" IS NOT NULL AND col IS NOT NULL""")
def grid_snap(spark, d) -> DataFrame:
    p = table(spark, d, "part")
    out = p.select(F.col("p_partkey").alias("id"), spatial.snap(F.col("p_size") * F.lit(7.3), 0.0, 20.0, 7.0).alias("row"), spatial.snap(F.col("p_retailprice"), 900.0, 20.0, 7.0).alias("col"))
    return out.where("row is not null and col is not null")


@query("tile_grid", """WITH e AS (SELECT c_nationkey AS area, -40.9::DOUBLE + min(c_custkey) * 0.003 AS west, -7.85::DOUBLE + min(c_acctbal) / 20000 AS south, -40.7::DOUBLE + max(c_custkey) * 0.003 AS east, -7.5::DOUBLE + max(c_acctbal) / 20000 AS north FROM customer GROUP BY 1),
s AS (SELECT *, 1024 * 20.0::DOUBLE / 110540 AS dy, 1024 * 20.0::DOUBLE / (111320 * cos(radians((south + north) / 2))) AS dx FROM e)
SELECT area, r::INT AS tile_row, c::INT AS tile_col, round(west + c * dx, 6) AS west, round(south + r * dy, 6) AS south, round(least(west + (c + 1) * dx, east), 6) AS east, round(least(south + (r + 1) * dy, north), 6) AS north
FROM s, range(0, 3000) b(c), range(0, 30) a(r) WHERE west < east AND south < north AND r < ceil((north - south) / dy) AND c < ceil((east - west) / dx)""")
def tile_grid(spark, d) -> DataFrame:
    """Tiles over the extents of areas that a table holds.

    A cent of a balance is half of a degree's sixth place, so many sides lie
    between two of them: they are scaled and rounded as the SQL does it.
    """
    c = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("area"))
    k, b = "c_custkey", "c_acctbal"
    e = c.agg((F.min(k) * 3 / 1000 - 40.9).alias("west"), (F.min(b) / 20000 - 7.85).alias("south"), (F.max(k) * 3 / 1000 - 40.7).alias("east"), (F.max(b) / 20000 - 7.5).alias("north"))
    return spatial.tile_grids(e, ["area"]).select("area", "tile_row", "tile_col", *[(F.round(F.col(c) * 1e6) / 1e6).alias(c) for c in ("west", "south", "east", "north")])


@query("regional_stats", f"""WITH {OBS_SQL}, v AS (SELECT CAST(date_trunc('month', obs_date) AS DATE) AS date, {_NDVI_CLEAR} AS v FROM obs)
SELECT date, round(avg(v), 6) AS mean, round(median(v), 6) AS median, round(stddev_pop(v), 6) AS std, round(min(v), 6) AS min, round(max(v), 6) AS max, count(v) AS n_valid, round(100.0::DOUBLE * count(v) / greatest(count(*), count(v), 1), 6) AS pct_valid
FROM v GROUP BY date HAVING count(v) > 0""")
def regional_stats(spark, d) -> DataFrame:
    v = observations(spark, d).select(_month().alias("date"), ix.masked(ix.index_column("ndvi"), ix.clear_scl(F.col("scl"))).alias("v"))
    return series.regional_stats(v, "v", ["date"])


@query("stats_upsert", f"""WITH {OBS_SQL}, m AS (SELECT CAST(date_trunc('month', obs_date) AS DATE) AS date, round(avg(nir), 6) AS mean, round(avg(nir) FILTER ({_SCL}), 6) AS again FROM obs GROUP BY 1)
SELECT date, CASE WHEN date >= DATE '2000-06-01' THEN again ELSE mean END AS mean FROM m""")
def stats_upsert(spark, d) -> DataFrame:
    obs = observations(spark, d).withColumn("date", _month())
    stored = obs.groupBy("date").agg(F.round(F.avg("nir"), 6).alias("mean"))
    new = obs.where(F.col("date") >= F.lit("2000-06-01").cast("date")).groupBy("date").agg(F.round(F.avg(ix.masked(F.col("nir"), ix.clear_scl(F.col("scl")))), 6).alias("mean"))
    return series.upsert(stored, new, ["date"])


@query("split_bands", f"WITH {OBS_SQL}, {_BASE_SQL}, b AS (SELECT month::INT AS month, pixel, ndmi_center AS a, ndmi_std AS b, nbr_center AS c, nbr_std * 12 AS e FROM base), u AS (SELECT month, pixel, 'ndmi' AS index_name, 'mean' AS stat, a AS v FROM b UNION ALL SELECT month, pixel, 'ndmi', 'std', b FROM b UNION ALL SELECT month, pixel, 'nbr', 'mean', c FROM b UNION ALL SELECT month, pixel, 'nbr', 'std', e FROM b) SELECT month, pixel, index_name, stat, round(CASE WHEN v > -9990 AND abs(v) <= 1.5::DOUBLE THEN v END, 6) AS value FROM u")
def split_bands(spark, d) -> DataFrame:
    wide = _baseline(spark, d).select("month", "pixel", F.col("ndmi_center").alias("ndmi_mean"), "ndmi_std", F.col("nbr_center").alias("nbr_mean"), (F.col("nbr_std") * 12).alias("nbr_std"))
    return scenes.split_bands(wide, ["month", "pixel"]).withColumn("value", F.round("value", 6))


_PROFILE_SQL = f"""prof AS (SELECT pixel % 5 AS grp, count(v) AS n, round(1.0::DOUBLE - count(v)::DOUBLE / count(*), 6) AS nodata, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, round(min(v), 6) AS min, round(max(v), 6) AS max, round(median(v), 6) AS median,
  round(quantile_cont(v, 0.01), 6) AS p01, round(quantile_cont(v, 0.99), 6) AS p99, round(count(*) FILTER (v < -1 OR v > 1)::DOUBLE / count(v), 6) AS out_of_range, round(count(*) FILTER (v > 0.95::DOUBLE)::DOUBLE / count(v), 6) AS high,
  round(count(*) FILTER (v < -0.95::DOUBLE)::DOUBLE / count(v), 6) AS low, round(count(*) FILTER (abs(v) < 0.005::DOUBLE)::DOUBLE / count(v), 6) AS near_zero,
  round((avg(v * v * v) - 3 * avg(v) * avg(v * v) + 2 * avg(v) ** 3) / nullif(stddev_pop(v) ** 3, 0), 4) AS skew, round(kurtosis_pop(v), 4) AS kurtosis
  FROM (SELECT pixel, nullif({_FORMULA['ndmi']}, 0) AS v FROM obs) GROUP BY 1)"""


_FILE_SQL = _PROFILE_SQL.replace("SELECT pixel % 5 AS grp,", "SELECT pixel % 5 AS grp, file,").replace("(SELECT pixel,", "(SELECT pixel, year(obs_date) AS file,").replace("GROUP BY 1)", "GROUP BY 1, 2)").replace("prof AS", "files AS") + ", prof AS (SELECT grp, " + ", ".join(f"avg({c}) AS {c}" for c in ("out_of_range", "high", "low", "kurtosis", "nodata")) + " FROM files GROUP BY 1)"


def _profiles(spark, d, *files) -> DataFrame:
    v = observations(spark, d).select((F.col("pixel") % 5).alias("grp"), *files, ix.index_column("ndmi").alias("v"))
    return quality.profile(v, ["grp", *(["file"] if files else [])])


@query("profile", f"WITH {OBS_SQL}, {_PROFILE_SQL} SELECT * FROM prof")
def profile(spark, d) -> DataFrame:
    return _profiles(spark, d)


@query("quality_verdict", f"""WITH {OBS_SQL}, {_FILE_SQL} SELECT grp, CASE WHEN out_of_range > 0.01::DOUBLE OR high > 0.02::DOUBLE OR low > 0.05::DOUBLE THEN 'FAIL' ELSE 'PASS' END AS overall,
array_to_string(list_filter([CASE WHEN out_of_range > 0.01::DOUBLE THEN 'out_of_range' END, CASE WHEN high > 0.02::DOUBLE THEN 'high' END, CASE WHEN low > 0.05::DOUBLE THEN 'low' END], lambda x: x IS NOT NULL), ',') AS issues,
array_to_string(list_filter([CASE WHEN out_of_range > 0.001::DOUBLE AND out_of_range <= 0.01::DOUBLE THEN 'out_of_range' END, CASE WHEN high > 0.005::DOUBLE AND high <= 0.02::DOUBLE THEN 'high' END, CASE WHEN kurtosis > 10 THEN 'kurtosis' END, CASE WHEN nodata > 0.15::DOUBLE THEN 'nodata' END], lambda x: x IS NOT NULL), ',') AS warnings FROM prof""")
def quality_verdict(spark, d) -> DataFrame:
    """Each year is a file of its own."""
    return quality.verdict(_profiles(spark, d, F.year("obs_date").alias("file")), ["grp"])


@query("histogram_sample", f"WITH {OBS_SQL}, k AS (SELECT month(obs_date)::INT AS month, nir08 AS v, obs_id, pixel, row_number() OVER (PARTITION BY month(obs_date) ORDER BY (obs_id * 48271 + pixel * 69621) % 2147483647, obs_id, pixel, nir08) AS r FROM obs) SELECT month, obs_id, pixel, v FROM k WHERE r <= 300")
def histogram_sample(spark, d) -> DataFrame:
    """The values that each month's histogram is drawn from, 300 at most."""
    o = observations(spark, d).select(F.month("obs_date").alias("month"), "obs_id", "pixel", F.col("nir08").alias("v"))
    key = F.struct((F.col("obs_id") * 48271 + F.col("pixel") * 69621) % 2147483647, "obs_id", "pixel", "v")
    return quality.bounded_sample(o, ["month"], key, 300)
