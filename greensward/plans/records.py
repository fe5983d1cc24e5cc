"""Queries over file names, climate records and checks, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greensward.functions import indices as ix
from greensward.functions.detection import enso_state, severity_band
from greensward.operators import composites, quality, series, spatial
from greensward.plans.registry import registry
from greensward.sources import scenes
from greensward.sources.observations import MONTHLY_SQL, OBS_SQL, monthly_totals, observations, table

QUERIES, SQL, query = registry()

_CLEAR = "scl IN (2, 4, 5, 6, 7, 11)"
_NDMI = f"CASE WHEN {_CLEAR} THEN (nir08 - swir16) / nullif(nir08 + swir16, 0) END"
_RING = [(900.0, 0.0), (2000.0, 100.0), (1500.0, 1500.0)]


@query("evi2_cap", f"""WITH {OBS_SQL}, e AS (SELECT obs_id, obs_date, 2.5::DOUBLE * (nir - red) / nullif(nir + 2.4::DOUBLE * red + 1, 0) AS v FROM obs),
m AS (SELECT *, max(v) OVER (PARTITION BY obs_date) AS top FROM e)
SELECT obs_id, round(CASE WHEN top > 1 AND v IS NOT NULL THEN greatest(least(v, 1.0::DOUBLE), -1.0::DOUBLE) ELSE v END, 6) AS value FROM m""")
def evi2_cap(spark, d) -> DataFrame:
    v = observations(spark, d).select("obs_id", "obs_date", ix.index_column("evi2").alias("value"))
    return composites.cap_dates(v, "value", "obs_date").select("obs_id", F.round("value", 6).alias("value"))


@query("sentinel_fill", f"WITH {OBS_SQL}, f AS (SELECT obs_id, coalesce(CASE WHEN {_CLEAR} THEN round(nir, 6) END, -9999.0::DOUBLE) AS filled FROM obs) SELECT obs_id, filled, CASE WHEN filled > -9990 THEN filled END AS value FROM f")
def sentinel_fill(spark, d) -> DataFrame:
    """Out with a sentinel and in again as null."""
    f = observations(spark, d).select("obs_id", F.coalesce(ix.masked(F.round("nir", 6), ix.clear_scl(F.col("scl"))), F.lit(-9999.0)).alias("filled"))
    return f.withColumn("value", ix.sentinel_to_null(F.col("filled")))


def _ring_sql(x: str, y: str) -> str:
    edges = [(a, b) for a, b in zip(_RING, _RING[1:] + _RING[:1], strict=True) if a[1] != b[1]]
    n = [f"((({y} < {a[1]}::DOUBLE) <> ({y} < {b[1]}::DOUBLE)) AND {x} < {b[0] - a[0]}::DOUBLE * ({y} - {a[1]}::DOUBLE) / {b[1] - a[1]}::DOUBLE + {a[0]}::DOUBLE)::INT" for a, b in edges]
    return f"({' + '.join(n)}) % 2 = 1"


@query("aoi_clip", f"WITH p AS (SELECT p_partkey, p_retailprice::DOUBLE AS x, p_size * 30.0::DOUBLE AS y FROM part) SELECT p_partkey FROM p WHERE {_ring_sql('x', 'y')}")
def aoi_clip(spark, d) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey", F.col("p_retailprice").cast("double").alias("x"), (F.col("p_size") * 30.0).alias("y"))
    return p.where(spatial.point_in_ring(F.col("x"), F.col("y"), _RING)).select("p_partkey")


def _mean_baseline(spark, d) -> DataFrame:
    obs = observations(spark, d).where(F.col("obs_date") < F.lit("2000-01-01").cast("date"))
    return composites.monthly_baseline(obs, {"ndmi": ix.masked(ix.index_column("ndmi"), ix.clear_scl(F.col("scl")))}, center="mean")


_MEAN_SQL = f"base AS (SELECT month(obs_date)::INT AS month, pixel, avg({_NDMI}) AS center, CASE WHEN count({_NDMI}) >= 2 THEN stddev_pop({_NDMI}) END AS std, count({_NDMI}) AS n_obs FROM obs WHERE obs_date < DATE '2000-01-01' GROUP BY 1, 2)"


@query("baseline_mean", f"WITH {OBS_SQL}, {_MEAN_SQL} SELECT month, pixel, round(center, 6) AS center, round(std, 6) AS std, n_obs FROM base")
def baseline_mean(spark, d) -> DataFrame:
    """The streaming centre: the mean in place of the median."""
    return _mean_baseline(spark, d).select("month", "pixel", F.round("ndmi_center", 6).alias("center"), F.round("ndmi_std", 6).alias("std"), F.col("ndmi_n").alias("n_obs"))


@query("baseline_coverage", f"WITH {OBS_SQL}, {_MEAN_SQL} SELECT month, max(n_obs) AS max_obs, round(100.0::DOUBLE * count(*) FILTER (n_obs > 0) / (SELECT count(*) FROM supplier), 6) AS pct_covered FROM base GROUP BY month")
def baseline_coverage(spark, d) -> DataFrame:
    """The suppliers are the grid."""
    return composites.coverage(_mean_baseline(spark, d), "ndmi_n", "month", table(spark, d, "supplier").count())


@query("precip_range", f"WITH {MONTHLY_SQL}, s AS (SELECT DISTINCT series_id FROM monthly), g AS (SELECT series_id, CAST(unnest(generate_series(DATE '1997-06-01', DATE '1999-03-01', INTERVAL 1 MONTH)) AS DATE) AS date FROM s) SELECT g.series_id, g.date, round(value, 4) AS value FROM g LEFT JOIN monthly m ON m.series_id = g.series_id AND m.date = g.date AND month(m.date) <> 5")
def precip_range(spark, d) -> DataFrame:
    """Mays count as missing; so do the months behind the last order."""
    m = monthly_totals(spark, d)
    out = scenes.month_range(m.withColumn("value", F.when(F.month("date") != 5, F.col("value"))), "1997-06-01", "1999-03-01")
    return out.withColumn("value", F.round("value", 4))


@query("current_spi")
def current_spi(spark, d) -> DataFrame:
    """Five years of months up to March 1999; those behind the last known one go."""
    return series.current_spi(scenes.month_range(monthly_totals(spark, d), "1994-04-01", "1999-03-01")).withColumn("spi3", F.round("spi3", 4))


_LINES = "SELECT year(o_orderdate) || ',' || month(o_orderdate) || ',' || count(*) AS line FROM orders"


@query("csv_merge", f"{_LINES} GROUP BY year(o_orderdate), month(o_orderdate) UNION {_LINES} WHERE year(o_orderdate) > 1995 OR o_orderkey % 2 = 0 GROUP BY year(o_orderdate), month(o_orderdate)")
def csv_merge(spark, d) -> DataFrame:
    """The second file repeats later years and has other values for earlier ones."""

    def lines(o: DataFrame) -> DataFrame:
        n = o.groupBy(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m")).agg(F.count(F.lit(1)).alias("n"))
        return n.select(F.concat_ws(",", "y", "m", "n").alias("line"))

    o = table(spark, d, "orders")
    return scenes.merge_lines(lines(o), lines(o.where((F.year("o_orderdate") > 1995) | (F.col("o_orderkey") % 2 == 0))))


_NAME_SQL = "f AS (SELECT DISTINCT CASE o_custkey % 7 WHEN 0 THEN '.' ELSE '' END || strftime(o_orderdate, '%Y%m%d') || '_S2A_T' || (o_custkey % 4) || CASE WHEN o_custkey % 5 = 0 THEN '' ELSE '_R1_L2A_ndmi.tif' END AS name FROM orders)"


def _names(spark, d) -> DataFrame:
    k = F.col("o_custkey")
    name = F.concat(F.when(k % 7 == 0, ".").otherwise(""), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_S2A_T"), (k % 4).cast("string"), F.when(k % 5 == 0, "").otherwise("_R1_L2A_ndmi.tif"))
    return table(spark, d, "orders").select(name.alias("name")).distinct()


@query("files_by_date", f"WITH {_NAME_SQL} SELECT substr(name, 1, 8) AS date, count(*) AS n_files, string_agg(name, ',' ORDER BY name) AS names FROM f WHERE regexp_matches(name, '^[0-9]{{8}}') AND substr(name, 1, 4)::INT BETWEEN 1993 AND 1997 GROUP BY 1")
def files_by_date(spark, d) -> DataFrame:
    return scenes.files_by_date(_names(spark, d), 1993, 1997)


@query("filename_metadata", f"WITH {_NAME_SQL}, p AS (SELECT name, string_split(name, '_') AS p FROM f) SELECT name, CASE WHEN len(p) >= 6 THEN p[1] END AS date, CASE WHEN len(p) >= 6 THEN p[2] END AS satellite, CASE WHEN len(p) >= 6 THEN p[3] END AS tile, CASE WHEN len(p) >= 6 THEN p[4] END AS revisit, CASE WHEN len(p) >= 6 THEN p[5] END AS level FROM p")
def filename_metadata(spark, d) -> DataFrame:
    return _names(spark, d).select("name", scenes.filename_metadata(F.col("name")).alias("m")).select("name", "m.*")


_ANOM_SQL = f"{MONTHLY_SQL}, an AS (SELECT series_id, date, round((value - 150) / 20.0::DOUBLE, 1) AS anom FROM monthly)"


def _anomalies(spark, d) -> DataFrame:
    return monthly_totals(spark, d).select("series_id", "date", F.round((F.col("value") - 150) / F.lit(20.0), 1).alias("anom"))


@query("oni_parse", f"WITH {_ANOM_SQL} SELECT series_id, year(date)::INT AS year, (row_number() OVER (PARTITION BY series_id ORDER BY date) - 1)::INT AS seq, anom FROM an")
def oni_parse(spark, d) -> DataFrame:
    """The anomalies of each series written as a text of tokens and read again."""
    token = F.struct("date", F.concat(F.lit("DJF "), F.year("date").cast("string"), F.lit("  "), F.format_string("%.1f", "anom")).alias("t"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(token)), lambda x: x["t"]), "\n")
    return _anomalies(spark, d).groupBy("series_id").agg(text.alias("text")).select("series_id", F.inline(quality.parse_oni(F.col("text"))))


@query("enso_bands", f"WITH {_ANOM_SQL} SELECT series_id, date, CASE WHEN anom >= 0.5::DOUBLE THEN 'el_nino' WHEN anom <= -0.5::DOUBLE THEN 'la_nina' ELSE 'neutral' END AS state, CASE WHEN abs(anom) >= 2 THEN 'very strong' WHEN abs(anom) >= 1.5::DOUBLE THEN 'strong' WHEN abs(anom) >= 1 THEN 'moderate' WHEN abs(anom) >= 0.5::DOUBLE THEN 'weak' ELSE 'neutral' END AS band FROM an")
def enso_bands(spark, d) -> DataFrame:
    return _anomalies(spark, d).select("series_id", "date", enso_state(F.col("anom")).alias("state"), severity_band(F.abs("anom")).alias("band"))


@query("temporal_coverage", f"WITH {OBS_SQL} SELECT year(obs_date)::INT AS year, (pixel % 10)::BIGINT AS tile, count(*) AS n, count(DISTINCT obs_date) AS n_dates FROM obs GROUP BY 1, 2")
def temporal_coverage(spark, d) -> DataFrame:
    return observations(spark, d).withColumns({"year": F.year("obs_date"), "tile": (F.col("pixel") % 10).cast("long")}).transform(quality.coverage_counts, ["year", "tile"])


@query("value_histogram", f"WITH {OBS_SQL}, v AS (SELECT round({_NDMI}, 6) AS v FROM obs), b AS (SELECT CASE WHEN v < -1 THEN 0 WHEN v >= 1 THEN 41 ELSE floor(40 * (v + 1.0::DOUBLE) / 2.0::DOUBLE) + 1 END::BIGINT AS bucket FROM v WHERE v IS NOT NULL) SELECT bucket, count(*) AS n FROM b GROUP BY 1")
def value_histogram(spark, d) -> DataFrame:
    v = observations(spark, d).select(F.round(ix.masked(ix.index_column("ndmi"), ix.clear_scl(F.col("scl"))), 6).alias("v"))
    return quality.histogram(v, "v", -1.0, 1.0, 40)


@query("commission_error", "SELECT p_brand AS tier, count(*) FILTER (p_partkey % 3 = 0)::DOUBLE / nullif(count(*) FILTER (p_partkey % 3 < 2), 0) AS commission_error FROM part GROUP BY 1")
def commission_error(spark, d) -> DataFrame:
    verdict = F.when(F.col("p_partkey") % 3 == 0, "FP").when(F.col("p_partkey") % 3 == 1, "TP")
    return quality.commission_error(table(spark, d, "part").select(F.col("p_brand").alias("tier"), verdict.alias("verdict")))
