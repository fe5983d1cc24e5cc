"""Queries over sources, stores, grids and the whole detection, and their DuckDB SQL."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greensward import config
from greensward.functions import indices as ix
from greensward.functions.detection import confidence_label, legend_label
from greensward.operators import composites, grid, persistence, quality, series, spatial
from greensward.plans import detect as runs
from greensward.plans.pixel import _BASE_SQL, _FORMULA, _NAMES, _SCL, _Z_SQL, _baseline, _clear_values, _confidence_sql, _month
from greensward.plans.registry import registry
from greensward.plans.scratch import Scratch
from greensward.plans.space import union_share_sql
from greensward.sources import alerts as store
from greensward.sources import baselines, running, scenes, sensors
from greensward.sources.observations import BOX_SQL, OBS_SQL, RASTER_SQL, boxes, observations, raster, table

QUERIES, SQL, query = registry()

# sources ----------------------------------------------------------------------------------


@query("datetime_range", """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 2 = 0 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') || '/' || strftime(CAST(o_orderdate AS DATE) + 5, '%Y-%m-%d')
  ELSE '2001-08-16/2001-09-01' END AS range FROM orders""")
def datetime_range(spark, d) -> DataFrame:
    """Both ends are given for every sixth order."""
    day, k = F.col("o_orderdate").cast("date"), F.col("o_orderkey")
    start, end = F.when(k % 3 == 0, day), F.when(k % 2 == 0, F.date_add(day, 5))
    return table(spark, d, "orders").select(k.alias("id"), scenes.datetime_range(start, end, F.lit("2001-09-01").cast("date")).alias("range"))


@query("scene_bbox", f"WITH {BOX_SQL}, s AS (SELECT box.id AS scene_id, box.date, (id % 60)::DOUBLE AS cloud_cover, x0, y0, x1, y1 FROM box) SELECT scene_id FROM s WHERE date BETWEEN DATE '1998-02-01' AND DATE '1999-01-01' AND cloud_cover < 20 AND x0 <= 700 AND x1 >= 300 AND y0 <= 900 AND y1 >= 500")
def scene_bbox(spark, d) -> DataFrame:
    s = boxes(spark, d).select(F.col("id").alias("scene_id"), "date", (F.col("id") % 60).cast("double").alias("cloud_cover"), F.col("x0").alias("west"), F.col("y0").alias("south"), F.col("x1").alias("east"), F.col("y1").alias("north"))
    return scenes.search(s, "1998-02-01", "1999-01-01", 20, None, bbox=(300, 500, 700, 900)).select("scene_id")


def _assets(spark, d, sensor: str) -> DataFrame:
    """Digital numbers of every asset of a sensor, out of the bands of the observations."""
    o = observations(spark, d)
    bands = {b: F.round(10_000 * F.col("nir08" if b == "nir" and sensor == "hls" else b)) for b in ("blue", "red", "nir", "nir08", "swir16", "swir22")}
    bands |= {"scl": F.col("scl"), "qa": F.col("qa")}
    wanted = config.ASSETS[sensor]
    return o.select("obs_id", "obs_date", *{a: bands[b].alias(a) for b, a in wanted.items() if b in bands}.values())


def _dispatch_sql() -> str:
    out = []
    for k, (sensor, clear) in enumerate((("s2", _SCL), ("landsat", "(qa & 24) = 0"), ("hls", "(qa & 14) = 0"))):
        scale = "2.75e-5::DOUBLE" if sensor == "landsat" else "1e-4::DOUBLE"
        offset = "-0.2::DOUBLE" if sensor == "landsat" else "0.0::DOUBLE"
        r = lambda b: f"CASE WHEN {clear} THEN greatest(nullif(round(10000 * {b}), 0) * {scale} + {offset}, CASE WHEN nullif(round(10000 * {b}), 0) IS NOT NULL THEN 0.0::DOUBLE END) END"  # noqa: E731,B023
        out.append(f"SELECT obs_id, '{sensor}' AS sensor, {r('nir08')} AS nir08, {r('swir16')} AS swir16 FROM obs WHERE obs_id % 3 = {k}")
    return " UNION ALL ".join(out)


@query("sensor_dispatch", f"WITH {OBS_SQL}, s AS ({_dispatch_sql()}) SELECT obs_id, sensor, round(nir08, 8) AS nir08, round(swir16, 8) AS swir16, round((nir08 - swir16) / nullif(nir08 + swir16, 0), 8) AS ndmi FROM s")
def sensor_dispatch(spark, d) -> DataFrame:
    """Three sensors, each by its loader: scaled, masked, and only with the bands that the index needs. All dates come before the newer offset of s2."""
    out = []
    for k, sensor in enumerate(("s2", "landsat", "hls")):
        s = sensors.load_scene(_assets(spark, d, sensor).where(F.col("obs_id") % 3 == k), sensor, ["ndmi"], ["obs_id"])
        out.append(s.select("obs_id", F.lit(sensor).alias("sensor"), F.round("nir08", 8).alias("nir08"), F.round("swir16", 8).alias("swir16"), F.round(ix.index_column("ndmi", sensor), 8).alias("ndmi")))
    return store.merge_tiles(out)


_SNAP = "abs({c} - ({o} + (floor(({c} - {o}) / 20) + 0.5::DOUBLE) * 20)) <= 7"


def _points(spark, d, k: int) -> DataFrame:
    return table(spark, d, "part").where(F.col("p_partkey") % 2 == k).select(F.col("p_retailprice").cast("double").alias("x"), (F.col("p_size") * F.lit(7.3)).alias("y"), F.col("p_partkey").cast("double").alias("value"))


@query("band_stack", f"""WITH p AS (SELECT p_partkey % 2 AS k, p_retailprice::DOUBLE AS x, (p_size * 7.3)::DOUBLE AS y, p_partkey::DOUBLE AS v FROM part),
s AS (SELECT k, floor(y / 20)::BIGINT AS "row", floor((x - 900) / 20)::BIGINT AS col, x, y, v FROM p WHERE {_SNAP.format(c='x', o='900')} AND {_SNAP.format(c='y', o='0')}),
f AS (SELECT *, row_number() OVER (PARTITION BY k, "row", col ORDER BY y, x, v) AS rn FROM s)
SELECT a."row", a.col, a.v AS red, b.v AS nir FROM f a LEFT JOIN f b ON b.k = 1 AND b.rn = 1 AND a."row" = b."row" AND a.col = b.col WHERE a.k = 0 AND a.rn = 1""")
def band_stack(spark, d) -> DataFrame:
    """Even parts are the points of one band, odd ones those of another."""
    return sensors.stack_bands({"red": _points(spark, d, 0), "nir": _points(spark, d, 1)}, 900.0, 0.0, 20.0, 7.0)


@query("dn_shift", f"""WITH {OBS_SQL}, p AS (SELECT obs_id, CAST(date_trunc('month', obs_date) AS DATE) AS scene, pixel // 10 AS "row", pixel % 10 AS col, dn::DOUBLE AS dn FROM obs),
m AS (SELECT scene, median(dn) AS m FROM p WHERE "row" < 6 AND col < 6 GROUP BY 1) SELECT obs_id, dn + CASE WHEN m > 1000 THEN 1000 ELSE 0 END AS dn FROM p LEFT JOIN m USING (scene)""")
def dn_shift(spark, d) -> DataFrame:
    """Corners of 6 x 6 cells, and a limit that about half of the scenes cross."""
    p = observations(spark, d).select("obs_id", _month().alias("scene"), F.floor(F.col("pixel") / 10).alias("row"), (F.col("pixel") % 10).alias("col"), F.col("dn").cast("double").alias("dn"))
    return sensors.shift_dn(p, "scene", "dn", sample=6, least=1000.0).select("obs_id", "dn")


@query("composite_load", f"WITH {OBS_SQL} SELECT obs_id, CASE WHEN {_SCL} THEN round(nir, 6) END AS evi2, round(red, 6) AS ndmi, round(blue, 6) AS nbr, NULL::DOUBLE AS bsi FROM obs")
def composite_load(spark, d) -> DataFrame:
    """Clouds hold the sentinel, and the fourth band is missing."""
    c = observations(spark, d).select("obs_id", F.coalesce(ix.masked(F.round("nir", 6), ix.clear_scl(F.col("scl"))), F.lit(-9999.0)).alias("evi2"), F.round("red", 6).alias("ndmi"), F.round("blue", 6).alias("nbr"))
    return sensors.load_composite(c, ["obs_id"])


@query("file_discovery", "SELECT DISTINCT CAST(o_orderdate AS DATE) AS date, 'composite_' || strftime(o_orderdate, '%Y-%m-%d') || '_t' || (o_custkey % 3) AS name FROM orders WHERE o_custkey % 3 <> 2")
def file_discovery(spark, d) -> DataFrame:
    """Files of one tile in three have no date in their names."""
    k = F.col("o_custkey") % 3
    name = F.when(k == 2, F.concat(F.lit("notes_"), F.col("o_orderkey").cast("string"))).otherwise(F.concat(F.lit("composite_"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("_t"), k.cast("string")))
    return scenes.discover(table(spark, d, "orders").select(name.alias("name")).distinct())


@query("precip_mean", "SELECT (p_partkey % 12)::BIGINT AS month, round(avg(CASE WHEN p_retailprice >= 950 THEN p_retailprice - 950 END)::DOUBLE, 6) AS mm FROM part WHERE p_size BETWEEN 10 AND 40 AND p_partkey % 50 BETWEEN 5 AND 30 GROUP BY 1")
def precip_mean(spark, d) -> DataFrame:
    cells = table(spark, d, "part").select((F.col("p_partkey") % 12).alias("month"), F.col("p_size").alias("lon"), (F.col("p_partkey") % 50).alias("lat"), (F.col("p_retailprice") - 950).alias("v"))
    return scenes.precipitation_mean(cells, (10, 5, 40, 30), ["month"]).withColumn("mm", F.round("mm", 6))


def _values_sql(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" for x in r) + ")" for r in rows)


# written out, so that a wrong entry of the table shows
_ASSET_SQL = """CASE sensor WHEN 's2' THEN CASE WHEN band IN ('blue', 'green', 'red', 'nir', 'nir08', 'swir16', 'swir22', 'scl') THEN band END
  WHEN 'landsat' THEN CASE WHEN band IN ('blue', 'green', 'red', 'nir08', 'swir16', 'swir22') THEN band WHEN band = 'qa' THEN 'qa_pixel' END
  WHEN 'hls' THEN CASE band WHEN 'blue' THEN 'B02' WHEN 'green' THEN 'B03' WHEN 'red' THEN 'B04' WHEN 'nir' THEN 'B8A' WHEN 'nir08' THEN 'B8A' WHEN 'swir16' THEN 'B11' WHEN 'swir22' THEN 'B12' WHEN 'qa' THEN 'Fmask' END END"""
_BANDS = ("blue", "green", "red", "nir", "nir08", "swir16", "swir22", "scl", "qa", "pan")


@query("asset_keys", f"WITH s AS (SELECT o_orderkey AS scene, ['s2', 'landsat', 'hls', 'other'][o_custkey % 4 + 1] AS sensor, unnest({list(_BANDS)!r}) AS band FROM orders) SELECT scene, sensor, band, {_ASSET_SQL} AS asset FROM s WHERE {_ASSET_SQL} IS NOT NULL")
def asset_keys(spark, d) -> DataFrame:
    """The assets that scenes of each sensor have for ten bands; unknown sensors and bands have none."""
    kind = F.get(F.array(*map(F.lit, ("s2", "landsat", "hls", "other"))), (F.col("o_custkey") % 4).cast("int"))
    scenes_ = table(spark, d, "orders").select(F.col("o_orderkey").alias("scene"), kind.alias("sensor"), F.explode(F.array(*map(F.lit, _BANDS))).alias("band"))
    return scenes_.withColumn("asset", sensors.asset_of(F.col("sensor"), F.col("band"))).where("asset is not null")


def _legend_sql(code: str) -> str:
    return "CASE " + " ".join(f"WHEN {code} = {c} THEN '{n}'" for c, n in config.LEGEND.items()) + f" ELSE 'class ' || {code} END"


@query("class_legend", f"SELECT p_partkey, {_legend_sql('p_size')} AS label FROM part")
def class_legend(spark, d) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", legend_label(F.col("p_size")).alias("label"))


# stores -----------------------------------------------------------------------------------


@query("baseline_store", f"WITH {OBS_SQL}, {_BASE_SQL} SELECT pixel, round(nbr_center, 6) AS center, round(nbr_std, 6) AS std, nbr_n AS n_obs FROM base WHERE month = 3")
def baseline_store(spark, d) -> DataFrame:
    """All months are built and stored, nothing is left to build, and one month of one index is read."""
    path = f"{Scratch(spark, 'baselines').root}/store"
    obs = observations(spark, d).where(F.col("obs_date") < F.lit("2000-01-01").cast("date"))
    runs.build_baselines(obs, _clear_values(), path)
    runs.build_baselines(obs, _clear_values(), path)
    return baselines.load_baseline(spark, path, "nbr", 3).select("pixel", F.round("center", 6).alias("center"), F.round("std", 6).alias("std"), "n_obs")


@query("baseline_years", f"""WITH {OBS_SQL}, o AS (SELECT *, (obs_id % 70)::DOUBLE AS cloud_cover FROM obs WHERE year(obs_date) IN (1996, 1998, 1999)), c AS (SELECT * FROM o WHERE cloud_cover < 40),
m AS (SELECT month(obs_date) AS month FROM c GROUP BY 1 HAVING count(DISTINCT obs_date) >= 2)
SELECT month(obs_date)::INT AS month, pixel, round(median({_FORMULA['ndmi']}), 6) AS center, round(stddev_pop({_FORMULA['ndmi']}), 6) AS std, count({_FORMULA['ndmi']}) AS n_obs FROM c WHERE month(obs_date) IN (SELECT month FROM m) GROUP BY 1, 2""")
def baseline_years(spark, d) -> DataFrame:
    """Chosen years, a cloud limit, months with two dates or more, and a spread whatever the count."""
    obs = observations(spark, d).withColumn("cloud_cover", (F.col("obs_id") % 70).cast("double"))
    b = composites.monthly_baseline(obs, {"ndmi": ix.index_column("ndmi")}, min_obs_std=1, min_dates=2, years=(1996, 1998, 1999), max_cloud=config.BASELINE_CLOUD)
    return b.select("month", "pixel", F.round("ndmi_center", 6).alias("center"), F.round("ndmi_std", 6).alias("std"), F.col("ndmi_n").alias("n_obs"))


def _dated(spark, d, k: int | None = None) -> DataFrame:
    b = boxes(spark, d) if k is None else boxes(spark, d).where(F.col("id") % 3 == k)
    return b.select("id", *[F.col(c).cast("double").alias(c) for c in ("x0", "y0", "x1", "y1")], (F.col("id") % 4).cast("int").alias("confidence"), F.lit(1.0).alias("area_ha"), F.col("date").alias("detection_date"))


@query("alert_store", f"WITH {BOX_SQL} SELECT id, CASE id % 4 WHEN 1 THEN 'low' WHEN 2 THEN 'medium' WHEN 3 THEN 'high' ELSE 'unknown' END AS label, x0::DOUBLE AS x0 FROM box WHERE date = DATE '1996-03-01' OR (date = DATE '1997-03-01' AND id % 3 = 0)")
def alert_store(spark, d) -> DataFrame:
    """All dates are stored, one is replaced by fewer alerts; one date is read, then another by way of all."""
    path = f"{Scratch(spark, 'alerts').root}/store"
    store.save_alerts(store.merge_tiles([_dated(spark, d, k) for k in range(3)]), path)
    store.save_alerts(_dated(spark, d, 0).where("detection_date = date'1997-03-01'"), path)
    one = store.load_alerts(spark, path, "1996-03-01")
    every = store.load_alerts(spark, path).where("detection_date = date'1997-03-01'")
    return one.unionByName(every).select("id", F.col("confidence_label").alias("label"), "x0")


@query("merge_tiles", f"WITH {BOX_SQL} SELECT date, count(*) + count(*) FILTER (id % 3 = 0) AS n, (sum(id) + coalesce(sum(id) FILTER (id % 3 = 0), 0))::BIGINT AS ids FROM box GROUP BY 1")
def merge_tiles(spark, d) -> DataFrame:
    """Three tiles, the first of which comes twice, as tiles do that overlap."""
    merged = store.merge_tiles([_dated(spark, d, k) for k in (0, 1, 2, 0)])
    return merged.groupBy(F.col("detection_date").alias("date")).agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"))


def _utm_inverse_sql(x: str, y: str, source: str) -> str:
    """CTEs ``u1`` to ``u3`` over ``source``; u3 has lon and lat."""
    k, b, t = spatial._K0 * spatial._R, spatial._BETA, spatial._DELTA
    north = " + ".join(f"{v!r}::DOUBLE * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, v in enumerate(b, 1))
    east = " + ".join(f"{v!r}::DOUBLE * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, v in enumerate(b, 1))
    lat = " + ".join(f"{v!r}::DOUBLE * sin({2 * j} * chi)" for j, v in enumerate(t, 1))
    return f"""u1 AS (SELECT *, ({y} - {spatial._N0!r}::DOUBLE) / {k!r}::DOUBLE AS xi, ({x} - {spatial._E0!r}::DOUBLE) / {k!r}::DOUBLE AS eta FROM {source}),
u2 AS (SELECT *, xi - ({north}) AS ux, eta - ({east}) AS uy FROM u1),
u2b AS (SELECT *, asin(sin(ux) / cosh(uy)) AS chi FROM u2),
u3 AS (SELECT *, -39.0::DOUBLE + degrees(atan2(sinh(uy), cos(ux))) AS lon, degrees(chi + {lat}) AS lat FROM u2b)"""


def _utm_forward_sql(source: str) -> str:
    """CTEs ``f1`` to ``f3`` over ``source`` with lon and lat; f3 has east and north."""
    c = 2 * math.sqrt(spatial._N) / (1 + spatial._N)
    k, a = spatial._K0 * spatial._R, spatial._ALPHA
    e = " + ".join(f"{v!r}::DOUBLE * cos({2 * j} * fxi) * sinh({2 * j} * feta)" for j, v in enumerate(a, 1))
    n = " + ".join(f"{v!r}::DOUBLE * sin({2 * j} * fxi) * cosh({2 * j} * feta)" for j, v in enumerate(a, 1))
    return f"""f1 AS (SELECT *, sinh(atanh(sin(radians(lat))) - {c!r}::DOUBLE * atanh({c!r}::DOUBLE * sin(radians(lat)))) AS ft, radians(lon + 39.0::DOUBLE) AS lam FROM {source}),
f2 AS (SELECT *, atan2(ft, cos(lam)) AS fxi, atanh(sin(lam) / sqrt(1 + ft * ft)) AS feta FROM f1),
f3 AS (SELECT *, {spatial._E0!r}::DOUBLE + {k!r}::DOUBLE * (feta + {e}) AS east, {spatial._N0!r}::DOUBLE + {k!r}::DOUBLE * (fxi + {n}) AS north FROM f2)"""


@query("utm_round_trip", f"WITH {BOX_SQL}, src AS (SELECT id, x0 + 400000.0::DOUBLE AS x, y0 + 9150000.0::DOUBLE AS y FROM box), {_utm_inverse_sql('x', 'y', 'src')}, {_utm_forward_sql('u3')} SELECT id, round(lon, 6) AS lon, round(lat, 6) AS lat, abs(east - x) < 1e-3 AND abs(north - y) < 1e-3 AS returns FROM f3")
def utm_round_trip(spark, d) -> DataFrame:
    """Box corners as degrees and back, to a millimetre."""
    b = boxes(spark, d).select("id", (F.col("x0") + 400_000.0).alias("x"), (F.col("y0") + 9_150_000.0).alias("y"))
    lon, lat = spatial.utm_inverse(F.col("x"), F.col("y"))
    b = b.withColumns({"lon": lon, "lat": lat})
    x, y = spatial.utm_forward(F.col("lon"), F.col("lat"))
    close = (F.abs(x - F.col("x")) < 1e-3) & (F.abs(y - F.col("y")) < 1e-3)
    return b.select("id", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"), close.alias("returns"))


@query("sample_sheet", f"""WITH {BOX_SQL}, c AS (SELECT id, date, (x0 + x1) / 2.0::DOUBLE + 400000 AS mx, (y0 + y1) / 2.0::DOUBLE + 9150000 AS my, CASE id % 4 WHEN 1 THEN 'low' WHEN 2 THEN 'medium' WHEN 3 THEN 'high' ELSE 'unknown' END AS confidence FROM box),
r AS (SELECT *, row_number() OVER (PARTITION BY confidence ORDER BY (id * 7919) % 10007, id) AS rn FROM c), s AS (SELECT *, (row_number() OVER (ORDER BY id) - 1)::INT AS sample_id FROM r WHERE rn <= 15), {_utm_inverse_sql('mx', 'my', 's')}
SELECT sample_id, strftime(date, '%Y-%m-%d') AS detection_date, confidence, '' AS lc_group, round(lat, 6) AS centroid_lat, round(lon, 6) AS centroid_lon, '' AS verdict FROM u3""")
def sample_sheet(spark, d) -> DataFrame:
    a = _dated(spark, d).withColumns({c: F.col(c) + (400_000 if c[0] == "x" else 9_150_000) for c in ("x0", "y0", "x1", "y1")}).withColumn("confidence", confidence_label(F.col("confidence")))
    few = quality.stratified_sample(a, ["confidence"], F.struct((F.col("id") * 7919) % 10007, "id"), 15)
    return quality.sample_sheet(few, F.col("id")).select("sample_id", "detection_date", "confidence", "lc_group", "centroid_lat", "centroid_lon", "verdict")


@query("series_read", f"WITH {OBS_SQL}, s AS (SELECT CAST(date_trunc('month', obs_date) AS DATE) AS date, CASE WHEN pixel % 2 = 0 THEN 'even' ELSE 'odd' END AS region, round(avg(nir), 6) AS mean FROM obs GROUP BY 1, 2) SELECT date, mean FROM s WHERE region = 'even' AND date BETWEEN DATE '1996-02-01' AND DATE '1998-11-01'")
def series_read(spark, d) -> DataFrame:
    o = observations(spark, d).select(_month().alias("date"), F.when(F.col("pixel") % 2 == 0, "even").otherwise("odd").alias("region"), "nir")
    stored = o.groupBy("date", "region").agg(F.round(F.avg("nir"), 6).alias("mean"))
    return series.read_series(stored, "1996-02-01", "1998-11-01", region="even").select("date", "mean")


@query("scene_cache", f"WITH {OBS_SQL} SELECT CAST(date_trunc('month', obs_date) AS DATE) AS scene, count(*) AS n FROM obs WHERE obs_date >= DATE '1996-03-01' AND obs_date < DATE '1996-05-01' GROUP BY 1 HAVING 100.0::DOUBLE * count(*) FILTER ({_SCL}) / count(*) >= 45")
def scene_cache(spark, d) -> DataFrame:
    """Two scenes, each asked for twice: built, then read, and held against the clear share both times."""
    cache = sensors.SceneCache(spark, f"{Scratch(spark, 'scenes').root}/cache")
    obs = observations(spark, d).select(_month().alias("scene"), "scl")
    out = spark.createDataFrame([], "scene date, n long")
    for day in ("1996-03-01", "1996-04-01"):
        for _ in range(2):
            rows = cache.get(day, lambda day=day: obs.where(F.col("scene") == F.lit(day).cast("date")), ix.clear_scl(F.col("scl")), 45.0)
        if rows is not None:
            out = out.unionByName(rows.groupBy("scene").agg(F.count(F.lit(1)).alias("n")))
    return out


@query("archive_report", f"""WITH {BOX_SQL}, r AS (SELECT *, dense_rank() OVER (ORDER BY date) AS rank FROM box), {union_share_sql(1, 'one')}, {union_share_sql(2, 'two')},
k AS (SELECT date, id, (one.share >= 0.05::DOUBLE AND two.share >= 0.05::DOUBLE)::INT AS k FROM one JOIN two USING (date, id))
SELECT coalesce(strftime(date, '%Y-%m-%d'), 'all') AS date, count(*) AS raw, sum(k)::BIGINT AS confirmed, count(*) - sum(k)::BIGINT AS dropped, round_even((count(*) - sum(k))::DOUBLE / count(*), 4) AS drop_frac FROM k GROUP BY ROLLUP (date)""")
def archive_report(spark, d) -> DataFrame:
    """Three observations in a row, for each date and in all."""
    return persistence.archive(boxes(spark, d), consecutive=3).withColumn("date", F.coalesce(F.date_format("date", "yyyy-MM-dd"), F.lit("all")))


@query("baseline_running", f"WITH {OBS_SQL}, v AS (SELECT pixel, month(obs_date)::INT AS month, unnest(['nir', 'nir08']) AS index_name, unnest([nir, nir08]) AS v FROM obs) SELECT index_name, month, pixel, round(avg(v), 9) AS center, CASE WHEN count(v) >= 2 THEN round(stddev_pop(v), 9) END AS std, count(v) AS n_obs FROM v WHERE v IS NOT NULL GROUP BY 1, 2, 3")
def baseline_running(spark, d) -> DataFrame:
    """Mean baselines from three deliveries of scenes of which the second comes twice and the third brings the first again."""
    o = observations(spark, d).withColumn("scene", _month().cast("string"))
    store_of = running.RunningBaselines(spark, f"{Scratch(spark, 'running').root}/store")
    part = F.month("obs_date") % 3
    for delivery in (part == 0, part == 1, part == 1, part != 1):
        store_of.add(o.where(delivery), {"nir": F.col("nir"), "nir08": F.col("nir08")})
    return running.baseline(store_of.states()).select("index_name", "month", "pixel", F.round("center", 9).alias("center"), F.round("std", 9).alias("std"), "n_obs")


# grids ------------------------------------------------------------------------------------

# images of 8 x 8 cells of 20 m onto cells of 15 m that start 10 m further west and north
_FROM, _ONTO = grid.Grid(0.0, 160.0, 20.0, 8, 8), grid.Grid.over(-10.0, 3.0, 157.0, 170.0, 15.0)
_TARGET_SQL = f"""t AS (SELECT r::INT AS "row", c::INT AS col, {_ONTO.left!r}::DOUBLE + (c + 0.5::DOUBLE) * 15 AS x, {_ONTO.top!r}::DOUBLE - (r + 0.5::DOUBLE) * 15 AS y FROM range(0, {_ONTO.height}) a(r), range(0, {_ONTO.width}) b(c))"""


@query("grid_template", f"WITH {BOX_SQL} SELECT id, floor(({grid.Grid.over(203.0, 311.0, 1407.0, 1290.0, 20.0).top!r}::DOUBLE - y0) / 20)::BIGINT AS \"row\", floor((x0 - 200.0::DOUBLE) / 20)::BIGINT AS col FROM box WHERE x0 >= 200 AND x0 < 1420 AND y0 > 300 AND y0 <= 1300")
def grid_template(spark, d) -> DataFrame:
    """Corners of boxes on the grid over an area whose bounds are no multiples of the cells."""
    return grid.Grid.over(203.0, 311.0, 1407.0, 1290.0, 20.0).cells(boxes(spark, d), "x0", "y0").select("id", "row", "col")


@query("reproject_nearest", f"""WITH {RASTER_SQL}, {_TARGET_SQL} SELECT img, t."row"::BIGINT AS "row", t.col::BIGINT AS col, round(v, 6) AS v FROM t JOIN raster r ON floor(x / 20) = r.col AND floor((160 - y) / 20) = r."row" WHERE v > -0.1::DOUBLE""")
def reproject_nearest(spark, d) -> DataFrame:
    """Values below -0.1 are missing."""
    r = raster(spark, d).withColumn("v", F.when(F.col("v") > -0.1, F.col("v")))
    return grid.reproject(r, _FROM, _ONTO, ["img"], nearest=True).select("img", "row", "col", F.round("v", 6).alias("v"))


@query("reproject_bilinear", f"""WITH {RASTER_SQL}, {_TARGET_SQL}, n AS (SELECT img, t."row", t.col, v, greatest(1 - abs(x - (r.col + 0.5::DOUBLE) * 20) / 20, 0) * greatest(1 - abs(y - (160 - (r."row" + 0.5::DOUBLE) * 20)) / 20, 0) AS w
  FROM t JOIN raster r ON abs(x - (r.col + 0.5::DOUBLE) * 20) < 20 AND abs(y - (160 - (r."row" + 0.5::DOUBLE) * 20)) < 20 WHERE v > -0.1::DOUBLE)
SELECT img, "row"::BIGINT AS "row", col::BIGINT AS col, round(sum(w * v) / sum(w), 5) AS v FROM n WHERE w > 1e-12 GROUP BY 1, 2, 3""")
def reproject_bilinear(spark, d) -> DataFrame:
    r = raster(spark, d).withColumn("v", F.when(F.col("v") > -0.1, F.col("v")))
    return grid.reproject(r, _FROM, _ONTO, ["img"]).select("img", "row", "col", F.round("v", 5).alias("v"))


@query("landcover_crop", "SELECT p_partkey, (p_partkey % 400 - 43)::BIGINT AS \"row\", (p_size - 12)::BIGINT AS col FROM part WHERE p_partkey % 400 BETWEEN 43 AND 162 AND p_size BETWEEN 12 AND 35")
def landcover_crop(spark, d) -> DataFrame:
    """A box that hangs over no edge of a raster of 400 x 51 cells of 0.01 degrees."""
    window = grid.crop_window((-40.88, -8.63, -40.64, -7.43), -41.0, -7.0, 0.01, 51, 400)
    cells = table(spark, d, "part").select("p_partkey", (F.col("p_partkey") % 400).alias("row"), F.col("p_size").alias("col"))
    return grid.crop(cells, window).select("p_partkey", F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"))


_RING = [(900.0, 0.0), (2000.0, 100.0), (1500.0, 1500.0)]


def _touch_sql(x: str, y: str, half: float) -> str:
    edges = list(zip(_RING, _RING[1:] + _RING[:1], strict=True))
    inside = " + ".join(f"((({y} < {a[1]}::DOUBLE) <> ({y} < {b[1]}::DOUBLE)) AND {x} < {b[0] - a[0]}::DOUBLE * ({y} - {a[1]}::DOUBLE) / {b[1] - a[1]}::DOUBLE + {a[0]}::DOUBLE)::INT" for a, b in edges if a[1] != b[1])
    cross = " OR ".join(f"({x} + {half} >= {min(a[0], b[0])} AND {x} - {half} <= {max(a[0], b[0])} AND {y} + {half} >= {min(a[1], b[1])} AND {y} - {half} <= {max(a[1], b[1])} AND abs(({x} - {a[0]}) * {b[1] - a[1]} - ({y} - {a[1]}) * {b[0] - a[0]}) <= {half * (abs(b[0] - a[0]) + abs(b[1] - a[1]))})" for a, b in edges)
    return f"(({inside}) % 2 = 1 OR {cross})"


@query("aoi_touched", f"WITH p AS (SELECT p_partkey, p_retailprice::DOUBLE AS x, p_size * 30.0::DOUBLE AS y FROM part) SELECT p_partkey FROM p WHERE {_touch_sql('x', 'y', 20.0)}")
def aoi_touched(spark, d) -> DataFrame:
    """Cells of 40 m that the area touches, not only those with their centres in it."""
    p = table(spark, d, "part").select("p_partkey", F.col("p_retailprice").cast("double").alias("x"), (F.col("p_size") * 30.0).alias("y"))
    return grid.clip(p, F.col("x"), F.col("y"), 40.0, _RING).select("p_partkey")


# detection --------------------------------------------------------------------------------

_DETECT_SQL = f"""RECURSIVE {OBS_SQL}, {_BASE_SQL}, {_Z_SQL},
ok AS (SELECT CAST(date_trunc('month', obs_date) AS DATE) AS scene FROM obs GROUP BY 1 HAVING 100.0::DOUBLE * count(*) FILTER ({_SCL}) / count(*) >= 50),
one AS (SELECT *, CAST(date_trunc('month', obs_date) AS DATE) AS scene, row_number() OVER (PARTITION BY date_trunc('month', obs_date), pixel ORDER BY obs_id) AS rn FROM det WHERE ndmi IS NOT NULL OR nbr IS NOT NULL OR evi2 IS NOT NULL),
j AS (SELECT scene, pixel // 10 AS "row", pixel % 10 AS col, ({_confidence_sql(0.0)}) AS confidence, nbr_center - nbr AS dn, nbr AS post, {_FORMULA['bsi']} AS bsi FROM one WHERE rn = 1 AND scene IN (SELECT scene FROM ok)),
g AS (SELECT scene FROM j GROUP BY 1 HAVING count(*) FILTER (confidence > 0)::DOUBLE / count(*) <= 0.3::DOUBLE),
cell AS (SELECT *, "row" * 1048576::BIGINT + col AS k, CASE WHEN dn > 0.27::DOUBLE AND post < 0.1::DOUBLE THEN 1 WHEN bsi > 0.1::DOUBLE AND dn > 0.05::DOUBLE THEN 2 WHEN dn > 0.1::DOUBLE THEN 3 ELSE 0 END AS kind FROM j WHERE confidence > 0 AND scene IN (SELECT scene FROM g)),
near AS (SELECT a.scene, a.k, b.k AS o FROM cell a JOIN cell b ON a.scene = b.scene AND abs(a."row" - b."row") + abs(a.col - b.col) = 1),
walk AS (SELECT scene, k, k AS lab FROM cell UNION SELECT n.scene, n.o, w.lab FROM walk w JOIN near n ON w.scene = n.scene AND w.k = n.k AND w.lab < n.o),
lab AS (SELECT scene, k, min(lab) AS region FROM walk GROUP BY 1, 2), reg AS (SELECT cell.*, region FROM cell JOIN lab USING (scene, k)),
mode AS (SELECT scene, region, kind, row_number() OVER (PARTITION BY scene, region ORDER BY count(*) DESC, kind) AS rn FROM reg WHERE kind > 0 GROUP BY 1, 2, 3),
a AS (SELECT scene, region, count(*) AS n_cells, count(*) * 20.0::DOUBLE * 20 / 1e4 AS area_ha, max(confidence)::INT AS confidence, min(col) * 20.0::DOUBLE AS x0, min("row") * 20.0::DOUBLE AS y0, (max(col) + 1) * 20.0::DOUBLE AS x1, (max("row") + 1) * 20.0::DOUBLE AS y1 FROM reg GROUP BY 1, 2 HAVING count(*) * 20.0::DOUBLE * 20 / 1e4 BETWEEN 0.08::DOUBLE AND 1000)
SELECT a.*, CASE a.confidence WHEN 1 THEN 'low' WHEN 2 THEN 'medium' ELSE 'high' END AS confidence_label, coalesce(kind, 0)::INT AS clearing FROM a LEFT JOIN mode ON mode.rn = 1 AND a.scene = mode.scene AND a.region = mode.region"""


@query("detect_alerts", "WITH " + _DETECT_SQL)
def detect_alerts(spark, d) -> DataFrame:
    """From observations to alerts: clear gate, first clear observation, baselines, levels, guard, regions, areas and clearing types."""
    obs = observations(spark, d).withColumns({"scene": _month(), "row": F.floor(F.col("pixel") / 10).cast("int"), "col": (F.col("pixel") % 10).cast("int")})
    late = obs.where(F.col("obs_date") >= F.lit("2000-01-01").cast("date"))
    clear = ix.clear_scl(F.col("scl"))
    return runs.detect(late, _baseline(spark, d), runs.masked_values(_NAMES, clear), clear, bsi=ix.index_column("bsi"), min_ha=0.08)


