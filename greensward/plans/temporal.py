"""Queries over time series, drought and catalogues, and their DuckDB SQL."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greensward.operators import quality, series
from greensward.plans.registry import registry
from greensward.sources import scenes
from greensward.sources.observations import MONTHLY_SQL, SERIES_SQL, daily_series, monthly_totals, table
from greensward.streaming.tracks import gap_sessions as sessions

QUERIES, SQL, query = registry()


@query("rolling3_sum", f"WITH {MONTHLY_SQL}, m AS (SELECT series_id, date, CASE WHEN month(date) <> 5 THEN value END AS value FROM monthly) SELECT series_id, date, round(CASE WHEN count(value) OVER w = 3 THEN sum(value) OVER w END, 4) AS sum3 FROM m WINDOW w AS (PARTITION BY series_id ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)")
def rolling3_sum(spark, d) -> DataFrame:
    """Mays count as missing."""
    m = monthly_totals(spark, d).withColumn("value", F.when(F.month("date") != 5, F.col("value")))
    return series.rolling3(m, ["date"], "value", ["series_id"]).select("series_id", "date", F.round("sum3", 4).alias("sum3"))


@query("spi3")
def spi3(spark, d) -> DataFrame:
    return series.spi3(monthly_totals(spark, d)).withColumn("spi3", F.round("spi3", 4))


_RAIN_SQL = f"{MONTHLY_SQL}, rain AS (SELECT year(date) AS year, month(date) AS month, avg(value) / 0.997::DOUBLE AS mm FROM monthly GROUP BY 1, 2), oni AS (SELECT year(date) AS year, month(date) AS seq, round((avg(value) - 120) / 19.97::DOUBLE, 4) AS anom FROM monthly GROUP BY 1, 2)"


@query("year_ranking", f"""WITH {_RAIN_SQL}, pk AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY abs(anom) DESC, seq) AS rn FROM oni),
o AS (SELECT year, anom AS peak, abs(anom) AS severity FROM pk WHERE rn = 1), r AS (SELECT year, sum(mm) AS annual FROM rain GROUP BY 1 HAVING count(DISTINCT month) = 12),
z AS (SELECT year, annual, CASE WHEN count(*) OVER () >= 2 AND stddev_pop(annual) OVER () > 0 THEN (annual - avg(annual) OVER ()) / stddev_pop(annual) OVER () END AS precip_z FROM r),
s AS (SELECT year, peak, severity, annual, precip_z, severity + 0.5::DOUBLE * coalesce(abs(precip_z), 0) AS score, severity < 1.5::DOUBLE AS eligible FROM o LEFT JOIN z USING (year))
SELECT year::INT AS year, peak, severity, round(annual, 4) AS annual, round(precip_z, 6) AS precip_z, round(score, 6) AS score, eligible, eligible AND row_number() OVER (PARTITION BY eligible ORDER BY year DESC) <= 5 AS recent, row_number() OVER (ORDER BY score, year DESC) <= 5 AS least FROM s""")
def year_ranking(spark, d) -> DataFrame:
    """Monthly means stand for rain, and their scaled distance from 120 for the climate index."""
    m = monthly_totals(spark, d)
    by = [F.year("date").alias("year"), F.month("date").alias("month")]
    rain = m.groupBy(*by).agg((F.avg("value") / 0.997).alias("mm"))
    oni = m.groupBy(*by).agg(F.round((F.avg("value") - 120) / 19.97, 4).alias("anom")).withColumnRenamed("month", "seq")
    out = quality.rank_years(oni, rain)
    return out.select("year", "peak", "severity", F.round("annual", 4).alias("annual"), F.round("precip_z", 6).alias("precip_z"), F.round("score", 6).alias("score"), "eligible", "recent", "least")


# sparse: two months of some series have no values, so that long gaps occur
_SPARSE_SQL = "sparse AS (SELECT o_custkey % 40 AS series_id, CAST(o_orderdate AS DATE) AS date, avg(CASE WHEN NOT (month(o_orderdate) IN (3, 4) AND o_custkey % 40 < 6) THEN o_totalprice END) / 997.0::DOUBLE AS value FROM orders GROUP BY 1, 2)"


def _sparse(spark, d) -> DataFrame:
    k = F.col("o_custkey") % 40
    price = F.when(~(F.month("o_orderdate").isin(3, 4) & (k < 6)), F.col("o_totalprice"))
    return table(spark, d, "orders").groupBy(k.alias("series_id"), F.col("o_orderdate").cast("date").alias("date")).agg((F.avg(price) / 997.0).alias("value"))


@query("gap_fill", f"""WITH {_SPARSE_SQL}, s AS (SELECT *, min(date) OVER (PARTITION BY series_id) AS d0 FROM sparse),
b AS (SELECT series_id, d0, datediff('day', d0, date) // 5 AS k, avg(value) AS v FROM s GROUP BY 1, 2, 3),
sp AS (SELECT series_id, d0, unnest(range(0, max(k) + 1)) AS k FROM b GROUP BY 1, 2),
r AS (SELECT sp.series_id, sp.d0, sp.k, v, count(v) OVER (PARTITION BY sp.series_id ORDER BY sp.k) AS g, count(v) OVER (PARTITION BY sp.series_id ORDER BY sp.k DESC) AS h FROM sp LEFT JOIN b ON b.series_id = sp.series_id AND b.k = sp.k),
t AS (SELECT *, count(*) OVER (PARTITION BY series_id, g) - 1 AS gap, max(v) OVER (PARTITION BY series_id, g) AS pv, min(k) OVER (PARTITION BY series_id, g) AS pk, max(v) OVER (PARTITION BY series_id, h) AS qv, max(k) OVER (PARTITION BY series_id, h) AS qk FROM r),
i AS (SELECT *, d0 + (5 * k)::INT AS bin_start, CASE WHEN v IS NOT NULL THEN v WHEN gap * 5 <= 30 AND g > 0 THEN CASE WHEN h = 0 THEN pv ELSE pv + (qv - pv) * (k - pk) / (qk - pk) END END AS inter FROM t)
SELECT series_id, CAST(bin_start AS DATE) AS bin_start, round(coalesce(inter, avg(inter) OVER (PARTITION BY series_id, dayofyear(bin_start))), 5) AS value, CASE WHEN v IS NOT NULL THEN 'observed' WHEN gap * 5 <= 30 THEN 'interpolated' ELSE 'seasonal' END AS filled FROM i""")
def gap_fill(spark, d) -> DataFrame:
    return series.gap_fill(_sparse(spark, d)).withColumn("value", F.round("value", 5))


def _least_squares_sql(source: str, k: int = 5) -> str:
    """CTEs up to ``fit`` (series_id, n, c0, c1, ...): the normal equations of the waves, by Cholesky's method written out."""
    wave = ["1.0::DOUBLE"] + [f"{f}({2 * h}::DOUBLE * pi() * dayofyear(date) / 365.25::DOUBLE)" for h in (1, 2) for f in ("cos", "sin")]
    out = [f"x AS (SELECT series_id, date, value, {', '.join(f'{w} AS x{i}' for i, w in enumerate(wave))} FROM {source} WHERE value IS NOT NULL)"]
    out.append(f"s0 AS (SELECT series_id, count(*) AS n, {', '.join(f'sum(x{i} * x{j}) AS g{i}{j}' for i in range(k) for j in range(i + 1))}, {', '.join(f'sum(x{i} * value) AS b{i}' for i in range(k))} FROM x GROUP BY 1)")
    step = 0

    def add(columns: list[str]) -> None:
        nonlocal step
        out.append(f"s{step + 1} AS (SELECT *, {', '.join(columns)} FROM s{step})")
        step += 1

    less = lambda v, terms: v + "".join(f" - {t}" for t in terms)
    for j in range(k):
        add([f"sqrt({less(f'g{j}{j}', [f'l{j}{m} * l{j}{m}' for m in range(j)])}) AS l{j}{j}"])
        if j + 1 < k:
            add([f"({less(f'g{i}{j}', [f'l{i}{m} * l{j}{m}' for m in range(j)])}) / l{j}{j} AS l{i}{j}" for i in range(j + 1, k)])
    for i in range(k):
        add([f"({less(f'b{i}', [f'l{i}{m} * z{m}' for m in range(i)])}) / l{i}{i} AS z{i}"])
    for i in reversed(range(k)):
        add([f"({less(f'z{i}', [f'l{m}{i} * c{m}' for m in range(i + 1, k)])}) / l{i}{i} AS c{i}"])
    names = ", ".join(f"c{i}" for i in range(k))
    out.append(f"sol AS (SELECT series_id, n, {names} FROM s{step} WHERE n >= {k})")
    fitted = " + ".join(f"c{i} * x{i}" for i in range(k))
    out.append(f"fit AS (SELECT series_id, any_value(n) AS n, {', '.join(f'any_value(c{i}) AS c{i}' for i in range(k))}, sqrt(avg((value - ({fitted})) ** 2)) AS rmse FROM x JOIN sol USING (series_id) GROUP BY 1)")
    return ", ".join(out)


@query("harmonic_fit", f"WITH {MONTHLY_SQL}, {_least_squares_sql('monthly')} SELECT series_id, n, {', '.join(f'round(c{i}, 5) AS c{i}' for i in range(5))}, round(rmse, 5) AS rmse FROM fit")
def harmonic_fit(spark, d) -> DataFrame:
    f = series.harmonic_fit(monthly_totals(spark, d))
    return f.select("series_id", "n", *[F.round(F.col("coefficients")[i], 5).alias(f"c{i}") for i in range(5)], F.round("rmse", 5).alias("rmse"))


_RESID_SQL = f"{SERIES_SQL}, res AS (SELECT series_id, date, value - avg(value) OVER (PARTITION BY series_id) AS residual, 0.05::DOUBLE * stddev_pop(value) OVER (PARTITION BY series_id) AS rmse FROM series)"


@query("breaks", f"""WITH {_RESID_SQL}, f AS (SELECT *, coalesce(abs(residual) > 3 * rmse, false) AS far FROM res), g AS (SELECT *, sum((NOT far)::INT) OVER (PARTITION BY series_id ORDER BY date) AS run FROM f),
h AS (SELECT *, row_number() OVER (PARTITION BY series_id, run ORDER BY date) AS i, lag(date, 2) OVER (PARTITION BY series_id, run ORDER BY date) AS first FROM g WHERE far)
SELECT series_id, first AS break_date FROM h WHERE i % 3 = 0""")
def breaks(spark, d) -> DataFrame:
    """Deviations from each user's mean, against a small given rmse."""
    from pyspark.sql import Window

    w = Window.partitionBy("series_id")
    s = daily_series(spark, d).withColumns({"residual": F.col("value") - F.avg("value").over(w), "rmse": 0.05 * F.stddev_pop("value").over(w)})
    return series.break_points(s)


@query("breaks_harmonic", f"""WITH {MONTHLY_SQL}, cut AS (SELECT series_id, date, value - CASE WHEN series_id % 2 = 0 AND date >= DATE '2000-01-01' THEN 200 ELSE 0 END AS value FROM monthly),
hist AS (SELECT * FROM cut WHERE date <= DATE '1998-12-31'), {_least_squares_sql('hist')},
w AS (SELECT cut.*, 2::DOUBLE * pi() * dayofyear(date) / 365.25::DOUBLE AS t FROM cut WHERE date > DATE '1998-12-31'),
e AS (SELECT w.series_id, date, value, c0 + c1 * cos(t) + c2 * sin(t) + c3 * cos(2 * t) + c4 * sin(2 * t) AS expected, rmse FROM w JOIN fit USING (series_id)),
f AS (SELECT *, coalesce(abs(value - expected) > 3 * rmse, false) AS far FROM e), g AS (SELECT *, sum((NOT far)::INT) OVER (PARTITION BY series_id ORDER BY date) AS run FROM f),
h AS (SELECT *, row_number() OVER p AS i, lag(date, 2) OVER p AS first FROM g WHERE far WINDOW p AS (PARTITION BY series_id, run ORDER BY date))
SELECT h.series_id, h.first AS break_date, round(e.value, 4) AS value, round(e.expected, 4) AS expected, round(e.value - e.expected, 4) AS anomaly FROM h JOIN e ON e.series_id = h.series_id AND e.date = h.first WHERE i % 3 = 0""")
def breaks_harmonic(spark, d) -> DataFrame:
    """Every other series falls by 200 from 2000 on; the years up to 1998 are the history."""
    fall = F.when((F.col("series_id") % 2 == 0) & (F.col("date") >= F.lit("2000-01-01").cast("date")), 200).otherwise(0)
    out = series.detect_breaks_harmonic(monthly_totals(spark, d).withColumn("value", F.col("value") - fall), "1998-12-31")
    return out.select("series_id", "break_date", *[F.round(c, 4).alias(c) for c in ("value", "expected", "anomaly")])


_PAIRS = f"{MONTHLY_SQL}, p AS (SELECT a.series_id, a.date AS di, b.date AS dj, a.value AS vi, b.value AS vj FROM monthly a JOIN monthly b ON a.series_id = b.series_id AND a.date < b.date)"


_MK_SQL = f"""{_PAIRS}, s AS (SELECT series_id, sum(sign(vj - vi))::BIGINT AS s FROM p GROUP BY 1), t AS (SELECT series_id, value, count(*) AS t FROM monthly GROUP BY 1, 2), u AS (SELECT series_id, sum(t)::BIGINT AS n, sum(t * (t - 1) * (2 * t + 5))::BIGINT AS ties FROM t GROUP BY 1),
v AS (SELECT series_id, n, s, (n * (n - 1) * (2 * n + 5) - ties) / 18.0::DOUBLE AS var_s FROM u JOIN s USING (series_id) WHERE n >= 4),
mk AS (SELECT series_id, n, s, round(s / (n * (n - 1) / 2.0::DOUBLE), 6) AS tau, round(var_s, 6) AS var_s, round(CASE WHEN s > 0 THEN (s - 1) / nullif(sqrt(var_s), 0) WHEN s < 0 THEN (s + 1) / nullif(sqrt(var_s), 0) ELSE 0 END, 6) AS z FROM v)"""


@query("mk_stat", f"WITH {_MK_SQL} SELECT * FROM mk")
def mk_stat(spark, d) -> DataFrame:
    return series.mann_kendall(monthly_totals(spark, d))


_SEN_SQL = """m AS (SELECT series_id, (vj - vi) / (datediff('day', di, dj) / 365.25::DOUBLE) AS m FROM p), r AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY m) - 1 AS r FROM m),
n AS (SELECT series_id, count(*) AS n, 1.96::DOUBLE * sqrt(count(*) * (count(*) - 1) * (2 * count(*) + 5) / 18.0::DOUBLE) AS c FROM monthly GROUP BY 1),
b AS (SELECT *, n * (n - 1) // 2 AS k, greatest(least(trunc((n * (n - 1) / 2.0::DOUBLE - c) / 2), n * (n - 1) // 2 - 1), 0) AS lo, greatest(least(trunc((n * (n - 1) / 2.0::DOUBLE + c) / 2), n * (n - 1) // 2 - 1), 0) AS hi FROM n WHERE n >= 3),
sl AS (SELECT series_id, median(m) AS slope, max(CASE WHEN r = lo THEN m END) AS low, max(CASE WHEN r = hi THEN m END) AS high FROM r JOIN b USING (series_id) GROUP BY 1),
d0 AS (SELECT series_id, min(date) AS d0 FROM monthly GROUP BY 1), ic AS (SELECT series_id, median(value - slope * datediff('day', d0, date) / 365.25::DOUBLE) AS intercept FROM monthly JOIN d0 USING (series_id) JOIN sl USING (series_id) GROUP BY 1),
sen AS (SELECT series_id, round(slope, 6) AS slope, round(intercept, 6) AS intercept, round(low, 6) AS low, round(high, 6) AS high FROM sl JOIN ic USING (series_id))"""


@query("sen_slope", f"WITH {_PAIRS}, {_SEN_SQL} SELECT * FROM sen")
def sen_slope(spark, d) -> DataFrame:
    return series.sen_slope(monthly_totals(spark, d))


def _tail_sql(z: str) -> str:
    poly = lambda c: functools.reduce(lambda a, x: f"({a}) * {z} + {x!r}::DOUBLE", c[1:], f"{c[0]!r}::DOUBLE")
    return f"CASE WHEN {z} < 7.07106781186547 THEN exp(-{z} * {z} / 2) * ({poly(series.TAIL_NUMERATOR)}) / ({poly(series.TAIL_DENOMINATOR)}) ELSE 0 END"


@query("trend_analysis", f"""WITH {_MK_SQL}, {_SEN_SQL}, pv AS (SELECT *, round(2 * {_tail_sql('abs(z)')}, 6) AS p_value FROM mk),
q AS (SELECT *, p_value < 0.05::DOUBLE AS significant, CASE WHEN p_value < 0.05::DOUBLE THEN CASE WHEN s > 0 THEN 'increasing' ELSE 'decreasing' END ELSE 'no_trend' END AS trend FROM pv)
SELECT q.*, slope, intercept, low, high FROM q JOIN sen USING (series_id)""")
def trend_analysis(spark, d) -> DataFrame:
    return series.trends(monthly_totals(spark, d)).drop("summary")


@query("stl")
def stl(spark, d) -> DataFrame:
    out = series.stl(monthly_totals(spark, d), period=12)
    return out.select("series_id", "date", *[F.round(c, 5).alias(c) for c in ("trend", "seasonal", "residual")])


_KEYS_SQL = "k AS (SELECT DISTINCT 'alerts/' || strftime(o_orderdate, '%Y-%m-%d') || CASE WHEN o_orderkey % 3 = 0 THEN '.json' ELSE '.geojson' END AS key FROM orders)"


@query("latest_n", f"WITH {_KEYS_SQL} SELECT key FROM k WHERE key LIKE '%.geojson' ORDER BY key DESC LIMIT 16")
def latest_n(spark, d) -> DataFrame:
    kind = F.when(F.col("o_orderkey") % 3 == 0, ".json").otherwise(".geojson")
    keys = table(spark, d, "orders").select(F.concat(F.lit("alerts/"), F.date_format("o_orderdate", "yyyy-MM-dd"), kind).alias("key")).distinct()
    return scenes.latest_keys(keys, 16)


_SCENE_SQL = "sc AS (SELECT o_orderkey AS scene_id, CAST(o_orderdate AS DATE) AS date, CASE WHEN o_orderkey % 11 <> 0 THEN (o_custkey % 100)::DOUBLE END AS cloud_cover, o_orderkey % 3 AS s FROM orders)"


@query("scene_search", f"WITH {_SCENE_SQL}, f AS (SELECT scene_id, cloud_cover, 's2' AS sensor FROM sc WHERE s = 0 AND date BETWEEN DATE '1999-01-01' AND DATE '1999-01-17' AND cloud_cover < 20 UNION ALL SELECT scene_id, cloud_cover, 'hls' FROM sc WHERE s = 1 AND date BETWEEN DATE '1999-01-01' AND DATE '1999-01-17' AND coalesce(cloud_cover, 100) < 20) SELECT scene_id, sensor FROM f ORDER BY coalesce(cloud_cover, 100), scene_id LIMIT 20")
def scene_search(spark, d) -> DataFrame:
    """Two sensors, the 20 clearest; the first falls back to a second provider when empty."""
    o = table(spark, d, "orders")
    cloud = F.when(F.col("o_orderkey") % 11 != 0, (F.col("o_custkey") % 100).cast("double"))
    sc = o.select(F.col("o_orderkey").alias("scene_id"), F.col("o_orderdate").cast("date").alias("date"), cloud.alias("cloud_cover"), (F.col("o_orderkey") % 3).alias("s"))
    look = lambda k, missing=None: scenes.search(sc.where(F.col("s") == k), "1999-01-01", "1999-01-17", 20, None, missing)
    return scenes.clearest({"s2": scenes.or_else(look(0), look(2)), "hls": look(1, 100.0)}).select("scene_id", "sensor")


@query("gap_sessions", "WITH e AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > ts - INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events), g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, new DESC ROWS UNBOUNDED PRECEDING) AS k FROM e) SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 6 HOUR AS \"end\", count(*) AS n_events FROM g GROUP BY user_id, k")
def gap_sessions(spark, d) -> DataFrame:
    s = sessions(table(spark, d, "events").withColumn("t", F.col("ts").cast("timestamp")), "user_id", "t", "6 hours")
    return s.select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "n_events")
