"""Queries over regions, boxes and tracks, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greensward.functions.detection import confidence_label, landcover_group, persistence_tier
from greensward.operators import persistence, quality, regions
from greensward.plans.registry import registry
from greensward.sources.observations import BOX_SQL, RASTER_SQL, boxes, raster, table

QUERIES, SQL, query = registry()


_MIN_HA = 0.08
_REGION_SQL = f"""{RASTER_SQL}, cell AS (SELECT img, "row", col, v, "row" * 1048576::BIGINT + col AS k FROM raster WHERE v < 0),
near AS (SELECT a.img, a.k, b.k AS o FROM cell a JOIN cell b ON a.img = b.img AND abs(a."row" - b."row") + abs(a.col - b.col) = 1),
walk AS (SELECT img, k, k AS lab FROM cell UNION SELECT n.img, n.o, w.lab FROM walk w JOIN near n ON w.img = n.img AND w.k = n.k AND w.lab < n.o),
lab AS (SELECT img, k, min(lab) AS region FROM walk GROUP BY img, k),
reg AS (SELECT cell.img, region, "row", col, v, CASE WHEN v < -0.25::DOUBLE THEN 3 WHEN v < -0.15::DOUBLE THEN 2 ELSE 1 END AS confidence FROM cell JOIN lab USING (img, k))"""
_REGION_SQL = "RECURSIVE " + _REGION_SQL


def _regions(spark, d) -> DataFrame:
    cells = raster(spark, d).where("v < 0")
    level = F.when(F.col("v") < -0.25, 3).when(F.col("v") < -0.15, 2).otherwise(1)
    return regions.label_regions(cells).withColumn("confidence", level)


@query("components", f"WITH {_REGION_SQL} SELECT img, region, count(*) AS n_cells, count(*) * 20.0::DOUBLE * 20 / 1e4 AS area_ha FROM reg GROUP BY 1, 2 HAVING count(*) * 20.0::DOUBLE * 20 / 1e4 BETWEEN {_MIN_HA}::DOUBLE AND 1000")
def components(spark, d) -> DataFrame:
    n = _regions(spark, d).groupBy("img", "region").agg(F.count(F.lit(1)).alias("n_cells")).withColumn("area_ha", regions.area_ha(F.col("n_cells"), 20.0))
    return regions.area_filter(n, _MIN_HA)


@query("zonal_confidence", f"WITH {_REGION_SQL} SELECT img, region, max(confidence)::INT AS confidence, CASE max(confidence) WHEN 1 THEN 'low' WHEN 2 THEN 'medium' ELSE 'high' END AS label FROM reg GROUP BY 1, 2")
def zonal_confidence(spark, d) -> DataFrame:
    return regions.zonal_max(_regions(spark, d), ["img", "region"], "confidence").withColumn("label", confidence_label(F.col("confidence")))


@query("alert_summary", f"WITH {_REGION_SQL}, a AS (SELECT img, region, max(confidence) AS confidence, count(*) * 20.0::DOUBLE * 20 / 1e4 AS area_ha FROM reg GROUP BY 1, 2) SELECT count(*) AS n_alerts, round_even(coalesce(sum(area_ha), 0), 2) AS total_area_ha, count(*) FILTER (confidence = 1) AS n_low, count(*) FILTER (confidence = 2) AS n_medium, count(*) FILTER (confidence = 3) AS n_high FROM a")
def alert_summary(spark, d) -> DataFrame:
    a = _regions(spark, d).groupBy("img", "region").agg(F.max("confidence").alias("confidence"), regions.area_ha(F.count(F.lit(1)), 20.0).alias("area_ha"))
    return regions.alert_summary(a)


@query("zonal_modal_class", "WITH n AS (SELECT p_brand AS zone, p_size AS code, count(*) AS n FROM part WHERE p_size > 0 GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY zone ORDER BY n DESC, code) AS rn FROM n) SELECT zone, code AS mode FROM r WHERE rn = 1")
def zonal_modal_class(spark, d) -> DataFrame:
    return regions.zonal_mode(table(spark, d, "part").select(F.col("p_brand").alias("zone"), F.col("p_size").alias("code")), ["zone"], "code")


def _group_sql(code: str, collection: str) -> str:
    from greensward import config

    return "CASE " + " ".join(f"WHEN {code} IN ({', '.join(map(str, c))}) THEN '{g}'" for g, c in config.LANDCOVER_GROUPS[collection].items()) + " ELSE 'other' END"


def _lc_sql(collection: str) -> str:
    g = _group_sql("p_size", collection)
    return f"""n{collection} AS (SELECT p_brand AS zone, p_size AS code, {g} AS grp, count(*) AS n FROM part GROUP BY 1, 2, 3),
b{collection} AS (SELECT zone, code, grp, row_number() OVER (PARTITION BY zone ORDER BY n DESC, code) AS rn FROM n{collection} WHERE code <> 0),
l{collection} AS (SELECT zone, any_value(b.code) AS lc_class, any_value(b.grp) AS lc_group, round_even(sum(CASE WHEN n.code <> 0 AND n.grp = 'natural' THEN n ELSE 0 END)::DOUBLE / nullif(sum(CASE WHEN n.code <> 0 THEN n.n END), 0), 3) AS lc_natural_frac
  FROM n{collection} n LEFT JOIN b{collection} b USING (zone) WHERE b.rn = 1 OR b.rn IS NULL GROUP BY zone)"""


_LC_SQL = (_lc_sql("10m") + ", " + _lc_sql("30m")).replace("THEN n ELSE 0 END", "THEN n.n ELSE 0 END")


def _zones(spark, d) -> DataFrame:
    return table(spark, d, "part").select(F.col("p_brand").alias("zone"), F.col("p_size").alias("code"))


@query("landcover_annotate", f"WITH {_LC_SQL} SELECT zone, a.lc_class AS lc_class_10m, a.lc_group AS lc_group_10m, a.lc_natural_frac AS lc_natural_frac_10m, b.lc_class AS lc_class_30m, b.lc_group AS lc_group_30m, b.lc_natural_frac AS lc_natural_frac_30m, a.lc_class, a.lc_group, a.lc_natural_frac FROM l10m a JOIN l30m b USING (zone)")
def landcover_annotate(spark, d) -> DataFrame:
    """Both collections side by side, and the default one again; a third that is unknown is skipped."""
    return regions.annotate_all(_zones(spark, d), ["zone"], {"10m": "code", "30m": "code", "other": "code", "5m": "missing"})


@query("natural_filter", f"WITH {_LC_SQL} SELECT zone, lc_natural_frac FROM l10m WHERE coalesce(lc_natural_frac, 0) >= 0.15::DOUBLE")
def natural_filter(spark, d) -> DataFrame:
    """At a limit of 0.15, which these zones cross."""
    return regions.natural_filter(regions.annotate_landcover(_zones(spark, d), ["zone"], "code"), 0.15).select("zone", "lc_natural_frac")


@query("lc_validation", "WITH n AS (SELECT p_size AS code, count(*) AS n FROM part GROUP BY 1), a AS (SELECT 1.0::DOUBLE - sum(CASE WHEN code = 0 THEN n ELSE 0 END)::DOUBLE / sum(n) AS v, count(*) AS k, bool_and(code BETWEEN 0 AND 62) AS p, bool_or(code IN (3, 4, 12)) AS g FROM n) SELECT round(v, 4) AS valid_frac, k AS n_classes, v > 0.5::DOUBLE AS has_valid_data, p AS plausible_classes, g AS vegetation_present, v > 0.5::DOUBLE AND p AND g AS passed FROM a")
def lc_validation(spark, d) -> DataFrame:
    return quality.landcover_checks(table(spark, d, "part"), "p_size")


_PAIR_SQL = f"""{BOX_SQL}, r AS (SELECT *, dense_rank() OVER (ORDER BY date) AS rank FROM box),
pair AS (SELECT a.rank, a.date, a.id AS a_id, b.id AS b_id, (least(a.x1, b.x1) - greatest(a.x0, b.x0)) * (least(a.y1, b.y1) - greatest(a.y0, b.y0)) AS overlap, (a.x1 - a.x0) * (a.y1 - a.y0) AS a_area
  FROM r a JOIN r b ON a.rank = b.rank + 1 AND a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1)"""


@query("spatial_pairs", f"WITH {_PAIR_SQL} SELECT date, a_id, b_id, overlap FROM pair")
def spatial_pairs(spark, d) -> DataFrame:
    return persistence.tile_pairs(boxes(spark, d))


def union_share_sql(back: int, name: str) -> str:
    """CTEs up to ``name`` (date, id, share) over ``r``: the share of a box that the union of the observation ``back`` dates before covers, in strips between sides."""
    return f"""p{name} AS (SELECT a.rank, a.id, greatest(a.x0, b.x0) AS l, least(a.x1, b.x1) AS r, greatest(a.y0, b.y0) AS t, least(a.y1, b.y1) AS u FROM r a JOIN r b ON a.rank = b.rank + {back} AND a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1),
v{name} AS (SELECT rank, id, x, lead(x) OVER (PARTITION BY rank, id ORDER BY x) AS nx FROM (SELECT rank, id, l AS x FROM p{name} UNION SELECT rank, id, r FROM p{name})),
s{name} AS (SELECT v.rank, v.id, v.x, v.nx, p.t, p.u, max(p.u) OVER (PARTITION BY v.rank, v.id, v.x ORDER BY p.t, p.u ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM v{name} v JOIN p{name} p ON v.rank = p.rank AND v.id = p.id AND p.l <= v.x AND p.r >= v.nx),
c{name} AS (SELECT rank, id, sum((nx - x) * greatest(u - greatest(t, coalesce(m, t)), 0)) AS covered FROM s{name} GROUP BY 1, 2),
{name} AS (SELECT r.date, r.id, coalesce(covered, 0)::DOUBLE / ((x1 - x0) * (y1 - y0)) AS share FROM r LEFT JOIN c{name} c ON c.rank = r.rank AND c.id = r.id)"""


_STRICT_SQL = f"""{BOX_SQL}, r AS (SELECT *, dense_rank() OVER (ORDER BY date) AS rank FROM box), {union_share_sql(1, 'share')},
kept AS (SELECT date, id FROM share WHERE share >= 0.05::DOUBLE)"""


@query("persist_strict", f"WITH {_STRICT_SQL} SELECT date, id FROM kept")
def persist_strict(spark, d) -> DataFrame:
    return persistence.strict_filter(boxes(spark, d)).select("date", "id")


@query("persist_history", f"WITH {_STRICT_SQL} SELECT box.date, count(*) AS raw, count(kept.id) AS confirmed, count(*) - count(kept.id) AS dropped, round_even((count(*) - count(kept.id))::DOUBLE / count(*), 4) AS drop_frac FROM box LEFT JOIN kept USING (date, id) GROUP BY box.date")
def persist_history(spark, d) -> DataFrame:
    return persistence.history_summary(boxes(spark, d))


_STREAK_SQL = f"""RECURSIVE {_PAIR_SQL}, hit AS (SELECT rank, a_id, b_id FROM pair WHERE overlap >= 0.05::DOUBLE * a_area),
st AS (SELECT rank, date, id, 1 AS n FROM r WHERE rank = 1
  UNION ALL SELECT r.rank, r.date, r.id, 1 + coalesce(max(st.n), 0) FROM r JOIN (SELECT max(rank) + 1 AS rank FROM st) now ON r.rank = now.rank
    LEFT JOIN hit ON hit.rank = r.rank AND hit.a_id = r.id LEFT JOIN st ON st.id = hit.b_id GROUP BY r.rank, r.date, r.id)"""

@query("persist_streak", f"WITH {_STREAK_SQL} SELECT date, id, n::INT AS persistence_count FROM st")
def persist_streak(spark, d) -> DataFrame:
    """Streaks over all dates."""
    return persistence.chained_streaks(boxes(spark, d))


@query("persist_tiers", f"WITH {_STREAK_SQL} SELECT date, id, CASE WHEN n >= 15 THEN 'confirmed' WHEN n >= 2 THEN 'candidate' ELSE 'first_observation' END AS tier FROM st")
def persist_tiers(spark, d) -> DataFrame:
    """Tiers of the streaks over all dates."""
    return persistence.chained_streaks(boxes(spark, d)).select("date", "id", persistence_tier(F.col("persistence_count")).alias("tier"))


_TRACK_SQL = f"""RECURSIVE {BOX_SQL}, r AS (SELECT *, dense_rank() OVER (ORDER BY date) AS rank, (x1 - x0) * (y1 - y0) AS size FROM box),
st AS (SELECT 0::BIGINT AS rank, 'S' AS kind, NULL::DATE AS date, ''::VARCHAR AS tid, 0::BIGINT AS id, 0::INT AS n, NULL::DATE AS first, NULL::DATE AS last, 0::BIGINT AS x0, 0::BIGINT AS y0, 0::BIGINT AS x1, 0::BIGINT AS y1
UNION ALL (WITH now AS (SELECT max(rank) + 1 AS rank FROM st), c AS (SELECT r.* FROM r JOIN now USING (rank)), d AS (SELECT min(rank) AS rank, min(date) AS day FROM c HAVING count(*) > 0),
t AS (SELECT st.* FROM st WHERE kind = 'T'), live AS (SELECT t.* FROM t, d WHERE n >= 15 OR day - last <= 180),
pr AS (SELECT c.id, live.tid, ((least(c.x1, live.x1) - greatest(c.x0, live.x0)) * (least(c.y1, live.y1) - greatest(c.y0, live.y0)))::DOUBLE / c.size AS share FROM c JOIN live ON c.x0 < live.x1 AND live.x0 < c.x1 AND c.y0 < live.y1 AND live.y0 < c.y1),
best AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY share DESC, tid) AS rn FROM pr WHERE share >= 0.05::DOUBLE),
m AS (SELECT c.*, best.tid FROM c LEFT JOIN best ON best.id = c.id AND best.rn = 1),
big AS (SELECT *, row_number() OVER (PARTITION BY tid ORDER BY size DESC, id) AS rn FROM m WHERE tid IS NOT NULL),
nt AS (SELECT t.tid, t.id, t.n + 1 AS n, t.first, day AS last, b.x0, b.y0, b.x1, b.y1 FROM t JOIN big b ON b.tid = t.tid AND b.rn = 1, d
  UNION ALL SELECT strftime(day, '%Y%m%d') || '-' || lpad(m.id::VARCHAR, 19, '0'), m.id, 1, day, day, x0, y0, x1, y1 FROM m, d WHERE tid IS NULL
  UNION ALL SELECT t.tid, t.id, t.n, t.first, t.last, t.x0, t.y0, t.x1, t.y1 FROM t WHERE NOT EXISTS (SELECT 1 FROM big WHERE big.tid = t.tid))
SELECT d.rank, 'T', day, nt.tid, nt.id, nt.n::INT, nt.first, nt.last, nt.x0, nt.y0, nt.x1, nt.y1 FROM nt, d WHERE nt.n >= 15 OR day - nt.last <= 180
UNION ALL SELECT d.rank, 'A', day, '', m.id, coalesce(t.n + 1, 1)::INT, coalesce(t.first, day), day, 0, 0, 0, 0 FROM m LEFT JOIN t ON t.tid = m.tid, d
UNION ALL SELECT d.rank, 'S', day, '', 0, 0, NULL, NULL, 0, 0, 0, 0 FROM d))"""


@query("track_fold", f"WITH {_TRACK_SQL} SELECT date, id, n AS persistence_count, CASE WHEN n >= 15 THEN 'confirmed' WHEN n >= 2 THEN 'candidate' ELSE 'first_observation' END AS persistence_status, first AS first_seen, last AS last_seen FROM st WHERE kind = 'A'")
def track_fold(spark, d) -> DataFrame:
    labelled, _ = persistence.fold_tracks(boxes(spark, d))
    return labelled.select("date", "id", "persistence_count", "persistence_status", "first_seen", "last_seen")


@query("stratified_sample", f"""WITH n AS (SELECT p_partkey, p_brand, {_group_sql('p_size', '10m')} AS lc_group, row_number() OVER (PARTITION BY p_brand, {_group_sql('p_size', '10m')} ORDER BY (p_partkey * 7919) % 10007, p_partkey) AS rn FROM part) SELECT p_partkey, p_brand, lc_group FROM n WHERE rn <= 5""")
def stratified_sample(spark, d) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey", "p_brand", landcover_group(F.col("p_size")).alias("lc_group"))
    return quality.stratified_sample(p, ["p_brand", "lc_group"], F.struct((F.col("p_partkey") * 7919) % 10007, "p_partkey"), 5)
