"""Queries over true shapes, areas of many rings and rasters of other coordinate systems, and their DuckDB SQL."""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from greensward.operators import areas, outlines, persistence, regions, shapes
from greensward.operators.grid import Grid
from greensward.operators.spatial import utm_forward, utm_inverse
from greensward.operators.warp import warp
from greensward.plans.flow import _utm_forward_sql, _utm_inverse_sql
from greensward.plans.registry import registry
from greensward.plans.space import _REGION_SQL, _group_sql
from greensward.sources.alerts import degree_rings
from greensward.sources.observations import RASTER_SQL, dated_cells, raster, table

QUERIES, SQL, query = registry()

#: Images of 8 x 8 cells of 20 m lie here.
UTM = Grid(400_000.0, 9_150_160.0, 20.0, 8, 8)
_FORWARD, _INVERSE = functools.partial(utm_forward, m=np), functools.partial(utm_inverse, m=np)
_WEST, _NORTH = (float(v) for v in _INVERSE(np.float64(UTM.left), np.float64(UTM.top)))

# outlines ---------------------------------------------------------------------------------

# sides of cells towards other regions, and the straight lines that they make up
_SIDE_SQL = f"""{_REGION_SQL}, side AS (
  SELECT img, region, 'h' AS axis, "row" + k AS line, col AS pos, k FROM reg a, range(0, 2) t(k) WHERE NOT EXISTS (SELECT 1 FROM reg b WHERE b.img = a.img AND b.region = a.region AND b."row" = a."row" + 2 * k - 1 AND b.col = a.col)
  UNION ALL SELECT img, region, 'v', col + k, "row", k FROM reg a, range(0, 2) t(k) WHERE NOT EXISTS (SELECT 1 FROM reg b WHERE b.img = a.img AND b.region = a.region AND b.col = a.col + 2 * k - 1 AND b."row" = a."row")),
isl AS (SELECT *, pos - row_number() OVER (PARTITION BY img, region, axis, line, k ORDER BY pos) AS island FROM side),
seg AS (SELECT img, region, axis, line, k, min(pos) AS a, max(pos) + 1 AS b FROM isl GROUP BY img, region, axis, line, k, island)"""
_HOLE_SQL = """v AS (SELECT img, region, count(DISTINCT ("row" + dr) * 100000 + col + dc) AS n FROM reg, range(0, 2) t(dr), range(0, 2) s(dc) GROUP BY 1, 2),
e AS (SELECT img, region, count(*) AS n FROM (SELECT img, region FROM side UNION ALL
  SELECT a.img, a.region FROM reg a JOIN reg b ON a.img = b.img AND a.region = b.region AND ((b."row" = a."row" + 1 AND b.col = a.col) OR (b.col = a.col + 1 AND b."row" = a."row"))) GROUP BY 1, 2),
c AS (SELECT img, region, count(*) AS n FROM reg GROUP BY 1, 2)"""


def _rings(spark, d) -> DataFrame:
    return outlines.outlines(regions.label_regions(raster(spark, d).where("v < 0")), tile=4)


@query("alert_outlines", f"""WITH {_SIDE_SQL}, {_HOLE_SQL}, s AS (SELECT img, region, count(*) AS n_corners, sum(b - a) * 20.0::DOUBLE AS perimeter FROM seg GROUP BY 1, 2)
SELECT img, region, c.n * 400.0::DOUBLE / 1e4 AS area_ha, 1 - (v.n - e.n + c.n) AS n_holes, n_corners, perimeter FROM c JOIN v USING (img, region) JOIN e USING (img, region) JOIN s USING (img, region)""")
def alert_outlines(spark, d) -> DataFrame:
    """Area by the rings of each region, holes off; rings go over the edges of tiles of 4 x 4 cells."""
    r = _rings(spark, d)
    length = F.aggregate(F.sequence(F.lit(1), F.size("ring") - 1), F.lit(0).cast("long"), lambda n, i: n + F.abs(F.get("ring", i)["row"] - F.get("ring", i - 1)["row"]) + F.abs(F.get("ring", i)["col"] - F.get("ring", i - 1)["col"]))
    return r.groupBy("img", "region").agg(regions.area_ha(F.sum("cells"), 20.0).alias("area_ha"), F.count_if(F.col("cells") < 0).alias("n_holes"), F.sum(F.size("ring") - 1).alias("n_corners"), (F.sum(length) * 20.0).alias("perimeter"))


_POINT_SQL = f"""pt AS (SELECT img, region, {UTM.left!r}::DOUBLE + 20 * CASE axis WHEN 'h' THEN CASE k WHEN 1 THEN a ELSE b END ELSE line END AS x, {UTM.top!r}::DOUBLE - 20 * CASE axis WHEN 'v' THEN CASE k WHEN 1 THEN b ELSE a END ELSE line END AS y FROM seg)"""


@query("outline_corners", f"WITH {_SIDE_SQL}, {_POINT_SQL}, {_utm_inverse_sql('x', 'y', 'pt')} SELECT img, region, round(lon, 6) AS lon, round(lat, 6) AS lat FROM u3")
def outline_corners(spark, d) -> DataFrame:
    """The corners of all rings in degrees, as features carry them."""
    p = degree_rings(outlines.polygons(_rings(spark, d), left=UTM.left, top=UTM.top))
    ring = p.select("img", "region", F.explode("rings").alias("ring")).select("img", "region", F.explode(F.slice("ring", 2, F.size("ring") - 1)).alias("p"))
    return ring.select("img", "region", F.round(F.col("p")[0], 6).alias("lon"), F.round(F.col("p")[1], 6).alias("lat"))


# overlap ----------------------------------------------------------------------------------

_DATED_SQL = _REGION_SQL.replace(RASTER_SQL, """raster AS (SELECT vec_id // 50 AS img, ((k - 1) // 8)::INT AS "row", ((vec_id % 50) * 10 + (k - 1) % 8)::INT AS col, embedding[k]::DOUBLE AS v FROM embeddings, range(1, 65) t(k))""")
_NEXT_SQL = f"""{_DATED_SQL}, sz AS (SELECT img, region, count(*) AS size FROM reg GROUP BY 1, 2)"""


def _shapes(spark, d) -> DataFrame:
    labelled = regions.label_regions(dated_cells(spark, d).where("v < 0"), "date")
    return shapes.runs(labelled.withColumnRenamed("region", "id"), ["date", "id"])


@query("shape_pairs", f"""WITH {_NEXT_SQL} SELECT a.img AS date, a.region AS a_id, b.region AS b_id, count(*) AS overlap, any_value(size) AS size FROM reg a JOIN reg b ON a.img = b.img + 1 AND a."row" = b."row" AND a.col = b.col JOIN sz ON sz.img = a.img AND sz.region = a.region GROUP BY 1, 2, 3 HAVING count(*) >= 0.05::DOUBLE * any_value(size)""")
def shape_pairs(spark, d) -> DataFrame:
    """Regions and those of the date before that cover a twentieth of their cells; boxes that meet are not enough."""
    return shapes.with_previous(_shapes(spark, d)).select("date", "a_id", "b_id", "overlap", "size")


@query("shape_strict", f"""WITH {_NEXT_SQL}, u AS (SELECT DISTINCT img + k AS img, k, "row", col FROM reg, range(1, 3) t(k)),
h AS (SELECT reg.img, region, k, count(*) AS hit FROM reg JOIN u USING (img, "row", col) GROUP BY 1, 2, 3) SELECT img AS date, region AS id FROM h JOIN sz USING (img, region) WHERE hit >= 0.3::DOUBLE * size GROUP BY 1, 2 HAVING count(*) = 2""")
def shape_strict(spark, d) -> DataFrame:
    """Regions of which both observations before cover 30 % of the cells."""
    return shapes.strict_shapes(_shapes(spark, d), 0.3, 2)


# tracks of shapes: st carries the date and id of the alert that gives a track its shape
_TRACK_SQL = f"""{_NEXT_SQL}, al AS (SELECT DATE '2020-01-01' + (img * 16)::INT AS date, img, region AS id, size FROM sz), r AS (SELECT *, dense_rank() OVER (ORDER BY date) AS rank FROM al),
ov AS (SELECT a.img AS ai, a.region AS aid, b.img AS bi, b.region AS bid, count(*) AS n FROM reg a JOIN reg b ON a."row" = b."row" AND a.col = b.col AND b.img < a.img GROUP BY 1, 2, 3, 4),
st AS (SELECT 0::BIGINT AS rank, 'S' AS kind, NULL::DATE AS date, ''::VARCHAR AS tid, 0::BIGINT AS id, 0::INT AS n, NULL::DATE AS first, NULL::DATE AS last, 0::BIGINT AS gi, 0::BIGINT AS gid
UNION ALL (WITH now AS (SELECT max(rank) + 1 AS rank FROM st), c AS (SELECT r.* FROM r JOIN now USING (rank)), d AS (SELECT min(rank) AS rank, min(date) AS day FROM c HAVING count(*) > 0),
t AS (SELECT st.* FROM st WHERE kind = 'T'), live AS (SELECT t.* FROM t, d WHERE n >= 15 OR day - last <= 180),
pr AS (SELECT c.id, live.tid, ov.n::DOUBLE / c.size AS share FROM c JOIN ov ON ov.ai = c.img AND ov.aid = c.id JOIN live ON live.gi = ov.bi AND live.gid = ov.bid),
best AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY share DESC, tid) AS rn FROM pr WHERE share >= 0.05::DOUBLE),
m AS (SELECT c.*, best.tid FROM c LEFT JOIN best ON best.id = c.id AND best.rn = 1),
big AS (SELECT *, row_number() OVER (PARTITION BY tid ORDER BY size DESC, id) AS rn FROM m WHERE tid IS NOT NULL),
nt AS (SELECT t.tid, t.id, t.n + 1 AS n, t.first, day AS last, b.img AS gi, b.id AS gid FROM t JOIN big b ON b.tid = t.tid AND b.rn = 1, d
  UNION ALL SELECT strftime(day, '%Y%m%d') || '-' || lpad(m.id::VARCHAR, 19, '0'), m.id, 1, day, day, m.img, m.id FROM m, d WHERE tid IS NULL
  UNION ALL SELECT t.tid, t.id, t.n, t.first, t.last, t.gi, t.gid FROM t WHERE NOT EXISTS (SELECT 1 FROM big WHERE big.tid = t.tid))
SELECT d.rank, 'T', day, nt.tid, nt.id, nt.n::INT, nt.first, nt.last, nt.gi, nt.gid FROM nt, d WHERE nt.n >= 15 OR day - nt.last <= 180
UNION ALL SELECT d.rank, 'A', day, '', m.id, coalesce(t.n + 1, 1)::INT, coalesce(t.first, day), day, 0, 0 FROM m LEFT JOIN t ON t.tid = m.tid, d
UNION ALL SELECT d.rank, 'S', day, '', 0, 0, NULL, NULL, 0, 0 FROM d))"""


@query("shape_tracks", f"WITH {_TRACK_SQL} SELECT date, id, n AS persistence_count, CASE WHEN n >= 15 THEN 'confirmed' WHEN n >= 2 THEN 'candidate' ELSE 'first_observation' END AS persistence_status, first AS first_seen, last AS last_seen FROM st WHERE kind = 'A'")
def shape_tracks(spark, d) -> DataFrame:
    """Regions of dates 16 days apart followed by the cells that they share."""
    s = _shapes(spark, d).withColumn("date", F.date_add(F.lit("2020-01-01").cast("date"), (F.col("date") * 16).cast("int")))
    labelled, _ = persistence.fold_tracks(shapes.stretches(s))
    return labelled.select("date", "id", "persistence_count", "persistence_status", "first_seen", "last_seen")


# areas ------------------------------------------------------------------------------------

# each nation's customers in order are the corners of a ring; what lies in an odd number of rings is inside
_CORNER_SQL = """cu AS (SELECT c_nationkey, c_custkey, c_acctbal::DOUBLE AS bal, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS k, count(*) OVER (PARTITION BY c_nationkey) AS n FROM customer),
cp AS (SELECT c_nationkey, k, n, 700 + 25 * c_nationkey + (300 + bal / 40) * cos(6.283185307179586::DOUBLE * k / n) AS x, 700 + 11 * c_nationkey + (300 + bal / 40) * sin(6.283185307179586::DOUBLE * k / n) AS y FROM cu),
ed AS (SELECT a.x AS x0, a.y AS y0, b.x AS x1, b.y AS y1 FROM cp a JOIN cp b ON a.c_nationkey = b.c_nationkey AND b.k = (a.k + 1) % a.n WHERE a.n > 1)"""
_AREA = Grid(0.0, 1600.0, 10.0, 160, 160)
_CELL_SQL = """ce AS (SELECT p_partkey, (p_partkey * 37) % 160 AS "row", (p_partkey * 91) % 160 AS col FROM part), cc AS (SELECT *, 1600 - ("row" + 0.5::DOUBLE) * 10 AS y, (col + 0.5::DOUBLE) * 10 AS x FROM ce),
odd AS (SELECT p_partkey FROM cc JOIN ed ON (y < y0) <> (y < y1) AND x < (x1 - x0) * (y - y0) / (y1 - y0) + x0 GROUP BY 1 HAVING count(*) % 2 = 1)"""


def _area_edges(spark, d) -> DataFrame:
    c = table(spark, d, "customer")
    mine = Window.partitionBy("c_nationkey")
    turn = 6.283185307179586 * (F.row_number().over(mine.orderBy("c_custkey")) - 1) / F.count(F.lit(1)).over(mine)
    far, k = 300 + F.col("c_acctbal") / 40, F.col("c_nationkey")
    point = F.struct((700 + 25 * k + far * F.cos("turn")).alias("x"), (700 + 11 * k + far * F.sin("turn")).alias("y"))
    corners = c.withColumn("turn", turn).groupBy("c_nationkey").agg(F.array_sort(F.collect_list(F.struct("c_custkey", point.alias("p")))).alias("r"))
    return areas.ring_edges(corners.select(F.transform("r", lambda q: q["p"]).alias("ring")), [])


def _area_cells(spark, d) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, d, "part").select(k, ((k * 37) % 160).alias("row"), ((k * 91) % 160).alias("col"))


@query("aoi_scanline", f"WITH {_CORNER_SQL}, {_CELL_SQL} SELECT p_partkey FROM odd")
def aoi_scanline(spark, d) -> DataFrame:
    """Cells whose centres lie in an area of 25 rings with holes, whose corners grow with the table."""
    return areas.clip_to(_area_cells(spark, d), areas.area_runs(_area_edges(spark, d), [], _AREA, all_touched=False)).select("p_partkey")


@query("aoi_scanline_touched", f"""WITH {_CORNER_SQL}, {_CELL_SQL}, hit AS (SELECT DISTINCT p_partkey FROM cc JOIN ed ON x + 5 >= least(x0, x1) AND x - 5 <= greatest(x0, x1) AND y + 5 >= least(y0, y1) AND y - 5 <= greatest(y0, y1) AND abs((x - x0) * (y1 - y0) - (y - y0) * (x1 - x0)) <= 5 * (abs(x1 - x0) + abs(y1 - y0)))
SELECT p_partkey FROM odd UNION SELECT p_partkey FROM hit""")
def aoi_scanline_touched(spark, d) -> DataFrame:
    return areas.clip_to(_area_cells(spark, d), areas.area_runs(_area_edges(spark, d), [], _AREA)).select("p_partkey")


# other coordinate systems -----------------------------------------------------------------

_DEGREES = Grid(_WEST - 3e-4, _NORTH + 3e-4, 1.7e-4, 13, 13)
_DEGREE_SQL = f"""t AS (SELECT r AS "row", c AS col, {_DEGREES.left!r}::DOUBLE + (c + 0.5::DOUBLE) * {_DEGREES.res!r}::DOUBLE AS lon, {_DEGREES.top!r}::DOUBLE - (r + 0.5::DOUBLE) * {_DEGREES.res!r}::DOUBLE AS lat FROM range(0, 13) a(r), range(0, 13) b(c)), {_utm_forward_sql('t')},
g AS (SELECT "row", col, ({UTM.top!r}::DOUBLE - north) / 20 AS fr, (east - {UTM.left!r}::DOUBLE) / 20 AS fc FROM f3)"""


def _some(spark, d) -> DataFrame:
    """Images in which values below -0.1 are missing."""
    return raster(spark, d).withColumn("v", F.when(F.col("v") > -0.1, F.col("v")))


@query("warp_bilinear", f"""WITH {RASTER_SQL}, {_DEGREE_SQL}, n AS (SELECT img, g."row", g.col, v, (1 - abs(fr - 0.5::DOUBLE - r."row")) * (1 - abs(fc - 0.5::DOUBLE - r.col)) AS w FROM g JOIN raster r ON abs(fr - 0.5::DOUBLE - r."row") < 1 AND abs(fc - 0.5::DOUBLE - r.col) < 1 WHERE v > -0.1::DOUBLE)
SELECT img, "row", col, round(sum(w * v) / sum(w), 5) AS v FROM n WHERE w > 1e-12 GROUP BY 1, 2, 3""")
def warp_bilinear(spark, d) -> DataFrame:
    """Images on a grid of metres to one of degrees; taps go over the edges of tiles of 4 x 4 cells."""
    return warp(_some(spark, d), UTM, _DEGREES, ["img"], _FORWARD, _INVERSE, tile=4).select("img", "row", "col", F.round("v", 5).alias("v"))


@query("warp_nearest", f"""WITH {RASTER_SQL}, {_DEGREE_SQL} SELECT img, g."row", g.col, v FROM g JOIN raster r ON floor(fr) = r."row" AND floor(fc) = r.col WHERE v > -0.1::DOUBLE""")
def warp_nearest(spark, d) -> DataFrame:
    return warp(_some(spark, d), UTM, _DEGREES, ["img"], _FORWARD, _INVERSE, nearest=True, tile=4)


#: Land cover on grids of degrees, of about 10 m and 30 m a cell, out of ``part``.
LANDCOVER = {"10m": Grid(_WEST - 1e-4, _NORTH + 1e-4, 9e-5, 20, 1 << 20), "30m": Grid(_WEST - 2e-4, _NORTH + 2e-4, 2.7e-4, 8, 1 << 20)}


def _zone_sql(collection: str) -> str:
    g = LANDCOVER[collection]
    x, y, res = f"{g.left!r}::DOUBLE", f"{g.top!r}::DOUBLE", f"{g.res!r}::DOUBLE"
    return f"""lc{collection} AS (SELECT (p_partkey - 1) // {g.width} AS r, (p_partkey - 1) % {g.width} AS c, p_size AS code FROM part),
in{collection} AS (SELECT img, region, r, c FROM (SELECT img, region, k AS r, {y} - (k + 0.5::DOUBLE) * {res} AS cy, x0, y0, x1, y1 FROM de, LATERAL (SELECT unnest(range(greatest(floor(({y} - greatest(y0, y1)) / {res})::BIGINT, 0), floor(({y} - least(y0, y1)) / {res})::BIGINT + 1)) AS k) WHERE y0 <> y1) e, range(0, {g.width}) t(c)
  WHERE (cy < y0) <> (cy < y1) AND {x} + (c + 0.5::DOUBLE) * {res} < (x1 - x0) * (cy - y0) / (y1 - y0) + x0 GROUP BY 1, 2, 3, 4 HAVING count(*) % 2 = 1),
on{collection} AS (SELECT DISTINCT img, region, r, c FROM (SELECT de.*, r, unnest(range(floor((least(x0, x1) - {x}) / {res})::BIGINT - 1, floor((greatest(x0, x1) - {x}) / {res})::BIGINT + 2)) AS c FROM de, LATERAL (SELECT unnest(range(floor(({y} - greatest(y0, y1)) / {res})::BIGINT - 1, floor(({y} - least(y0, y1)) / {res})::BIGINT + 2)) AS r)) e
  WHERE {x} + (c + 1) * {res} >= least(x0, x1) AND {x} + c * {res} <= greatest(x0, x1) AND {y} - r * {res} >= least(y0, y1) AND {y} - (r + 1) * {res} <= greatest(y0, y1)
    AND abs(({x} + (c + 0.5::DOUBLE) * {res} - x0) * (y1 - y0) - ({y} - (r + 0.5::DOUBLE) * {res} - y0) * (x1 - x0)) <= {res} / 2 * (abs(x1 - x0) + abs(y1 - y0))),
nn{collection} AS (SELECT img, region, code, {_group_sql('code', collection)} AS grp, count(*) AS n FROM (SELECT * FROM in{collection} UNION SELECT * FROM on{collection}) z JOIN lc{collection} USING (r, c) GROUP BY 1, 2, 3, 4),
bb{collection} AS (SELECT img, region, code, grp, row_number() OVER (PARTITION BY img, region ORDER BY n DESC, code) AS rn FROM nn{collection} WHERE code <> 0),
zz{collection} AS (SELECT n.img, n.region, any_value(b.code) AS lc_class, any_value(b.grp) AS lc_group, round_even(sum(CASE WHEN n.code <> 0 AND n.grp = 'natural' THEN n.n ELSE 0 END)::DOUBLE / nullif(sum(CASE WHEN n.code <> 0 THEN n.n END), 0), 3) AS lc_natural_frac
  FROM nn{collection} n LEFT JOIN bb{collection} b ON b.img = n.img AND b.region = n.region AND b.rn = 1 GROUP BY 1, 2)"""


_ZONE_SQL = f"""{_SIDE_SQL}, sg AS (SELECT *, row_number() OVER (ORDER BY img, region, axis, line, k, a) AS sid FROM seg),
en AS (SELECT img, region, sid, k2, {UTM.left!r}::DOUBLE + 20 * CASE axis WHEN 'h' THEN CASE k2 WHEN 0 THEN a ELSE b END ELSE line END AS x, {UTM.top!r}::DOUBLE - 20 * CASE axis WHEN 'v' THEN CASE k2 WHEN 0 THEN a ELSE b END ELSE line END AS y FROM sg, range(0, 2) t(k2)),
{_utm_inverse_sql('x', 'y', 'en')}, de AS (SELECT a.img, a.region, a.lon AS x0, a.lat AS y0, b.lon AS x1, b.lat AS y1 FROM u3 a JOIN u3 b ON a.sid = b.sid AND a.k2 = 0 AND b.k2 = 1),
{_zone_sql('10m')}, {_zone_sql('30m')}, al AS (SELECT DISTINCT img, region FROM reg)"""


@query("zonal_landcover", f"WITH {_ZONE_SQL} SELECT img, region, " + ", ".join(f"z{c}.{v} AS {v}_{c}" for c in LANDCOVER for v in ("lc_class", "lc_group", "lc_natural_frac")) + " FROM al LEFT JOIN zz10m z10m USING (img, region) LEFT JOIN zz30m z30m USING (img, region)")
def zonal_landcover(spark, d) -> DataFrame:
    """Outlines on a grid of 20 m in metres against land cover of 10 m and 30 m in degrees, all cells that they touch."""
    codes = {c: table(spark, d, "part").select(F.floor((F.col("p_partkey") - 1) / g.width).alias("row"), ((F.col("p_partkey") - 1) % g.width).alias("col"), F.col("p_size").alias("code")) for c, g in LANDCOVER.items()}
    alerts = outlines.polygons(_rings(spark, d), left=UTM.left, top=UTM.top)
    return areas.annotate_polygons(alerts, ["img", "region"], {c: (codes[c], g) for c, g in LANDCOVER.items()}, _INVERSE)
