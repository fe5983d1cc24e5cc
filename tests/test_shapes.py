"""Outlines, overlap, areas, warps and zones against plain numpy."""

import functools
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from greensward.operators import areas, outlines, persistence, regions, shapes
from greensward.operators import warp as warps
from greensward.operators.batches import in_groups
from greensward.operators.graph import connected_components, joined_nearby
from greensward.operators.grid import Grid
from greensward.operators.spatial import utm_forward, utm_inverse
from greensward.operators.warp import warp
from greensward.sources import alerts as store

FORWARD, INVERSE = functools.partial(utm_forward, m=np), functools.partial(utm_inverse, m=np)


def cells_of(spark, grids):
    return spark.createDataFrame([(k, int(r), int(c)) for k, g in enumerate(grids) for r, c in np.argwhere(g)], "img int, row int, col int")


def filled(rings, shape):
    """Cells in an odd number of rings (corners)."""
    r, c = (g + 0.5 for g in np.indices(shape))
    odd = np.zeros(shape, bool)
    for ring in rings:
        for (r0, c0), (r1, c1) in zip(ring, ring[1:]):
            if r0 != r1:
                odd ^= (min(r0, r1) < r) & (r < max(r0, r1)) & (c < c0)
    return odd


PINCHED = np.array([[1, 1, 1, 1], [1, 0, 1, 1], [1, 1, 0, 1], [1, 1, 1, 1]])
OPEN = np.array([[1, 1, 1, 0], [1, 0, 1, 0], [1, 1, 0, 1], [1, 1, 1, 1]])


@pytest.mark.parametrize("tile", [3, 5, 64])
def test_outlines_hold_their_cells(spark, tile):
    rng = np.random.default_rng(tile)
    grids = [PINCHED, OPEN, np.ones((7, 7))] + [rng.random((13, 17)) < p for p in (0.5, 0.6, 0.8, 0.9)]
    labelled = regions.label_regions(cells_of(spark, grids), tile=tile).cache()
    rings = outlines.outlines(labelled, tile=tile).collect()
    want = {}
    for r in labelled.collect():
        want.setdefault((r.img, r.region), set()).add((r.row, r.col))
    got = {}
    for r in rings:
        ring = [(p.row, p.col) for p in r.ring]
        assert ring[0] == ring[-1] and len(set(ring[:-1])) == len(ring) - 1  # no ring touches itself
        assert all((a[0] == b[0]) != (a[1] == b[1]) for a, b in zip(ring, ring[1:]))
        assert all((a[0] == b[0]) == (b[1] == c[1]) for a, b, c in zip(ring, ring[1:-1], ring[2:]))
        got.setdefault((r.img, r.region), []).append((r.cells, ring))
    assert set(got) == set(want)
    for key, found in got.items():
        assert sum(n for n, _ in found) == len(want[key]) and sum(n > 0 for n, _ in found) == 1
        assert set(map(tuple, np.argwhere(filled([r for _, r in found], grids[key[0]].shape)))) == want[key]
    assert sorted(n for n, _ in got[0, 0]) == [-1, -1, 16]


def test_outlines_do_not_depend_on_tiles(spark):
    grids = [np.random.default_rng(9).random((20, 20)) < 0.65]
    labelled = regions.label_regions(cells_of(spark, grids)).cache()
    one, other = (sorted(map(str, outlines.outlines(labelled, tile=t).collect())) for t in (4, 100))
    assert one == other and outlines.outlines(labelled.where("false")).count() == 0


def test_features_carry_outlines(spark, tmp_path):
    labelled = regions.label_regions(cells_of(spark, [np.array([[1, 1, 1], [1, 0, 1], [1, 1, 1]])]))
    alerts = outlines.polygons(outlines.outlines(labelled), left=400_000.0, top=9_150_000.0).withColumns({"confidence": F.lit(2), "day": F.lit("2020-05-01").cast("date")})
    feature = json.loads(store.as_features(alerts, ["confidence", "day"]).first().value)
    outer, hole = feature["geometry"]["coordinates"]
    assert feature["properties"] == {"confidence": 2, "day": "2020-05-01"} and len(outer) == len(hole) == 5 and outer[0] == outer[-1]
    area = lambda r: sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:])) / 2
    assert area(outer) > 0 > area(hole)
    lon, lat = INVERSE(np.float64(400_000), np.float64(9_150_000))
    assert [round(float(lon), 6), round(float(lat), 6)] in outer
    both = alerts.unionByName(alerts.withColumn("day", F.lit("2020-05-02").cast("date")))
    store.save_features(both, str(tmp_path / "f"), ["confidence"], "day")
    store.save_features(alerts.withColumn("confidence", F.lit(3)), str(tmp_path / "f"), ["confidence"], "day")
    kept = spark.read.text(str(tmp_path / "f")).collect()
    assert sorted((str(r.day), json.loads(r.value)["properties"]["confidence"]) for r in kept) == [("2020-05-01", 3), ("2020-05-02", 2)]


def shape_rows(spark, rows):
    cells = [(d, i, r, c) for d, i, g in rows for r, c in g]
    return spark.createDataFrame(cells, "date int, id int, row int, col int")


ELL = [(r, 0) for r in range(6)] + [(5, c) for c in range(6)]
TURNED = [(r, 5) for r in range(5)] + [(0, c) for c in range(2, 6)]


def test_interleaved_shapes_do_not_match(spark):
    rows = [(1, 1, ELL), (2, 2, TURNED), (2, 3, ELL[3:] + ELL[3:])]
    r = shapes.runs(shape_rows(spark, rows), ["date", "id"], 4)
    assert [tuple(x)[1:] for x in shapes.with_previous(r).collect()] == [(2, 3, 1, 8, 8)]
    assert {(x.date, x.id) for x in shapes.strict_shapes(r).collect()} == {(2, 3)}
    assert all(x.c0 // 4 == x.c1 // 4 == x.block for x in r.collect())


def test_stretches_overlap():
    rng = np.random.default_rng(6)
    for _ in range(200):
        sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40))) for _ in range(2)]
        cut = [[g for g in np.split(s, np.flatnonzero(np.diff(s) > 1) + 1)] for s in sets]
        a, b = (np.array([[g[0] for g in c], [g[-1] + 1 for g in c]]) for c in cut)
        assert persistence.stretch_overlap(a, b) == len(np.intersect1d(*sets))


def test_tracks_of_shapes(spark):
    """Interleaved shapes are two tracks though their boxes meet; a track takes the shape of its largest alert."""
    day = lambda k: F.date_add(F.lit("2024-01-01").cast("date"), k)
    rows = [(0, 1, ELL), (10, 2, TURNED), (10, 3, ELL[2:]), (20, 4, TURNED + [(1, 4)]), (20, 5, ELL[:2]), (300, 6, TURNED)]
    s = shapes.runs(shape_rows(spark, rows), ["date", "id"], 4).withColumn("date", day(F.col("date")))
    for dates in (8, 1):
        labelled, tracks = persistence.fold_tracks(shapes.stretches(s), dates, 1)
        got = {r.id: (r.persistence_count, r.first_seen.isoformat()) for r in labelled.collect()}
        assert got == {1: (1, "2024-01-01"), 2: (1, "2024-01-11"), 3: (2, "2024-01-01"), 4: (2, "2024-01-11"), 5: (1, "2024-01-21"), 6: (1, "2024-10-27")}
        assert [r.n_sightings for r in tracks.collect()] == [1]


def test_overlaps_of_random_shapes(spark):
    rng = np.random.default_rng(1)
    rows = [(d, 10 * d + k, list(map(tuple, (np.argwhere(rng.random((6, 40)) < 0.4) + [0, int(rng.integers(20))]).tolist()))) for d in range(4) for k in range(3)]
    r = shapes.runs(shape_rows(spark, rows), ["date", "id"], 16).cache()
    sets = {(d, i): set(map(tuple, c)) for d, i, c in rows}
    assert {(x.date, x.id): x.size for x in shapes.sizes(r, ["date", "id"]).collect()} == {k: len(s) for k, s in sets.items()}
    want = {(d, i, j): (len(s & t), len(s)) for (d, i), s in sets.items() for (e, j), t in sets.items() if e == d - 1 and len(s & t) >= 0.3 * len(s)}
    assert {(x.date, x.a_id, x.b_id): (x.overlap, x.size) for x in shapes.with_previous(r, 0.3).collect()} == want
    for back in (1, 2):
        union = {d: set().union(*(t for (e, _), t in sets.items() if e == d - back)) for d in range(4)}
        share = {(x.date, x.id): x.share for x in shapes.union_share(r, back).collect()}
        assert share == pytest.approx({(d, i): len(s & union[d]) / len(s) for (d, i), s in sets.items()})


def brute_inside(rings, grid):
    r, c = np.indices((grid.height, grid.width))
    x, y = grid.left + (c + 0.5) * grid.res, grid.top - (r + 0.5) * grid.res
    odd, touched, h = np.zeros(r.shape, bool), np.zeros(r.shape, bool), grid.res / 2
    for ring in rings:
        for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1]):
            if y0 != y1:
                odd ^= ((y < y0) != (y < y1)) & (x < (x1 - x0) * (y - y0) / (y1 - y0) + x0)
            near = (x + h >= min(x0, x1)) & (x - h <= max(x0, x1)) & (y + h >= min(y0, y1)) & (y - h <= max(y0, y1))
            if (x0, y0) != (x1, y1):
                touched |= near & (np.abs((x - x0) * (y1 - y0) - (y - y0) * (x1 - x0)) <= h * (abs(x1 - x0) + abs(y1 - y0)))
    return odd, odd | touched


def ring_table(spark, rings):
    return spark.createDataFrame([([{"x": float(x), "y": float(y)} for x, y in r],) for r in rings], "ring array<struct<x:double,y:double>>")


def covered(runs, grid):
    out = np.zeros((grid.height, grid.width), int)
    for x in runs.collect():
        out[x.row, x.c0 : x.c1 + 1] += 1
    return out


RINGS = {
    "square on cells": [[(20, 20), (60, 20), (60, 60), (20, 60)]],
    "hole and part": [[(5, 5), (95, 8), (90, 93), (9, 88)], [(30, 30), (60, 33), (50, 62)], [(200, 11), (240, 60), (180, 55)]],
    "closed, with repeats": [[(33, 12), (33, 12), (71, 77), (12, 60), (33, 12)]],
    "over the edges": [[(-50, -50), (400, 40), (300, 900)]],
    "thin": [[(3, 3), (290, 97), (3, 4)], [(10, 90), (10, 90.0)]],
}


@pytest.mark.parametrize("name", list(RINGS))
def test_scanlines(spark, monkeypatch, name):
    monkeypatch.setattr(areas, "BLOCK", 8)
    grid, rings = Grid(0.0, 100.0, 10.0, 30, 10), RINGS[name]
    edges = areas.ring_edges(ring_table(spark, rings), [])
    odd, touched = brute_inside(rings, grid)
    got = covered(areas.area_runs(edges, [], grid, all_touched=False), grid)
    assert (got == odd).all()
    assert (covered(areas.area_runs(edges, [], grid), grid) == touched).all()


def test_ten_thousand_corners(spark):
    turn = np.linspace(0, 2 * np.pi, 10_000, endpoint=False)
    rng = np.random.default_rng(2)
    ring = lambda r: list(zip((500 + r * np.cos(turn)).tolist(), (500 + r * np.sin(turn)).tolist(), strict=True))
    rings, grid = [ring(400 + 30 * rng.random(10_000)), ring(150 + 20 * rng.random(10_000))], Grid(0.0, 1000.0, 10.0, 100, 100)
    edges = areas.ring_edges(ring_table(spark, rings), [])
    runs = areas.area_runs(edges, [], grid)
    odd, touched = brute_inside(rings, grid)
    assert (covered(runs, grid) == touched).all()
    assert len(runs._jdf.queryExecution().optimizedPlan().toString()) < 60_000
    cells = spark.createDataFrame([(int(r), int(c), k) for k, (r, c) in enumerate(np.ndindex(100, 100))], "row int, col int, block int")
    assert {x.block for x in areas.clip_to(cells, areas.area_runs(edges, [], grid, all_touched=False)).collect()} == set(np.flatnonzero(odd).tolist())


@pytest.mark.parametrize("tile", [5, 1024])
def test_warp_there_and_back(spark, tile):
    utm = Grid(400_000.0, 9_150_000.0, 20.0, 24, 18)
    lon, lat = INVERSE(np.array([utm.left, utm.left + 480]), np.array([utm.top, utm.top - 360]))
    deg = Grid(float(lon.min()) - 1e-4, float(lat.max()) + 1e-4, 6e-5, 90, 70)
    v = np.add.outer(3.0 * np.arange(18), 2.0 * np.arange(24))
    v[4, 5] = np.nan
    rows = spark.createDataFrame([("a", int(r), int(c), float(v[r, c])) for r, c in np.ndindex(v.shape)], "name string, row int, col int, v double")
    fine = warp(rows, utm, deg, ["name"], FORWARD, INVERSE, tile=tile).collect()
    r, c = np.indices((deg.height, deg.width))
    x, y = FORWARD(deg.left + (c + 0.5) * deg.res, deg.top - (r + 0.5) * deg.res)
    fr, fc = (utm.top - y) / 20 - 0.5, (x - utm.left) / 20 - 0.5
    seen = {(p.row, p.col): p.v for p in fine}
    assert len(seen) == len(fine)
    plain = (fr > 0) & (fr < 17) & (fc > 0) & (fc < 23) & ~((abs(fr - 4) < 1) & (abs(fc - 5) < 1))
    assert all(seen[i] == pytest.approx(3 * fr[i] + 2 * fc[i]) for i in zip(*(k.tolist() for k in np.nonzero(plain)), strict=True))
    out = (fr < -1) | (fr > 18) | (fc < -1) | (fc > 24)
    assert not any(out[i] for i in seen)
    # nearest, to fine degrees and back, returns each cell's own value
    near = warp(rows, utm, deg, ["name"], FORWARD, INVERSE, nearest=True, tile=tile)
    back = warp(near, deg, utm, ["name"], INVERSE, FORWARD, nearest=True, tile=tile).collect()
    assert {(p.row, p.col): p.v for p in back} == {i: v[i] for i in np.ndindex(v.shape) if not np.isnan(v[i])}
    assert warp(rows.where("false"), utm, deg, ["name"], FORWARD, INVERSE).count() == 0


def test_zones_on_another_grid(spark):
    """An alert of two cells of 20 m: classes of 10 m cells on the same corner, and of a raster that it doesn't meet."""
    labelled = regions.label_regions(cells_of(spark, [np.array([[1, 1, 0], [0, 0, 0]]), np.array([[0, 0, 0], [0, 0, 1]])]))
    alerts = outlines.polygons(outlines.outlines(labelled))
    codes = spark.createDataFrame([(r, c, 3 if c < 2 else 15) for r in range(2) for c in range(4)], "row int, col int, code int")
    grid = Grid(0.0, 0.0, 10.0, 4, 2)
    got = {(r.img): (r.lc_class_10m, r.lc_group_10m, r.lc_natural_frac_10m) for r in areas.annotate_polygons(alerts, ["img", "region"], {"10m": (codes, grid)}, all_touched=False).collect()}
    assert got == {0: (3, "natural", 0.5), 1: (None, None, None)}


def distance(p, ring):
    """Of a point from a closed ring."""
    best = np.inf
    for a, b in zip(ring, ring[1:]):
        line = b - a
        t = np.clip((p - a) @ line / max(line @ line, 1e-12), 0, 1)
        best = min(best, np.linalg.norm(p - a - t * line))
    return best


@pytest.mark.parametrize("tolerance", [1.0, 12.0, 45.0, 1e6])
def test_simple_rings_stay_near(tolerance):
    rng = np.random.default_rng(int(tolerance))
    for n in (4, 5, 9, 60, 300):
        turn = np.sort(rng.random(n)) * 2 * np.pi
        p = np.stack([np.cos(turn), np.sin(turn)], 1) * (200 + 60 * rng.random((n, 1)))
        ring = np.concatenate([p, p[:1]])
        got = outlines.simple_ring(ring, tolerance)
        assert (got[0] == got[-1]).all() and len({tuple(q) for q in got.tolist()}) >= 3
        at = {tuple(q) for q in ring.tolist()}
        assert all(tuple(q) in at for q in got.tolist()) and len(got) <= len(ring)
        if tolerance < 1e6:
            assert max(distance(q, got) for q in p) <= tolerance + 1e-9
    square = np.array([(0, 0), (0, 10), (0, 20), (20, 20), (20, 0), (0, 0)], float)
    assert len(outlines.simple_ring(square, 5.0)) == 5


def test_simplified_outlines_of_the_table(spark):
    from greensward.plans import shapes as plans

    whole = outlines.polygons(plans._rings(spark, "/root/testdata/sf0.001"))
    simple = {(r.img, r.region): r.rings for r in outlines.simplify(whole).collect()}
    fewer = 0
    for r in whole.collect():
        done = simple[r.img, r.region]
        assert len(done) == len(r.rings)
        for a, b in zip(r.rings, done):
            a, b = (np.array([(p.x, p.y) for p in ring]) for ring in (a, b))
            assert (b[0] == b[-1]).all() and len(b) >= 4
            assert max(distance(p, b) for p in a) <= 12.0 + 1e-9
            fewer += len(a) - len(b)
    # steps of a cell of 20 m go 14.1 m off the diagonal, so few outlines lose corners at 12 m; at 15 m many do
    more = sum(len(a) for r in outlines.simplify(whole, 15.0).collect() for a in r.rings)
    assert fewer >= 0 and more < sum(len(a) for r in simple.values() for a in r)


def test_samples_do_not_depend_on_partitions(spark):
    from greensward.operators import quality

    rows = spark.range(5000).select((F.col("id") % 7).alias("g"), "id").where("g < 6 or id < 30")
    key = F.struct(F.xxhash64("id", F.lit(3)), "id")
    want = None
    for parts in (1, 5, 23):
        got = sorted(map(tuple, quality.bounded_sample(rows.repartition(parts), ["g"], key, 40).collect()))
        want = want or got
        assert got == want and sorted(sum(g == k for g, _ in got) for k in range(7)) == [4, *[40] * 6]
    plan = quality.bounded_sample(rows, ["g"], key, 40)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # before the shuffle and behind it


def test_tiles_of_extents(spark):
    from greensward.operators import spatial

    e = spark.createDataFrame([("a", -40.90, -7.85, -38.95, -6.95), ("b", 1.0, 0.0, 0.0, 1.0), ("c", None, 0.0, 1.0, 1.0), ("d", 0.0, 0.0, 0.1, 0.1)], "name string, west double, south double, east double, north double")
    got = {r.name: r["count"] for r in spatial.tile_grids(e, ["name"]).groupBy("name").count().collect()}
    assert got == {"a": 55, "d": 1}


def test_tiles_to_the_last_place(spark, tmp_path):
    """Sides between two sixth places, against the SQL's own values; columns beyond the SQL's 3,000 stay."""
    import duckdb

    from greensward.operators import spatial
    from greensward.plans import catalog

    rng = np.random.default_rng(6)
    rows = [(k, k % 100, cents / 100) for k, cents in enumerate(rng.integers(-99_999, 999_999, 400).tolist())]
    schema, names = "c_custkey long, c_nationkey int, c_acctbal double", ["area", "tile_row", "tile_col", "west", "south", "east", "north"]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/few/customer.parquet")
    con = duckdb.connect()
    con.execute(f"create view customer as select * from '{tmp_path}/few/customer.parquet/*.parquet'")
    want = sorted(con.execute(f"select {', '.join(names)} from ({catalog.SQL['tile_grid']})").fetchall())
    assert sorted(map(tuple, catalog.QUERIES["tile_grid"](spark, f"{tmp_path}/few").select(names).collect())) == want and len(want) > 100

    spark.createDataFrame([(0, 1, 0.0), (899_999, 1, 0.0)], schema).coalesce(1).write.parquet(f"{tmp_path}/wide/customer.parquet")
    wide = catalog.QUERIES["tile_grid"](spark, f"{tmp_path}/wide").where("tile_row = 0").orderBy("tile_col").collect()
    assert [r.tile_col for r in wide] == list(range(len(wide))) and len(wide) > 14_000 and wide[-1].east == 2659.297

    e = spark.createDataFrame([("a", -40.9, -7.85, 200.0, -6.95)], "name string, west double, south double, east double, north double")
    line = spatial.tile_grids(e, ["name"]).where("tile_row = 0").orderBy("tile_col").collect()
    assert all(a.east == b.west for a, b in zip(line, line[1:])) and len(line) > 1000


def test_images_warped_together(spark, monkeypatch):
    """Small tiles go through a task many images at a time, with the values of each on its own."""
    from greensward.operators import batches, warp as module
    from greensward.operators.grid import Grid

    rng = np.random.default_rng(2)
    rows = [(k, r, c, None if rng.random() < 0.2 else float(rng.normal())) for k in range(40) for r in range(k % 3, 9) for c in range(k % 2, 11)]
    raster = spark.createDataFrame(rows, "img long, row int, col int, v double")
    source, target, turn = Grid(0.0, 90.0, 10.0, 11, 9), Grid(-20.0, 110.0, 7.0, 20, 20), lambda x, y: (0.9 * x - 0.2 * y, 0.2 * x + 0.9 * y)
    back = lambda x, y: ((0.9 * x + 0.2 * y) / 0.85, (0.9 * y - 0.2 * x) / 0.85)
    run = lambda nearest, tile: sorted(module.warp(raster, source, target, ["img"], back, turn, nearest=nearest, tile=tile).collect())
    plan = module.warp(raster, source, target, ["img"], back, turn, tile=4)._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroupsInArrow" not in plan
    together = {(n, t): run(n, t) for n in (False, True) for t in (4, 32)}
    monkeypatch.setattr(module, "SMALL", 0)
    monkeypatch.setattr(batches, "ROWS", 50)
    for (nearest, tile), want in together.items():
        got = run(nearest, tile)
        assert len(got) == len(want) > 2_000 and [r[:3] for r in got] == [r[:3] for r in want] and np.allclose([r.v for r in got], [r.v for r in want], atol=1e-12)


def test_small_tiles_traced_together(spark):
    """Regions and rings of many small tiles are those of one tile for each image, and no task is called for each."""
    rng = np.random.default_rng(4)
    cells = spark.createDataFrame([(k, r, c) for k in range(60) for r in range(9) for c in range(11) if rng.random() < 0.6], "img long, row int, col int")
    one, many = (regions.label_regions(cells, tile=t) for t in (64, 3))
    assert sorted(one.collect()) == sorted(many.collect())
    want, got = (outlines.outlines(one, tile=t) for t in (64, 3))
    rings = sorted(got.collect())
    assert rings == sorted(want.collect()) and min(r.cells for r in rings) < 0
    assert sum(r.cells for r in rings) == cells.count() and all(r.ring[0] == r.ring[-1] == min(r.ring) for r in rings)
    assert "FlatMapGroupsInArrow" not in "".join(d._jdf.queryExecution().optimizedPlan().toString() for d in (many, got))
    assert list(outlines.closed_rings(np.array([0, 1, 2, 42, 40, 20]), np.array([0]), 10)[0]) == [0, 2, 42, 40, 0]


def test_polygons_as_runs(spark, monkeypatch):
    """Many polygons with holes and parts on two grids at a time give the cells of plain scanlines, in runs that don't meet; few rows of edges in work at a time."""
    monkeypatch.setattr(areas, "STRIP", 40)
    grids = [Grid(0.0, 100.0, 10.0, 30, 10), Grid(-20.0, 130.0, 7.0, 40, 25)]
    names = list(RINGS) * 3
    polygons = [[[{"x": float(x), "y": float(y)} for x, y in ring] for ring in RINGS[n]] for n in names] + [None, []]
    alerts = spark.createDataFrame(list(enumerate(polygons)), "id long, rings array<array<struct<x:double,y:double>>>").coalesce(1)
    for touched in (False, True):
        rows = areas.polygon_runs(alerts, ["id"], grids, lambda x, y: (x, y), touched).collect()
        assert sorted(r.id for r in rows if r.grid is None) == list(range(len(polygons)))
        for g, grid in enumerate(grids):
            for k, n in enumerate(names):
                want, mine = brute_inside(RINGS[n], grid)[touched], [r for r in rows if (r.id, r.grid) == (k, g)]
                got = np.zeros(want.shape, int)
                for r in mine:
                    assert r.c0 // areas.NARROW == r.c1 // areas.NARROW == r.block
                    got[r.row, r.c0 : r.c1 + 1] += 1
                assert (got == want).all()


def test_zones_of_many_polygons(spark):
    """Land cover of polygons on one place: cells with repeated, missing and absent classes; rows are neither sorted for a maximum nor tried against a raster's whole line."""
    square = lambda x, y: [[{"x": x + a, "y": y - b} for a, b in ((0.0, 0.0), (0.0, 20.0), (30.0, 20.0), (30.0, 0.0))]]
    alerts = spark.createDataFrame([(k, square(10.0 * (k % 5), -10.0)) for k in range(200)] + [(200, square(50_000.0, 0.0))], "id long, rings array<array<struct<x:double,y:double>>>")
    code = {(r, c): (None, 0, 3, 15, 15, 3, 24)[(r + 2 * c) % 7] for r in range(4) for c in range(3000) if c != 5}
    codes = spark.createDataFrame([(r, c, v) for (r, c), v in code.items()], "row int, col int, code int")
    zones = areas.annotate_polygons(alerts, ["id"], {"10m": (codes, Grid(0.0, 0.0, 10.0, 3000, 4))}, all_touched=False)
    for r in zones.collect():
        seen = [code[k] for k in ((i, r.id % 5 + j) for i in (1, 2) for j in range(3)) if code.get(k)] if r.id < 200 else []
        best = min(set(seen), key=lambda v: (-seen.count(v), v)) if seen else None
        assert (r.lc_class_10m, r.lc_natural_frac_10m) == (best, round(seen.count(3) / len(seen), 3) if seen else None)
        assert r.lc_group_10m == {None: None, 3: "natural", 15: "farming", 24: "urban"}[best]
    assert zones.count() == 201
    assert "SortAggregate" not in zones._jdf.queryExecution().toString()


def test_degrees_of_rings(spark):
    """Missing rings and points stay missing, and corners are no expressions that are worked out one by one."""
    ring = [{"x": 400_000.0 + 20 * k, "y": 9_150_000.0 - 20 * k} for k in range(3)]
    rows = [(0, None), (1, [ring, None, []]), (2, []), (3, [[ring[2], None, {"x": None, "y": 1.0}]])]
    degrees = store.degree_rings(spark.createDataFrame(rows, "id long, rings array<array<struct<x:double,y:double>>>").coalesce(1))
    got = {r.id: r.rings for r in degrees.where("id <> 2").collect()}
    want = [[round(float(v), 6) for v in INVERSE(np.float64(p["x"]), np.float64(p["y"]))] for p in ring]
    assert got == {0: None, 1: [want, None, []], 3: [[want[2], [None, None], [None, None]]]}
    assert "lambda" not in degrees._jdf.queryExecution().optimizedPlan().toString()


def test_nearest_needs_no_borders(spark, monkeypatch):
    """With ``nearest`` a cell goes to its own tile alone, images before tiles; values of many images are those of each one."""
    grid, fine = Grid(0.0, 160.0, 20.0, 8, 8), Grid(-15.0, 175.0, 10.0, 19, 19)
    v = np.random.default_rng(4).random((40, 8, 8))
    rows = spark.createDataFrame([(k, r, c, float(v[k, r, c])) for k, r, c in np.ndindex(v.shape)], "img long, row int, col int, v double")
    seen = []
    monkeypatch.setattr(warps, "in_groups", lambda dealt, keys, *more: seen.append((dealt.count(), keys)) or in_groups(dealt, keys, *more))
    got = warp(rows, grid, fine, ["img"], lambda x, y: (x, y), lambda x, y: (x, y), nearest=True, tile=4).collect()
    r, c = np.indices((19, 19))
    sr, sc = np.floor((160 - (175 - (r + 0.5) * 10)) / 20).astype(int), np.floor((-15 + (c + 0.5) * 10) / 20).astype(int)
    inside = (sr >= 0) & (sr < 8) & (sc >= 0) & (sc < 8)
    assert {(g.img, g.row, g.col): g.v for g in got} == {(k, i, j): v[k, sr[i, j], sc[i, j]] for k in range(40) for i, j in zip(*(a.tolist() for a in np.nonzero(inside)))}
    assert seen == [(40 * 64, ["img", "_tr", "_tc"])]


def test_joined_nearby(spark):
    """Paths of cells of many images: in one square each is a star around its smallest cell; squares that cut them leave their components."""
    rng = np.random.default_rng(5)
    paths = [(f"i{i}", [k // 7 + 20 * (k % 7 + 8 * half) for k in rng.permutation(30).tolist()]) for i in range(40) for half in range(2)]
    edges = spark.createDataFrame([(i, a, b) for i, p in paths for a, b in zip(p, p[1:])] * 2, "img string, src long, dst long")
    want = {(i, c): min(p) for i, p in paths for c in p}
    stars = joined_nearby(edges, 20, 1024).collect()
    assert len(stars) == 40 * 2 * 29
    assert all(r.src.img == r.dst.img and r.dst.cell == want[tuple(r.src)] for r in stars)
    for side in (3, 1024):
        found = connected_components(joined_nearby(edges, 20, side)).collect()
        assert {tuple(r.id): r.component.cell for r in found} == want
