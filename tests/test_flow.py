"""Sources, stores, grids and whole runs of the vegetation engine."""

import datetime
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from greensward import config
from greensward.functions.detection import legend_label
from greensward.functions.indices import clear_scl, index_column
from greensward.operators import composites, grid, quality, regions
from greensward.plans import detect as runs
from greensward.sources import alerts, baselines, scenes, sensors

D = datetime.date


def test_aoi_of_many_rings(spark, tmp_path):
    ring = lambda x, y: [[x, y], [x + 1, y], [x + 1, y + 1], [x, y]]
    shapes = [{"type": "Polygon", "coordinates": [ring(-40, -8), ring(-39.8, -7.9)]}, {"type": "MultiPolygon", "coordinates": [[ring(-38, -7)], [ring(-37, -9)]]}]
    p = tmp_path / "a.geojson"
    p.write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": s} for s in shapes]}))
    rings = scenes.read_aoi(spark, str(p))
    assert rings.count() == 4 and tuple(scenes.total_bounds(rings).first()) == (-40, -9, -36, -6)


def alert_rows(spark, rows):
    return spark.createDataFrame([(i, D.fromisoformat(d), 400_000.0, 9_150_000.0, 400_020.0, 9_150_040.0, c, 1.0) for i, d, c in rows], "id long, detection_date date, x0 double, y0 double, x1 double, y1 double, confidence int, area_ha double")


def test_alert_store(spark, tmp_path):
    path = str(tmp_path / "alerts")
    assert alerts.load_alerts(spark, path).count() == 0
    with pytest.raises(FileNotFoundError):
        alerts.load_alerts(spark, path, "2024-05-01")
    alerts.save_alerts(alert_rows(spark, [(1, "2024-05-01", 1), (2, "2024-05-09", 3)]), path)
    alerts.save_alerts(alert_rows(spark, [(7, "2024-05-09", 9)]), path)
    assert [(r.id, r.confidence_label) for r in alerts.load_alerts(spark, path).collect()] == [(1, "low"), (7, "unknown")]
    assert [r.id for r in alerts.load_alerts(spark, path, "2024-05-09").collect()] == [7]
    with pytest.raises(FileNotFoundError):
        alerts.load_alerts(spark, path, "2024-05-02")
    f = json.loads(alerts.as_features(alert_rows(spark, [(1, "2024-05-01", 1)]), ["id", "detection_date"]).first().value)
    (west, south), (east, _), (_, north) = f["geometry"]["coordinates"][0][:3]
    assert f["properties"] == {"id": 1, "detection_date": "2024-05-01"}
    assert -39.91 < west < east < -39.90 and -7.70 < south < north < -7.68 and round(west, 6) == west
    tile = alert_rows(spark, [(1, "2024-05-01", 1)])
    assert alerts.merge_tiles([tile, tile, tile.withColumn("more", F.lit(1))]).count() == 3


def test_baseline_store(spark, tmp_path):
    path = str(tmp_path / "base")
    obs = spark.createDataFrame([(p, D(y, m, 3), 0.1 * p + 0.01 * y - 20, 0.5) for p in (1, 2) for y in (2020, 2021) for m in (3, 4)], "pixel long, obs_date date, v double, w double")
    both = {"v": F.col("v"), "w": F.col("w")}
    have = runs.build_baselines(obs, both, path)
    assert {(r.index_name, r.month) for r in have.collect()} == {(n, m) for n in "vw" for m in (3, 4)}
    centre, spread = baselines.load_pair(spark, path, "v", 3)
    assert {r.pixel: round(r.value, 6) for r in centre.collect()} == {1: 0.305, 2: 0.405} and spread.first().value == pytest.approx(0.005)
    with pytest.raises(FileNotFoundError):
        baselines.load_baseline(spark, path, "v", 5)
    # only missing months are built: a changed April stays as it was, unless it is forced
    more = obs.withColumn("v", F.col("v") + 1).unionByName(obs.withColumn("obs_date", F.add_months("obs_date", 1)))
    runs.build_baselines(more, both, path)
    assert baselines.load_baseline(spark, path, "v", 4).where("pixel = 1").first().center == pytest.approx(0.305)
    assert baselines.load_baseline(spark, path, "v", 5).count() == 2
    runs.build_baselines(more, both, path, force=True)
    assert baselines.load_baseline(spark, path, "v", 4).where("pixel = 1").first().center == pytest.approx(0.805)


def test_months_with_one_date_and_chosen_years(spark):
    obs = spark.createDataFrame([(1, D(2017, 1, 2), 1.0, 10.0), (1, D(2019, 1, 2), 3.0, 10.0), (1, D(2018, 1, 2), 9.0, 10.0), (1, D(2021, 1, 5), 8.0, 40.0), (1, D(2017, 2, 2), 5.0, 10.0)], "pixel long, obs_date date, v double, cloud_cover double")
    got = composites.monthly_baseline(obs, {"v": F.col("v")}, min_dates=2, years=config.BASELINE_YEARS, max_cloud=config.BASELINE_CLOUD).collect()
    assert [(r.month, r.v_center, r.v_n) for r in got] == [(1, 2.0, 2)]


def test_loaders(spark):
    with pytest.raises(ValueError):
        sensors.asset_key("landsat", "scl")
    with pytest.raises(ValueError):
        sensors.bands_for(["ndvi"], "radar")
    assert sensors.bands_for(["ndvi", "nbr"], "landsat") == ["nir08", "red", "swir22", "qa"] and sensors.asset_key("hls", "nir") == "B8A"
    raw = spark.createDataFrame([(1, D(2020, 5, 1), 4000, 2000, 4), (2, D(2023, 5, 1), 4000, 0, 5), (3, D(2023, 5, 1), 4000, 2000, 9)], "id int, obs_date date, nir08 int, swir16 int, scl int")
    got = [(r.nir08, r.swir16) for r in sensors.load_scene(raw, "s2", ["ndmi"], ["id"]).orderBy("id").collect()]
    assert got == [(pytest.approx(0.4), pytest.approx(0.2)), (pytest.approx(0.3), None), (None, None)]
    c = spark.createDataFrame([(1, 0.5, -9999.0, 0.1)], "id int, evi2 double, ndmi double, nbr double")
    assert tuple(sensors.load_composite(c, ["id"]).first()) == (1, 0.5, None, 0.1, None)
    with pytest.raises(ValueError):
        sensors.load_composite(c.drop("nbr"), ["id"])
    old = spark.createDataFrame([("a", 0, 0, 900.0), ("a", 600, 0, 3.0), ("b", 0, 0, 0.2), ("b", 600, 600, 900.0), ("c", 0, 0, None)], "scene string, row int, col int, dn double")
    assert sorted((r.scene, r.dn or 0) for r in sensors.shift_dn(old, "scene", "dn").collect()) == [("a", 1003.0), ("a", 1900.0), ("b", 0.2), ("b", 900.0), ("c", 0)]


def test_scene_cache(spark, tmp_path):
    cache, built = sensors.SceneCache(spark, str(tmp_path / "c")), []
    rows = spark.createDataFrame([(4,), (9,), (None,), (4,)], "scl int")
    get = lambda least: cache.get("s1", lambda: built.append(1) or rows, clear_scl(F.col("scl")), least)
    assert get(50.0).count() == 4 and get(51.0) is None and built == [1]


def test_search_range_and_precipitation(spark):
    sc = spark.createDataFrame([("a", 5.0, 0, 0, 10, 10), ("b", 5.0, 20, 0, 30, 10)], "scene_id string, cloud_cover double, west int, south int, east int, north int").withColumn("date", F.lit("2024-02-01").cast("date"))
    assert [r.scene_id for r in scenes.search(sc, "2024-01-01", "2024-03-01", bbox=(10, 5, 19, 6)).collect()] == ["a"]
    day = lambda s: F.lit(s).cast("date")
    rng = lambda a, b: spark.range(1).select(scenes.datetime_range(day(a), day(b), day("2024-03-20"))).first()[0]
    assert rng("2024-01-01", "2024-01-05") == "2024-01-01/2024-01-05" and rng("2024-01-01", None) == rng(None, None) == "2024-03-04/2024-03-20"
    rain = spark.createDataFrame([(1, 0.5, 0.5, 10.0), (1, 0.7, 0.5, -9999.0), (1, 5.0, 0.5, 90.0), (2, 0.5, 0.5, -1.0)], "m int, lon double, lat double, v double")
    assert {r.m: r.mm for r in scenes.precipitation_mean(rain, (0, 0, 1, 1), ["m"]).collect()} == {1: 10.0, 2: None}
    names = spark.createDataFrame([("x_2024-01-09.tif",), ("notes.txt",), ("a/2023-12-01_b.tif",)], "name string")
    assert [str(r.date) for r in scenes.discover(names).collect()] == ["2023-12-01", "2024-01-09"]


def test_legend_and_sheet(spark):
    df = spark.createDataFrame([(4,), (99,)], "c int").select(legend_label(F.col("c")))
    assert [r[0] for r in df.collect()] == ["Savanna formation", "class 99"]
    r = quality.sample_sheet(alert_rows(spark, [(5, "2024-05-01", 1), (3, "2024-05-09", 2)]), F.col("id")).collect()
    assert [(x.sample_id, x.detection_date, x.lc_group, x.verdict) for x in r] == [(0, "2024-05-09", "", ""), (1, "2024-05-01", "", "")] and round(r[0].centroid_lat, 2) == -7.69


def test_collections_that_are_missing(spark):
    z = spark.createDataFrame([(1, 39), (1, 39), (1, 4), (2, 0)], "zone int, code int")
    r = {x.zone: x for x in regions.annotate_all(z, ["zone"], {"30m": "code", "7m": "code", "10m": "gone"}).collect()}
    assert set(r[1].asDict()) == {"zone", "lc_class_30m", "lc_group_30m", "lc_natural_frac_30m"} and r[1].lc_group_30m == "farming" and r[2].lc_class_30m is None
    both = regions.annotate_all(z, ["zone"], {"10m": "code", "30m": "code"})
    assert {x.zone: x.lc_group for x in both.collect()}[1] == "other"
    assert [x.zone for x in regions.natural_filter(both, 0.3).collect()] == [1]


def test_verdict_of_means(spark):
    p = spark.createDataFrame([("a", 0.03, 0.0, 0.0, 1.0, 0.0), ("a", 0.0, 0.0, 0.0, 1.0, 0.0), ("b", 0.012, 0.0, 0.0, 1.0, 0.5), ("b", 0.0, 0.0, 0.0, None, 0.0)], "band string, out_of_range double, high double, low double, kurtosis double, nodata double")
    assert {r.band: (r.overall, r.issues, r.warnings) for r in quality.verdict(p, ["band"]).collect()} == {"a": ("FAIL", "out_of_range", ""), "b": ("PASS", "", "out_of_range,nodata")}


def test_grid_and_crop():
    g = grid.Grid.over(3.0, -17.0, 61.0, 40.0, 20.0)
    assert (g.left, g.top, g.width, g.height) == (0.0, 40.0, 4, 3)
    assert grid.crop_window((-1.0, 0.2, 0.5, 0.8), 0.0, 1.0, 0.1, 20, 10) == (2, 0, 6, 5)
    with pytest.raises(ValueError):
        grid.crop_window((5, 0, 6, 1), 0.0, 1.0, 0.1, 20, 10)


def test_reprojection_matches_plain_loops(spark):
    rng = np.random.default_rng(4)
    src, dst = grid.Grid(0.0, 60.0, 10.0, 7, 6), grid.Grid(-6.0, 63.0, 7.0, 12, 11)
    v = rng.normal(size=(6, 7))
    v[rng.random(v.shape) < 0.2] = np.nan
    df = spark.createDataFrame([(r, c, None if np.isnan(v[r, c]) else float(v[r, c])) for r in range(6) for c in range(7)], "row int, col int, v double").withColumn("img", F.lit(1))
    near, linear = {}, {}
    for r in range(11):
        for c in range(12):
            x, y = -6 + (c + 0.5) * 7, 63 - (r + 0.5) * 7
            i, j = int((60 - y) // 10), int(x // 10)
            if 0 <= i < 6 and 0 <= j < 7 and not np.isnan(v[i, j]):
                near[r, c] = v[i, j]
            w = np.maximum(0, 1 - np.abs(x - (np.arange(7) + 0.5) * 10) / 10) * np.maximum(0, 1 - np.abs(y - (60 - (np.arange(6) + 0.5) * 10)) / 10)[:, None]
            w = np.where(np.isnan(v), 0, w)
            if w.sum() > 1e-12:
                linear[r, c] = float((w * np.nan_to_num(v)).sum() / w.sum())
    for want, nearest in ((near, True), (linear, False)):
        got = {(r.row, r.col): r.v for r in grid.reproject(df, src, dst, ["img"], nearest=nearest).collect()}
        assert got.keys() == want.keys() and got == pytest.approx(want)


def test_touched_cells(spark):
    ring = [(2.3, 2.2), (8.15, 3.4), (4.6, 9.1)]
    cells = spark.createDataFrame([(x + 0.5, y + 0.5) for x in range(11) for y in range(11)], "x double, y double")
    some = lambda touched: {(r.x, r.y) for r in grid.clip(cells, F.col("x"), F.col("y"), 1.0, ring, touched).collect()}
    fine = np.stack(np.meshgrid(np.arange(0, 11, 0.02) + 0.01, np.arange(0, 11, 0.02) + 0.01), -1).reshape(-1, 2)
    cross = lambda a, b: (b[0] - a[0]) * (fine[:, 1] - a[1]) - (b[1] - a[1]) * (fine[:, 0] - a[0]) > 0
    inside = fine[cross(ring[0], ring[1]) & cross(ring[1], ring[2]) & cross(ring[2], ring[0])]
    sampled = {(x + 0.5, y + 0.5) for x, y in np.floor(inside).astype(int).tolist()}
    assert some(False) < some(True) and sampled <= some(True) and len(some(True) - sampled) <= 3


def test_detection_to_tracks(spark, tmp_path):
    """A block of 6 x 6 cells is cleared on two dates; one scene is cloudy, one is all alert."""
    good, bad = dict(nir=0.5, red=0.05, blue=0.04, nir08=0.5, swir16=0.15, swir22=0.08), dict(nir=0.2, red=0.15, blue=0.08, nir08=0.2, swir16=0.35, swir22=0.35)
    rows = []

    def scene(day, cleared, scl=4):
        for r in range(20):
            for c in range(20):
                b = bad if cleared(r, c) else good
                wobble = 0.01 * ((r * 7 + c * 3 + day.toordinal()) % 5)
                rows.append((len(rows), 100 * r + c, r, c, day, *[b[k] + wobble for k in sorted(b)], 9 if r > 17 and c > 9 else scl, 3 if r < 3 else 4))

    for year in (2019, 2020, 2021):
        scene(D(year, 3, 5), lambda r, c: False)
    block = lambda r, c: 2 <= r < 8 and 3 <= c < 9
    scene(D(2022, 3, 1), block)
    scene(D(2022, 3, 11), lambda r, c: block(r, c) or (r, c) == (15, 15))
    scene(D(2022, 3, 21), block, scl=9)
    scene(D(2022, 3, 31), lambda r, c: True)
    obs = spark.createDataFrame(rows, "obs_id long, pixel long, row int, col int, obs_date date, " + ", ".join(f"{k} double" for k in sorted(good)) + ", scl int, lc int").withColumn("scene", F.col("obs_date"))
    clear = clear_scl(F.col("scl"))
    values = runs.masked_values(("ndmi", "nbr", "evi2"), clear)
    early = obs.where(F.year("obs_date") < 2022)
    base = composites.monthly_baseline(early, values)
    found = runs.detect(obs.where(F.year("obs_date") == 2022), base, values, clear, bsi=index_column("bsi"), landcover={"10m": "lc"})
    got = {r.scene.day: r for r in found.collect()}
    assert sorted(got) == [1, 11] and all(r.n_cells >= 30 and r.confidence == 3 and r.clearing == 1 for r in got.values())
    assert (got[1].x0, got[1].y0, got[1].x1, got[1].y1) == (60.0, 40.0, 180.0, 160.0) and got[1].lc_natural_frac == 1.0
    path = str(tmp_path / "alerts")
    tracks = runs.track_and_store(found.withColumns({c: F.col(c).cast("long") for c in ("x0", "y0", "x1", "y1")}), path)
    assert [(r.n_sightings, r.first_seen, r.last_seen) for r in tracks.collect()] == [(2, D(2022, 3, 1), D(2022, 3, 11))]
    assert [r.persistence_count for r in alerts.load_alerts(spark, path).collect()] == [1, 2]
    assert [r.persistence_status for r in alerts.load_alerts(spark, path, "2022-03-11").collect()] == ["candidate"]
    assert runs.detect(obs.where("false"), base, values, clear).count() == 0
    # true shapes: outlines in metres, cells as stretches, metres that aren't whole stay so
    shaped = runs.detect(obs.where(F.year("obs_date") == 2022), base, values, clear, res=12.5, min_ha=0.3, rings=True, cells=True).cache()
    for r in shaped.collect():
        assert sum(b - a for a, b in zip(r.starts, r.ends)) == r.n_cells and [(p.x, p.y) for p in r.rings[0]][0] == (r.rings[0][-1].x, r.rings[0][-1].y)
        assert abs(sum(a.x * b.y - b.x * a.y for ring in r.rings for a, b in zip(ring, ring[1:]))) / 2 == pytest.approx(r.n_cells * 12.5**2)
    kept = runs.track_and_store(shaped, str(tmp_path / "shaped")).collect()
    assert [(r.n_sightings, r.x0, r.x1, len(r.starts)) for r in kept] == [(2, 37.5, 112.5, 6)]
