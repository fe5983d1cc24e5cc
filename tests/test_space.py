import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from greensward.operators import persistence, regions, spatial, unions
from greensward.operators.graph import connected_components
from greensward.plans.scratch import Scratch
from greensward.streaming.tracks import TrackStore, track_stream

BOX = "date date, id long, x0 long, y0 long, x1 long, y1 long"
D = datetime.date


def boxes(spark, rows):
    return spark.createDataFrame([(D.fromisoformat(d), i, *b) for d, i, b in rows], BOX)


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 1), (20, 21), (5, 5), (None, 4)] + [(100, k) for k in range(101, 160)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert {got[k] for k in (1, 2, 3, 7, 8, 9)} == {1} and got[21] == 20 and 5 not in got and got[159] == 100
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_long_path(spark):
    got = connected_components(spark.range(300).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst")))
    assert got.select("component").distinct().collect()[0][0] == 0 and got.count() == 301


def test_regions_cross_levels_and_modes(spark):
    cells = [(1, r, c) for r, c in [(0, 0), (0, 1), (1, 1), (2, 2), (3, 2), (5, 0), (5, 2), (6, 0), (6, 1), (6, 2)]]
    got = regions.label_regions(spark.createDataFrame(cells, "img int, row int, col int"), width=10)
    assert {(r.row, r.col): r.region for r in got.collect()} == {(0, 0): 0, (0, 1): 0, (1, 1): 0, (2, 2): 22, (3, 2): 22, (5, 0): 50, (5, 2): 50, (6, 0): 50, (6, 1): 50, (6, 2): 50}
    z = spark.createDataFrame([(1, 4), (1, 4), (1, 15), (1, 15), (1, 0), (2, 0)], "zone int, code int")
    assert {r.zone: r["mode"] for r in regions.zonal_mode(z, ["zone"], "code").collect()} == {1: 4, 2: 0}
    a = {r.zone: r for r in regions.annotate_landcover(z, ["zone"], "code").collect()}
    assert (a[1].lc_class, a[1].lc_group, a[1].lc_natural_frac) == (4, "natural", 0.5) and a[2].lc_class is None


def test_strict_filter_and_history(spark):
    b = boxes(spark, [("2023-05-03", 1, (0, 0, 60, 80)), ("2023-05-19", 2, (25, 30, 85, 110)), ("2023-05-19", 3, (0, 78, 60, 158))])
    assert [r.id for r in persistence.strict_filter(b).collect()] == [2]
    h = {str(r.date): r for r in persistence.history_summary(b).collect()}
    assert (h["2023-05-03"].confirmed, h["2023-05-19"].confirmed, h["2023-05-19"].raw) == (0, 1, 2)
    s = {r.id: r.persistence_count for r in persistence.streaks(b).collect()}
    assert s == {1: 1, 2: 2, 3: 1}
    prior = spark.createDataFrame([(1, 3)], "id long, persistence_count int")
    assert {r.id: r.persistence_count for r in persistence.streaks(b, prior).collect()}[2] == 4


def test_areas_of_unions(spark, monkeypatch):
    """Against a count of unit cells, with whole corners; boxes of any size are as many rows."""
    rng = np.random.default_rng(8)
    for strips in (1, 3, 256):
        monkeypatch.setattr(unions, "STRIPS", strips)
        for n in (1, 2, 7, 40):
            x, y = rng.integers(0, 60, (2, n))
            w, h = rng.integers(1, 30, (2, n))
            grid = np.zeros((90, 90), bool)
            for a, b, c, d in zip(x, y, w, h, strict=True):
                grid[a : a + c, b : b + d] = True
            assert unions.covered_area(x * 0.5, y * 1.0, (x + w) * 0.5, (y + h) * 1.0) == grid.sum() * 0.5
    rows = [(k % 5, f"g{k % 3}", *map(float, v)) for k, v in enumerate(np.concatenate([rng.integers(0, 50, (90, 2)), rng.integers(50, 99, (90, 2))], 1).tolist())]
    parts = spark.createDataFrame([*rows, (None, None, 0.0, 0.0, 2.5, 2.0), (None, None, 1.0, 0.0, 3.0, 2.0)], "k int, name string, x0 double, y0 double, x1 double, y1 double")
    got = {(r.k, r.name): r.area for r in unions.union_areas(parts, ["k", "name"]).collect()}
    for key in {(r[0], r[1]) for r in rows}:
        grid = np.zeros((100, 100), bool)
        for r in rows:
            if r[:2] == key:
                grid[int(r[2]) : int(r[4]), int(r[3]) : int(r[5])] = True
        assert got[key] == grid.sum()
    assert got[None, None] == 6.0 and len(got) == 16


def test_shares_off_the_grid(spark):
    b = spark.createDataFrame([(D(2023, 5, 3), 1, 0.25, 0.5, 4.75, 3.0), (D(2023, 5, 3), 2, 3.0, 2.0, 9.0, 8.0), (D(2023, 5, 19), 1, 1.0, 1.0, 6.0, 5.0), (D(2023, 5, 19), 2, 50.0, 50.0, 51.0, 51.0), (D(2023, 5, 19), 3, 2.0, 2.0, 2.0, 3.0)], "date date, id long, x0 double, y0 double, x1 double, y1 double")
    share = {(r.date.day, r.id): r.share for r in persistence.union_area_share(b).collect()}
    assert share == {(3, 1): 0, (3, 2): 0, (19, 1): pytest.approx((3.75 * 2 + 3 * 3 - 1.75) / 20), (19, 2): 0, (19, 3): None}
    assert [(r.date.day, r.id) for r in persistence.strict_filter(b).collect()] == [(19, 1)]


def test_tracks_grace_and_one_count_a_date(spark):
    box, far = (1_200, 700, 1_300, 800), (7_000, 700, 7_100, 800)
    b = boxes(spark, [("2022-02-10", 1, box), ("2022-02-26", 2, box), ("2022-08-20", 3, box), ("2023-03-01", 4, box), ("2023-03-01", 5, far)])
    got, tracks = persistence.fold_tracks(b)
    assert {r.id: r.persistence_count for r in got.collect()} == {1: 1, 2: 2, 3: 3, 4: 1, 5: 1}
    assert tracks.count() == 2
    two = boxes(spark, [("2022-02-10", 1, box), ("2022-02-26", 2, box), ("2022-02-26", 3, (1_250, 700, 1_300, 800))])
    got, tracks = persistence.fold_tracks(two)
    assert {r.id: r.persistence_count for r in got.collect()} == {1: 1, 2: 2, 3: 2}
    assert [r.n_sightings for r in tracks.collect()] == [2]


def test_confirmed_track_outlives_grace(spark):
    scratch = Scratch(spark, "test")
    old = spark.createDataFrame([("1", 15, D(2024, 1, 1), D(2024, 2, 1), 0, 0, 100, 100), ("2", 14, D(2024, 1, 1), D(2024, 2, 1), 500, 0, 600, 100)], persistence.TRACK)
    b = boxes(spark, [("2025-01-01", 10, (0, 0, 100, 100)), ("2025-01-01", 11, (500, 0, 600, 100))])
    got, tracks = persistence.update_tracks(b, old, D(2025, 1, 1), scratch)
    assert {r.id: r.persistence_count for r in got.collect()} == {10: 16, 11: 1}
    same, kept = persistence.update_tracks(b.where("false"), old, D(2025, 1, 1), scratch)
    assert same.count() == 0 and kept.count() == 2


def random_boxes(spark, seed, dates=16):
    rng = np.random.default_rng(seed)
    rows = [(f"{2020 + m // 12}-{1 + m % 12:02d}-05", 100 * m + k if seed else k, (x, y, x + 100, y + 100)) for m in range(dates) for k, (x, y) in enumerate(rng.integers(0, 900, (int(rng.integers(0, 9)), 2)).tolist())]
    return boxes(spark, rows)


def one_by_one(spark, b):
    """All dates by ``update_tracks``, which joins one date's alerts with all tracks."""
    scratch, tracks, out = Scratch(spark, "test"), spark.createDataFrame([], persistence.TRACK), []
    for r in b.select("date").distinct().orderBy("date").collect():
        got, tracks = persistence.update_tracks(b.where(F.col("date") == F.lit(r.date)), tracks, r.date, scratch)
        out += got.withColumn("date", F.lit(r.date)).collect()
    return out, tracks.collect()


@pytest.mark.parametrize("seed", [0, 1])
def test_tiles_and_runs_fold_like_dates(spark, seed):
    """Ids of seed 0 come again on each date, so tracks of one id must stay apart."""
    b, cols = random_boxes(spark, seed).cache(), ["date", "id", "persistence_count", "persistence_status", "first_seen", "last_seen"]
    want, left = one_by_one(spark, b)
    pick = lambda rows, names: sorted(tuple(r[c] for c in names) for r in rows)
    for dates, tile in ((8, 64), (3, 1), (1, 2), (100, 5)):
        labelled, tracks = persistence.fold_tracks(b, dates, tile)
        assert pick(labelled.collect(), cols) == pick(want, cols) and labelled.count() == b.count()
        kept = tracks.collect()
        assert pick(kept, tracks.columns) == pick(left, tracks.columns) and len({t.track_id for t in kept}) == len(kept) > 3
    assert {(r.date, r.id): r.persistence_count for r in persistence.chained_streaks(b).collect()} == date_by_date(b)


def date_by_date(b):
    """Streaks by a plain loop over dates and pairs."""
    by, count = {}, {}
    for r in b.collect():
        by.setdefault(r.date, []).append(r)
    before = []
    for day in sorted(by):
        for a in by[day]:
            over = [(min(a.x1, p.x1) - max(a.x0, p.x0), min(a.y1, p.y1) - max(a.y0, p.y0), p) for p in before]
            good = [count[p.date, p.id] for w, h, p in over if w > 0 and h > 0 and w * h >= 0.05 * (a.x1 - a.x0) * (a.y1 - a.y0)]
            count[day, a.id] = 1 + max(good, default=0)
        before = by[day]
    return count


def test_streaks_where_the_nearest_chain_ends_first(spark):
    """The smallest id of the observation before leads into a short chain, the other into the longest."""
    links = [(r, a, b) for r in range(2, 30) for a, b in [(10, 10)]] + [(30, 11, 9), (30, 11, 10), (29, 9, 8), (31, 12, 11), (31, 12, 5), (32, 1, 12)]
    rows = spark.createDataFrame([(D(2020, 1, 1) + datetime.timedelta(days=r), r, a, b) for r, a, b in links], "date date, rank int, a_id long, b_id long")
    alerts = rows.select("date", F.col("a_id").alias("id")).distinct()
    got = {(r.date - D(2020, 1, 1)).days * 100 + r.id: r.persistence_count for r in persistence.streak_lengths(alerts, rows).collect()}
    assert got[3011] == 30 and got[3112] == 31 and got[3201] == 32 and got[2909] == 2 and got[2910] == 29
    again = persistence.streaks(random_boxes(spark, 0), date_counts(spark)).collect()
    assert {(r.date, r.id): r.persistence_count for r in again} == date_by_date(random_boxes(spark, 0))


def date_counts(spark):
    """Streaks of ids that come again on other dates."""
    return persistence.chained_streaks(random_boxes(spark, 0))


def test_one_id_on_two_dates_is_two_tracks(spark):
    here, there = (0, 0, 100, 100), (900, 0, 1000, 100)
    b = boxes(spark, [("2025-01-01", 1, here), ("2025-01-05", 1, there), ("2025-01-09", 2, here), ("2025-01-09", 3, there)])
    got, tracks = persistence.fold_tracks(b)
    assert sorted((r.date.day, r.id, r.persistence_count) for r in got.collect()) == [(1, 1, 1), (5, 1, 1), (9, 2, 2), (9, 3, 2)]
    assert sorted((r.x0, r.n_sightings) for r in tracks.collect()) == [(0, 2), (900, 2)]


def test_box_pairs_of_all_sizes(spark):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(120):
        x, y, w, h = *rng.integers(-500, 3000, 2), *rng.choice([3, 40, 100, 900, 2500], 2)
        rows.append((k % 3, k, int(x), int(y), int(x + w), int(y + h)))
    a = spark.createDataFrame(rows, "k int, id long, x0 long, y0 long, x1 long, y1 long")
    area = lambda p, q: max(0, min(p[4], q[4]) - max(p[2], q[2])) * max(0, min(p[5], q[5]) - max(p[3], q[3]))
    want = {(p[1], q[1]): area(p, q) for p in rows for q in rows if p[0] == q[0] and area(p, q)}
    got = spatial.box_pairs(a, a, ["k"]).collect()
    assert {(r.a_id, r.b_id): r.overlap for r in got} == want and len(got) == len(want)


def test_regions_over_tiles(spark):
    rng = np.random.default_rng(6)
    cells = spark.createDataFrame([(i, *map(int, c)) for i in range(2) for c in np.unique(rng.integers(0, 25, (330, 2)), axis=0)], "img int, row int, col int")
    whole, tiled = (sorted(map(tuple, regions.label_regions(cells, tile=t).collect())) for t in (1024, 6))
    assert whole == tiled and len({(c[0], c[3]) for c in whole}) > 20


def test_archive(spark, tmp_path):
    b = boxes(spark, [("2025-03-01", 1, (0, 0, 100, 100)), ("2025-03-08", 2, (20, 0, 120, 100)), ("2025-03-15", 3, (40, 0, 140, 100)), ("2025-03-15", 4, (900, 0, 1000, 100))])
    got = {r.date and r.date.day: (r.raw, r.confirmed) for r in persistence.archive(b, consecutive=3, path=str(tmp_path / "kept")).collect()}
    assert got == {1: (1, 0), 8: (1, 0), 15: (2, 1), None: (4, 1)}
    assert [r.id for r in spark.read.parquet(str(tmp_path / "kept")).collect()] == [3]


def test_stream_equals_fold(spark, tmp_path):
    rows = [("2025-01-01", 1, (0, 0, 100, 100)), ("2025-01-05", 2, (10, 0, 110, 100)), ("2025-01-09", 3, (20, 0, 120, 100)), ("2025-01-09", 4, (900, 0, 990, 90))]
    b = boxes(spark, rows)
    src = str(tmp_path / "in")
    for k, d in enumerate(("2025-01-01", "2025-01-05", "2025-01-09")):
        b.where(F.col("date") == F.lit(D.fromisoformat(d))).coalesce(1).write.parquet(f"{src}/{k}")
    stream = spark.readStream.schema(b.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(src)
    store = TrackStore(spark, str(tmp_path / "tracks"))
    track_stream(stream, store, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    got = {r.id: r.persistence_count for r in spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "out")).collect()}
    want, tracks = persistence.fold_tracks(b)
    assert got == {r.id: r.persistence_count for r in want.collect()}
    cols = ["n_sightings", "first_seen", "last_seen", "x0"]
    assert sorted(store.read().select(cols).collect()) == sorted(tracks.select(cols).collect())


def test_tile_grid_snap_and_projection(spark):
    assert spatial.tile_grid(spark, -40.90, -7.85, -38.95, -6.95).count() == 55
    with pytest.raises(ValueError):
        spatial.tile_grid(spark, 1, 0, 0, 1)
    r = spark.range(1).select(spatial.snap(F.lit(30.05), 0, 20, 20), spatial.snap(F.lit(20.0), 0, 20, 20), spatial.snap(F.lit(39.0), 0, 20, 5)).first()
    assert tuple(r) == (1, 1, None)
    e, n = spatial.utm_forward(F.lit(-39.0), F.lit(0.0))
    assert tuple(round(x, 3) for x in spark.range(1).select(e, n).first()) == (500000.0, 10000000.0)
    p = spatial.point_in_ring(F.col("x"), F.col("y"), [(0, 0), (4, 0), (4, 4), (2, 1), (0, 4)])
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (3.5, 2.0), (5.0, 1.0)], "x double, y double")
    assert [r[0] for r in df.select(p).collect()] == [True, False, True, False]


def test_utm_round_trip(spark):
    df = spark.createDataFrame([(-40.0, -8.0), (-39.2, -7.1), (-36.5, -1.0)], "lon double, lat double")
    e, n = spatial.utm_forward(F.col("lon"), F.col("lat"))
    lon, lat = spatial.utm_inverse(F.col("e"), F.col("n"))
    for r in df.withColumns({"e": e, "n": n}).withColumns({"a": lon, "b": lat}).collect():
        assert abs(r.a - r.lon) < 1e-8 and abs(r.b - r.lat) < 1e-8
