"""Operators on inputs whose work once grew faster than they do."""

import datetime
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from greensward.operators import areas, matching, persistence, unions
from greensward.operators.grid import Grid

CIRCLE = Grid(0.0, 1000.0, 10.0, 100, 100)


def circle(spark, n):
    """A ring of ``n`` corners around (500, 500), 300 m off."""
    turn = F.col("id") * (2 * np.pi / n)
    corner = F.struct((500 + 300 * F.cos(turn)).alias("x"), (500 + 300 * F.sin(turn)).alias("y"))
    return spark.range(n).select("id", corner.alias("p")).agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "p"))), lambda q: q["p"]).alias("ring"))


def cells(runs):
    return {(r.row, c) for r in runs.collect() for c in range(r.c0, r.c1 + 1)}


def test_ring_of_many_corners(spark):
    """Edges are zipped, not looked up by an index that works the ring out again for each."""
    edges, start = areas.ring_edges(circle(spark, 20_000), []), time.monotonic()
    got = cells(areas.area_runs(edges, [], CIRCLE, all_touched=False))
    assert edges.count() == 20_000 and time.monotonic() - start < 60
    assert got == {(r, c) for r in range(100) for c in range(100) if (10 * c + 5 - 500) ** 2 + (10 * r + 5 - 500) ** 2 < 300**2}


def test_area_off_the_grid_on_either_side(spark):
    """Crossings left and right of the grid still pair up."""
    square = lambda x0, x1: [{"x": float(x), "y": float(y)} for x, y in ((x0, 0), (x1, 0), (x1, 1000), (x0, 1000))]
    rings = spark.createDataFrame([(square(-500, 200),), (square(-300, -100),), (square(900, 2000),), (square(1500, 1800),)], "ring array<struct<x:double,y:double>>")
    got = cells(areas.area_runs(areas.ring_edges(rings, []), [], CIRCLE, all_touched=False))
    assert got == {(r, c) for r in range(100) for c in (*range(20), *range(90, 100))}


def test_cells_that_many_edges_meet(spark):
    """Edges of one area send a run once for each task, however many of them have it."""
    edges = areas.ring_edges(circle(spark, 20_000), [])
    runs = areas.area_runs(edges, [], CIRCLE)
    inside = cells(areas.area_runs(edges, [], CIRCLE, all_touched=False))
    far = lambda r, c: max(abs(10 * c + d - 500) for d in (0, 10)) ** 2 + max(abs(10 * r + d - 500) for d in (0, 10)) ** 2
    got = cells(runs)
    assert inside < got and all(far(r, c) >= 300**2 for r, c in got - inside)
    assert areas.edge_runs(edges, [], CIRCLE).count() > 20_000 > 1_000 > runs.count()
    plan = runs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") >= 3  # crossings, runs of edges, united runs


def test_covered_boxes_of_all_sizes(spark):
    """Shares by tiles are those of a grid of unit cells, for boxes of many sizes and with two observations before; no pair of boxes is a row."""
    rng = np.random.default_rng(5)
    n, side = 240, 5000
    x, y = rng.integers(0, side, n), rng.integers(0, side, n)
    w, h = (rng.choice([0, 3, 40, 90, 150, 700, 3000], n) for _ in range(2))
    day = rng.integers(0, 20, n)
    rows = [(int(i), f"2020-01-{d + 1:02d}", *map(int, b)) for i, d, *b in zip(range(n), day, x, y, x + w, y + h, strict=True)]
    b = spark.createDataFrame(rows, "id long, date string, x0 long, y0 long, x1 long, y1 long").withColumn("date", F.col("date").cast("date"))
    dates = sorted(set(day.tolist()))
    shares = persistence.union_area_shares(b, 2)
    got = {r.id: (r.share_1, r.share_2) for r in shares.collect()}
    assert len(got) == n
    for k in (1, 2):
        for at in range(len(dates)):
            cover = np.zeros((side + 3000, side + 3000), bool)
            for i in np.flatnonzero(day == dates[at - k]) if at >= k else ():
                cover[x[i] : x[i] + w[i], y[i] : y[i] + h[i]] = True
            for i in np.flatnonzero(day == dates[at]):
                hit = int(cover[x[i] : x[i] + w[i], y[i] : y[i] + h[i]].sum())
                assert got[int(i)][k - 1] == (hit / (int(w[i]) * int(h[i])) if w[i] * h[i] else None)
    assert "b_id" not in shares._jdf.queryExecution().optimizedPlan().toString()


def test_archive_joins_counts_only(spark):
    """Counts meet by date: neither boxes nor the kept ones are joined, so no table of them can be broadcast."""
    b = spark.createDataFrame([(1, "2020-01-01", 0, 0, 10, 10), (2, "2020-01-02", 5, 0, 15, 10), (3, "2020-01-02", 50, 0, 60, 10)], "id long, date string, x0 long, y0 long, x1 long, y1 long").withColumn("date", F.col("date").cast("date"))
    table = persistence.archive(b)
    assert sorted((str(r.date), r.raw, r.confirmed, r.dropped, r.drop_frac) for r in table.collect()) == [("2020-01-01", 1, 0, 1, 1.0), ("2020-01-02", 2, 1, 1, 0.5), ("None", 3, 1, 2, 0.6667)]
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert not any("id#" in line for line in plan.splitlines() if "Join" in line)


def test_pairs_are_not_joined_again(spark):
    """Date and area come with the box, so pairs pass no join of their own."""
    b = spark.createDataFrame([(1, "2020-01-01", 0, 0, 10, 10), (2, "2020-01-02", 5, 0, 15, 10)], "id long, date string, x0 long, y0 long, x1 long, y1 long").withColumn("date", F.col("date").cast("date"))
    pairs = persistence.with_previous(b)
    assert [(str(r.date), r.a_id, r.b_id, r.overlap, r.a_area) for r in pairs.collect()] == [("2020-01-02", 2, 1, 50, 100)]
    top = pairs._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert sum("a_level" in line and "Join" in line for line in top) == 1 and sum("Join" in line for line in top) == 3


def test_best_match_tries_few(spark):
    """The best of all pairs, by share and by value, while only a small part of the pairs is tried."""
    rng = np.random.default_rng(3)
    make = lambda n, sides: (lambda c: np.concatenate([c, c + rng.choice(sides, (n, 2))], 1).astype(float))(rng.integers(0, 1000, (n, 2)))
    tried = []
    for sides in ([100], [5, 60, 400]):
        a, b = make(600, sides), make(4000, sides)
        value = rng.integers(1, 4, len(b)).astype(float)
        size = (a[:, 2:] - a[:, :2]).prod(1)
        w, h = (np.minimum(a[:, None, i + 2], b[None, :, i + 2]) - np.maximum(a[:, None, i], b[None, :, i]) for i in (0, 1))
        share = np.where((w > 0) & (h > 0), w * h, 0) / size[:, None]
        good = share >= 0.05
        want = np.where(good.any(1), np.where(good, share, -1).argmax(1), -1)

        def exact(i, j):
            tried.append((i, j))
            return share[i, j] * size[i]

        assert (matching.best_match(a, size, b, 0.05) == want).all()
        got = matching.best_match(a, size, b, 0.05, value=value)
        assert (np.where(got >= 0, value[got], 0) == np.where(good, value, 0).max(1)).all() and good[got >= 0, got[got >= 0]].all()
        tried.clear()
        matching.best_match(a[:, :], size, b, 0.05, exact=exact)
        assert len(tried) < good.sum() / 3


def test_streaks_send_no_links(spark):
    """Boxes that all meet give rows by box, not by pair: 300 a date, so 90,000 pairs of one date and the next."""
    b = spark.range(1200).select("id", F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 4).cast("int")).alias("date"), (F.col("id") % 7).alias("x0"), (F.col("id") % 5).alias("y0"))
    b = b.withColumns({"x1": F.col("x0") + 100, "y1": F.col("y0") + 100})
    streaks = persistence.chained_streaks(b)
    assert {(r.date.day, r.persistence_count) for r in streaks.select("date", "persistence_count").distinct().collect()} == {(k, k) for k in (1, 2, 3, 4)}
    assert streaks.count() == 1200 and "b_id" not in streaks._jdf.queryExecution().optimizedPlan().toString()


def test_dense_alerts_have_smaller_tiles():
    """Tasks of tracks stay bounded as alerts come to lie denser, until one date and the least tile."""
    assert [persistence.run_size(d, lambda n: 2 * n + 1) for d in (0.01, 44.0, 440.0)] == [(8, 64), (1, 9), (1, 4)]


def test_slabs_need_one_job_for_many_dates(spark):
    """Alerts apart in x are followed over all dates at once, with the tracks of runs of dates; 60 dates were 8 jobs before."""
    b = spark.range(360).select("id", F.date_add(F.lit("2020-01-01").cast("date"), (F.floor(F.col("id") / 6) * 16).cast("int")).alias("date"), (F.col("id") % 3 * 20 + F.col("id") % 2).alias("x0"), (F.col("id") * 7 % 5).alias("y0"))
    b = b.withColumns({"x1": F.col("x0") + 10, "y1": F.col("y0") + 10})
    (got, kept), (want, left) = persistence.fold_tracks(b), persistence.fold_tracks(b, 8, 4)
    assert sorted(got.collect()) == sorted(want.collect()) and sorted(kept.collect()) == sorted(left.collect())
    assert len({f.split("/steps/")[1].split("/")[0] for f in got.inputFiles()}) == 1


def test_dense_dates_match_each_alert_once(spark):
    """One date a task: hits name the alert that gives a track its box, and the next date finds it, as when all dates are followed at once."""
    rng = np.random.default_rng(1)
    for sides in ([20], [0, 10, 15, 20]):
        n = 500
        day, corner = np.sort(rng.integers(0, 30, n)) * 25, rng.integers(0, 90, (n, 2))
        alerts = {"day": day, "id": rng.permutation(n), "box": np.concatenate([corner, corner + rng.choice(sides, (n, 2))], 1).astype(float)}
        none = np.zeros(0, np.int64)
        tracks = hits = {k: none for k in ("day", "id", "n", "first", "last")} | {"box": np.zeros((0, 4))}
        want, left = persistence.fold_dates(alerts, tracks)
        got = {}
        for d in np.unique(day):
            seen, tracks, hits = persistence.fold_day({k: v[day == d] for k, v in alerts.items()}, tracks, hits, int(d))
            assert len(np.unique(np.stack([hits["day"], hits["id"]]), axis=1).T) == len(hits["id"])
            got |= dict(zip(seen["id"].tolist(), zip(seen["n"].tolist(), seen["first"].tolist(), strict=True), strict=True))
        assert got == dict(zip(want["id"].tolist(), zip(want["n"].tolist(), want["first"].tolist(), strict=True), strict=True))
        _, tracks, _ = persistence.fold_day({k: v[:0] for k, v in alerts.items()}, tracks, hits, int(day.max()))
        rows = lambda t: sorted(zip(*(t[k].tolist() for k in ("day", "id", "n", "first", "last", "box")), strict=True))
        assert rows(tracks) == rows(left) and max(n for n, _ in got.values()) >= 14
    b = spark.createDataFrame([(int(i), int(d), *map(int, x)) for d, i, x in zip(day, alerts["id"], alerts["box"], strict=True)], "id long, d int, x0 long, y0 long, x1 long, y1 long")
    b = b.where("d < 250").select("id", F.date_add(F.lit("2020-01-01").cast("date"), F.col("d")).alias("date"), "x0", "y0", "x1", "y1")
    for one, other in zip(persistence.fold_tracks(b, 1, 2), persistence.fold_tracks(b), strict=True):
        assert sorted(one.collect()) == sorted(other.collect())


def test_pairs_by_tiles_shuffle_boxes_only(spark):
    """Pairs of boxes of all sizes, against all that could be; no join makes them, and each box is sent about once."""
    rng = np.random.default_rng(8)
    n = 500
    corner, day = rng.integers(-900, 2500, (n, 2)), rng.integers(0, 20, n)
    box = np.concatenate([corner, corner + rng.choice([0, 30, 100, 100, 150, 700, 2600], (n, 2))], 1)
    b = spark.createDataFrame([(int(i), int(d), *map(int, x)) for i, d, x in zip(range(n), day, box, strict=True)], "id long, d int, x0 long, y0 long, x1 long, y1 long")
    b = b.select("id", F.date_add(F.lit("2020-01-01").cast("date"), F.col("d")).alias("date"), "x0", "y0", "x1", "y1")
    rank = np.searchsorted(np.unique(day), day)
    w, h = (np.minimum(box[:, None, k + 2], box[None, :, k + 2]) - np.maximum(box[:, None, k], box[None, :, k]) for k in (0, 1))
    for back in (1, 2):
        want = {(int(i), int(j)): int(w[i, j] * h[i, j]) for i, j in np.argwhere((w > 0) & (h > 0) & (rank[:, None] == rank[None, :] + back))}
        pairs = persistence.tile_pairs(b, back)
        got = pairs.collect()
        assert len(got) == len(want) > 100 and {(r.a_id, r.b_id): r.overlap for r in got} == want
        assert all((r.date - datetime.date(2020, 1, 1)).days == day[r.a_id] for r in got)
    one = b.withColumns({"x1": F.col("x0") + 100, "y1": F.col("y0") + 100})
    plan = persistence.tile_pairs(one)._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Join" in line for line in plan.splitlines()) == 1  # dates' numbers
    real = one.select(*("id", "date"), *[F.col(c).cast("double").alias(c) for c in ("x0", "y0", "x1", "y1")])
    assert persistence.tile_pairs(real).count() == persistence.with_previous(real).count()


def test_pairs_shuffle_few_bytes_a_box(spark, monkeypatch):
    """Boxes are shuffled in packs; whole corners and others, ids of any kind, and packs of any size give the same pairs."""
    b = spark.range(0, 12_000, 1, 1).select("id", F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 12).cast("int")).alias("date"), (F.xxhash64("id") % 800).alias("x0"), (F.xxhash64("id", F.lit(1)) % 800).alias("y0"))
    b = b.withColumns({"x1": F.col("x0") + 100, "y1": F.col("y0") + 100})

    def sent(plan):
        """Bytes of the shuffles of a plan that has run."""
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return sent(plan.executedPlan())
        if name.endswith("QueryStageExec"):
            return sent(plan.plan())
        own = plan.metrics().get("shuffleBytesWritten").get().value() if name == "ShuffleExchangeExec" else 0
        return own + sum(sent(plan.children().apply(k)) for k in range(plan.children().size()))

    n = persistence.tile_pairs(b).groupBy().agg(F.count(F.lit(1)).alias("n"), F.sum("overlap"))
    rows = n.collect()
    assert rows[0].n > 100_000 and sent(n._jdf.queryExecution().executedPlan()) < 20 * 12_000  # 45 a box as rows

    some = b.where("id < 600").select(F.concat(F.lit("a"), "id").alias("id"), "date", *[(F.col(c) / 7).alias(c) for c in ("x0", "y0", "x1", "y1")])
    want = {(r.a_id, r.b_id, r.overlap) for r in persistence.tile_pairs(some).collect()}
    box = {r.id: (r.date, r.x0, r.y0, r.x1, r.y1) for r in some.collect()}
    left = {(i, j) for i, a in box.items() for j, c in box.items() if (a[0] - c[0]).days == 1 and min(a[3], c[3]) > max(a[1], c[1]) and min(a[4], c[4]) > max(a[2], c[2])}
    assert {w[:2] for w in want} == left and len(want) > 100
    for i, j, o in want:
        a, c = box[i], box[j]
        assert o == pytest.approx((min(a[3], c[3]) - max(a[1], c[1])) * (min(a[4], c[4]) - max(a[2], c[2])), rel=1e-9, abs=1e-9)
    for size in (1, 50):
        monkeypatch.setattr(unions, "PACKED", size)
        assert {(r.a_id, r.b_id, r.overlap) for r in persistence.tile_pairs(some).collect()} == want
