"""Registered queries over whole tables, against brute force on small fixtures."""

import datetime
from collections import defaultdict

import pytest

from greensward.plans import catalog

D = datetime.datetime


@pytest.fixture(scope="module")
def orders(spark, tmp_path_factory):
    """24 months from 1995 on; those of customer 1 are always there, the others come and go."""
    d, rows = str(tmp_path_factory.mktemp("orders")), []
    for m in range(24):
        for c in range(8):
            if c < 2 or (m * 5 + c * c) % 7 < 4:
                rows.append((110 * m + c + 3 * (m % 5), 1 + c // 2 * 6, D(1995 + m // 12, 1 + m % 12, 1 + c), 900.0 + 13 * c + (m * 37) % 101))
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_totalprice double").write.parquet(f"{d}/orders.parquet")
    return d, rows


def months(rows):
    """Boxes of each month in order: ``(date, {id: (x0, y0)})``."""
    by = defaultdict(dict)
    for k, c, t, _ in rows:
        by[t.date().replace(day=1)][k] = (c * 37 % 1500 + k % 110, c * 91 % 1500 + k * 7 % 110)
    return sorted(by.items())


def overlap(a, b):
    return max(0, 100 - abs(a[0] - b[0])) * max(0, 100 - abs(a[1] - b[1]))


def pairs(rows):
    m = months(rows)
    return {(d, i, j): o for (_, old), (d, new) in zip(m, m[1:]) for i, a in new.items() for j, b in old.items() if (o := overlap(a, b))}


def cells(b):
    return {(x, y) for x in range(-(-b[0] // 10), -(-(b[0] + 100) // 10)) for y in range(-(-b[1] // 10), -(-(b[1] + 100) // 10))}


def test_spatial_pairs_of_all_dates(spark, orders):
    got = {(r.date, r.a_id, r.b_id): r.overlap for r in catalog.QUERIES["spatial_pairs"](spark, orders[0]).collect()}
    assert got == pairs(orders[1]) and len({k[0] for k in got}) > 20


def test_strict_filter_of_all_dates(spark, orders):
    want, summary, old = set(), {}, {}
    for d, new in months(orders[1]):
        union = set().union(*map(cells, old.values()))
        kept = {i for i, b in new.items() if len(cells(b) & union) >= 0.05 * len(cells(b))}
        want |= {(d, i) for i in kept}
        summary[d], old = (len(new), len(kept)), new
    assert {(r.date, r.id) for r in catalog.QUERIES["persist_strict"](spark, orders[0]).collect()} == want
    assert {r.date: (r.raw, r.confirmed) for r in catalog.QUERIES["persist_history"](spark, orders[0]).collect()} == summary


def test_projection_of_all_boxes(spark, orders):
    got = catalog.QUERIES["utm_round_trip"](spark, orders[0]).collect()
    assert len(got) == len(orders[1]) and all(r.returns for r in got)


def test_tracks_of_all_dates(spark, orders):
    got = catalog.QUERIES["track_fold"](spark, orders[0]).collect()
    assert len(got) == len(orders[1]) and max(r.persistence_count for r in got) >= 15
    assert "confirmed" in {r.persistence_status for r in got}


def test_streaks_of_all_dates(spark, orders):
    rows, want, hits = orders[1], {}, defaultdict(list)
    for (d, i, j), o in pairs(rows).items():
        if o >= 0.05 * 100 * 100:
            hits[d, i].append(j)
    last = {}
    for d, new in months(rows):
        last = {i: 1 + max((last[j] for j in hits[d, i]), default=0) for i in new}
        want |= {(d, i): n for i, n in last.items()}
    assert max(want.values()) >= 15
    assert {(r.date, r.id): r.persistence_count for r in catalog.QUERIES["persist_streak"](spark, orders[0]).collect()} == want
    tier = lambda n: "confirmed" if n >= 15 else "candidate" if n >= 2 else "first_observation"
    assert {(r.date, r.id): r.tier for r in catalog.QUERIES["persist_tiers"](spark, orders[0]).collect()} == {k: tier(n) for k, n in want.items()}


def test_names_of_all_orders(spark, orders):
    names = {f"{'.' if c % 7 == 0 else ''}{t:%Y%m%d}_S2A_T{c % 4}{'' if c % 5 == 0 else '_R1_L2A_ndmi.tif'}" for _, c, t, _ in orders[1]}
    got = catalog.QUERIES["filename_metadata"](spark, orders[0]).collect()
    assert sorted(r.name for r in got) == sorted(names)
    by = defaultdict(list)
    for n in sorted(names):
        if n[0] != "." and 1993 <= int(n[:4]) <= 1997:
            by[n[:8]].append(n)
    assert {r.date: (r.n_files, r.names) for r in catalog.QUERIES["files_by_date"](spark, orders[0]).collect()} == {k: (len(v), ",".join(v)) for k, v in by.items()}


def test_gaps_of_all_series(spark, orders):
    series, want = defaultdict(lambda: defaultdict(list)), {}
    for _, c, t, p in orders[1]:
        series[c % 40][t.date()].append(None if t.month in (3, 4) and c % 40 < 6 else p / 997)
    for k, days in series.items():
        d0, seen = min(days), defaultdict(list)
        for d, p in days.items():
            if p[0] is not None:
                seen[(d - d0).days // 5].append(sum(p) / len(p))
        v = {b: sum(x) / len(x) for b, x in seen.items()}
        last = (max(days) - d0).days // 5
        assert 0 in v
        for b in range(last + 1):
            before, after = max(x for x in v if x <= b), min((x for x in v if x >= b), default=None)
            empty = min((x for x in v if x > before), default=last + 1) - before - 1
            key = (k, d0 + datetime.timedelta(5 * b))
            if b in v:
                want[key] = ("observed", v[b])
            elif empty * 5 <= 30:
                want[key] = ("interpolated", v[before] if after is None else v[before] + (v[after] - v[before]) * (b - before) / (after - before))
            else:
                want[key] = ("seasonal", None)
    got = {(r.series_id, r.bin_start): r for r in catalog.QUERIES["gap_fill"](spark, orders[0]).collect()}
    assert got.keys() == want.keys() and {f for f, _ in want.values()} == {"observed", "interpolated", "seasonal"}
    for key, (kind, value) in want.items():
        same = [x for (k, d), (f, x) in want.items() if k == key[0] and d.timetuple().tm_yday == key[1].timetuple().tm_yday and x is not None]
        value = sum(same) / len(same) if value is None and same else value
        assert got[key].filled == kind and (got[key].value is None) == (value is None) and abs((got[key].value or 0) - (value or 0)) < 2e-5


def test_baselines_of_all_observations(spark, tmp_path):
    ddl = "l_orderkey long, l_linenumber int, l_suppkey long, l_shipdate timestamp_ntz, l_discount double, l_tax double, l_quantity double, l_extendedprice double, l_partkey long"
    rows = [(k, 1, s, D(y, m, 3), 0.1, 0.1, 20.0, 5e4, 4) for k, (s, y, m) in enumerate([(7, 1995, 2), (8, 1995, 3), (9, 1998, 11)])]
    spark.createDataFrame(rows, ddl).write.parquet(str(tmp_path / "lineitem.parquet"))
    got = {(r.index_name, r.month) for r in catalog.QUERIES["baseline_missing"](spark, str(tmp_path)).collect()}
    assert got == {(n, m) for n in ("ndmi", "nbr", "evi2") for m in range(1, 13) if n == "evi2" or m not in (2, 3, 11)}


def test_stl_has_the_default_rounds(spark, orders, monkeypatch):
    from greensward.operators import series

    seen, real = [], series.stl
    monkeypatch.setattr(series, "stl", lambda s, period, outer=15: seen.append(outer) or real(s, period, outer))
    assert catalog.QUERIES["stl"](spark, orders[0]).count() > 0 and seen == [15]
