import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from greensward.operators import quality, series
from greensward.operators.pairs import kendall_s, slope_ranks
from greensward.operators.quantiles import exact_quantiles

S = "series_id long, date date, value double"


def days(start, values, step=5):
    d = datetime.date.fromisoformat(start)
    return [(1, d + datetime.timedelta(step * k), v) for k, v in enumerate(values) if v is not None]


def test_regional_stats(spark):
    df = spark.createDataFrame([("a", 0.1), ("a", 0.2), ("a", 0.3), ("a", None), ("a", None), ("a", None), ("b", None)], "date string, v double")
    r = series.regional_stats(df.unionByName(spark.createDataFrame([(None, 0.5)], df.schema)), "v", ["date"]).collect()
    assert {x.date: x.median for x in r} == {"a": 0.2, None: 0.5}
    r = [x for x in r if x.date]
    assert len(r) == 1 and (r[0].n_valid, r[0].pct_valid, r[0].mean) == (3, 50.0, 0.2)


def test_gap_lengths(spark):
    short = spark.createDataFrame(days("2024-01-01", [1.0] + [None] * 6 + [8.0]), S)
    r = series.gap_fill(short).orderBy("bin_start").collect()
    assert [x.filled for x in r] == ["observed"] + ["interpolated"] * 6 + ["observed"]
    assert [x.value for x in r] == pytest.approx([1, 2, 3, 4, 5, 6, 7, 8])
    long = spark.createDataFrame(days("2024-01-01", [1.0] + [None] * 7 + [9.0]), S)
    r = series.gap_fill(long).orderBy("bin_start").collect()
    assert [x.filled for x in r][1:-1] == ["seasonal"] * 7 and r[3].value is None


def test_breaks_reset_after_three(spark):
    far = [0, 9, 9, 9, 9, 9, 9, 0, 9, 9, None, 9]
    rows = [(1, datetime.date(2024, 1, 1) + datetime.timedelta(k), None if v is None else float(v), 1.0) for k, v in enumerate(far)]
    got = series.break_points(spark.createDataFrame(rows, "series_id long, date date, residual double, rmse double")).collect()
    assert sorted(str(r.break_date) for r in got) == ["2024-01-02", "2024-01-05"]


def test_trends_of_a_line(spark):
    df = spark.createDataFrame([(1, datetime.date(2020, 1, 1) + datetime.timedelta(k), 2.0 * k / 365.25) for k in range(30)], S)
    r = series.trends(df).first()
    assert (r.s, r.tau, r.trend) == (435, 1.0, "increasing") and r.slope == pytest.approx(2.0)
    few = spark.createDataFrame([(1, datetime.date(2020, 1, k + 1), 1.0) for k in range(3)], S)
    r = series.trends(few.unionByName(df)).where("n = 33").first()
    assert r.trend == "increasing"
    r = series.trends(few).first()
    assert (r.n, r.tau, r.p_value, r.trend, r.significant, r.slope, r.intercept) == (3, 0.0, 1.0, "insufficient_data", False, 0.0, 1.0)
    two = spark.createDataFrame([(1, datetime.date(2020, 1, k + 1), 5.0) for k in range(2)] + [(1, datetime.date(2020, 2, 1), None)], S)
    r = series.sen_slope(two).first()
    assert (r.slope, r.intercept, r.low, r.high) == (0.0, 0.0, 0.0, 0.0)


def test_normal_tail(spark):
    z = [k / 7 for k in range(270)]
    got = spark.createDataFrame([(x,) for x in z], "z double").select(series.normal_tail(F.col("z")).alias("p")).collect()
    assert [r.p for r in got] == pytest.approx([math.erfc(x / math.sqrt(2)) / 2 for x in z], rel=1e-6, abs=1e-300)


@pytest.mark.parametrize(("cells", "most"), [(4096, 50_000), (4, 3)])
def test_exact_quantiles(spark, cells, most):
    """Few and coarse cells make many rounds: ties, outliers, one value, none."""
    rng = np.random.default_rng(8)
    data = {"a": rng.normal(size=101), "b": np.append(rng.choice([1.0, 2.0], 60), 1e9), "c": np.array([7.0]), "d": np.array([]), None: rng.normal(size=20) * 1e-12}
    rows = [(k, float(v)) for k, x in data.items() for v in x] + [(k, None) for k in data]
    got = {r.k: (r.q0, r.q1, r.q2) for r in exact_quantiles(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", [0.5, 0.01, 0.99], cells=cells, most=most).collect()}
    assert got.keys() == data.keys() - {"d"}
    for k, q in got.items():
        assert q == pytest.approx(tuple(np.quantile(data[k], [0.5, 0.01, 0.99])), rel=1e-12, abs=1e-25)


def test_harmonic_recovers_waves(spark):
    d = [datetime.date(2020, 1, 1) + datetime.timedelta(9 * k) for k in range(120)]
    t = np.array([x.timetuple().tm_yday for x in d]) / 365.25
    y = 3 + 0.5 * np.cos(2 * np.pi * t) - 0.25 * np.sin(4 * np.pi * t)
    r = series.harmonic_fit(spark.createDataFrame([(1, a, float(b)) for a, b in zip(d, y)], S)).first()
    assert r.coefficients == pytest.approx([3, 0.5, 0, 0, -0.25], abs=1e-9) and r.rmse < 1e-9


def test_spi():
    x = np.random.default_rng(1).gamma(2, 50, 200)
    shape, scale = series.gamma_fit(x)
    s = np.log(x.mean()) - np.log(x).mean()
    assert abs(np.log(shape) - series._digamma(shape) - s) < 1e-9 and shape * scale == pytest.approx(x.mean())
    assert series.gamma_cdf(1.0, 2.0) == pytest.approx(1 - np.exp(-2)) and series.gamma_cdf(3.0, 9.0) == pytest.approx(1 - np.exp(-9) * (1 + 9 + 40.5))
    at = lambda v: series.spi(np.append(x, v))
    assert abs(at(np.median(x))) < 0.5 and at(np.quantile(x, 0.05)) < -1 and at(np.quantile(x, 0.95)) > 1
    assert at(np.nan) == 0.0


def test_stl_parts_add_up():
    k = np.arange(120)
    y = 0.02 * k + np.sin(2 * np.pi * k / 12)
    t, s, r = series.stl_decompose(y, 12, outer=3)
    assert t + s + r == pytest.approx(y) and np.abs(r).max() < 0.1 and np.abs(t - 0.02 * k)[12:-12].max() < 0.1
    t, s, r = series.stl_decompose(y[:20], 12)
    assert (t == y[:20]).all() and not s.any() and not r.any()


def test_year_ranking_and_oni(spark):
    text = "DJF 2019 0.9 | JFM 2019 -0.9 | FMA 2019 0.1\nDJF 2020 2.1 | JFM 2020 0.3"
    text = text.replace("0.9", "0.90").replace("0.1", "0.10").replace("2.1", "2.10").replace("0.3", "0.30")
    oni = spark.createDataFrame([(text,)], "t string").select(F.inline(quality.parse_oni(F.col("t"))))
    assert [(r.year, r.seq, r.anom) for r in oni.collect()] == [(2019, 0, 0.9), (2019, 1, -0.9), (2019, 2, 0.1), (2020, 3, 2.1), (2020, 4, 0.3)]
    odd = spark.createDataFrame([("SEAS YR TOTAL ANOM\nDJF 1950 24.7 -1.53\n\nnote 1950 x\nJFM 1950\n",), (None,)], "t string").select(F.inline(quality.parse_oni(F.col("t"))))
    assert [(r.year, r.anom) for r in odd.collect()] == [(1950, -1.53)]
    rain = spark.createDataFrame([(y, m, float(m + y - 2019)) for y in (2019, 2020) for m in range(1, 13)], "year int, month int, mm double")
    r = {x.year: x for x in quality.rank_years(oni, rain).collect()}
    assert (r[2019].peak, r[2019].eligible, r[2020].eligible) == (0.9, True, False) and r[2020].precip_z == pytest.approx(1)


def test_sample_and_commission(spark):
    df = spark.createDataFrame([(k, "a" if k % 3 else None) for k in range(60)], "k int, g string")
    got = quality.stratified_sample(df, ["g"], F.xxhash64("k"), 15)
    assert {r.g: r["count"] for r in got.groupBy("g").count().collect()} == {"a": 15, None: 15}
    v = spark.createDataFrame([("x", "TP"), ("x", "FP"), ("y", None)], "tier string, verdict string")
    assert {r.tier: r.commission_error for r in quality.commission_error(v).collect()} == {"x": 0.5, "y": None}


def test_breaks_relative_to_a_harmonic_history(spark):
    """Seasonal swings are no breaks; a shift of six points after the history is two, and one of two points none."""
    import datetime

    import numpy as np

    from greensward.operators import series

    start, rows = datetime.date(2019, 1, 1), []
    for i in range(200):
        d = start + datetime.timedelta(10 * i)
        wave = 0.5 + 0.3 * np.cos(2 * np.pi * d.timetuple().tm_yday / 365.25) + 0.01 * (-1) ** i
        for s, shifted in ((1, range(0)), (2, range(150, 156)), (3, range(150, 152))):
            rows.append((s, d, float(wave - 0.2 * (i in shifted))))
    rows += [(4, start, 1.0), (4, datetime.date(2023, 1, 1), 9.0)]
    got = series.detect_breaks_harmonic(spark.createDataFrame(rows, "series_id long, date date, value double"), "2022-01-01").collect()
    want = [(2, start + datetime.timedelta(10 * i)) for i in (150, 153)]
    assert sorted((r.series_id, r.break_date) for r in got) == want
    assert all(abs(r.anomaly + 0.2) < 0.03 and abs(r.value - r.expected - r.anomaly) < 1e-12 for r in got)


@pytest.mark.parametrize("held", [10, 300, 1 << 20])
def test_pair_counts_and_ranks(held):
    rng = np.random.default_rng(held)
    for n in (1, 2, 3, 10, 90, 250):
        day = np.sort(rng.integers(0, n, n)).astype(float)
        y = np.round(rng.normal(size=n), 1) if n % 2 else rng.normal(size=n) * 1e6
        pairs = [(y[j] - y[i]) / (day[j] - day[i]) for i in range(n) for j in range(n) if day[i] < day[j]]
        assert kendall_s(day, y) == sum(np.sign(m) for m in pairs)
        ranks = sorted({0, len(pairs) // 3, len(pairs) // 2, len(pairs) - 1} - {-1})
        if pairs:
            assert slope_ranks(day, y, ranks, held) == [sorted(pairs)[r] for r in ranks]
    assert slope_ranks(np.arange(40.0), np.full(40, 3.0), [0, 779], held) == [0.0, 0.0]


def test_last_row_of_a_key_wins(spark):
    old = spark.createDataFrame([("a", 1, 1.0), ("b", 1, 2.0), (None, 1, 3.0)], "region string, rev int, mean double")
    new = spark.createDataFrame([("a", 3, 5.0), ("a", 2, 9.0), ("c", 1, 7.0), ("c", 1, 7.0), ("c", 1, 4.0), (None, 2, None)], "region string, rev int, mean double")
    assert sorted(map(str, series.upsert(old, new, ["region"], ["rev"]).collect())) == sorted(map(str, spark.createDataFrame([("a", 3, 5.0), ("b", 1, 2.0), ("c", 1, 7.0), (None, 2, None)], old.schema).collect()))
    assert {r.mean for r in series.upsert(old, new.drop("rev").withColumn("rev", F.lit(1)).select(old.columns), ["region"]).collect()} == {9.0, 2.0, 7.0, None}


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), float("-inf")])
def test_quantiles_of_values_that_are_not_finite(spark, bad):
    rows = spark.createDataFrame([(k % 2, float(k)) for k in range(100)] + [(0, bad), (2, bad)], "g int, v double")
    got = {r.g: (r.q0, r.q1) for r in exact_quantiles(rows, ["g"], "v", [0.5, 1.0], most=5, cells=16).collect()}
    assert got == {0: (49.0, 98.0), 1: (50.0, 99.0)}
    stats = {r.g: r for r in series.regional_stats(rows, "v", ["g"]).collect()}
    assert set(stats) == {0, 1} and stats[0].n_valid == 50 and stats[0]["max"] == 98.0 and stats[0].pct_valid == pytest.approx(100 * 50 / 51, abs=1e-6)
    assert {r.g: r.n for r in quality.profile(rows, ["g"]).collect()} == {0: 49, 1: 50, 2: 0}


def test_quantiles_of_ranges_wider_than_a_double(spark):
    rows = spark.createDataFrame([(v,) for k in range(40) for v in (-1.7e308, 1.7e308, float(k), 5e-324)], "v double").withColumn("g", F.lit(1))
    got = exact_quantiles(rows, ["g"], "v", [0.0, 0.3, 0.6, 1.0], most=5, cells=8).first()
    want = sorted(v for k in range(40) for v in (-1.7e308, 1.7e308, float(k), 5e-324))
    assert (got.q0, got.q3) == (want[0], want[-1]) and got.q1 == pytest.approx(np.interp(0.3 * 159, range(160), want)) and got.q2 == pytest.approx(np.interp(0.6 * 159, range(160), want))


def test_gamma_by_closed_forms_and_quadrature():
    for x in (0.01, 0.3, 1.0, 2.5, 9.0, 40.0):
        assert series.gamma_cdf(1.0, x) == pytest.approx(1 - math.exp(-x), abs=1e-12)
        assert series.gamma_cdf(0.5, x) == pytest.approx(math.erf(math.sqrt(x)), abs=1e-12)
        assert series.gamma_cdf(3.0, x) == pytest.approx(1 - math.exp(-x) * (1 + x + x * x / 2), abs=1e-12)
        for a in (3.3, 6.2, 25.0):
            t = np.linspace(0, x, 20_001)
            density = t ** (a - 1) * np.exp(-t - math.lgamma(a))
            simpson = (density[0] + density[-1] + 4 * density[1:-1:2].sum() + 2 * density[2:-1:2].sum()) * (t[1] - t[0]) / 3
            assert series.gamma_cdf(a, x) == pytest.approx(simpson, abs=1e-6)


def test_gamma_fit_has_the_largest_likelihood():
    rng = np.random.default_rng(12)
    for k, scale in ((0.6, 30.0), (1.3, 150.0), (9.0, 4.0)):
        x = rng.gamma(k, scale, 200)
        likelihood = lambda a, b: float(((a - 1) * np.log(x) - x / b).sum()) - len(x) * (math.lgamma(a) + a * math.log(b))  # noqa: B023, E731
        a, b = series.gamma_fit(x)
        best = likelihood(a, b)
        assert all(best >= likelihood(a * u, b * v) for u in (0.98, 0.999, 1.0, 1.001, 1.02) for v in (0.98, 0.999, 1.0, 1.001, 1.02))
        assert a * b == pytest.approx(x.mean())


def test_spi_of_exponential_rain():
    """Sums whose fit is nearly exponential: the index is the normal quantile of q + (1 - q)(1 - exp(-x / mean)), within the fit's own shape."""
    from statistics import NormalDist

    rng = np.random.default_rng(3)
    rain = np.append(rng.exponential(50.0, 4000), np.zeros(1000))
    for target in (5.0, 40.0, 120.0):
        q = 1000 / 5001
        want = NormalDist().inv_cdf(q + (1 - q) * (1 - math.exp(-target / 50.0)))
        assert series.spi(np.append(rain, target)) == pytest.approx(want, abs=0.05)


@pytest.mark.parametrize("period", [6, 12])
def test_stl_of_a_line_and_a_cycle(period):
    """Local lines and means over whole cycles give a line and a steady cycle back; a spike stays in the residual."""
    t = np.arange(10 * period, dtype=float)
    line, cycle = 3 + 0.05 * t, np.sin(2 * np.pi * t / period) + 0.5 * np.cos(4 * np.pi * t / period)
    trend, seasonal, residual = series.stl_decompose(line + cycle, period, outer=1)
    assert np.abs(trend - line).max() < 1e-9 and np.abs(seasonal - cycle).max() < 1e-9 and np.abs(residual).max() < 1e-9
    noise = np.random.default_rng(period).normal(size=len(t)) * 0.02
    y = line + cycle + noise
    y[5 * period + 2] += 8
    trend, seasonal, residual = series.stl_decompose(y, period)
    assert residual[5 * period + 2] > 7.8 and np.abs(trend - line).max() < 0.06 and np.abs(seasonal - cycle).max() < 0.1
