"""Time series: regional statistics, gap filling, trends, breaks and drought."""

from __future__ import annotations

import functools
import math
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from greensward import config
from greensward.operators.pairs import kendall_s, slope_ranks
from greensward.operators.quantiles import finite, with_quantiles


def regional_stats(values: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Statistics of the finite values; groups without one have no row.

    The median comes from histograms (``exact_quantiles``), so a date of any
    number of pixels is never gathered in a task.
    """
    values = values.withColumn(value, finite(F.col(value)))
    v, n = F.col(value), F.count(value)
    r = lambda c: F.round(c, 6)
    out = values.groupBy(*by).agg(r(F.avg(v)).alias("mean"), r(F.stddev_pop(v)).alias("std"), r(F.min(v)).alias("min"), r(F.max(v)).alias("max"), n.alias("n_valid"), r(100.0 * n / F.greatest(F.count(F.lit(1)), n, F.lit(1))).alias("pct_valid"))
    out = with_quantiles(out.where("n_valid > 0"), values, by, value, {"median": 0.5})
    return out.select(*by, "mean", r(F.col("median")).alias("median"), "std", "min", "max", "n_valid", "pct_valid")


def read_series(stored: DataFrame, first: str | None = None, last: str | None = None, **equal: str) -> DataFrame:
    """Stored rows whose columns have the values ``equal``, from ``first`` to ``last``, both included, in the order of dates."""
    out = stored
    for name, value in equal.items():
        out = out.where(F.col(name) == value)
    if first is not None:
        out = out.where(F.col("date") >= F.lit(first).cast("date"))
    if last is not None:
        out = out.where(F.col("date") <= F.lit(last).cast("date"))
    return out.orderBy("date")


def upsert(stored: DataFrame, new: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """New rows replace stored ones with the same keys.

    Of new rows that share their keys the last by ``order`` counts, and among
    those that are equal there, or without an order, the largest by the other
    columns. Null keys are keys like any other.
    """
    rest = [c for c in new.columns if c not in {*keys, *(order or [])}]
    last = new.groupBy(*keys).agg(F.max(F.struct(*(order or []), *rest)).alias("_last")) if len(new.columns) > len(keys) else new.distinct()
    last = last.select(*[F.col(c) if c in keys else F.col("_last")[c].alias(c) for c in new.columns])
    old, fresh = stored.alias("old"), last.alias("fresh")
    same = F.lit(True)
    for c in keys:
        same = same & F.col(f"old.{c}").eqNullSafe(F.col(f"fresh.{c}"))
    return old.join(fresh, same, "left_anti").unionByName(last)


def rolling3(series: DataFrame, order: list[str], value: str, by: list[str] | None = None) -> DataFrame:
    """Sum of three rows in order; null unless all three are there."""
    w = Window.partitionBy(*(by or [])).orderBy(*order).rowsBetween(-2, 0)
    return series.withColumn("sum3", F.when(F.count(value).over(w) == 3, F.sum(value).over(w)))


def gap_fill(series: DataFrame, value: str = "value") -> DataFrame:
    """``series_id, bin_start, value, filled`` on 5-day bins from each series' first date.

    A gap is an observed bin and the empty ones behind it. Up to 30 days it is
    filled on the line to the next observation (the last value after the last
    one); longer ones get the mean of their day of the year, taken after that.
    """
    first = Window.partitionBy("series_id")
    s = series.withColumn("d0", F.min("date").over(first))
    step = F.floor(F.datediff("date", "d0") / config.BIN_DAYS)
    bins = s.groupBy("series_id", "d0", step.alias("k")).agg(F.avg(value).alias("v"))
    spine = s.groupBy("series_id", "d0").agg(F.max(step).alias("n")).select("series_id", "d0", F.explode(F.sequence(F.lit(0).cast("bigint"), "n")).alias("k"))
    r = spine.join(bins, ["series_id", "d0", "k"], "left")
    back = Window.partitionBy("series_id").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy("series_id").orderBy("k").rowsBetween(0, Window.unboundedFollowing)
    at = F.when(F.col("v").isNotNull(), F.struct("k", "v"))
    r = r.withColumns({"p": F.last(at, True).over(back), "q": F.first(at, True).over(ahead), "g": F.count("v").over(back)})
    size = F.count(F.lit(1)).over(Window.partitionBy("series_id", "g")) - 1
    short = size * config.BIN_DAYS <= config.MAX_GAP_DAYS
    line = F.col("p.v") + (F.col("q.v") - F.col("p.v")) * (F.col("k") - F.col("p.k")) / (F.col("q.k") - F.col("p.k"))
    inter = F.when(F.col("v").isNotNull(), F.col("v")).when(short & F.col("p").isNotNull(), F.when(F.col("q").isNull(), F.col("p.v")).otherwise(line))
    r = r.withColumns({"short": short, "inter": inter, "bin_start": F.expr("date_add(d0, cast(5 * k as int))")})
    seasonal = F.avg("inter").over(Window.partitionBy("series_id", F.dayofyear("bin_start")))
    label = F.when(F.col("v").isNotNull(), "observed").when(F.col("short"), "interpolated").otherwise("seasonal")
    return r.select("series_id", "bin_start", F.coalesce("inter", seasonal).alias("value"), label.alias("filled"))


def _by_series(series: DataFrame, figures, ddl: str) -> DataFrame:
    """``figures(day, value)`` of each series, days since 1970 in order; a task has the points of a series, never its pairs."""
    days = F.datediff("date", F.lit("1970-01-01").cast("date"))
    points = series.select("series_id", days.alias("day"), F.col("value").cast("double").alias("value"))
    names = [f.split()[0] for f in ddl.split(", ")]

    def one(table: pa.Table) -> pa.Table:
        day, value = table.column("day").to_numpy().astype(np.float64), table.column("value").to_numpy()
        order = np.lexsort((value, day))
        out = table.select(["series_id"]).slice(0, 1)
        for name, figure in zip(names, figures(day[order], value[order]), strict=True):
            out = out.append_column(name, pa.array([figure]))
        return out

    return points.groupBy("series_id").applyInArrow(one, f"series_id {dict(series.dtypes)['series_id']}, {ddl}")


def mann_kendall(series: DataFrame) -> DataFrame:
    """``series_id, n, s, tau, var_s, z``: S over all pairs, by merge counts, with the variance corrected for ties; zeros with under four values. Nulls are left out."""
    series = series.where("value is not null")
    s = _by_series(series, lambda day, value: [kendall_s(day, value)], "s bigint")
    t = series.groupBy("series_id", "value").agg(F.count(F.lit(1)).alias("t")).groupBy("series_id").agg(F.sum("t").alias("n"), F.sum(F.col("t") * (F.col("t") - 1) * (2 * F.col("t") + 5)).alias("ties"))
    n, enough = F.col("n"), F.col("n") >= 4
    out = t.join(s, "series_id", "left").withColumn("s", F.when(enough, F.coalesce("s", F.lit(0))).otherwise(0))
    out = out.withColumn("var_s", F.when(enough, (n * (n - 1) * (2 * n + 5) - F.col("ties")) / F.lit(18.0)).otherwise(0.0))
    z = F.when(F.col("var_s") > 0, F.try_divide(F.col("s") - F.signum("s"), F.sqrt("var_s"))).otherwise(0.0)
    tau = F.when(enough, F.col("s") / (n * (n - 1) / 2.0)).otherwise(0.0)
    return out.select("series_id", "n", "s", F.round(tau, 6).alias("tau"), F.round("var_s", 6).alias("var_s"), F.round(z, 6).alias("z"))


def sen_figures(day: np.ndarray, value: np.ndarray) -> list[float]:
    """Slope a year, intercept at the first day, and the bounds of the slope; zeros with under three values or on one day."""
    n = len(day)
    _, same = np.unique(day, return_counts=True)
    k = n * (n - 1) // 2 - int((same * (same - 1) // 2).sum())
    if n < 3 or not k:
        return [0.0] * 4
    c = 1.96 * math.sqrt(n * (n - 1) * (2 * n + 5) / 18.0)
    low, high = (max(min(int((k + d) / 2), k - 1), 0) for d in (-c, c))
    a, b, first, last = (365.25 * m for m in slope_ranks(day, value, [(k - 1) // 2, k // 2, low, high]))
    slope = (a + b) / 2
    return [slope, float(np.median(value - slope * (day - day[0]) / 365.25)), first, last]


def sen_slope(series: DataFrame) -> DataFrame:
    """``series_id, slope, intercept, low, high`` a year: the median of pair slopes, its 95 % bounds by rank without tie correction, and the median of what the slope leaves, at the first date.

    Zeros with under three values or without two dates; nulls are left out.
    Ranks are searched over the slopes as they are made, so pairs are neither
    shuffled nor held.
    """
    found = _by_series(series.where("value is not null"), sen_figures, "slope double, intercept double, low double, high double")
    out = series.select("series_id").distinct().join(found, "series_id", "left")
    return out.select("series_id", *[F.round(F.coalesce(c, F.lit(0.0)), 6).alias(c) for c in ("slope", "intercept", "low", "high")])


def break_points(residuals: DataFrame) -> DataFrame:
    """First dates of three consecutive points beyond three times ``rmse``; a run of six gives two."""
    w = Window.partitionBy("series_id").orderBy("date")
    r = residuals.withColumn("far", F.coalesce(F.abs("residual") > config.BREAK_RMSE * F.col("rmse"), F.lit(False)))
    r = r.withColumn("run", F.sum((~F.col("far")).cast("int")).over(w))
    r = r.where("far").withColumn("i", F.row_number().over(Window.partitionBy("series_id", "run").orderBy("date")))
    first = F.lag("date", config.BREAK_RUN - 1).over(Window.partitionBy("series_id", "run").orderBy("date"))
    return r.withColumn("break_date", first).where(F.col("i") % config.BREAK_RUN == 0).select("series_id", "break_date")


def harmonic_design(dates: pd.Series, harmonics: int = config.HARMONICS) -> np.ndarray:
    t = dates.dt.dayofyear.to_numpy() / 365.25
    return np.column_stack([np.ones(len(t))] + [f(2 * np.pi * k * t) for k in range(1, harmonics + 1) for f in (np.cos, np.sin)])


def harmonic_fit(series: DataFrame, harmonics: int = config.HARMONICS) -> DataFrame:
    """Least squares of a mean and ``harmonics`` yearly waves: ``series_id, n, coefficients, rmse``; zeros and null with too few points."""

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        d = pdf.dropna(subset=["value"])
        x, k = harmonic_design(pd.to_datetime(d["date"]), harmonics), 1 + 2 * harmonics
        if len(d) < k:
            return pd.DataFrame([{"series_id": pdf["series_id"].iloc[0], "n": len(d), "coefficients": [0.0] * k, "rmse": None}])
        beta = np.linalg.lstsq(x, d["value"].to_numpy(), rcond=None)[0]
        rmse = float(np.sqrt(np.mean((d["value"].to_numpy() - x @ beta) ** 2)))
        return pd.DataFrame([{"series_id": pdf["series_id"].iloc[0], "n": len(d), "coefficients": beta.tolist(), "rmse": rmse}])

    return series.select("series_id", "date", "value").groupBy("series_id").applyInPandas(fit, "series_id long, n long, coefficients array<double>, rmse double")


def detect_breaks_harmonic(series: DataFrame, history_end: str, harmonics: int = config.HARMONICS) -> DataFrame:
    """``series_id, break_date, value, expected, anomaly``: breaks after ``history_end`` relative to the waves fitted up to it; none without a fit."""
    day = F.col("date") <= F.lit(history_end).cast("date")
    fit = harmonic_fit(series.where(day), harmonics).where("rmse is not null").select("series_id", "coefficients", "rmse")
    t = F.dayofyear("date") / F.lit(365.25)
    expected = F.col("coefficients")[0]
    for k in range(1, harmonics + 1):
        for j, f in enumerate((F.cos, F.sin)):
            expected = expected + F.col("coefficients")[2 * k - 1 + j] * f(2 * math.pi * k * t)
    later = series.where(~day).join(fit, "series_id").withColumn("expected", expected).withColumn("residual", F.col("value") - F.col("expected"))
    found = break_points(later).withColumnRenamed("break_date", "date")
    return found.join(later, ["series_id", "date"]).select("series_id", F.col("date").alias("break_date"), "value", "expected", F.col("residual").alias("anomaly"))


#: Fixed values of Hart's rational approximation of the normal tail, highest power first.
TAIL_NUMERATOR = (3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931, 220.206867912376)
TAIL_DENOMINATOR = (8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752)


def normal_tail(z: Column) -> Column:
    """Share of the standard normal distribution above ``z`` of 0 or more, to about 1e-15; Spark has no erf."""
    poly = lambda c: functools.reduce(lambda a, x: a * z + x, c[1:], F.lit(c[0]))
    far = z + 0.65
    for k in (4.0, 3.0, 2.0, 1.0):
        far = z + F.try_divide(F.lit(k), far)
    bell = F.exp(-z * z / 2)
    near = bell * poly(TAIL_NUMERATOR) / poly(TAIL_DENOMINATOR)
    return F.when(z > 37, 0.0).when(z < 7.07106781186547, near).otherwise(bell / far / 2.506628274631)


def trends(series: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Mann-Kendall with its two-sided p and verdict, Sen's slope with its intercept, and a line that sums them up."""
    mk = mann_kendall(series)
    mk = mk.withColumn("p_value", F.when(F.col("n") >= 4, F.round(2 * normal_tail(F.abs("z")), 6)).otherwise(1.0))
    mk = mk.withColumn("significant", F.col("p_value") < alpha)
    kind = F.when(F.col("n") < 4, "insufficient_data").when(F.col("significant") & (F.col("s") > 0), "increasing").when(F.col("significant"), "decreasing").otherwise("no_trend")
    out = mk.withColumn("trend", kind).join(sen_slope(series), "series_id", "left")
    summary = F.struct("trend", "significant", F.col("slope").alias("slope_per_year"), F.col("n").alias("n_observations"))
    return out.withColumn("summary", F.to_json(summary))


def _digamma(x: float) -> float:
    out = 0.0
    while x < 8:
        out, x = out - 1 / x, x + 1
    f = 1 / (x * x)
    return out + math.log(x) - 0.5 / x - f * (1 / 12 - f * (1 / 120 - f / 252))


def gamma_fit(x: np.ndarray) -> tuple[float, float]:
    """Maximum likelihood shape and scale, location 0, by bisection on log(k) - digamma(k)."""
    s = math.log(x.mean()) - np.log(x).mean()
    lo, hi = 1e-4, 1e8
    for _ in range(200):
        mid = math.sqrt(lo * hi)
        lo, hi = (mid, hi) if math.log(mid) - _digamma(mid) > s else (lo, mid)
    return lo, x.mean() / lo


def gamma_cdf(a: float, x: float) -> float:
    """Regularised lower incomplete gamma function: series below a + 1, continued fraction above."""
    if x <= 0:
        return 0.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        n = a
        while abs(term) > 1e-15 * abs(total):
            n += 1
            term *= x / n
            total += term
        return front * total
    b, c = x + 1 - a, 1e300
    d = h = 1 / b
    for i in range(1, 500):
        an = -i * (i - a)
        b += 2
        d, c = 1 / (an * d + b), b + an / c
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return 1 - front * h


def spi(values: np.ndarray) -> float:
    """Standardised precipitation index of the last value against all that are there."""
    target, ref = values[-1], values[~np.isnan(values)]
    if np.isnan(target):
        return 0.0
    wet = ref[ref > 0]
    if len(wet) < config.SPI_MIN_REFERENCE:
        sd = ref.std() if len(ref) > 1 else 1.0
        return float((target - ref.mean()) / sd) if sd > 0 else 0.0
    if wet.std() < 1e-10:
        return 0.0
    shape, scale = gamma_fit(wet)
    q = float((ref == 0).mean())
    p = q + (1 - q) * gamma_cdf(shape, target / scale) if target > 0 else q
    return NormalDist().inv_cdf(min(max(p, config.SPI_CLIP), 1 - config.SPI_CLIP))


def spi3(series: DataFrame) -> DataFrame:
    """``series_id, spi3`` of 3-month sums, the last against all; 0 with fewer than two sums."""

    def kernel(pdf: pd.DataFrame) -> pd.DataFrame:
        v = pdf.sort_values("date")["value"].to_numpy(float)
        sums = np.convolve(v, np.ones(3), "valid") if len(v) >= 3 else np.zeros(0)
        return pd.DataFrame([{"series_id": pdf["series_id"].iloc[0], "spi3": spi(sums) if len(sums) >= 2 else 0.0}])

    return series.select("series_id", "date", "value").groupBy("series_id").applyInPandas(kernel, "series_id long, spi3 double")


def _loess(x: np.ndarray, y: np.ndarray, w: np.ndarray, span: int, at: np.ndarray) -> np.ndarray:
    """Local linear fits with tricube weights over the ``span`` nearest points."""
    out = np.empty(len(at))
    n = len(x)
    q = min(span, n)
    for i, t in enumerate(at):
        lo = min(max(int(np.searchsorted(x, t)) - q, 0), n - q)
        while lo + q < n and x[lo + q] - t < t - x[lo]:
            lo += 1
        xs, ys = x[lo : lo + q], y[lo : lo + q]
        h = max(t - xs[0], xs[-1] - t) + (span - n) // 2 * (span > n)
        d = np.abs(xs - t) / max(h, 1e-12)
        k = np.where(d < 0.999, (1 - np.minimum(d, 1) ** 3) ** 3, 0) * w[lo : lo + q]
        k[d <= 0.001] = w[lo : lo + q][d <= 0.001]
        total = k.sum()
        if total <= 0:
            out[i] = ys.mean()
            continue
        k = k / total
        m = (k * xs).sum()
        var = (k * (xs - m) ** 2).sum()
        slope = (t - m) / var if var > 1e-9 * max(1.0, (x[-1] - x[0]) ** 2) else 0.0
        out[i] = (k * (1 + slope * (xs - m)) * ys).sum()
    return out


def stl_decompose(y: np.ndarray, period: int, seasonal: int = 7, inner: int = 2, outer: int = 15) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Robust seasonal-trend decomposition by LOESS; trend alone with under two periods."""
    n = len(y)
    if n < 2 * period:
        return y.copy(), np.zeros(n), np.zeros(n)
    odd = lambda v: int(math.ceil(v)) | 1
    span_t, span_l = odd(1.5 * period / (1 - 1.5 / seasonal)), odd(period + 1e-9)
    x, w, trend = np.arange(n, dtype=float), np.ones(n), np.zeros(n)
    mean = lambda v, k: np.convolve(v, np.ones(k) / k, "valid")
    for _ in range(outer):
        for _ in range(inner):
            cycle = np.empty(n + 2 * period)
            for p in range(period):
                sub = np.arange(p, n, period)
                k = np.arange(len(sub), dtype=float)
                cycle[p::period] = _loess(k, (y - trend)[sub], w[sub], seasonal, np.arange(-1, len(sub) + 1, dtype=float))
            low = _loess(x, mean(mean(mean(cycle, period), period), 3), np.ones(n), span_l, x)
            season = cycle[period : period + n] - low
            trend = _loess(x, y - season, w, span_t, x)
        r = np.abs(y - season - trend)
        h = 6 * np.median(r)
        w = np.where(r <= 0.001 * h, 1.0, np.where(r <= 0.999 * h, (1 - np.minimum(r / max(h, 1e-300), 1) ** 2) ** 2, 0.0))
    return trend, season, y - trend - season


def stl(series: DataFrame, period: int = config.STL_PERIOD, outer: int = 15) -> DataFrame:
    """``series_id, date, trend, seasonal, residual``; series are independent, a task each."""

    def kernel(pdf: pd.DataFrame) -> pd.DataFrame:
        d = pdf.dropna(subset=["value"]).sort_values("date").reset_index(drop=True)
        t, s, r = stl_decompose(d["value"].to_numpy(float), period, outer=outer)
        return pd.DataFrame({"series_id": d["series_id"], "date": d["date"], "trend": t, "seasonal": s, "residual": r})

    return series.select("series_id", "date", "value").groupBy("series_id").applyInPandas(kernel, "series_id long, date date, trend double, seasonal double, residual double")


def current_spi(monthly: DataFrame) -> DataFrame:
    """``series_id, spi3`` without the months behind each series' last known value; gaps inside stay."""
    last = F.max(F.when(F.col("value").isNotNull(), F.col("date"))).over(Window.partitionBy("series_id"))
    return spi3(monthly.withColumn("last", last).where(F.col("date") <= F.col("last")))
