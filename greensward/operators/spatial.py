"""Grids, tiles, and joins of boxes by cell buckets."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Metres of a degree of latitude, and of longitude at the equator.
METRES_LAT, METRES_LON = 110_540.0, 111_320.0


def snap(coordinate: Column, origin: float, res: float, tolerance: float) -> Column:
    """Index of the nearest cell centre within ``tolerance``, else null; halves go up."""
    k = F.floor((coordinate - origin) / res)
    return F.when(F.abs(coordinate - (origin + (k + 0.5) * res)) <= tolerance, k)


def tile_grids(extents: DataFrame, by: list[str], res: float = 20.0, tile_px: int = 1024) -> DataFrame:
    """``by, tile_row, tile_col, west, south, east, north``: rectangles of at most ``tile_px`` cells a side that cover each extent in degrees.

    Extents without an area, or with a null side, have no tiles.
    """
    dy = F.lit(tile_px * res / METRES_LAT)
    dx = tile_px * res / (METRES_LON * F.cos(F.radians((F.col("south") + F.col("north")) / 2)))
    count = lambda low, high, step: F.sequence(F.lit(0), (F.ceil((F.col(high) - F.col(low)) / step) - 1).cast("int"))
    e = extents.where("west < east and south < north").select(*by, "west", "south", "east", "north", dx.alias("dx"), dy.alias("dy"))
    e = e.withColumn("tile_row", F.explode(count("south", "north", F.col("dy")))).withColumn("tile_col", F.explode(count("west", "east", F.col("dx"))))
    x, y = (lambda k: F.col("west") + k * F.col("dx")), (lambda k: F.col("south") + k * F.col("dy"))  # one line for both tiles that meet at it
    row, col = F.col("tile_row"), F.col("tile_col")
    return e.select(*by, "tile_row", "tile_col", x(col).alias("west"), y(row).alias("south"), F.least(x(col + 1), "east").alias("east"), F.least(y(row + 1), "north").alias("north"))


def tile_grid(spark: SparkSession, west: float, south: float, east: float, north: float, res: float = 20.0, tile_px: int = 1024) -> DataFrame:
    """Rectangles of at most ``tile_px`` cells a side that cover a box in degrees."""
    if not (west < east and south < north):
        raise ValueError("bounds must have west < east and south < north")
    box = spark.range(1).select(*[F.lit(float(v)).alias(c) for c, v in (("west", west), ("south", south), ("east", east), ("north", north))])
    return tile_grids(box, [], res, tile_px)


def box_pairs(a: DataFrame, b: DataFrame, on: list[str], bucket: int = 100, *, corners: bool = False, carry: list[str] | None = None) -> DataFrame:
    """Pairs of boxes that share some area, and that area; with ``corners`` also the box that they share, and the columns ``carry`` of ``a``.

    ``a`` and ``b`` have ``id, x0, y0, x1, y1`` and the keys ``on``. A box has
    the level at which buckets (``bucket``, doubled for each level) are as large
    as its longer side; it goes to the four buckets or fewer that it touches at
    that level and at each higher one that occurs, and a pair meets at the
    higher level of its two. So a large box costs no more rows than a small one.
    The equality join on keys, level and bucket replaces a nested loop, and a
    pair counts in the bucket of its common corner alone.
    """
    side = lambda: F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"), F.lit(1))
    own = lambda: F.greatest(F.ceil(F.log2(side() / F.lit(float(bucket))) - 1e-9), F.lit(0)).cast("int")
    levels = sorted({r.lv for d in (a, b) for r in d.select(own().alias("lv")).distinct().collect()})  # a few dozens at most
    cut = lambda c: F.floor(c / (F.lit(float(bucket)) * F.pow(F.lit(2.0), F.col("level"))))

    def dealt(d: DataFrame, p: str, *more: str) -> DataFrame:
        d = d.withColumn(f"{p}_level", own())
        d = d.select(*on, *more, f"{p}_level", *[F.col(c).alias(f"{p}_{c}") for c in ("id", "x0", "y0", "x1", "y1")])
        d = d.withColumn("level", F.explode(F.filter(F.array(*map(F.lit, levels or [0])), lambda v: v >= F.col(f"{p}_level"))))
        d = d.withColumn("bx", F.explode(F.sequence(cut(F.col(f"{p}_x0")), cut(F.col(f"{p}_x1")))))
        return d.withColumn("by", F.explode(F.sequence(cut(F.col(f"{p}_y0")), cut(F.col(f"{p}_y1")))))

    j = dealt(a, "a", *(carry or [])).join(dealt(b, "b"), [*on, "level", "bx", "by"]).where(F.greatest("a_level", "b_level") == F.col("level"))
    left, low = F.greatest("a_x0", "b_x0"), F.greatest("a_y0", "b_y0")
    w, h = F.least("a_x1", "b_x1") - left, F.least("a_y1", "b_y1") - low
    return j.where((w > 0) & (h > 0) & (cut(left) == F.col("bx")) & (cut(low) == F.col("by"))).select(*on, F.col("a_id"), F.col("b_id"), (w * h).alias("overlap"), *(carry or []), *([left.alias("x0"), low.alias("y0"), (left + w).alias("x1"), (low + h).alias("y1")] if corners else []))


# WGS84 to UTM by the Krueger series to the third order; zone 24 south by default.
_A, _F = 6378137.0, 1 / 298.257223563
_N = _F / (2 - _F)
_R = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
_DELTA = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15)
_K0, _E0, _N0 = 0.9996, 500_000.0, 10_000_000.0


def utm_forward(lon, lat, central: float = -39.0, m=F):
    """Easting and northing of the southern half; of columns, or of arrays with ``m=numpy``."""
    phi, lam = m.radians(lat), m.radians(lon - central)
    c = 2 * math.sqrt(_N) / (1 + _N)
    t = m.sinh(m.atanh(m.sin(phi)) - c * m.atanh(c * m.sin(phi)))
    xi, eta = m.atan2(t, m.cos(lam)), m.atanh(m.sin(lam) / m.sqrt(1 + t * t))
    e, n = eta, xi
    for j, a in enumerate(_ALPHA, 1):
        e = e + a * m.cos(2 * j * xi) * m.sinh(2 * j * eta)
        n = n + a * m.sin(2 * j * xi) * m.cosh(2 * j * eta)
    return _E0 + _K0 * _R * e, _N0 + _K0 * _R * n


def utm_inverse(east, north, central: float = -39.0, m=F):
    """Longitude and latitude; of columns, or of arrays with ``m=numpy``."""
    xi, eta = (north - _N0) / (_K0 * _R), (east - _E0) / (_K0 * _R)
    x, y = xi, eta
    for j, b in enumerate(_BETA, 1):
        x = x - b * m.sin(2 * j * xi) * m.cosh(2 * j * eta)
        y = y - b * m.cos(2 * j * xi) * m.sinh(2 * j * eta)
    chi = m.asin(m.sin(x) / m.cosh(y))
    lat = chi
    for j, d in enumerate(_DELTA, 1):
        lat = lat + d * m.sin(2 * j * chi)
    return central + m.degrees(m.atan2(m.sinh(y), m.cos(x))), m.degrees(lat)


def point_in_ring(x: Column, y: Column, ring: list[tuple[float, float]]) -> Column:
    """Even-odd rule over the ring's edges, as one expression."""
    inside = F.lit(False)
    for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1], strict=True):
        if y0 != y1:
            crosses = ((y < y0) != (y < y1)) & (x < (x1 - x0) * (y - y0) / (y1 - y0) + x0)
            inside = inside != crosses
    return inside
