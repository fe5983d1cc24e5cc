"""Scenes of a sensor as clear reflectance on one grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greensward import config
from greensward.functions import indices as ix
from greensward.operators import spatial

_CLEAR = {"s2": ix.clear_scl, "landsat": ix.clear_landsat, "hls": ix.clear_hls}


def asset_key(sensor: str, band: str) -> str:
    """The key of a band among a scene's assets."""
    if band not in config.ASSETS.get(sensor, {}):
        raise ValueError(f"no band {band!r} of sensor {sensor!r}")
    return config.ASSETS[sensor][band]


def asset_of(sensor: Column, band: Column) -> Column:
    """``asset_key`` by row; null where the sensor doesn't have the band."""
    known = F.create_map(*[F.lit(x) for s, m in config.ASSETS.items() for b, a in m.items() for x in (f"{s}/{b}", a)])
    return F.try_element_at(known, F.concat_ws("/", sensor, band))


def bands_for(names: list[str], sensor: str) -> list[str]:
    """The bands that some indices of a sensor need, in order, and its class band."""
    if sensor not in config.ASSETS:
        raise ValueError(f"unknown sensor {sensor!r}; known: {sorted(config.ASSETS)}")
    swap = {"nir": "nir08"} if sensor in ("landsat", "hls") else {}
    need = {swap.get(b, b) for n in names for b in config.INDEX_BANDS[n]}
    return [*sorted(need), config.CLASS_BANDS[sensor]]


def load_scene(assets: DataFrame, sensor: str, names: list[str], keys: list[str], date: str = "obs_date", processing: str | None = None) -> DataFrame:
    """``keys`` and the bands of the indices as reflectance, null where the class band isn't clear; that band goes.

    ``assets`` has a column for each asset key, so only what the indices need is
    read. An asset's own scale and offset come first if there are columns
    ``<key>_scale`` and ``<key>_offset``; then the processing baseline, if its
    column is named, and the date decide. Class bands are never scaled.
    """
    bands = bands_for(names, sensor)
    clear = _CLEAR[sensor](F.col(asset_key(sensor, bands[-1])))
    level = None if processing is None else F.col(processing).cast("double")

    def scaled(band: str) -> Column:
        key = asset_key(sensor, band)
        own = (F.col(f"{key}_scale"), F.col(f"{key}_offset")) if {f"{key}_scale", f"{key}_offset"} <= set(assets.columns) else None
        return ix.masked(ix.reflectance(F.col(key), *ix.scale_offset(F.lit(sensor), F.col(date), level, own=own)), clear)

    return assets.select(*keys, *[scaled(b).alias(b) for b in bands[:-1]])


def stack_bands(bands: dict[str, DataFrame], x0: float, y0: float, res: float, tolerance: float) -> DataFrame:
    """``row, col`` and a column for each band: points ``x, y, value`` that lie within ``tolerance`` of a cell centre on each axis.

    The first band leads; other bands are joined to its cells by equality, and a
    cell that they miss is null. Of points that fall in one cell the first in
    the order of y, x counts.
    """
    out = None
    for name, points in bands.items():
        at = points.select(spatial.snap(F.col("y"), y0, res, tolerance).alias("row"), spatial.snap(F.col("x"), x0, res, tolerance).alias("col"), F.struct("y", "x", "value").alias("p"))
        cells = at.where("row is not null and col is not null").groupBy("row", "col").agg(F.min("p")["value"].alias(name))
        out = cells if out is None else out.join(cells, ["row", "col"], "left")
    return out


def shift_dn(pixels: DataFrame, scene: str, dn: str, sample: int = 512, shift: float = 1000.0, least: float = 200.0) -> DataFrame:
    """Scenes in old units get ``shift`` added: those whose median over the top left ``sample`` x ``sample`` cells is above ``least``. Off by default in the engine."""
    corner = pixels.where((F.col("row") < sample) & (F.col("col") < sample) & F.col(dn).isNotNull())
    old = corner.groupBy(F.col(scene).alias("_scene")).agg(F.median(dn).alias("_median")).where(F.col("_median") > least)
    out = pixels.join(old, F.col(scene) == F.col("_scene"), "left")
    return out.withColumn(dn, F.when(F.col("_median").isNotNull(), F.col(dn) + shift).otherwise(F.col(dn))).drop("_scene", "_median")


def load_composite(cells: DataFrame, keys: list[str], bands: tuple[str, ...] = ("evi2", "ndmi", "nbr", "bsi"), sentinel: float = -9990.0) -> DataFrame:
    """The bands of a composite with the sentinel as null; the last band may be missing, and is null then."""
    missing = [b for b in bands[:-1] if b not in cells.columns]
    if missing:
        raise ValueError(f"the composite has no {', '.join(missing)}")
    band = lambda b: ix.sentinel_to_null(F.col(b), sentinel) if b in cells.columns else F.lit(None).cast("double")
    return cells.select(*keys, *[band(b).alias(b) for b in bands])


class SceneCache:
    """Clipped scenes as one Parquet folder each; a scene that is there is read, and held against the clear share again."""

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def get(self, key: str, build, clear: Column, least: float) -> DataFrame | None:
        """The scene, built and written if it isn't there; none if too little of it is clear."""
        from pyspark.errors import AnalysisException

        where = f"{self.path}/scene={key}"
        try:
            rows = self.spark.read.parquet(where)
        except AnalysisException:
            build().write.mode("overwrite").parquet(where)
            rows = self.spark.read.parquet(where)
        share = rows.agg((100.0 * F.count_if(F.coalesce(clear, F.lit(False))) / F.count(F.lit(1))).alias("p")).first().p
        return rows if share is not None and share >= least else None
