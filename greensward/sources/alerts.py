"""Alerts and tracks going out and coming in."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from greensward.functions.detection import confidence_label
from greensward.operators.spatial import utm_inverse

ALERT = "id long, x0 double, y0 double, x1 double, y1 double, confidence int, confidence_label string, area_ha double, created_at string, detection_date date"


def to_degrees(alerts: DataFrame) -> DataFrame:
    """``west, south, east, north`` to six decimals in place of metres, from all four corners of each box."""
    corners = [utm_inverse(F.col(x).cast("double"), F.col(y).cast("double")) for x in ("x0", "x1") for y in ("y0", "y1")]
    r = lambda c: F.bround(c, 6)
    lon, lat = [c[0] for c in corners], [c[1] for c in corners]
    named = {"west": r(F.least(*lon)), "south": r(F.least(*lat)), "east": r(F.greatest(*lon)), "north": r(F.greatest(*lat))}
    return alerts.withColumns(named).drop("x0", "y0", "x1", "y1")


def save_alerts(alerts: DataFrame, path: str, created_at: Column | None = None) -> None:
    """Add label and time of writing, and replace the dates that ``alerts`` holds; other dates stay."""
    out = alerts.withColumns({"confidence_label": confidence_label(F.col("confidence")), "created_at": (F.current_timestamp() if created_at is None else created_at).cast("string")})
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("detection_date").parquet(path)


def load_alerts(spark: SparkSession, path: str, date: str | None = None) -> DataFrame:
    """The alerts of one date, an error if there are none; or of all dates, in their order, an empty table if nothing is stored."""
    from pyspark.errors import AnalysisException

    try:
        stored = spark.read.parquet(path)
    except AnalysisException:
        if date is not None:
            raise FileNotFoundError(f"no alerts of {date} in {path}") from None
        return spark.createDataFrame([], ALERT)
    if date is None:
        return stored.orderBy("detection_date", "id")
    found = stored.where(F.col("detection_date") == F.lit(date).cast("date"))
    if found.isEmpty():
        raise FileNotFoundError(f"no alerts of {date} in {path}")
    return found


def degree_rings(alerts: DataFrame, rings: str = "rings") -> DataFrame:
    """Rings of points (x, y) in metres as GeoJSON has them: pairs of degrees to six decimals, both ends the same."""

    @F.arrow_udf("array<array<array<double>>>")
    def degrees(column: pa.Array) -> pa.Array:
        """All corners of a batch at once; the lists around them stay."""
        column = pa.concat_arrays([column])
        ring = column.values
        part = dict(zip((f.name for f in ring.values.type), ring.values.flatten()))
        x, y = (np.asarray(part[c].cast(pa.float64()).fill_null(np.nan)) for c in "xy")
        pairs = np.stack(utm_inverse(x, y, m=np), 1).round(6)
        gone = np.isnan(x) | np.isnan(y)
        pair = pa.ListArray.from_arrays(np.arange(0, 2 * len(x) + 1, 2, dtype=np.int32), pa.array(pairs.ravel(), mask=np.repeat(gone, 2)))
        for lists in (ring, column):
            pair = pa.ListArray.from_arrays(pa.array(np.asarray(lists.offsets)), pair, mask=lists.is_null())
        return pair

    return alerts.withColumn(rings, degrees(F.col(rings)))


def as_features(alerts: DataFrame, properties: list[str]) -> DataFrame:
    """One GeoJSON feature a row in degrees; dates are ISO texts.

    Its geometry are the outlines in ``rings`` (outer ring first) if the alerts have them, else the box.
    """
    if "rings" in alerts.columns:
        d = degree_rings(alerts)
        coordinates = F.col("rings")
    else:
        d = to_degrees(alerts)
        corner = lambda x, y: F.array(F.col(x), F.col(y))
        coordinates = F.array(F.array(corner("west", "south"), corner("east", "south"), corner("east", "north"), corner("west", "north"), corner("west", "south")))
    text = {c: F.date_format(c, "yyyy-MM-dd") for c, t in d.dtypes if t == "date" and c in properties}
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"), F.struct(F.lit("Polygon").alias("type"), coordinates.alias("coordinates")).alias("geometry"))
    return d.withColumns(text).select(F.to_json(feature).alias("value"))


def save_features(alerts: DataFrame, path: str, properties: list[str], date: str = "detection_date") -> None:
    """GeoJSON lines, a folder for each date; the dates that ``alerts`` holds are replaced, others stay."""
    lines = as_features(alerts.withColumn("_date", F.col(date)), [*properties, "_date"])
    day = F.get_json_object("value", "$.properties._date")
    lines.select("value", day.alias(date)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date).text(path)


def track_features(tracks: DataFrame) -> DataFrame:
    """The state of tracks as compact GeoJSON features to six decimals."""
    return as_features(tracks, ["n_sightings", "first_seen", "last_seen"])


def merge_tiles(tiles: list[DataFrame]) -> DataFrame:
    """All tiles' alerts together; what tiles share at their edges stays twice."""
    out = tiles[0]
    for t in tiles[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out
