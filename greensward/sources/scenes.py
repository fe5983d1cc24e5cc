"""Scene catalogues, object keys, band tables and GeoJSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from greensward import config


def search(scenes: DataFrame, start: str, end: str, max_cloud: float = config.MAX_CLOUD, max_items: int | None = 50, missing_cloud: float | None = None, bbox: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Scenes of the dates (both included) with less cloud that meet the box; a missing value fails unless ``missing_cloud`` stands for it."""
    cloud = F.col("cloud_cover") if missing_cloud is None else F.coalesce("cloud_cover", F.lit(missing_cloud))
    found = scenes.where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")) & (cloud < max_cloud))
    if bbox is not None:
        west, south, east, north = bbox
        found = found.where((F.col("west") <= east) & (F.col("east") >= west) & (F.col("south") <= north) & (F.col("north") >= south))
    return found if max_items is None else found.orderBy(F.desc("date"), "scene_id").limit(max_items)


def or_else(first: DataFrame, second: DataFrame) -> DataFrame:
    """The second provider's scenes only if the first has none."""
    return second if first.isEmpty() else first


def clearest(sources: dict[str, DataFrame], n: int = config.MAX_SCENES) -> DataFrame:
    """All sensors' scenes, the ``n`` with least cloud; missing counts as 100."""
    out = None
    for sensor, df in sources.items():
        df = df.withColumn("sensor", F.lit(sensor))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out.orderBy(F.coalesce("cloud_cover", F.lit(100.0)), "scene_id").limit(n)


def latest_keys(keys: DataFrame, n: int, suffix: str = ".geojson") -> DataFrame:
    """The last ``n`` keys with the suffix, in order; all for ``n`` of 0 or less."""
    found = keys.where(F.col("key").endswith(suffix))
    return (found.orderBy(F.desc("key")).limit(n) if n > 0 else found).orderBy("key")


def missing_baselines(existing: DataFrame, indices: list[str]) -> DataFrame:
    """``index_name, month`` pairs without a baseline."""
    spark = existing.sparkSession
    need = spark.createDataFrame([(i, m) for i in indices for m in range(1, 13)], "index_name string, month int")
    return need.join(existing, ["index_name", "month"], "left_anti")


def split_bands(wide: DataFrame, keys: list[str], limit: float = 1.5) -> DataFrame:
    """Columns ``<index>_<stat>`` as rows ``index_name, stat, value``; sentinels and values beyond ``limit`` are null."""
    bands = [c for c in wide.columns if c not in keys]
    long = wide.unpivot(keys, bands, "band", "raw")
    v = F.col("raw")
    return long.select(*keys, F.split("band", "_")[0].alias("index_name"), F.split("band", "_")[1].alias("stat"), F.when((v > -9990) & (F.abs(v) <= limit), v).alias("value"))


def datetime_range(start: Column, end: Column, today: Column, days_back: int = config.DAYS_BACK) -> Column:
    """``first/last`` of a search: as given if both are, else the ``days_back`` days up to today."""
    iso = lambda d: F.date_format(d, "yyyy-MM-dd")
    given = start.isNotNull() & end.isNotNull()
    return F.concat_ws("/", iso(F.when(given, start).otherwise(F.date_sub(today, days_back))), iso(F.when(given, end).otherwise(today)))


def discover(names: DataFrame) -> DataFrame:
    """``date, name`` of the files whose stems hold an ISO date, in order."""
    date = F.to_date(F.regexp_extract("name", r"(\d{4}-\d{2}-\d{2})", 1))
    return names.where(F.col("name").rlike(r"\d{4}-\d{2}-\d{2}")).select(date.alias("date"), "name").orderBy("name")


def filename_metadata(name: Column) -> Column:
    """date, satellite, tile, revisit and level from ``_`` separated parts; null with fewer than six."""
    p = F.split(name, "_")
    return F.when(F.size(p) >= 6, F.struct(*[p[i].alias(n) for i, n in enumerate(("date", "satellite", "tile", "revisit", "level"))]))


def read_precipitation(spark: SparkSession, path: str) -> DataFrame:
    """``year, month, mm`` from a CSV with a header; always ordered by key, whatever the order of lines."""
    df = spark.read.csv(path, header=True, schema="year int, month int, aoi_mean_precip_mm double")
    return df.select("year", "month", F.col("aoi_mean_precip_mm").alias("mm")).orderBy("year", "month")


def precipitation_mean(cells: DataFrame, bbox: tuple[float, float, float, float], by: list[str]) -> DataFrame:
    """``by, mm``: the plain mean of the cells whose centres (lon, lat) lie in a box; negative values are no data."""
    west, south, east, north = bbox
    inside = F.col("lon").between(west, east) & F.col("lat").between(south, north)
    return cells.where(inside).groupBy(*by).agg(F.avg(F.when(F.col("v") >= 0, F.col("v"))).alias("mm"))


def read_aoi(spark: SparkSession, path: str) -> DataFrame:
    """``feature, part, ring`` of all polygons of a GeoJSON file: every polygon of a multipolygon, and every ring, holes among them."""
    f = spark.read.option("multiLine", True).schema("features array<struct<geometry:struct<type:string,coordinates:string>>>").json(path)
    g = f.select(F.posexplode("features").alias("feature", "f")).select("feature", F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("text"))
    one, many = "array<array<array<double>>>", "array<array<array<array<double>>>>"
    polygons = F.when(F.col("kind") == "Polygon", F.array(F.from_json("text", one))).otherwise(F.from_json("text", many))
    return g.select("feature", F.explode(polygons).alias("p")).select("feature", F.posexplode("p").alias("part", "ring"))


def total_bounds(rings: DataFrame) -> DataFrame:
    """One row ``west, south, east, north`` over the vertices of all rings."""
    v = rings.select(F.explode("ring").alias("p"))
    x, y = F.col("p")[0], F.col("p")[1]
    return v.agg(F.min(x).alias("west"), F.min(y).alias("south"), F.max(x).alias("east"), F.max(y).alias("north"))


def files_by_date(names: DataFrame, first_year: int | None = None, last_year: int | None = None) -> DataFrame:
    """``date, n_files, names`` of the files whose names start with eight digits; both years are included."""
    year = F.substring("name", 1, 4).cast("int")
    found = names.where(F.col("name").rlike(r"^\d{8}"))
    if first_year is not None:
        found = found.where(year >= first_year)
    if last_year is not None:
        found = found.where(year <= last_year)
    return found.groupBy(F.substring("name", 1, 8).alias("date")).agg(F.count(F.lit(1)).alias("n_files"), F.array_join(F.sort_array(F.collect_list("name")), ",").alias("names"))


def merge_lines(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Every distinct line once; a changed value is another line."""
    return stored.union(new).distinct()


def month_range(precipitation: DataFrame, first: str, last: str, by: str = "series_id") -> DataFrame:
    """A row for each series and month from ``first`` to ``last``, both included; null where nothing is known."""
    months = F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 month")))
    spine = precipitation.select(by).distinct().select(by, months.alias("date"))
    return spine.join(precipitation.select(by, "date", "value"), [by, "date"], "left")
