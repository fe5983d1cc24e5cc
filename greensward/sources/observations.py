"""Tables of the driver read as observations, series, boxes, zones and rasters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixel observations out of ``lineitem``; only the bands that are used are read."""
    t = table(spark, sf_dir, "lineitem")
    c = F.col
    return t.select(
        (c("l_orderkey") * 10 + c("l_linenumber")).alias("obs_id"),
        c("l_suppkey").alias("pixel"),
        c("l_shipdate").cast("date").alias("obs_date"),
        c("l_discount").alias("red"),
        c("l_tax").alias("blue"),
        (c("l_quantity") / 50.0).alias("nir"),
        (c("l_extendedprice") / 100000.0).alias("nir08"),
        (c("l_linenumber").cast("double") / 10.0).alias("swir16"),
        (c("l_discount") * 4.0).alias("swir22"),
        (c("l_orderkey") % 12).cast("int").alias("scl"),
        (c("l_partkey") % 32).cast("int").alias("qa"),
        c("l_partkey").alias("dn"),
    )


OBS_SQL = """obs AS (SELECT l_orderkey * 10 + l_linenumber AS obs_id, l_suppkey AS pixel, CAST(l_shipdate AS DATE) AS obs_date,
  l_discount AS red, l_tax AS blue, l_quantity / 50.0::DOUBLE AS nir, l_extendedprice / 100000.0::DOUBLE AS nir08,
  l_linenumber::DOUBLE / 10.0::DOUBLE AS swir16, l_discount * 4.0::DOUBLE AS swir22,
  (l_orderkey % 12)::INT AS scl, (l_partkey % 32)::INT AS qa, l_partkey AS dn FROM lineitem)"""


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Square alerts of side 100 by month, out of ``orders``."""
    o = table(spark, sf_dir, "orders")
    x, y = (F.col("o_custkey") * 37) % 1500 + F.col("o_orderkey") % 110, (F.col("o_custkey") * 91) % 1500 + (F.col("o_orderkey") * 7) % 110
    month = F.trunc(F.col("o_orderdate").cast("date"), "month")
    return o.select(F.col("o_orderkey").alias("id"), month.alias("date"), x.alias("x0"), y.alias("y0"), (x + 100).alias("x1"), (y + 100).alias("y1"))


BOX_SQL = """box AS (SELECT o_orderkey AS id, CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
  (o_custkey * 37) % 1500 + o_orderkey % 110 AS x0, (o_custkey * 91) % 1500 + (o_orderkey * 7) % 110 AS y0,
  (o_custkey * 37) % 1500 + o_orderkey % 110 + 100 AS x1, (o_custkey * 91) % 1500 + (o_orderkey * 7) % 110 + 100 AS y1
  FROM orders)"""


def raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each embedding as an 8 x 8 raster: ``img, row, col, v``."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("img"), F.posexplode("embedding").alias("k", "v"))
    return e.select("img", F.floor(F.col("k") / 8).cast("int").alias("row"), (F.col("k") % 8).alias("col"), F.col("v").cast("double").alias("v"))


RASTER_SQL = """raster AS (SELECT vec_id AS img, ((k - 1) // 8)::INT AS "row", ((k - 1) % 8)::INT AS col, embedding[k]::DOUBLE AS v
  FROM embeddings, range(1, 65) t(k))"""


def dated_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty images in a row, two columns apart, for each date: ``date`` (its number), ``row, col, v``."""
    r = raster(spark, sf_dir)
    return r.select(F.floor(F.col("img") / 50).alias("date"), "row", ((F.col("img") % 50) * 10 + F.col("col")).cast("int").alias("col"), "v")


def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean event value by user and day: ``series_id, date, value``."""
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.col("user_id").alias("series_id"), F.col("ts").cast("date").alias("date")).agg(F.round(F.avg("value"), 6).alias("value"))


SERIES_SQL = """series AS (SELECT user_id AS series_id, CAST(ts AS DATE) AS date, round(avg(value), 6) AS value FROM events GROUP BY 1, 2)"""


def monthly_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean order price by customer segment of 10 and month, as a monthly series: ``series_id, date, value``."""
    o = table(spark, sf_dir, "orders")
    return o.groupBy((F.col("o_custkey") % 10).alias("series_id"), F.trunc(F.col("o_orderdate").cast("date"), "month").alias("date")).agg((F.avg("o_totalprice") / 997.0).alias("value"))


MONTHLY_SQL = """monthly AS (SELECT o_custkey % 10 AS series_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
  avg(o_totalprice) / 997.0::DOUBLE AS value FROM orders GROUP BY 1, 2)"""
