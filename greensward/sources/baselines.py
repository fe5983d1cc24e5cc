"""The store of monthly baselines: Parquet by index and month."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_baselines(wide: DataFrame, path: str, names: list[str]) -> None:
    """``month, pixel`` with ``<index>_center, _std, _n`` as rows, a folder for each index and month; months that are written replace stored ones."""
    one = [F.struct(F.lit(n).alias("index_name"), F.col(f"{n}_center").alias("center"), F.col(f"{n}_std").alias("std"), F.col(f"{n}_n").alias("n_obs")) for n in names]
    rows = wide.select("pixel", "month", F.inline(F.array(*one)))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("index_name", "month").parquet(path)


def load_baseline(spark: SparkSession, path: str, index: str, month: int) -> DataFrame:
    """``pixel, center, std, n_obs`` of one index and month; only its folder is read. An error if there is none."""
    if not 1 <= month <= 12:
        raise ValueError(f"no month {month}")
    found = spark.read.parquet(path).where((F.col("index_name") == index) & (F.col("month") == month)).drop("index_name", "month")
    if found.isEmpty():
        raise FileNotFoundError(f"no baseline of {index} for month {month} in {path}")
    return found


def load_pair(spark: SparkSession, path: str, index: str, month: int) -> tuple[DataFrame, DataFrame]:
    """The centre and the spread of a baseline, each with its pixels."""
    both = load_baseline(spark, path, index, month)
    return both.select("pixel", F.col("center").alias("value")), both.select("pixel", F.col("std").alias("value"))


def stored_pairs(spark: SparkSession, path: str) -> DataFrame:
    """``index_name, month`` of what is stored."""
    return spark.read.parquet(path).select("index_name", "month").distinct()
