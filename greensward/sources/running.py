"""Baselines that grow: stored counts, means and squares that new scenes are merged into."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from greensward.plans.scratch import Scratch, _path

STATE = "index_name string, month int, pixel bigint, n bigint, mean double, m2 double"


def states(obs: DataFrame, values: dict[str, Column]) -> DataFrame:
    """``index_name, month, pixel, n, mean, m2`` of each pixel's values that are there: count, mean and sum of squares about the mean."""
    kept = F.inline(F.array(*[F.struct(F.lit(k).alias("index_name"), v.cast("double").alias("v")) for k, v in values.items()]))
    rows = obs.select(F.month("obs_date").alias("month"), F.col("pixel").cast("long").alias("pixel"), kept).where("v is not null")
    n = F.count("v")
    return rows.groupBy("index_name", "month", "pixel").agg(n.alias("n"), F.avg("v").alias("mean"), (F.var_pop("v") * n).alias("m2"))


def merged(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two tables of states as one, by the pairwise formula; what only one of them holds stays as it is."""
    keys = ["index_name", "month", "pixel"]
    j = a.alias("a").join(b.alias("b"), keys, "full_outer")
    na, nb = (F.coalesce(f"{t}.n", F.lit(0)).cast("long") for t in "ab")
    ma, mb = F.coalesce("a.mean", "b.mean"), F.coalesce("b.mean", "a.mean")
    apart = mb - ma
    return j.select(*keys, (na + nb).alias("n"), (ma + apart * nb / (na + nb)).alias("mean"), (F.coalesce("a.m2", F.lit(0.0)) + F.coalesce("b.m2", F.lit(0.0)) + apart * apart * na * nb / (na + nb)).alias("m2"))


def baseline(state: DataFrame, min_obs_std: int = 2) -> DataFrame:
    """``index_name, month, pixel, center, std, n_obs``: mean and population spread, null under ``min_obs_std`` observations."""
    std = F.when(F.col("n") >= min_obs_std, F.sqrt(F.greatest(F.col("m2"), F.lit(0.0)) / F.col("n")))
    return state.select("index_name", "month", "pixel", F.col("mean").alias("center"), std.alias("std"), F.col("n").alias("n_obs"))


class RunningBaselines:
    """States and the scenes that are in them, a folder for each version; the last whole version counts.

    The list of scenes is written after the states, and a version without both
    is as if it weren't there: a run that dies leaves the version before it, and
    one that is repeated finds its scenes on the list and adds nothing.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def versions(self) -> list[int]:
        path, fs = _path(self.spark, self.path)
        if not fs.exists(path):
            return []
        found = [s.getPath().getName() for s in fs.listStatus(path) if s.getPath().getName().startswith("version=")]
        whole = lambda name: all(fs.exists(_path(self.spark, f"{self.path}/{name}/{part}/_SUCCESS")[0]) for part in ("states", "scenes"))
        return sorted(int(n.removeprefix("version=")) for n in found if whole(n))

    def _read(self, part: str, schema: str) -> DataFrame:
        have = self.versions()
        if not have:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/version={have[-1]}/{part}")

    def states(self) -> DataFrame:
        return self._read("states", STATE)

    def scenes(self) -> DataFrame:
        return self._read("scenes", "scene string")

    def add(self, obs: DataFrame, values: dict[str, Column], scene: str = "scene") -> int:
        """Merge the observations of scenes that aren't on the list; the number of scenes added. Null scenes are left out."""
        scratch = Scratch(self.spark, "running")
        named = obs.where(F.col(scene).isNotNull()).withColumn("_scene", F.col(scene).cast("string"))
        old = self.scenes().withColumnRenamed("scene", "_scene")
        fresh = scratch.put(named.select("_scene").distinct().join(old, "_scene", "left_anti"), "fresh")
        n = fresh.count()
        if n:
            version = f"{self.path}/version={max(self.versions(), default=-1) + 1}"
            new = states(named.join(scratch.small(fresh), "_scene", "left_semi"), values)
            merged(self.states(), new).write.mode("overwrite").parquet(f"{version}/states")
            old.unionByName(fresh).select(F.col("_scene").alias("scene")).write.mode("overwrite").parquet(f"{version}/scenes")
        scratch.keep()
        return n
