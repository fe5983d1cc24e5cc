"""Baselines that grow scene by scene against one pass, replays and broken runs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from greensward.sources.running import RunningBaselines, baseline, merged, states

def values():
    return {"a": F.col("v"), "b": F.col("v") * 1e-3 + 1e6}


@pytest.fixture(scope="module")
def obs(spark):
    rng = np.random.default_rng(4)
    rows = [(f"s{k % 12:02d}", f"2020-{1 + k % 3:02d}-05", int(rng.integers(6)), float(rng.normal(3, 2)) if rng.random() < 0.9 else None) for k in range(400)]
    return spark.createDataFrame(rows, "scene string, day string, pixel int, v double").withColumn("obs_date", F.to_date("day")).cache()


def figures(df):
    return {(r.index_name, r.month, r.pixel): (r.n_obs, r.center, -1 if r.std is None else r.std) for r in df.collect()}


def same(a, b):
    assert set(a) == set(b)
    for k in a:
        assert a[k][0] == b[k][0] and a[k][1:] == pytest.approx(b[k][1:], rel=1e-9, abs=1e-7)


def test_increments_equal_one_pass(spark, obs, tmp_path):
    want = figures(baseline(states(obs, values())))
    one = {r.pixel: (r.n, r.m, r.s) for r in obs.where("month(obs_date) = 2").groupBy("pixel").agg(F.count("v").alias("n"), F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).collect()}
    assert all(want["a", 2, p] == pytest.approx(x) for p, x in one.items())
    store = RunningBaselines(spark, str(tmp_path / "store"))
    assert store.states().count() == 0
    for k in range(4):
        assert store.add(obs.where(F.substring("scene", 2, 2).cast("int") % 4 == k), values()) == 3
    same(figures(baseline(store.states())), want)
    # all of it again, and a part: nothing is added, and no version is written
    before = store.versions()
    assert store.add(obs, values()) == store.add(obs.where("scene = 's01'"), values()) == 0
    assert store.versions() == before == [0, 1, 2, 3]
    same(figures(baseline(store.states())), want)


def test_a_broken_version_does_not_count(spark, obs, tmp_path):
    store = RunningBaselines(spark, str(tmp_path / "store"))
    store.add(obs.where("scene < 's06'"), values())
    kept = figures(baseline(store.states()))
    (tmp_path / "store" / "version=1" / "states").mkdir(parents=True)
    (tmp_path / "store" / "version=1" / "states" / "_SUCCESS").write_text("")
    same(figures(baseline(store.states())), kept)
    assert store.add(obs, values()) == 6
    same(figures(baseline(store.states())), figures(baseline(states(obs, values()))))


def test_single_observations_and_null_scenes(spark, obs, tmp_path):
    store = RunningBaselines(spark, str(tmp_path / "store"))
    row = obs.where("v is not null").limit(1).withColumn("scene", F.lit(None).cast("string"))
    assert store.add(row, values()) == 0 and store.add(obs.where("false"), values()) == 0
    one = states(row, values())
    assert {r.std for r in baseline(one).collect()} == {None} and {r.std for r in baseline(one, 1).collect()} == {0.0}
    two = {r.index_name: r for r in merged(one, one).collect()}
    assert two["a"].n == 2 and two["a"].m2 == 0 and two["a"].mean == pytest.approx(one.where("index_name = 'a'").first().mean)
