import pytest
from pyspark.sql import functions as F

from greensward.functions import detection as det
from greensward.functions import indices as ix
from greensward.operators import composites
from greensward.sources import scenes


def one(df):
    return df.first()[0]


def test_index_values(spark):
    r = spark.createDataFrame([(0.1, 0.2, 0.4, 0.4, 0.3, 0.2)], "blue double, red double, nir double, nir08 double, swir16 double, swir22 double")
    assert one(r.select(ix.index_column("bsi"))) == pytest.approx(0)
    assert one(r.select(ix.ndvi(F.lit(0.35), F.lit(0.05)))) == pytest.approx(0.75)
    assert one(r.select(ix.ndmi(F.lit(0.33), F.lit(0.27)))) == pytest.approx(0.1)
    assert one(r.select(ix.savi(F.lit(0.45), F.lit(0.05)))) == pytest.approx(0.6)
    assert one(r.select(ix.evi2(F.lit(0.31), F.lit(0.12)))) == pytest.approx(2.5 * 0.19 / 1.598)
    assert one(r.select(ix.ndvi(F.lit(0.0), F.lit(0.0)))) is None
    assert ix.usable_indices(["nir08", "red"], "landsat") == ["ndvi", "evi2", "savi"]
    with pytest.raises(ValueError):
        ix.index_column("ndxi")


def test_zscore_and_null_spread(spark):
    rows = [(0.3, 0.5, 0.1, -2.0), (0.3, 0.5, 0.001, -20.0), (0.7, 0.5, 0.1, 2.0), (0.3, 0.5, None, -20.0)]
    df = spark.createDataFrame(rows, "c double, m double, s double, want double")
    for r in df.select(det.zscore(F.col("c"), F.col("m"), F.col("s")).alias("z"), "want").collect():
        assert r.z == pytest.approx(r.want)


def test_confidence_levels(spark):
    df = spark.createDataFrame([(-4.0, -0.4, -4.5, -0.45), (-2.6, -0.16, 0.0, 0.0), (-2.2, -0.16, None, None), (0.1, 0.0, 0.1, 0.0), (-1.6, -0.2, 0.0, 0.0)], "zm double, dm double, zn double, dn double")
    z, d = {"ndmi": F.col("zm"), "nbr": F.col("zn")}, {"ndmi": F.col("dm"), "nbr": F.col("dn")}
    assert [r[0] for r in df.select(det.confidence(z, d)).collect()] == [3, 2, 1, 0, 0]
    assert [r[0] for r in df.select(det.confidence(z, d, spi=-1.5)).collect()] == [3, 1, 0, 0, 0]


def test_clearing_tiers_groups(spark):
    df = spark.createDataFrame([(0.3, 0.05, 0.0, 1), (0.1, 0.3, 0.2, 2), (0.2, 0.3, 0.0, 3), (None, None, None, 0)], "d double, p double, b double, want int")
    assert all(r.c == r.want for r in df.select(det.clearing(F.col("d"), F.col("p"), F.col("b")).alias("c"), "want").collect())
    n = spark.createDataFrame([(1,), (2,), (14,), (15,)], "n int").select(det.persistence_tier(F.col("n")))
    assert [r[0] for r in n.collect()] == ["first_observation", "candidate", "candidate", "confirmed"]
    g = lambda code, c: one(spark.range(1).select(det.landcover_group(F.lit(code), c)))
    assert (g(39, "30m"), g(39, "10m"), g(75, "30m"), g(75, "10m"), g(4, "10m")) == ("farming", "other", "urban", "other", "natural")
    with pytest.raises(ValueError):
        det.landcover_group(F.lit(1), "5m")


def test_reflectance(spark):
    df = spark.createDataFrame([(0, "s2", "2023-01-01"), (3000, "s2", "2023-01-01"), (3000, "s2", "2020-01-01"), (500, "s2", "2023-01-01"), (20000, "landsat", "2020-01-01")], "dn int, sensor string, d string")
    got = df.select(ix.reflectance(F.col("dn"), *ix.scale_offset(F.col("sensor"), F.to_date("d")))).collect()
    assert [r[0] for r in got] == [None] + [pytest.approx(x) for x in (0.2, 0.3, 0.0, 0.35)]


def test_baseline_needs_two_observations_for_a_spread(spark):
    obs = spark.createDataFrame([(1, "2020-01-01", 0.2), (1, "2021-01-05", 0.4), (2, "2020-01-01", 0.5), (3, "2020-01-01", None)], "pixel int, d string, v double").withColumn("obs_date", F.to_date("d"))
    r = {x.pixel: x for x in composites.monthly_baseline(obs, {"v": F.col("v")}).collect()}
    assert r[1].v_center == pytest.approx(0.3) and r[1].v_std == pytest.approx(0.1)
    assert (r[2].v_center, r[2].v_std, r[2].v_n) == (0.5, None, 1)
    assert (r[3].v_center, r[3].v_n) == (None, 0)


def test_scene_search_and_fallback(spark):
    sc = spark.createDataFrame([("a", "2024-01-01", 5.0), ("b", "2024-01-02", None), ("c", "2024-01-03", 20.0)], "scene_id string, d string, cloud_cover double").withColumn("date", F.to_date("d"))
    found = scenes.search(sc, "2024-01-01", "2024-01-31")
    assert [r.scene_id for r in found.collect()] == ["a"]
    assert scenes.or_else(found.where("false"), sc).count() == 3
    assert [r.scene_id for r in scenes.clearest({"s2": sc}, 3).collect()] == ["a", "c", "b"]
    keys = spark.createDataFrame([("x/2031-02-03.geojson",), ("x/2031-05-09.geojson",), ("x/2030-12-24.geojson",), ("x/z.txt",)], "key string")
    assert [r.key[2:12] for r in scenes.latest_keys(keys, 2).collect()] == ["2031-02-03", "2031-05-09"]
