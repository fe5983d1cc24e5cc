"""The two runs that users start: building baselines, and detection from observations to tracked alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greensward import config
from greensward.functions import indices as ix
from greensward.functions.detection import clearing, confidence_label
from greensward.operators import composites, outlines, persistence, regions, shapes
from greensward.sources import alerts as store
from greensward.sources import baselines, scenes


def build_baselines(obs: DataFrame, values: dict[str, Column], path: str, *, force: bool = False, **how) -> DataFrame:
    """Build the monthly baselines that the store lacks (all with ``force``) and return ``index_name, month`` of what it holds then.

    Months are built in one pass over ``obs``; ``how`` goes to
    ``composites.monthly_baseline``. A store that isn't there is begun.
    """
    from pyspark.errors import AnalysisException

    spark, names = obs.sparkSession, list(values)
    try:
        have = baselines.stored_pairs(spark, path)
        have.schema  # noqa: B018
    except AnalysisException:
        have = spark.createDataFrame([], "index_name string, month int")
    need = sorted({r.month for r in scenes.missing_baselines(have, names).collect()}) if not force else list(range(1, 13))
    if need:
        baselines.write_baselines(composites.monthly_baseline(obs.where(F.month("obs_date").isin(need)), values, **how), path, names)
    return baselines.stored_pairs(spark, path)


def detect(obs: DataFrame, base: DataFrame, values: dict[str, Column], clear: Column, *, scene: str = "scene", rank: str = "obs_id", bsi: Column | None = None, spi: float = 0.0, min_clear: float = config.MIN_CLEAR["streaming"], most: float = config.MAX_ALERT_FRACTION, denominator: str = "all", min_ha: float = config.MIN_AREA_HA, max_ha: float = config.MAX_AREA_HA, res: float = 20.0, landcover: dict[str, str] | None = None, rings: bool = False, cells: bool = False) -> DataFrame:
    """Alerts of all scenes: a row for each connected region of cells of an anomaly.

    ``obs`` has ``pixel, row, col, obs_date`` and the bands; of a cell's
    observations in a scene the first by ``rank`` that has a value counts.
    Scenes that aren't clear enough go, then those with too large a share of
    alerts. A region has ``n_cells, area_ha, confidence`` (the highest),
    ``confidence_label``, ``clearing`` (the most frequent type above 0, if
    ``bsi`` is given; the state before is the month's baseline of nbr), its box
    ``x0, y0, x1, y1`` in metres from the grid's corner, and the land cover of
    its cells for each collection in ``landcover``; with ``rings`` also its
    outline, as rings of points in metres from that corner with y falling from
    row to row (``outlines.polygons``); with ``cells`` its cells as stretches
    (``starts, ends``), so that tracks go by true shapes. Several scenes are worked on at once;
    nothing but the plan is on the driver.
    """
    good = composites.clear_gate(obs, scene, clear, min_clear).select(scene)
    found = obs.join(good, scene, "left_semi").withColumns({f"_v_{n}": v for n, v in values.items()})
    found = found.withColumn("_bsi", F.lit(None).cast("double") if bsi is None else bsi)
    keep = {"row", "col", "obs_date", "_bsi", *(f"_v_{n}" for n in values), *(landcover or {}).values()}
    some = F.coalesce(*[F.col(f"_v_{n}") for n in values]).isNotNull()
    first = F.min(F.struct(F.col(rank).alias("_rank"), *sorted(keep)))
    pixels = found.where(some).groupBy(scene, "pixel").agg(first.alias("p")).select(scene, "pixel", *[F.col(f"p.{c}").alias(c) for c in sorted(keep)])
    judged = composites.against_baseline(pixels, base, {n: F.col(f"_v_{n}") for n in values}, spi)
    judged = judged.withColumn("valid", F.coalesce(*[F.col(f"z_{n}") for n in values]).isNotNull())
    judged = composites.scene_guard(judged, scene, most, denominator).where("confidence > 0")
    kind = clearing(F.col("nbr_center") - F.col("nbr"), F.col("nbr"), F.col("_bsi")) if "nbr" in values and bsi is not None else F.lit(0)
    slim = judged.select(scene, "row", "col", "confidence", kind.alias("clearing"), *(landcover or {}).values())
    labelled = regions.label_regions(slim, scene)
    by = [scene, "region"]
    edge = lambda f, c, k: (f(c) + k) * res
    box = [edge(F.min, "col", 0).alias("x0"), edge(F.min, "row", 0).alias("y0"), edge(F.max, "col", 1).alias("x1"), edge(F.max, "row", 1).alias("y1")]
    out = labelled.groupBy(*by).agg(F.count(F.lit(1)).alias("n_cells"), F.max("confidence").cast("int").alias("confidence"), *box)
    out = regions.area_filter(out.withColumn("area_ha", regions.area_ha(F.col("n_cells"), res)), min_ha, max_ha)
    out = out.withColumn("confidence_label", confidence_label(F.col("confidence")))
    out = out.join(regions.zonal_mode(labelled, by, "clearing").withColumnRenamed("mode", "clearing"), by, "left")
    out = out.join(regions.annotate_all(labelled, by, landcover), by, "left") if landcover else out
    if rings or cells:
        kept = labelled.join(out.select(*by), by, "left_semi")
    if cells:
        whole = shapes.stretches(shapes.runs(kept.select(F.col(scene).alias("date"), F.col("region").alias("id"), "row", "col"), ["date", "id"]))
        out = out.join(whole.select(F.col("date").alias(scene), F.col("id").alias("region"), "starts", "ends"), by, "left")
    if rings:
        out = out.join(outlines.polygons(outlines.outlines(kept, scene), scene, res=res), by, "left")
    return out


def track_and_store(alerts: DataFrame, path: str, scene: str = "scene") -> DataFrame:
    """Chain the alerts of all scenes to tracks, save them by date with count, status and dates, and return the last tracks.

    An alert's id is its region's number, which is unique within its scene.
    Alerts with ``starts, ends`` are followed by the cells that they share,
    others by their boxes.
    """
    true = [c for c in ("starts", "ends") if c in alerts.columns]
    boxes = alerts.select(F.col(scene).alias("date"), F.col("region").alias("id"), "x0", "y0", "x1", "y1", *true)
    labelled, tracks = persistence.fold_tracks(boxes)
    out = alerts.withColumnRenamed(scene, "date").withColumnRenamed("region", "id").join(labelled, ["date", "id"])
    store.save_alerts(out.withColumnRenamed("date", "detection_date"), path)
    return tracks


def masked_values(names: tuple[str, ...], clear: Column) -> dict[str, Column]:
    return {n: ix.masked(ix.index_column(n), clear) for n in names}
