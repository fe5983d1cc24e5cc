"""Tracks kept over a stream of dated alerts, and event-time sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from greensward.operators.persistence import TRACK, update_tracks
from greensward.plans.scratch import Scratch, _path


class TrackStore:
    """Tracks as one Parquet folder for each batch; the last complete one counts."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _batches(self) -> list[int]:
        path, fs = _path(self.spark, self.path)
        if not fs.exists(path):
            return []
        done = [s.getPath() for s in fs.listStatus(path)]
        good = [p.getName() for p in done if fs.exists(_path(self.spark, f"{p}/_SUCCESS")[0])]
        return sorted(int(n.removeprefix("batch=")) for n in good if n.startswith("batch="))

    def read(self, before: int | None = None) -> DataFrame:
        have = [b for b in self._batches() if before is None or b < before]
        schema = self.spark.createDataFrame([], TRACK).schema
        return self.spark.read.schema(schema).parquet(f"{self.path}/batch={have[-1]}") if have else self.spark.createDataFrame([], TRACK)

    def write(self, tracks: DataFrame, batch: int) -> None:
        tracks.write.mode("overwrite").parquet(f"{self.path}/batch={batch}")


def track_stream(alerts: DataFrame, store: TrackStore, out: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Fold each micro-batch's dates, in order, into the store; a batch that is run again starts from the tracks before it and replaces its output."""

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        scratch = Scratch(spark, "stream")
        tracks = store.read(before=number)
        rows = scratch.put(batch, "batch")
        done = None
        for r in rows.select("date").distinct().orderBy("date").collect():
            labelled, tracks = update_tracks(rows.where(F.col("date") == F.lit(r.date)), tracks, r.date, scratch, idempotent=True)
            labelled = labelled.withColumn("date", F.lit(r.date))
            done = labelled if done is None else done.unionByName(labelled)
        if done is not None:
            done.write.mode("overwrite").parquet(f"{out}/batch={number}")
        store.write(tracks, number)

    return alerts.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def gap_sessions(events: DataFrame, key: str, ts: str, gap: str) -> DataFrame:
    """Sessions of a key that end after ``gap`` without an event; for batches and, behind a watermark, streams."""
    w = F.session_window(F.col(ts), gap)
    return events.groupBy(F.col(key), w).agg(F.count(F.lit(1)).alias("n_events")).select(key, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n_events")
