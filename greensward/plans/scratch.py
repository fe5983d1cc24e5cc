"""Intermediate tables in the folder that the driver and all executors share.

Lineage is cut by writing Parquet below ``spark.checkpoint.dir``; a lost
executor then costs a re-read, never a recomputation of the whole chain.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tables up to this many bytes on disk may be broadcast.
BROADCAST_BYTES = 8 << 20


def shared_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a temporary folder only in local mode."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    base = "file://" + tempfile.mkdtemp(prefix="greensward-")
    spark.conf.set("spark.checkpoint.dir", base)
    return base


def _path(spark: SparkSession, where: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


class Scratch:
    """A folder of Parquet tables that belong to one run of an operator."""

    def __init__(self, spark: SparkSession, tag: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
        self.made: set[str] = set()
        self.n = 0

    def put(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return the table read back with the same schema."""
        self.n += 1
        where = f"{self.root}/{self.n:03d}-{name}"
        df.write.parquet(where)
        out = self.spark.read.schema(df.schema).parquet(where)
        self.made.add(where)
        out._scratch_path = where
        return out

    def append(self, df: DataFrame, where: str) -> DataFrame:
        """Add ``df`` to a table of one schema that a loop fills step by step; its plan doesn't grow with the steps."""
        df.write.mode("append").parquet(where)
        return self.spark.read.schema(df.schema).parquet(where)

    def bytes(self, table: DataFrame) -> int:
        path, fs = _path(self.spark, table._scratch_path)
        return int(fs.getContentSummary(path).getLength())

    def drop(self, *tables: DataFrame | None) -> None:
        for t in tables:
            if t is not None:
                self._delete(t._scratch_path)

    def keep(self, *tables: DataFrame) -> None:
        """Delete all tables put here but these: those that what an operator returns still reads."""
        for where in self.made - {t._scratch_path for t in tables}:
            self._delete(where)

    def _delete(self, where: str) -> None:
        path, fs = _path(self.spark, where)
        fs.delete(path, True)
        self.made.discard(where)

    def small(self, table: DataFrame, most: int = BROADCAST_BYTES, of: DataFrame | None = None) -> DataFrame:
        """Mark a written table, or a projection ``of`` one, for broadcast if its files are small, else leave it to AQE."""
        return F.broadcast(table) if self.bytes(table if of is None else of) <= most else table
