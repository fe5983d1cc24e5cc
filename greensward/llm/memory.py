"""Bounded memory in Python workers, which share a machine with the JVM."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import SparkSession

#: Bytes of an Arrow batch of whole texts, in place of Spark's default.
TEXT_BYTES = "4m"


def give_back() -> None:
    """Workers outlive their tasks; what their allocators keep would add up beside the JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def text_batches(spark: SparkSession | None) -> None:
    """Send texts to Python in batches of a few megabytes, unless the session sets a size of its own, in bytes or rows."""
    mine = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark is not None and all(spark.conf.get(k, None) is None for k in (mine, "spark.sql.execution.arrow.maxRecordsPerBatch")):
        spark.conf.set(mine, TEXT_BYTES)
