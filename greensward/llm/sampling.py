"""Bounded samples by hash, the same for every run and partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hashed_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """``h`` and the columns of at most ``n`` distinct rows, those whose ``key`` has the smallest hashes.

    Keys are counted first, by a scan of that column alone; then only rows whose
    key's hash lies below a cut for about ``2 n`` keys leave their task, each
    once. The cut goes by distinct keys, so copies under many keys weigh as in
    the table and neither they nor repeated rows can empty the sample; with few
    keys every row takes part. Null keys are one key.
    """
    h = F.pmod(F.xxhash64(F.col(key), F.lit(1)), F.lit(1 << 40))
    keys = df.agg(F.approx_count_distinct(key)).first()[0]
    rows = df.withColumn("h", h)
    if keys > 4 * n:
        rows = rows.where(F.col("h") < int(2 * n / keys * (1 << 40)))
    return rows.distinct().orderBy("h", *df.columns).limit(n)
