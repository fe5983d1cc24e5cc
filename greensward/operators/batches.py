"""Small groups worked on many at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

#: Rows that are gathered before groups are worked on.
ROWS = 1 << 17


def group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """The first row of each stretch of equal keys."""
    def code(key: pa.Array) -> np.ndarray:
        plain = pa.types.is_integer(key.type) and not key.null_count
        return np.asarray(key if plain else key.dictionary_encode().indices.fill_null(-1))

    codes = [code(table.column(k).combine_chunks()) for k in keys]
    return np.concatenate([[0], np.flatnonzero(np.any([np.diff(c) != 0 for c in codes], axis=0)) + 1]).astype(np.int64)


def in_groups(rows: DataFrame, keys: list[str], work: Callable[[pa.Table, np.ndarray], pa.Table], schema: str | StructType) -> DataFrame:
    """What ``work`` makes of the groups of ``rows``, in the columns of ``schema``.

    It gets whole groups, one behind the other in the order of ``keys``, and the
    first row of each: as many as ``ROWS`` rows hold, or one that is larger. So
    a call costs little beside its rows, however small the groups are.
    """
    size = ROWS

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n, most = 0, size
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= most:
                table = pa.Table.from_batches(held).combine_chunks()
                first = group_starts(table, keys)
                most = max(size, 2 * (n - int(first[-1])))  # a large group isn't looked at again for each batch
                if len(first) > 1:
                    yield from work(table.slice(0, int(first[-1])), first[:-1]).to_batches()
                    held = table.slice(int(first[-1])).to_batches()
                    n -= int(first[-1])
        if n:
            table = pa.Table.from_batches(held).combine_chunks()
            yield from work(table, group_starts(table, keys)).to_batches()

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(sweep, schema)
