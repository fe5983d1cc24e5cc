"""Documents dealt to blocks, so that what a block needs from the corpus comes back to it as rows.

A task that reads documents cuts them into blocks of a bounded size and names
for each block the distinct keys that its documents hold. Keys are counted and
looked up over the whole corpus by plain aggregations and joins; their answers
go back to their block, where they stand before its documents. Nothing of the
corpus is broadcast, and a block's keys are bounded by its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text of a block, bytes of texts in work at a time, and rows of a batch of keys.
BLOCK_BYTES, SLICE_BYTES, BATCH_ROWS = 32 << 20, 2 << 20, 100_000
#: A row's place is its block times this and its kind: answers come before documents.
KINDS = 4


def block_numbers() -> Iterator[int]:
    """Names of a task's blocks, no other task of its stage having them."""
    part = TaskContext.get().partitionId()
    yield from range(part << 24, (part + 1) << 24)


def of_kind(kind: int) -> Column:
    return F.col("at") % KINDS == kind


def by_block(rows: DataFrame) -> DataFrame:
    """All rows of a block in one task, in the order of ``at`` and ``key``."""
    return rows.repartition(F.floor(F.col("at") / KINDS)).sortWithinPartitions("at", "key")


def slices(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """``(first row, texts)`` in runs of about ``SLICE_BYTES``; null texts are empty."""
    group, first, size = [], 0, 0
    for i, x in enumerate(texts.cast(pa.large_binary())):
        group.append(x.as_py() or b"")
        size += len(group[-1])
        if size >= SLICE_BYTES:
            yield first, group
            group, first, size = [], i + 1, 0
    if group:
        yield first, group


class Known:
    """Distinct values of a block, numbered in the order in which they come. They stand in an Arrow array, a tenth of what Python objects take."""

    def __init__(self, kind: pa.DataType, first: list = ()):
        self.values = pa.array(list(first), kind)

    def codes(self, values: list) -> np.ndarray:
        """The number of each value; new ones are added."""
        d = pa.array(values, self.values.type).dictionary_encode()
        code = pc.fill_null(pc.index_in(d.dictionary, value_set=self.values), -1).to_numpy(zero_copy_only=False).astype(np.int32)
        new = np.flatnonzero(code < 0)
        code[new] = len(self.values) + np.arange(len(new))
        self.values = pa.concat_arrays([self.values, d.dictionary.take(pa.array(new))])
        return code[np.asarray(d.indices)]


def rows_of(schema: pa.Schema, rows: int, /, **cols) -> Iterator[pa.RecordBatch]:
    """Batches of ``rows`` rows; a number stands in all rows, and columns not given are null."""
    full = [pa.nulls(rows, f.type) if f.name not in cols else pa.array(np.full(rows, cols[f.name]), f.type) if isinstance(cols[f.name], int) else pa.array(cols[f.name], f.type) for f in schema]
    for s in range(0, rows, BATCH_ROWS):
        yield pa.RecordBatch.from_arrays([c.slice(s, BATCH_ROWS) for c in full], schema=schema)


def pack(**cols: pa.Array) -> bytes:
    """Columns of a slice of documents as one compressed value."""
    batch = pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    return out.getvalue().to_pybytes()


def unpack(value: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(value) as r:
        return r.read_next_batch()


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Slices of batches in which ``key`` doesn't change, with its value."""
    for batch in batches:
        if batch.num_rows:
            c = batch.column(key).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(c)) + 1), batch.num_rows]
            for s, e in zip(cuts, cuts[1:]):
                yield c[s].item(), batch.slice(s, e - s)
