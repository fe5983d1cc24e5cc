"""Token ids in blocks of separately compressed documents with a shared zstandard dictionary.

An archive is a folder of four Parquet tables, so Spark's committers make it
whole and any store that Spark reaches will do:

* ``dictionary``: one row, ``(dict_hash, end_id, content)``; the hash is the sha256 of the content.
* ``blocks``: ``(block, first_doc, last_doc, doc_ids, n_tokens, n_ids, offsets, dict_hash, payload)``
  in a folder ``shard=`` for each task that wrote. Shards and blocks ascend
  with doc_id. ``payload`` holds one zstandard frame for each document, of
  little-endian unsigned 32-bit ids; frame i is
  ``payload[offsets[i]:offsets[i + 1]]``, so one document is read without its
  neighbours. ``n_ids`` is the sum of ``n_tokens``.
* ``shards``: ``(shard, shard_start, n_documents, n_tokens)``; ``shard_start`` counts the ids of all shards before.
* ``index``: ``(shard, block, first_doc, last_doc, base)`` in the order of blocks; ``base`` counts the ids of all blocks before.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from greensward.llm.memory import give_back, text_batches
from greensward.llm.sampling import hashed_rows
from greensward.llm.token_ids import default_tokenizer, encoder
from greensward.plans.scratch import Scratch

#: Documents that train the dictionary, ids that each of them lends, bytes of the dictionary, and the compression level.
SAMPLE_DOCS, SAMPLE_IDS, DICT_BYTES, LEVEL = 1000, 4096, 64 << 10, 3
#: A block ends at so many bytes of frames or documents. Ids asked for that are looked up in one pass over the index.
BLOCK_BYTES, BLOCK_DOCS, LOOKUP = 1 << 20, 4096, 1000

BLOCK = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("first_doc", pa.int64()), ("last_doc", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())), ("n_ids", pa.int64()), ("offsets", pa.list_(pa.int64())), ("dict_hash", pa.string()), ("payload", pa.binary())])
BLOCK_DDL = "shard int, block int, first_doc bigint, last_doc bigint, doc_ids array<bigint>, n_tokens array<bigint>, n_ids bigint, offsets array<bigint>, dict_hash string, payload binary"
INDEX_DDL = "shard int, block int, first_doc bigint, last_doc bigint, base bigint"


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int | None) -> bytes:
    """A dictionary over id arrays; empty if they are too few to train on.

    The ``SAMPLE_DOCS`` rows whose doc_ids have the smallest hashes are encoded,
    whole and of any length; a row of more than ``SAMPLE_IDS`` ids lends a run of
    so many from a place that its hash chooses.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, end_id)
        for batch in batches:
            out = []
            for h, a in zip(batch.column("h").to_pylist(), enc.documents(batch.column("text")), strict=True):
                at = h % max(1, len(a) - SAMPLE_IDS + 1)
                out.append((h, a[at : at + SAMPLE_IDS].astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.binary())], names=["h", "ids"])

    rows = hashed_rows(docs.where("text <> ''"), "doc_id", SAMPLE_DOCS).select("h", "text").mapInArrow(runs, "h bigint, ids binary").collect()
    try:
        return zstandard.train_dictionary(DICT_BYTES, sorted(bytes(r.ids) for r in rows), level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _dictionary(content: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(content)} if content else {}


def write_archive(docs: DataFrame, where: str, *, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None, end_id: int | None = 2) -> None:
    """Encode every whole text and write the archive in ascending order of ``doc_id``.

    Texts are dealt by ranges of doc_id and sorted within their task; null ids
    come first. Rows that share an id are dealt on by length and by the task
    that read them, so a repeated id is no limit either. Null texts count as
    empty: their only id is ``end_id``. Texts of any length are one frame. An
    empty table makes an archive without blocks; other columns are ignored.
    """
    spark = docs.sparkSession
    text_batches(spark)
    path = tokenizer or default_tokenizer()
    slim = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    content = train_dictionary(slim, path, end_id)
    digest = hashlib.sha256(content).hexdigest()
    spark.createDataFrame([(digest, end_id, bytearray(content))], "dict_hash string, end_id int, content binary").coalesce(1).write.parquet(f"{where}/dictionary")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard, block = encoder(path, end_id), TaskContext.get().partitionId(), 0
        press = zstandard.ZstdCompressor(level=LEVEL, **_dictionary(content))
        ids: list[int | None] = []
        counts: list[int] = []
        frames: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            known = [i for i in ids if i is not None]
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in frames])])
            row = {"shard": shard, "block": block, "first_doc": min(known, default=None), "last_doc": max(known, default=None), "doc_ids": ids, "n_tokens": counts, "n_ids": sum(counts), "offsets": offsets.tolist(), "dict_hash": digest, "payload": b"".join(frames)}
            return pa.RecordBatch.from_pylist([row], schema=BLOCK)

        for batch in batches:
            for i, a in zip(batch.column("doc_id").to_pylist(), enc.documents(batch.column("text")), strict=True):
                frame = press.compress(a.astype("<u4").tobytes())
                if frames and (size + len(frame) > BLOCK_BYTES or len(frames) >= BLOCK_DOCS):
                    yield flush()
                    ids, counts, frames, size, block = [], [], [], 0, block + 1
                ids.append(i)
                counts.append(len(a))
                frames.append(frame)
                size += len(frame)
            give_back()
        if frames:
            yield flush()

    order = [F.col("doc_id").asc_nulls_first(), F.col("size")]
    slim = slim.withColumns({"size": F.coalesce(F.octet_length("text"), F.lit(-1)), "reader": F.spark_partition_id()})
    ranged = slim.repartitionByRange(*order, F.col("reader")).sortWithinPartitions(*order)
    ranged.select("doc_id", "text").mapInArrow(blocks, BLOCK_DDL).write.partitionBy("shard").parquet(f"{where}/blocks")
    written = spark.read.schema(BLOCK_DDL).parquet(f"{where}/blocks").select("shard", "block", "first_doc", "last_doc", F.size("doc_ids").alias("n"), "n_ids")
    per = written.groupBy("shard").agg(F.sum("n").alias("n_documents"), F.sum("n_ids").alias("n_tokens"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task that wrote
    per.select("shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("shard_start"), "n_documents", "n_tokens").write.parquet(f"{where}/shards")
    shards = spark.read.schema("shard int, shard_start bigint").parquet(f"{where}/shards")
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    index = written.join(shards, "shard").withColumn("base", F.col("shard_start") + F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    index.select("shard", "block", "first_doc", "last_doc", "base").write.parquet(f"{where}/index")


def _wanted(index: DataFrame, doc_ids: list[int]) -> DataFrame:
    """The blocks that can hold one of the ids: a range of the index is pushed down, then the ids are tried on its rows."""
    ids = sorted(set(doc_ids))
    found = index.where((F.col("first_doc") <= ids[-1]) & (F.col("last_doc") >= ids[0])) if ids else index.where("false")
    tried = None
    for s in range(0, len(ids), LOOKUP):
        some = F.array(*map(F.lit, ids[s : s + LOOKUP]))
        part = found.where(F.exists(some, lambda i: (F.col("first_doc") <= i) & (F.col("last_doc") >= i)))
        tried = part if tried is None else tried.unionByName(part)
    return found if tried is None else tried.distinct()


def read_archive(spark: SparkSession, where: str, doc_ids: list[int] | None = None, *, with_ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` and, if asked for, ``ids``, of all documents or of those listed.

    With ``doc_ids`` the index tells the blocks; only the folders of their
    shards are read, and only the frames asked for are expanded.
    """
    row = spark.read.parquet(f"{where}/dictionary").first()
    content, digest = bytes(row.content), row.dict_hash
    if hashlib.sha256(content).hexdigest() != digest:
        raise ValueError(f"{where}: the dictionary doesn't match its hash")
    scratch = Scratch(spark, "archive")
    index = spark.read.schema(INDEX_DDL).parquet(f"{where}/index")
    blocks = spark.read.schema(BLOCK_DDL).parquet(f"{where}/blocks")
    if doc_ids is not None:
        index = scratch.put(_wanted(index, doc_ids), "wanted")
        blocks = blocks.where(F.col("shard").isin([r.shard for r in index.select("shard").distinct().collect()]))
    else:
        index = scratch.put(index, "index")
    starts = scratch.small(index.select("shard", "block", "base"), of=index)
    ddl = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.binary())] * with_ids)
    only = None if doc_ids is None else frozenset(doc_ids)

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        un = zstandard.ZstdDecompressor(**_dictionary(content))
        for batch in batches:
            for r in range(batch.num_rows):
                b = {c: batch.column(c)[r] for c in batch.schema.names}
                if b["dict_hash"].as_py() != digest:
                    raise ValueError("a block was written with another dictionary")
                payload, ids, off = b["payload"].as_buffer(), b["doc_ids"].as_py(), b["offsets"].as_py()
                n = np.array(b["n_tokens"].as_py(), np.int64)
                start = b["base"].as_py() + np.cumsum(n) - n
                pick = [i for i in range(len(ids)) if only is None or ids[i] in only]
                raw = [un.decompress(memoryview(payload)[off[i] : off[i + 1]]) for i in pick]
                cols = [pa.array([ids[i] for i in pick], pa.int64()), pa.array(start[pick], pa.int64()), pa.array([len(x) // 4 for x in raw], pa.int64()), pa.array([zlib.crc32(x) for x in raw], pa.int64())]
                yield pa.RecordBatch.from_arrays(cols + [pa.array(raw, pa.binary())] * with_ids, schema=schema)

    return blocks.join(starts, ["shard", "block"]).select("dict_hash", "doc_ids", "n_tokens", "offsets", "payload", "base").mapInArrow(expand, ddl)


def op4_token_archive(spark, sf_dir: str) -> DataFrame:
    where = f"{Scratch(spark, 'tokens').root}/archive"
    write_archive(spark.read.parquet(f"{sf_dir}/documents.parquet"), where)
    return read_archive(spark, where, with_ids=False)
