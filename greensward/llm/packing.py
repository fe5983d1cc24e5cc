"""Best-fit packing of token pieces into sequences, over vectors of capacities."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from greensward.llm.memory import give_back, text_batches
from greensward.llm.token_ids import default_tokenizer, encoder
from greensward.plans.scratch import Scratch

#: Weights of the residual norm: tokens first, then free document slots and attention cost between equals.
WEIGHTS = (1.0, 1e-3, 1e-3)
#: Ranks, of 24 bytes each, that are broadcast at most.
MAX_RANKS = 200_000

PIECE = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("shard", pa.int32()), ("local", pa.int64())])
PIECE_DDL = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, shard int, local bigint"


def cut(n: int, most: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` ids: all have ``most`` ids but the first, which has what is left over."""
    if n <= 0:
        return []
    first = (n - 1) % most + 1
    return [(0, first)] + [(s, most) for s in range(first, n, most)]


def pack_lengths(counts: dict[int, int], max_tokens: int, max_docs: int | None = None, max_cost: int | None = None, weights: tuple[float, float, float] = WEIGHTS) -> tuple[np.ndarray, int]:
    """Pack ``counts[length]`` pieces of each length; the segments of the plan and the number of sequences.

    A piece takes (length, 1, length squared) of a sequence's capacities
    (tokens, pieces, attention cost). Lengths go down; each piece goes to the
    open sequence in which it fits under every capacity and leaves the residual
    vector (as shares of the capacities) of least weighted norm. Sequences with
    the same contents are one class with a multiplicity, and equal pieces are
    placed in whole runs, so the work depends on distinct lengths, not pieces.

    A segment (length, rank, n, sequence, each, offset) puts the pieces of that
    length with ranks from ``rank`` to ``rank + n - 1`` into the sequences from
    ``sequence`` on, ``each`` to a sequence, the first of them at ``offset``.
    """
    cap = np.array([max_tokens, max_docs or max_tokens, max_cost or max_tokens * max_tokens], np.int64)
    w = np.array(weights) / cap.astype(float) ** 2
    room = np.zeros((0, 3), np.int64)
    base, many = np.zeros(0, np.int64), np.zeros(0, np.int64)
    out, total = [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        v = np.array([length, 1, length * length], np.int64)
        if length <= 0 or (v > cap).any():
            raise ValueError(f"a piece of {length} ids fits no sequence")
        while left:
            fits = np.flatnonzero((room >= v).all(1))
            if len(fits):
                k = fits[(((room[fits] - v) ** 2) * w).sum(1).argmin()]
            else:
                # open as many sequences as these pieces fill
                each = int((cap // v).min())
                room, k = np.vstack([room, cap]), len(base)
                base, many = np.append(base, total), np.append(many, -(-left // each))
                total += int(many[k])
            each = int((room[k] // v).min())
            full = min(int(many[k]), left // each)
            per = each if full else left
            bins = full or 1
            out.append((length, rank, bins * per, base[k], per, cap[0] - room[k][0]))
            rest = int(many[k]) - bins
            if rest:  # the untouched sequences of the class stay open as they are
                room, base, many = np.vstack([room, room[k]]), np.append(base, base[k] + bins), np.append(many, rest)
            room[k] -= per * v
            many[k] = bins
            left, rank = left - bins * per, rank + bins * per
        live = (room > 0).all(1)
        room, base, many = room[live], base[live], many[live]
    return np.array(out, np.int64).reshape(-1, 6), total


def place(segments: np.ndarray, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of the pieces with these lengths and ranks."""
    s = segments[np.lexsort((segments[:, 1], segments[:, 0]))]
    big = int(s[:, 1].max(initial=0)) + int(s[:, 2].max(initial=0)) + 1
    i = np.searchsorted(s[:, 0] * big + s[:, 1], length * big + rank, side="right") - 1
    s = s[i]
    k = rank - s[:, 1]
    return s[:, 3] + k // s[:, 4], s[:, 5] + k % s[:, 4] * length


def token_pieces(docs: DataFrame, max_tokens: int, *, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None, end_id: int | None = 2) -> DataFrame:
    """The pieces of every document: ``doc_id, piece, start, length, ids_crc32`` and, within the task ``shard``, ``local``: earlier pieces of that length."""
    path = tokenizer or default_tokenizer()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()  # what a worker's earlier tasks left
        enc, shard = encoder(path, end_id), TaskContext.get().partitionId()
        seen = np.zeros(max_tokens + 1, np.int64)
        for batch in batches:
            rows = []
            for i, a in zip(batch.column("doc_id").to_pylist(), enc.documents(batch.column("text")), strict=True):
                raw = memoryview(a.astype("<u4").tobytes())
                for k, (s, n) in enumerate(cut(len(a), max_tokens)):
                    rows.append((i, k, s, n, zlib.crc32(raw[4 * s : 4 * (s + n)]), shard, int(seen[n])))
                    seen[n] += 1
            cols = list(zip(*rows, strict=True)) if rows else [[]] * len(PIECE)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, PIECE, strict=True)], schema=PIECE)
            give_back()

    return docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text")).mapInArrow(pieces, PIECE_DDL)


def pack(docs: DataFrame, max_tokens: int = 1024, *, max_docs: int | None = None, max_cost: int | None = None, weights: tuple[float, float, float] = WEIGHTS, **tokens) -> DataFrame:
    """Pack all documents into sequences: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Only documents of more than ``max_tokens`` ids are cut (``cut``). What goes
    to the driver is the number of pieces of each length, at most
    ``max_tokens`` numbers, and the plan made from them (``pack_lengths``). A
    piece's rank among those of its length is its place within its task plus
    the pieces of earlier tasks, from one count for each task and length: no
    length is sorted or gathered, however common. Null texts are empty and take
    one id, the end; without an ``end_id`` they have no piece. Repeated rows
    are packed again; an empty table gives an empty result.
    """
    text_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "packing")
    pieces = scratch.put(token_pieces(docs, max_tokens, **tokens), "pieces")
    counts = scratch.put(pieces.groupBy("shard", "length").agg(F.count(F.lit(1)).alias("n")), "counts")
    total = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    segments, _ = pack_lengths(total, max_tokens, max_docs, max_cost, weights)

    @F.arrow_udf("struct<sequence_id:bigint,offset:bigint>")
    def to_sequence(length: pa.Array, rank: pa.Array) -> pa.Array:
        where = place(segments, length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in where], ["sequence_id", "offset"])

    before = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    first = scratch.put(counts.select("shard", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")), "ranks")
    if first.count() <= MAX_RANKS:  # a row for each task and length: many tasks join by shuffle
        first = scratch.small(first)
    out = pieces.join(first, ["shard", "length"]).withColumn("at", to_sequence("length", F.col("first") + F.col("local")))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset")


def op3_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
