"""Language-model scores of whole texts by context-tree weighting, beside a unigram base."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from greensward.llm.blocks import BLOCK_BYTES, KINDS, SLICE_BYTES, Known, block_numbers, by_block, of_kind, pack, rows_of, runs, slices, unpack
from greensward.llm.context_tree import window_scores, windows
from greensward.llm.memory import give_back, text_batches
from greensward.plans.scratch import Scratch

#: Bytes of context of the longest contexts, and windows of a block that wait to be added up.
DEPTH, WAITING = 5, 1_000_000
GRAM, WORD, DOCUMENT = 0, 1, 2
#: The end of a text; no word holds it.
END = b"\n"

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_SEEN = "at bigint, key bigint, n bigint, word binary, docs binary"
_SEEN_ARROW = pa.schema([("at", pa.int64()), ("key", pa.int64()), ("n", pa.int64()), ("word", pa.binary()), ("docs", pa.binary())])
_SCORED = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double, n_bytes bigint"


def normal(text: bytes) -> bytes:
    """Lower-cased words with one space between them, then the end."""
    return b" ".join(text.translate(_LOWER).split()) + END


def _placed(texts: list[bytes], depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Windows of all bytes of texts, and how many of each text; a text begins behind ``depth`` ends. Long texts go in pieces."""
    joined = b"".join([END * depth + t for t in texts])
    ends = np.cumsum([len(t) + depth for t in texts])
    step = 2 * SLICE_BYTES
    for s in range(0, len(joined), step):
        w = windows(joined[s : s + step + depth], depth)
        good = np.ones(len(w), bool)
        over = (ends[:, None] - s - 1 - np.arange(depth)).ravel()  # windows over two texts go
        good[over[(over >= 0) & (over < len(w))]] = False
        w = w[good]
        if len(w):
            last = np.clip(ends - depth, s, s + len(good))
            begin = np.clip(ends - np.diff(ends, prepend=0), s, s + len(good))
            yield w, np.maximum(last - begin, 0)


def _tally(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One count for each distinct key, in the order of keys."""
    key, n = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    order = np.argsort(key)
    key, n = key[order], n[order]
    first = np.flatnonzero(np.diff(key, prepend=key[:1] - 1))
    return key[first], np.add.reduceat(n, first)


def _words() -> Known:
    """Words of a block; the end of a text is word 0."""
    return Known(pa.binary(), [b""])


def language_scores(docs: DataFrame, held: Column, depth: int = DEPTH) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte`` of each row.

    A text is its words in lower case (A-Z) and an end, as bytes with one space
    between words. Training counts all windows of texts that aren't ``held``
    (null: not held) and all their words; held texts teach nothing. ``score`` is
    the log10 probability by the weighted context trees, ``bits_per_byte`` its
    code length, ``base_score`` the smoothed unigram's.

    Null and empty texts, and those of white space, are an end alone. Texts of
    any length are read whole; repeated rows count and are scored again; ties
    can't occur. An empty table stays empty; without training texts every bit is
    1/2 and every token as likely as any. Columns other than doc_id and text are
    ignored, whatever their names. Windows and words are counted over the whole
    corpus and return to the blocks of documents that asked for them.
    """
    spark = docs.sparkSession
    text_batches(spark)
    scratch = Scratch(spark, "language")
    slim = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(held, F.lit(False)).alias("held"), docs["text"].alias("text"))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = block_numbers()
        block, size, n_slices, parts, known, times = next(numbers), 0, 0, [], _words(), np.zeros(0, np.int64)

        def close() -> Iterator[pa.RecordBatch]:
            key, n = _tally(parts)
            yield from rows_of(_SEEN_ARROW, len(key), at=block * KINDS + GRAM, key=key, n=n)
            yield from rows_of(_SEEN_ARROW, len(times), at=block * KINDS + WORD, key=np.arange(len(times)), n=times, word=known.values)

        for batch in batches:
            ids, out = batch.column("doc_id"), batch.column("held").to_numpy(zero_copy_only=False)
            for first, group in slices(batch.column("text")):
                size += sum(map(len, group))
                texts, teach = [normal(t) for t in group], ~out[first : first + len(group)]
                held_here = batch.column("held").slice(first, len(group))
                yield from rows_of(_SEEN_ARROW, 1, at=block * KINDS + DOCUMENT, key=n_slices, docs=[pack(doc_id=ids.slice(first, len(group)), held=held_here, text=pa.array(texts, pa.large_binary()))])
                # those that teach first, so their windows and words are the first
                order = np.argsort(~teach, kind="stable")
                taught = int(teach.sum())
                for grams, each in _placed([texts[i] for i in order], depth):
                    d = pa.array(grams).dictionary_encode()
                    at = np.asarray(d.indices)[: int(each[:taught].sum())]
                    parts.append((np.asarray(d.dictionary), np.bincount(at, minlength=len(d.dictionary))))
                words = [texts[i].split() for i in order]
                code = known.codes(list(chain.from_iterable(words)))
                here = np.bincount(code[: sum(map(len, words[:taught]))], minlength=len(known.values))
                here[: len(times)] += times
                here[0] += taught
                times = here
                if sum(len(k) for k, _ in parts) > WAITING:
                    parts = [_tally(parts)]
                n_slices += 1
                if size >= BLOCK_BYTES:
                    yield from close()
                    block, size, n_slices, parts, known, times = next(numbers), 0, 0, [], _words(), np.zeros(0, np.int64)
            give_back()
        if parts:
            yield from close()
        parts.clear()
        del known, times
        give_back()

    seen = scratch.put(slim.mapInArrow(look, _SEEN), "seen")
    asked = seen.where(of_kind(WORD)).select("word", "at", "key", "n")
    one = Window.partitionBy("word")  # a row for each block at most
    counts = scratch.put(asked.select("at", "key", F.sum("n").over(one).alias("c"), (F.col("at") == F.min("at").over(one)).alias("first")), "words")
    grams = scratch.put(seen.where(of_kind(GRAM)).groupBy("key").agg(F.sum("n").alias("n")), "windows")
    scores = scratch.put(window_scores(grams.withColumnRenamed("key", "gram"), depth, scratch), "scores")
    total = counts.where("first").agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    nothing = F.lit(None).cast("binary").alias("docs")
    answers = seen.where(of_kind(GRAM)).select("at", "key").join(scores.withColumnRenamed("gram", "key"), "key").select("at", "key", F.col("lp").alias("value"), nothing)
    known = counts.select("at", "key", F.col("c").cast("double").alias("value"), nothing)
    texts = seen.where(of_kind(DOCUMENT)).select("at", "key", F.lit(None).cast("double").alias("value"), "docs")
    all_tokens, distinct = int(total.n), int(total.v)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, key, base = None, [[], []], None, None
        for at, rows in runs(batches, "at"):
            block, kind = divmod(at, KINDS)
            if block != now:
                now, parts, key, words_of = block, [[], []], None, _words()
            if kind != DOCUMENT:
                parts[kind].append((rows.column("key").to_numpy(), rows.column("value").to_numpy()))
                continue
            if key is None:
                key, lp = (np.concatenate([p[i] for p in parts[GRAM]]) for i in (0, 1))
                count = np.concatenate([p[1] for p in parts[WORD]])
                base = np.log10((count + 0.5) / (all_tokens + 0.5 * (distinct + 1)))
            for docs in map(unpack, rows.column("docs").to_pylist()):
                group = docs.column("text").to_pylist()
                sums = np.zeros(len(group))
                for grams, each in _placed(group, depth):
                    d = pa.array(grams).dictionary_encode()
                    # looked up in their order, which finds neighbours in cache
                    distinct_here = np.asarray(d.dictionary)
                    order = np.argsort(distinct_here)
                    value = np.empty(len(order))
                    value[order] = lp[np.searchsorted(key, distinct_here[order])]
                    found = value[np.asarray(d.indices)]
                    some = np.flatnonzero(each)
                    sums[some] += np.add.reduceat(found, np.cumsum(each[some]) - each[some])
                words = [t.split() for t in group]
                # in the order in which the block first saw them
                order = np.argsort(docs.column("held").to_numpy(zero_copy_only=False), kind="stable")
                code = words_of.codes(list(chain.from_iterable(words[i] for i in order)))
                sizes = np.array([len(w) for w in words])
                flat = np.zeros(len(code) + len(words), np.int32)
                start = np.cumsum(sizes + 1) - sizes  # behind each text's end, which stands first
                flat[np.repeat(start[order] - (np.cumsum(sizes[order]) - sizes[order]), sizes[order]) + np.arange(len(code))] = code
                tokens = sizes + 1
                first = np.cumsum(tokens) - tokens
                known_here = np.add.reduceat((count[flat] > 0).astype(np.int64), first)
                cols = [docs.column("doc_id"), docs.column("held"), pa.array(tokens), pa.array(known_here), pa.array(np.add.reduceat(base[flat], first)), pa.array(sums), pa.array([len(t) for t in group], pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "n_bytes"])
            give_back()

    out = by_block(answers.unionByName(known).unionByName(texts)).mapInArrow(score, _SCORED)
    scratch.keep(seen, counts, scores)
    return out.withColumns({"train_tokens": F.lit(all_tokens).cast("long"), "bits_per_byte": -F.col("score") * math.log2(10) / F.col("n_bytes")})


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id's digits leaves 1 modulo 5; null ids aren't held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def op12_lm_scoring(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return language_scores(docs, held_out(F.col("doc_id")))
