"""Token alignment of two tokenizers, worked out once for each distinct segment of the corpus.

Texts are cut before runs of spaces between two characters that aren't white
space. The first tokenizer's pre-tokens never go over such a place; the second
can't merge there if none of its pieces has a space mark behind another
character, which is verified when its file is loaded. Where that fails, a whole
text is one segment. Both tokenizers end a token at a cut, so groups, links and
digests of a text are those of its segments in turn.

Tasks that read documents name the distinct segments of each block of texts. All
blocks that ask for a segment meet in one task, in the order of segments, where
it is tokenized and aligned once; what it gives goes back to these blocks, and
documents are composed there. How many documents hold a pair
is counted by block and summed, and goes back to the blocks the same way.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from greensward.llm.blocks import BLOCK_BYTES, KINDS, Known, block_numbers, by_block, of_kind, pack, rows_of, runs, slices, unpack
from greensward.llm.memory import give_back, text_batches
from greensward.llm.token_counts import default_model
from greensward.llm.token_ids import default_tokenizer
from greensward.plans.scratch import Scratch

ANSWER, DOCUMENT = 0, 1
#: Segments tokenized at a time, and segments of a block parsed at a time.
SEGMENTS, PARSED = 2000, 50_000

_CUT = re.compile(r"(?<=\S)(?= +\S)")
_SEEN, _SEEN_ARROW = "at bigint, key bigint, segment string, docs binary", pa.schema([("at", pa.int64()), ("key", pa.int64()), ("segment", pa.string()), ("docs", pa.binary())])
_COMPOSED = "at bigint, key bigint, a int, b int, n bigint, docs binary"
_COMPOSED_ARROW = pa.schema([("at", pa.int64()), ("key", pa.int64()), ("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64()), ("docs", pa.binary())])
_RESULT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
#: The visible characters by which byte-level files write bytes; the others follow from 256 on.
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]


class Aligner:
    """Two tokenizers and the bytes of their ids: ``byte_bpe`` a byte-level file, ``pieces`` a sentencepiece file."""

    def __init__(self, byte_bpe: str, pieces: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_bpe)
        self.a.encode_special_tokens = True
        hidden = [b for b in range(256) if b not in set(_VISIBLE)]
        byte = {chr(b): b for b in _VISIBLE} | {chr(256 + k): b for k, b in enumerate(hidden)}
        self.a_bytes = {i: bytes(byte[c] for c in t) if all(c in byte for c in t) else t.encode() for t, i in self.a.get_vocab().items()}
        self.b = m = sentencepiece.SentencePieceProcessor(model_file=pieces)
        names = [m.id_to_piece(i) for i in range(m.vocab_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if m.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        with open(byte_bpe, encoding="utf-8") as f:
            kind = json.load(f)
        whole = kind["normalizer"] is None and kind["pre_tokenizer"] is not None and kind["pre_tokenizer"]["type"] == "ByteLevel" and kind["pre_tokenizer"]["use_regex"] and not kind["pre_tokenizer"]["add_prefix_space"]
        #: Whether neither tokenizer can merge over a cut.
        self.cuts = whole and not any(re.search("[^▁]▁", p) for p in names)

    def segments(self, text: str) -> list[str]:
        """Segments of a space and the text; none of an empty text."""
        return (_CUT.split(f" {text}") if self.cuts else [f" {text}"]) if text else []

    def groups(self, segments: list[str]) -> list[str | None]:
        """``a1,a2|b1;a3|b2`` of each segment; null where the bytes of either side's tokens aren't the segment's."""
        left = [x.ids for x in self.a.encode_batch_fast(segments, add_special_tokens=False)]
        right = self.b.encode([s[1:] for s in segments], num_threads=1)
        return [self._group(s.encode(), a, b) for s, a, b in zip(segments, left, right, strict=True)]

    def _group(self, raw: bytes, a: list[int], b: list[int]) -> str | None:
        mine, theirs = [self.a_bytes[i] for i in a], [self.b_bytes[i] for i in b]
        if b"".join(mine) != raw or b"".join(theirs) != raw:
            return None
        out, i, j, end_a, end_b = [], 0, 0, 0, 0
        while i < len(a):
            s, t = i, j
            end_a, end_b = end_a + len(mine[i]), end_b + len(theirs[j])
            i, j = i + 1, j + 1
            while end_a != end_b:
                if end_a < end_b:
                    end_a, i = end_a + len(mine[i]), i + 1
                else:
                    end_b, j = end_b + len(theirs[j]), j + 1
            out.append(f"{','.join(map(str, a[s:i]))}|{','.join(map(str, b[t:j]))}")
        return ";".join(out)


@lru_cache(maxsize=1)
def _aligner(byte_bpe: str, pieces: str) -> Aligner:
    """One for each Python worker, kept from task to task."""
    return Aligner(byte_bpe, pieces)


class Links:
    """The groups of a block's segments as arrays: counts by segment, and its linked id pairs with how often each is linked."""

    def __init__(self, groups: list[str | None]):
        self.text = groups
        self.good = np.array([g is not None for g in groups], bool)
        self.n_a, self.n_b, self.n_groups = (np.zeros(len(groups), np.int32) for _ in range(3))
        found = [self._some(s) for s in range(0, len(groups), PARSED)]
        segment, pair, times = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(3))
        self.pairs, code = np.unique(pair, return_inverse=True)
        self.pair, self.times = code.astype(np.int32), times
        self.begin = np.searchsorted(segment, np.arange(len(groups) + 1))

    def _some(self, start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Segment, id pair and times of the links of ``PARSED`` segments, each segment and pair once."""
        groups = self.text[start : start + PARSED]
        raw = np.frombuffer("".join(f"{g or ''}\n" for g in groups).encode(), np.uint8)
        mark = np.flatnonzero((raw < 48) | (raw > 57))  # separators: line end, comma, semicolon, bar
        digits = np.diff(mark, prepend=-1) - 1
        value = np.zeros(len(mark), np.int64)
        for k in range(int(digits.max(initial=0))):
            value += np.where(k < digits, (raw[np.maximum(mark - 1 - k, 0)].astype(np.int64) - 48) * 10**k, 0)
        sep = raw[mark]
        before_of = lambda stop: np.cumsum(stop) - stop
        segment, group = before_of((sep == 10).astype(np.int64)), before_of(((sep == 10) | (sep == 59)).astype(np.int64))
        # a token is on the second side if its group's bar came before it
        ends, bars = np.flatnonzero((sep == 10) | (sep == 59)), np.flatnonzero(sep == 124)
        bar_of = np.full(len(ends), -1)
        bar_of[np.searchsorted(ends, bars)] = bars
        here, right = digits > 0, np.arange(len(mark)) > bar_of[group]
        n = len(groups)
        self.n_a[start : start + n], self.n_b[start : start + n] = (np.bincount(segment[here & (right == r)], minlength=n) for r in (False, True))
        self.n_groups[start : start + n] = np.bincount(segment[bars], minlength=n)
        # distinct ids of a group on both sides, then their products
        sides = []
        for r in (False, True):
            at = here & (right == r)
            key, count = np.unique((group[at] << 32) | value[at], return_counts=True)
            sides.append((key >> 32, key & 0xFFFFFFFF, count))
        (ga, ia, ca), (gb, ib, cb) = sides
        first = np.searchsorted(gb, ga)
        width = np.searchsorted(gb, ga, side="right") - first
        other = np.repeat(first - (np.cumsum(width) - width), width) + np.arange(int(width.sum()))
        of_group = np.zeros(len(ends) + 1, np.int64)
        of_group[group] = segment
        pair, code = np.unique((np.repeat(ia, width) << 32) | ib[other], return_inverse=True)
        key, where = np.unique(of_group[np.repeat(ga, width)] * max(len(pair), 1) + code, return_inverse=True)
        times = np.bincount(where, np.repeat(ca, width) * cb[other], len(key)).astype(np.int64)
        return start + key // max(len(pair), 1), pair[key % max(len(pair), 1)], times

    def of_documents(self, codes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(document, pair, times)`` of documents' segments, each document and pair once."""
        n = max(len(self.text), 1)
        at, count = np.unique(owner.astype(np.int64) * n + codes, return_counts=True)
        doc, code = at // n, at % n
        width = self.begin[code + 1] - self.begin[code]
        link = np.repeat(self.begin[code] - (np.cumsum(width) - width), width) + np.arange(int(width.sum()))
        p = max(len(self.pairs), 1)
        key, where = np.unique(np.repeat(doc, width) * p + self.pair[link], return_inverse=True)
        times = np.bincount(where, np.repeat(count, width) * self.times[link], len(key)).astype(np.int64)
        return key // p, key % p, times


def _look(path_a: str, path_b: str):
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = _aligner(path_a, path_b).segments
        numbers = block_numbers()
        block, size, n_slices, known = next(numbers), 0, 0, Known(pa.string())

        def close() -> Iterator[pa.RecordBatch]:
            yield from rows_of(_SEEN_ARROW, len(known.values), at=block * KINDS + ANSWER, key=np.arange(len(known.values)), segment=known.values)

        for batch in batches:
            for first, group in slices(batch.column("text")):
                size += sum(map(len, group))
                parts = [cut(t.decode()) for t in group]
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(p) for p in parts])]), pa.int64())
                codes = pa.LargeListArray.from_arrays(offsets, pa.array(known.codes(list(chain.from_iterable(parts)))))
                yield from rows_of(_SEEN_ARROW, 1, at=block * KINDS + DOCUMENT, key=n_slices, docs=[pack(doc_id=batch.column("doc_id").slice(first, len(group)), codes=codes)])
                n_slices += 1
                if size >= BLOCK_BYTES:
                    yield from close()
                    block, size, n_slices, known = next(numbers), 0, 0, Known(pa.string())
            give_back()
        yield from close()
        del known
        give_back()

    return look


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, text, links, n_docs = None, [], None, None

    def close() -> Iterator[pa.RecordBatch]:
        if links is not None:
            p = np.flatnonzero(n_docs)
            yield from rows_of(_COMPOSED_ARROW, len(p), at=now * KINDS + ANSWER, key=p, a=links.pairs[p] >> 32, b=links.pairs[p] & 0xFFFFFFFF, n=n_docs[p])

    for at, rows in runs(batches, "at"):
        block, kind = divmod(at, KINDS)
        if block != now:
            yield from close()
            now, text, links = block, [], None
        if kind == ANSWER:
            text += rows.column("groups").to_pylist()  # in the order of their codes
            continue
        if links is None:
            links, text = Links(text), []
            give_back()
            n_docs = np.zeros(len(links.pairs), np.int64)
        for n_slice, value in zip(rows.column("key").to_pylist(), rows.column("docs").to_pylist(), strict=True):
            docs = unpack(value)
            n, codes = docs.num_rows, docs.column("codes")
            flat, ends = codes.flatten().to_numpy(), np.asarray(codes.offsets)[1:] - codes.offsets[0].as_py()
            owner = np.repeat(np.arange(n), np.diff(ends, prepend=0))
            bad = np.zeros(n, bool)
            bad[owner[~links.good[flat]]] = True
            use = ~bad[owner]
            total = lambda v: pa.array(np.bincount(owner[use], v[flat[use]], n).astype(np.int64))  # noqa: B023, E731
            digest = ["" if b or s == e else hashlib.sha256(";".join(map(links.text.__getitem__, flat[s:e].tolist())).encode()).hexdigest() for s, e, b in zip([0, *ends[:-1]], ends, bad.tolist(), strict=True)]
            doc, pair, times = links.of_documents(flat[use], owner[use])
            n_docs += np.bincount(pair, minlength=len(n_docs))
            at_doc = pa.array(np.searchsorted(doc, np.arange(n + 1)))
            held = {"pair": pa.LargeListArray.from_arrays(at_doc, pa.array(pair, pa.int32())), "times": pa.LargeListArray.from_arrays(at_doc, pa.array(times))}
            counts = {"n_a": total(links.n_a), "n_b": total(links.n_b), "n_groups": total(links.n_groups), "n_links": pa.array(np.bincount(doc, times, n).astype(np.int64))}
            yield from rows_of(_COMPOSED_ARROW, 1, at=at, key=n_slice, docs=[pack(doc_id=docs.column("doc_id"), **counts, groups_sha256=pa.array(digest, pa.string()), **held)])
        give_back()
    yield from close()
    del links, text
    give_back()


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, parts, count = None, [], None
    for at, rows in runs(batches, "at"):
        block, kind = divmod(at, KINDS)
        if block != now:
            now, parts, count = block, [], None
        if kind == ANSWER:
            parts.append([rows.column(c).to_numpy(zero_copy_only=False) for c in ("key", "n", "top")])
            continue
        if count is None:
            code, n, best = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(3))
            count, top = np.zeros(int(code.max(initial=-1)) + 1, np.int64), np.zeros(int(code.max(initial=-1)) + 1, np.int64)
            count[code], top[code], parts = n, best, []
        for docs in map(unpack, rows.column("docs").to_pylist()):
            ends = np.asarray(docs.column("pair").offsets)
            pair, times = (docs.column(c).flatten().to_numpy() for c in ("pair", "times"))
            exact = lambda w: pa.array([int(x.sum()) for x in np.split(times * w[pair], ends[1:-1])] if docs.num_rows else [], pa.int64())  # noqa: B023, E731
            cols = [*(docs.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")), exact(top), exact(count), docs.column("groups_sha256")]
            yield pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in _RESULT.split(", ")])


def align_documents(docs: DataFrame, byte_bpe: str | None = None, pieces: str | None = None) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of each row.

    A space and the text are encoded by both tokenizers without special tokens,
    whose strings are plain text. Byte offsets where tokens of both end cut them
    into groups, and all pairs of occurrences of one group are links.
    ``n_best`` counts the links whose id pair is in as many documents as any
    other of its first id (ties included), ``count_sum`` sums the documents of
    each link's pair. The digest is of ``a1,a2|b1;a3|b2``.

    Null and empty texts, and those whose tokens' bytes differ from the text on
    either side, have zeros and an empty digest and count in no pair. Texts of
    any length are read whole and may be one segment; repeated rows are
    documents of their own; an empty table stays empty. Columns other than
    doc_id and text are ignored, whatever their names.
    """
    spark = docs.sparkSession
    text_batches(spark)
    paths = byte_bpe or default_tokenizer(), pieces or default_model()
    scratch = Scratch(spark, "alignment")
    slim = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in the order of segments, so all that ask for one stand together and it is worked out once."""
        aligner, last = _aligner(*paths), {}
        for batch in batches:
            d = batch.column("segment").dictionary_encode()
            names = d.dictionary.to_pylist()
            fresh = [n for n in names if n not in last]
            for s in range(0, len(fresh), SEGMENTS):
                last.update(zip(fresh[s : s + SEGMENTS], aligner.groups(fresh[s : s + SEGMENTS]), strict=True))
            groups = pa.array([last[n] for n in names], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("at"), batch.column("key"), groups.take(d.indices)], names=["at", "key", "groups"])
            last = {names[-1]: last[names[-1]]} if names else last
        give_back()

    nothing = F.lit(None).cast("binary").alias("docs")
    seen = scratch.put(slim.mapInArrow(_look(*paths), _SEEN), "seen")
    asked = seen.where(of_kind(ANSWER)).select("segment", "at", "key")
    answers = asked.repartition("segment").sortWithinPartitions("segment").mapInArrow(align, "at bigint, key bigint, groups string").withColumn("docs", nothing)
    texts = seen.where(of_kind(DOCUMENT)).select("at", "key", F.lit(None).cast("string").alias("groups"), "docs")
    composed = scratch.put(by_block(answers.unionByName(texts)).mapInArrow(_compose, _COMPOSED), "composed")
    scratch.drop(seen)
    pairs = composed.where(of_kind(ANSWER)).select("a", "b", "at", "key", "n")
    counts = pairs.groupBy("a", "b").agg(F.sum("n").alias("n"))
    of_first = Window.partitionBy("a")  # as many rows as the second vocabulary has at most
    counts = scratch.put(counts.withColumn("top", (F.col("n") == F.max("n").over(of_first)).cast("int")), "counts")
    judged = pairs.drop("n").join(counts, ["a", "b"]).select("at", "key", "n", "top", nothing)
    done = composed.where(of_kind(DOCUMENT)).select("at", "key", F.lit(None).cast("long").alias("n"), F.lit(None).cast("int").alias("top"), "docs")
    return by_block(judged.unionByName(done)).mapInArrow(_judge, _RESULT)


def op11_alignment(spark, sf_dir: str) -> DataFrame:
    return align_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
