"""Byte-level BPE ids of whole texts, by the tokenizers library over distinct chunks.

A text may be cut before every single space or line end between two characters
that aren't white space: the byte-level pre-tokenizer starts a new piece there
whatever stands before it, so the ids of a text are those of its chunks in
turn. Words repeat, so each distinct chunk is encoded once for each worker,
which remembers chunks as an Arrow array and looks them up there.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks that a worker remembers; beyond that those met once go. Bytes of text encoded at a time.
MEMO_CHUNKS, SLICE_BYTES = 150_000, 2 << 20

_CUT = re.compile(r"(?<=\S)(?= \S)")
#: White space beside a space, or a space at an end of the text (RE2; every code point that either library calls white space).
_WHITE = r"\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
#: The mark that is put where texts are cut; texts that hold it go the slower way.
_MARK = "\x01"
_UNEVEN = rf"[{_WHITE}] | [{_WHITE}]|^ | $|\A \z|\x01"
_LINE_END = rf"([^{_WHITE}])\n([^{_WHITE}])"


def default_tokenizer() -> str:
    """Path of the 50k byte-level BPE file of the public tokenizer set."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class ChunkEncoder:
    """Encodes Arrow string arrays to flat id arrays; ``end_id`` closes every text."""

    def __init__(self, path: str, end_id: int | None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        first = [t[0] for t, _ in sorted(self.tok.get_vocab().items(), key=lambda x: x[1])]
        self.starts = {mark: np.array([c == byte for c in first]) for mark, byte in ((" ", "Ġ"), ("\n", "Ċ"))}
        self.end_id = end_id
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.at, self.n, self.hits = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int8)

    def _shrink(self) -> None:
        """Keep the chunks that more than one slice had."""
        keep = self.hits > 1
        if 2 * keep.sum() > len(keep):
            return self._forget()
        at, n = self.at[keep], self.n[keep].astype(np.int64)
        begin = np.cumsum(n) - n
        self.ids = self.ids[np.repeat(at - begin, n) + np.arange(int(n.sum()))]
        self.known, self.at, self.n, self.used = self.known.filter(pa.array(keep)), begin, self.n[keep], len(self.ids)
        self.hits = np.ones(len(n), np.int8)

    def _learn(self, keys: pa.Array) -> None:
        """Encode new chunks, a hundred at a time where those that start alike stand in a row."""
        rows, sizes = [], []
        ends = np.append(np.arange(0, len(keys), 100), len(keys))
        firsts = pc.utf8_slice_codeunits(keys, 0, 1)
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), keys), pa.scalar("", pa.large_string())).to_pylist()
        for s, e, text, got in zip(ends[:-1], ends[1:], texts, self.tok.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(got.ids, np.uint32)
            mark = text[0]
            start = np.flatnonzero(self.starts[mark][ids]) if mark in self.starts else ids[:0]
            if len(start) == e - s and start[0] == 0 and firsts[e - 1].as_py() == mark:
                rows.append(ids)
                sizes.append(np.diff(np.append(start, len(ids))))
            else:
                each = [np.array(x.ids, np.uint32) for x in self.tok.encode_batch_fast(keys[s:e].to_pylist(), add_special_tokens=False)]
                rows += each
                sizes.append(np.array([len(x) for x in each]))
        ids, n = np.concatenate(rows), np.concatenate(sizes).astype(np.int32)
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(ids)] = ids
        self.known = pa.concat_arrays([self.known, keys])
        self.at = np.append(self.at, self.used + np.cumsum(n) - n)
        self.n, self.hits = np.append(self.n, n), np.append(self.hits, np.zeros(len(n), np.int8))
        self.used += len(ids)

    def _codes(self, keys: pa.Array) -> np.ndarray:
        """Places in the memo of distinct chunks, new ones learned first."""
        found = pc.index_in(keys, value_set=self.known)
        code = pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = np.flatnonzero(code < 0)
        if len(new):
            fresh = keys.take(pa.array(new))
            order = np.asarray(pc.sort_indices(pc.utf8_slice_codeunits(fresh, 0, 1)))
            code[new[order]] = len(self.known) + np.arange(len(new))
            self._learn(fresh.take(pa.array(order)))
        self.hits[code] = np.minimum(self.hits[code] + 1, 2)
        return code

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, offsets)``: text i has ``ids[offsets[i]:offsets[i + 1]]``; null counts as empty."""
        if len(self.known) > MEMO_CHUNKS:
            self._shrink()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        uneven = np.asarray(pc.match_substring_regex(texts, _UNEVEN)) | np.asarray(pc.equal(pc.binary_length(texts), 0))
        # behind each cut stands a mark and the chunk, which begins with the space or line end that was cut before
        even = pc.replace_substring(texts.filter(pa.array(~uneven)), " ", _MARK + " ")
        even = pc.replace_substring_regex(even, _LINE_END, f"\\1{_MARK}\n\\2")
        slow = [_CUT.split(t) if t else [] for t in texts.filter(pa.array(uneven)).to_pylist()]
        split = pc.split_pattern(even, _MARK)
        count = np.empty(len(texts), np.int64)
        count[~uneven] = np.diff(np.asarray(split.offsets))
        count[uneven] = [len(x) for x in slow]
        chunks = pa.concat_arrays([split.flatten(), pa.array([c for x in slow for c in x], pa.large_string())]).dictionary_encode()
        flat = self._codes(chunks.dictionary)[np.asarray(chunks.indices)] if len(chunks) else np.zeros(0, np.int64)
        size = self.n[flat].astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(size)])
        total = int(ends[-1])
        ids = self.ids[np.repeat(self.at[flat] - ends[:-1], size) + np.arange(total)]
        # the even texts' ids stand first, the uneven ones' behind them
        order = np.concatenate([np.flatnonzero(~uneven), np.flatnonzero(uneven)])
        length = np.empty(len(texts), np.int64)
        length[order] = np.diff(ends[np.concatenate([[0], np.cumsum(count[order])])])
        if slow and len(slow) < len(texts):
            first = np.empty(len(texts), np.int64)
            first[order] = np.cumsum(length[order]) - length[order]
            begin = np.cumsum(length) - length
            ids = ids[np.repeat(first - begin, length) + np.arange(total)]
        offsets = np.concatenate([[0], np.cumsum(length)])
        if self.end_id is not None:
            ids = np.insert(ids, offsets[1:], self.end_id).astype(np.uint32)
            offsets = offsets + np.arange(len(offsets))
        return ids, offsets

    def documents(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, at most ``SLICE_BYTES`` of text (or one text) in work at a time."""
        sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)
        group = np.cumsum(sizes) // SLICE_BYTES
        for g in np.unique(group):
            rows = np.flatnonzero(group == g)
            ids, off = self.encode(texts.slice(rows[0], len(rows)))
            for i in range(len(rows)):
                yield ids[off[i] : off[i + 1]]


@lru_cache(maxsize=2)
def encoder(path: str, end_id: int | None) -> ChunkEncoder:
    """One encoder for each Python worker, kept from task to task."""
    return ChunkEncoder(path, end_id)
