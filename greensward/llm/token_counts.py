"""Unigram token counts, one dynamic program for each prefix that distinct words share."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from greensward.llm.memory import text_batches

#: What an unknown character costs below the worst piece, words a worker remembers, and texts counted together.
UNKNOWN_PENALTY, MEMO_WORDS, GROUP_BYTES = 10.0, 500_000, 8 << 20
SPACE = "▁"


def default_model() -> str:
    """Path of the 32k piece file of the public tokenizer set."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def load_pieces(path: str) -> dict[str, float]:
    """Pieces and their log-probabilities; without bytes, controls and the unknown piece.

    A unigram file brings log-probabilities. A BPE file brings ranks, from which
    Zipf's law makes a distribution over the pieces: the piece of rank r has a
    share in proportion to 1 / r. Nothing is trained.
    """
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {m.id_to_piece(i): m.get_score(i) for i in range(m.vocab_size()) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))}
    ranked = sorted(found, key=lambda p: (-found[p], p))
    if not all(s == int(s) for s in found.values()):
        return found
    total = math.log(math.fsum(1 / r for r in range(1, len(ranked) + 1)))
    return {p: -math.log(r) - total for r, p in enumerate(ranked, 1)}


class TrieCounter:
    """Counts the pieces of words by the best-scoring segmentation, ties to fewer pieces.

    New words are taken in sorted order, which visits their trie depth first:
    the path to the last word stays on a stack of forward states, and only the
    characters behind the prefix that two neighbours share get new ones. A
    state is (score, pieces) of the best segmentation of that prefix; the state
    at a word's end is its terminal count.
    """

    def __init__(self, pieces: dict[str, float]):
        # by last character: which lengths of pieces end in it
        self.pieces = pieces
        ends: dict[str, set[int]] = {}
        for p in pieces:
            ends.setdefault(p[-1], set()).add(len(p))
        self.ends = {c: sorted(n) for c, n in ends.items()}
        self.unknown = min(pieces.values(), default=0.0, key=lambda s: (s < -1e8, s)) - UNKNOWN_PENALTY
        self.memo: dict[bytes, int] = {}

    def learn(self, words: list[bytes]) -> None:
        """Add words that aren't remembered yet."""
        if len(self.memo) + len(words) > MEMO_WORDS:
            self.memo.clear()
        pieces, ends, unknown, memo = self.pieces, self.ends, self.unknown, self.memo
        last, score, count = "", [0.0], [0]
        for text, word in sorted((SPACE + w.decode(errors="replace"), w) for w in words):
            shared = 0
            for a, b in zip(text, last):
                if a != b:
                    break
                shared += 1
            del score[shared + 1 :], count[shared + 1 :]
            for d in range(shared + 1, len(text) + 1):
                c = text[d - 1]
                best, n = score[d - 1] + unknown, count[d - 1] + len(c.encode())
                for k in ends.get(c, ()):
                    if k > d:
                        break
                    s = pieces.get(text[d - k : d])
                    if s is not None:
                        s += score[d - k]
                        if s > best or (s == best and count[d - k] + 1 < n):
                            best, n = s, count[d - k] + 1
                score.append(best)
                count.append(n)
            memo[word] = count[-1]
            last = text

    def count(self, texts: list[bytes]) -> list[tuple[int, int]]:
        """``(words, pieces)`` of each text."""
        words = [t.split() for t in texts]
        distinct = set().union(*words)
        new = [w for w in distinct if w not in self.memo]
        if len(self.memo) + len(new) > MEMO_WORDS:
            new = list(distinct)
        self.learn(new)
        get = self.memo.__getitem__
        return [(len(w), sum(map(get, w))) for w in words]


@lru_cache(maxsize=1)
def _counter(path: str) -> TrieCounter:
    return TrieCounter(load_pieces(path))


def token_counts(text: Column, model: str | None = None) -> Column:
    """``struct<n_words, n_tokens>`` of every whole text.

    Words are runs of ``[^\\x20\\x09-\\x0D]``; each stands as a pre-token with
    a leading space mark. Pieces and scores come from a public piece file; a
    character in no piece counts as its UTF-8 bytes. Null and empty texts, and
    texts of white space, have 0 of both; of segmentations with equal scores the
    one with fewer pieces counts. Texts and words of any length are read whole,
    repeated rows count again, and an empty table stays empty.
    """
    text_batches(SparkSession.getActiveSession())
    path = model or default_model()

    @F.arrow_udf("struct<n_words:bigint,n_tokens:bigint>")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = _counter(path)
        for batch in batches:
            rows, group, size = [], [], 0
            for x in batch:
                group.append((x.as_py() or "").encode())
                size += len(group[-1])
                if size > GROUP_BYTES:
                    rows += counter.count(group)
                    group, size = [], 0
            rows += counter.count(group)
            yield pa.StructArray.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1)], ["n_words", "n_tokens"])

    return count.asNondeterministic()(text)


def op9_token_counts(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return docs.select("doc_id", token_counts(F.col("text")).alias("c")).select("doc_id", "c.*")
