"""Context-tree weighting against the recursion as it is written, byte by byte; words against counters."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from greensward.llm import lm_scoring
from greensward.llm.context_tree import log_kt, window_scores, windows
from greensward.plans.scratch import Scratch

SF = "/root/testdata/sf0.001"


def brute_scores(texts, train, depth):
    """Log10 probability of each text by trees of contexts that are filled symbol by symbol."""
    seen = defaultdict(lambda: [0, 0])
    steps = lambda t: ((bit, (1 << i) | (t[k] >> (8 - i)), t[k - depth : k]) for k in range(depth, len(t)) for i in range(8) for bit in [(t[k] >> (7 - i)) & 1])
    padded = [b"\n" * depth + t for t in texts]
    for t, use in zip(padded, train, strict=True):
        if use:
            for bit, p, ctx in steps(t):
                for d in range(depth + 1):
                    seen[p, ctx[depth - d :]][bit] += 1
    kids = defaultdict(set)
    for p, ctx in list(seen):
        if ctx:
            kids[p, ctx[1:]].add((p, ctx))

    log_pe = lambda n: math.lgamma(n[0] + 0.5) + math.lgamma(n[1] + 0.5) - math.log(math.pi) - math.lgamma(n[0] + n[1] + 1)
    pw = {}

    def log_pw(node):
        if node not in pw:
            pe = log_pe(seen[node])
            if len(node[1]) < depth:
                below = sum(map(log_pw, kids[node]))
                pe = math.log(0.5) + max(pe, below) + math.log1p(math.exp(-abs(pe - below)))
            pw[node] = pe
        return pw[node]

    def predict(p, ctx, d, bit):
        node = (p, ctx[depth - d :])
        n = seen[node] if node in seen else [0, 0]
        mine = (n[bit] + 0.5) / (n[0] + n[1] + 1)
        if d == depth:
            return mine
        share = math.exp(math.log(0.5) + log_pe(n) - log_pw(node)) if node in pw or node in seen else 0.5
        return share * mine + (1 - share) * predict(p, ctx, d + 1, bit)

    return [math.fsum(math.log10(predict(p, ctx, 0, bit)) for bit, p, ctx in steps(t)) for t in padded]


def test_kt_is_the_product_of_its_steps():
    for a, b in [(0, 0), (1, 0), (0, 3), (7, 5), (40, 1)]:
        want = sum(math.log((k + 0.5) / (k + 1)) for k in range(a)) + sum(math.log((k + 0.5) / (a + k + 1)) for k in range(b))
        assert log_kt(np.array([a]), np.array([b]))[0] == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_windows_score_like_the_recursion(spark, depth):
    rng = random.Random(depth)
    texts = ["".join(rng.choice("ab c") for _ in range(rng.randrange(40))) + rng.choice(["", "é", "\x00z"]) for _ in range(30)]
    raw = [lm_scoring.normal(t.encode()) for t in texts]
    train = [i % 3 > 0 for i in range(30)]
    counts = Counter()
    for t, use in zip(raw, train, strict=True):
        for w in windows(b"\n" * depth + t, depth).tolist():
            counts[w] += use
    rows = spark.createDataFrame(list(counts.items()), "gram bigint, n bigint")
    got = dict(window_scores(rows, depth, Scratch(spark, "test")).collect())
    assert set(got) == set(counts)
    for t, want in zip(raw, brute_scores(raw, train, depth), strict=True):
        assert sum(got[w] for w in windows(b"\n" * depth + t, depth).tolist()) == pytest.approx(want, abs=1e-6)


def check(spark, rows, depth):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = lm_scoring.language_scores(docs, lm_scoring.held_out(F.col("doc_id")), depth).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((i is None, i or 0) for i, _ in rows)
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    raw = [lm_scoring.normal((t or "").encode()) for _, t in rows]
    c = Counter()
    for t, h in zip(raw, held, strict=True):
        if not h:
            c.update([*t.split(), b""])
    n, v = sum(c.values()), len(c)
    want = []
    for (i, _), t, h, score in zip(rows, raw, held, brute_scores(raw, [not h for h in held], depth), strict=True):
        tokens = [*t.split(), b""]
        base = math.fsum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        want.append((i or 0, h, len(tokens), sum(c[w] > 0 for w in tokens), n, base, score, len(t)))
    have = sorted((r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score, r.n_bytes) for r in got)
    for a, b in zip(have, sorted(want), strict=True):
        assert a[:5] == b[:5] and a[7] == b[7] and a[5:7] == pytest.approx(b[5:7], abs=1e-6)
    assert all(r.bits_per_byte == pytest.approx(-r.score / math.log10(2) / r.n_bytes) for r in got)


def test_scores_of_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "BLOCK_BYTES", 300)
    monkeypatch.setattr(lm_scoring, "SLICE_BYTES", 40)
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, "One two\ttwo"), (4, "One two\ttwo"), (5, "é ü \x1c \x00"), (None, "no id"), (6, "word " * 500), (7, "x" * 900)]
    rows += [(100 + i, f"Some words number {i % 7} and more WORDS") for i in range(60)]
    check(spark, rows, 2)
    check(spark, [(i, "a b") for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 1], 2)
    empty = spark.createDataFrame([], "doc_id bigint, text string, held boolean, block int, kind string")
    assert lm_scoring.language_scores(empty, lm_scoring.held_out(F.col("doc_id")), 2).count() == 0


def test_clashing_columns_are_ignored(spark):
    docs = spark.createDataFrame([(1, "a b", "x", 3, None), (2, "a c", "y", 4, None)], "doc_id bigint, text string, block string, score int, key string")
    assert sorted(r.doc_id for r in lm_scoring.language_scores(docs, F.lit(False), 1).collect()) == [1, 2]


def test_texts_of_the_tables_by_the_recursion(spark):
    docs = [r for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    check(spark, [(r.doc_id, r.text[:400] if r.text else r.text) for r in docs], 3)
