"""Whitening against exact fractions and a dense computation."""

import math
from fractions import Fraction

import numpy as np
import pytest

from greensward.llm import whitening

SF = "/root/testdata/sf0.001"


def brute(rows, k=4):
    """``(n, {vec_id: [(deviation, whitened by component)]}, explained)`` with exact sums."""
    good = [(i, [math.floor(float(c) * 256) for c in v]) for i, v in rows if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v)]
    lengths = [len(x) for _, x in good]
    d = max(set(lengths), key=lambda m: (lengths.count(m), m))
    good = [(i, x) for i, x in good if len(x) == d]
    fit = sorted({tuple(x) for _, x in good})
    n, s = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    cov = [[float(sum(Fraction(n * x[a] - s[a]) * (n * x[b] - s[b]) for x in fit) / n**3) for b in range(d)] for a in range(d)]
    e, v = np.linalg.eigh(np.array(cov))
    e, v = e[::-1], v[:, ::-1]
    out = {}
    for i, x in good:
        z = [n * a - b for a, b in zip(x, s, strict=True)]
        out.setdefault(i, []).append((sum(a * a for a in z), np.array([a / n for a in z]) @ v[:, :k] / np.sqrt(e[:k])))
    return n, out, e / e.sum()


def check(got, rows):
    n, want, explained = brute(rows)
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.component), []).append(r)
    assert sorted({i for i, _ in by}) == sorted(want)
    signs = {}
    for (i, c), found in by.items():
        mine = sorted((r.deviation, r.whitened) for r in found)
        theirs = [(dev, w[c - 1]) for dev, w in want[i]]
        if c not in signs and abs(theirs[0][1]) > 1e-3:
            signs[c] = math.copysign(1, mine[0][1] * theirs[0][1])
        theirs = sorted((dev, w * signs.get(c, 1)) for dev, w in theirs)
        assert [m[0] for m in mine] == [t[0] for t in theirs]
        assert [m[1] for m in mine] == pytest.approx([t[1] for t in theirs], abs=1e-6)
        assert all(r.n == n and r.explained == pytest.approx(explained[c - 1], rel=1e-6) and r.identity_error < 1e-6 for r in found)


def test_small_vectors_by_fractions(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(c) for c in rng.normal(size=5) * [1, 2, 3, 0.5, 1.5]]) for i in range(60)]
    rows += [(60 + i, rows[3][1]) for i in range(30)]  # a third are copies
    rows += [(3, rows[4][1]), (200, None), (201, [1.0, None, 0.0, 0.0, 0.0]), (202, [math.nan, 1.0, 0.0, 0.0, 0.0]), (203, [math.inf, 0.0, 0.0, 0.0, 0.0]), (204, []), (205, [1.0, 2.0]), (206, [-0.0, 0.0, 0.0, 0.0, 0.0])]
    docs = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id bigint, embedding array<float>, x string, n int")
    rows = [(i, v and [c if c is None else float(np.float32(c)) for c in v]) for i, v in rows]
    check(whitening.whiten(docs).collect(), rows)


def test_the_table(spark):
    got = whitening.op13_whitening(spark, SF).collect()
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    n, want, explained = brute(rows)
    assert len(got) == 4 * sum(map(len, want.values()))
    # whitened values over the fit list have unit variance and no correlation
    first, seen = {}, set()
    for r in got:
        first.setdefault(r.vec_id, {})[r.component] = r.whitened
        assert r.n == n and r.deviation in {d for d, _ in want[r.vec_id]} and r.explained == pytest.approx(explained[r.component - 1], rel=1e-6)
    distinct = []
    for i, v in rows:
        if i in first and (key := tuple(math.floor(c * 256) for c in v)) not in seen:
            seen.add(key)
            distinct.append([first[i][c] for c in (1, 2, 3, 4)])
    assert np.abs(np.cov(np.array(distinct).T, bias=True) - np.eye(4)).max() < 1e-4
    assert max(r.identity_error for r in got) < 1e-4


def test_without_variance(spark):
    ddl = "vec_id bigint, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], ddl)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [])], ddl)).count() == 0
    one = whitening.whiten(spark.createDataFrame([(1, [0.5, 1.0]), (None, [0.5, 1.0])], ddl)).collect()
    assert sorted((r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one if r.vec_id == 1) == [(1, 1, 0, None, None, None), (2, 1, 0, None, None, None)] and len(one) == 4
    flat = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i, 1.0]) for i in range(6)], ddl)).collect()
    assert all((r.whitened is not None) == (r.component == 1) for r in flat)
    assert flat[0].identity_error < 1e-9


def test_large_numbers_are_exact_or_fail():
    z = np.array([[1 << 31, 3], [5, -7]], np.int64)
    assert whitening.squares(z).tolist() == [(1 << 62) + 9, 74]
    with pytest.raises(OverflowError):
        whitening.squares(np.array([[1 << 32, 0]], np.int64))
    with pytest.raises(OverflowError):
        whitening.centred(np.array([[1 << 40]]), 1 << 30, np.array([0]))
