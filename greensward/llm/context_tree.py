"""Context-tree weighting over bytes, learned from a whole corpus.

A byte is eight binary decisions; the bits before one in its byte choose the
tree, the bytes before choose a path in it. Each node of a tree is a context of
0 to ``depth`` bytes with the zeros and ones seen behind it. ``Pe`` is the
Krichevsky-Trofimov probability of these, and bottom-up

    Pw = Pe                              at the full depth
    Pw = 1/2 Pe + 1/2 product of Pw of the longer contexts

which mixes all prunings of the tree. What is predicted after training mixes the
estimates of all depths: a node has the share ``1/2 Pe / Pw`` of what comes down
to it, and passes the rest to the longer context. A context never seen estimates
1/2, as the formulas say.

Windows of ``depth + 1`` bytes with their counts are all that training needs,
since every node's counts are sums of theirs. Windows are packed in a long, the
last byte lowest. The lowest two depths are worked out window by window in tasks
that hold all windows of a context of ``depth - 1`` bytes (65,536 at most), the
others are aggregations and joins of nodes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greensward.llm.blocks import runs
from greensward.plans.scratch import Scratch

#: Windows that a task works on at once, unless one context has more.
CHUNK = 200_000
NODES = "ctx bigint, p int, n0 bigint, n1 bigint, lpw double"


def _log_gamma(x, log):
    """Stirling's series eight places up; for numpy arrays and columns alike."""
    y = x + 8.0
    down = log(x * (x + 1) * (x + 2) * (x + 3)) + log((x + 4) * (x + 5) * (x + 6) * (x + 7))
    return (y - 0.5) * log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y) - down


def log_kt(n0, n1, log=np.log):
    """Natural logarithm of the Krichevsky-Trofimov probability of ``n0`` zeros and ``n1`` ones."""
    return _log_gamma(n0 + 0.5, log) + _log_gamma(n1 + 0.5, log) - math.log(math.pi) - _log_gamma(n0 + n1 + 1.0, log)


def windows(data: bytes, depth: int) -> np.ndarray:
    """The packed windows of ``depth + 1`` bytes that begin at each place."""
    n = depth + 1
    # runs of 1, 2, 4 bytes, each two of the half before it, then those whose lengths add up to n
    run, have, width = np.frombuffer(data, np.uint8), {}, 1
    while width <= n:
        have[width] = run
        if 2 * width <= n:
            wide = run[: max(len(run) - width, 0)].astype(f"u{2 * width}")
            run = (wide << (8 * width)) | run[width : width + len(wide)]
        width *= 2
    out = np.zeros(max(len(data) - depth, 0), np.int64)
    at = 0
    for width in sorted(have, reverse=True):
        if n - at >= width:
            out <<= 8 * width
            out |= have[width][at : at + len(out)].astype(np.int64)
            at += width
    return out


class _Level:
    """Nodes of one depth for one bit: ``at`` is the node of each window."""

    def __init__(self, gram: np.ndarray, n: np.ndarray, depth: int, bit: int):
        sym = gram & 255
        ctx = (gram >> 8) & ((1 << 8 * depth) - 1)
        self.key, self.at = np.unique((ctx << bit) | (sym >> (8 - bit)), return_inverse=True)
        one = (sym >> (7 - bit)) & 1
        self.n1 = np.bincount(self.at, n * one, len(self.key))
        self.n0 = np.bincount(self.at, n * (1 - one), len(self.key))
        self.lpe = log_kt(self.n0, self.n1)
        self.share, self.lpw = np.ones(len(self.key)), self.lpe

    def weigh(self, longer: _Level) -> None:
        parent = np.zeros(len(longer.key), np.int64)
        parent[longer.at] = self.at
        self.lpw = math.log(0.5) + np.logaddexp(self.lpe, np.bincount(parent, longer.lpw, len(self.key)))
        self.share = np.exp(math.log(0.5) + self.lpe - self.lpw)

    def estimate(self, one: np.ndarray) -> np.ndarray:
        """The probability of each window's bit by its node alone."""
        return (np.where(one, self.n1[self.at], self.n0[self.at]) + 0.5) / (self.n0 + self.n1 + 1)[self.at]


def _levels(gram: np.ndarray, n: np.ndarray, depth: int, bit: int) -> tuple[_Level, _Level]:
    full, above = _Level(gram, n, depth, bit), _Level(gram, n, depth - 1, bit)
    above.weigh(full)
    return full, above


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by ``ctx`` in tables of about ``CHUNK`` rows that hold whole contexts."""
    held, size, last = [], 0, None
    for ctx, rows in runs(batches, "ctx"):
        if ctx != last and size >= CHUNK:
            yield pa.Table.from_batches(held)
            held, size = [], 0
        held.append(rows)
        size, last = size + rows.num_rows, ctx
    if held:
        yield pa.Table.from_batches(held)


def _log_half_sum(a: Column, b: Column) -> Column:
    top = F.greatest(a, b)
    return top + F.log(F.exp(a - top) + F.exp(b - top)) + math.log(0.5)


def window_scores(grams: DataFrame, depth: int, scratch: Scratch) -> DataFrame:
    """``gram, lp``: the log10 probability of each window's last byte behind the others.

    ``grams`` has every window once and ``n``, how often training texts hold it;
    windows with an ``n`` of 0 are scored and teach nothing.
    """
    k = depth - 1
    cut = lambda c, d: c.bitwiseAND(F.lit((1 << 8 * d) - 1).cast("long"))
    dealt = grams.select(cut(F.shiftright("gram", 8), k).alias("ctx"), "gram", "n")

    def lowest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole(batches):
            gram, n = t.column("gram").to_numpy(), t.column("n").to_numpy()
            for bit in range(8):
                _, up = _levels(gram, n, depth, bit)
                p = (1 << bit) | (up.key & ((1 << bit) - 1))
                cols = [up.key >> bit, p.astype(np.int32), up.n0.astype(np.int64), up.n1.astype(np.int64), up.lpw]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["ctx", "p", "n0", "n1", "lpw"])

    nodes = [scratch.put(dealt.repartition("ctx").sortWithinPartitions("ctx").mapInArrow(lowest, NODES), f"nodes{k}")]
    for d in range(k - 1, -1, -1):
        up = nodes[0].groupBy(cut(F.col("ctx"), d).alias("ctx"), "p").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("lpw").alias("below"))
        up = up.withColumn("lpe", log_kt(F.col("n0"), F.col("n1"), F.log)).withColumn("lpw", _log_half_sum(F.col("lpe"), F.col("below")))
        nodes.insert(0, scratch.put(up.withColumn("share", F.exp(F.col("lpe") + math.log(0.5) - F.col("lpw"))), f"nodes{d}"))
    # what the shorter contexts say of a zero and a one, and the share that they pass on
    said = None
    for d in range(k):
        here = nodes[d].withColumns({"k0": (F.col("n0") + 0.5) / (F.col("n0") + F.col("n1") + 1), "k1": (F.col("n1") + 0.5) / (F.col("n0") + F.col("n1") + 1)})
        if said is None:
            here = here.withColumns({"s0": F.lit(0.0), "s1": F.lit(0.0), "rest": F.lit(1.0)})
        else:
            here = here.withColumn("up", cut(F.col("ctx"), d - 1)).join(said.withColumnRenamed("ctx", "up"), ["up", "p"])
        mine = F.col("rest") * F.col("share")
        said = here.select("ctx", "p", (F.col("s0") + mine * F.col("k0")).alias("s0"), (F.col("s1") + mine * F.col("k1")).alias("s1"), (F.col("rest") - mine).alias("rest"))
    lowest_nodes = nodes[-1].select("ctx", "p")
    if said is None:
        priors = lowest_nodes.withColumns({"s0": F.lit(0.0), "s1": F.lit(0.0), "rest": F.lit(1.0)})
    else:
        priors = lowest_nodes.withColumn("up", cut(F.col("ctx"), k - 1)).join(said.withColumnRenamed("ctx", "up"), ["up", "p"]).drop("up")
    both = dealt.select("ctx", "gram", "n", *[F.lit(None).cast(t).alias(c) for c, t in (("p", "int"), ("s0", "double"), ("s1", "double"), ("rest", "double"))])
    both = both.unionByName(priors.select("ctx", F.lit(None).cast("long").alias("gram"), F.lit(None).cast("long").alias("n"), "p", "s0", "s1", "rest"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole(batches):
            is_gram = t.column("gram").is_valid()
            g, up = t.filter(is_gram), t.filter(t.column("p").is_valid())
            gram, n = g.column("gram").to_numpy(), g.column("n").to_numpy()
            p, s0, s1, rest = (up.column(c).to_numpy() for c in ("p", "s0", "s1", "rest"))
            key = (up.column("ctx").to_numpy() << 8) | p
            order = np.argsort(key)
            key, s0, s1, rest = key[order], s0[order], s1[order], rest[order]
            total = np.zeros(len(gram))
            for bit in range(8):
                full, above = _levels(gram, n, depth, bit)
                one = ((gram >> (7 - bit)) & 1).astype(bool)
                share = above.share[above.at]
                prob = share * above.estimate(one) + (1 - share) * full.estimate(one)
                node = (1 << bit) | (above.key & ((1 << bit) - 1))
                at = np.searchsorted(key, ((above.key >> bit) << 8) | node)[above.at]
                total += np.log10(np.where(one, s1[at], s0[at]) + rest[at] * prob)
            yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(total)], names=["gram", "lp"])

    return both.repartition("ctx").sortWithinPartitions("ctx").mapInArrow(score, "gram bigint, lp double")
