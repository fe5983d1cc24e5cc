"""A histogram gradient-boosted classifier over document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greensward.llm.quality_rules import LOWER, SPACES, UPPER, _count, repeated_words
from greensward.llm.sampling import hashed_rows

#: Labelled documents to learn from at most; shape of the ensemble.
TRAIN_DOCS, TREES, DEPTH, BINS, RATE, LAMBDA, MIN_ROWS = 20_000, 80, 4, 64, 0.15, 1.0, 20
#: Scores from here on are predicted as good.
GOOD = 0.7

STATISTICS = (
    "log_bytes", "log_words", "word_length", "upper", "digits", "symbols", "pipes", "bangs", "punctuation", "stops", "wide", "distinct", "top_word",
    "stutter", "repeats", "log_lines", "line_length", "dup_lines", "short_lines", "stop_lines", "upper_lines", "symbol_lines", "long_words", "control",
)


def statistics(b: bytes) -> tuple[float, ...]:
    """The features of one UTF-8 text, in the order of ``STATISTICS``."""
    words = b.split()
    n, w = max(len(b), 1), max(len(words), 1)
    up, low = _count(b, UPPER), _count(b, LOWER)
    tally: dict[bytes, int] = {}
    for x in words:
        tally[x] = tally.get(x, 0) + 1
    lines = [x for x in b.split(b"\n") if x.strip(SPACES)]
    m = max(len(lines), 1)
    chars = len(b) - _count(b, bytes(range(0x80, 0xC0)))
    return (
        np.log1p(len(b)), np.log1p(len(words)), chars / w, up / (up + low + 1), _count(b, b"0123456789") / n, _count(b, b"#*$%&<>") / w, b.count(b"|") / w,
        b.count(b"!") / w, _count(b, b".,;:?") / w, _count(b, b".?") / w, (len(b) - chars) / n, len(tally) / w, max(tally.values(), default=0) / w,
        sum(map(bytes.__eq__, words, words[1:])) / w, repeated_words(words) / w, np.log1p(len(lines)), np.log1p(n / m), 1 - len(set(lines)) / m,
        sum(len(x) < 30 for x in lines) / m, sum(x.rstrip(SPACES).endswith((b".", b"?", b"!")) for x in lines) / m,
        sum(2 * _count(x, UPPER) > len(x) for x in lines) / m, sum(10 * _count(x, b"#*$%&|<>") > len(x) for x in lines) / m,
        sum(len(x) > 24 for x in tally) / w, _count(b, bytes([*range(9), *range(14, 32), 127])) / n,
    )


def table(texts: list[str | None]) -> np.ndarray:
    return np.array([statistics((t or "").encode()) for t in texts], np.float64).reshape(-1, len(STATISTICS))


@dataclass
class Trees:
    """Complete binary trees in arrays: ``feature`` and ``above`` by inner node, ``leaf`` by leaf; children of k are 2k+1 and 2k+2."""

    feature: np.ndarray
    above: np.ndarray
    leaf: np.ndarray
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1; all rows go down a tree together."""
        raw, row, inner = np.full(len(x), self.prior), np.arange(len(x)), self.feature.shape[1]
        for f, a, leaf in zip(self.feature, self.above, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (x[row, f[node]] > a[node])
            raw += leaf[node - inner] if len(node) else 0
        return 1 / (1 + np.exp(-raw))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boost by second-order logistic gain on histograms of at most ``BINS`` quantile bins."""
    n, features = x.shape
    inner = 2**depth - 1
    mean = min(max(float(y.mean()) if n else 0.5, 1e-3), 1 - 1e-3)
    out = Trees(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)), float(np.log(mean / (1 - mean))))
    if not n:
        return out
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(features)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], 1)
    flat = binned + np.arange(features) * BINS
    raw = np.full(n, out.prior)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, wide = 2**level - 1, 2**level
            key = ((node - first)[:, None] * (features * BINS) + flat).ravel()
            hist = [np.bincount(key, np.repeat(v, features), wide * features * BINS).reshape(wide, features, BINS).cumsum(2) for v in (grad, hess, np.ones(n))]
            g, h, c = hist
            gt, ht, ct = g[..., -1:], h[..., -1:], c[..., -1:]
            gain = g**2 / (h + LAMBDA) + (gt - g) ** 2 / (ht - h + LAMBDA) - gt**2 / (ht + LAMBDA)
            gain = np.where((c >= MIN_ROWS) & (ct - c >= MIN_ROWS), gain, -np.inf).reshape(wide, -1)
            best = gain.argmax(1)
            for k in range(wide):
                f, cut = divmod(int(best[k]), BINS)
                if gain[k, best[k]] > 1e-6 and cut < len(edges[f]):
                    out.feature[t, first + k], out.above[t, first + k] = f, edges[f][cut]
            node = 2 * node + 1 + (x[np.arange(n), out.feature[t, node]] > out.above[t, node])
        leaf = node - inner
        g, h = np.bincount(leaf, grad, inner + 1), np.bincount(leaf, hess, inner + 1)
        out.leaf[t] = -RATE * g / (h + LAMBDA)
        raw += out.leaf[t][leaf]
    return out


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> Trees:
    """Fit on the documents of at most ``most`` labelled ids, those with the smallest hashes.

    ``docs`` has doc_id and text, ``labels`` doc_id and label (0 or 1, others
    are left out); other columns, clashing or not, are ignored. Null ids have no
    label. A null or empty text has the statistics of no words; a text of any
    length is read whole. An id that is labelled twice counts with each label,
    repeated rows once, and an id with several texts with the smallest of them,
    so reruns agree. Without labels the score is 0.5 for all. The sampled ids,
    at most ``most``, are broadcast.
    """
    some = labels.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col("label").cast("int").alias("label"))
    ids = docs.sparkSession.createDataFrame([(r.doc_id, r.label) for r in hashed_rows(some, "doc_id", most).collect()], "doc_id bigint, label int")

    @F.arrow_udf("array<double>")
    def features(text: pa.Array) -> pa.Array:
        return pa.array(table(text.to_pylist()).tolist(), pa.list_(pa.float64()))

    few = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    rows = few.select("doc_id", "label", features("text").alias("x")).collect()
    rows.sort(key=lambda r: (r.doc_id, r.label))
    return fit(np.array([r.x for r in rows], np.float64).reshape(-1, len(STATISTICS)), np.array([r.label for r in rows], np.float64))


def quality_score(text: Column, trees: Trees) -> Column:
    """Probability that a text is good; null and empty texts score as texts without words."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(trees.score(table(batch.to_pylist())), pa.float64())

    return score.asNondeterministic()(text)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id's digits leaves 2 modulo 4; null ids aren't held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op10_quality_model(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    trees = train(docs, labels.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))))
    out = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), quality_score(F.col("text"), trees).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= GOOD).cast("int"))
