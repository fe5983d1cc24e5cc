"""Whitening of embeddings on their principal components, from exact integer sums."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greensward.plans.scratch import Scratch

#: Steps of a unit that entries are rounded down to, and components returned.
STEPS, COMPONENTS = 256, 4
#: A component of at most this share of the variance has none.
FLAT = 1e-11
WHITENED = "vec_id bigint, component int, deviation bigint, whitened double"


def steps(vector: Column) -> Column:
    """Entries in whole steps, rounded down; null if the vector or an entry is null or an entry isn't finite."""
    finite = lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False))
    return F.when(F.forall(vector, finite), F.transform(vector, lambda c: F.floor(c.cast("double") * STEPS).cast("long")))


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n * x - sums`` in whole numbers; an error beyond a long."""
    if len(x) and n * int(np.abs(x).max()) + int(np.abs(sums).max()) >= 1 << 62:
        raise OverflowError("n * x leaves the range of a long")
    return n * x - sums


def squares(z: np.ndarray) -> np.ndarray:
    """Exact sums of squares of rows; an error beyond a long."""
    if z.size and int(np.abs(z).max()) ** 2 * z.shape[1] >= 1 << 63:
        exact = [sum(v * v for v in row) for row in z.tolist()]
        if max(exact) >= 1 << 63:
            raise OverflowError("a deviation leaves the range of a long")
        return np.array(exact, np.int64)
    return (z * z).sum(1)


def principal(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues from the largest down and unit eigenvectors as columns, the largest entry of each positive."""
    e, v = np.linalg.eigh(covariance)
    e, v = e[::-1], v[:, ::-1]
    return np.maximum(e, 0.0), v * np.where(v[np.abs(v).argmax(0), np.arange(len(e))] < 0, -1.0, 1.0)


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for each row and component.

    ``embeddings`` has vec_id and embedding; other columns are ignored. Rows
    whose vector is null or holds null or non-finite entries go, and so do
    vectors whose length isn't the commonest (the longest on ties), empty ones
    among them. Entries become ``x``, whole steps of 1/256. Each distinct x
    counts once in the fit: copies, a third of the rows or more, meet in the
    tasks that read them before anything is shuffled. ``RowMatrix`` sums the
    products of exactly centred rows in the JVM; the driver sees the sums and
    one covariance, of the square of the dimensions. Rows are whitened where
    they are read, and repeated ids and null ids stay rows of their own.

    A component without variance (one distinct vector, or fewer than dimensions)
    has a null ``whitened`` and no part in the identity error; ``explained`` is
    null if nothing varies. Equal eigenvalues leave the choice of their
    components open. An empty table stays empty. Whole numbers beyond a long
    are an error.
    """
    spark = embeddings.sparkSession
    scratch = Scratch(spark, "whitening")
    rows = embeddings.select(embeddings["vec_id"].cast("long").alias("vec_id"), steps(embeddings["embedding"]).alias("x")).where("size(x) > 0")
    usual = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    result = f"{WHITENED}, n bigint, explained double, identity_error double"
    order = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    if usual is None:
        return spark.createDataFrame([], result).select(order)
    d = usual.d
    rows = rows.where(F.size("x") == d)
    fit = scratch.put(rows.select("x").distinct(), "fit")
    per = fit.select(F.posexplode("x").alias("pos", "v")).groupBy("pos").agg(F.sum("v").alias("s"), F.count(F.lit(1)).alias("n")).orderBy("pos").collect()
    n, sums = per[0].n, np.array([r.s for r in per], np.int64)
    total = F.array(*[F.lit(int(s)).cast("long") for s in sums])
    means_off = F.zip_with("x", total, lambda x, s: (F.lit(n).cast("long") * x - s).cast("double") / n)
    vectors = MLUtils.convertVectorColumnsFromML(fit.select(array_to_vector(means_off).alias("v")), "v")
    covariance = RowMatrix(vectors, numCols=d).computeGramianMatrix().toArray() / n
    e, v = principal((covariance + covariance.T) / 2)
    trace = float(np.trace(covariance))
    k = min(components, d)
    real = e[:k] > FLAT * trace
    scale = np.divide(1.0, np.sqrt(e[:k]), out=np.full(k, np.nan), where=real)
    held = spark.sparkContext.broadcast((n, sums, v[:, :k] * scale))

    def project(x: pd.Series) -> tuple[np.ndarray, np.ndarray]:
        n, sums, to = held.value
        z = centred(np.stack(x.to_list()).astype(np.int64), n, sums)
        return z, (z / n) @ to

    def fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"w": list(np.nan_to_num(project(b["x"])[1]))})

    def whitened(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            z, w = project(b["x"])
            off = squares(z)
            for c in range(k):
                yield pd.DataFrame({"vec_id": b["vec_id"], "component": np.int32(c + 1), "deviation": off, "whitened": w[:, c] if real[c] else None})

    at = [(i, j) for i in range(k) for j in range(i + 1) if real[i] and real[j]]
    error = None
    if at:
        w = fit.mapInPandas(fitted, "w array<double>")
        got = w.agg(*[F.covar_pop(F.col("w")[i], F.col("w")[j]).alias(f"c{i}_{j}") for i, j in at]).first()
        error = max(abs(got[f"c{i}_{j}"] - (i == j)) for i, j in at)
    scratch.keep()
    explained = F.element_at(F.array(*[F.lit(float(x / trace) if trace > 0 else None).cast("double") for x in e[:k]]), F.col("component"))
    out = rows.mapInPandas(whitened, WHITENED)
    return out.withColumns({"n": F.lit(n).cast("long"), "explained": explained, "identity_error": F.lit(error).cast("double")}).select(order)


def op13_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
