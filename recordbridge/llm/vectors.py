"""Vectors as integers, and their exact inner products, inside Spark tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(df: DataFrame, key: str, vector: str, **others: Column) -> DataFrame:
    """Distinct (id, vector as doubles, width, others) of the rows with an id and a vector without null or non-finite components."""
    rows = df.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector"), *[c.alias(n) for n, c in others.items()])
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("id").isNotNull() & finite).distinct().withColumn("width", F.size("vector"))


def integers(cells: pa.ChunkedArray, width: int, scale: int) -> np.ndarray:
    """floor(scale * component) of vectors of one width, as whole doubles."""
    cells = cells.combine_chunks() if isinstance(cells, pa.ChunkedArray) else cells
    whole = np.floor(scale * cells.flatten().to_numpy(zero_copy_only=False)).reshape(len(cells), width)
    if not np.isfinite(whole).all():
        raise ValueError(f"a component times {scale} is beyond double precision")
    return whole


def exact_kind(a: np.ndarray, b: np.ndarray) -> type:
    """In what all inner products of rows of ``a`` and ``b`` are exact: doubles, 64-bit or Python integers."""
    bound = a.shape[1] * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0))
    return np.float64 if bound < 2**53 else np.int64 if bound < 2**62 and max(np.abs(a).max(), np.abs(b).max()) < 2**62 else object


def as_kind(whole: np.ndarray, kind: type) -> np.ndarray:
    if kind is not object:
        return whole.astype(kind)
    out = np.empty(whole.shape, object)
    out[...] = [[int(x) for x in row] for row in whole.tolist()] if whole.size else out
    return out


def products(a: np.ndarray, b: np.ndarray, kind: type) -> np.ndarray:
    """Inner products of all rows of ``a`` with all rows of ``b``."""
    return np.dot(as_kind(a, kind), as_kind(b, kind).T)


def highest(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties by smaller id."""
    if scores.dtype == object:
        return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i]))[:k], np.int64)
    if len(scores) > 4 * k:  # what is below the k-th highest score needs no order
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= kth)
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def long_scores(scores: list) -> pa.Array:
    """Whole scores as 64-bit integers; one beyond them stops the job."""
    return pa.array([int(s) for s in scores], pa.int64())
