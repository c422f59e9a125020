"""Packed moments of clusters of vectors, and what follows from them: centroids and WCSS.

The moments of a cluster are one row: the number of its vectors, their mean, and per dimension the sum
of squared deviations from it (``spread``). Two such rows merge without going back to the points, and
without taking the difference of large sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phrasegrove.functions import kernels
from phrasegrove.operators.packed import merged

# A task hands on what it has when its clusters hold this many numbers, and starts anew.
TASK_CELLS = 1 << 22


def complete(vec_col: str, dims: int | None) -> Column:
    """A vector without null and NaN elements and, where ``dims`` is given, of that size."""
    clean = F.array_contains(vec_col, F.lit(float("nan"))) == F.lit(False)
    sized = F.size(vec_col) == dims if dims is not None else F.lit(True)
    return F.coalesce(clean & sized, F.lit(False))


def moment_batches(held: kernels.Moments, names: list[str]) -> Iterator[pa.RecordBatch]:
    for keys, n, mean, spread in held.drain():
        ends = pa.array(np.arange(len(n) + 1, dtype=np.int32) * mean.shape[1])
        arrays = [*(pa.array(keys[:, i], pa.int32()) for i in range(keys.shape[1])), pa.array(n, pa.int64())]
        arrays += [pa.ListArray.from_arrays(ends, pa.array(part.ravel())) for part in (mean, spread)]
        yield pa.RecordBatch.from_arrays(arrays, names=names)


def merged_rows(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Packed moments with one row per value of ``keys``, which are integers."""
    names = [*keys, "n", "mean", "spread"]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = kernels.Moments()
        for batch in batches:
            if batch.num_rows:
                numbers = np.stack([batch.column(i).to_numpy() for i in range(len(keys))], axis=1)
                sides = [kernels.matrix(batch.column(len(keys) + 1 + i)) for i in range(2)]
                held.merge(numbers, batch.column(len(keys)).to_numpy(), *sides)
        yield from moment_batches(held, names)

    columns = [*(F.col(key).cast("int").alias(key) for key in keys), "n", "mean", "spread"]
    return merged(parts.select(*columns), keys, merge)


def cluster_moments(
    df: DataFrame, cluster_col: str, vec_col: str = "embedding", dims: int | None = None
) -> DataFrame:
    """``(cluster_id, n, mean, spread)`` of the complete vectors, one packed row per cluster.

    A task gives a row per cluster that it meets (more only when the clusters outgrow
    ``TASK_CELLS``), so a cluster that holds most of the points costs no more than any other.
    Without ``dims`` all complete vectors count, and several sizes among them are an error.
    """
    cluster = F.col(cluster_col).cast("int")
    rows = df.where(cluster.isNotNull()).select(cluster.alias("cluster_id"), F.col(vec_col).cast("array<double>").alias("v"))
    rows = rows.where(complete("v", dims))
    names = ["cluster_id", "n", "mean", "spread"]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = kernels.Moments()
        for batch in batches:
            if batch.num_rows:
                held.add(batch.column(0).to_numpy(), kernels.matrix(batch.column(1)))
                if held.cells > TASK_CELLS:
                    yield from moment_batches(held, names)
        yield from moment_batches(held, names)

    parts = rows.mapInArrow(partial, "cluster_id int, n long, mean array<double>, spread array<double>")
    return merged_rows(parts, ["cluster_id"])


def merged_moments(moments: DataFrame, group: Column, *keys: str) -> DataFrame:
    """Moments of unions of clusters: ``group`` is the cluster that each one goes to."""
    return merged_rows(moments.withColumn("cluster_id", group), [*keys, "cluster_id"])


def total(array_col: str) -> Column:
    return F.aggregate(array_col, F.lit(0.0), lambda held, x: held + x)


def unpack(vectors: DataFrame, vec_col: str, value_col: str = "value") -> DataFrame:
    """A row per element, for results that are wanted long."""
    return vectors.select("cluster_id", F.posexplode(vec_col).alias("dim", value_col))


def centroids(
    df: DataFrame, cluster_col: str, vec_col: str = "embedding", dims: int | None = None
) -> DataFrame:
    """``(cluster_id, centroid)``: the mean vector of each cluster."""
    found = cluster_moments(df, cluster_col, vec_col, dims)
    return found.select("cluster_id", F.col("mean").alias("centroid"))


def wcss(moments: DataFrame) -> DataFrame:
    """``(cluster_id, n, wcss)``: squared distance of the members to their own mean.

    It follows from the moments alone, so the points are read once.
    """
    return moments.select("cluster_id", "n", total("spread").alias("wcss"))
