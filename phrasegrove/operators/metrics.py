"""Silhouette, elbow and run metrics."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phrasegrove import schemas
from phrasegrove.functions import kernels
from phrasegrove.functions.balls import Balls
from phrasegrove.operators.bounded import each_block, once, ship_blocks
from phrasegrove.operators.moments import cluster_moments, total


def mean_inside(rows: np.ndarray, own: np.ndarray, counts: np.ndarray, balls: Balls) -> np.ndarray:
    """Mean squared distance of each point to its own cluster's other members, ``ALONE`` without any.

    The mean over a cluster is the squared distance to its mean plus its members' mean squared
    distance to it; leaving the point itself out takes n to n - 1.
    """
    apart = rows - balls.centres[own]
    whole = np.einsum("ij,ij->i", apart, apart) + balls.offsets[own]
    n = counts[own]
    return np.where(n > 1, whole * n / np.maximum(n - 1, 1), kernels.ALONE)


def silhouette_scores(
    df: DataFrame,
    cluster_col: str,
    vec_col: str = "embedding",
    score_col: str = "silhouette",
    dims: int | None = None,
    block_bytes: int | None = None,
    moments: DataFrame | None = None,
) -> DataFrame:
    """Add the squared-Euclidean silhouette of every point.

    The clusters' moments are all a point has to be compared with, so no pair of
    points ever meets, and the points are not shuffled. A point alone in its cluster scores 0;
    with one cluster, no cluster or an incomplete vector it is null. ``moments`` are the clusters'
    ``cluster_moments``, where they are known already.
    """
    moments = cluster_moments(df, cluster_col, vec_col, dims) if moments is None else moments
    profiles = moments.select(
        "cluster_id", "n", "mean", (total("spread") / F.col("n")).alias("variance")
    )

    def prepare(block: pa.Table):
        ids = block.column("cluster_id").to_numpy().astype("i4")
        if not len(ids):
            return ids, np.zeros(0), None
        means = kernels.matrix(block.column("mean").combine_chunks())
        return ids, block.column("n").to_numpy(), Balls(means, block.column("variance").to_numpy())

    shipped = ship_blocks(profiles, "cluster_id", prepare, block_bytes)

    @F.arrow_udf("struct<inside: double, outside: double>")
    def distances(vectors: pa.Array, clusters: pa.Array) -> pa.Array:
        kept, rows, inside, outside = np.zeros(0, "i8"), None, np.zeros(0), np.zeros(0)
        for ids, counts, balls in each_block(shipped):
            if not len(ids):
                continue
            if rows is None:
                kept, rows = kernels.usable_rows(vectors, balls.centres.shape[1])
                wanted = clusters.take(pa.array(kept)).to_numpy(zero_copy_only=False)
                inside, outside = np.full(len(rows), np.nan), np.full(len(rows), np.inf)
            at = np.minimum(np.searchsorted(ids, wanted), len(ids) - 1)
            own = np.where(ids[at] == wanted, at, -1)
            mine = np.flatnonzero(own >= 0)
            inside[mine] = mean_inside(rows[mine], own[mine], counts, balls)
            outside = np.minimum(outside, balls.least_other(rows, own))
        fields = []
        for values in (inside, outside):
            known = np.isfinite(values)
            fields.append(kernels.scatter(values[known], kept[known], len(vectors), pa.float64()))
        return pa.StructArray.from_arrays(fields, ["inside", "outside"])

    inside, outside = F.col("_gap.inside"), F.col("_gap.outside")
    value = (
        F.when(inside.isNull() | outside.isNull(), F.lit(None))
        .when(inside == kernels.ALONE, 0.0)
        .when(inside < outside, 1 - inside / outside)
        .when(inside > outside, outside / inside - 1)
        .otherwise(0.0)
    )
    gap = once(distances)(vec_col, F.col(cluster_col).cast("int"))
    return df.withColumn("_gap", gap).withColumn(score_col, value).drop("_gap")


def silhouette_by_cluster(
    df: DataFrame,
    cluster_col: str,
    vec_col: str = "embedding",
    threshold: float = 0.3,
    dims: int | None = None,
) -> DataFrame:
    """``(cluster_id, n, silhouette, below_threshold)`` of every cluster."""
    scored = silhouette_scores(df, cluster_col, vec_col, dims=dims)
    return (
        scored.groupBy(F.col(cluster_col).cast("int").alias("cluster_id"))
        .agg(F.count(F.lit(1)).alias("n"), F.avg("silhouette").alias("silhouette"))
        .withColumn("below_threshold", F.col("silhouette") < threshold)
    )


def mean_silhouette(
    df: DataFrame,
    cluster_col: str,
    vec_col: str = "embedding",
    dims: int | None = None,
    moments: DataFrame | None = None,
) -> DataFrame:
    """One row: the mean silhouette over all points."""
    scored = silhouette_scores(df, cluster_col, vec_col, dims=dims, moments=moments)
    return scored.agg(F.avg("silhouette").alias("silhouette"))


def elbow(sweep: DataFrame, run_col: str = "run_id") -> DataFrame:
    """Mark the recommended k of each run of ``(run, k, inertia)`` rows.

    Inertia is scaled by the run's largest; the interior k with the largest signed second
    difference wins, the smaller k on a tie. With one or two candidates the last one wins.
    """
    run = Window.partitionBy(run_col)
    by_k = run.orderBy("k")
    scaled = F.coalesce(
        F.col("inertia") / F.nullif(F.max("inertia").over(run), F.lit(0.0)), F.lit(0.0)
    )
    bend = F.lead("scaled").over(by_k) - 2 * F.col("scaled") + F.lag("scaled").over(by_k)
    few = F.count(F.lit(1)).over(run) <= 2
    best_first = run.orderBy(
        F.when(few, F.col("k")).desc_nulls_last(), F.col("curvature").desc_nulls_last(), "k"
    )
    return (
        sweep.withColumn("scaled", scaled)
        .withColumn("curvature", bend)
        .withColumn("recommended", F.row_number().over(best_first) == 1)
    )


def metric_rows(rows: DataFrame) -> DataFrame:
    """Fit to the metrics table; what a row does not know, such as ``k_n2`` of a sweep, is null."""
    return schemas.conform(rows, schemas.METRICS)
