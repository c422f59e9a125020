"""Nearest centroid of every point."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phrasegrove.functions import kernels
from phrasegrove.functions.balls import Balls
from phrasegrove.operators.bounded import each_block, once, ship_blocks


def centroid_block(block: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and centroids of a block, which must be complete and of one size."""
    if block.num_rows == 0:
        raise ValueError("there are no centroids to compare with")
    ids = block.column("cluster_id").to_numpy().astype("i4")
    lists = block.column("centroid").combine_chunks()
    _, centres = kernels.usable_rows(lists, len(lists[0]))
    if len(centres) != len(ids):
        raise ValueError("every centroid must be complete and of the same size")
    return ids, centres


def nearest_centroid(
    points: DataFrame,
    centroid_rows: DataFrame,
    vec_col: str = "embedding",
    cluster_col: str = "cluster_id",
    distance_col: str = "distance",
    block_bytes: int | None = None,
) -> DataFrame:
    """Add the id of, and squared distance to, the nearest of ``(cluster_id, centroid)``.

    The points are read once and not shuffled; a task goes through the centroids block by block,
    and within a block only through the balls that may hold a point's nearest centroid.
    Equal distances go to the smaller id, and a vector that is null, of another size or has a
    null or NaN element gets nulls.
    """
    def prepare(block: pa.Table) -> tuple[np.ndarray, Balls]:
        ids, centres = centroid_block(block)
        return ids, Balls(centres)

    shipped = ship_blocks(centroid_rows, "cluster_id", prepare, block_bytes)

    @F.arrow_udf("struct<distance: double, cluster_id: int>")
    def best(vectors: pa.Array) -> pa.Array:
        kept = least = found = rows = None
        for ids, balls in each_block(shipped):
            if rows is None:
                kept, rows = kernels.usable_rows(vectors, balls.centres.shape[1])
                least, found = np.full(len(rows), np.inf), np.zeros(len(rows), "i4")
            at, gap = balls.nearest(rows)
            # Blocks come in the order of their ids, so an equal distance keeps the earlier one.
            closer = gap < least
            least[closer], found[closer] = gap[closer], ids[at[closer]]
        fields = [
            kernels.scatter(least, kept, len(vectors), pa.float64()),
            kernels.scatter(found, kept, len(vectors), pa.int32()),
        ]
        return pa.StructArray.from_arrays(
            fields, ["distance", "cluster_id"], mask=fields[0].is_null()
        )

    return (
        points.withColumn("_best", once(best)(vec_col))
        .withColumn(cluster_col, F.col("_best.cluster_id"))
        .withColumn(distance_col, F.col("_best.distance"))
        .drop("_best")
    )


def distance_to_centroid(
    assigned: DataFrame,
    centroid_rows: DataFrame,
    vec_col: str,
    cluster_col: str = "cluster_n1",
    distance_col: str = "distance",
    block_bytes: int | None = None,
) -> DataFrame:
    """Add the squared distance of rows that have a cluster already to its centroid.

    A row without a cluster or with an incomplete vector gets null.
    """
    shipped = ship_blocks(centroid_rows, "cluster_id", centroid_block, block_bytes)

    @F.arrow_udf("double")
    def distance(vectors: pa.Array, clusters: pa.Array) -> pa.Array:
        kept = gaps = rows = None
        for ids, centres in each_block(shipped):
            if rows is None:
                kept, rows = kernels.usable_rows(vectors, centres.shape[1])
                wanted = clusters.take(pa.array(kept)).to_numpy(zero_copy_only=False)
                gaps = np.full(len(rows), np.nan)
            at = np.minimum(np.searchsorted(ids, wanted), len(ids) - 1)
            own = np.flatnonzero(ids[at] == wanted)
            apart = rows[own] - centres[at[own]]
            gaps[own] = np.einsum("ij,ij->i", apart, apart)
        known = ~np.isnan(gaps)
        return kernels.scatter(gaps[known], kept[known], len(vectors), pa.float64())

    return assigned.withColumn(
        distance_col, once(distance)(vec_col, F.col(cluster_col).cast("int"))
    )
