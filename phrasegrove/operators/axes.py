"""Principal axes of wide vectors by a randomised range finder.

The exact solver holds a matrix of dims x dims on the driver. Here a block of ``axes`` and some more
directions is turned by the covariance a few times (each turn is one pass over the vectors), so the
driver holds dims x axes numbers only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.common import _py2java
from pyspark.ml.feature import PCAModel
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phrasegrove.functions import kernels
from phrasegrove.operators.moments import cluster_moments
from phrasegrove.operators.packed import merged

# Directions beyond those wanted, turns by the covariance, and dimensions of a packed row.
OVERSAMPLE = 8
PASSES = 3
ROWS_OF_TILE = 256
SEED = 17

PACKED = "tile int, part array<double>"


def turned(vectors: DataFrame, mean: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The sum over all ``vec`` of (x - mean) (x - mean)' block, in one pass."""
    sent = vectors.sparkSession.sparkContext.broadcast((mean, block))
    dims, width = block.shape

    def emit(sums: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for tile, part in sums.items():
            lists = pa.array([part.ravel()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array([tile], pa.int32()), lists], names=["tile", "part"])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, block = sent.value
        total = np.zeros(block.shape)
        for batch in batches:
            if batch.num_rows:
                apart = kernels.matrix(batch.column(0)) - mean
                total += apart.T @ (apart @ block)
        yield from emit({at // ROWS_OF_TILE: total[at : at + ROWS_OF_TILE] for at in range(0, dims, ROWS_OF_TILE)})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for tile, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                held = part.values.to_numpy()
                sums[tile] = sums[tile] + held if tile in sums else held.copy()
        yield from emit(sums)

    rows = merged(vectors.mapInArrow(partial, PACKED), ["tile"], add).collect()
    return np.concatenate([np.array(r["part"]).reshape(-1, width) for r in sorted(rows, key=lambda r: r["tile"])])


def principal_axes(
    df: DataFrame, vec_col: str, dims: int, axes: int, passes: int = PASSES
) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``axes`` main directions of complete vectors as columns, their variances, and the total.

    The angle to the exact subspace shrinks by lambda[axes + 8] / lambda[axes] with each pass but
    the last, which finds the directions within the block.
    """
    rows = df.select(F.col(vec_col).cast("array<double>").alias("vec"), F.lit(0).alias("one"))
    found = cluster_moments(rows, "one", "vec", dims).first()
    if found is None:
        raise ValueError("there are no complete vectors to find axes of")
    mean, n = np.array(found["mean"]), found["n"]
    vectors = rows.where(F.size("vec") == dims).select("vec")
    width = min(dims, axes + OVERSAMPLE)
    block = np.linalg.qr(np.random.default_rng(SEED).normal(size=(dims, width)))[0]
    for _ in range(passes):
        image = turned(vectors, mean, block)
        # The last block's own eigenvectors order and turn it; the next block is where it went.
        values, turn = np.linalg.eigh((block.T @ image + image.T @ block) / 2)
        axes_of, variances = block @ turn[:, ::-1], values[::-1]
        block = np.linalg.qr(image)[0]
    return axes_of[:, :axes], variances[:axes] / max(1, n - 1), float(np.sum(found["spread"])) / max(1, n - 1)


def range_pca(
    df: DataFrame, vec_col: str, array_col: str, output_col: str, dims: int, axes: int
) -> PCAModel:
    """A fitted ``PCAModel`` from vectors in ``array_col``, to be used on the vector column ``vec_col``."""
    found, variances, total = principal_axes(df, array_col, dims, axes)
    context = df.sparkSession.sparkContext
    # PCAModel has no constructor in Python.
    made = context._jvm.org.apache.spark.ml.feature.PCAModel(
        "range_pca",
        _py2java(context, DenseMatrix(dims, axes, found.ravel(order="F").tolist())),
        _py2java(context, DenseVector((variances / total if total else variances).tolist())),
    )
    made.set(made.getParam("k"), axes)
    model = PCAModel(made)
    model._transfer_params_from_java()
    return model.setInputCol(vec_col).setOutputCol(output_col)
