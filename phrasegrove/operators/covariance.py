"""Sample covariance of vector dimensions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from phrasegrove.functions import kernels
from phrasegrove.operators.packed import merged

# Dimensions along a side of a tile of the matrix.
TILE = 256
# Vectors of a batch that are summed at a time.
ROWS = 4096

PACKED = "ti int, tj int, n long, mean_i array<double>, mean_j array<double>, products array<double>"


def tile_batch(ti: int, tj: int, n: int, *arrays: np.ndarray) -> pa.RecordBatch:
    lists = [pa.array([a.ravel()], pa.list_(pa.float64())) for a in arrays]
    columns = [pa.array([ti], pa.int32()), pa.array([tj], pa.int32()), pa.array([n], pa.int64()), *lists]
    return pa.RecordBatch.from_arrays(columns, names=["ti", "tj", "n", "mean_i", "mean_j", "products"])


def tile_moments(df: DataFrame, vec_col: str, dims: int, tile: int | None = None) -> DataFrame:
    """Packed co-moments of the complete vectors: a row per tile on or above the diagonal.

    A task multiplies its centred batches tile by tile and gives one row per tile; tiles merge
    pairwise by their counts, means and products of deviations.
    """
    tile = tile or TILE

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = kernels.CoMoments(dims, tile)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                held.add(kernels.usable_rows(batch.column(0).slice(at, ROWS), dims)[1])
        if held.n:
            for (i, j), products in held.tiles.items():
                yield tile_batch(i, j, held.n, held.mean[held.parts[i]], held.mean[held.parts[j]], products)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}
        for batch in batches:
            numbers = zip(*(batch.column(k).to_pylist() for k in range(3)))
            for row, (ti, tj, n) in enumerate(numbers):
                a, b, products = (batch.column(k)[row].values.to_numpy() for k in (3, 4, 5))
                kept = held.setdefault((ti, tj), [0, np.zeros(len(a)), np.zeros(len(b)), np.zeros((len(a), len(b)))])
                shift_a, shift_b, whole = a - kept[1], b - kept[2], kept[0] + n
                kept[3] += products.reshape(len(a), len(b))
                kept[3] += np.outer(shift_a * (kept[0] * n / whole), shift_b)
                kept[1] += shift_a * (n / whole)
                kept[2] += shift_b * (n / whole)
                kept[0] = whole
        for (ti, tj), (n, *arrays) in held.items():
            yield tile_batch(ti, tj, n, *arrays)

    return merged(df.select(vec_col).mapInArrow(partial, PACKED), ["ti", "tj"], merge)


def covariance(df: DataFrame, vec_col: str, dims: int, tile: int | None = None) -> DataFrame:
    """``(i, j, cov)`` for i <= j over the complete vectors; null where there is but one."""
    width = tile or TILE

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ti, tj, n = (batch.column(k)[row].as_py() for k in range(3))
                a, b = (len(batch.column(k)[row].values) for k in (3, 4))
                cov = batch.column(5)[row].values.to_numpy().reshape(a, b) / max(1, n - 1)
                i, j = np.triu_indices(a, 0, b) if ti == tj else np.indices((a, b)).reshape(2, -1)
                rows = [pa.array(i + ti * width, pa.int32()), pa.array(j + tj * width, pa.int32())]
                values = pa.array(cov[i, j], mask=np.full(len(i), n < 2))
                yield pa.RecordBatch.from_arrays([*rows, values], names=["i", "j", "cov"])

    return tile_moments(df, vec_col, dims, tile).mapInArrow(pairs, "i int, j int, cov double")
