"""Weighted coresets: a few points that stand for all when clusters are fitted.

A point is taken with a chance that is half uniform and half by its part of the squared distances to
the mean (far points matter more), and weighs the inverse of that chance. Coresets merge by union,
and a coreset of a coreset is one: tasks sample blocks of their points while they read them, and
what they give is sampled once more to the wanted size. Chances come from a hash of the id, so a
task that runs again takes the same points of a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phrasegrove.functions import kernels
from phrasegrove.functions.balls import Balls
from phrasegrove.functions.vectors import with_array
from phrasegrove.operators.bounded import pin

# Points a task holds before it samples them, and how many of them stay, about.
BLOCK_ROWS = 1 << 16
BLOCK_SAMPLE = 1 << 10

SAMPLED = "id_hash long, point array<double>, weight double"


def chances(points: np.ndarray, weights: np.ndarray, size: int) -> np.ndarray:
    """The chance of each weighted point to be among about ``size``; 1 for all if they are that few."""
    if len(points) <= size:
        return np.ones(len(points))
    whole = weights.sum()
    apart = points - (weights @ points) / whole
    part = weights * np.einsum("ij,ij->i", apart, apart)
    share = weights / whole
    if part.sum() > 0:
        share = (share + part / part.sum()) / 2
    return np.minimum(1, size * share)


def draws(hashes: np.ndarray, level: int) -> np.ndarray:
    """A number in [0, 1) for each hash, independent from level to level."""
    x = hashes.astype(np.int64).view(np.uint64) + np.uint64(level) * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))) / 2.0**64


def _sampled(hashes: np.ndarray, points: np.ndarray, weights: np.ndarray, size: int, level: int) -> pa.RecordBatch:
    chance = chances(points, weights, size)
    taken = draws(hashes, level) < chance
    ends = pa.array(np.arange(taken.sum() + 1, dtype=np.int32) * points.shape[1])
    lists = pa.ListArray.from_arrays(ends, pa.array(points[taken].ravel()))
    arrays = [pa.array(hashes[taken]), lists, pa.array(weights[taken] / chance[taken])]
    return pa.RecordBatch.from_arrays(arrays, names=["id_hash", "point", "weight"])


def block_coreset(points: DataFrame) -> DataFrame:
    """The first sampling of ``(id_hash, point)``: in blocks, while the points are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        rows = 0

        def emit() -> pa.RecordBatch:
            hashes, vectors = (np.concatenate(side) for side in zip(*held))
            return _sampled(hashes, vectors, np.ones(len(hashes)), BLOCK_SAMPLE, 1)

        for batch in batches:
            if batch.num_rows:
                held.append((batch.column(0).to_numpy(), kernels.matrix(batch.column(1))))
                rows += batch.num_rows
            if rows >= BLOCK_ROWS:
                yield emit()
                held.clear()
                rows = 0
        if rows:
            yield emit()

    return points.mapInArrow(run, SAMPLED)


def coreset(features: DataFrame, size: int, features_col: str, id_col: str = "id") -> DataFrame:
    """``(point, weight)``: about ``size`` rows that stand for all; the points are read once.

    Fewer points than ``size`` (and than ``BLOCK_SAMPLE`` a block) come back whole, with weight 1.
    """
    points = with_array(features, features_col, "point", "double")
    blocks = pin(block_coreset(points.select(F.xxhash64(id_col).alias("id_hash"), "point")))
    # The second sampling works on the table of the first, with what it says of all points.
    everything = blocks.agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("weight")).first()
    if everything["n"] <= size:
        return blocks.select("point", "weight")
    mean = _weighted_mean(blocks)
    gap = F.aggregate(
        F.zip_with("point", F.array(*map(F.lit, mean)), lambda a, b: (a - b) * (a - b)),
        F.lit(0.0),
        lambda total, x: total + x,
    )
    blocks = blocks.withColumn("part", F.col("weight") * gap)
    parts = blocks.agg(F.sum("part")).first()[0]
    share = F.col("weight") / everything["weight"]
    share = (share + F.col("part") / parts) / 2 if parts else share
    chance = F.least(F.lit(1.0), size * share)
    draw = F.shiftrightunsigned(F.xxhash64("id_hash", F.lit(2)), 11) / float(1 << 53)
    return pin(blocks.where(draw < chance).select("point", (F.col("weight") / chance).alias("weight")))


def _weighted_mean(blocks: DataFrame) -> list[float]:
    """The mean of the weighted points, from one packed row a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, mean = 0.0, None
        for batch in batches:
            if batch.num_rows:
                points, weights = kernels.matrix(batch.column(0)), batch.column(1).to_numpy()
                total = weight + weights.sum()
                new = weights @ points / weights.sum()
                mean = new if mean is None else mean + (new - mean) * (weights.sum() / total)
                weight = total
        if mean is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([weight]), pa.array([mean.tolist()], pa.list_(pa.float64()))], names=["weight", "mean"]
            )

    rows = blocks.select("point", "weight").mapInArrow(run, "weight double, mean array<double>").collect()
    weights = np.array([row["weight"] for row in rows])
    return (weights @ np.array([row["mean"] for row in rows]) / weights.sum()).tolist()


def inertias(features: DataFrame, features_col: str, centres: list[np.ndarray]) -> tuple[int, list[float]]:
    """The number of points, and for each set of centres the sum of the points' squared distances
    to their nearest one; the points are read once for all sets."""
    sets = features.sparkSession.sparkContext.broadcast([Balls(np.asarray(c)) for c in centres])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(len(sets.value))
        for batch in batches:
            if batch.num_rows:
                points = kernels.matrix(batch.column(0))
                n += len(points)
                sums += [balls.nearest(points)[1].sum() for balls in sets.value]
        yield pa.RecordBatch.from_arrays(
            [pa.array([n]), pa.array([sums.tolist()], pa.list_(pa.float64()))], names=["n", "sums"]
        )

    points = with_array(features, features_col, "point", "double").select("point")
    parts = points.mapInArrow(run, "n long, sums array<double>")
    total = parts.agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(len(centres)))).first()
    return total["n"] or 0, [total[f"s{i}"] or 0.0 for i in range(len(centres))]
