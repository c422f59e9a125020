"""Whitening of embeddings; covariances come from variances by polarisation.

1. An entry c becomes the integer floor(1024 c) + 100000. One pass gives the number of vectors and
   the sum of each dimension.
2. A second pass aggregates, for each dimension and for the sum of each two dimensions, the squares
   of the values less the whole part of their mean. These are integers and are summed exactly; the
   fraction of the mean is taken off the sums afterwards, again in integers. A task gives a packed
   row for each dimension (it and the pairs it begins), and these are added in two levels.
3. Var(a + b) - Var(a) - Var(b) = 2 Cov(a, b) gives all cross-covariances, each rounded once. The
   matrix has dims x dims numbers and is handed to ``eigh`` on the driver.
4. Every vector is centred, projected on the leading components and divided by the roots of their
   eigenvalues. The covariance of the projected rows, from one aggregate with running means, is
   compared with the identity.

Sums stay in 64 bits as long as they fit and go on as Python integers beyond, with the same result.

Defined cases: vectors that are null or hold null or non-finite entries are left out, and so are those
with an entry of 2^52 or more, which has no such integer, and those whose length differs from that of
most vectors (the smallest such length among equals); null ids and repeated rows are vectors like
others; a component without variance (beyond rounding) has no whitened value and no row, so equal
vectors or a single one give no row; a sum of squared deviations beyond 38 digits is null; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phrasegrove.llm.common import lists_of, stored

#: The integers of an entry. Fixed values of the contract.
SCALE, SHIFT = 1024, 100_000
#: Entries from here on have no 64-bit integer.
LARGEST = float(1 << 52)
#: Vectors whose pair sums are formed at a time.
ROWS = 1024
#: Pieces in which the tasks' partial sums are added first.
PIECES = 64
LIMB = 32
PARTIAL = "tile int, limbs array<array<bigint>>"


class ExactSums:
    """Running sums of integer arrays of one shape."""

    def __init__(self, size: int):
        self.small = np.zeros(size, np.int64)
        self.large = np.zeros(size, object)
        self.used = 0  # bound of what ``small`` holds

    def add(self, values: np.ndarray, bound: int, at: slice) -> None:
        """``values`` at ``at``, none of them above ``bound``."""
        if values.dtype == object:
            self.large[at] += values
            return
        if self.used + bound >= 1 << 62:
            self.large += self.small.astype(object)
            self.small[:] = 0
            self.used = 0
        self.small[at] += values

    def limbs(self) -> list[list[int]]:
        """Digits to the base 2^32, lowest first; the last ones carry the sign."""
        total = self.small
        if self.large.any():
            total = total.astype(object) + self.large
        out = []
        while True:
            out.append((total & ((1 << LIMB) - 1)).tolist())
            total = total >> LIMB
            if all(-(1 << 30) <= x < 1 << 30 for x in (min(total, default=0), max(total, default=0))):
                return [*out, total.tolist()]


def from_limbs(limbs: list[list[int]]) -> list[int]:
    return [sum(int(x) << (LIMB * k) for k, x in enumerate(column)) for column in zip(*limbs)]


def integers(vectors: list[np.ndarray]) -> np.ndarray:
    return np.floor(np.stack(vectors).astype(np.float64) * SCALE).astype(np.int64) + SHIFT


def pieces_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield part, integers(lists_of(part, "vec"))


def _partial(tile: int, sums: ExactSums) -> pa.RecordBatch:
    limbs = pa.array([sums.limbs()], pa.list_(pa.list_(pa.int64())))
    return pa.RecordBatch.from_arrays([pa.array([tile], pa.int32()), limbs], names=["tile", "limbs"])


def _added(table: pa.Table) -> pa.Table:
    total: list[np.ndarray] = []
    for limbs in table["limbs"].to_pylist():
        for k, digits in enumerate(limbs):
            if k == len(total):
                total.append(np.array(digits, object))
            else:
                total[k] = total[k] + np.array(digits, object)
    whole = ExactSums(len(total[0]))
    whole.large = np.array(from_limbs(total), object)
    limbs = pa.array([whole.limbs()], pa.list_(pa.list_(pa.int64())))
    return pa.table({"tile": pa.array([table["tile"][0].as_py()], pa.int32()), "limbs": limbs})


def _totals(partials: DataFrame) -> dict[int, list[int]]:
    """The sums of each tile over all tasks, added in two levels of groups."""
    rows = partials.withColumn("piece", F.spark_partition_id() % PIECES)
    rows = rows.groupBy("tile", "piece").applyInArrow(_added, PARTIAL)
    rows = rows.groupBy("tile").applyInArrow(_added, PARTIAL)
    return {row["tile"]: from_limbs(row["limbs"]) for row in rows.collect()}


def moments(rows: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of the vectors and the sum of each dimension."""

    def run(batches):
        sums = ExactSums(dims + 1)
        for _, x in pieces_of(batches):
            bound = len(x) * max(1, abs(int(x.min())), abs(int(x.max())))
            x = x if bound < 1 << 62 else x.astype(object)
            sums.add(np.append(x.sum(axis=0), len(x)), bound, slice(None))
            sums.used += bound
        yield _partial(0, sums)

    total = _totals(rows.mapInArrow(run, PARTIAL)).get(0, [0] * (dims + 1))
    return total[-1], total[:-1]


def pair_squares(rows: DataFrame, centre: np.ndarray) -> dict[int, list[int]]:
    """For each dimension i the sum of squares of y_i, and of y_i + y_j for all j > i, where y is
    the integer vector less ``centre``."""
    dims = len(centre)

    def run(batches):
        tiles = [ExactSums(dims - i) for i in range(dims)]
        for _, x in pieces_of(batches):
            y = np.ascontiguousarray((x - centre).T)
            most = 2 * max(1, abs(int(y.min())), abs(int(y.max())))
            bound = most * most * y.shape[1]
            if bound >= 1 << 62:
                y = y.astype(object)
            for i, sums in enumerate(tiles):
                own, pair = y[i], y[i + 1 :] + y[i]
                if y.dtype == object:
                    sums.add(np.array([(own * own).sum()], object), bound, slice(0, 1))
                    if len(pair):
                        sums.add((pair * pair).sum(axis=1), bound, slice(1, None))
                else:
                    sums.add(np.array([own @ own]), bound, slice(0, 1))
                    sums.add(np.einsum("jb,jb->j", pair, pair), bound, slice(1, None))
                    sums.used += bound
        for i, sums in enumerate(tiles):
            yield _partial(i, sums)

    return _totals(rows.mapInArrow(run, PARTIAL))


def covariance(n: int, rest: list[int], squares: dict[int, list[int]]) -> np.ndarray:
    """The covariance matrix; ``rest`` is what the sums are above n times the centre.

    n * (n times a variance) is an integer, and so is n^2 times twice a covariance.
    """
    dims = len(rest)
    own = [n * squares[i][0] - rest[i] ** 2 for i in range(dims)]
    out = np.zeros((dims, dims))
    for i in range(dims):
        out[i, i] = own[i] / n**2
        for j in range(i + 1, dims):
            both = n * squares[i][j - i] - (rest[i] + rest[j]) ** 2
            out[i, j] = out[j, i] = (both - own[i] - own[j]) / (2 * n**2)
    return out


def leading(matrix: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns, each with its largest entry positive."""
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    some = values > max(values[0], 0) * len(matrix) * np.finfo(float).eps
    values, vectors = values[some], vectors[:, some]
    places = np.abs(vectors).argmax(axis=0)
    return values, vectors * np.sign(vectors[places, np.arange(len(values))])


def deviations(y: np.ndarray, n: int, rest: list[int]) -> list[Decimal | None]:
    """For each row the sum over the dimensions of (n y - rest)^2."""
    most = max(1, abs(int(y.min())), abs(int(y.max())))
    r = np.array(rest, object)
    if y.shape[1] * most * max(most, n) < 1 << 62:
        r = r.astype(np.int64)
    else:
        y = y.astype(object)
    squares, products = (y * y).sum(axis=1), (y * r).sum(axis=1)
    fixed = sum(int(x) ** 2 for x in rest)
    whole = [n * n * int(a) - 2 * n * int(b) + fixed for a, b in zip(squares, products)]
    return [Decimal(x) if x < 10**38 else None for x in whole]


def whiten(df: DataFrame, components: int = 8, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` per vector and component."""
    rows = df.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("vec"))
    fits = F.forall("vec", lambda c: F.coalesce(F.abs(c) < LARGEST, F.lit(False)) & ~F.isnan(c))
    rows = rows.where(F.coalesce(fits, F.lit(False)))
    lengths = rows.groupBy(F.size("vec").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), "dims").first()
    dims = most["dims"] if most else 0
    rows = rows.where(F.size("vec") == dims)
    vectors = rows.select("vec")
    n, sums = moments(vectors, dims) if dims else (0, [])
    centre = np.array([s // n for s in sums], np.int64)
    rest = [s - n * int(m) for s, m in zip(sums, centre)]
    values, axes, trace = np.zeros(0), np.zeros((dims, 0)), 1.0
    if n:
        matrix = covariance(n, rest, pair_squares(vectors, centre))
        values, axes = leading(matrix, components)
        trace = float(np.trace(matrix))
    fraction = np.array([r / n for r in rest])
    turn = axes / np.sqrt(values)

    def run(batches):
        for part, x in pieces_of(batches):
            y = x - centre
            projected = (y - fraction) @ turn
            flat = pa.array(projected.ravel())
            ends = pa.array(np.arange(len(y) + 1, dtype=np.int32) * len(values))
            made = [pa.array(deviations(y, n, rest), pa.decimal128(38, 0)), pa.ListArray.from_arrays(ends, flat)]
            yield pa.RecordBatch.from_arrays([part.column(0), *made], names=["vec_id", "deviation", "w"])

    kind = df.schema[id_col].dataType.simpleString()
    done = rows.mapInArrow(run, f"vec_id {kind}, deviation decimal(38,0), w array<double>")
    done = stored(done.where(F.lit(len(values) > 0)), "whitened")
    error = 0.0
    if len(values):
        pairs = [(i, j) for i in range(len(values)) for j in range(i, len(values))]
        found = done.agg(*(F.covar_pop(F.col("w")[i], F.col("w")[j]).alias(f"c{i}_{j}") for i, j in pairs)).first()
        error = max(abs(found[k] - (i == j)) for k, (i, j) in enumerate(pairs))
    shares = F.array(*(F.lit(float(v) / trace) for v in values)).cast("array<double>")
    out = done.select("vec_id", "deviation", F.posexplode("w").alias("pos", "whitened"))
    return out.select(
        "vec_id",
        (F.col("pos") + 1).alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("pos")).alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )
