"""Small numpy kernels that run on one Arrow batch inside a task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A score matrix (batch rows x clusters) is cut to at most this many cells.
SCORE_CELLS = 1 << 22

# Distances are compared after rounding to this many digits; equal ones go to the smaller id.
TIE_DIGITS = 9

# Marks a point that has no other member in its cluster; a real mean distance is never negative.
ALONE = -1.0


def usable_rows(vectors: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the complete vectors in a list array, and those vectors as a matrix."""
    right_size = pc.fill_null(pc.equal(pc.list_value_length(vectors), dims), False)
    positions = np.flatnonzero(right_size.to_numpy(zero_copy_only=False))
    flat = vectors.filter(right_size).flatten().to_numpy(zero_copy_only=False)
    matrix = flat.astype("f8").reshape(len(positions), dims)
    whole = ~np.isnan(matrix).any(axis=1)
    return positions[whole], matrix[whole]


def row_slices(n_rows: int, n_clusters: int):
    step = max(1, SCORE_CELLS // max(1, n_clusters))
    return (slice(at, at + step) for at in range(0, n_rows, step))


def nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of, and squared distance to, the nearest centre of each point.

    A matrix product ranks all centres. Where others come within rounding error of the best,
    they are measured again by direct differences, so no answer depends on cancellation.
    """
    index = np.empty(len(points), "i8")
    sizes = np.einsum("ij,ij->i", centres, centres)
    doubled = -2.0 * centres.T
    for part in row_slices(len(points), len(centres)):
        x = points[part]
        score = x @ doubled
        score += sizes
        best = score.argmin(axis=1)
        every = np.arange(len(x))
        least = score[every, best]
        scale = np.einsum("ij,ij->i", x, x) + sizes.max()
        limit = least + 1e-9 + 1e-11 * scale
        score[every, best] = np.inf
        for row in np.flatnonzero(score.min(axis=1) <= limit):
            rivals = np.append(np.flatnonzero(score[row] <= limit[row]), best[row])
            exact = np.round(((x[row] - centres[rivals]) ** 2).sum(axis=1), TIE_DIGITS)
            best[row] = rivals[exact == exact.min()].min()
        index[part] = best
    gaps = points - centres[index]
    return index, np.round(np.einsum("ij,ij->i", gaps, gaps), TIE_DIGITS)


def squared_gaps(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of all points to all centres, by products taken near the centres' mean."""
    middle = centres.mean(axis=0)
    x, c = points - middle, centres - middle
    gaps = np.einsum("ij,ij->i", x, x)[:, None] + np.einsum("ij,ij->i", c, c) - 2.0 * (x @ c.T)
    return np.maximum(gaps, 0.0, out=gaps)


def roughly_nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Index of a centre of each point that is nearest but for rounding."""
    index = np.empty(len(points), "i8")
    for part in row_slices(len(points), len(centres)):
        index[part] = squared_gaps(points[part], centres).argmin(axis=1)
    return index


def scatter(values: np.ndarray, positions: np.ndarray, length: int, kind) -> pa.Array:
    """An Arrow array of ``length`` with ``values`` at ``positions`` and null elsewhere."""
    full = np.zeros(length, values.dtype)
    full[positions] = values
    absent = np.ones(length, bool)
    absent[positions] = False
    return pa.array(full, type=kind, mask=absent)


def matrix(vectors: pa.Array) -> np.ndarray:
    """A list array of complete vectors as rows of a matrix; they must be of one size."""
    sizes = np.diff(vectors.offsets.to_numpy())
    if len(sizes) and (sizes != sizes[0]).any():
        raise ValueError("the vectors are of several sizes: say by dims which one counts")
    return vectors.flatten().to_numpy().reshape(len(sizes), -1)


class Moments:
    """Count, mean and summed squared deviations of the vectors of many clusters.

    A cluster's key is a row of integers. What comes in is first reduced to one row per key,
    centred on that row's own mean, and then merged with what is held.
    """

    def __init__(self):
        self._clear()

    def _clear(self) -> None:
        self.places: dict[bytes, int] = {}
        self.keys: list[np.ndarray] = []
        self.n, self.mean, self.spread = np.zeros(0, "i8"), None, None

    @property
    def cells(self) -> int:
        return 2 * len(self.places) * (0 if self.mean is None else self.mean.shape[1])

    def add(self, cluster: np.ndarray, rows: np.ndarray) -> None:
        """Vectors of the clusters with these numbers."""
        ones = np.ones(len(rows), "i8")
        self.merge(cluster.reshape(-1, 1), ones, rows, np.zeros((1, 1)))

    def merge(self, keys: np.ndarray, n: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> None:
        """Moments under these keys, which may repeat."""
        known, inverse = np.unique(keys, axis=0, return_inverse=True)
        order = np.argsort(inverse.ravel(), kind="stable")
        starts = np.searchsorted(inverse.ravel()[order], np.arange(len(known)))
        n, mean = n[order], mean[order]
        whole = np.add.reduceat(n, starts)
        centre = np.add.reduceat(mean * n[:, None], starts, axis=0) / whole[:, None]
        apart = mean - np.repeat(centre, np.diff(np.append(starts, len(n))), axis=0)
        inside = np.add.reduceat(apart * apart * n[:, None], starts, axis=0)
        if spread.shape == mean.shape:
            inside += np.add.reduceat(spread[order], starts, axis=0)
        self._take(known, whole, centre, inside)

    def _take(self, keys: np.ndarray, n: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> None:
        """Moments of different keys."""
        at = np.empty(len(keys), "i8")
        for i, key in enumerate(keys):
            at[i] = self.places.setdefault(key.tobytes(), len(self.places))
        if self.mean is not None and self.mean.shape[1] != mean.shape[1]:
            raise ValueError("the vectors are of several sizes: say by dims which one counts")
        fresh = at >= len(self.keys)
        self.keys.extend(keys[fresh])
        if len(self.keys) > len(self.n):
            room = max(len(self.keys), 2 * len(self.n))
            self.n = np.append(self.n, np.zeros(room - len(self.n), "i8"))
            grown = [np.zeros((room, mean.shape[1])) for _ in range(2)]
            for held, new in zip((self.mean, self.spread), grown):
                if held is not None:
                    new[: len(held)] = held
            self.mean, self.spread = grown
        whole = self.n[at] + n
        shift = mean - self.mean[at]
        part = (n / whole)[:, None]
        self.spread[at] += spread + shift * shift * part * self.n[at][:, None]
        self.mean[at] += shift * part
        self.n[at] = whole

    def drain(self):
        """Hand out ``(keys, n, mean, spread)`` in slices, and hold nothing any more."""
        if self.keys:
            keys, used = np.stack(self.keys), len(self.keys)
            for part in row_slices(used, self.mean.shape[1]):
                some = slice(part.start, min(part.stop, used))
                yield keys[some], self.n[some], self.mean[some], self.spread[some]
        self._clear()


class CoMoments:
    """Count, mean and summed products of deviations of vectors, in square tiles.

    Only tiles on and above the diagonal are held. A batch is centred on its own mean and its tiles
    are then merged, so nothing depends on how far from the origin the vectors lie.
    """

    def __init__(self, dims: int, tile: int):
        self.parts = [slice(at, min(at + tile, dims)) for at in range(0, dims, tile)]
        self.n, self.mean = 0, np.zeros(dims)
        self.tiles = {
            (i, j): np.zeros((a.stop - a.start, b.stop - b.start))
            for i, a in enumerate(self.parts)
            for j, b in enumerate(self.parts)
            if i <= j
        }

    def add(self, rows: np.ndarray) -> None:
        if not len(rows):
            return
        n, mean = len(rows), rows.mean(axis=0)
        apart = rows - mean
        shift, whole = mean - self.mean, self.n + n
        weight = self.n * n / whole
        for (i, j), tile in self.tiles.items():
            a, b = self.parts[i], self.parts[j]
            tile += apart[:, a].T @ apart[:, b]
            tile += np.outer(shift[a] * weight, shift[b])
        self.mean += shift * (n / whole)
        self.n = whole
