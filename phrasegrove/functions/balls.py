"""A two-level index of centroids: balls of members, skipped where the triangle inequality allows.

For a point x and a ball with centre c and radius r, no member is nearer than |x - c| - r. A point
first meets the members of its nearest ball, and then only those of balls whose bound does not
exceed what it has found. The answers are those of comparing all; where few balls can be
skipped, all are compared at once.
"""

from __future__ import annotations

import numpy as np

from phrasegrove.functions import kernels

# Fewer centroids than this are compared one and all.
LEAST = 128
# Steps in which the balls are formed, and the part of all comparisons from which all are made.
STEPS = 4
MOST = 0.5
# Points that go through the balls at a time.
ROWS = 4096


class Balls:
    """Centroids in about as many balls as the root of their number.

    ``offsets``, if given, is added to the squared distance to each centroid.
    """

    def __init__(self, centres: np.ndarray, offsets: np.ndarray | None = None):
        self.centres = centres
        self.offsets = np.zeros(len(centres)) if offsets is None else offsets
        self.evaluated = 0  # distances that were worked out
        self.members: list[np.ndarray] = []
        if len(centres) < LEAST:
            return
        wanted = int(np.ceil(np.sqrt(len(centres))))
        heads = centres[np.linspace(0, len(centres) - 1, wanted).astype(int)]
        for _ in range(STEPS):
            own = kernels.roughly_nearest(centres, heads)
            used, own = np.unique(own, return_inverse=True)
            heads = np.zeros((len(used), centres.shape[1]))
            np.add.at(heads, own, centres)
            heads /= np.bincount(own)[:, None]
        own = kernels.roughly_nearest(centres, heads)
        used, own = np.unique(own, return_inverse=True)
        self.heads = heads[used]
        self.members = [np.flatnonzero(own == j) for j in range(len(used))]
        apart = centres - self.heads[own]
        reach = np.sqrt(np.einsum("ij,ij->i", apart, apart))
        self.radius = np.array([reach[m].max() for m in self.members])
        self.least_offset = np.array([self.offsets[m].min() for m in self.members])
        self.sizes = np.array([len(m) for m in self.members])
        # Above what rounding can do to a bound, and to a distance that is rounded to its digits.
        self.scale = np.einsum("ij,ij->i", centres, centres).max()

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``kernels.nearest``: index and squared distance, equal ones to the smaller index."""
        found, least = np.zeros(len(points), "i8"), np.full(len(points), np.inf)

        def visit(rows: np.ndarray, members: np.ndarray) -> None:
            at, gap = kernels.nearest(points[rows], self.centres[members])
            at = members[at]
            better = (gap < least[rows]) | ((gap == least[rows]) & (at < found[rows]))
            least[rows[better]], found[rows[better]] = gap[better], at[better]

        self._walk(points, least, visit)
        return found, least

    def least_other(self, points: np.ndarray, own: np.ndarray) -> np.ndarray:
        """The smallest squared distance plus offset to a centroid other than ``own`` (-1: none)."""
        least = np.full(len(points), np.inf)
        places = np.zeros(len(self.centres), "i8")

        def visit(rows: np.ndarray, members: np.ndarray) -> None:
            places[members] = np.arange(len(members))
            for part in kernels.row_slices(len(rows), len(members)):
                some = rows[part]
                values = kernels.squared_gaps(points[some], self.centres[members]) + self.offsets[members]
                mine = np.flatnonzero((own[some] >= 0) & np.isin(own[some], members))
                values[mine, places[own[some][mine]]] = np.inf
                least[some] = np.minimum(least[some], values.min(axis=1))

        self._walk(points, least, visit)
        return least

    def _walk(self, points: np.ndarray, least: np.ndarray, visit) -> None:
        """Have every point visit the balls that may better its entry of ``least``."""
        every = np.arange(len(self.centres))
        for at in range(0, len(points), ROWS):
            rows = np.arange(at, min(at + ROWS, len(points)))
            if not self.members:
                self.evaluated += len(rows) * len(every)
                visit(rows, every)
                continue
            x = points[rows]
            gaps = np.sqrt(kernels.squared_gaps(x, self.heads))
            bounds = np.maximum(0, gaps - self.radius) ** 2 + self.least_offset
            slack = 2e-9 + 1e-11 * (np.einsum("ij,ij->i", x, x) + self.scale)
            self.evaluated += gaps.size
            first = gaps.argmin(axis=1)
            for j in np.unique(first):
                self._visit(j, rows[first == j], visit)
            bounds[np.arange(len(rows)), first] = np.inf
            alive = bounds <= (least[rows] + slack)[:, None]
            if (alive * self.sizes).sum() > MOST * len(rows) * len(every):
                self.evaluated += len(rows) * len(every)
                visit(rows, every)
                continue
            for j in np.flatnonzero(alive.any(axis=0)):
                some = rows[alive[:, j]]
                # What was found since may rule the ball out.
                some = some[bounds[some - at, j] <= least[some] + slack[some - at]]
                if len(some):
                    self._visit(j, some, visit)

    def _visit(self, ball: int, rows: np.ndarray, visit) -> None:
        self.evaluated += len(rows) * self.sizes[ball]
        visit(rows, self.members[ball])
