"""Sparse rows as numpy arrays, and one-against-all squared hinge losses over them; runs inside tasks."""

import sys

import numpy as np
from pyspark import cloudpickle

# Sent to the tasks with the code that uses it, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class SparseRows:
    """Rows of (column, value), each with one more column of ones at the end, for the intercept."""

    def __init__(self, size: np.ndarray, columns: np.ndarray, values: np.ndarray, width: int):
        n, ends = len(size), np.cumsum(size)
        self.n, self.width = n, width + 1
        self.columns = np.insert(columns.astype(np.int64), ends, width)
        self.values = np.insert(values.astype(np.float64), ends, 1.0)
        self.row = np.repeat(np.arange(n), size + 1)

    def __len__(self) -> int:
        return self.n

    def times(self, m: np.ndarray) -> np.ndarray:
        return np.stack([np.bincount(self.row, self.values * x[self.columns], self.n) for x in np.ascontiguousarray(m.T)], axis=1)

    def transposed_times(self, m: np.ndarray) -> np.ndarray:
        return np.stack([np.bincount(self.columns, self.values * x[self.row], self.width) for x in np.ascontiguousarray(m.T)], axis=1)


class HingeBlock:
    """A block of labelled rows; every function works for all classes at once.

    The objective of a class is |w|^2 / 2 + c * sum max(0, 1 - y w.x)^2; functions give the sums over the block.
    """

    def __init__(self, rows: SparseRows, labels: np.ndarray, classes: int):
        self.rows = rows
        self.signs = np.where(labels[:, None] == np.arange(classes), 1.0, -1.0)

    def _short(self, scores: np.ndarray) -> np.ndarray:
        """How far each row falls short of its margin."""
        return np.maximum(0.0, 1.0 - self.signs * scores)

    def slope(self, w: np.ndarray) -> np.ndarray:
        return -2.0 * self.rows.transposed_times(self.signs * self._short(self.rows.times(w)))

    def along(self, w: np.ndarray, p: np.ndarray, steps: np.ndarray) -> np.ndarray:
        """Losses at w + t p for each step t, by class."""
        at, way = self.rows.times(w), self.rows.times(p)
        return np.stack([(self._short(at + t * way) ** 2).sum(axis=0) for t in steps])

    def newton(self, w: np.ndarray, gradient: np.ndarray, weight: float, close: float, most: int = 60) -> np.ndarray:
        """Newton direction of each class by conjugate gradients, as if the rows of the block, ``weight`` times, were all."""
        active = self._short(self.rows.times(w)) > 0
        p, left = np.zeros_like(gradient), -gradient
        way, size = left.copy(), (left * left).sum(axis=0)
        goal = size * close ** 2
        for _ in range(most):
            # Classes that are not there yet.
            live = np.flatnonzero(size > goal)
            if not len(live):
                break
            ahead = way[:, live]
            bent = ahead + 2.0 * weight * self.rows.transposed_times(np.where(active[:, live], self.rows.times(ahead), 0.0))
            step = size[live] / (ahead * bent).sum(axis=0)
            p[:, live] += step * ahead
            left[:, live] -= step * bent
            new = (left[:, live] ** 2).sum(axis=0)
            way[:, live] = left[:, live] + new / size[live] * ahead
            size[live] = new
        return p
