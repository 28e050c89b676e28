"""Numpy and Arrow helpers that run inside tasks."""

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# Sent to the tasks with the code that uses it, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE = 1_000_000
_QUERIES_AT_ONCE, _ROWS_AT_ONCE, _PAIRS_AT_ONCE = 256, 4096, 1 << 13
_FIRST_LOOK = 512
_NO_ROW = -(1 << 62)


def matrix_of(vectors: pa.Array) -> np.ndarray:
    """Rows of a list array as a double matrix."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    if len(vectors) == 0:
        return np.zeros((0, 0))
    return np.asarray(vectors.flatten(), dtype=np.float64).reshape(len(vectors), -1)


def unit_rows(m: np.ndarray) -> np.ndarray:
    if m.size == 0:
        return m
    length = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(length > 0, length, 1.0)


def without_spare_copies(index: np.ndarray, k: int) -> np.ndarray:
    """Places of the rows that can be among the k best: of equal rows the first k."""
    bits = np.ascontiguousarray(index).view(np.uint64)
    odd = np.random.default_rng(1).integers(0, 1 << 63, bits.shape[1], dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    mixed = np.zeros(len(bits), np.uint64)
    for start in range(0, len(bits), _ROWS_AT_ONCE):
        part = bits[start:start + _ROWS_AT_ONCE]
        mixed[start:start + _ROWS_AT_ONCE] = ((part ^ (part >> np.uint64(29))) * odd).sum(axis=1, dtype=np.uint64)
    order = np.argsort(mixed, kind="stable")
    first = np.flatnonzero(np.r_[True, mixed[order][1:] != mixed[order][:-1]])
    size = np.diff(np.r_[first, len(order)])
    keep = np.ones(len(index), bool)
    for a, n in zip(first[size > k].tolist(), size[size > k].tolist()):
        group = order[a:a + n]
        if all((index[group[i:i + _ROWS_AT_ONCE]] == index[group[0]]).all() for i in range(0, n, _ROWS_AT_ONCE)):
            keep[group[k:]] = False
    return np.flatnonzero(keep)


def best_rows(queries: np.ndarray, index: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and similarities of the k best index rows per query, best first.

    Rows are of unit length, and the index rows in id order: ties go to the lower one.  Products of single precision
    choose the rows that can still be among the best, with a bound for their error; only these are scored in double
    precision, so the result is that of double precision for all.
    """
    n, total = min(k, len(index)), len(queries)
    if n == 0 or total == 0:
        return np.zeros((total, 0), dtype=np.int64), np.zeros((total, 0))
    useful = without_spare_copies(index, n)
    if len(useful) < len(index):
        index = index[useful]
    # Rounding of the inputs and of every step of the sum, and of scores to six decimals.
    slack = (index.shape[1] + 4) * 2.0 ** -23 + 1.5 / SCALE
    rows = index.astype(np.float32)
    places, scores = np.empty((total, n), np.int64), np.empty((total, n))
    for q0 in range(0, total, _QUERIES_AT_ONCE):
        asked = queries[q0:q0 + _QUERIES_AT_ONCE]
        narrow = asked.astype(np.float32)
        # Kept rows as one number, score before place; the worst of a full list bounds what can still enter it.
        best = np.full((len(asked), n), _NO_ROW)
        bound = np.full(len(asked), -np.inf, np.float32)
        for i0 in range(0, len(index), _ROWS_AT_ONCE):
            tile = narrow @ rows[i0:i0 + _ROWS_AT_ONCE].T
            if i0 == 0 and tile.shape[1] > n:
                # Any n rows bound the n best of all from below.
                few = tile[:, :max(_FIRST_LOOK, 4 * n)]
                bound = np.partition(few, few.shape[1] - n, axis=1)[:, few.shape[1] - n] - np.float32(slack)
            who, where = np.divmod(np.flatnonzero(tile >= bound[:, None]), tile.shape[1])
            if not len(who):
                continue
            exact = _products(asked, index[i0:i0 + _ROWS_AT_ONCE], who, where)
            keys = np.rint(exact * SCALE).astype(np.int64) * len(index) + (len(index) - 1 - i0 - where)
            best = _largest(best, who, keys)
            full = best[:, -1] > _NO_ROW
            worst = np.floor_divide(best[full, -1], len(index)) / SCALE
            bound[full] = np.maximum(bound[full], (worst - slack).astype(np.float32))
        places[q0:q0 + len(asked)] = useful[len(index) - 1 - np.mod(best, len(index))]
        scores[q0:q0 + len(asked)] = np.floor_divide(best, len(index)) / SCALE
    return places, scores


def _products(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of the pairs of rows (i, j)."""
    if 8 * len(i) > len(left) * len(right):
        return (left @ right.T)[i, j]
    return np.concatenate([np.einsum("ij,ij->i", left[i[s:s + _PAIRS_AT_ONCE]], right[j[s:s + _PAIRS_AT_ONCE]])
                           for s in range(0, len(i), _PAIRS_AT_ONCE)])


def _largest(best: np.ndarray, who: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The largest numbers of each row of ``best`` and of what is new for the row, from the largest down."""
    n = best.shape[1]
    who, keys = np.r_[np.repeat(np.arange(len(best)), n), who], np.r_[best.ravel(), keys]
    order = np.lexsort((-keys, who))
    who, keys = who[order], keys[order]
    first = np.searchsorted(who, np.arange(len(best)))
    return keys[np.arange(len(who)) - first[who] < n].reshape(best.shape)


def list_array(values: pa.Array, width: int, rows: int) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * width, pa.int32()), values)
