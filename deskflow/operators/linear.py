"""One linear solver for all classes: squared hinge loss, one class against the others.

Rows are packed once to blocks of sparse arrays.  A pass over the blocks gives the sums of all classes together: one small
matrix per block, added up in a tree.  A step takes two passes: every block proposes the Newton directions of its own
rows at the common gradient, whose mean is the common direction; then the losses of several step lengths are compared.
Blocks are dealt by a hash, so each is a fair sample, and a handful of steps is enough however many there are.  Where
blocks are too small to be that, the steps before correct the direction (limited-memory BFGS, with the blocks' mean as
the first guess of the inverse).
"""

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from deskflow.functions.sparse import HingeBlock, SparseRows

_PACKED = "block int, n long, labels binary, size binary, columns binary, cells binary"
_SUMS = "block int, sums binary"
# Steps tried, and the share of the promised gain that a step must bring.
_STEPS = 2.0 ** -np.arange(12)
_GAIN = 1e-4
_REMEMBERED = 12


def _pack(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by([("_order", "ascending"), ("label", "ascending")])
    size = pa.compute.list_value_length(rows.column("columns")).to_numpy()
    flat = [np.asarray(rows.column(c).combine_chunks().flatten(), kind) for c, kind in (("columns", "<i4"), ("cells", "<f8"))]
    parts = [rows.column("label").to_numpy().astype("<i4"), size.astype("<i4"), *flat]
    return pa.table([pa.array([rows.column("block")[0].as_py()], pa.int32()), pa.array([len(rows)], pa.int64()),
                     *[pa.array([p.tobytes()], pa.binary()) for p in parts]],
                    names=["block", "n", "labels", "size", "columns", "cells"])


def _added(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("block")
    total = np.sum([np.frombuffer(b, "<f8") for b in rows.column("sums").to_pylist()], axis=0)
    return pa.table([rows.column("block")[:1], pa.array([total.tobytes()], pa.binary())], names=["block", "sums"])


class SquaredHinge:
    """Coefficients (features and intercept x classes), with the steps taken and the slope that was left."""

    def __init__(self, coefficients: np.ndarray, steps: int, slope: float):
        self.coefficients, self.steps, self.slope = coefficients, steps, slope

    @classmethod
    def fit(cls, rows: DataFrame, width: int, classes: int, c: float = 1.0, tol: float = 1e-7, max_steps: int = 100,
            rows_per_block: int = 8192) -> "SquaredHinge":
        """Fit on rows (label, columns, cells, _order): class number, sparse entries, and a number that deals them out.

        The result does not depend on the order or the partitions of the rows.  ``slope`` is the largest partial
        derivative at the end, by row; ``tol`` bounds it, ``max_steps`` only guards against a fit that does not get there.
        """
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        total = rows.count()
        blocks = max(1, math.ceil(total / rows_per_block))
        dealt = rows.withColumn("block", F.pmod(F.xxhash64("_order"), F.lit(blocks)).cast("int"))
        packed = dealt.groupBy("block").applyInArrow(_pack, _PACKED).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return cls(*_solve(packed, blocks, total, width, classes, c, tol, max_steps))
        finally:
            packed.unpersist()
            rows.unpersist()

    def scores(self, size: np.ndarray, columns: np.ndarray, cells: np.ndarray) -> np.ndarray:
        return SparseRows(size, columns, cells, len(self.coefficients) - 1).times(self.coefficients)


def _solve(packed: DataFrame, blocks: int, total: int, width: int, classes: int, c: float, tol: float, max_steps: int):
    shape = (width + 1, classes)
    if not total:
        return np.zeros(shape), 0, 0.0
    spark = packed.sparkSession

    def over_blocks(work: Callable[[HingeBlock, int], np.ndarray], sent: tuple, form: tuple) -> np.ndarray:
        """Sum of ``work(block, rows, *sent)`` over all blocks."""
        shared = spark.sparkContext.broadcast(sent)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in batch.to_pylist():
                    size, columns, labels = (np.frombuffer(r[k], "<i4") for k in ("size", "columns", "labels"))
                    block = HingeBlock(SparseRows(size, columns, np.frombuffer(r["cells"], "<f8"), width), labels, classes)
                    found = work(block, r["n"], *shared.value)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r["block"]], pa.int32()), pa.array([found.astype("<f8").tobytes()], pa.binary())], ["block", "sums"])

        sums = packed.mapInArrow(run, _SUMS)
        if blocks > 16:
            # A tree of two levels: the driver adds up as many matrices as a task did.
            sums = sums.groupBy((F.col("block") % math.isqrt(blocks)).alias("part")).applyInArrow(_added, _SUMS)
        found = _added(sums.toArrow())
        shared.unpersist()
        return np.frombuffer(found.column("sums")[0].as_py(), "<f8").reshape(form)

    def newton(block, n, w, gradient, close):
        return n / total * block.newton(w, gradient, c * total / n, close)

    def search(block, n, w, p):
        return np.concatenate([block.along(w, p, np.r_[0.0, _STEPS]), block.slope(w + p)])

    def guess(w, towards, close):
        """The blocks' mean of the inverse curvature times ``towards``."""
        return -over_blocks(newton, (w, towards, close), shape)

    w = np.zeros(shape)
    gradient = c * over_blocks(lambda block, n, w: block.slope(w), (w,), shape)
    started = np.abs(gradient).max()
    past: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for step in range(max_steps):
        left = np.abs(gradient).max()
        if left <= tol * c * total:
            return w, step, left / (c * total)
        p = -_bent(gradient, past, lambda towards: guess(w, towards, min(0.1, math.sqrt(left / started))))
        # Where rounding or a poor guess spoils a direction, straight down.
        p = np.where((gradient * p).sum(axis=0) < 0, p, -gradient)
        found = over_blocks(search, (w, p), (1 + len(_STEPS) + shape[0], classes))
        norms = np.stack([((w + t * p) ** 2).sum(axis=0) / 2 for t in np.r_[0.0, _STEPS]])
        values = norms + c * found[:1 + len(_STEPS)]
        promised = (gradient * p).sum(axis=0)
        # Rounding hides gains this small.
        noise = 1e-12 * np.abs(values[0])
        good = values[1:] <= values[0] + _GAIN * _STEPS[:, None] * promised + noise
        length = np.where(good.any(axis=0), _STEPS[good.argmax(axis=0)], 0.0)
        if not length.any():
            return w, step + 1, left / (c * total)
        moved = length * p
        if (length == 1.0).all():
            after = w + moved + c * found[1 + len(_STEPS):]
        else:
            after = w + moved + c * over_blocks(lambda block, n, w: block.slope(w), (w + moved,), shape)
        change = after - gradient
        along = (moved * change).sum(axis=0)
        # The directions of a single block are Newton's own and need no correction.
        if blocks > 1:
            past = [*past[1 - _REMEMBERED:], (moved, change, np.where(along > 0, 1.0 / np.where(along > 0, along, 1.0), 0.0))]
        w, gradient = w + moved, after
    return w, max_steps, np.abs(gradient).max() / (c * total)


def _bent(gradient: np.ndarray, past: list, guess: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Inverse curvature times the gradient, from steps and changes of the gradient, and a guess of the rest."""
    towards, shares = gradient.copy(), []
    for moved, change, inverse in reversed(past):
        share = inverse * (moved * towards).sum(axis=0)
        towards -= share * change
        shares.append(share)
    found = guess(towards)
    for (moved, change, inverse), share in zip(past, reversed(shares)):
        found = found + (share - inverse * (change * found).sum(axis=0)) * moved
    return found
