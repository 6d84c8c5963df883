"""Logistic regression with an L2 penalty by Newton's method: reweighted least squares, a few passes over the data.

Every pass is one aggregate: the gradient and the weighted Gram matrix of all rows, added up inside the tasks and then
in two levels. The driver holds that matrix, a number per pair of features, and solves for the next coefficients.
Features are centred and scaled for the arithmetic only. The penalty is on the coefficients of the features as they
are, and the intercept is free, so centring changes nothing but the accuracy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playthrough.sources.code import ship_code

#: Beyond this the matrix is too large for a task: 32 MB at this number.
MOST_FEATURES = 2000
#: Groups that the tasks' sums are added up in, before their sums are.
FIRST_LEVEL = 64
ROWS_AT_ONCE = 2048
#: Times a step is halved that does not lower the loss.
HALVINGS = 30
#: A gain below this share of the loss is near the optimum; there, steps that are taken without a look at the loss.
NEAR, POLISHED = 1e-7, 2
#: Directions of less curvature than this, relative to the largest, are flat: the coefficients stay as they are.
FLAT = 1e-14


@dataclass(frozen=True)
class Fit:
    coefficients: np.ndarray
    intercept: float
    passes: int
    converged: bool


def _upper(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(n)


def _summed(design: DataFrame, step) -> np.ndarray:
    """The sum of the arrays that ``step`` makes, one per task."""
    sums = design.mapInArrow(step, "sums array<double>")
    sums = sums.select(array_to_vector("sums").alias("v"), F.pmod(F.spark_partition_id(), F.lit(FIRST_LEVEL)).alias("g"))
    sums = sums.groupBy("g").agg(Summarizer.sum(F.col("v")).alias("v"))
    return sums.agg(Summarizer.sum(F.col("v")).alias("v")).first()["v"].toArray()


def _blocks(batch: pa.RecordBatch, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    y, weight = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2))
    for at in range(0, len(x), ROWS_AT_ONCE):
        part = slice(at, at + ROWS_AT_ONCE)
        yield x[part], y[part], weight[part]


def _one(sums: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([sums], pa.list_(pa.float64()))], ["sums"])


def _moments(width: int, around: np.ndarray):
    """Sum of weights, and weighted sums of the features and their squares, from a point near the mean."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(1 + 2 * width)
        for batch in batches:
            for x, _, weight in _blocks(batch, width):
                z = x - around
                sums += np.concatenate([[weight.sum()], weight @ z, weight @ (z * z)])
        yield _one(sums)

    return add


def _pass(used: np.ndarray, width: int, centre: np.ndarray, scale: np.ndarray, weights: np.ndarray):
    """Loss, gradient and Gram matrix at ``weights``, the intercept last."""
    n = len(used) + 1
    rows, columns = _upper(n)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, gradient, gram = 0.0, np.zeros(n), np.zeros((n, n))
        for batch in batches:
            for x, y, weight in _blocks(batch, width):
                z = np.ones((len(x), n))
                z[:, :-1] = (x[:, used] - centre) / scale
                eta = z @ weights
                p = 0.5 * (1 + np.tanh(0.5 * eta))
                loss += weight @ (np.logaddexp(0, eta) - y * eta)
                gradient += z.T @ (weight * (p - y))
                gram += z.T @ (z * (weight * p * (1 - p))[:, None])
        yield _one(np.concatenate([[loss], gradient, gram[rows, columns]]))

    return add


def _solved(gram: np.ndarray, gradient: np.ndarray) -> np.ndarray:
    size, directions = np.linalg.eigh(gram)
    usable = size > FLAT * max(size.max(), 1e-300)
    along = directions[:, usable]
    return along @ ((along.T @ gradient) / size[usable])


def fit(design: DataFrame, c: float = 1.0, max_iter: int = 100, tol: float = 1e-9) -> Fit:
    """Minimise the weighted sum of losses plus ``|coefficients|² / (2 c)`` over rows (x, label, weight).

    ``x`` is an array of the same length everywhere. It ends when a step would lower the loss by less than ``tol`` of
    it, after ``max_iter`` passes, or when halved steps do not lower it any more.
    """
    ship_code(design.sparkSession)
    first = design.select("x").first()
    width = len(first["x"])
    design = design.select("x", F.col("label").cast("double"), F.col("weight").cast("double"))
    around = np.array(first["x"], dtype=np.float64)
    total, *rest = np.split(_summed(design, _moments(width, around)), [1, 1 + width])
    mean = rest[0] / total
    variance = rest[1] / total - mean * mean
    # What is left of a constant by rounding is no spread.
    spread = np.sqrt(np.where(variance > 1e-14 * np.maximum(mean * mean, 1e-300), variance, 0))
    used = np.flatnonzero(spread)
    centre, scale = (around + mean)[used], spread[used]
    n = len(used) + 1
    penalty = np.append(1 / (c * scale**2), 0.0)
    rows, columns = _upper(n)

    def measured(at: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        sums = _summed(design, _pass(used, width, centre, scale, at))
        gram = np.zeros((n, n))
        gram[rows, columns] = sums[1 + n :]
        gram[columns, rows] = sums[1 + n :]
        loss = sums[0] + 0.5 * (penalty * at) @ at
        return loss, sums[1 : 1 + n] + penalty * at, gram + np.diag(penalty)

    weights, passes, converged, polished = np.zeros(n), 1, False, 0
    loss, gradient, gram = measured(weights)
    while passes <= max_iter:
        step = _solved(gram, gradient)
        gain = step @ gradient
        if gain <= tol * max(abs(loss), 1e-300) or polished == POLISHED:
            # Too little left for another pass; the step itself is still an improvement to second order.
            weights, converged = weights - step, True
            break
        if gain <= NEAR * max(abs(loss), 1e-300):
            # So near that each step squares the distance, and that the loss may not show it.
            weights, polished = weights - step, polished + 1
            loss, gradient, gram = measured(weights)
            passes += 1
            continue
        for _ in range(HALVINGS):
            tried = measured(weights - step)
            passes += 1
            if tried[0] <= loss:
                break
            step = step / 2
        else:
            break
        weights = weights - step
        loss, gradient, gram = tried
    coefficients = np.zeros(width)
    coefficients[used] = weights[:-1] / scale
    return Fit(coefficients, float(weights[-1] - coefficients[used] @ centre), passes, converged)
