"""Logistic regression by Newton steps, with a certificate of its optimum.

A step needs the loss, its gradient and its second derivatives at the present
coefficients: one weighted Gram matrix, added up by the tasks over their rows
and then by a small shuffle, so that (features + 1) squared numbers come to the
driver, whatever the number of rows.  Newton steps end after a handful of
passes.  The loss is strictly convex under the penalty, so a gradient of zero
proves the optimum: :attr:`LogisticFit.gradient` is that certificate, one
number a feature, and holds for any other solver's result as well.

The objective is the one of :func:`truant.operators.models.fit_logistic`:
mean weighted log loss plus ``penalty / 2`` times the squared coefficients, the
intercept without penalty, features as they come.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truant.session import ship_package

ROWS_AT_A_TIME = 8192


@dataclass
class LogisticFit:
    features: list[str]
    coefficients: np.ndarray
    intercept: float
    gradient: np.ndarray      # of the penalised mean loss: one a feature, the intercept's last
    loss: float
    steps: int                # passes over the rows

    def frame(self, spark) -> DataFrame:
        """(Feature, Coefficient, Gradient), the intercept under ``(intercept)``."""
        rows = zip([*self.features, "(intercept)"], [*map(float, self.coefficients), float(self.intercept)], map(float, self.gradient), strict=True)
        return spark.createDataFrame(list(rows), "Feature string, Coefficient double, Gradient double")


def design(df: DataFrame, features: list[str], target: str, weight: Column | None = None) -> DataFrame:
    """(x: array of the features, y, w); null features count as 0, rows without a target are left out."""
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features])
    return df.where(F.col(target).isNotNull()).select(x.alias("x"), F.col(target).cast("double").alias("y"), (F.lit(1.0) if weight is None else weight).cast("double").alias("w"))


def sums(rows: DataFrame, beta: np.ndarray) -> np.ndarray:
    """[sum of w, loss, gradient (d), Gram matrix (d * d)] at ``beta`` (d: features and intercept), summed over ``rows``."""
    d = len(beta)
    shared = rows.sparkSession.sparkContext.broadcast(beta)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 + d + d * d)
        for b in batches:
            for k in range(0, b.num_rows, ROWS_AT_A_TIME):
                part = b.slice(k, ROWS_AT_A_TIME)
                x = np.ones((part.num_rows, d))
                x[:, :-1] = part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, d - 1)
                y, w = part.column(1).to_numpy(), part.column(2).to_numpy()
                z = x @ shared.value
                p = 0.5 * (1 + np.tanh(z / 2))  # without overflow
                total[0] += w.sum()
                total[1] += (w * (np.logaddexp(0, z) - y * z)).sum()
                total[2 : 2 + d] += x.T @ (w * (p - y))
                total[2 + d :] += (x.T @ (x * (w * p * (1 - p))[:, None])).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["i", "v"])

    out = np.zeros(2 + d + d * d)
    for r in rows.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[r.i] = r.v
    return out


def _at(rows: DataFrame, beta: np.ndarray, penalty: float) -> tuple[float, np.ndarray, np.ndarray]:
    """Penalised mean loss, gradient and second derivatives."""
    d = len(beta)
    s = sums(rows, beta)
    total = s[0] or 1.0
    lam = np.full(d, penalty)
    lam[-1] = 0.0
    return s[1] / total + 0.5 * float((lam * beta * beta).sum()), s[2 : 2 + d] / total + lam * beta, s[2 + d :].reshape(d, d) / total + np.diag(lam)


def certificate(rows: DataFrame, coefficients: np.ndarray, intercept: float, penalty: float) -> np.ndarray:
    """The gradient at any solver's coefficients; all zero only at the optimum."""
    return _at(rows, np.append(np.asarray(coefficients, float), intercept), penalty)[1]


def fit(df: DataFrame, features: list[str], target: str, weight: Column | None = None, penalty: float | None = None,
        tolerance: float = 1e-9, max_steps: int = 50) -> LogisticFit:
    """The optimum to a greatest gradient of ``tolerance``; ``penalty`` defaults to one over the number of rows.

    ``df`` is read once a step and should be a written table.  A step that does
    not lower the loss is halved.  Without penalty, classes that the features
    separate have no finite optimum: the fit then ends after ``max_steps``, and
    its gradient tells.
    """
    ship_package(df.sparkSession)
    rows = design(df, features, target, weight)
    if penalty is None:
        penalty = 1.0 / max(1, rows.count())
    beta = np.zeros(len(features) + 1)
    loss, gradient, second = _at(rows, beta, penalty)
    steps = 1
    while np.abs(gradient).max() > tolerance and steps < max_steps:
        move = np.linalg.lstsq(second, gradient, rcond=None)[0]  # features that depend on each other leave a flat direction
        size = 1.0
        while True:
            trial = _at(rows, beta - size * move, penalty)
            steps += 1
            if trial[0] <= loss + 1e-15 * abs(loss) or size < 1e-6 or steps >= max_steps:
                break
            size /= 2
        if trial[0] > loss + 1e-12 * abs(loss):
            break
        beta = beta - size * move
        loss, gradient, second = trial
    return LogisticFit(features, beta[:-1], float(beta[-1]), gradient, float(loss), steps)
