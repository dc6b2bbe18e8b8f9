"""Linear SVM with squared hinge loss, by distributed Newton steps.

Minimises |v|^2 / 2 + C * sum of weight * max(0, 1 - s (v . x))^2, where x has
a constant 1 appended (its coefficient, the intercept, is shrunk like the
others) and s is +1 or -1. A step needs two sums over the rows, both of the
size of the dimension squared: gradient and generalised Hessian of the rows
inside the margin, and the losses at a ladder of step lengths. Tasks sum
their rows first; only totals reach the driver. The loss is piecewise
quadratic and strictly convex, so the steps end with a gradient near zero,
which is returned for checking.

Balanced class weights are n / (2 * n_class) of the rows of the fit.
``calibrate`` fits one SVM and one sigmoid a fold, each fold's weights its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cirflow.operators.boosting import _matrix, vector
from cirflow.session import stored

STEPS, NEAR = 100, 1e-9
#: Step lengths tried at once.
LENGTHS = 0.5 ** np.arange(0, 20)


@dataclass
class LinearModel:
    """Coefficients, intercept, and the gradient's norm at them as a share of that at zero."""

    coef: np.ndarray
    intercept: float
    gradient: float
    steps: int

    def margin(self, features: Column) -> Column:
        """The decision value of an array column."""
        products = F.zip_with(features, F.array(*[F.lit(float(c)) for c in self.coef]), lambda x, c: x * c)
        return F.aggregate(products, F.lit(float(self.intercept)), lambda s, x: s + x)


def _total(rows: DataFrame, width: int, of: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of the vector that ``of(x, sign, weight)`` returns for a batch."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x = np.column_stack([_matrix(batch.column(0), width), np.ones(batch.num_rows)])
                part = of(x, np.asarray(batch.column(1)), np.asarray(batch.column(2)))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["i", "v"])

    t = rows.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros((max(t["i"].to_pylist()) + 1) if t.num_rows else 0)
    out[t["i"].to_numpy()] = t["v"].to_numpy()
    return out


def fit(df: DataFrame, features: str = "features", label: str = "y", c: float = 1.0, balanced: bool = True, steps: int = STEPS, near: float = NEAR) -> LinearModel:
    """Fit on the rows of ``df`` whose label is 0 or 1. One class alone, or no row, gives zeros."""
    rows = df.where(F.col(label).isin(0, 1)).select(vector(features, df).alias("x"), F.col(label).cast("int").alias("y"))
    n0, n1, width = rows.agg(F.count_if(F.col("y") == 0), F.count_if(F.col("y") == 1), F.max(F.size("x"))).first()
    if not n0 or not n1:
        return LinearModel(np.zeros(width or 0), 0.0, 0.0, 0)
    weight = F.when(F.col("y") == 1, (n0 + n1) / (2 * n1)).otherwise((n0 + n1) / (2 * n0)) if balanced else F.lit(1.0)
    rows = stored(rows.select("x", F.when(F.col("y") == 1, 1.0).otherwise(-1.0).alias("s"), weight.alias("w")), "svm-rows")
    d = width + 1
    iu = np.triu_indices(d)
    v, first = np.zeros(d), None

    for step in range(steps):
        def sums(x, s, w, v=v):
            miss = 1 - s * (x @ v)
            inside = miss > 0
            x, r, w = x[inside], (miss * s)[inside], w[inside]
            return np.concatenate([[(w * r * r).sum()], x.T @ (w * r), (x.T @ (x * w[:, None]))[iu]])

        total = _total(rows, width, sums)
        loss = 0.5 * v @ v + c * total[0]
        gradient = v - 2 * c * total[1:d + 1]
        hessian = np.zeros((d, d))
        hessian[iu] = 2 * c * total[d + 1:]
        hessian = hessian + np.triu(hessian, 1).T + np.eye(d)
        norm = float(np.linalg.norm(gradient))
        first = norm if first is None else first
        if norm <= near * max(first, 1e-300):
            break
        move = -np.linalg.solve(hessian, gradient)

        def losses(x, s, w, v=v, move=move):
            miss = np.maximum(1 - s[:, None] * ((x @ v)[:, None] + (x @ move)[:, None] * LENGTHS), 0)
            return (w[:, None] * miss * miss).sum(0)

        at = [v + t * move for t in LENGTHS]
        value = 0.5 * np.array([a @ a for a in at]) + c * _total(rows, width, losses)
        enough = value <= loss + 1e-4 * LENGTHS * (gradient @ move) + 1e-12 * abs(loss)
        if not enough.any():
            break
        v = at[int(enough.argmax())]
    return LinearModel(v[:-1].copy(), float(v[-1]), norm / max(first, 1e-300), step)


@dataclass
class Sigmoid:
    """P(1) = 1 / (1 + exp(a * margin + b))."""

    a: float
    b: float


def fit_sigmoid(df: DataFrame, margin: Column, label: str = "y", steps: int = STEPS) -> Sigmoid:
    """Platt's sigmoid: cross-entropy against the smoothed targets, by damped Newton steps on two numbers."""
    rows = stored(df.where(F.col(label).isin(0, 1)).select(F.array(margin).alias("x"), F.when(F.col(label) == 1, 1.0).otherwise(-1.0).alias("s"), F.lit(1.0).alias("w")), "sigmoid-rows")
    n1, n0 = rows.agg(F.count_if(F.col("s") > 0), F.count_if(F.col("s") < 0)).first()
    high, low = (n1 + 1.0) / (n1 + 2.0), 1.0 / (n0 + 2.0)
    z = np.array([0.0, np.log((n0 + 1.0) / (n1 + 1.0))])
    if not n0 + n1:
        return Sigmoid(0.0, 0.0)

    def losses(x, s, w, at):
        t = np.where(s > 0, high, low)
        f = x @ at.T
        return (np.logaddexp(0, f) - (1 - t)[:, None] * f).sum(0)     # -t log p - (1 - t) log(1 - p), p = 1 / (1 + e^f)

    for _ in range(steps):
        def sums(x, s, w, z=z):
            t = np.where(s > 0, high, low)
            p = 1 / (1 + np.exp(np.clip(x @ z, -700, 700)))
            q = p * (1 - p)
            h = x.T @ (x * q[:, None])
            return np.concatenate([x.T @ (t - p), [h[0, 0], h[0, 1], h[1, 1]], losses(x, s, w, z[None])])

        g0, g1, a, b, c, loss = _total(rows, 1, sums)
        gradient, hessian = np.array([g0, g1]), np.array([[a, b], [b, c]]) + 1e-12 * np.eye(2)
        if np.abs(gradient).max() <= 1e-9 * (n0 + n1):
            break
        move = -np.linalg.solve(hessian, gradient)
        at = np.array([z + t * move for t in LENGTHS])
        value = _total(rows, 1, lambda x, s, w, at=at: losses(x, s, w, at))
        enough = value <= loss + 1e-4 * LENGTHS * (gradient @ move)
        if not enough.any():
            break
        z = at[int(enough.argmax())]
    return Sigmoid(float(z[0]), float(z[1]))


@dataclass
class Calibrated:
    """An SVM and a sigmoid for each fold; probabilities are averaged over the folds."""

    folds: list[tuple[LinearModel, Sigmoid]]

    def predict(self, df: DataFrame, features: str = "features", keep: tuple[str, ...] = ("id", "y"), threshold: float = 0.5) -> DataFrame:
        rows = df.select(*keep, vector(features, df).alias("_x"))
        p = sum((F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(s.a) * m.margin(F.col("_x")) + F.lit(s.b))) for m, s in self.folds), F.lit(0.0)) / len(self.folds)
        return rows.select(*keep, p.alias("p")).withColumn("pred", (F.col("p") >= threshold).cast("int"))

    def coefficients(self, spark: SparkSession, names: list[str]) -> DataFrame:
        """(Feature, coef, abs_coef): the mean over the folds."""
        mean = np.mean([m.coef for m, _ in self.folds], axis=0)
        return spark.createDataFrame([(n, float(v), abs(float(v))) for n, v in zip(names, mean, strict=True)], "Feature string, coef double, abs_coef double")

    @property
    def gradient(self) -> float:
        """The largest gradient share of the folds' fits."""
        return max(m.gradient for m, _ in self.folds)


def calibrate(df: DataFrame, fold: str, k: int = 3, features: str = "features", label: str = "y", c: float = 1.0) -> Calibrated:
    """For each fold an SVM on the other folds (balanced by their own counts) and a sigmoid on the fold's decision values."""
    out = []
    for i in range(k):
        model = fit(df.where(F.col(fold) != i), features, label, c)
        held = df.where(F.col(fold) == i).select(vector(features, df).alias("_x"), label)
        out.append((model, fit_sigmoid(held, model.margin(F.col("_x")), label)))
    return Calibrated(out)
