"""Squared-hinge SVM against a plain optimiser, calibration, and vector shifts."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from cirflow.operators import classify as C
from cirflow.operators import svm


def table(spark, n=300, d=5, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * np.arange(1, d + 1)
    y = (x[:, 0] - 0.3 * x[:, 1] + rng.normal(0, 0.8, n) > 0.6).astype(int)
    df = spark.createDataFrame([(i, x[i].tolist(), int(y[i]), i % 3) for i in range(n)], "id long, features array<double>, y int, fold int").repartition(4)
    return x, y, df


def plain_svm(x, y, c=1.0):
    """Gradient descent with momentum on the same loss, to a tiny gradient."""
    s, a = np.where(y == 1, 1.0, -1.0), np.column_stack([x, np.ones(len(x))])
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    step = 1 / (1 + 2 * c * np.linalg.eigvalsh(a.T @ (a * w[:, None]))[-1])
    v = u = np.zeros(a.shape[1])
    for k in range(100_000):
        r = np.maximum(1 - s * (a @ u), 0)
        g = u - 2 * c * a.T @ (w * r * s)
        new = u - step * g
        u = new + k / (k + 3) * (new - v) if (g @ (new - v)) < 0 else new
        v = new
        if np.linalg.norm(g) < 1e-9:
            break
    return v


def test_svm_equals_a_plain_optimiser(spark):
    x, y, df = table(spark)
    m = svm.fit(df)
    assert m.gradient < 1e-9 and m.steps < 30
    v = plain_svm(x, y)
    assert np.concatenate([m.coef, [m.intercept]]) == pytest.approx(v, abs=1e-6)
    got = {r.id: r.m for r in df.select("id", m.margin(F.col("features")).alias("m")).collect()}
    assert [got[i] for i in range(300)] == pytest.approx(x @ v[:-1] + v[-1], abs=1e-5)


def test_calibration_takes_each_folds_weights_and_smoothed_targets(spark):
    x, y, df = table(spark)
    cal = svm.calibrate(df, "fold", 3)
    assert len(cal.folds) == 3 and cal.gradient < 1e-9
    p = np.zeros(300)
    for i, (m, s) in enumerate(cal.folds):
        train, held = np.arange(300) % 3 != i, np.arange(300) % 3 == i
        assert m.coef == pytest.approx(plain_svm(x[train], y[train])[:-1], abs=1e-6)
        f, t = x[held] @ m.coef + m.intercept, y[held]
        target = np.where(t == 1, (t.sum() + 1) / (t.sum() + 2), 1 / ((1 - t).sum() + 2))
        q = 1 / (1 + np.exp(s.a * f + s.b))
        assert abs(((target - q) * f).sum()) < 1e-4 and abs((target - q).sum()) < 1e-4 and s.a < 0
        p += 1 / (1 + np.exp(s.a * (x @ m.coef + m.intercept) + s.b)) / 3
    got = {r.id: (r.p, r.pred) for r in cal.predict(df).collect()}
    assert [got[i][0] for i in range(300)] == pytest.approx(p, abs=1e-9) and all(got[i][1] == int(got[i][0] >= 0.5) for i in got)
    mean = {r.Feature: r.coef for r in cal.coefficients(spark, list("abcde")).collect()}
    assert [mean[c] for c in "abcde"] == pytest.approx(np.mean([m.coef for m, _ in cal.folds], axis=0), abs=1e-12)


def test_svm_edges(spark):
    _, _, df = table(spark, 30)
    one = svm.fit(df.where("y = 1"))
    assert (one.coef == 0).all() and svm.fit(df.where("false")).steps == 0
    odd = df.withColumn("y", F.when(F.col("id") > 4, F.col("y"))).withColumn("features", F.when(F.col("id") != 9, F.col("features")).otherwise(F.array(*[F.lit(0.0)] * 5)))
    assert svm.fit(odd).gradient < 1e-9


def test_vector_shift_equals_one_column_each(spark):
    rng = np.random.default_rng(1)
    rows = [(i, m, int(rng.integers(2)), int(rng.integers(2)), rng.normal(size=7).tolist() + [5.0]) for i in range(200) for m in "ab"] + [(0, "c", 1, 1, [1.0] * 8), (0, None, 1, 0, [2.0] * 8), (0, "a", None, 1, [9.0] * 8)]
    df = spark.createDataFrame(rows, "id int, model string, y int, pred int, v array<double>")
    names = [f"f{i}" for i in range(8)]
    wide = df.select("model", "y", "pred", *[F.col("v")[i].alias(n) for i, n in enumerate(names)]).where("y is not null")
    for normalise in (False, True):
        want = {(r.model, r.feature): r for r in C.error_feature_shift(wide, names, normalise=normalise, by="model").collect()}
        got = {(r.model, r.feature): r for r in C.error_vector_shift(df, "v", names, normalise=normalise, by="model").collect()}
        assert got.keys() == want.keys() and len(got) == 16
        for k in want:
            assert [got[k][c] for c in ("effect", "correct_mean", "error_mean")] == pytest.approx([want[k][c] for c in ("effect", "correct_mean", "error_mean")], abs=1e-9)
