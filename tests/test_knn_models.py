import numpy as np
import pytest
from pyspark.sql import functions as F

from cirflow.operators.knn import knn_regress
from tests.conftest import SF001, SF01


def test_knn_matches_brute_force(spark):
    rng = np.random.default_rng(0)
    n, dim = 300, 5
    X = rng.integers(0, 4, (n, dim)).astype(float)          # many exact ties and hits
    y = rng.normal(size=n)
    rows = [(i, X[i].tolist(), float(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, w array<double>, target double")
    train, query = df.where("id % 4 != 0"), df.where("id % 4 = 0")
    got = {r["id"]: r["pred"] for r in knn_regress(train, query, 7, block_rows=50).collect()}
    tr = [i for i in range(n) if i % 4]
    for q in range(0, n, 4):
        d2 = ((X[tr] - X[q]) ** 2).sum(axis=1)
        order = sorted(range(len(tr)), key=lambda j: (d2[j], tr[j]))[:7]
        d = np.sqrt(d2[order]); t = y[[tr[j] for j in order]]
        exp = t[d == 0].mean() if (d == 0).any() else (t / d).sum() / (1 / d).sum()
        assert got[q] == pytest.approx(exp, abs=1e-9)


def test_facts_hold_and_repeat(spark):
    from cirflow.plans import catalog as K
    a = K.REGISTRY["train_decision_tree"](spark, SF01)
    b = K.REGISTRY["train_decision_tree"](spark, SF01)
    rows = a.collect()
    assert rows and all(all(v for k, v in r.asDict().items() if k not in ("id", "y")) for r in rows)
    assert a.exceptAll(b).count() == 0


def test_scaler_population_std(spark):
    from cirflow.operators.models import PopulationScaler
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (6.0, 5.0)], "a double, c double")
    s = PopulationScaler(["a", "c"]).fit(df)
    assert s.params["a"][1] == pytest.approx(np.std([1, 2, 3, 6]))
    out = s.transform(df).agg(F.stddev_pop("a"), F.max("c")).first()
    assert out[0] == pytest.approx(1.0) and out[1] == 0.0


def test_kfold_regression_knn_takes_every_feature(spark):
    from cirflow.plans import catalog as C

    train, _ = C._train_test(spark, SF001)
    rows = C.SP.kfold(train.drop("fold"), "id", 5, seed=7, out="cv_fold").select("id", "features", "target", "cv_fold").collect()
    x, t, fold = np.array([r.features.toArray() for r in rows]), np.array([r.target for r in rows]), np.array([r.cv_fold for r in rows])
    rmse = []
    for f in range(5):
        a, b = fold != f, fold == f
        z = (x - x[a].mean(0)) / x[a].std(0)
        d = np.sqrt(((z[b][:, None] - z[a][None]) ** 2).sum(2))
        near = np.argsort(d, axis=1, kind="stable")[:, :15]
        w = 1 / np.take_along_axis(d, near, 1)
        rmse.append(np.sqrt((((w * t[a][near]).sum(1) / w.sum(1) - t[b]) ** 2).mean()))
    got = C.kfold_summary(spark, SF001).where("model = 'knn'").first().asDict()
    assert any(isinstance(v, float) and abs(v - np.mean(rmse)) < 1e-4 for v in got.values()), (got, rmse)
