"""What the review of round 4 found: a registered fit of a twentieth of the reference's trees."""
import numpy as np

from cirflow.operators import boosting as B
from cirflow.plans import catalog as K
from tests.conftest import SF01


def test_registered_regressor_grows_all_trees(spark, monkeypatch):
    made = []

    def kept(*a, _fit=B.fit, **k):
        made.append(_fit(*a, **k))
        return made[-1]

    monkeypatch.setattr(B, "fit", kept)
    rows = K.REGISTRY["train_boosted_regressor"](spark, SF01).collect()
    (m,) = made
    assert m.params == B.RANGE_REGRESSOR and len(m.trees) == m.params.n_estimators == 1200
    assert all(t.feature[0] >= 0 for t in m.trees)
    assert rows and all(r.p_finite and r.above_floor and r.all_trees for r in rows)


def test_cuts_with_unit_hessians_equal_one_node_at_a_time():
    rng = np.random.default_rng(5)
    bins = rng.integers(1, 256, (3000, 5)).astype(np.uint8)
    bins[2990:, 2] = 0                                       # missing values in the last node only
    g, rows, columns = rng.integers(-9, 9, 3000).astype(float), np.arange(3000), np.tile(np.arange(5), (8, 1))
    start = np.array([0, 3, 20, 150, 400, 700, 1300, 2500, 3000])
    for p in (B.Params(min_child_weight=5.0, reg_lambda=2.0), B.Params(reg_alpha=0.5, min_child_weight=0.0)):
        for h in (np.ones(3000), rng.integers(1, 4, 3000).astype(float)):
            got = B.node_cuts(bins, g, h, rows, start, columns, p)
            for i in range(8):
                r = rows[start[i]:start[i + 1]]
                want = B.node_cut(bins[r], g[r], h[r], columns[i], p)
                assert got[0][i] == want[0] and (want[0] == -np.inf or tuple(x[i] for x in got[1:]) == want[1:])


def test_many_whole_trees_take_few_jobs(spark, monkeypatch):
    """The trees do not depend on how many a job grows."""
    asked = []

    def counted(self, small, tree, most, _f=B._Fit._finish):
        asked.append(most)
        return _f(self, small, tree, most)

    monkeypatch.setattr(B._Fit, "_finish", counted)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(120, 3))
    df = spark.createDataFrame([(i, x[i].tolist(), float(x[i, 0] + x[i, 1] ** 2)) for i in range(120)], "id long, features array<double>, y double").repartition(2)
    p = B.Params(n_estimators=130, max_depth=3, objective="squared")
    many = B.fit(df, p)
    assert asked == [100, 30]
    monkeypatch.setattr(B, "ROUNDS_A_TASK", 65)
    few = B.fit(df, p)
    assert asked == [100, 30, 65, 65]
    assert [(t.feature, t.cut) for t in many.trees] == [(t.feature, t.cut) for t in few.trees] and len(few.trees) == 130
