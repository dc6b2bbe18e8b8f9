"""Forests against exhaustive Gini and variance trees, jobs against one task each, rules, nearest neighbours with pivots."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cirflow.operators import boosting as B
from cirflow.operators import forest as R
from cirflow.operators import knn, models


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(150, 5)), 1)
    y = (x[:, 0] * x[:, 1] + 0.5 * x[:, 2] + rng.normal(0, 0.3, 150) > 0.1).astype(int)
    target = x[:, 0] * 2 + x[:, 3] ** 2 + rng.normal(0, 0.1, 150)
    df = spark.createDataFrame([(i, x[i].tolist(), int(y[i]), float(target[i])) for i in range(150)], "id long, features array<double>, y int, target double").repartition(4)
    hashes = {r.id: r.h for r in df.select("id", F.xxhash64("id").alias("h")).collect()}
    return x, y, target, df, np.array([hashes[i] for i in range(150)], np.int64)


def plain(x, y, w, impurity, p, tree=0, path=1, depth=0):
    """Leaf value, or (feature, rows left, children), by trying every cut and comparing impurities."""
    mean = (w * y).sum() / w.sum()
    if len(set(y)) == 1 or len(y) < p.min_samples_split or (p.max_depth is not None and depth >= p.max_depth):
        return mean
    best = None
    for f in R.features_of(tree, path, x.shape[1], p).tolist():
        for t in np.unique(x[:, f])[1:]:
            left = x[:, f] < t
            if min(left.sum(), (~left).sum()) < p.min_samples_leaf:
                continue
            drop = w.sum() * impurity(y, w) - sum(w[s].sum() * impurity(y[s], w[s]) for s in (left, ~left))
            if best is None or drop > best[0] * (1 + 1e-7):
                best = drop, f, left
    if best is None or best[0] <= 1e-8 * w.sum():
        return mean
    _, f, left = best
    return f, left, [plain(x[s], y[s], w[s], impurity, p, tree, (2 * path + i) & ((1 << 63) - 1), depth + 1) for i, s in enumerate((left, ~left))]


def outputs(node, n):
    if not isinstance(node, tuple):
        return np.full(n, node)
    out = np.empty(n)
    for s, child in zip((node[1], ~node[1]), node[2]):
        out[s] = outputs(child, int(s.sum()))
    return out


def gini(y, w):
    q = (w * y).sum() / w.sum()
    return 1 - q * q - (1 - q) ** 2


def variance(y, w):
    m = (w * y).sum() / w.sum()
    return (w * (y - m) ** 2).sum() / w.sum()


@pytest.mark.parametrize("finish", [20_000, 30])
@pytest.mark.parametrize("settings,regression", [(dict(max_features=1.0), False), (dict(max_features="sqrt", class_weight="balanced_subsample", min_samples_leaf=2), False),
                                                 (dict(max_features=0.6, class_weight="balanced", max_depth=4), False), (dict(max_features=1.0, min_samples_split=9), True)])
def test_trees_equal_exhaustive_search(data, settings, regression, finish):
    x, y, target, df, hashes = data
    p = R.Params(n_estimators=3, **settings)
    m = R.fit(df, p, label="target" if regression else "y", regression=regression, finish_rows=finish)
    truth = target if regression else y.astype(float)
    bins = B.to_bins(x, m.cuts)
    for t in range(3):
        w = R.draws(hashes, t, p)
        if p.class_weight == "balanced":
            w = w * np.array([150 / (2 * (y == 0).sum()), 150 / (2 * (y == 1).sum())])[y]
        elif p.class_weight:
            n = np.array([w[y == 0].sum(), w[y == 1].sum()])
            w = w * (n.sum() / (2 * n))[y]
        some = w > 0
        want = outputs(plain(x[some], truth[some], w[some], variance if regression else gini, p, t), int(some.sum()))
        assert m.trees[t].output(bins)[some] == pytest.approx(want, abs=1e-9)
    assert m.importance().sum() == pytest.approx(1.0)


def test_draws_are_a_bootstrap_and_trees_differ(data):
    rows = np.arange(50_000, dtype=np.int64)
    p = R.Params()
    c = R.draws(rows, 3, p)
    assert [abs((c == k).mean() - math.exp(-1) / math.factorial(k)) < 0.01 for k in range(4)] == [True] * 4
    assert abs(np.corrcoef(c, R.draws(rows, 4, p))[0, 1]) < 0.02


def test_full_forest_predicts_and_repeats(data):
    x, y, _, df, _ = data
    a, b = (R.fit(df, R.Params(n_estimators=200)) for _ in range(2))
    pa_, pb = ({r.id: (r.p, r.pred) for r in m.predict(df).collect()} for m in (a, b))
    assert pa_ == pb and len(a.trees) == 200
    bins = B.to_bins(x, a.cuts)
    want = np.mean([t.output(bins) for t in a.trees], axis=0)
    assert [pa_[i][0] for i in range(150)] == pytest.approx(want, abs=1e-12)
    assert np.mean([(pa_[i][1] == y[i]) for i in range(150)]) > 0.97      # trees without a limit


def test_forest_edges(data, spark):
    _, _, _, df, _ = data
    assert R.fit(df.where("false"), R.Params(n_estimators=2)).trees == []
    one = R.fit(df.withColumn("y", F.lit(1)), R.Params(n_estimators=2))
    assert all(t.feature == [-1] and t.value == [1.0] for t in one.trees)


def test_rules_as_filters_give_the_models_predictions(spark, data):
    _, _, _, df, _ = data
    names = [f"f {i}" for i in range(5)]
    wide = df.select("id", "y", *[F.col("features")[i].alias(n) for i, n in enumerate(names)])
    train = models.assemble(wide, names)
    for depth in (0, 4):
        m = models.decision_tree(depth).setFeaturesCol("features").setLabelCol("y").fit(train)
        rules = models.tree_rules(m, names, spark).collect()
        want = {r.id: int(r.prediction) for r in m.transform(train).collect()}
        got = {}
        for r in rules:
            ids = [x.id for x in wide.where(r["condition"]).select("id").collect()]
            assert len(ids) == r["support"] and not got.keys() & set(ids)
            share = [x.y for x in wide.where(F.col("id").isin(ids)).collect()]
            q = sum(share) / len(share)
            assert r["gini"] == pytest.approx(2 * q * (1 - q)) and len(r["conditions"]) <= depth
            got |= dict.fromkeys(ids, r["class"])
        assert got == want and (depth == 0) == (len(rules) == 1)


def test_pivots_skip_pairs_of_blocks_and_lose_no_neighbour(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(0, 50, (12, 4))
    x = centres[np.arange(900) % 12] + rng.normal(0, 1, (900, 4))
    x[600:640] = x[0]                                        # equal rows
    df = spark.createDataFrame([(i, x[i].tolist(), float(i % 7)) for i in range(900)], "id long, w array<double>, target double").repartition(6)
    train, query = df.where("id % 5 != 0"), df.where("id % 5 = 0")
    visited = []
    got = {}
    for r in knn.knn_candidates(train, query, 7, block_rows=30, visited=visited).collect():
        got.setdefault(r.qid, []).append((r.d2, r.tid))
    t = np.array([i for i in range(900) if i % 5])
    for q in range(0, 900, 5):
        d2 = ((x[t] - x[q]) ** 2).sum(1)
        order = np.lexsort((t, d2))[:7]
        assert sorted(got[q]) == [(pytest.approx(d2[o], abs=1e-9), t[o]) for o in order]
    assert visited[0] < visited[1] / 3
    few = knn.knn_candidates(train.limit(3), query.where("id < 10"), 7, block_rows=30)
    assert few.count() == 6
    assert knn.knn_candidates(train.where("false"), query, 7).count() == 0 and knn.knn_candidates(train, query.where("false"), 7).count() == 0
