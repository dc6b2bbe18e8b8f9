"""Histogram boosting: one tree against exhaustive search, jobs against one task, patience against a loop."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from cirflow.operators import boosting as B


def plain_tree(x, g, h, p, depth, cuts):
    """Nested (feature, threshold, missing_left, gain, left, right) or a leaf's value, by trying every cut."""
    shrink = lambda s: np.sign(s) * max(abs(s) - p.reg_alpha, 0.0)
    score = lambda s, t: shrink(s) ** 2 / (t + p.reg_lambda)
    leaf = -p.learning_rate * shrink(g.sum()) / (h.sum() + p.reg_lambda)
    best = (B.LEAST_GAIN,)
    if depth:
        for f in range(x.shape[1]):
            for missing_left in (False, True):
                for t in cuts[f]:
                    left = np.where(np.isnan(x[:, f]), missing_left, x[:, f] < t)
                    if missing_left and not np.isnan(x[:, f]).any() or left.all() or not left.any():
                        continue
                    if min(h[left].sum(), h[~left].sum()) < p.min_child_weight:
                        continue
                    gain = score(g[left].sum(), h[left].sum()) + score(g[~left].sum(), h[~left].sum()) - score(g.sum(), h.sum())
                    gain = float(np.float32(gain))
                    if gain > best[0]:
                        best = gain, f, t, missing_left, left
    if len(best) == 1:
        return leaf
    gain, f, t, missing_left, left = best
    ends = [plain_tree(x[s], g[s], h[s], p, depth - 1, cuts) for s in (left, ~left)]
    if gain < p.gamma and not any(isinstance(e, tuple) for e in ends):
        return leaf
    return f, t, missing_left, gain, *ends


def nested(tree, m, at=0):
    f = tree.feature[at]
    if f < 0:
        return tree.value[at]
    return f, m.threshold(f, tree.cut[at]), tree.missing_left[at], tree.gain[at], nested(tree, m, tree.left[at]), nested(tree, m, tree.right[at])


def same(a, b):
    if isinstance(a, tuple) != isinstance(b, tuple):
        return False
    if not isinstance(a, tuple):
        return a == pytest.approx(b, abs=1e-9)
    return a[0] == b[0] and a[1] == b[1] and (a[2] == b[2]) and a[3] == pytest.approx(b[3], rel=1e-6, abs=1e-6) and same(a[4], b[4]) and same(a[5], b[5])


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(240, 4)), 2)
    x[rng.random(x.shape) < 0.08] = np.nan
    y = (np.nan_to_num(x[:, 0], nan=1.0) + 0.5 * np.nan_to_num(x[:, 1]) ** 2 + rng.normal(0, 0.4, 240) > 0.4).astype(int)
    rows = [(i, [None if np.isnan(v) else float(v) for v in x[i]], int(y[i]), float(x[i][0] if x[i][0] == x[i][0] else 9) * 3 + float(y[i])) for i in range(240)]
    return x, y, spark.createDataFrame(rows, "id long, features array<double>, y int, target double").repartition(5)


PLAIN = dict(subsample=1.0, colsample_bytree=1.0)


@pytest.mark.parametrize("settings", [dict(), dict(gamma=3.0, reg_alpha=0.7, reg_lambda=2.0), dict(min_child_weight=6.0, scale_pos_weight=2.5)])
@pytest.mark.parametrize("finish", [0, 60, 20_000])
def test_first_tree_equals_exhaustive_search(data, settings, finish):
    x, y, df = data
    p = B.Params(n_estimators=1, max_depth=4, **PLAIN, **settings)
    m = B.fit(df, p, finish_rows=finish)
    w = np.where(y == 1, p.scale_pos_weight, 1.0)
    want = plain_tree(x, w * (0.5 - y), w * 0.25, p, 4, [[*np.unique(c[~np.isnan(c)])[1:], np.inf] for c in x.T])
    assert same(nested(m.trees[0], m), want)


def test_distributed_levels_equal_one_task(data):
    _, _, df = data
    for p, label in ((B.Params(n_estimators=4, max_depth=3, gamma=0.1), "y"), (B.Params(n_estimators=4, max_depth=4, objective="squared", min_child_weight=5, subsample=0.6), "target")):
        one, many, some = (B.fit(df, p, label=label, finish_rows=n) for n in (20_000, 0, 50))
        for a, b, c in zip(one.trees, many.trees, some.trees, strict=True):
            assert same(nested(a, one), nested(b, many)) and same(nested(a, one), nested(c, some))
        assert len(one.trees) == 4 and any(f >= 0 for t in one.trees for f in t.feature)


def test_columns_and_rows_are_sampled_by_tree():
    p = B.Params(subsample=0.3, colsample_bytree=0.5)
    rows = np.arange(40000, dtype=np.int64)
    a, b = B.sampled(rows, 1, p), B.sampled(rows, 2, p)
    assert abs(a.mean() - 0.3) < 0.01 and abs((a & b).mean() - 0.09) < 0.01
    assert len(B.columns_of(0, 10, p)) == 5 and not np.array_equal(B.columns_of(0, 100, p), B.columns_of(1, 100, p))


def margins_of(m, x):
    bins = B.to_bins(x, m.cuts)
    out = [np.full(len(x), m.base)]
    for t in m.trees:
        out.append(out[-1] + t.output(bins))
    return np.array(out[1:])


def test_patience_equals_a_loop(data):
    x, y, df = data
    p = B.Params(n_estimators=120, max_depth=3, learning_rate=0.4)
    valid = F.col("id") % 3 == 0
    full = B.fit(df, p, valid=valid)
    val = np.arange(240) % 3 == 0
    losses = [np.logaddexp(0, np.where(y[val] > 0, -m[val], m[val])).mean() for m in margins_of(full, x)]
    assert full.losses == pytest.approx(losses, abs=1e-12) and len(losses) == 120
    for patience in (1, 7, 30):
        best, stop = 0, None
        for i, v in enumerate(losses):
            if v < losses[best]:
                best = i
            elif i - best == patience:
                stop = i
                break
        assert stop is not None
        m = B.fit(df, p, valid=valid, patience=patience)
        assert (m.best_round, m.last_round, len(m.trees)) == (best, stop, best + 1)
        assert m.losses == pytest.approx(losses[:stop + 1], abs=1e-12) and m.last_round - m.best_round == patience
    assert B.stopped([3.0, 2.0, 2.5], 30) is None
    with pytest.raises(ValueError):
        B.fit(df, p, patience=3)


def test_predictions_thresholds_and_importance(data, spark):
    x, y, df = data
    m = B.fit(df, B.Params(n_estimators=20, max_depth=3))
    got = {r.id: (r.p, r.pred) for r in m.predict(df).collect()}
    p = 1 / (1 + np.exp(-margins_of(m, x)[-1]))
    assert all(got[i] == (pytest.approx(p[i], abs=1e-12), int(p[i] >= 0.5)) for i in range(240))
    assert ((p >= 0.5) == y).mean() > 0.9
    imp = m.importance()
    assert imp.sum() == pytest.approx(1) and imp.argmax() in (0, 1)
    # the node table gives the same margins by its thresholds
    nodes = {(r.tree, r.node): r for r in m.nodes(spark).collect()}
    for i in range(0, 240, 17):
        total = 0.0
        for t in range(20):
            r = nodes[t, 0]
            while r.feature >= 0:
                v = x[i, r.feature]
                r = nodes[t, r.left if (r.missing_left if np.isnan(v) else v < r.threshold) else r.right]
            total += r.value
        assert 1 / (1 + np.exp(-total)) == pytest.approx(p[i], abs=1e-12)


def test_edges(spark, data):
    _, _, df = data
    none = B.fit(df.where("false"), B.Params(n_estimators=3))
    assert none.trees == [] and none.predict(df.limit(3)).count() == 3
    one = B.fit(df.withColumn("features", F.array(F.lit(None).cast("double"))), B.Params(n_estimators=3, objective="squared"), label="target")
    assert all(t.feature == [-1] for t in one.trees)
    odd = df.withColumn("y", F.when(F.col("id") > 5, F.col("y"))).withColumn("margin", F.lit(1)).withColumn("row", F.lit("a"))
    m = B.fit(odd, B.Params(n_estimators=3, max_depth=2), valid=F.col("id") == 77777)
    assert len(m.trees) == 3 and m.losses == [0.0] * 3
    assert m.predict(odd, keep=("id", "row")).columns == ["id", "row", "p", "pred"]
