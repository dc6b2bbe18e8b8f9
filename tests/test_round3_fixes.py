"""What the review of round 3 found: wide broadcasts, serial growth of trees, one small job after another."""
import numpy as np
import pytest

from cirflow.plans import catalog as K
from tests.conftest import SF001


@pytest.mark.parametrize("name", ["error_feature_shift", "error_feature_effect", "topk_error_features"])
def test_event_vectors_are_not_broadcast(spark, name):
    plan = K.REGISTRY[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_forest_trees_stay_in_the_table(spark):
    """The driver holds the upper nodes only; rows meet the pieces of every tree, also where a subtree fills several."""
    from cirflow.operators import boosting as B
    from cirflow.operators import forest as R
    rng = np.random.default_rng(2)
    x, noise = rng.normal(size=(900, 3)), rng.normal(size=900)
    df = spark.createDataFrame([(i, x[i].tolist(), float(x[i, 0] + noise[i])) for i in range(900)], "id long, features array<double>, y double").repartition(3)
    for finish in (20_000, 300):
        m = R.fit(df, R.Params(n_estimators=4, max_features=1.0), regression=True, finish_rows=finish)
        assert max(len(t.feature) for t in m.trees.heads) < 20 and m.trees.table.where("part > 1").count() > 0
        trees = list(m.trees)
        assert all(len(t.feature) > 600 for t in trees) and m.trees[-1].feature == trees[3].feature
        got = {r.id: r.p for r in m.predict(df).collect()}
        want = np.mean([t.output(B.to_bins(x, m.cuts)) for t in trees], axis=0)
        assert [got[i] for i in range(900)] == pytest.approx(want, abs=1e-12)


def test_cuts_of_many_nodes_equal_one_at_a_time():
    from cirflow.operators import boosting as B
    rng = np.random.default_rng(4)
    bins = rng.integers(1, 9, (3000, 6)).astype(np.uint8)
    bins[rng.random(bins.shape) < 0.0005] = 0                # a few missing values
    g, h = rng.integers(-9, 9, 3000).astype(float), rng.integers(1, 4, 3000).astype(float)
    start = np.array([0, 2, 5, 9, 17, 40, 300, 302, 900, 1412, 3000])
    rows = rng.permutation(3000)
    for columns, p, least in ((np.tile(np.arange(6), (10, 1)), B.Params(), 1), (np.sort(rng.permuted(np.tile(np.arange(6), (10, 1)), axis=1)[:, :3]), B.Params(reg_alpha=0.5, min_child_weight=0.0), 2)):
        got = B.node_cuts(bins, g, h, rows, start, columns, p, least)
        for i in range(10):
            r = rows[start[i]:start[i + 1]]
            want = B.node_cut(bins[r], g[r], h[r], columns[i], p, least)
            assert got[0][i] == want[0] and (want[0] == -np.inf or tuple(x[i] for x in got[1:]) == want[1:])


def test_boosting_takes_few_jobs_where_a_task_holds_the_sample(spark, monkeypatch):
    from pyspark.sql import functions as F

    from cirflow.operators import boosting as B
    calls = []
    for name in ("_level", "_finish"):
        def counted(self, *a, _f=getattr(B._Fit, name), _name=name):
            calls.append(_name)
            return _f(self, *a)
        monkeypatch.setattr(B._Fit, name, counted)
    df = spark.range(30_000).select("id", F.array(F.rand(1), F.rand(2)).alias("features")).withColumn("y", (F.col("features")[0] > 0.4).cast("int"))
    few = B.fit(df, B.Params(n_estimators=10, max_depth=3))
    assert calls == ["_finish"] and len(few.trees) == 10
    many = B.fit(df, B.Params(n_estimators=2, max_depth=3), finish_rows=12_000)
    assert "_level" in calls and [t.feature for t in many.trees] == [t.feature for t in few.trees[:2]] and [t.cut for t in many.trees] == [t.cut for t in few.trees[:2]]


def test_nearest_rows_by_products_equal_all_differences():
    """Equal rows, ties and points far from the origin, where the products alone lose every digit."""
    from cirflow.operators import knn
    rng = np.random.default_rng(7)
    for shift, x in ((0.0, rng.integers(0, 4, (400, 5)).astype(float)), (1e7, rng.normal(size=(400, 8))), (0.0, np.zeros((60, 3))), (1e-9, rng.normal(size=(300, 64)) * 1e-6), (3.0, rng.normal(size=(40, 64)))):
        x = x + shift
        points, q = x[::2], x[1::2]
        columns, d2 = knn._nearest_rows(q, points, 15)
        want = ((q[:, None] - points[None]) ** 2).sum(2)
        order = np.argsort(want, axis=1, kind="stable")[:, :15]
        assert (columns == order).all() and (d2 == np.take_along_axis(want, order, 1)).all()


def test_decode_of_many_rows_at_once():
    """Null and empty ids, bytes that are no UTF-8, and more rows than are decoded together."""
    import pyarrow as pa

    from cirflow.llm import bpe
    v = type("V", (), {"bytes": [b"a", b"\xc3", b"\xa9", b" b", b""]})()
    v.bytes_array, v.lengths = pa.array(v.bytes, pa.binary()), np.array([len(b) for b in v.bytes])
    shared = type("S", (), {"value": "test-vocabulary"})
    kept = dict(bpe._LOADED)
    bpe._LOADED["test-vocabulary"] = v
    try:
        ids = [None, [], [1, 2], [1], [0, 3, 4], [2, 1]] * (bpe.DECODE_ROWS // 2)
        batch = pa.RecordBatch.from_arrays([pa.array([None if x is None else np.array(x, "<u4").tobytes() for x in ids], pa.binary())], names=["ids"])
        got = next(iter(bpe._decode_batches(shared, "ids", "out")(iter([batch])))).column(1).to_pylist()
    finally:
        bpe._LOADED.clear()
        bpe._LOADED.update(kept)
    assert got == [None if x is None else b"".join(v.bytes[i] for i in x).decode("utf-8", "replace") for x in ids]
