import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cirflow.operators import splits as SP
from cirflow.operators.quantiles import from_ordered_bits, group_quantiles, ordered_bits
from cirflow.sources.fixtures import md5_int
from tests.conftest import SF01


def test_group_split_sizes_and_order(spark):
    from cirflow.sources import fixtures as FX
    g = SP.group_split(FX.groups(spark, SF01), "source")
    counts = {r["split"]: r["n"] for r in
              g.select("source", "split").distinct().groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert counts == {"val": 3, "test": 3, "train": 14}
    parts = spark.createDataFrame([(f"part{i}", i) for i in range(1, 8)] * 3, "f string, v int")
    order = ["part4", "part3", "part1", "part2", "part5", "part6", "part7"]
    t = {r["f"]: r["split"] for r in SP.group_table(parts, "f", order=order).collect()}
    assert t["part4"] == "val" and t["part3"] == "test"
    assert sorted(k for k, v in t.items() if v == "train") == ["part1", "part2", "part5", "part6", "part7"]
    with pytest.raises(ValueError):
        SP.split_sizes(2, 0.15, 0.15)


def test_rank_within_is_exact(spark):
    df = spark.range(3000).select(F.col("id"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    got = SP.rank_within(df, ["y"], "id", buckets=7)
    w = Window.partitionBy("y").orderBy(md5_int(42, "id"), "id")
    exp = df.withColumn("rn", (F.row_number().over(w) - 1).cast("bigint"))
    assert got.select("id", "rn").exceptAll(exp.select("id", "rn")).count() == 0
    folds = SP.stratified_kfold(df, "y", "id", 3).groupBy("y", "fold").count().collect()
    for y in (0, 1):
        c = [r["count"] for r in folds if r["y"] == y]
        assert max(c) - min(c) <= 1


def test_group_ranks_need_no_window_over_all_groups(spark):
    from cirflow.sources.fixtures import md5_key
    df = spark.range(500).select((F.col("id") % 240).cast("string").alias("g")).unionByName(
        spark.sql("SELECT CAST(NULL AS STRING) AS g"))
    got = SP.group_table(df, "g")
    exp = df.distinct().withColumn("e", F.row_number().over(Window.orderBy(md5_key(42, "g"), "g")) - 1)
    assert got.join(exp, got["g"].eqNullSafe(exp["g"])).where("pos = e").count() == 241
    assert SP.group_split(df, "g").where("split is null").count() == 0


def test_class_tables_are_broadcast_and_null_classes_stay(spark):
    from cirflow.operators import profile as PR
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), (1, 2.0), (1, 4.0), (1, 6.0), (0, 5.0)], "y int, v double")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for out in (SP.balanced_weight(df, "y"), PR.box_stats(df, "y", "v"), PR.class_histogram(df, "y", "v", 2)):
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        w = {(r["y"], round(r["weight"], 6)) for r in SP.balanced_weight(df, "y").collect()}
        assert w == {(None, 1.0), (1, round(2 / 3, 6)), (0, 2.0)}
        assert {r["y"]: r["median"] for r in PR.box_stats(df, "y", "v").collect()} == {None: 2.0, 1: 4.0, 0: 5.0}
        assert PR.class_histogram(df, "y", "v", 2).where("y is null").agg(F.sum("n")).first()[0] == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_selection_equals_numpy(spark):
    """One hot group, one of few values, one of huge and tiny numbers of either sign, one of a single row, a NULL group."""
    rng = np.random.default_rng(4)
    groups = {"hot": rng.normal(0, 1, 20000).tolist(), "few": rng.integers(0, 3, 999).astype(float).tolist(),
              "wide": (rng.choice([-1.0, 1.0], 501) * 10.0 ** rng.uniform(-300, 300, 501)).tolist() + [float("inf"), float("-inf"), 0.0, -0.0, 5e-324],
              "one": [7.5], None: [1.0, 2.0], "close": (1.0 + np.arange(400) * 2.0 ** -52).tolist()}
    rows = [(g, x) for g, xs in groups.items() for x in xs] + [("hot", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(8)
    probs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {r[0]: tuple(r[1:]) for r in group_quantiles(df, "x", probs, ["g"]).collect()}
    assert got.keys() == groups.keys()
    for g, xs in groups.items():
        xs = sorted(x for x in xs)
        for q, v in zip(probs, got[g], strict=True):
            h = (len(xs) - 1) * q
            a, b = xs[int(np.floor(h))], xs[int(np.ceil(h))]
            assert v == (a if a == b else pytest.approx(a + (b - a) * (h - np.floor(h)), rel=1e-15))
    plain = df.where("g = 'hot'")
    assert group_quantiles(plain, "x", [0.5], names=["m"]).collect() == [(pytest.approx(float(np.median(groups["hot"])), abs=1e-15),)]
    assert group_quantiles(df.where("false"), "x", [0.5], ["g"]).count() == 0 and group_quantiles(df.where("x is null"), "x", [0.5], names=["m"]).collect() == [(None,)]
    nan = spark.createDataFrame([(1.0,), (float("nan"),), (2.0,)], "x double")
    assert group_quantiles(nan, "x", [0.5], names=["m"]).first()["m"] == 2.0


def test_ordered_bits_order_like_the_values():
    x = np.array([float("-inf"), -1e300, -1.0, -5e-324, 0.0, 5e-324, 1.0, 1e300, float("inf"), float("nan")])
    bits = ordered_bits(x)
    assert (np.diff(bits) > 0).all() and ordered_bits(np.array([-0.0]))[0] == bits[4]
    assert np.array_equal(from_ordered_bits(bits), x, equal_nan=True)
