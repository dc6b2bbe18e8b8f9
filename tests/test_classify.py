import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cirflow.operators import classify as C


def test_golden_confusion_to_metrics(spark):
    # saved reference confusion matrix: TN 2856, FP 152, FN 250, TP 2682
    rows = [(0, 0)] * 2856 + [(0, 1)] * 152 + [(1, 0)] * 250 + [(1, 1)] * 2682
    df = spark.createDataFrame(rows, "y int, pred int")
    m = C.binary_metrics(df).first()
    assert m["accuracy"] == pytest.approx(0.9323232323, abs=1e-10)
    assert m["precision"] == pytest.approx(0.9463655610, abs=1e-10)
    assert m["recall"] == pytest.approx(0.9147339700, abs=1e-10)
    assert m["f1"] == pytest.approx(0.9302809573, abs=1e-10)
    e = C.error_partition(df).first()
    assert (e["n"], e["n_correct"], e["n_wrong"]) == (5940, 5538, 402)
    rep = {r["label"]: r for r in C.classification_report(df).collect()}
    assert rep["0"]["support"] == 3008 and rep["1"]["support"] == 2932


def _scored(n, seed, ties=True):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        y = rnd.randint(0, 1)
        p = round(min(1.0, max(0.0, rnd.gauss(0.4 + 0.2 * y, 0.2))), 1 if ties else 6)
        out.append((i, y, p, "a" if i % 2 else "b"))
    return out


def _auc_brute(rows):
    pos = [p for _, y, p, _ in rows if y == 1]
    neg = [p for _, y, p, _ in rows if y == 0]
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    return s / (len(pos) * len(neg))


@pytest.fixture
def ranges(spark, request):
    """So many ranges, none put together for being small."""
    keys = {"spark.sql.shuffle.partitions": str(request.param), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield request.param
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("ranges", [1, 3, 16], indirect=True)
def test_auc_and_roc_against_brute_force(spark, ranges):
    rows = _scored(400, 3)
    df = spark.createDataFrame(rows, "id int, y int, p double, model string")
    cum = C.score_cumulative(df, "model")
    got = {r["model"]: r["auc"] for r in
           cum.groupBy("model").agg((F.sum(F.col("neg") * (F.col("pos_above") + F.col("pos") / 2.0))
                                     / (F.first("tot_pos") * F.first("tot_neg"))).alias("auc")).collect()}
    for m in ("a", "b"):
        assert got[m] == pytest.approx(_auc_brute([r for r in rows if r[3] == m]), abs=1e-12)
    # the curve ends at (1, 1), starts at (0, 0) and its trapezoid area is the AUC
    curve = C.roc_curve(df, "model")
    tz = {r["model"]: r["auc"] for r in C.auc_trapezoid(curve, "model").collect()}
    for m in ("a", "b"):
        assert tz[m] == pytest.approx(got[m], abs=1e-12)


def test_threshold_tune_matches_loop(spark):
    rows = _scored(500, 5)
    df = spark.createDataFrame(rows, "id int, y int, p double, model string").where("model = 'a'")
    got = C.threshold_tune(df).first()
    ys = np.array([r[1] for r in rows if r[3] == "a"])
    ps = np.array([r[2] for r in rows if r[3] == "a"])
    best = (-1.0, -1.0, None)
    for t in np.arange(0.10, 0.91, 0.01):
        pred = (ps >= t).astype(int)
        tp = int(((pred == 1) & (ys == 1)).sum()); fp = int(((pred == 1) & (ys == 0)).sum())
        fn = int(((pred == 0) & (ys == 1)).sum())
        f1 = 2 * tp / (2 * tp + fp + fn) if tp + fp + fn else 0.0
        rec = tp / (tp + fn) if tp + fn else 0.0
        if f1 > best[0] or (f1 == best[0] and rec > best[1]):
            best = (f1, rec, t)
    assert got["threshold"] == best[2] and got["f1"] == pytest.approx(best[0], abs=1e-12)


def test_error_rate_bins_excludes_one(spark):
    df = spark.createDataFrame([(1, 1.0, 1), (0, 0.3, 0), (1, 0.95, 0)], "y int, p double, pred int")
    bins = {r["label"]: r for r in C.error_rate_bins(df).collect()}
    assert set(bins) == {"0.2-0.3", "0.9-1.0"}     # 0.3 < 0.30000000000000004 (linspace edge)
    assert bins["0.9-1.0"]["error_rate"] == 1.0


@pytest.mark.parametrize("ranges", [16], indirect=True)
def test_concentrated_scores_spread_over_ranges(spark, ranges):
    """Scores inside one part in a million, of one model: no range holds more than its share."""
    rng = random.Random(9)
    rows = [(i, rng.randint(0, 1), 0.7 + rng.random() * 1e-7, "a") for i in range(8000)]
    df = spark.createDataFrame(rows, "id int, y int, p double, model string")
    sizes = [r["count"] for r in C.ranged(df.select("model", "p").distinct(), F.col("model"), F.desc("p")).groupBy("_part").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 8000 / 16
    got = {r["model"]: r["auc"] for r in C.roc_auc(df, "model").collect()}
    order = sorted(rows, key=lambda r: r[2])
    ranks = sum(i + 1 for i, r in enumerate(order) if r[1] == 1)
    pos = sum(r[1] for r in rows)
    assert got == {"a": pytest.approx((ranks - pos * (pos + 1) / 2) / (pos * (8000 - pos)), abs=1e-12)}
    both = C.curve_and_auc(df, "model")
    assert {r["auc"] for r in both.select("auc").distinct().collect()} == set(got.values())
    assert both.count() == C.roc_curve(df, "model").count()
