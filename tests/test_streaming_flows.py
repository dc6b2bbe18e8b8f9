import os
import tempfile

from pyspark.sql import functions as F

from cirflow.plans import flows as FL
from cirflow.sources import fixtures as FX
from cirflow.streaming import features as ST
from tests.conftest import SF001


def test_feature_stream_matches_batch(spark):
    meas = FX.measurements(spark, SF001)
    src = tempfile.mkdtemp(prefix="cirflow-stream-src-")
    meas.write.mode("overwrite").parquet(os.path.join(src, "in"))
    stream = ST.read_measurements(spark, os.path.join(src, "in"), meas.schema)
    feats = ST.feature_stream(stream, start=0, length=64, pre=8, post=24, gap=3)
    q = feats.select("id", "PEAK2_IDX", "CIR_energy", "ALN_energy").writeStream.format("memory") \
        .queryName("cirflow_feats").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = spark.table("cirflow_feats")
    batch = ST.feature_stream(meas, start=0, length=64, pre=8, post=24, gap=3).select(
        "id", "PEAK2_IDX", "CIR_energy", "ALN_energy")
    assert got.count() == meas.count()
    assert got.exceptAll(batch).count() == 0


def test_pair_flow_runs(spark):
    meas = FX.measurements(spark, SF001)
    cfg = FL.Config(focus_start=0, focus_len=64, align_pre=8, align_post=24, gap=3,
                    gbt=dict(max_iter=5, max_depth=3))
    cfg.tune_trials, cfg.tune_grid = 2, {"maxDepth": [2, 3], "maxIter": [3, 5]}
    out = FL.pair_classification(spark, meas, cfg)
    assert out["cv_f1"] is not None and 0.0 <= out["cv_f1"] <= 1.0
    assert out["threshold_curve"].count() == 200
    assert {r["feature"] for r in out["error_features"].collect()} <= set(FL.PAIR_SCALARS)
    m = out["metrics"].first()
    assert 0.0 <= m["accuracy"] <= 1.0
    assert out["confusion"].agg(F.sum("n")).first()[0] == out["scored"].count()


def test_class_profile_stream(spark):
    meas = FX.measurements(spark, SF001)
    src = tempfile.mkdtemp(prefix="cirflow-stream-prof-")
    meas.write.mode("overwrite").parquet(os.path.join(src, "in"))
    stream = ST.read_measurements(spark, os.path.join(src, "in"), meas.schema, max_files_per_trigger=1)
    feats = ST.feature_stream(stream, start=0, length=64, pre=8, post=24, gap=3)
    prof = ST.class_profile_stream(feats)
    q = prof.writeStream.format("memory").queryName("cirflow_prof").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    got = {r["NLOS"]: r["n"] for r in spark.table("cirflow_prof").collect()}
    exp = {r["NLOS"]: r["count"] for r in meas.groupBy("NLOS").count().collect()}
    assert got == exp


def test_range_flow_runs(spark):
    meas = FX.measurements(spark, SF001)
    cfg = FL.Config(focus_start=0, focus_len=64, align_pre=8, align_post=24, gap=3,
                    reg=dict(max_iter=5, max_depth=3, step=0.1), reg_cv=True)
    out = FL.range_estimation(spark, meas, cfg)
    assert out["cv"].count() == 2 and out["importance_p1"].count() == len(FL.REG_SCALARS) + 32
    m = {r["path"]: r for r in out["metrics"].collect()}
    assert set(m) == {"path1", "path2"} and all(r["rmse"] >= 0 for r in m.values())
    c = out["clipped"].first()
    assert c["rmse_clipped"] is not None and c["n_violations"] >= 0


def test_csv_parts_scan_by_name_with_tag(spark):
    import pytest
    from cirflow.sources import scans as SC
    meas = FX.measurements(spark, SF001)
    wide = SC.unpack_waveform(meas.drop("__source_file"), "cir", "CIR", 64)
    base = tempfile.mkdtemp(prefix="cirflow-csv-")
    rev = list(reversed(wide.columns))          # a layout other than the schema's order
    wide.where("id % 2 = 0").select(*rev).coalesce(1).write.option("header", True).csv(os.path.join(base, "p1"))
    wide.where("id % 2 = 1").select(*rev).coalesce(1).write.option("header", True).csv(os.path.join(base, "p2"))
    got = SC.scan_parts_tagged(spark, [os.path.join(base, "p1"), os.path.join(base, "p2")], n_samples=64)
    assert got.count() == meas.count()
    assert got.select("__source_file").distinct().count() == 2
    exp = meas.select("NLOS", "RANGE", "FP_IDX", "cir")
    assert got.select("NLOS", "RANGE", "FP_IDX", "cir").exceptAll(exp).count() == 0
    # a part whose header order differs from the others is refused, not misread
    wide.select(*wide.columns).coalesce(1).write.option("header", True).csv(os.path.join(base, "p3"))
    bad = SC.scan_parts(spark, [os.path.join(base, "p1"), os.path.join(base, "p3")], n_samples=64)
    with pytest.raises(Exception):
        bad.select("NLOS", "cir").collect()


def test_single_path_flow_runs(spark):
    meas = FX.measurements(spark, SF001)
    cfg = FL.Config(focus_start=0, focus_len=64, align_pre=8, align_post=24, gap=3, boosted=dict(n_estimators=60), forest=dict(n_estimators=20), patience=5)
    out = FL.single_path_models(spark, meas, cfg)
    models = {r["model"] for r in out["comparison"].collect()}
    assert models == {"random_forest", "logistic", "boosted", "svm_platt"}
    width = len(FL.BASE_SCALARS) + 64
    assert out["importance"].count() == width and out["coefficients"].count() == width and out["best_round"] < 60
    assert out["scored"].where("p between 0 and 1").count() == out["scored"].count() > 0
    # at the reference's window: 16 core, 12 engineered and 120 window columns
    assert len(FL.BASE_SCALARS) + FL.Config().focus_len == 148


def test_stream_to_table_available_now(spark):
    from cirflow.session import scratch_path
    meas = FX.measurements(spark, SF001)
    src = scratch_path(spark, "stream-src")
    meas.write.parquet(src)
    feats = ST.feature_stream(ST.read_measurements(spark, src, meas.schema), start=0, length=64,
                              pre=8, post=24, gap=3).select("id", "PEAK2_IDX", "CIR_energy")
    out, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    q = ST.start_to_table(feats, out, ckpt, trigger_once=True)
    q.awaitTermination(300)
    assert spark.read.parquet(out).count() == meas.count()
