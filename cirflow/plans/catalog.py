"""Registered queries: one per operator of SURVEY section 2.

Each query takes (spark, sf_dir) and returns a DataFrame computed from the
driver tables (via the views in ``cirflow.sources.fixtures``); the DuckDB
statement that must give the same rows is in ``cirflow.plans.oracle``.
Output columns that carry order-dependent floating sums are rounded the
same way on both sides (``rnd``).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cirflow.functions import scalars as S
from cirflow.functions import waves as W
from cirflow.operators import classify as C
from cirflow.operators import features as FE
from cirflow.operators import profile as PR
from cirflow.operators import rank as RK
from cirflow.operators import regress as RG
from cirflow.operators import splits as SP
from cirflow.session import scratch_path, stored
from cirflow.sources import fixtures as FX
from cirflow.sources import scans as SC

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# Parameters of the peak tests on the coarse user waves (FIXTURES.md D).
FLAT = dict(start=0, length=120, gap=5, height=3.0, min_prominence=4.0)
FLAT_STRICT = dict(FLAT, min_prominence=20.0)


def q(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def rnd(df: DataFrame, cols, digits: int = 6) -> DataFrame:
    """Round the given columns (and map -0.0 to 0.0)."""
    return df.withColumns({c: F.round(F.col(c), digits) + F.lit(0.0) for c in cols})


def scored_pred(spark, sf) -> DataFrame:
    return C.with_pred(FX.scored(spark, sf), 0.5)


def importance(spark, sf) -> DataFrame:
    """(Feature, Importance): part-type counts under feature-like names."""
    r = FX.ranks(spark, sf)
    prefix = F.element_at(F.array(F.lit("CIR_"), F.lit("PEAK2_"), F.lit("RANGE_")),
                          (F.col("a").cast("int") % 3 + 1))
    tot = F.sum("b").over(Window.partitionBy(F.lit(0)))   # one row per part type: small
    return r.select(F.concat(prefix, F.col("f")).alias("Feature"), (F.col("b") / tot).alias("Importance"))


def coefs(spark, sf) -> DataFrame:
    r = FX.ranks(spark, sf)
    return r.select(F.col("f").alias("Feature"), (F.col("b") / F.col("a") - 25.0).alias("coef"))


def peaks_flat(spark, sf, params=FLAT, engine: str = "vectorized") -> DataFrame:
    from cirflow.functions import fast
    w = FX.wave_flat(spark, sf)
    impl = fast.second_peak if engine == "vectorized" else W.second_peak
    sp = impl("w", "fp", params["start"], params["length"], params["gap"],
              params["height"], params["min_prominence"])
    return w.select("id", "fp", sp.alias("s")).select("id", "fp", "s.*")


# ================================================================ 2.1 scans / sinks
def _csv_parts(spark, sf, tag: bool | str) -> DataFrame:
    """Customer and supplier balances as two CSV parts, read by the part scan."""
    path = scratch_path(spark, "parts")
    for name, prefix in (("customer", "c"), ("supplier", "s")):
        part = FX.table(spark, sf, name).select(F.col(f"{prefix}_acctbal").alias("acctbal"), F.col(f"{prefix}_{name[:4]}key").alias("key"))
        SC.write_result_table(part, f"{path}/{name}.csv")
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("acctbal", T.DoubleType())])
    return SC.scan_parts(spark, [f"{path}/customer.csv", f"{path}/supplier.csv"], schema, tag=tag, pack=False)


@q("scan_parts_tagged")
def scan_parts_tagged(spark, sf):
    return _csv_parts(spark, sf, "folder")


@q("scan_parts")
def scan_parts(spark, sf):
    return _csv_parts(spark, sf, False)


@q("pack_waveform")
def pack_waveform(spark, sf):
    w = FX.wave_emb(spark, sf)
    wide = SC.unpack_waveform(w.select("id", "w"), "w", "S", 64)
    packed = SC.pack_waveform(wide, "S", 64, "w")
    return packed.select("id", F.posexplode("w").alias("pos", "x"))


def _emb_split(spark, sf) -> DataFrame:
    return SP.group_split(FX.wave_emb(spark, sf).drop("w"), "grp")


@q("write_split_dataset")
def write_split_dataset(spark, sf):
    path = SC.write_split_dataset(_emb_split(spark, sf), scratch_path(spark, "split"))
    return spark.read.parquet(path).select("id", "y", "fp", "grp", "split")


@q("read_split_dataset")
def read_split_dataset(spark, sf):
    path = SC.write_split_dataset(_emb_split(spark, sf), scratch_path(spark, "split"))
    return SC.read_split_dataset(spark, path, "train").select("id", "y", "fp", "grp")


@q("write_split_manifest")
def write_split_manifest(spark, sf):
    g = SP.group_split(FX.groups(spark, sf), "source")
    path = SC.write_split_manifest(g, "source", scratch_path(spark, "manifest"))
    groups = spark.read.schema("source string, n bigint, split string").parquet(f"{path}/groups")
    summary = spark.read.json(f"{path}/summary").select("random_seed", "n_total", "n_train", "n_val", "n_test")
    return groups.crossJoin(F.broadcast(summary))            # one row


@q("write_result_table")
def write_result_table(spark, sf):
    path = SC.write_result_table(FX.ranks(spark, sf), scratch_path(spark, "ranks"))
    return SC.read_result_table(spark, path, "f string, a double, b double")


@q("read_result_table")
def read_result_table(spark, sf):
    path = SC.write_result_table(importance(spark, sf), scratch_path(spark, "imp"), fmt="parquet")
    return SC.read_result_table(spark, path, fmt="parquet").select("Feature", "Importance")


@q("save_predictions")
def save_predictions(spark, sf):
    path = SC.save_predictions(scored_pred(spark, sf), scratch_path(spark, "pred"))
    read = lambda name, *cols: spark.read.parquet(f"{path}/{name}").select(F.lit(name).alias("part"), "model", *cols)
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    pred = read("predictions", "id", "y", "pred", "p", none("bigint", "n"), none("double", "fpr"), none("double", "tpr"))
    cells = read("confusion", none("bigint", "id"), "y", "pred", none("double", "p"), "n", none("double", "fpr"), none("double", "tpr"))
    points = read("roc", none("bigint", "id"), none("int", "y"), none("int", "pred"), F.col("threshold").alias("p"), none("bigint", "n"), "fpr", "tpr")
    return pred.unionByName(cells).unionByName(points)


# ================================================================ 2.2 projections / filters
@q("project_features")
def project_features(spark, sf):
    from cirflow.sources.scans import CORE_FEATURES
    d = FE.ratio_features(FX.measurements(spark, sf))
    return rnd(d.select("id", *CORE_FEATURES, *FE.RATIO_FEATURES), ["SNR_dB", *FE.RATIO_FEATURES], 6)


@q("cast_types")
def cast_types(spark, sf):
    s = FX.scalars(spark, sf)
    return s.select(F.col("a").cast("double").alias("a"), F.col("k").cast("bigint").alias("k"),
                    (F.col("b") > 0).cast("int").alias("flag"))


@q("filter_class")
def filter_class(spark, sf):
    return FX.wave_emb(spark, sf).where(F.col("y") == 1).select("id", "grp")


@q("filter_split")
def filter_split(spark, sf):
    g = FX.groups(spark, sf)
    val = SP.group_table(g, "source").where(F.col("split") == "val").select("source")
    return g.join(val, "source", "left_semi").select("doc_id", "source")


@q("drop_by_prefix")
def drop_by_prefix(spark, sf):
    o = FX.table(spark, sf, "orders")
    return o.select(*[c for c in o.columns if not c.startswith("o_order")])


@q("constant_label")
def constant_label(spark, sf):
    w = FX.wave_emb(spark, sf)
    return w.select("id", F.col("y").alias("pair_label"), F.lit(1).alias("path2_nlos"))


@q("threshold_predict")
def threshold_predict(spark, sf):
    return FX.scored(spark, sf).select("id", "model", S.threshold_predict("p", 0.5).alias("pred"))


@q("rename_select")
def rename_select(spark, sf):
    return FX.ranks(spark, sf).select(F.col("f").alias("Feature"), F.col("a").alias("Coefficient"))


@q("sample_per_class")
def sample_per_class(spark, sf):
    """Whole waves of seeds 42-44 and focus windows of seeds 0-9, one of each class."""
    out = PR.sample_views(FX.wave_emb(spark, sf).select("id", "y", "w"), "y", "id", "w", start=16, length=32)
    return out.select("y", "id", "seed", "view", F.posexplode("w").alias("pos", "x"))


# ================================================================ 2.3 splits / folds / weights
@q("group_split")
def group_split(spark, sf):
    return SP.group_split(FX.groups(spark, sf), "source").select("doc_id", "source", "split")


@q("split_assign")
def split_assign(spark, sf):
    return _emb_split(spark, sf).groupBy("split").agg(F.count("*").alias("n"))


@q("split_balance")
def split_balance(spark, sf):
    return SP.split_balance(_emb_split(spark, sf), "y")


@q("class_counts")
def class_counts(spark, sf):
    return SP.class_counts(FX.groups(spark, sf), "quality")


@q("stratified_kfold")
def stratified_kfold(spark, sf):
    s = FX.scored_wide(spark, sf).select("id", "y")
    return SP.stratified_kfold(s, "y", "id", 3)


@q("kfold")
def kfold(spark, sf):
    return SP.kfold(FX.scored_wide(spark, sf).select("id"), "id", 5)


@q("pos_weight")
def pos_weight(spark, sf):
    return SP.pos_weight(FX.scored_wide(spark, sf), "y")


@q("balanced_weight")
def balanced_weight(spark, sf):
    s = FX.scored_wide(spark, sf).select("id", "y")
    return SP.balanced_weight(s, "y")


# ================================================================ 2.4 scalar functions
@q("guarded_ratio")
def guarded_ratio(spark, sf):
    s = FX.scalars(spark, sf)
    return s.select("a", "b", S.guarded_ratio("a", "b").alias("ratio"))


@q("sum_squares")
def sum_squares(spark, sf):
    s = FX.scalars(spark, sf)
    return s.select("a", "b", S.sum_squares("a", "b", "a").alias("ss"))


@q("peak_gap")
def peak_gap(spark, sf):
    p = peaks_flat(spark, sf)
    return p.select("id", S.peak_gap("peak2_idx", "fp").alias("gap"))


@q("second_range")
def second_range(spark, sf):
    p = peaks_flat(spark, sf)
    rng = F.col("fp") * 0.5
    return rnd(p.select("id", S.second_range(rng, S.peak_gap("peak2_idx", "fp")).alias("range2")),
               ["range2"], 9)


@q("column_index_parse")
def column_index_parse(spark, sf):
    prof = FE.wave_profile(FX.wave_emb(spark, sf), "w", "y")
    names = prof.select(F.concat(F.lit("CIR"), (F.col("pos") + 730).cast("string")).alias("name")).distinct()
    return names.select("name", S.column_index_parse("name").alias("idx"))


@q("name_category")
def name_category(spark, sf):
    return importance(spark, sf).select("Feature", S.name_category("Feature").alias("Category"))


@q("monotone_clip")
def monotone_clip(spark, sf):
    r = FX.regress(spark, sf)
    return r.agg(F.count_if(F.col("p2") < F.col("p1")).alias("n_violations"),
                 F.sum(S.monotone_clip("p1", "p2")).alias("sum_p2_clipped"))


@q("per_path_labels")
def per_path_labels(spark, sf):
    s = scored_pred(spark, sf)
    lab = s.select("model", F.when(F.col("pred") == 1, "NLOS").otherwise("LOS").alias("path1"),
                   F.lit("NLOS").alias("path2"))
    c = SP.class_counts(lab, "path1", ["model"])
    return c.withColumn("path2", F.lit("NLOS"))


@q("wave_normalise")
def wave_normalise(spark, sf):
    w = FX.wave_emb(spark, sf)
    n = w.select("id", W.wave_normalise("w", F.col("grp") + 1).alias("wn"))
    return rnd(n.select("id", W.wave_sum("wn").alias("s")), ["s"], 6)


# ================================================================ 2.5 waveform functions
@q("wave_window")
def wave_window(spark, sf):
    w = FX.wave_emb(spark, sf).select("id", W.wave_window("w", 8, 32).alias("win"))
    return w.select("id", F.size("win").alias("n"), W.wave_sum("win").alias("s"),
                    F.get("win", 0).alias("first"), F.element_at("win", -1).alias("last"))


@q("wave_align")
def wave_align(spark, sf):
    w = FX.wave_emb(spark, sf)
    a = w.select("id", W.wave_align("w", "fp").alias("al"))
    return a.select("id", F.posexplode("al").alias("k", "x"))


@q("wave_peak")
def wave_peak(spark, sf):
    return FX.wave_user(spark, sf).select("id", W.wave_peak("w").alias("peak"))


@q("wave_peak_idx")
def wave_peak_idx(spark, sf):
    w = FX.wave_user(spark, sf)
    return w.select("id", W.wave_peak_idx("w").alias("peak_idx"),
                    W.wave_peak_idx("w", 730).alias("peak_idx_abs"))


@q("wave_energy")
def wave_energy(spark, sf):
    return FX.wave_emb(spark, sf).select("id", W.wave_energy("w").alias("energy"))


@q("wave_sum")
def wave_sum(spark, sf):
    return FX.wave_emb(spark, sf).select("id", W.wave_sum("w").alias("s"))


@q("wave_kurtosis")
def wave_kurtosis(spark, sf):
    return rnd(FX.wave_user(spark, sf).select("id", W.wave_kurtosis("w").alias("kurtosis")), ["kurtosis"], 8)


@q("wave_skewness")
def wave_skewness(spark, sf):
    return rnd(FX.wave_user(spark, sf).select("id", W.wave_skewness("w").alias("skewness")), ["skewness"], 8)


@q("wave_rise_time")
def wave_rise_time(spark, sf):
    return FX.wave_user(spark, sf).select("id", W.wave_rise_time("w").alias("rise_time"))


@q("wave_local_maxima")
def wave_local_maxima(spark, sf):
    w = FX.wave_flat(spark, sf)
    return w.select("id", F.explode(W.wave_local_maxima("w", FLAT["height"])).alias("pos"))


@q("wave_num_peaks")
def wave_num_peaks(spark, sf):
    return FX.wave_user(spark, sf).select("id", W.wave_num_peaks("w").alias("num_peaks"))


@q("wave_prominence")
def wave_prominence(spark, sf):
    from cirflow.functions import fast
    w = FX.wave_flat(spark, sf)
    return w.select("id", F.explode(fast.prominences("w", FLAT["height"])).alias("p")).select(
        "id", "p.pos", "p.prominence")


@q("second_peak")
def second_peak(spark, sf):
    return peaks_flat(spark, sf).drop("fp")


@q("found_rate")
def found_rate(spark, sf):
    return rnd(FE.found_rate(peaks_flat(spark, sf, FLAT_STRICT), "peak2_found"), ["pct_found"], 9)


@q("median_impute")
def median_impute(spark, sf):
    p = peaks_flat(spark, sf, FLAT_STRICT).withColumn("gap", S.peak_gap("peak2_idx", "fp"))
    out = FE.median_impute(p, ["gap", "peak2_amp", "peak2_idx"], rng=None)
    return out.select("id", "gap", "peak2_amp", "peak2_idx")


@q("wave_profile")
def wave_profile(spark, sf):
    return rnd(FE.wave_profile(FX.wave_emb(spark, sf), "w", "y"), ["mean_amp"], 6)


# ================================================================ 2.6 joins
@q("join_rankings")
def join_rankings(spark, sf):
    r = FX.ranks(spark, sf)
    return RK.join_rankings(r.select("f", "a"), r.where(F.col("a") > 10).select("f", "b"), "f")


@q("lookup_default_zero")
def lookup_default_zero(spark, sf):
    imp = importance(spark, sf)
    top = RK.topk(imp, "Importance", 15)
    other = imp.where(F.col("Feature").startswith("CIR_")).select(
        "Feature", (F.col("Importance") * 2).alias("Importance"))
    return RK.lookup_default_zero(top, other)


@q("attach_split")
def attach_split(spark, sf):
    g = SP.group_split(FX.groups(spark, sf), "source").select("doc_id", "split")
    lab = FX.table(spark, sf, "labels")
    return RK.attach_split(lab, g, "doc_id").select("doc_id", "quality", "split")


@q("align_predictions")
def align_predictions(spark, sf):
    return RK.align_predictions(FX.scored(spark, sf), models=list(FX.SCORED_MODELS))


# ================================================================ 2.7 aggregations
def _user_feats(spark, sf) -> DataFrame:
    w = FX.wave_user(spark, sf)
    return w.select("id", "y", F.col("fp").cast("double").alias("fp"),
                    W.wave_sum("w").alias("wsum"), W.wave_peak("w").alias("peak"))


@q("class_mean_std")
def class_mean_std(spark, sf):
    return rnd(PR.class_mean_std(_user_feats(spark, sf), "y", ["fp", "wsum", "peak"]), ["mean", "std"], 6)


@q("column_mean_std")
def column_mean_std(spark, sf):
    ev = FX.table(spark, sf, "events")
    return rnd(PR.column_mean_std(ev, ["value", "user_id"]), ["mean", "std"], 6)


@q("scaled_check")
def scaled_check(spark, sf):
    from cirflow.operators.models import PopulationScaler
    li = FX.table(spark, sf, "lineitem")
    cols = ["l_quantity", "l_extendedprice", "l_discount"]
    sc = PopulationScaler(cols).fit(li)
    return rnd(PR.scaled_check(sc.transform(li), cols), ["mean", "std"], 6)


@q("min_max")
def min_max(spark, sf):
    return PR.min_max(FX.regress(spark, sf), ["y1", "y2"])


@q("label_correlation")
def label_correlation(spark, sf):
    return rnd(PR.label_correlation(_user_feats(spark, sf), "y", ["fp", "wsum", "peak"]), ["corr"], 6)


@q("class_histogram")
def class_histogram(spark, sf):
    s = FX.scored_wide(spark, sf).join(FX.table(spark, sf, "events").select(
        F.col("event_id").alias("id"), "value"), "id")
    return rnd(PR.class_histogram(s, "y", "value", 50), ["lo", "hi", "density"], 6)


@q("count_histogram")
def count_histogram(spark, sf):
    r = FX.regress(spark, sf).withColumn("res", F.col("p1") - F.col("y1"))
    return rnd(PR.count_histogram(r, "res", 60), ["lo", "hi"], 6)


@q("box_stats")
def box_stats(spark, sf):
    ev = FX.table(spark, sf, "events")
    return rnd(PR.box_stats(ev, "event_type", "value"), ["q1", "median", "q3"], 6)


@q("scatter_sample")
def scatter_sample(spark, sf):
    ev = FX.table(spark, sf, "events").withColumn(
        "y", F.col("event_type").isin("purchase", "signup").cast("int"))
    return PR.scatter_sample(ev, "y", "event_id", "value", "user_id")


@q("category_importance")
def category_importance(spark, sf):
    return rnd(PR.category_importance(importance(spark, sf)), ["Importance"], 9)


@q("coef_sign_counts")
def coef_sign_counts(spark, sf):
    return PR.coef_sign_counts(coefs(spark, sf))


@q("distinct_sorted")
def distinct_sorted(spark, sf):
    return PR.distinct_sorted(FX.table(spark, sf, "documents"), "source")


# ================================================================ 2.8 classification evaluation
@q("confusion_matrix")
def confusion_matrix(spark, sf):
    return C.confusion_matrix(scored_pred(spark, sf), "model")


@q("binary_metrics")
def binary_metrics(spark, sf):
    return C.binary_metrics(scored_pred(spark, sf), "model")


@q("classification_report")
def classification_report(spark, sf):
    return C.classification_report(scored_pred(spark, sf), "model")


@q("roc_curve")
def roc_curve(spark, sf):
    return C.roc_curve(FX.scored(spark, sf), "model")


@q("roc_auc")
def roc_auc(spark, sf):
    return C.roc_auc(FX.scored(spark, sf), "model")


@q("auc_trapezoid")
def auc_trapezoid(spark, sf):
    return rnd(C.auc_trapezoid(C.roc_curve(FX.scored(spark, sf), "model"), "model"), ["auc"], 9)


@q("multi_model_roc")
def multi_model_roc(spark, sf):
    return C.curve_and_auc(FX.scored(spark, sf), "model")


@q("threshold_tune")
def threshold_tune(spark, sf):
    return C.threshold_tune(FX.scored(spark, sf), "model")


@q("threshold_curve")
def threshold_curve(spark, sf):
    return C.threshold_curve(FX.scored(spark, sf), "model")


@q("error_partition")
def error_partition(spark, sf):
    return C.error_partition(scored_pred(spark, sf), "model")


@q("error_confidence")
def error_confidence(spark, sf):
    return C.error_confidence(scored_pred(spark, sf), "model")


@q("error_prob_stats")
def error_prob_stats(spark, sf):
    return rnd(C.error_prob_stats(scored_pred(spark, sf), "model"), ["mean", "std", "min", "max", "median"], 9)


def _vector_shift(spark, sf, normalise: bool) -> DataFrame:
    # a vector is far wider than the planner's estimate of an array: it is never broadcast
    rows = scored_pred(spark, sf).join(FX.event_features(spark, sf).hint("merge"), "id")
    return C.error_vector_shift(rows, "features", [f"F{i}" for i in range(FX.EVENT_FEATURES)], normalise=normalise, by="model")


@q("error_feature_shift")
def error_feature_shift(spark, sf):
    return rnd(_vector_shift(spark, sf, False), ["effect", "correct_mean", "error_mean"], 6)


@q("error_feature_effect")
def error_feature_effect(spark, sf):
    return rnd(_vector_shift(spark, sf, True), ["effect", "correct_mean", "error_mean"], 6)


@q("error_rate_bins")
def error_rate_bins(spark, sf):
    return C.error_rate_bins(scored_pred(spark, sf), "model")


@q("model_comparison")
def model_comparison(spark, sf):
    return C.model_comparison(scored_pred(spark, sf))


@q("metrics_melt")
def metrics_melt(spark, sf):
    m = C.model_comparison(scored_pred(spark, sf))
    return C.metrics_melt(m, "model", ["accuracy", "precision", "recall", "f1", "auc"])


@q("best_model")
def best_model(spark, sf):
    return C.best_model(C.model_comparison(scored_pred(spark, sf)))


@q("metric_duel")
def metric_duel(spark, sf):
    return C.metric_duel(C.model_comparison(scored_pred(spark, sf)), "m1", "m2")


# ================================================================ 2.9 regression evaluation
def regress_long(spark, sf) -> DataFrame:
    r = FX.regress(spark, sf)
    return (r.select("key", F.lit("path1").alias("path"), F.col("y1").alias("y"), F.col("p1").alias("p"))
            .unionByName(r.select("key", F.lit("path2").alias("path"), F.col("y2").alias("y"),
                                  F.col("p2").alias("p"))))


@q("regression_metrics")
def regression_metrics(spark, sf):
    return rnd(RG.regression_metrics(regress_long(spark, sf), "y", "p", "path"), ["rmse", "mae", "r2"], 6)


@q("clipped_metrics")
def clipped_metrics(spark, sf):
    out = RG.clipped_metrics(FX.regress(spark, sf), "y2", "p1", "p2")
    return rnd(out, ["rmse_raw", "mae_raw", "r2_raw", "rmse_clipped", "mae_clipped", "r2_clipped"], 6)


@q("residual_stats")
def residual_stats(spark, sf):
    return rnd(RG.residual_stats(regress_long(spark, sf), "y", "p", "path"),
               ["mean", "std", "share_lt_0_5", "share_lt_1_0", "median"], 6)


@q("actual_vs_predicted")
def actual_vs_predicted(spark, sf):
    return RG.actual_vs_predicted(regress_long(spark, sf), "y", "p", "path", "key")


@q("fold_summary")
def fold_summary(spark, sf):
    d = SP.kfold(regress_long(spark, sf), "key", 5)
    per_fold = RG.fold_metrics(d, "y", "p", "fold", "path")
    return rnd(RG.fold_summary(per_fold, "path"),
               ["rmse_mean", "rmse_std", "mae_mean", "mae_std", "r2_mean", "r2_std"], 6)


def model_results(spark, sf) -> DataFrame:
    """Metrics of three predictors per path: as given, shrunk, and blended."""
    d = regress_long(spark, sf)
    variants = (d.select("path", "y", F.lit("given").alias("model"), "p")
                .unionByName(d.select("path", "y", F.lit("shrunk").alias("model"), (F.col("p") * 0.9).alias("p")))
                .unionByName(d.select("path", "y", F.lit("blend").alias("model"),
                                      ((F.col("p") + F.col("y")) / 2.0).alias("p"))))
    return rnd(RG.regression_metrics(variants, "y", "p", ["path", "model"]), ["rmse", "mae", "r2"], 6)


@q("rank_results")
def rank_results(spark, sf):
    return RG.rank_results(model_results(spark, sf), "path")


@q("best_per_path")
def best_per_path(spark, sf):
    return RG.best_per_path(model_results(spark, sf), "path", "model")


# ================================================================ 2.10 ranking
@q("avg_rank")
def avg_rank(spark, sf):
    return RK.avg_rank(FX.ranks(spark, sf), "a", "rank").select("f", "a", "rank")


@q("rank_agreement")
def rank_agreement(spark, sf):
    return RK.rank_agreement(FX.ranks(spark, sf), FX.ranks(spark, sf), "f", "a", "b")


@q("normalise_to_one")
def normalise_to_one(spark, sf):
    return RK.normalise_to_one(FX.ranks(spark, sf).select("f", "a"), "a")


@q("rank_enumerate")
def rank_enumerate(spark, sf):
    return RK.rank_enumerate(importance(spark, sf), "Importance")


# ================================================================ 2.11 top-k
@q("topk_importance")
def topk_importance(spark, sf):
    return RK.topk(importance(spark, sf), "Importance", 15)


@q("topk_abs")
def topk_abs(spark, sf):
    return RK.topk(coefs(spark, sf), "coef", 10, absolute=True)


@q("topk_error_features")
def topk_error_features(spark, sf):
    return rnd(RK.topk(_vector_shift(spark, sf, True), "effect", 10, name="feature"), ["effect", "correct_mean", "error_mean"], 6)


# ================================================================ 2.12 set operations
@q("union_parts")
def union_parts(spark, sf):
    return FX.parts_tagged(spark, sf)


@q("hstack_features")
def hstack_features(spark, sf):
    """Append second-path and aligned-window features to the measurement rows."""
    d = FE.second_path(FX.measurements(spark, sf), "cir", "FP_IDX", "RANGE", start=0, length=64, gap=3)
    d = FE.aligned_features(d, "cir", "FP_IDX", pre=8, post=24)
    return rnd(d.select("id", "PEAK2_IDX", "PEAK2_AMP", "PEAK2_FOUND", "PEAK2_GAP", "RANGE_PATH2_EST",
                        "CIR_energy", "CIR_rise_time"), ["RANGE_PATH2_EST"], 9)


# ================================================================ 2.13 models
# The scaler and KNN have exact oracles. Fits return, for each row they score,
# facts that a statement can derive: ids and labels, probabilities in range,
# predictions that follow from them, quality above a floor, and what else the
# model must meet. The scores themselves are the operators' results (tests
# compare those with plain versions).
SCALE_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


def _li_train(spark, sf) -> tuple[DataFrame, DataFrame]:
    li = SP.kfold(FX.table(spark, sf, "lineitem"), "l_orderkey", 5)
    return li, li.where(F.col("fold") != 0)


@q("fit_scaler")
def fit_scaler(spark, sf):
    from cirflow.operators.models import PopulationScaler
    _, train = _li_train(spark, sf)
    return rnd(PopulationScaler(SCALE_COLS).fit(train).stats(spark), ["mean", "std"], 6)


@q("apply_scaler")
def apply_scaler(spark, sf):
    from cirflow.operators.models import PopulationScaler
    li, train = _li_train(spark, sf)
    sc = PopulationScaler(SCALE_COLS, suffix="_z").fit(train)
    out = sc.transform(li).select("l_orderkey", "l_linenumber", *[c + "_z" for c in SCALE_COLS])
    return rnd(out, [c + "_z" for c in SCALE_COLS], 6)


def ml_table(spark, sf) -> DataFrame:
    """Embeddings as a learnable task: y = embedding[0] > 0, 64 features,
    a regression target, and an md5 split (fold 0 test, 1 val, else train)."""
    from pyspark.ml.functions import array_to_vector
    e = FX.table(spark, sf, "embeddings")
    d = e.select(F.col("vec_id").alias("id"), (F.get("embedding", 0) > 0).cast("int").alias("y"),
                 array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("features"),
                 (F.get("embedding", 1).cast("double") * 10.0 + F.col("label")).alias("target"))
    d = SP.kfold(d, "id", 5)
    return d.withColumn("split", F.when(F.col("fold") == 0, "test").when(F.col("fold") == 1, "val")
                        .otherwise("train"))


def _train_test(spark, sf):
    d = ml_table(spark, sf)
    return d.where(F.col("split") != "test"), d.where(F.col("split") == "test")


#: Smallest AUC and R2 of a fit on the learnable tables.
AUC_FLOOR, R2_FLOOR = 0.75, 0.0


def _facts(scored: DataFrame, threshold: float = 0.5, **facts: bool) -> DataFrame:
    """(id, y, p_in_range, pred_fits, above_floor, facts...) of scored test rows."""
    scored = stored(scored, "scored")
    auc = C.roc_auc(scored).first()["auc"]
    return scored.select("id", "y", F.coalesce(F.col("p").between(0, 1), F.lit(False)).alias("p_in_range"), (F.col("pred") == (F.col("p") >= threshold).cast("int")).alias("pred_fits"),
                         F.lit(auc is not None and auc >= AUC_FLOOR).alias("above_floor"), *[F.lit(bool(v)).alias(k) for k, v in facts.items()])


def _regression_facts(scored: DataFrame, **facts: bool) -> DataFrame:
    scored = stored(scored, "scored")
    r2 = RG.regression_metrics(scored.withColumn("m", F.lit(1)), "y", "p", "m").first()["r2"]
    finite = F.coalesce(~F.isnan("p") & (F.abs("p") < float("inf")), F.lit(False))
    return scored.select("id", finite.alias("p_finite"), F.lit(r2 is not None and r2 >= R2_FLOOR).alias("above_floor"), *[F.lit(bool(v)).alias(k) for k, v in facts.items()])


def _fit_score(spark, sf, est, weight: str | None = None) -> DataFrame:
    from cirflow.operators import models as M
    train, test = _train_test(spark, sf)
    if weight == "balanced":
        train = SP.balanced_weight(train, "y")
    est = est.setFeaturesCol("features").setLabelCol("y")
    if weight:
        est = est.setWeightCol("weight")
    return M.predict_proba(est.fit(train), test)


def _pair_params(train: DataFrame, **settings):
    """The pair classifier's settings, the positive class weighted by n0 / n1."""
    from cirflow.operators import boosting as B
    n0, n1 = train.agg(F.count_if(F.col("y") == 0), F.count_if(F.col("y") == 1)).first()
    return B.Params(scale_pos_weight=n0 / max(n1, 1), **settings)


@q("train_boosted_classifier")
def train_boosted_classifier(spark, sf):
    from cirflow.operators import boosting as B
    train, test = _train_test(spark, sf)
    m = B.fit(train, _pair_params(train))
    return _facts(m.predict(test), all_trees=len(m.trees) == 200, importance_sums_to_one=abs(m.importance().sum() - 1) < 1e-9)


@q("early_stopping")
def early_stopping(spark, sf):
    """Ends after 30 rounds without a smaller validation loss; the model is cut at the best round."""
    from cirflow.operators import boosting as B
    train, test = _train_test(spark, sf)
    m = B.fit(train, _pair_params(train.where("split = 'train'")), valid=F.col("split") == "val", patience=30)
    ended = m.last_round - m.best_round == 30 or m.last_round == m.params.n_estimators - 1
    return _facts(m.predict(test), ended_in_time=ended, best_is_least=min(m.losses) == m.losses[m.best_round], cut_at_best=len(m.trees) == m.best_round + 1)


@q("train_random_forest")
def train_random_forest(spark, sf):
    from cirflow.operators import forest as R
    train, test = _train_test(spark, sf)
    m = R.fit(train)
    return _facts(m.predict(test), all_trees=len(m.trees) == 200)


@q("train_logistic")
def train_logistic(spark, sf):
    return _facts(_logistic_scores(spark, sf))


def _logistic_scores(spark, sf) -> DataFrame:
    from cirflow.operators import models as M
    train, _ = _train_test(spark, sf)
    return _fit_score(spark, sf, M.logistic(1.0, float(train.count())), weight="balanced")


@q("train_linear_svm")
def train_linear_svm(spark, sf):
    from cirflow.operators import svm as V
    train, test = _train_test(spark, sf)
    m = V.fit(train)
    margin = test.select("id", "y", m.margin(V.vector("features", test)).alias("m"))
    scored = margin.select("id", "y", (F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("m")))).alias("p"), (F.col("m") >= 0).cast("int").alias("pred"))
    return _facts(scored, gradient_near_zero=m.gradient < 1e-6)


@q("platt_calibrate")
def platt_calibrate(spark, sf):
    from cirflow.operators import svm as V
    train, test = _train_test(spark, sf)
    m = V.calibrate(stored(SP.stratified_kfold(train, "y", "id", 3, out="cal_fold"), "cal-folds"), "cal_fold", 3)
    return _facts(m.predict(test), gradient_near_zero=m.gradient < 1e-6, rising=all(s.a < 0 for _, s in m.folds))


@q("train_decision_tree")
def train_decision_tree(spark, sf):
    """A depth-4 tree with balanced classes; the rules read from it, applied as filters, give its predictions."""
    from cirflow.operators import models as M
    train, test = _train_test(spark, sf)
    est = M.decision_tree(4).setFeaturesCol("features").setLabelCol("y").setWeightCol("weight")
    m = est.fit(stored(SP.balanced_weight(train, "y"), "tree-rows"))
    names = [f"f{i}" for i in range(m.numFeatures)]
    rules = M.tree_rules(m, names, spark).select("condition", "class").collect()          # one a leaf
    scored = stored(M.predict_proba(m, test, ["id", "y", "features"]), "tree-scored")
    from pyspark.ml.functions import vector_to_array
    wide = scored.select("id", *[vector_to_array("features")[i].alias(n) for i, n in enumerate(names)])
    by_rule = wide.select("id", F.array_compact(F.array(*[F.when(F.expr(r["condition"]), F.lit(r["class"])) for r in rules])).alias("classes"))
    fits = scored.join(by_rule, "id").select("id", ((F.size("classes") == 1) & (F.get("classes", F.lit(0)) == F.col("pred"))).alias("rule_fits"))
    return _facts(scored.drop("features")).join(fits, "id")


def _fit_regress(spark, sf, est) -> DataFrame:
    train, test = _train_test(spark, sf)
    m = est.setFeaturesCol("features").setLabelCol("target").fit(train)
    return m.transform(test).select("id", F.col("target").alias("y"), F.col("prediction").alias("p"))


@q("train_boosted_regressor")
def train_boosted_regressor(spark, sf):
    from cirflow.operators import boosting as B
    train, test = _train_test(spark, sf)
    m = B.fit(train, B.RANGE_REGRESSOR, label="target")
    return _regression_facts(m.predict(test.withColumnRenamed("y", "cls").withColumnRenamed("target", "y")), all_trees=len(m.trees) == 1200)


@q("train_rf_regressor")
def train_rf_regressor(spark, sf):
    from cirflow.operators import forest as R
    train, test = _train_test(spark, sf)
    m = R.fit(train, R.RANGE_REGRESSOR, label="target", regression=True)
    return _regression_facts(m.predict(test.withColumnRenamed("y", "cls").withColumnRenamed("target", "y")), all_trees=len(m.trees) == 100)


@q("knn_regress")
def knn_regress(spark, sf):
    from cirflow.operators.knn import knn_regress as knn
    w = SP.kfold(FX.wave_emb(spark, sf), "id", 5).withColumn("target", F.col("grp").cast("double"))
    out = knn(w.where(F.col("fold") != 0), w.where(F.col("fold") == 0), 15, "id", "w", "target")
    return rnd(out, ["pred"], 6)


@q("random_search_cv")
def random_search_cv(spark, sf):
    from cirflow.operators import models as M
    train, test = _train_test(spark, sf)
    train = SP.stratified_kfold(train, "y", "id", 3, out="cv_fold")
    rf = M.random_forest(num_trees=10).setFeaturesCol("features").setLabelCol("y")
    grid = {"maxDepth": [3, 5, 8], "numTrees": [10, 20], "minInstancesPerNode": [1, 2]}
    cv = M.random_search_cv(rf, grid, train, n_iter=3, fold_col="cv_fold", parallelism=3)
    drawn = [{p.name: v for p, v in m.items()} for m in cv.getEstimatorParamMaps()]
    chosen = drawn[cv.avgMetrics.index(max(cv.avgMetrics))]
    kept = all(cv.bestModel.getOrDefault(k) == v for k, v in chosen.items())
    return _facts(M.predict_proba(cv.bestModel, test), all_draws=len(cv.avgMetrics) == 3, best_is_refitted=kept)


@q("cv_score")
def cv_score(spark, sf):
    from cirflow.operators import models as M
    train, _ = _train_test(spark, sf)
    train = SP.stratified_kfold(train, "y", "id", 3, out="cv_fold")
    dt = M.decision_tree(4).setFeaturesCol("features").setLabelCol("y")
    score = M.cv_score(dt, train, "cv_fold")
    folds = train.groupBy("cv_fold").agg(F.count("*").alias("n_rows"), F.count_if(F.col("y") == 1).alias("n_ones"))
    return folds.select("cv_fold", "n_rows", "n_ones", F.lit(0.5 < score <= 1.0).alias("mean_f1_in_range"))


@q("kfold_regression")
def kfold_regression(spark, sf):
    """5-fold CV on the train split: a forest on the feature vector and a
    15-NN regressor on the same 64 features, its scaler fitted inside each fold."""
    summary = kfold_summary(spark, sf)
    sane = (F.col("rmse_mean") > 0) & (F.col("rmse_std") >= 0) & (F.col("mae_mean") <= F.col("rmse_mean"))
    return summary.select("model", sane.alias("errors_fit"), (F.col("r2_mean") > -0.2).alias("above_floor"))


def kfold_summary(spark, sf) -> DataFrame:
    from cirflow.operators import models as M
    train, _ = _train_test(spark, sf)
    # folds from another seed: the test split already used md5(42|id) mod 5
    train = SP.kfold(train.drop("fold"), "id", 5, seed=7, out="cv_fold")
    from pyspark.ml.functions import vector_to_array
    cols = [f"x{i}" for i in range(64)]
    train = stored(train.withColumns({c: vector_to_array("features")[i] for i, c in enumerate(cols)}), "cv-rows")
    rf = M.kfold_predictions(train, "cv_fold", 5, M.estimator_fit_predict(
        M.rf_regressor(num_trees=10, max_depth=6), "features", "target"))
    knn = M.kfold_predictions(train, "cv_fold", 5, M.knn_fit_predict(cols, "target", 15))
    per_fold = (RG.fold_metrics(rf, "y", "p", "fold").withColumn("model", F.lit("random_forest"))
                .unionByName(RG.fold_metrics(knn, "y", "p", "fold").withColumn("model", F.lit("knn"))))
    return stored(RG.fold_summary(per_fold, "model"), "cv-summary")


@q("predict_proba")
def predict_proba(spark, sf):
    return _facts(_logistic_scores(spark, sf)).select("id", "y", "p_in_range")


@q("feature_importance")
def feature_importance(spark, sf):
    """Every feature's share of the forest's impurity decrease; the label's own feature has the largest."""
    from cirflow.operators import forest as R
    train, _ = _train_test(spark, sf)
    imp = R.fit(train, R.Params(n_estimators=50)).importance()
    rows = [(f"f{i}", 0.0 <= float(v) <= 1.0, i == int(imp.argmax())) for i, v in enumerate(imp)]
    return spark.createDataFrame(rows, "Feature string, in_range boolean, largest boolean").withColumn("sums_to_one", F.lit(bool(abs(imp.sum() - 1) < 1e-9)))


@q("coefficients")
def coefficients(spark, sf):
    """Coefficients averaged over the calibration folds of the linear SVM."""
    from cirflow.operators import svm as V
    train, _ = _train_test(spark, sf)
    m = V.calibrate(stored(SP.stratified_kfold(train, "y", "id", 3, out="cal_fold"), "cal-folds"), "cal_fold", 3)
    c = m.coefficients(spark, [f"f{i}" for i in range(len(m.folds[0][0].coef))])
    top = c.agg(F.max("abs_coef")).first()[0]
    return c.select("Feature", (F.col("abs_coef") == F.abs("coef")).alias("abs_fits"), (F.col("abs_coef") == top).alias("largest"), F.lit(m.gradient < 1e-6).alias("gradient_near_zero"))


@q("save_model")
def save_model(spark, sf):
    """A fitted tree, saved and read again, predicts as before."""
    from pyspark.ml.classification import DecisionTreeClassificationModel
    from cirflow.operators import models as M
    train, test = _train_test(spark, sf)
    m = M.decision_tree(4).setFeaturesCol("features").setLabelCol("y").fit(train)
    path = M.save_model(m, scratch_path(spark, "model"))
    again = M.predict(DecisionTreeClassificationModel.load(path), test, ["id"], "again")
    return again.join(M.predict(m, test, ["id"]), "id").select("id", (F.col("again") == F.col("pred")).alias("same"))
