"""End-to-end flows of the reference as DataFrame plans.

A  pair classification: features -> group split -> impute (fit on train)
   -> boosted trees -> threshold -> evaluation tables
B  single-path models: base features -> split -> scaler -> several models
   -> threshold tuned on validation -> model comparison
C  range estimation: regression features -> one regressor per path ->
   monotone clip -> metrics and residuals

Every stage is lazy; the feature table is written once (or checkpointed to
the shared checkpoint folder) so model fits and evaluations reread it
instead of recomputing the waveform features, and so a lost executor only
recomputes from that table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cirflow.functions.scalars import monotone_clip
from cirflow.functions import waves as W
from cirflow.operators import boosting as B
from cirflow.operators import classify as C
from cirflow.operators import features as FE
from cirflow.operators import forest as R
from cirflow.operators import models as M
from cirflow.operators import regress as RG
from cirflow.operators import splits as SP
from cirflow.operators import svm as V
from cirflow.session import scratch_path
from cirflow.sources.scans import CORE_FEATURES


@dataclass
class Config:
    focus_start: int = W.FOCUS_START
    focus_len: int = W.FOCUS_LEN
    align_pre: int = W.ALIGN_PRE
    align_post: int = W.ALIGN_POST
    gap: int = W.MIN_GAP_SAMPLES
    height: float = W.PEAK_HEIGHT
    prominence: float = W.PEAK_PROMINENCE
    val_size: float = 0.15
    test_size: float = 0.15
    seed: int = 42
    group: str = "__source_file"
    label: str = "NLOS"
    impute_fit_on: str = "train"            # "all" reproduces the reference
    threshold: float = 0.5
    gbt: dict = field(default_factory=lambda: dict(max_iter=200, max_depth=6, step=0.1))
    tune_trials: int = 0                     # > 0: random search with cross-validation
    cv_folds: int = 3
    tune_grid: dict = field(default_factory=lambda: {
        "maxDepth": [3, 4, 5, 6, 8], "stepSize": [0.03, 0.05, 0.1, 0.2], "maxIter": [100, 200, 400],
        "subsamplingRate": [0.6, 0.8, 1.0], "minInstancesPerNode": [1, 3, 5]})
    boosted: dict = field(default_factory=dict)      # flow B: boosting.Params, forest.Params
    forest: dict = field(default_factory=dict)
    patience: int = 30
    reg: dict = field(default_factory=lambda: dict(max_iter=1200, max_depth=8, step=0.015))
    reg_cv: bool = False                     # k-fold CV of both regressors on the train split


def materialise(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared checkpoint folder and read back: cuts the
    lineage (executor loss recomputes from here) and shares the work."""
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def pair_features(df: DataFrame, cfg: Config) -> DataFrame:
    """16 core + 4 second-path + 10 engineered scalars + aligned window."""
    d = FE.ratio_features(df)
    d = FE.second_path(d, "cir", "FP_IDX", "RANGE", cfg.focus_start, cfg.focus_len, cfg.gap,
                       cfg.height, cfg.prominence)
    return FE.aligned_features(d, "cir", "FP_IDX", cfg.align_pre, cfg.align_post, engine="vectorized")


PAIR_SCALARS = (CORE_FEATURES + ["PEAK2_IDX", "PEAK2_AMP", "PEAK2_FOUND", "PEAK2_GAP"] + FE.RATIO_FEATURES
                + ["CIR_energy", "CIR_kurtosis", "CIR_skewness", "CIR_rise_time", "CIR_num_peaks"])


def _vectorise(df: DataFrame, scalars: list[str], size: int, aligned: str = "cir_aligned") -> DataFrame:
    from pyspark.ml.feature import VectorSizeHint
    from pyspark.ml.functions import array_to_vector
    d = df.fillna(0.0, ["CIR_kurtosis", "CIR_skewness"])       # constant windows: NULL -> 0
    # its features are then CIR_aligned_0, ...: the waveform category
    d = d.withColumn("CIR_aligned", array_to_vector(aligned))
    d = VectorSizeHint(inputCol="CIR_aligned", size=size, handleInvalid="error").transform(d)
    return M.assemble(d, scalars + ["CIR_aligned"], "features")


def prepare_pair(spark: SparkSession, meas: DataFrame, cfg: Config) -> DataFrame:
    """Flow A up to the model input: features, split, imputation, vector."""
    d = SP.group_split(pair_features(meas, cfg), cfg.group, cfg.val_size, cfg.test_size, cfg.seed)
    d = materialise(spark, d, "pair-features")
    fit = d.where(F.col("split") == "train") if cfg.impute_fit_on == "train" else d
    d = FE.median_impute(d, ["PEAK2_GAP", "PEAK2_AMP", "PEAK2_IDX"], fit_df=fit)
    return _vectorise(d, PAIR_SCALARS, cfg.align_pre + cfg.align_post)


def pair_classification(spark: SparkSession, meas: DataFrame, cfg: Config | None = None) -> dict:
    """Flow A. Returns result tables (DataFrames) keyed by name."""
    cfg = cfg or Config()
    d = prepare_pair(spark, meas, cfg).withColumnRenamed(cfg.label, "y")
    train = SP.with_pos_weight(d.where(F.col("split") == "train"), "y")
    test = d.where(F.col("split") == "test")
    gbt = M.boosted_classifier(**cfg.gbt).setFeaturesCol("features").setLabelCol("y").setWeightCol("weight")
    cv_f1 = None
    if cfg.tune_trials:
        # random search over a parameter grid, stratified folds, F1 of class 1
        folds = SP.stratified_kfold(train, "y", "id", cfg.cv_folds, seed=cfg.seed + 1, out="cv_fold")
        cv = M.random_search_cv(gbt, cfg.tune_grid, folds, cfg.tune_trials, "cv_fold", seed=cfg.seed)
        model, cv_f1 = cv.bestModel, float(max(cv.avgMetrics))
    else:
        model = gbt.fit(train)
    scored = M.predict_proba(model, test, ["id", "y"], cfg.threshold).withColumn("model", F.lit("gbt"))
    errors = scored.join(test.select("id", *PAIR_SCALARS), "id")
    names = M.feature_names(d, "features")
    imp = M.feature_importance(model, names, spark)
    from cirflow.operators.profile import category_importance
    return {
        "scored": scored,
        "metrics": C.binary_metrics(scored, "model").join(C.roc_auc(scored, "model"), "model"),
        "confusion": C.confusion_matrix(scored, "model"),
        "report": C.classification_report(scored, "model"),
        "roc": C.roc_curve(scored, "model"),
        "errors": C.error_partition(scored, "model"),
        "confidence": C.error_confidence(scored, "model"),
        "importance": imp,
        "categories": category_importance(imp, residual_core=True),
        "threshold_curve": C.threshold_curve(scored, "model"),
        "error_prob_stats": C.error_prob_stats(scored, "model"),
        "error_features": C.error_feature_shift(errors, PAIR_SCALARS),
        "cv_f1": cv_f1,
    }


BASE_SCALARS = CORE_FEATURES + FE.RATIO_FEATURES + FE.SHAPE_FEATURES


def base_matrix(d: DataFrame, cfg: Config) -> tuple[DataFrame, list[str]]:
    """The base set as columns: scalars, shapes and the focus window's samples (148 at the reference's window)."""
    window = [f"CIR{cfg.focus_start + i}" for i in range(cfg.focus_len)]
    d = d.withColumns({c: F.coalesce(F.get("cir", F.lit(cfg.focus_start + i)).cast("double"), F.lit(0.0)) for i, c in enumerate(window)})
    return d, BASE_SCALARS + window


def single_path_models(spark: SparkSession, meas: DataFrame, cfg: Config | None = None) -> dict:
    """Flow B: all base features, split, scaler fit on train, four models with a
    validation-tuned threshold, one comparison table. The boosted model ends by
    patience on the validation rows; the SVM is calibrated over three folds."""
    cfg = cfg or Config()
    d = FE.engineer_features(meas, "cir", cfg.focus_start, cfg.focus_len, engine="vectorized")
    d = SP.group_split(d, cfg.group, cfg.val_size, cfg.test_size, cfg.seed).withColumnRenamed(cfg.label, "y")
    d, cols = base_matrix(d.fillna(0.0, ["CIR_kurtosis", "CIR_skewness"]), cfg)
    d = materialise(spark, d, "base-features")
    scaler = M.PopulationScaler(cols).fit(d.where(F.col("split") == "train"))
    d = materialise(spark, M.assemble(scaler.transform(d), cols, "features").select("id", "y", "split", "features"), "base-matrix")
    train = d.where(F.col("split") == "train")
    weighted = SP.balanced_weight(train, "y")
    n0, n1 = train.agg(F.count_if(F.col("y") == 0), F.count_if(F.col("y") == 1)).first()
    logistic = M.logistic(1.0, float(n0 + n1)).setFeaturesCol("features").setLabelCol("y").setWeightCol("weight").fit(weighted)
    forest = R.fit(train, R.Params(**cfg.forest))
    boosted = B.fit(d.where(F.col("split").isin("train", "val")), B.Params(scale_pos_weight=n0 / max(n1, 1), **cfg.boosted),
                    valid=F.col("split") == "val", patience=cfg.patience)
    folds = materialise(spark, SP.stratified_kfold(train, "y", "id", 3, seed=cfg.seed + 1, out="cal_fold"), "cal-folds")
    svm = V.calibrate(folds, "cal_fold", 3)
    predict = {"random_forest": forest.predict, "boosted": boosted.predict, "svm_platt": svm.predict,
               "logistic": lambda rows, threshold=0.5: M.predict_proba(logistic, rows, ["id", "y"], threshold)}
    scored_all = None
    for name, scores in predict.items():
        t = C.threshold_tune(scores(d.where(F.col("split") == "val"))).first()["threshold"]
        s = scores(d.where(F.col("split") == "test"), threshold=t).withColumn("model", F.lit(name))
        scored_all = s if scored_all is None else scored_all.unionByName(s)
    scored_all = materialise(spark, scored_all, "base-scored")
    comparison = C.model_comparison(scored_all)
    names = cols
    return {"scored": scored_all, "comparison": comparison, "best": C.best_model(comparison),
            "importance": spark.createDataFrame([(n, float(v)) for n, v in zip(names, boosted.importance(), strict=True)], "Feature string, Importance double"),
            "coefficients": svm.coefficients(spark, names), "best_round": boosted.best_round}


REG_SCALARS = [c for c in PAIR_SCALARS if c != "RANGE"]


def range_estimation(spark: SparkSession, meas: DataFrame, cfg: Config | None = None) -> dict:
    """Flow C: one regressor per path, path 2 clipped to >= path 1."""
    cfg = cfg or Config()
    d = SP.group_split(pair_features(meas, cfg), cfg.group, cfg.val_size, cfg.test_size, cfg.seed)
    d = materialise(spark, d, "range-features")
    fit = d.where(F.col("split") == "train") if cfg.impute_fit_on == "train" else d
    d = _vectorise(FE.median_impute(d, ["PEAK2_GAP", "PEAK2_AMP", "PEAK2_IDX"], fit_df=fit), REG_SCALARS,
                   cfg.align_pre + cfg.align_post)
    train, test = d.where(F.col("split") == "train"), d.where(F.col("split") == "test")
    preds = test.select("id", F.col("RANGE").alias("y1"), F.col("RANGE_PATH2_EST").alias("y2"), "features")
    names = M.feature_names(d, "features")
    importances, cv = {}, None
    for target, out in (("RANGE", "p1"), ("RANGE_PATH2_EST", "p2")):
        est = M.boosted_regressor(**cfg.reg)
        if cfg.cv_folds and cfg.reg_cv:
            folds = SP.kfold(train, "id", cfg.cv_folds, seed=cfg.seed + 2, out="cv_fold")
            oof = M.kfold_predictions(folds, "cv_fold", cfg.cv_folds,
                                      M.estimator_fit_predict(M.boosted_regressor(**cfg.reg), "features", target))
            s_ = RG.fold_summary(RG.fold_metrics(oof, "y", "p", "fold")).withColumn("path", F.lit(out))
            cv = s_ if cv is None else cv.unionByName(s_)
        m = est.setFeaturesCol("features").setLabelCol(target).fit(train)
        importances[out] = M.feature_importance(m, names, spark)
        preds = m.transform(preds).withColumnRenamed("prediction", out)
    preds = preds.select("id", "y1", "p1", "y2", "p2")
    long = (preds.select("id", F.lit("path1").alias("path"), F.col("y1").alias("y"), F.col("p1").alias("p"))
            .unionByName(preds.select("id", F.lit("path2").alias("path"), F.col("y2").alias("y"),
                                      monotone_clip("p1", "p2").alias("p"))))
    return {"predictions": preds, "metrics": RG.regression_metrics(long, "y", "p", "path"),
            "clipped": RG.clipped_metrics(preds, "y2", "p1", "p2"),
            "residuals": RG.residual_stats(long, "y", "p", "path"),
            "importance_p1": importances["p1"], "importance_p2": importances["p2"], "cv": cv}
