"""Spark ML training, scoring and model summaries.

Feature vectors come from ``VectorAssembler`` / ``array_to_vector``; all
fits are Spark ML estimators (distributed tree aggregation / L-BFGS), and
scoring is ``model.transform`` -- a narrow projection.
"""

from __future__ import annotations

import random
from typing import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC,
                                       LogisticRegression, RandomForestClassifier)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cirflow.session import scratch_path, stored


# ------------------------------------------------------------ scaler
class PopulationScaler:
    """z-score with the population std (n), fitted on one DataFrame (the
    train split). A column constant in the fit data is only centred.
    Spark ML's StandardScaler uses n - 1, hence this small class."""

    def __init__(self, cols: Sequence[str], suffix: str = ""):
        self.cols = list(cols)
        self.suffix = suffix
        self.params: dict[str, tuple[float, float]] = {}

    def fit(self, df: DataFrame) -> "PopulationScaler":
        aggs = []
        for i, c in enumerate(self.cols):
            aggs += [F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}")]
        row = df.agg(*aggs).first()   # one row of fitted scalars
        self.params = {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(self.cols)}
        return self

    def stats(self, spark) -> DataFrame:
        return spark.createDataFrame([(c, float(m), float(s)) for c, (m, s) in self.params.items()],
                                     "feature string, mean double, std double")

    def transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for c, (m, s) in self.params.items():
            x = F.col(c) - F.lit(m)
            out[c + self.suffix] = x / F.lit(s) if s and s > 0 else x
        return df.withColumns(out)


# ------------------------------------------------------------ features
def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Dense feature vector from named numeric columns (names kept in the
    vector's ML attribute metadata)."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def feature_names(df: DataFrame, col: str = "features") -> list[str]:
    meta = df.schema[col].metadata.get("ml_attr", {})
    attrs = meta.get("attrs", {})
    names = sorted([a for group in attrs.values() for a in group], key=lambda a: a["idx"])
    n = meta.get("num_attrs") or len(names)
    return [a["name"] for a in names] if names else [f"f{i}" for i in range(n)]


# ------------------------------------------------------------ estimators
def boosted_classifier(max_iter: int = 200, max_depth: int = 6, step: float = 0.1,
                       subsample: float = 0.8, feature_subset: str = "0.8", min_instances: int = 1,
                       weight_col: str | None = None, seed: int = 42, max_bins: int = 256,
                       validation_col: str | None = None, validation_tol: float = 0.01) -> GBTClassifier:
    g = GBTClassifier(maxIter=max_iter, maxDepth=max_depth, stepSize=step, subsamplingRate=subsample,
                      featureSubsetStrategy=feature_subset, minInstancesPerNode=min_instances,
                      seed=seed, maxBins=max_bins, lossType="logistic", validationTol=validation_tol)
    if weight_col:
        g.setWeightCol(weight_col)
    if validation_col:
        g.setValidationIndicatorCol(validation_col)
    return g


def random_forest(num_trees: int = 200, max_depth: int = 12, feature_subset: str = "sqrt",
                  weight_col: str | None = None, seed: int = 42) -> RandomForestClassifier:
    rf = RandomForestClassifier(numTrees=num_trees, maxDepth=min(max_depth, 30),
                                featureSubsetStrategy=feature_subset, seed=seed)
    if weight_col:
        rf.setWeightCol(weight_col)
    return rf


def logistic(c: float = 1.0, weight_sum: float = 1.0, weight_col: str | None = None,
             max_iter: int = 100) -> LogisticRegression:
    """L2 logistic regression; sklearn's C sums losses, Spark averages by
    weight: regParam = 1 / (C * sum(w))."""
    lr = LogisticRegression(regParam=1.0 / (c * weight_sum), elasticNetParam=0.0,
                            standardization=False, maxIter=max_iter)
    if weight_col:
        lr.setWeightCol(weight_col)
    return lr


def linear_svm(c: float = 1.0, weight_sum: float = 1.0, weight_col: str | None = None,
               max_iter: int = 100) -> LinearSVC:
    svm = LinearSVC(regParam=1.0 / (c * weight_sum), standardization=False, maxIter=max_iter)
    if weight_col:
        svm.setWeightCol(weight_col)
    return svm


def decision_tree(max_depth: int = 4, weight_col: str | None = None, seed: int = 42) -> DecisionTreeClassifier:
    dt = DecisionTreeClassifier(maxDepth=max_depth, seed=seed)
    if weight_col:
        dt.setWeightCol(weight_col)
    return dt


def boosted_regressor(max_iter: int = 1200, max_depth: int = 8, step: float = 0.015,
                      subsample: float = 0.8, seed: int = 42, max_bins: int = 256) -> GBTRegressor:
    return GBTRegressor(maxIter=max_iter, maxDepth=max_depth, stepSize=step, subsamplingRate=subsample,
                        seed=seed, maxBins=max_bins, lossType="squared")


def rf_regressor(num_trees: int = 100, max_depth: int = 12, seed: int = 42) -> RandomForestRegressor:
    return RandomForestRegressor(numTrees=num_trees, maxDepth=min(max_depth, 30), seed=seed)


# ------------------------------------------------------------ scoring / summaries
def predict_proba(model, df: DataFrame, keep: Sequence[str] = ("id", "y"), threshold: float = 0.5) -> DataFrame:
    """(keep..., p, pred): P(class 1) from probability or a sigmoid of the
    raw margin for models without probabilities (LinearSVC)."""
    out = model.transform(df)
    if "probability" in out.columns:
        p = vector_to_array("probability")[1]
    else:
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-vector_to_array("rawPrediction")[1]))
    return out.select(*keep, p.alias("p")).withColumn("pred", (F.col("p") >= threshold).cast("int"))


def predict(model, df: DataFrame, keep: Sequence[str] = ("id",), out: str = "pred") -> DataFrame:
    return model.transform(df).select(*keep, F.col("prediction").alias(out))


def feature_importance(model, names: Sequence[str], spark) -> DataFrame:
    """(Feature, Importance) sorted desc (one row per feature)."""
    imp = model.featureImportances.toArray().tolist()
    rows = [(n, float(v)) for n, v in zip(names, imp)]
    return spark.createDataFrame(rows, "Feature string, Importance double").orderBy(
        F.desc("Importance"), "Feature")


def coefficients(model, names: Sequence[str], spark) -> DataFrame:
    """(Feature, coef, abs_coef) sorted by |coef| desc."""
    cs = model.coefficients.toArray().tolist()
    rows = [(n, float(v), abs(float(v))) for n, v in zip(names, cs)]
    return spark.createDataFrame(rows, "Feature string, coef double, abs_coef double").orderBy(
        F.desc("abs_coef"), "Feature")


def tree_rules(model, names: Sequence[str], spark) -> DataFrame:
    """(rule, conditions, condition, class, support, gini): one row a leaf, the
    saved node table walked from the leaves to the root. ``condition`` is a
    filter on columns of those names; each row of data meets exactly one rule."""
    path = scratch_path(spark, "tree")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    name = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("split.featureIndex") + 1)
    test = lambda sign: F.concat_ws(" ", F.concat(F.lit("`"), name, F.lit("`")), F.lit(sign), F.col("split.leftCategoriesOrThreshold")[0].cast("string"))
    up = nodes.where("leftChild >= 0").select(F.col("id").alias("parent"), F.explode(F.array(
        F.struct(F.col("leftChild").alias("child"), test("<=").alias("test")), F.struct(F.col("rightChild").alias("child"), test(">").alias("test")))).alias("e")).select("parent", "e.*")
    up = stored(up, "tree-edges")
    rules = nodes.where("leftChild < 0").select(F.col("id").alias("rule"), F.col("id").alias("at"), F.array().cast("array<string>").alias("conditions"),
                                                F.col("prediction").cast("int").alias("class"), F.col("rawCount").alias("support"), F.col("impurity").alias("gini"))
    for _ in range(model.depth):                             # one step towards the root for every leaf
        rules = rules.join(up, F.col("at") == F.col("child"), "left").select(
            "rule", F.coalesce("parent", "at").alias("at"), F.when(F.col("test").isNull(), F.col("conditions")).otherwise(F.concat(F.array("test"), "conditions")).alias("conditions"),
            "class", "support", "gini")
    condition = F.when(F.size("conditions") == 0, F.lit("true")).otherwise(F.array_join("conditions", " AND "))
    return rules.select("rule", "conditions", condition.alias("condition"), "class", "support", "gini")


# ------------------------------------------------------------ calibration
def platt_calibrate(df: DataFrame, features: str, label: str, fold: str, make_svm,
                    k: int = 3) -> tuple[list, list]:
    """Calibrated linear SVM: for each fold, fit the SVM on the other folds
    and a one-feature logistic sigmoid on the held-out fold's margins, with
    sklearn's smoothed targets ((n+ + 1)/(n+ + 2), 1/(n- + 2)) emulated by
    two weighted copies per row. Returns [(svm, sigmoid)] per fold; scores
    are averaged by ``platt_score``."""
    pairs = []
    for i in range(k):
        train = df.where(F.col(fold) != i)
        hold = df.where(F.col(fold) == i)
        svm = make_svm().setFeaturesCol(features).setLabelCol(label).fit(train)
        m = svm.transform(hold).select(label, vector_to_array("rawPrediction")[1].alias("margin"))
        cnt = m.agg(F.count_if(F.col(label) == 1).alias("np"), F.count_if(F.col(label) == 0).alias("nn")).first()
        t_pos = (cnt["np"] + 1.0) / (cnt["np"] + 2.0)
        t_neg = 1.0 / (cnt["nn"] + 2.0)
        tgt = F.when(F.col(label) == 1, F.lit(t_pos)).otherwise(F.lit(t_neg))
        two = m.withColumn("t", tgt).select("margin", F.explode(F.array(
            F.struct(F.lit(1.0).alias("lab"), F.col("t").alias("w")),
            F.struct(F.lit(0.0).alias("lab"), (F.lit(1.0) - F.col("t")).alias("w")))).alias("c"))
        two = assemble(two.select("margin", "c.lab", "c.w"), ["margin"], "mf")
        sig = LogisticRegression(featuresCol="mf", labelCol="lab", weightCol="w", regParam=0.0,
                                 standardization=False).fit(two)
        pairs.append((svm, sig))
    return pairs


def platt_score(pairs, df: DataFrame, features: str, keep: Sequence[str] = ("id", "y")) -> DataFrame:
    """Average of the fold sigmoids' P(1) -- a narrow projection per fold
    model, combined in one select."""
    probs = []
    for i, (svm, sig) in enumerate(pairs):
        a, b = float(sig.coefficients[0]), float(sig.intercept)
        margin = F.aggregate(
            F.zip_with(vector_to_array(features), F.array(*[F.lit(float(v)) for v in svm.coefficients]),
                       lambda x, w: x * w), F.lit(float(svm.intercept)), lambda acc, v: acc + v)
        probs.append(F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(a) * margin + F.lit(b)))))
    avg = probs[0]
    for p in probs[1:]:
        avg = avg + p
    return df.select(*keep, (avg / len(probs)).alias("p")).withColumn("pred", (F.col("p") >= 0.5).cast("int"))


# ------------------------------------------------------------ search / CV
def sample_grid(grid: dict[str, list], n: int, seed: int = 42) -> list[dict]:
    """n random draws (without repeats when possible) from a parameter grid."""
    import itertools
    keys = list(grid)
    combos = list(itertools.product(*[grid[k] for k in keys]))
    rng = random.Random(seed)
    picks = rng.sample(combos, min(n, len(combos)))
    return [dict(zip(keys, c)) for c in picks]


def random_search_cv(estimator, grid: dict[str, list], df: DataFrame, n_iter: int, fold_col: str,
                     parallelism: int = 4, seed: int = 42):
    """CrossValidator over ``n_iter`` sampled parameter maps, user folds
    (``foldCol``), maximising F1 of class 1."""
    maps = []
    for d in sample_grid(grid, n_iter, seed):
        maps.append({estimator.getParam(k): v for k, v in d.items()})
    ev = MulticlassClassificationEvaluator(labelCol=estimator.getLabelCol(), metricName="fMeasureByLabel",
                                           metricLabel=1.0)
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=maps, evaluator=ev,
                        foldCol=fold_col, parallelism=parallelism, seed=seed)
    return cv.fit(df)


def cv_score(estimator, df: DataFrame, fold_col: str, parallelism: int = 2) -> float:
    ev = MulticlassClassificationEvaluator(labelCol=estimator.getLabelCol(), metricName="fMeasureByLabel",
                                           metricLabel=1.0)
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=[{}], evaluator=ev, foldCol=fold_col,
                        parallelism=parallelism)
    return float(cv.fit(df).avgMetrics[0])


def save_model(model, path: str) -> str:
    model.write().overwrite().save(path)
    return path


__all__ = ["PopulationScaler", "assemble", "tree_rules", "boosted_classifier", "random_forest",
           "logistic", "linear_svm", "decision_tree", "boosted_regressor", "rf_regressor",
           "predict_proba", "feature_importance", "coefficients", "platt_calibrate", "platt_score",
           "random_search_cv", "cv_score", "Pipeline", "PipelineModel"]


# ------------------------------------------------------------ k-fold regression
def kfold_predictions(df: DataFrame, fold_col: str, k: int, fit_predict) -> DataFrame:
    """Out-of-fold predictions: for each fold f, ``fit_predict(train, held)``
    is fitted on the other folds and returns (id, y, p) for fold f. The k
    fits are separate distributed jobs; the result is one long table."""
    out = None
    for f in range(k):
        part = fit_predict(df.where(F.col(fold_col) != f), df.where(F.col(fold_col) == f)) \
            .withColumn("fold", F.lit(f))
        out = part if out is None else out.unionByName(part)
    return out


def knn_fit_predict(feature_cols: Sequence[str], label: str, k: int = 15, id_col: str = "id"):
    """KNN regression whose population scaler is fitted on the training
    folds only (as the reference does inside each fold)."""
    from cirflow.operators.knn import knn_regress

    def run(train: DataFrame, held: DataFrame) -> DataFrame:
        sc = PopulationScaler(feature_cols).fit(train)
        to_arr = F.array(*[F.col(c).cast("double") for c in feature_cols])
        tr = sc.transform(train).select(id_col, to_arr.alias("_w"), F.col(label).alias("_t"))
        te = sc.transform(held).select(id_col, to_arr.alias("_w"))
        pred = knn_regress(tr, te, k, id_col, "_w", "_t")
        return held.select(id_col, F.col(label).alias("y")).join(pred.withColumnRenamed("pred", "p"), id_col)
    return run


def estimator_fit_predict(estimator, features: str, label: str, id_col: str = "id"):
    def run(train: DataFrame, held: DataFrame) -> DataFrame:
        m = estimator.setFeaturesCol(features).setLabelCol(label).fit(train)
        return m.transform(held).select(id_col, F.col(label).alias("y"), F.col("prediction").alias("p"))
    return run
