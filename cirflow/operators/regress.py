"""Regression evaluation. All one-pass grouped aggregates."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cirflow.functions.scalars import monotone_clip
from cirflow.operators.quantiles import group_quantiles


def _by(by) -> list[str]:
    return [by] if isinstance(by, str) else list(by or [])


def regression_metrics(df: DataFrame, y: str, p: str, by=()) -> DataFrame:
    """rmse, mae, r2 = 1 - SSE/SST (SST from the population variance of y)."""
    e = F.col(p) - F.col(y)
    g = df.groupBy(*_by(by)).agg(
        F.count("*").alias("n"), F.sum(e * e).alias("_sse"), F.avg(F.abs(e)).alias("mae"),
        F.var_pop(y).alias("_vy"))
    return g.select(*_by(by), "n", F.sqrt(F.col("_sse") / F.col("n")).alias("rmse"), "mae",
                    (F.lit(1.0) - F.col("_sse") / (F.col("_vy") * F.col("n"))).alias("r2"))


def clipped_metrics(df: DataFrame, y2: str, p1: str, p2: str, by=()) -> DataFrame:
    """Path-2 metrics before and after enforcing p2 >= p1, and the number of
    violations (p2 < p1) -- one aggregate."""
    by = _by(by)
    er = F.col(p2) - F.col(y2)
    ec = monotone_clip(p1, p2) - F.col(y2)
    g = df.groupBy(*by).agg(
        F.count("*").alias("n"), F.sum(er * er).alias("_sr"), F.avg(F.abs(er)).alias("mae_raw"),
        F.sum(ec * ec).alias("_sc"), F.avg(F.abs(ec)).alias("mae_clipped"), F.var_pop(y2).alias("_vy"),
        F.count_if(F.col(p2) < F.col(p1)).alias("n_violations"))
    sst = F.col("_vy") * F.col("n")
    return g.select(*by, "n", F.sqrt(F.col("_sr") / F.col("n")).alias("rmse_raw"), "mae_raw",
                    (F.lit(1.0) - F.col("_sr") / sst).alias("r2_raw"),
                    F.sqrt(F.col("_sc") / F.col("n")).alias("rmse_clipped"), "mae_clipped",
                    (F.lit(1.0) - F.col("_sc") / sst).alias("r2_clipped"), "n_violations")


def residual_stats(df: DataFrame, y: str, p: str, by=()) -> DataFrame:
    """residual = p - y: mean, population std, exact median, share |r| < 0.5
    and < 1.0."""
    by = _by(by)
    d = df.withColumn("_r", F.col(p) - F.col(y))
    s = d.groupBy(*by).agg(F.avg("_r").alias("mean"), F.stddev_pop("_r").alias("std"),
                           F.avg((F.abs("_r") < 0.5).cast("double")).alias("share_lt_0_5"),
                           F.avg((F.abs("_r") < 1.0).cast("double")).alias("share_lt_1_0"))
    med = group_quantiles(d, "_r", [0.5], by, names=["median"])
    if by:
        return s.join(med, by)
    m = med.first()
    return s.withColumn("median", F.lit(m["median"] if m else None).cast("double"))


def actual_vs_predicted(df: DataFrame, y: str, p: str, by=(), key: str | None = None) -> DataFrame:
    """(by..., [key], y, p, lo, hi): the points of the actual-vs-predicted plot,
    each with the shared axis limits of its group."""
    by = _by(by)
    points = df.select(*by, *([key] if key else []), F.col(y).alias("y"), F.col(p).alias("p"))
    limits = points.groupBy(*by).agg(F.least(F.min("y"), F.min("p")).alias("lo"), F.greatest(F.max("y"), F.max("p")).alias("hi"))
    from cirflow.operators.splits import with_class_stats
    return with_class_stats(points, limits, by)


def fold_metrics(df: DataFrame, y: str, p: str, fold: str = "fold", by=()) -> DataFrame:
    return regression_metrics(df, y, p, [*_by(by), fold])


def fold_summary(per_fold: DataFrame, by=(), metrics: Sequence[str] = ("rmse", "mae", "r2")) -> DataFrame:
    """Mean and population std of each metric across folds."""
    aggs = []
    for m in metrics:
        aggs += [F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std")]
    return per_fold.groupBy(*_by(by)).agg(F.count("*").alias("n_folds"), *aggs)


def rank_results(results: DataFrame, path: str = "path") -> DataFrame:
    return results.orderBy(path, "rmse", "mae")


def best_per_path(results: DataFrame, path: str = "path", model: str = "model") -> DataFrame:
    """Lowest-RMSE row per path (results are small: models x paths)."""
    w = Window.partitionBy(path).orderBy("rmse", "mae", model)
    return results.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
