"""Per-class profiles and distribution summaries."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cirflow.operators.quantiles import group_quantiles
from cirflow.operators.splits import with_class_stats


def _by(by) -> list[str]:
    return [by] if isinstance(by, str) else list(by or [])


def class_mean_std(df: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    """(label, feature, mean, std) with the sample (n-1) std, as pandas."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.avg(c).alias(f"m{i}"), F.stddev_samp(c).alias(f"s{i}")]
    wide = df.groupBy(label).agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"m{i}").alias("mean"),
                                        F.col(f"s{i}").alias("std")) for i, c in enumerate(cols)]))
    return wide.select(label, rows.alias("r")).select(label, "r.*")


def column_mean_std(df: DataFrame, cols: Sequence[str], sample: bool = True) -> DataFrame:
    """(feature, mean, std) -- sample std by default, population with
    ``sample=False`` (the scaled-data check)."""
    sd = F.stddev_samp if sample else F.stddev_pop
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.avg(c).alias(f"m{i}"), sd(c).alias(f"s{i}")]
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"m{i}").alias("mean"),
                                        F.col(f"s{i}").alias("std")) for i, c in enumerate(cols)]))
    return df.agg(*aggs).select(rows.alias("r")).select("r.*")


def scaled_check(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return column_mean_std(df, cols, sample=False)


def min_max(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.min(c).cast("double").alias(f"lo{i}"), F.max(c).cast("double").alias(f"hi{i}")]
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"lo{i}").alias("min"),
                                        F.col(f"hi{i}").alias("max")) for i, c in enumerate(cols)]))
    return df.agg(*aggs).select(rows.alias("r")).select("r.*")


def label_correlation(df: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    """(feature, corr) Pearson correlation with the label."""
    wide = df.agg(*[F.corr(F.col(c).cast("double"), F.col(label).cast("double")).alias(f"c{i}")
                    for i, c in enumerate(cols)])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"c{i}").alias("corr"))
                               for i, c in enumerate(cols)]))
    return wide.select(rows.alias("r")).select("r.*")


def histogram(df: DataFrame, value: str, bins: int = 50, by=(), density: bool = False) -> DataFrame:
    """Equal-width bins over each group's own [min, max] (last bin closed;
    a constant group uses [v - 0.5, v + 0.5], as NumPy). (by..., bin, lo,
    hi, n[, density]); empty bins are omitted. Per-group ranges are one row
    per group; without groups the range is a fitted scalar."""
    by = _by(by)
    d = df.select(*by, F.col(value).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    stats = [F.count("*").alias("_n"),
             F.when(F.max("_x") > F.min("_x"), F.min("_x")).otherwise(F.min("_x") - 0.5).alias("_lo"),
             F.when(F.max("_x") > F.min("_x"), F.max("_x")).otherwise(F.max("_x") + 0.5).alias("_hi")]
    if by:
        j = with_class_stats(d, d.groupBy(*by).agg(*stats), by)
    else:
        r = d.agg(*stats).first()          # fitted scalars: count and range
        j = d.select("_x", F.lit(r["_n"]).alias("_n"), F.lit(r["_lo"]).cast("double").alias("_lo"),
                     F.lit(r["_hi"]).cast("double").alias("_hi"))
    b = F.least(F.floor((F.col("_x") - F.col("_lo")) * bins / (F.col("_hi") - F.col("_lo"))),
                F.lit(bins - 1)).cast("int")
    g = j.groupBy(*by, b.alias("bin")).agg(F.count("*").alias("n"), F.first("_lo").alias("_lo"),
                                          F.first("_hi").alias("_hi"), F.first("_n").alias("_n"))
    out = g.select(*by, "bin",
                   (F.col("_lo") + F.col("bin") * (F.col("_hi") - F.col("_lo")) / bins).alias("lo"),
                   (F.col("_lo") + (F.col("bin") + 1) * (F.col("_hi") - F.col("_lo")) / bins).alias("hi"),
                   "n",
                   *([(F.col("n") / (F.col("_n") * ((F.col("_hi") - F.col("_lo")) / bins))).alias("density")]
                     if density else []))
    return out


def class_histogram(df: DataFrame, label: str, value: str, bins: int = 50) -> DataFrame:
    return histogram(df, value, bins, [label], density=True)


def count_histogram(df: DataFrame, value: str, bins: int = 20, by=()) -> DataFrame:
    return histogram(df, value, bins, by, density=False)


def box_stats(df: DataFrame, label: str, value: str, whisker: float = 1.5) -> DataFrame:
    """Per class: q1, median, q3, whiskers (furthest points within
    whisker*IQR of the box) and the outlier count."""
    q = group_quantiles(df, value, [0.25, 0.5, 0.75], [label], names=["q1", "median", "q3"])
    j = with_class_stats(df.select(label, F.col(value).cast("double").alias("_x")).where(F.col("_x").isNotNull()), q, [label])
    iqr = F.col("q3") - F.col("q1")
    lo_f, hi_f = F.col("q1") - whisker * iqr, F.col("q3") + whisker * iqr
    return j.groupBy(label).agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.min(F.when(F.col("_x") >= lo_f, F.col("_x"))).alias("whisker_lo"),
        F.max(F.when(F.col("_x") <= hi_f, F.col("_x"))).alias("whisker_hi"),
        F.count_if((F.col("_x") < lo_f) | (F.col("_x") > hi_f)).alias("n_outliers"))


def sample_per_class(df: DataFrame, label: str, key: str, n: int, seed: int) -> DataFrame:
    """n rows of each class in md5(seed|key) order. The filter on a
    row_number lets Spark keep only n rows per class in each map task before
    the exchange (window group limit), so no class is gathered whole."""
    from cirflow.sources.fixtures import md5_int
    w = Window.partitionBy(label).orderBy(md5_int(seed, key), key)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def sample_views(df: DataFrame, label: str, key: str, wave: str, whole_seeds: Sequence[int] = (42, 43, 44), window_seeds: Sequence[int] = tuple(range(10)),
                 start: int = 0, length: int = 120) -> DataFrame:
    """(label, key, seed, view, wave): one row of each class for each seed, the
    first in md5(seed|key) order, as a whole wave or as its focus window. All
    seeds are one aggregate; a task keeps one row a class and seed."""
    picks = F.explode(F.array(*[F.struct(F.lit(s).alias("seed"), F.lit(v).alias("view")) for v, seeds in (("whole", whole_seeds), ("focus", window_seeds)) for s in seeds]))
    rows = df.select(label, key, wave, picks.alias("p")).select(label, key, wave, "p.seed", "p.view")
    first = rows.groupBy(label, "view", "seed").agg(F.min_by(F.struct(key, wave), F.struct(md5_int_of("seed", key), key)).alias("r"))
    cut = F.when(F.col("view") == "focus", F.slice(f"r.{wave}", start + 1, length)).otherwise(F.col(f"r.{wave}"))
    return first.select(label, f"r.{key}", "seed", "view", cut.alias(wave))


def md5_int_of(seed: str, key: str) -> Column:
    """``md5_int`` for a seed column."""
    return F.conv(F.substring(F.md5(F.concat(F.col(seed).cast("string"), F.lit("|"), F.col(key).cast("string"))), 1, 8), 16, 10).cast("bigint")


def scatter_sample(df: DataFrame, label: str, key: str, x: str, y: str, n: int | None = None,
                   seed: int = 42) -> DataFrame:
    """(label, x, y) point set for a scatter plot: every row, or n per class."""
    points = df.select(key, label, x, y)
    return points if n is None else sample_per_class(points, label, key, n, seed)


def category_importance(imp: DataFrame, feature: str = "Feature", importance: str = "Importance",
                        category_col=None, residual_core: bool = False) -> DataFrame:
    """Sum of importance per category (category by name prefix unless a
    column is given). ``residual_core``: core = max(0, 1 - others), as the
    task-1 report."""
    from cirflow.functions.scalars import name_category, CATEGORY_DEFAULT
    cat = category_col if category_col is not None else name_category(feature)
    g = imp.groupBy(cat.alias("Category")).agg(F.sum(importance).alias("Importance"))
    if not residual_core:
        return g
    others = g.where(F.col("Category") != CATEGORY_DEFAULT)
    # the category table has at most a handful of rows
    total_other = others.agg(F.coalesce(F.sum("Importance"), F.lit(0.0)).alias("t"))
    core = total_other.select(F.lit(CATEGORY_DEFAULT).alias("Category"),
                              F.greatest(F.lit(0.0), F.lit(1.0) - F.col("t")).alias("Importance"))
    return others.unionByName(core)


def coef_sign_counts(coefs: DataFrame, coef: str = "coef") -> DataFrame:
    return coefs.agg(F.count_if(F.col(coef) > 0).alias("n_positive"),
                     F.count_if(F.col(coef) < 0).alias("n_negative"))


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct().orderBy(col)
