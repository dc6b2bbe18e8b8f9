"""Joins, rankings and top-k over result tables.

Importance / coefficient tables have one row per feature, so their global
windows run on a table bounded by the feature count. Joins of row-level
tables (``attach_split``, ``align_predictions``) are plain equi-joins on
the row key and shuffle on it.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def join_rankings(a: DataFrame, b: DataFrame, on: str = "Feature") -> DataFrame:
    return a.join(b, on, "inner")


def lookup_default_zero(keys: DataFrame, other: DataFrame, on: str = "Feature",
                        value: str = "Importance", out: str = "other") -> DataFrame:
    """For every key row take the other table's value, 0 where it is missing."""
    o = other.select(on, F.col(value).alias(out))
    return keys.join(o, on, "left").withColumn(out, F.coalesce(F.col(out), F.lit(0.0)))


def attach_split(df: DataFrame, split_table: DataFrame, key: str, split: str = "split") -> DataFrame:
    """Reuse another dataset's split assignment by row key (never position)."""
    return df.join(split_table.select(key, split), key, "inner")


def align_predictions(scored: DataFrame, key: str = "id", model: str = "model", p: str = "p",
                      y: str = "y", models: Sequence[str] | None = None) -> DataFrame:
    """Wide table: one row per key with each model's score as a column."""
    g = scored.groupBy(key, y)
    g = g.pivot(model, list(models)) if models else g.pivot(model)
    return g.agg(F.first(p))


def avg_rank(df: DataFrame, score: str, out: str = "rank", by: Sequence[str] = ()) -> DataFrame:
    """Descending rank with ties averaged, truncated to int (the reference
    truncates before it averages two ranks)."""
    w = Window.partitionBy(*by).orderBy(F.desc(score)) if by else Window.orderBy(F.desc(score))
    wt = Window.partitionBy(*by, score) if by else Window.partitionBy(score)
    return df.withColumn(out, F.floor(F.rank().over(w) + (F.count("*").over(wt) - 1) / 2.0).cast("int"))


def rank_agreement(a: DataFrame, b: DataFrame, on: str = "Feature", a_score: str = "a",
                   b_score: str = "b") -> DataFrame:
    """Join two rankings; AvgRank = (rank_a + rank_b) / 2 (ranks truncated
    first); sorted by AvgRank then name."""
    ra = avg_rank(a.select(on, a_score), a_score, "rank_a")
    rb = avg_rank(b.select(on, b_score), b_score, "rank_b")
    j = join_rankings(ra, rb, on)
    return j.withColumn("avg_rank", (F.col("rank_a") + F.col("rank_b")) / 2.0)


def normalise_to_one(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """x / sum(x) over the set; unchanged when the sum is <= 0."""
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    s = F.sum(value).over(w)
    return df.withColumn(value, F.when(s > 0, F.col(value) / s).otherwise(F.col(value)))


def rank_enumerate(df: DataFrame, score: str, name: str = "Feature", out: str = "rank") -> DataFrame:
    """1-based position in descending score order (ties by name)."""
    return df.withColumn(out, F.row_number().over(Window.orderBy(F.desc(score), name)))


def topk(df: DataFrame, score: str, k: int, name: str = "Feature", absolute: bool = False) -> DataFrame:
    """Top k by score (or |score|), ties by name: a TakeOrdered, so each task
    keeps k rows."""
    key = F.abs(F.col(score)) if absolute else F.col(score)
    return df.orderBy(key.desc(), F.col(name)).limit(k)
