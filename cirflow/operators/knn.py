"""Exact k-nearest-neighbour regression.

A join pruned by pivots and the triangle inequality:

1. a bounded number of pivots is drawn from the train rows by a hash of the id.
   Every row of either side goes to its nearest pivot and, by its distance
   to it, into a ring; rings are cut from the data's quantiles, and one with
   more than ``block_rows`` rows (equal distances) is split by a hash, so that
   blocks are small whatever the data. The driver gets one line a train block:
   pivot, smallest and largest distance, rows;
2. first round: each query row names the nearest rings, by the bound
   |d(q, pivot) - ring|, that hold ``k`` rows. The pairs of blocks named are
   compared; every query row then has an upper bound, its k-th distance;
3. second round: the pairs of blocks that a query row's bound still allows and
   that were not compared yet. All others are provably farther than k rows;
4. per query row the candidates of its pairs are cut to ``k`` (ties by train id)
   and combined into the 1/d-weighted mean (exact hits take all the weight, as
   scikit-learn's ``weights='distance'``).

Only blocks in a named pair are sent, to the pairs they are in. Where the
bounds prune nothing (many dimensions, no clusters) all pairs of blocks are
compared, spread over as many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cirflow.session import stored

#: Rows of a block: each block is sent to every pair it is in, so that larger ones are sent less often.
BLOCK_ROWS = 16_384
#: Pivots at most; numbers of a tile of differences.
PIVOTS, TILE = 64, 4_000_000
_CANDIDATE = "qid long, tid long, d2 double, target double"


def _distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distances, sums of squared differences of each pair, a tile at a time."""
    out = np.empty((len(x), len(points)))
    step = max(1, TILE // max(1, points.size))
    for a in range(0, len(x), step):
        out[a:a + step] = ((x[a:a + step, None, :] - points[None, :, :]) ** 2).sum(axis=2)
    return out


def _nearest_rows(x: np.ndarray, points: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(columns, squared distances) of each row's ``k`` nearest points, ties to the first point.

    Products of matrices give every distance with a bound on its rounding; whatever that bound leaves open is computed
    again as a sum of squared differences, and only those count."""
    k = min(k, len(points))
    middle = points.mean(0)
    x0, p0 = x - middle, points - middle
    xx, pp = np.einsum("ij,ij->i", x0, x0), np.einsum("ij,ij->i", p0, p0)
    # rounding of the centring, the products and the sums, generously
    slack = 8e-16 * (x.shape[1] + 8) * ((np.abs(x).max(1, initial=0) ** 2 + np.abs(points).max(initial=0) ** 2) * x.shape[1] + xx + pp.max(initial=0))
    out_columns, out_d2 = np.empty((len(x), k), np.int64), np.empty((len(x), k))
    step = max(1, TILE // max(1, len(points)))
    for a in range(0, len(x), step):
        b = min(len(x), a + step)
        about = xx[a:b, None] + pp - 2 * (x0[a:b] @ p0.T)
        bound = np.partition(about, k - 1, axis=1)[:, k - 1] + 2 * slack[a:b]
        row, column = np.nonzero(~(about > bound[:, None]))
        d2 = np.empty(len(row))
        for c in range(0, len(row), TILE // max(1, x.shape[1]) + 1):
            e = slice(c, c + TILE // max(1, x.shape[1]) + 1)
            d2[e] = ((x[a + row[e]] - points[column[e]]) ** 2).sum(1)
        order = np.lexsort((column, d2, row))
        first = np.searchsorted(row, np.arange(b - a))
        take = order[first[:, None] + np.arange(k)]
        out_columns[a:b], out_d2[a:b] = column[take], d2[take]
    return out_columns, out_d2


def _matrix(col: pa.Array) -> np.ndarray:
    return np.asarray(col.flatten().to_numpy(zero_copy_only=False), float).reshape(len(col), -1)


def _placed(rows: DataFrame, pivots: np.ndarray, block_rows: int, name: str) -> DataFrame:
    """``rows`` (id, f, ...) with ``block`` and ``r``, the distance to the block's pivot."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)

    def nearest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                d = np.sqrt(_distances(_matrix(batch.column(1)), pivots))
                at = d.argmin(1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at.astype(np.int32)), pa.array(d[np.arange(len(at)), at])], names=[*batch.schema.names, "pivot", "r"])

    rows = stored(rows.mapInArrow(nearest, f"{schema}, pivot int, r double"), f"knn-{name}")
    sizes = {r["pivot"]: r["n"] for r in rows.groupBy("pivot").agg(F.count("*").alias("n")).collect()}      # at most PIVOTS lines
    most = max([math.ceil(n / block_rows) for n in sizes.values()], default=1)
    if most == 1:                                            # every pivot's rows fill one block
        return rows.withColumn("block", F.concat_ws("-", "pivot", F.lit("0-0")))
    cuts = {r["pivot"]: sorted(set(r["c"])) for r in rows.groupBy("pivot").agg(F.percentile_approx("r", F.array(*[F.lit(i / most) for i in range(1, most)]), 10_000).alias("c")).collect()}

    def rings(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pivot, r = np.asarray(batch.column(batch.num_columns - 2)), np.asarray(batch.column(batch.num_columns - 1))
            ring = np.zeros(len(r), np.int32)
            for p in np.unique(pivot).tolist():
                some = pivot == p
                # a pivot's rows are cut into as many rings as they fill blocks
                every = max(1, most // max(1, math.ceil(sizes[p] / block_rows)))
                ring[some] = np.searchsorted(cuts.get(p, [])[every - 1::every], r[some], "left")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ring)], names=[*batch.schema.names, "ring"])

    rows = stored(rows.mapInArrow(rings, f"{schema}, pivot int, r double, ring int"), f"knn-{name}")
    parts = rows.groupBy("pivot", "ring").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("parts"))
    rows = rows.join(parts, ["pivot", "ring"])
    return stored(rows.withColumn("block", F.concat_ws("-", "pivot", "ring", F.pmod(F.xxhash64("id"), "parts"))).drop("parts", "ring"), f"knn-{name}")


def _pairs(queries: DataFrame, pivots: np.ndarray, blocks: list, k: int) -> DataFrame:
    """(qb, tb): the pairs of blocks that query rows name. A row with a bound ``d2`` names every block it may find
    something in; one without, the nearest blocks that hold ``k`` rows."""
    names = np.array([b["block"] for b in blocks])
    at, low, high, n = (np.array([b[c] for b in blocks]) for c in ("pivot", "low", "high", "n"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[str, str]] = set()
        for batch in batches:
            block, f, bound = batch.column(0).to_pylist(), _matrix(batch.column(1)), np.asarray(batch.column(2).to_numpy(zero_copy_only=False), float)
            fresh: set[tuple[str, str]] = set()
            for a in range(0, len(f), 256):
                d = np.sqrt(_distances(f[a:a + 256], pivots))[:, at]
                least = np.maximum(0, np.maximum(d - high, low - d))
                for i in range(len(d)):
                    if np.isnan(bound[a + i]):
                        order = np.lexsort((d[i], least[i]))
                        named = order[:int(np.searchsorted(np.cumsum(n[order]), k)) + 1]
                    else:
                        reach = math.sqrt(bound[a + i])
                        named = np.flatnonzero(least[i] <= reach + 1e-9 * (1 + reach + d[i]))   # rounding never hides a block
                    fresh.update((block[a + i], t) for t in names[named].tolist())
            fresh -= seen
            seen |= fresh
            q, t = zip(*fresh) if fresh else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.string()), pa.array(t, pa.string())], names=["qb", "tb"])

    return queries.mapInArrow(run, "qb string, tb string").distinct()


def _compare(queries: DataFrame, train: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """Each query row's ``k`` nearest train rows of every pair its block is in."""

    def nearest(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(t):
            return pd.DataFrame({"qid": pd.Series([], dtype="int64"), "tid": pd.Series([], dtype="int64"), "d2": pd.Series([], dtype="float64"), "target": pd.Series([], dtype="float64")})
        t = t.sort_values("tid", kind="stable")
        cols, d2 = _nearest_rows(np.stack(q["qf"].to_numpy()).astype(float), np.stack(t["tf"].to_numpy()).astype(float), k)
        rows = np.repeat(np.arange(len(q)), cols.shape[1])            # ties stay in train-id order
        cols, d2 = cols.reshape(-1), d2.reshape(-1)
        return pd.DataFrame({"qid": q["qid"].to_numpy()[rows].astype("int64"), "tid": t["tid"].to_numpy()[cols].astype("int64"),
                             "d2": d2, "target": t["ty"].to_numpy()[cols].astype("float64")})

    q = queries.select(F.col("block").alias("qb"), F.col("id").alias("qid"), F.col("f").alias("qf")).join(pairs, "qb")
    t = train.select(F.col("block").alias("tb"), F.col("id").alias("tid"), F.col("f").alias("tf"), F.col("target").alias("ty")).join(pairs, "tb")
    return q.groupBy("qb", "tb").cogroup(t.groupBy("qb", "tb")).applyInPandas(lambda a, b: nearest(a, b), _CANDIDATE)


def _first(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("qid").orderBy("d2", "tid")
    return found.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k)


def knn_candidates(train: DataFrame, query: DataFrame, k: int, id_col: str = "id", feat: str = "w", target: str = "target", block_rows: int = BLOCK_ROWS,
                   visited: list | None = None) -> DataFrame:
    """(qid, tid, d2, target): the k nearest train rows of every query row (squared Euclidean distance, ties by train
    id). ``visited`` gets the number of pairs of blocks compared and of all pairs."""
    doubles = lambda c: F.transform(c, lambda x: x.cast("double"))
    t = train.select(F.col(id_col).cast("long").alias("id"), doubles(feat).alias("f"), F.col(target).cast("double").alias("target"))
    q = query.select(F.col(id_col).cast("long").alias("id"), doubles(feat).alias("f"))
    # as many pivots as the train rows fill blocks
    drawn = t.select("f", "id").orderBy(F.xxhash64("id"), "id").limit(min(PIVOTS, max(1, math.ceil(t.count() / block_rows)))).collect()
    if not drawn:
        return train.sparkSession.createDataFrame([], _CANDIDATE)
    pivots = np.unique(np.array([r["f"] for r in drawn], float), axis=0)
    t, q = _placed(t, pivots, block_rows, "train"), _placed(q, pivots, block_rows, "query")
    blocks = t.groupBy("block").agg(F.first("pivot").alias("pivot"), F.min("r").alias("low"), F.max("r").alias("high"), F.count("*").alias("n")).collect()
    none = F.lit(None).cast("double")
    first = stored(_pairs(q.select("block", "f", none.alias("d2")), pivots, blocks, k), "knn-pairs")
    found = stored(_first(_compare(q, t, first, k), k), "knn-first")
    bound = found.where(F.col("_r") == k).select(F.col("qid").alias("id"), "d2")
    # a row without k candidates has no bound yet: all blocks
    asked = q.join(bound, "id", "left").select("block", "f", F.coalesce("d2", F.lit(float("inf"))).alias("d2"))
    second = stored(_pairs(asked, pivots, blocks, k).join(first, ["qb", "tb"], "left_anti"), "knn-pairs")
    if visited is not None:
        visited[:] = first.count() + second.count(), len(blocks) * q.select("block").distinct().count()
    rest = _compare(q, t, second, k)
    return _first(found.drop("_r").unionByName(rest), k).drop("_r")


def knn_regress(train: DataFrame, query: DataFrame, k: int = 15, id_col: str = "id", feat: str = "w",
                target: str = "target", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, pred): distance-weighted mean target of the k nearest train rows."""
    c = knn_candidates(train, query, k, id_col, feat, target, block_rows)
    d = F.sqrt("d2")
    g = c.groupBy("qid").agg(
        F.count_if(F.col("d2") == 0).alias("_hits"),
        F.avg(F.when(F.col("d2") == 0, F.col("target"))).alias("_hit_mean"),
        F.sum(F.when(F.col("d2") > 0, F.col("target") / d)).alias("_num"),
        F.sum(F.when(F.col("d2") > 0, F.lit(1.0) / d)).alias("_den"))
    return g.select(F.col("qid").alias(id_col),
                    F.when(F.col("_hits") > 0, F.col("_hit_mean")).otherwise(F.col("_num") / F.col("_den")).alias("pred"))
