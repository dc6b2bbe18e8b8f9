"""Exact grouped quantiles by distributed selection.

A value's 64 bits, signs flipped where needed, order like the value. They are
written once as integers. Each round counts, per group, the values that share
the next 16 bits, among those that agree with a wanted value in the bits known
so far; the running count tells which 16 bits the wanted value has. A round
ends for a wanted rank when all values left are equal: two or three rounds for
most data, four at most, on one path whatever the number of rows. No task holds
a group: a round's state is at most 2^16 counts for each wanted rank, summed on
the map side first.

Quantiles interpolate linearly between the order statistics at floor(h) and
ceil(h), h = (n - 1) q. NULLs are ignored, NaN is above every number, -0.0 is
0.0. NULL groups are groups. A group without values is absent; without groups
the result is one row, NULL if there is no value.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cirflow.session import stored

#: Bits that a round decides.
ROUND_BITS = 16
_LOW = np.int64(0x7FFFFFFFFFFFFFFF)


def _qname(q: float) -> str:
    return "q_" + f"{q:g}".replace(".", "_").replace("-", "m")


def ordered_bits(x: np.ndarray) -> np.ndarray:
    """Integers that order like the doubles."""
    bits = (np.where(np.isnan(x), np.nan, x) + 0.0).view(np.int64)
    return bits ^ ((bits >> 63) & _LOW)


def from_ordered_bits(key: np.ndarray) -> np.ndarray:
    return (key ^ ((key >> 63) & _LOW)).view(np.float64)


def _mapped(df: DataFrame, source: str, out: str, kind: str, of) -> DataFrame:
    """``df`` with column ``source`` replaced by ``out``, a function of its values."""
    rest = [f for f in df.schema.fields if f.name != source]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in rest], f"`{out}` {kind}"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(of(batch.column(len(rest)).to_numpy(zero_copy_only=False)))], names=[*[f.name for f in rest], out])

    return df.select(*[f"`{f.name}`" for f in rest], source).mapInArrow(run, schema)


def _joined(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Inner join in which NULL keys meet; ``b``'s keys are dropped."""
    b = b.withColumnsRenamed({c: f"_r_{c}" for c in cols})
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return a.join(b, cond).drop(*[f"_r_{c}" for c in cols])


def group_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (), names: Sequence[str] | None = None) -> DataFrame:
    """(by..., <name per prob>): exact, linearly interpolated quantiles of ``value``."""
    by, probs = list(by), [float(q) for q in probs]
    names = list(names) if names else [_qname(q) for q in probs]
    groups = [f"_g{i}" for i in range(len(by))]
    rows = df.select(*[F.col(b).alias(g) for b, g in zip(by, groups)], F.col(value).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    keys = stored(_mapped(rows, "_x", "key", "bigint", ordered_bits), "quantile-keys")

    # the wanted ranks of each group: one row for each order statistic
    wanted = keys.groupBy(*groups).agg(F.count("*").alias("n")).where("n > 0")
    ranks = F.array(*[F.struct(F.lit(i).alias("q"), ((F.col("n") - 1) * F.lit(q)).alias("h")) for i, q in enumerate(probs)])
    wanted = wanted.select(*groups, F.explode(ranks).alias("w")).select(*groups, "w.q", "w.h")
    ends = F.explode(F.array_distinct(F.array(F.floor("h"), F.ceil("h")))).alias("rank")
    wanted = stored(wanted.select(*groups, "q", "h", ends), "quantile-ranks")

    state = wanted.select(*groups, "rank").distinct().withColumn("left", F.col("rank")).withColumn("prefix", F.lit(0).cast("bigint"))
    done = None
    for shift in range(64 - ROUND_BITS, -1, -ROUND_BITS):
        prefix = F.shiftright("key", shift + ROUND_BITS) if shift + ROUND_BITS < 64 else F.lit(0).cast("bigint")
        part = keys.withColumn("prefix", prefix)
        if shift + ROUND_BITS < 64:                          # values that agree with a wanted one so far
            part = _joined(part, state.select(*groups, "prefix").distinct(), [*groups, "prefix"])
        counts = part.groupBy(*groups, "prefix", F.shiftright("key", shift).alias("piece")).agg(F.count("*").alias("c"), F.min("key").alias("low"), F.max("key").alias("high"))
        before = Window.partitionBy(*groups, "prefix").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("before", F.coalesce(F.sum("c").over(before), F.lit(0)))
        hit = _joined(state, counts, [*groups, "prefix"]).where((F.col("before") <= F.col("left")) & (F.col("left") < F.col("before") + F.col("c")))
        hit = stored(hit.select(*groups, "rank", (F.col("left") - F.col("before")).alias("left"), F.col("piece").alias("prefix"), "low", "high"), "quantile-round")
        found = hit.where("low = high").select(*groups, "rank", F.col("low").alias("key"))
        done = found if done is None else done.unionAll(found)
        state = hit.where("low < high").select(*groups, "rank", "left", "prefix")
        if state.isEmpty():
            break
    values = _mapped(done.select(*groups, "rank", "key"), "key", "v", "double", from_ordered_bits)
    ends = _joined(wanted, values, [*groups, "rank"]).groupBy(*groups, "q").agg(F.min_by("v", "rank").alias("v0"), F.max_by("v", "rank").alias("v1"), F.first("h").alias("h"))
    at = F.when(F.col("v0") == F.col("v1"), F.col("v0")).otherwise(F.col("v0") + (F.col("v1") - F.col("v0")) * (F.col("h") - F.floor("h")))
    out = ends.groupBy(*groups).agg(*[F.max(F.when(F.col("q") == i, at)).alias(n) for i, n in enumerate(names)])
    return stored(out, "quantiles").withColumnsRenamed(dict(zip(groups, by)))
