"""Views over the driver tables that stand in for the reference's inputs.

The reference's measurement CSVs are not shipped, so its operators run on
views derived from the given tables (see FIXTURES.md). Every view grows
with its source table; none is a fixed sample.

* ``wave_emb``  embeddings as fixed-length 64-sample waves
* ``wave_user`` event values per user as variable-length waves; each user's
  sequence in time is cut after every ``WAVE_SAMPLES`` samples, so a wave
  depends on that user's events alone and no aggregation group is unbounded
* ``wave_flat`` as ``wave_user`` with coarse values (plateaus, ties)
* ``scored``    three score columns over events, unpivoted (model, id, y, p)
* ``regress``   two regression targets and predictions over lineitem
* ``scalars``   ratio inputs over lineitem (denominator has exact zeros)
* ``groups``    documents with labels, grouped by source
* ``ranks``     two importance tables over part
* ``parts_tagged`` customer + supplier balances tagged with their source
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Samples per user wave (fixed value: the reference's waveform length).
WAVE_SAMPLES = 1016
SEED = 42


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def md5_key(seed: int, key) -> F.Column:
    """Deterministic pseudo-random order key: md5('<seed>|<key>')."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string") if isinstance(key, str) else key.cast("string")))


def md5_int(seed: int, key) -> F.Column:
    """First 8 hex digits of md5(seed|key) as a non-negative bigint."""
    return F.conv(F.substring(md5_key(seed, key), 1, 8), 16, 10).cast("bigint")


def wave_emb(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").alias("id"),
        (F.col("label") >= 5).cast("int").alias("y"),
        (F.col("vec_id") % 64).cast("int").alias("fp"),
        F.col("label").alias("grp"),
        F.transform("embedding", lambda x: F.floor(F.abs(x.cast("double")) * 10000.0) * 1.0).alias("w"))


def _user_waves(spark: SparkSession, sf_dir: str, quantise) -> DataFrame:
    return user_waves(table(spark, sf_dir, "events"), quantise)


def user_waves(ev: DataFrame, quantise) -> DataFrame:
    """Each user's events in (ts, event_id) order, ``WAVE_SAMPLES`` to a wave.

    A row's rank within its user is the number of the user's events in earlier
    hours plus its rank within the hour, so a hot user is not one task."""
    ev = ev.select("user_id", "event_id", "ts", "value", F.date_trunc("hour", "ts").alias("hour"))
    counts = ev.groupBy("user_id", "hour").agg(F.count("*").alias("n"))
    ahead = F.sum("n").over(Window.partitionBy("user_id").orderBy("hour").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(F.col("user_id").alias("u"), F.col("hour").alias("h"), F.coalesce(ahead, F.lit(0)).alias("ahead"))
    rank = F.row_number().over(Window.partitionBy("user_id", "hour").orderBy("ts", "event_id"))
    placed = ev.join(counts, F.col("user_id").eqNullSafe(F.col("u")) & F.col("hour").eqNullSafe(F.col("h")))
    placed = placed.withColumn("seg", F.floor((F.col("ahead") + rank - 1) / WAVE_SAMPLES))
    g = (placed.groupBy("user_id", "seg")
         .agg(F.min("event_id").alias("id"),
              F.array_sort(F.collect_list(F.struct("ts", "event_id", "value"))).alias("tv")))
    return g.select(
        "id",
        (F.col("user_id") % 2).cast("int").alias("y"),
        (F.col("user_id") % 40).cast("int").alias("fp"),
        F.transform("tv", lambda t: quantise(t["value"])).alias("w"))


def wave_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _user_waves(spark, sf_dir, lambda v: F.floor(v * 100.0) * 1.0)


def wave_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _user_waves(spark, sf_dir, lambda v: F.floor(v / 10.0) * 1.0)


SCORED_MODELS = ("m1", "m2", "m3")


def scored_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("id"),
        F.col("event_type").isin("purchase", "signup").cast("int").alias("y"),
        (F.least(F.col("value"), F.lit(100.0)) / 100.0).alias("m1"),
        ((F.col("event_id") * 7919) % 1000 / 1000.0).alias("m2"),
        ((F.col("user_id") % 21) / 20.0).alias("m3"))


#: Features of an event: its value, its user, and readings derived from both.
EVENT_FEATURES = 150


def event_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, features): a vector of ``EVENT_FEATURES`` numbers for each event."""
    readings = F.transform(F.sequence(F.lit(0), F.lit(EVENT_FEATURES - 3)),
                           lambda i: (F.col("event_id") * (i * 2 + 3)) % 1009 / 10.0 + (i % 5) * F.col("value"))
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.concat(F.array("value", F.col("user_id").cast("double")), readings).alias("features"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long scored table (id, y, model, p)."""
    return scored_wide(spark, sf_dir).unpivot(["id", "y"], list(SCORED_MODELS), "model", "p")


def regress(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    y1 = F.floor(F.col("l_extendedprice") / 10.0) * 1.0
    return li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("key"),
        y1.alias("y1"),
        (F.col("l_quantity") * 200.0).alias("p1"),
        (y1 + F.col("l_linenumber") * 100.0).alias("y2"),
        (F.col("l_quantity") * 210.0 - 500.0).alias("p2"))


def scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("k"), F.col("l_quantity").alias("a"),
                     (F.col("l_tax") * 100.0).alias("b"), F.col("l_discount").alias("c"),
                     F.col("l_extendedprice").alias("d"))


def groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return d.join(lab, "doc_id", "left")


def ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return (p.groupBy(F.concat("p_brand", "p_type").alias("f"))
             .agg(F.count("*").cast("double").alias("a"), F.sum("p_size").cast("double").alias("b")))


def parts_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("acctbal"),
        F.lit("customer").alias("__source_file"))
    s = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("acctbal"),
        F.lit("supplier").alias("__source_file"))
    return c.unionByName(s)


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A measurement-shaped table (scalar readings + packed 64-sample wave
    ``cir`` + label ``NLOS`` + group ``__source_file``) derived from the
    embeddings, for running the end-to-end flows. The label is learnable
    (embedding[0] > 0); the seven groups mimic the reference's seven parts."""
    e = table(spark, sf_dir, "embeddings")
    w = F.transform("embedding", lambda x: F.floor(F.abs(x.cast("double")) * 10000.0) * 1.0)
    g = lambda i: F.get(F.col("cir"), i)
    d = e.select(F.col("vec_id").alias("id"), (F.get("embedding", 0) > 0).cast("int").alias("NLOS"),
                 F.col("label"), w.alias("cir"),
                 F.concat(F.lit("part"), (F.col("vec_id") % 7 + 1).cast("string")).alias("__source_file"))
    return d.select(
        "id", "NLOS", "cir", "__source_file",
        (g(2) / 1000.0 + F.col("label")).alias("RANGE"),
        (F.col("id") % 40 + 8).cast("double").alias("FP_IDX"),
        g(3).alias("FP_AMP1"), g(4).alias("FP_AMP2"), g(5).alias("FP_AMP3"),
        g(6).alias("STDEV_NOISE"), g(7).alias("CIR_PWR"), g(8).alias("MAX_NOISE"),
        (g(9) + 1.0).alias("RXPACC"), (F.col("label") % 3 + 1).cast("double").alias("CH"),
        F.lit(128.0).alias("FRAME_LEN"), F.lit(1024.0).alias("PREAM_LEN"),
        F.lit(6800.0).alias("BITRATE"), F.lit(64.0).alias("PRFR"),
        g(10).alias("SNR"), F.log10(g(10) + 1.0).alias("SNR_dB"))
