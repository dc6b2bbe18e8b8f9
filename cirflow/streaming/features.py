"""Structured Streaming entry points.

The reference has no streaming; its row-level operators (ratios, window
slicing, alignment, shape statistics, second-path search) are stateless, so
the same expressions run unchanged on a streaming DataFrame. A stream of
measurement files becomes a stream of feature rows; the per-class running
profile is a streaming aggregate (complete/update mode).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cirflow.functions import waves as W
from cirflow.operators import features as FE


def read_measurements(spark: SparkSession, path: str, schema: T.StructType | str,
                      fmt: str = "parquet", max_files_per_trigger: int = 64) -> DataFrame:
    return (spark.readStream.schema(schema).format(fmt)
            .option("maxFilesPerTrigger", max_files_per_trigger).load(path))


def feature_stream(df: DataFrame, start: int = W.FOCUS_START, length: int = W.FOCUS_LEN,
                   pre: int = W.ALIGN_PRE, post: int = W.ALIGN_POST, gap: int = W.MIN_GAP_SAMPLES,
                   height: float = W.PEAK_HEIGHT, prominence: float = W.PEAK_PROMINENCE,
                   engine: str = "native") -> DataFrame:
    """Stateless per-row features: ratios, focus-window shape statistics,
    second path and aligned-window statistics (prefixed ``ALN``)."""
    d = FE.engineer_features(df, "cir", start, length)
    d = FE.second_path(d, "cir", "FP_IDX", "RANGE", start, length, gap, height, prominence, engine=engine)
    d = d.withColumn("cir_aligned", W.wave_align("cir", "FP_IDX", pre, post))
    return FE.shape_features(d, "cir_aligned", with_peak=False, prefix="ALN")


def class_profile_stream(features: DataFrame, label: str = "NLOS",
                         cols=("CIR_energy", "PEAK2_GAP", "RANGE")) -> DataFrame:
    """Running per-class count and means (a streaming aggregate)."""
    return features.groupBy(label).agg(F.count("*").alias("n"),
                                       *[F.avg(c).alias(f"mean_{c}") for c in cols])


def start_to_table(df: DataFrame, path: str, checkpoint: str, trigger_once: bool = False):
    """Append feature rows to a Parquet table with exactly-once file sink
    semantics (the checkpoint must be on shared storage)."""
    w = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.outputMode("append").start()
