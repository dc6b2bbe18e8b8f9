"""Scans and sinks.

* Measurement parts are read with an explicit, header-validated schema (no
  inference) and tagged with ``_metadata.file_name``; the 1016 waveform columns are packed
  into one ``array<double>`` right at the scan so later plans carry one
  column (and stay under codegen's field limit).
* Split datasets are written partitioned by ``split`` so reading one split
  is partition pruning, not a filter over everything.
* Result tables and scored predictions are plain Parquet / CSV writes.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

N_SAMPLES = 1016
SCALAR_COLUMNS = ["NLOS", "RANGE", "FP_IDX", "FP_AMP1", "FP_AMP2", "FP_AMP3", "STDEV_NOISE",
                  "CIR_PWR", "MAX_NOISE", "RXPACC", "CH", "FRAME_LEN", "PREAM_LEN", "BITRATE",
                  "PRFR", "SNR", "SNR_dB"]
CORE_FEATURES = ["RANGE", "FP_IDX", "FP_AMP1", "FP_AMP2", "FP_AMP3", "STDEV_NOISE", "CIR_PWR",
                 "MAX_NOISE", "RXPACC", "CH", "FRAME_LEN", "PREAM_LEN", "BITRATE", "PRFR", "SNR",
                 "SNR_dB"]


def measurement_schema(n_samples: int = N_SAMPLES) -> T.StructType:
    fields = [T.StructField("NLOS", T.IntegerType())]
    fields += [T.StructField(c, T.DoubleType()) for c in SCALAR_COLUMNS[1:]]
    fields += [T.StructField(f"CIR{i}", T.DoubleType()) for i in range(n_samples)]
    return T.StructType(fields)


def pack_waveform(df: DataFrame, prefix: str = "CIR", n_samples: int = N_SAMPLES,
                  out: str = "cir") -> DataFrame:
    """CIR0..CIR{n-1} columns -> one array<double> column."""
    wave = [f"{prefix}{i}" for i in range(n_samples)]
    keep = [c for c in df.columns if c not in set(wave)]
    return df.select(*keep, F.array(*[F.col(c).cast("double") for c in wave]).alias(out))


def unpack_waveform(df: DataFrame, wave: str = "cir", prefix: str = "CIR", n_samples: int = N_SAMPLES) -> DataFrame:
    keep = [c for c in df.columns if c != wave]
    return df.select(*keep, *[F.get(F.col(wave), i).alias(f"{prefix}{i}") for i in range(n_samples)])


def _part_name(tag: bool | str) -> Column:
    return F.regexp_extract("_metadata.file_path", "([^/]+)/[^/]+$", 1) if tag == "folder" else F.col("_metadata.file_name")


def scan_parts(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None,
               tag: bool | str = False, pack: bool = True, n_samples: int = N_SAMPLES,
               fmt: str = "csv") -> DataFrame:
    """Read measurement parts, optionally tagged in ``__source_file`` with the
    file name, or (``tag="folder"``) with the name of the folder that holds
    the part's files, waveform packed.

    CSV parts are matched by header *name*: the column order comes from the
    header of the first part (no data is read for it), types from
    ``schema``, and ``enforceSchema=false`` makes Spark check every part's
    header against that order, so a part laid out differently fails instead
    of being misaligned. Column pruning still applies to the CSV parser.
    Other formats are read with the schema directly."""
    schema = schema or measurement_schema(n_samples)
    if fmt == "csv":
        header = spark.read.option("header", True).option("inferSchema", False).csv(paths).columns
        types = {f.name: f.dataType for f in schema.fields}
        missing = [c for c in types if c not in header]
        if missing:
            raise ValueError(f"columns missing from the CSV header: {missing[:10]}")
        file_schema = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in header])
        raw = (spark.read.schema(file_schema).option("header", True).option("enforceSchema", False)
               .csv(paths))
        cols = [F.col(f"`{f.name}`") for f in schema.fields]
        if tag:
            cols.append(_part_name(tag).alias("__source_file"))
        df = raw.select(*cols)
    else:
        df = spark.read.schema(schema).format(fmt).load(paths)
        if tag:
            df = df.withColumn("__source_file", _part_name(tag))
    return pack_waveform(df, n_samples=n_samples) if pack else df


def scan_parts_tagged(spark: SparkSession, paths, **kw) -> DataFrame:
    return scan_parts(spark, paths, tag=True, **kw)


def write_split_dataset(df: DataFrame, path: str, split: str = "split", mode: str = "overwrite") -> str:
    df.write.mode(mode).partitionBy(split).parquet(path)
    return path


def read_split_dataset(spark: SparkSession, path: str, split: str | None = None,
                       split_col: str = "split") -> DataFrame:
    df = spark.read.parquet(path)
    return df.where(F.col(split_col) == split) if split else df


def split_manifest(df: DataFrame, group: str, split: str = "split", seed: int = 42,
                   val_size: float = 0.15, test_size: float = 0.15) -> DataFrame:
    """One row: seed, sizes and row counts per split. The groups of each split
    are a table of their own (``manifest_groups``): their number has no bound."""
    def n(s):
        return F.count_if(F.col(split) == s)

    return df.agg(
        F.lit(seed).alias("random_seed"), F.lit(val_size).alias("val_size"),
        F.lit(test_size).alias("test_size"), F.lit(round(1 - val_size - test_size, 10)).alias("train_size"),
        F.count("*").alias("n_total"), n("train").alias("n_train"), n("val").alias("n_val"), n("test").alias("n_test"))


def manifest_groups(df: DataFrame, group: str, split: str = "split") -> DataFrame:
    """(split, group, n): the groups of each split and their rows."""
    return df.groupBy(split, group).agg(F.count("*").alias("n"))


def write_split_manifest(df: DataFrame, group: str, path: str, split: str = "split", **kw) -> str:
    """``summary`` (one row) as JSON beside ``groups`` as Parquet, partitioned by split."""
    split_manifest(df, group, split, **kw).write.mode("overwrite").json(f"{path}/summary")
    manifest_groups(df, group, split).write.mode("overwrite").partitionBy(split).parquet(f"{path}/groups")
    return path


def write_result_table(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> str:
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
    return path


def read_result_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                      fmt: str = "csv") -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        return r.option("header", True).option("inferSchema", schema is None).csv(path)
    return r.format(fmt).load(path)


def save_predictions(scored: DataFrame, path: str, by: Iterable[str] = ("model",)) -> str:
    """``predictions`` by model, and beside them what plots and reports need:
    ``confusion`` (all four cells a model) and ``roc`` (the curve's points)."""
    from cirflow.operators import classify as C
    cols = [c for c in by if c in scored.columns]
    w = scored.write.mode("overwrite")
    (w.partitionBy(*cols) if cols else w).parquet(f"{path}/predictions")
    saved = scored.sparkSession.read.parquet(f"{path}/predictions")
    C.confusion_matrix(saved, cols).write.mode("overwrite").parquet(f"{path}/confusion")
    C.roc_curve(saved, cols).write.mode("overwrite").parquet(f"{path}/roc")
    return path
