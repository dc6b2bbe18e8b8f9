"""Feature construction over measurement rows.

A measurement row carries scalar readings and one packed waveform column.
All features are native expressions added with ``withColumns`` (one narrow
projection, no shuffle). Only ``median_impute`` and ``wave_profile`` shuffle,
and both aggregate partially before the exchange.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cirflow.functions import scalars as S
from cirflow.functions import waves as W
from cirflow.operators.quantiles import group_quantiles
from cirflow.session import stored

RATIO_FEATURES = ["FP_AMP_ratio", "SNR_per_acc", "signal_to_noise", "noise_ratio", "FP_power"]
SHAPE_FEATURES = ["CIR_peak", "CIR_peak_idx", "CIR_energy", "CIR_kurtosis", "CIR_skewness",
                  "CIR_rise_time", "CIR_num_peaks"]
PEAK2_FEATURES = ["PEAK2_IDX", "PEAK2_AMP", "PEAK2_FOUND", "PEAK2_GAP"]


def ratio_features(df: DataFrame) -> DataFrame:
    """Guarded ratios and first-path power from the scalar readings."""
    return df.withColumns({
        "FP_AMP_ratio": S.guarded_ratio("FP_AMP1", "FP_AMP2"),
        "SNR_per_acc": S.guarded_ratio("SNR", "RXPACC"),
        "signal_to_noise": S.guarded_ratio("CIR_PWR", "STDEV_NOISE"),
        "noise_ratio": S.guarded_ratio("MAX_NOISE", "STDEV_NOISE"),
        "FP_power": S.sum_squares("FP_AMP1", "FP_AMP2", "FP_AMP3"),
    })


def shape_features(df: DataFrame, wave: str, with_peak: bool = True,
                   prefix: str = "CIR", engine: str = "native") -> DataFrame:
    """Shape statistics of one window column. The window is materialised by
    the caller as its own column, so each statistic reads it once.
    ``engine="vectorized"``: all statistics in one Arrow-batched NumPy pass."""
    names = (["peak", "peak_idx"] if with_peak else []) + ["energy", "kurtosis", "skewness",
                                                           "rise_time", "num_peaks"]
    if engine == "vectorized":
        from cirflow.functions import fast
        df = df.withColumn("_st", fast.shape_stats(wave))
        return df.withColumns({f"{prefix}_{k}": F.col(f"_st.{k}") for k in names}).drop("_st")
    df = df.withColumn("_mom", W.wave_moments(wave))    # shared by kurtosis and skewness
    cols = {
        "peak": W.wave_peak(wave), "peak_idx": W.wave_peak_idx(wave).cast("double"),
        "energy": W.wave_energy(wave),
        "kurtosis": W.kurtosis_from_moments(F.col("_mom")),
        "skewness": W.skewness_from_moments(F.col("_mom")),
        "rise_time": W.wave_rise_time(wave), "num_peaks": W.wave_num_peaks(wave),
    }
    return df.withColumns({f"{prefix}_{k}": cols[k] for k in names}).drop("_mom")


def engineer_features(df: DataFrame, wave: str = "cir", start: int = W.FOCUS_START,
                      length: int = W.FOCUS_LEN, engine: str = "native") -> DataFrame:
    """Base feature set: ratios + shape statistics of the fixed focus window
    (kept as column ``cir_focus``)."""
    df = df.withColumn("cir_focus", W.wave_window(wave, start, length))
    return shape_features(ratio_features(df), "cir_focus", with_peak=True, engine=engine)


def second_path(df: DataFrame, wave: str = "cir", fp: str = "FP_IDX", rng: str = "RANGE",
                start: int = W.FOCUS_START, length: int = W.FOCUS_LEN,
                gap: int = W.MIN_GAP_SAMPLES, height: float = W.PEAK_HEIGHT,
                prominence: float = W.PEAK_PROMINENCE, engine: str = "vectorized") -> DataFrame:
    """Second-path peak (nullable), gap, second range estimate and the
    constant path-2 label. ``engine``: "vectorized" (Arrow-batched NumPy,
    the fast path) or "native" (pure Spark expressions, e.g. for plans that
    must avoid Python workers)."""
    from cirflow.functions import fast
    impl = fast.second_peak if engine == "vectorized" else W.second_peak
    sp = impl(wave, fp, start, length, gap, height, prominence)
    df = df.withColumn("_sp", sp)
    return (df.withColumns({
        "PEAK2_IDX": F.col("_sp.peak2_idx"),
        "PEAK2_AMP": F.col("_sp.peak2_amp"),
        "PEAK2_FOUND": F.col("_sp.peak2_found"),
    }).drop("_sp")
      .withColumn("PEAK2_GAP", S.peak_gap("PEAK2_IDX", fp))
      .withColumn("RANGE_PATH2_EST", S.second_range(rng, "PEAK2_GAP"))
      .withColumn("PATH2_NLOS", F.lit(1)))


def aligned_features(df: DataFrame, wave: str = "cir", fp: str = "FP_IDX",
                     pre: int = W.ALIGN_PRE, post: int = W.ALIGN_POST, engine: str = "native") -> DataFrame:
    """Aligned window ``cir_aligned`` and its 5 shape statistics (no peak /
    peak index: the pair and regression sets leave them out)."""
    df = df.withColumn("cir_aligned", W.wave_align(wave, fp, pre, post))
    return shape_features(df, "cir_aligned", with_peak=False, engine=engine)


def found_rate(df: DataFrame, found: str = "PEAK2_FOUND") -> DataFrame:
    return df.agg(F.count("*").alias("n"),
                  F.sum(found).cast("bigint").alias("n_found"),
                  (F.avg(found) * 100.0).alias("pct_found"))


def fit_medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    """Exact medians of ``cols`` (NULLs ignored), fitted scalars: the columns
    are the groups of one selection."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("x")) for c in cols])).alias("s"))
    got = {r["c"]: r["m"] for r in group_quantiles(long.select("s.c", "s.x"), "x", [0.5], ["c"], names=["m"]).collect()}
    return {c: got.get(c) for c in cols}


def median_impute(df: DataFrame, cols: Sequence[str] = ("PEAK2_GAP", "PEAK2_AMP", "PEAK2_IDX"),
                  fit_df: DataFrame | None = None, rng: str | None = "RANGE",
                  gap: str = "PEAK2_GAP") -> DataFrame:
    """Replace NULLs by the column median of ``fit_df`` (default: ``df``
    itself, the reference's behaviour; pass the train split to avoid
    leakage), then recompute the second-path range from the imputed gap."""
    if fit_df is None:
        df = fit_df = stored(df, "impute")       # the peak search runs once, for the medians and the rows
    med = fit_medians(fit_df, cols)
    df = df.withColumns({c: F.coalesce(F.col(c), F.lit(med[c]).cast("double")) for c in cols})
    if rng is not None and gap in cols:
        df = df.withColumn("RANGE_PATH2_EST", S.second_range(rng, gap))
    return df


def wave_profile(df: DataFrame, wave: str, label: str, base: int = 0) -> DataFrame:
    """Mean amplitude per (label, sample index). Explode is narrow and the
    partial aggregate shrinks it to labels x length before the shuffle."""
    e = df.select(label, F.posexplode(wave).alias("pos", "x"))
    return (e.groupBy(label, (F.col("pos") + base).cast("int").alias("pos"))
             .agg(F.avg("x").alias("mean_amp"), F.count("*").alias("n")))
