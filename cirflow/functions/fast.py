"""Arrow-batched engine for the peak search (``peaks_vec``).

Spark still slices the focus window (JVM side), partitions and schedules
the work; only the per-row peak search runs as a vectorised pandas UDF on
whole Arrow batches. Same results as the native expressions in ``waves``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from cirflow.functions import peaks_vec as PV
from cirflow.functions import waves as W


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def second_peak(w, fp, start: int = W.FOCUS_START, length: int = W.FOCUS_LEN,
                gap: int = W.MIN_GAP_SAMPLES, height: float = W.PEAK_HEIGHT,
                min_prominence: float = W.PEAK_PROMINENCE) -> Column:
    """struct(peak2_idx, peak2_amp, peak2_found) -- as ``waves.second_peak``."""
    @F.pandas_udf("peak2_idx double, peak2_amp double, peak2_found int")
    def _search(focus: pd.Series, f: pd.Series) -> pd.DataFrame:
        return PV.second_peak_batch(focus.to_numpy(), f.to_numpy(dtype=np.float64, na_value=np.nan),
                                    start, gap, height, min_prominence)

    return _search(W.wave_window(w, start, length), _c(fp).cast("double"))


def num_peaks(w, rel_height: float = W.NUM_PEAKS_REL_HEIGHT) -> Column:
    """As ``waves.wave_num_peaks``."""
    @F.pandas_udf("double")
    def _count(x: pd.Series) -> pd.Series:
        return pd.Series(PV.num_peaks_batch(x.to_numpy(), rel_height, W.TINY))

    return _count(_c(w))


def shape_stats(w) -> Column:
    """struct(peak, peak_idx, energy, kurtosis, skewness, rise_time,
    num_peaks) of a window in one Arrow crossing -- as the native builders
    in ``waves`` (sums may differ in the last bits: NumPy sums pairwise)."""
    @F.pandas_udf("peak double, peak_idx double, energy double, kurtosis double, skewness double, "
                  "rise_time double, num_peaks double")
    def _stats(x: pd.Series) -> pd.DataFrame:
        return PV.shape_stats_batch(x.to_numpy(), W.NUM_PEAKS_REL_HEIGHT, W.RISE_LO, W.RISE_HI, W.TINY)

    return _stats(_c(w))


def prominences(w, height: float | None = None) -> Column:
    """array<struct<pos, prominence>> -- as ``waves.wave_prominences``."""
    @F.pandas_udf("array<struct<pos:int, prominence:double>>")
    def _prom(x: pd.Series) -> pd.Series:
        return pd.Series(PV.prominences_batch(x.to_numpy(), height))

    return _prom(_c(w))
