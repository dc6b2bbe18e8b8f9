"""Waveform (array<double>) Column builders.

All builders return native Spark expressions (slices and higher-order
functions), so they run inside the JVM on any DataFrame -- batch or
streaming -- with no Python in the data path. Positions are 0-based, as in
the reference.

Spark evaluates a lambda body once per array element and does not hoist
sub-expressions that do not depend on the lambda variable, so every value a
lambda needs (the wave itself, its peak, a peak position) is bound once with
:func:`let` before the element loop.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed values of the reference's processing (must equal the reference).
FOCUS_START = 730          # focus window is samples [730, 850)
FOCUS_LEN = 120
ALIGN_PRE = 30             # aligned window: 30 samples before FP_IDX
ALIGN_POST = 90            # ... and 90 after
MIN_GAP_SAMPLES = 15       # second-path search starts 15 samples after FP
PEAK_PROMINENCE = 30.0     # second-path peak: prominence >= 30
PEAK_HEIGHT = 10.0         # ... and height >= 10
RISE_LO, RISE_HI = 0.1, 0.9
NUM_PEAKS_REL_HEIGHT = 0.3
TINY = 1e-10


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable."""
    return F.get(F.transform(F.array(value), body), 0)


def let2(a: Column, b: Column, body: Callable[[Column, Column], Column]) -> Column:
    return let(F.struct(a.alias("a"), b.alias("b")), lambda s: body(s["a"], s["b"]))


# ---------------------------------------------------------------- slicing
def wave_window(w: ColumnOrName, start: int | Column = FOCUS_START,
                length: int | Column = FOCUS_LEN) -> Column:
    """Half-open window [start, start+length) (shorter if the wave ends)."""
    start_c = start + 1 if isinstance(start, int) else _c(start) + 1
    return F.slice(_c(w), start_c, length)


def wave_align(w: ColumnOrName, fp: ColumnOrName, pre: int = ALIGN_PRE,
               post: int = ALIGN_POST) -> Column:
    """out[k] = w[int(fp) - pre + k] for k in [0, pre+post), 0 outside the wave.

    Built from slices and zero runs (no per-element lambda)."""
    total = pre + post

    def body(s: Column) -> Column:
        w_, f = s["a"], s["b"]
        n = F.size(w_)
        lead = F.least(F.greatest(F.lit(pre) - f, F.lit(0)), F.lit(total))
        src = F.greatest(f - pre, F.lit(0))
        take = F.greatest(F.least(f + post, n) - src, F.lit(0))
        return F.concat(F.array_repeat(F.lit(0.0), lead),
                        F.slice(w_, src + 1, take),
                        F.array_repeat(F.lit(0.0), F.lit(total) - lead - take))

    return let(F.struct(_c(w).alias("a"), _c(fp).cast("int").alias("b")), body)


def wave_normalise(w: ColumnOrName, rxpacc: ColumnOrName) -> Column:
    """Amplitudes divided by the accumulated preamble count (guarded at 1; NULL gives NULLs)."""
    return let(F.when(_c(rxpacc).isNotNull(), F.greatest(_c(rxpacc).cast("double"), F.lit(1.0))),
               lambda d: F.transform(_c(w), lambda x: x / d))


# ---------------------------------------------------------------- scalars of a wave
def wave_peak(w: ColumnOrName) -> Column:
    return F.array_max(_c(w))


def wave_peak_idx(w: ColumnOrName, base: int = 0) -> Column:
    """First index of the maximum; ``base`` turns it into an absolute sample."""
    return let(_c(w), lambda a: (F.array_position(a, F.array_max(a)) - 1 + base).cast("int"))


def wave_energy(w: ColumnOrName) -> Column:
    """Sum of squares."""
    return F.aggregate(_c(w), F.lit(0.0), lambda acc, x: acc + x * x)


def wave_sum(w: ColumnOrName) -> Column:
    """Plain sum (the EDA's 'energy')."""
    return F.aggregate(_c(w), F.lit(0.0), lambda acc, x: acc + x)


def wave_moments(w: ColumnOrName) -> Column:
    """struct(n, m2, m3, m4): population central moments. The mean is bound
    once; deviations and squared deviations are built as arrays (no struct
    accumulator per element), then summed."""
    def body(a: Column) -> Column:
        n = F.size(a)
        return let(F.aggregate(a, F.lit(0.0), lambda t, x: t + x) / n, lambda mean: let(
            F.transform(a, lambda x: x - mean), lambda d: let(
                F.transform(d, lambda x: x * x), lambda d2: F.struct(
                    n.alias("n"),
                    (F.aggregate(d2, F.lit(0.0), lambda t, x: t + x) / n).alias("m2"),
                    (F.aggregate(F.zip_with(d2, d, lambda u, v: u * v), F.lit(0.0), lambda t, x: t + x) / n).alias("m3"),
                    (F.aggregate(d2, F.lit(0.0), lambda t, x: t + x * x) / n).alias("m4")))))
    return let(_c(w), body)


_central_moments = wave_moments


def kurtosis_from_moments(m: Column) -> Column:
    """Population excess kurtosis m4/m2^2 - 3; NULL when m2 = 0."""
    return F.when(m["m2"] > 0, m["m4"] / (m["m2"] * m["m2"]) - 3.0)


def skewness_from_moments(m: Column) -> Column:
    """Population skewness m3/m2^1.5; NULL when m2 = 0."""
    return F.when(m["m2"] > 0, m["m3"] / F.pow(m["m2"], 1.5))


def wave_kurtosis(w: ColumnOrName) -> Column:
    """Population excess kurtosis m4/m2^2 - 3; NULL for a constant wave."""
    return let(wave_moments(w), kurtosis_from_moments)


def wave_skewness(w: ColumnOrName) -> Column:
    """Population skewness m3/m2^1.5; NULL for a constant wave."""
    return let(wave_moments(w), skewness_from_moments)


def wave_rise_time(w: ColumnOrName, lo: float = RISE_LO, hi: float = RISE_HI) -> Column:
    """first index >= hi*peak minus first index >= lo*peak; 0.0 for a
    (near) zero peak."""
    def body(a: Column, pk: Column) -> Column:
        i_hi = F.array_position(F.transform(a, lambda x: x >= pk * hi), True)
        i_lo = F.array_position(F.transform(a, lambda x: x >= pk * lo), True)
        return (F.when(pk < TINY, F.lit(0.0))
                .when((i_hi == 0) | (i_lo == 0), F.lit(0.0))
                .otherwise((i_hi - i_lo).cast("double")))
    return let(_c(w), lambda a: let(F.array_max(a), lambda pk: body(a, pk)))


# ---------------------------------------------------------------- peaks
def _maxima(a: Column) -> Column:
    """Strict local maxima of a bound array (positions, ascending).

    A candidate i rises into its value (a[i-1] < a[i]) and does not rise out
    of it (a[i+1] <= a[i]); a strict one (a[i+1] < a[i]) is a peak at i.
    For a plateau the first later sample that differs, at j, decides: a peak
    at the plateau middle (i + j - 1) div 2 iff a[j] < a[i]; a plateau that
    runs into the last sample never counts, nor do the two end samples.
    Only plateau candidates scan ahead, so the cost is one cheap pass."""
    n = F.size(a)

    def plateau(i: Column) -> Column:
        v = F.get(a, i)
        k = F.array_position(F.transform(F.slice(a, i + 2, F.greatest(n - i - 1, F.lit(0))),
                                         lambda x: x != v), True).cast("int")
        return F.when(k == 0, F.lit(-1)).when(F.get(a, i + k) < v, ((i * 2 + k - 1) / 2).cast("int")) \
                .otherwise(F.lit(-1))

    cand = F.filter(F.sequence(F.lit(1), F.greatest(n - 2, F.lit(1))),
                    lambda i: (i <= n - 2) & (F.get(a, i - 1) < F.get(a, i)) & (F.get(a, i + 1) <= F.get(a, i)))
    pos = F.transform(cand, lambda i: F.when(F.get(a, i + 1) < F.get(a, i), i).otherwise(plateau(i)))
    return F.when(n < 3, F.array().cast("array<int>")).otherwise(
        F.filter(pos, lambda p: p >= 0).cast("array<int>"))


def wave_local_maxima(w: ColumnOrName, height: float | None = None) -> Column:
    """array<int> of local-maximum positions, optionally with w[p] >= height."""
    def body(a: Column) -> Column:
        m = _maxima(a)
        if height is None:
            return m
        return F.filter(m, lambda p: F.get(a, p) >= height)
    return let(_c(w), body)


def _prominence(a: Column, p: Column) -> Column:
    """Topographic prominence of the sample at p inside the bound array a:
    a[p] minus the higher of the two lowest points reached before a strictly
    higher sample (or the array end) on each side. A side whose maximum is
    not higher than a[p] needs no scan (its base is the array end)."""
    def body(v: Column) -> Column:
        n = F.size(a)
        left = F.slice(a, 1, p)                                             # a[0 .. p-1]
        right = F.slice(a, p + 2, F.greatest(n - p - 1, F.lit(0)))          # a[p+1 .. n-1]
        lb = F.when(F.coalesce(F.array_max(left), v) <= v, F.lit(-1)).otherwise(
            F.array_max(F.transform(left, lambda x, j: F.when(x > v, j).otherwise(F.lit(-1)))))
        rb = F.when(F.coalesce(F.array_max(right), v) <= v, n).otherwise(
            F.array_min(F.transform(right, lambda x, j: F.when(x > v, j + p + 1).otherwise(n))))
        return let2(lb, rb, lambda l_, r_: v - F.greatest(
            F.array_min(F.slice(a, l_ + 2, p - l_)), F.array_min(F.slice(a, p + 1, r_ - p))))
    return let(F.get(a, p), body)


def wave_prominences(w: ColumnOrName, height: float | None = None) -> Column:
    """array<struct<pos:int, prominence:double>> for every local maximum."""
    def body(a: Column) -> Column:
        m = _maxima(a)
        if height is not None:
            m = F.filter(m, lambda p: F.get(a, p) >= height)
        return F.transform(m, lambda p: F.struct(p.alias("pos"), _prominence(a, p).alias("prominence")))
    return let(_c(w), body)


def wave_num_peaks(w: ColumnOrName, rel_height: float = NUM_PEAKS_REL_HEIGHT) -> Column:
    """Number of local maxima with w[p] >= rel_height * peak; 0.0 if the
    peak is (near) zero."""
    def body(a: Column, pk: Column) -> Column:
        return F.when(pk < TINY, F.lit(0.0)).otherwise(
            F.size(F.filter(_maxima(a), lambda p: F.get(a, p) >= pk * rel_height)).cast("double"))
    return let(_c(w), lambda a: let(F.array_max(a), lambda pk: body(a, pk)))


def second_peak(w: ColumnOrName, fp: ColumnOrName, start: int = FOCUS_START,
                length: int = FOCUS_LEN, gap: int = MIN_GAP_SAMPLES,
                height: float = PEAK_HEIGHT, min_prominence: float = PEAK_PROMINENCE) -> Column:
    """struct(peak2_idx double, peak2_amp double, peak2_found int).

    Search window = focus window from clip(int(fp) - start + gap, 0, L-1)
    to its end; nothing is searched when that start is the last sample.
    Among maxima with height >= ``height`` and prominence (measured inside
    the search window) >= ``min_prominence`` take the most prominent, the
    first one on ties. idx is absolute (start + offset)."""
    def search(sw: Column, s: Column) -> Column:
        cands = F.transform(
            F.filter(_maxima(sw), lambda p: F.get(sw, p) >= height),
            lambda p: F.struct(_prominence(sw, p).alias("prom"), (-p).alias("neg"), p.alias("pos")))
        best = F.array_max(F.filter(cands, lambda c: c["prom"] >= min_prominence))
        return let(best, lambda b: F.struct(
            (F.lit(start) + s + b["pos"]).cast("double").alias("peak2_idx"),
            F.get(sw, b["pos"]).alias("peak2_amp"),
            F.when(b.isNull(), F.lit(0)).otherwise(F.lit(1)).alias("peak2_found")))

    def body(focus: Column, f: Column) -> Column:
        n = F.size(focus)
        s = F.least(F.greatest(f - start + gap, F.lit(0)), n - 1)
        none = F.struct(F.lit(None).cast("double").alias("peak2_idx"),
                        F.lit(None).cast("double").alias("peak2_amp"),
                        F.lit(0).alias("peak2_found"))
        return let(s, lambda s_: F.when(s_ >= n - 1, none).otherwise(
            let(F.slice(focus, s_ + 1, F.greatest(n - s_, F.lit(0))), lambda sw: search(sw, s_))))

    return let2(wave_window(w, start, length), _c(fp).cast("int"), body)
