"""Row-level scalar Column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed values of the reference (must equal the reference).
RATIO_FLOOR = 1e-10
SPEED_OF_LIGHT = 3e8           # m/s
SAMPLE_PERIOD_NS = 1.0016      # ns per waveform sample
METERS_PER_SAMPLE = SPEED_OF_LIGHT * SAMPLE_PERIOD_NS * 1e-9 / 2   # two-way time of flight
CATEGORY_PREFIXES = (("PEAK2", "Second Path"), ("CIR", "CIR Waveform"))
CATEGORY_DEFAULT = "Core Features"


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def guarded_ratio(a: ColumnOrName, b: ColumnOrName, floor: float = RATIO_FLOOR) -> Column:
    """a / max(b, floor): never divides by zero (ANSI mode raises on /0); a NULL b gives NULL."""
    return _c(a) / F.when(_c(b).isNotNull(), F.greatest(_c(b), F.lit(floor)))


def sum_squares(*cols: ColumnOrName) -> Column:
    out = None
    for c in cols:
        t = _c(c) * _c(c)
        out = t if out is None else out + t
    return out


def peak_gap(peak2_idx: ColumnOrName, fp_idx: ColumnOrName) -> Column:
    return _c(peak2_idx) - _c(fp_idx)


def second_range(rng: ColumnOrName, gap: ColumnOrName,
                 meters_per_sample: float = METERS_PER_SAMPLE) -> Column:
    """Second-path range = first-path range + gap * metres per sample."""
    return _c(rng) + _c(gap) * meters_per_sample


def column_index_parse(name: ColumnOrName, prefix: str = "CIR") -> Column:
    """'CIR745' -> 745 (NULL if the name is not prefix + digits)."""
    return F.regexp_extract(_c(name), f"^{prefix}([0-9]+)$", 1).try_cast("int")


def name_category(name: ColumnOrName, prefixes=CATEGORY_PREFIXES,
                  default: str = CATEGORY_DEFAULT) -> Column:
    """Category of a feature by name prefix; first matching prefix wins."""
    n = _c(name)
    out = None
    for pfx, cat in prefixes:
        cond = n.startswith(pfx)
        out = F.when(cond, F.lit(cat)) if out is None else out.when(cond, F.lit(cat))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def monotone_clip(p1: ColumnOrName, p2: ColumnOrName) -> Column:
    """p2 := max(p2, p1) (path 2 is never shorter than path 1); NULL if either is."""
    return F.when(_c(p1).isNotNull() & _c(p2).isNotNull(), F.greatest(_c(p2), _c(p1)))


def threshold_predict(p: ColumnOrName, t: float | Column = 0.5) -> Column:
    """Inclusive: pred = 1 iff p >= t."""
    return (_c(p) >= t).cast("int")
