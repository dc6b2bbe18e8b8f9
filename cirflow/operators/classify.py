"""Classification evaluation over a scored table.

Input: a long table with a score ``p`` in [0, 1], a true label ``y`` in
{0, 1}, optionally ``pred`` and any grouping columns (``model``). Every
operator takes ``by`` so one pass serves all models.

Nothing here sorts a whole model's rows in one task:

* ranking quantities (ROC, AUC) first group rows by distinct score, then
  cut the (group, score) rows into ranges of the data (``ranged``): each range
  is one window, and the ranges' totals, one row a range and group, give its
  offset. Ranges hold like numbers of rows however close the scores lie;
* threshold sweeps map each score to its threshold index once (exact float
  comparisons against the same threshold values the reference builds) and
  cumulate over <= (thresholds + 1) rows per model.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cirflow.operators.quantiles import group_quantiles
from cirflow.session import stored


def _by(by) -> list[str]:
    return [by] if isinstance(by, str) else list(by or [])


def with_pred(scored: DataFrame, t: float = 0.5, p: str = "p", out: str = "pred") -> DataFrame:
    """pred = 1 iff p >= t (inclusive)."""
    return scored.withColumn(out, (F.col(p) >= t).cast("int"))


def _counts(y: str = "y", pred: str = "pred") -> list[Column]:
    yc, pc = F.col(y), F.col(pred)
    return [F.count_if((yc == 0) & (pc == 0)).alias("tn"), F.count_if((yc == 0) & (pc == 1)).alias("fp"),
            F.count_if((yc == 1) & (pc == 0)).alias("fn"), F.count_if((yc == 1) & (pc == 1)).alias("tp")]


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def _metrics_from_counts(df: DataFrame) -> DataFrame:
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    return df.withColumns({
        "accuracy": _safe_div(tp + tn, n),
        "precision": _safe_div(tp, tp + fp),
        "recall": _safe_div(tp, tp + fn),
        "f1": _safe_div(2 * tp, 2 * tp + fp + fn),
    })


def confusion_counts(scored: DataFrame, by=(), y: str = "y", pred: str = "pred") -> DataFrame:
    return scored.groupBy(*_by(by)).agg(*_counts(y, pred))


def confusion_matrix(scored: DataFrame, by=(), y: str = "y", pred: str = "pred") -> DataFrame:
    """(by..., y, pred, n, pct): all four cells, zero cells included."""
    by = _by(by)
    c = confusion_counts(scored, by, y, pred)
    cells = F.explode(F.array(
        F.struct(F.lit(0).alias("y"), F.lit(0).alias("pred"), F.col("tn").alias("n")),
        F.struct(F.lit(0).alias("y"), F.lit(1).alias("pred"), F.col("fp").alias("n")),
        F.struct(F.lit(1).alias("y"), F.lit(0).alias("pred"), F.col("fn").alias("n")),
        F.struct(F.lit(1).alias("y"), F.lit(1).alias("pred"), F.col("tp").alias("n"))))
    tot = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    return c.select(*by, cells.alias("c"), tot.alias("_t")).select(
        *by, "c.y", "c.pred", "c.n", _safe_div(F.col("c.n") * 100.0, F.col("_t")).alias("pct"))


def binary_metrics(scored: DataFrame, by=(), y: str = "y", pred: str = "pred") -> DataFrame:
    """accuracy, precision, recall, F1 with positive class 1 (0 when undefined)."""
    return _metrics_from_counts(confusion_counts(scored, by, y, pred))


def classification_report(scored: DataFrame, by=(), y: str = "y", pred: str = "pred") -> DataFrame:
    """(by..., label, precision, recall, f1, support) for classes '0', '1',
    and rows 'accuracy', 'macro avg', 'weighted avg'."""
    by = _by(by)
    c = confusion_counts(scored, by, y, pred)
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))

    def prf(t, f_p, f_n):
        pr, rc = _safe_div(t, t + f_p), _safe_div(t, t + f_n)
        return pr, rc, _safe_div(2 * t, 2 * t + f_p + f_n)

    p1, r1, f1 = prf(tp, fp, fn)
    p0, r0, f0 = prf(tn, fn, fp)
    s1, s0 = tp + fn, tn + fp
    n = s0 + s1
    acc = _safe_div(tp + tn, n)

    def row(label, pr, rc, f, s):
        return F.struct(F.lit(label).alias("label"), pr.alias("precision"), rc.alias("recall"),
                        f.alias("f1"), s.cast("bigint").alias("support"))

    rows = F.array(
        row("0", p0, r0, f0, s0), row("1", p1, r1, f1, s1),
        row("accuracy", acc, acc, acc, n),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        row("weighted avg", _safe_div(p0 * s0 + p1 * s1, n), _safe_div(r0 * s0 + r1 * s1, n),
            _safe_div(f0 * s0 + f1 * s1, n), n))
    return c.select(*by, F.explode(rows).alias("r")).select(*by, "r.*")


# ------------------------------------------------------------ ranking (ROC / AUC)
def ranged(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` with ``_part``, the number of the range of ``order`` a row falls in.
    Ranges are cut from the data, hold like numbers of rows, and follow one
    another in the order; written once, so that they stay as they are."""
    return stored(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranged")


def score_cumulative(scored: DataFrame, by=(), y: str = "y", p: str = "p") -> DataFrame:
    """One row per (by..., distinct score): pos, neg at that score, pos_above
    and neg_above (strictly higher scores), group totals tot_pos and tot_neg,
    and is_first / is_last plus the next lower score's (pos, neg).
    The input is aggregated once, by (group, score)."""
    scored, by, const = _group_or_const(scored, by)
    g = scored.groupBy(*by, F.col(p).alias("p")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg"))
    g = ranged(g, *[F.col(b) for b in by], F.desc("p"))
    # totals and top score of each range of a group: groups + ranges rows
    parts = g.groupBy(*by, "_part").agg(F.sum("pos").alias("_spos"), F.sum("neg").alias("_sneg"),
                                        F.max_by(F.struct("pos", "neg"), "p").alias("_head"))
    wp = Window.partitionBy(*by).orderBy("_part")
    before = wp.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    parts = parts.select(
        *by, "_part",
        F.coalesce(F.sum("_spos").over(before), F.lit(0)).alias("_opos"),
        F.coalesce(F.sum("_sneg").over(before), F.lit(0)).alias("_oneg"),
        F.lead("_head").over(wp).alias("_next_head"),
        F.sum("_spos").over(whole).alias("tot_pos"), F.sum("_sneg").over(whole).alias("tot_neg"))
    g = g.join(parts, [*by, "_part"])
    wi = Window.partitionBy(*by, "_part").orderBy(F.desc("p"))
    above = wi.rowsBetween(Window.unboundedPreceding, -1)
    g = g.withColumns({
        "pos_above": (F.col("_opos") + F.coalesce(F.sum("pos").over(above), F.lit(0))).cast("bigint"),
        "neg_above": (F.col("_oneg") + F.coalesce(F.sum("neg").over(above), F.lit(0))).cast("bigint"),
        "_lead": F.lead(F.struct("pos", "neg")).over(wi),
    })
    nxt = F.coalesce(F.col("_lead"), F.col("_next_head"))
    by = [b for b in by if not (const and b == "_g")]
    return g.select(*by, "p", "pos", "neg", "pos_above", "neg_above", "tot_pos", "tot_neg",
                    ((F.col("pos_above") + F.col("neg_above")) == 0).alias("is_first"),
                    nxt.isNull().alias("is_last"),
                    nxt["pos"].alias("next_pos"), nxt["neg"].alias("next_neg"))


def roc_auc(scored: DataFrame, by=(), y: str = "y", p: str = "p") -> DataFrame:
    """Exact ROC AUC; tied scores count one half."""
    return auc_of(score_cumulative(scored, by, y, p), by)


def auc_of(c: DataFrame, by=()) -> DataFrame:
    """ROC AUC from the cumulative table."""
    by = _by(by)
    num = F.sum(F.col("neg") * (F.col("pos_above") + F.col("pos") / 2.0))
    return c.groupBy(*by).agg(
        F.when((F.first("tot_pos") == 0) | (F.first("tot_neg") == 0), F.lit(None).cast("double"))
         .otherwise(num / (F.first("tot_pos").cast("double") * F.first("tot_neg").cast("double"))).alias("auc"))


def roc_curve(scored: DataFrame, by=(), y: str = "y", p: str = "p",
              drop_intermediate: bool = True) -> DataFrame:
    """(by..., threshold, fpr, tpr): one point per distinct score, descending,
    plus the (0, 0) start with a NULL threshold. With ``drop_intermediate``
    interior points collinear with both neighbours are dropped (a point is
    collinear iff the next lower score has the same (pos, neg) counts)."""
    return curve_of(score_cumulative(scored, by, y, p), by, drop_intermediate)


def curve_of(c: DataFrame, by=(), drop_intermediate: bool = True) -> DataFrame:
    """ROC points from the cumulative table."""
    by = _by(by)
    starts = c.where("is_first")
    if drop_intermediate:
        keep = (F.col("is_first") | F.col("is_last")
                | (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg")))
        c = c.where(keep)
    pts = c.select(*by, F.col("p").alias("threshold"),
                   _safe_div((F.col("neg_above") + F.col("neg")).cast("double"), F.col("tot_neg").cast("double")).alias("fpr"),
                   _safe_div((F.col("pos_above") + F.col("pos")).cast("double"), F.col("tot_pos").cast("double")).alias("tpr"))
    start = starts.select(
        *by, F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(pts)


def curve_and_auc(scored: DataFrame, by=(), y: str = "y", p: str = "p") -> DataFrame:
    """ROC points with their group's AUC; one cumulative table feeds both."""
    c = stored(score_cumulative(scored, by, y, p), "cumulative")
    return curve_of(c, by).join(auc_of(c, by), _by(by)) if _by(by) else _attach_scalar_row(curve_of(c), auc_of(c))


def auc_trapezoid(curve: DataFrame, by=(), fpr: str = "fpr", tpr: str = "tpr") -> DataFrame:
    """Trapezoid area under saved (fpr, tpr) points. Points are cut into ranges
    of the data; each point's predecessor is the one before it in its range or,
    for a range's first point, the last point of the group's range before."""
    curve, gb, const = _group_or_const(curve, by)
    d = curve.select(*gb, F.col(fpr).cast("double").alias("_f"), F.col(tpr).cast("double").alias("_t"))
    d = ranged(d, *[F.col(b) for b in gb], F.col("_f"), F.col("_t"))
    pt = F.struct("_f", "_t")
    tails = d.groupBy(*gb, "_part").agg(F.max_by(pt, pt).alias("_tail"))
    tails = tails.select(*gb, "_part", F.lag("_tail").over(Window.partitionBy(*gb).orderBy("_part")).alias("_prev"))
    d = d.join(tails, [*gb, "_part"])
    w = Window.partitionBy(*gb, "_part").orderBy("_f", "_t")
    d = d.withColumns({"_pf": F.coalesce(F.lag("_f").over(w), F.col("_prev._f")),
                       "_pt": F.coalesce(F.lag("_t").over(w), F.col("_prev._t"))})
    out = d.groupBy(*gb).agg(F.sum(F.coalesce((F.col("_f") - F.col("_pf")) * (F.col("_t") + F.col("_pt")) / 2.0,
                                              F.lit(0.0))).alias("auc"))
    return out.drop("_g") if const else out


# ------------------------------------------------------------ threshold sweeps
def _arange_index(p: Column, start: float, step: float, n: int, last: float | None = None) -> Column:
    """Largest i in [0, n) with t_i <= p where t_i = start + i*step (the
    values np.arange / np.linspace produce; t_{n-1} = ``last`` if given);
    -1 if p is below every threshold. Exact: the float estimate is
    corrected against the real threshold values."""
    def t(i: Column) -> Column:
        v = F.lit(start) + i.cast("double") * F.lit(step)
        return v if last is None else F.when(i == n - 1, F.lit(last)).otherwise(v)

    i0 = F.floor((p - F.lit(start)) / F.lit(step)).cast("int")
    i0 = F.least(F.greatest(i0, F.lit(-1)), F.lit(n - 1))
    up = F.least(i0 + 1, F.lit(n - 1))
    dn = F.greatest(i0 - 1, F.lit(-1))
    b = (F.when((up > i0) & (t(up) <= p), up)
          .when((i0 >= 0) & (t(i0) <= p), i0)
          .when((dn >= 0) & (t(dn) <= p), dn)
          .otherwise(F.greatest(dn - 1, F.lit(-1))))
    return b


def _sweep(scored: DataFrame, by: list[str], idx: Column, n: int, y: str) -> DataFrame:
    """Per (by..., threshold index k in [0, n)): tp, fp, fn, tn for
    pred = (index(p) >= k). Rows are first reduced to (group, index)
    counts; every k is added as a zero row, so one descending running sum
    over <= n + 1 rows per group gives the counts at every threshold."""
    counts = scored.groupBy(*by, idx.alias("k")).agg(
        F.count_if(F.col(y) == 1).alias("_pos"), F.count_if(F.col(y) == 0).alias("_neg"))
    grid = counts.select(*by).distinct().select(
        *by, F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("k"),
        F.lit(0).cast("bigint").alias("_pos"), F.lit(0).cast("bigint").alias("_neg"))
    full = counts.unionByName(grid).groupBy(*by, "k").agg(F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"))
    part = Window.partitionBy(*by)
    w = part.orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, 0)
    full = full.withColumns({"tp": F.sum("_pos").over(w), "fp": F.sum("_neg").over(w),
                             "_P": F.sum("_pos").over(part), "_N": F.sum("_neg").over(part)})
    return full.where(F.col("k") >= 0).select(
        *by, "k", "tp", "fp", (F.col("_P") - F.col("tp")).alias("fn"), (F.col("_N") - F.col("fp")).alias("tn"))


def _group_or_const(df: DataFrame, by) -> tuple[DataFrame, list[str], bool]:
    by = _by(by)
    if by:
        return df, by, False
    return df.withColumn("_g", F.lit(0)), ["_g"], True


def threshold_tune(scored: DataFrame, by=(), y: str = "y", p: str = "p",
                   start: float = 0.10, stop: float = 0.91, step: float = 0.01) -> DataFrame:
    """Sweep t = np.arange(start, stop, step) (0.10 ... 0.90: 81 values);
    pick max F1, then max recall, then the lowest t. Returns (by...,
    threshold, f1, recall, precision)."""
    import math
    n = int(math.ceil((stop - start) / step))
    delta = (start + step) - start      # np.arange fills start + i * (t_1 - t_0)
    df, gb, const = _group_or_const(scored, by)
    sw = _metrics_from_counts(_sweep(df, gb, _arange_index(F.col(p), start, delta, n), n, y))
    sw = sw.withColumn("threshold", F.lit(start) + F.col("k").cast("double") * F.lit(delta))
    best = sw.groupBy(*gb).agg(F.max_by(F.struct("threshold", "f1", "recall", "precision"),
                                        F.struct("f1", "recall", -F.col("k"))).alias("b"))
    out = best.select(*gb, "b.*")
    return out.drop("_g") if const else out


def threshold_curve(scored: DataFrame, by=(), y: str = "y", p: str = "p",
                    start: float = 0.05, stop: float = 0.95, num: int = 200) -> DataFrame:
    """np.linspace(start, stop, num) thresholds: (by..., k, threshold, f1,
    precision, recall, accuracy, is_best_f1 (first max), is_near_half
    (first threshold closest to 0.5))."""
    step = (stop - start) / (num - 1)
    df, gb, const = _group_or_const(scored, by)
    sw = _metrics_from_counts(_sweep(df, gb, _arange_index(F.col(p), start, step, num, last=stop), num, y))
    t = F.when(F.col("k") == num - 1, F.lit(stop)).otherwise(F.col("k").cast("double") * F.lit(step) + F.lit(start))
    sw = sw.withColumn("threshold", t)
    part = Window.partitionBy(*gb)
    sw = sw.withColumns({
        "_bk": F.min_by("k", F.struct(-F.col("f1"), F.col("k"))).over(part),
        "_nk": F.min_by("k", F.struct(F.abs(F.col("threshold") - 0.5), F.col("k"))).over(part)})
    out = sw.select(*gb, "k", "threshold", "f1", "precision", "recall", "accuracy",
                    (F.col("k") == F.col("_bk")).alias("is_best_f1"),
                    (F.col("k") == F.col("_nk")).alias("is_near_half"))
    return out.drop("_g") if const else out


# ------------------------------------------------------------ errors
def error_partition(scored: DataFrame, by=(), y: str = "y", pred: str = "pred") -> DataFrame:
    c = confusion_counts(scored, by, y, pred)
    return c.select(*_by(by), (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("n"),
                    (F.col("tn") + F.col("tp")).alias("n_correct"),
                    (F.col("fp") + F.col("fn")).alias("n_wrong"),
                    F.col("fp").alias("n_fp"), F.col("fn").alias("n_fn"))


def error_confidence(scored: DataFrame, by=(), y: str = "y", p: str = "p", pred: str = "pred",
                     near=(0.4, 0.6), confident=(0.2, 0.8), band=(0.3, 0.7)) -> DataFrame:
    """Wrong predictions near the boundary / confidently wrong, in both of
    the reference's definitions (all bounds inclusive):
    * near = near[0] <= p <= near[1]; confident = p <= confident[0] or p >= confident[1]
    * band_near = band[0] <= p <= band[1]; band_outside = wrong - band_near."""
    wrong = F.col(y) != F.col(pred)
    pc = F.col(p)
    g = scored.groupBy(*_by(by)).agg(
        F.count_if(wrong).alias("n_wrong"),
        F.count_if(wrong & (pc >= near[0]) & (pc <= near[1])).alias("n_near"),
        F.count_if(wrong & ((pc <= confident[0]) | (pc >= confident[1]))).alias("n_confident"),
        F.count_if(wrong & (pc >= band[0]) & (pc <= band[1])).alias("n_band_near"))
    d = F.greatest(F.col("n_wrong"), F.lit(1))
    return g.withColumns({
        "n_band_outside": F.col("n_wrong") - F.col("n_band_near"),
        "pct_near": F.col("n_near") * 100.0 / d,
        "pct_confident": F.col("n_confident") * 100.0 / d,
        "pct_band_near": F.col("n_band_near") * 100.0 / d,
        "pct_band_outside": (F.col("n_wrong") - F.col("n_band_near")) * 100.0 / d})


def error_prob_stats(scored: DataFrame, by=(), y: str = "y", p: str = "p", pred: str = "pred") -> DataFrame:
    """Over wrong predictions: mean, exact median, population std, min, max of p."""
    by = _by(by)
    wrong = scored.where(F.col(y) != F.col(pred))
    s = wrong.groupBy(*by).agg(F.count("*").alias("n_wrong"), F.avg(p).alias("mean"),
                               F.stddev_pop(p).alias("std"), F.min(p).alias("min"), F.max(p).alias("max"))
    med = group_quantiles(wrong, p, [0.5], by, names=["median"])
    return s.join(med, by) if by else _attach_scalar_row(s, med)


def _attach_scalar_row(a: DataFrame, b: DataFrame) -> DataFrame:
    """Put the columns of two one-row results side by side."""
    r = b.first()
    return a.withColumns({c: F.lit(r[c] if r is not None else None).cast(t)
                          for c, t in b.dtypes})


def error_feature_shift(df: DataFrame, features: Sequence[str], y: str = "y", pred: str = "pred",
                        normalise: bool = False, eps: float = 1e-10, by=()) -> DataFrame:
    """Per ``by`` group and feature: mean over correct rows, mean over wrong rows and
    effect = |wrong - correct| (``normalise``: / population std of the
    correct rows, 0 when that std <= eps), sorted by effect desc.
    One wide aggregate (no explode); empty if either side is empty."""
    ok = F.col(y) == F.col(pred)
    aggs = [F.count_if(ok).alias("_nc"), F.count_if(~ok).alias("_nw")]
    for i, f in enumerate(features):
        aggs += [F.avg(F.when(ok, F.col(f))).alias(f"c{i}"), F.avg(F.when(~ok, F.col(f))).alias(f"w{i}"),
                 F.stddev_pop(F.when(ok, F.col(f))).alias(f"s{i}")]
    by = _by(by)
    wide = df.groupBy(*by).agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"c{i}").alias("correct_mean"),
                                        F.col(f"w{i}").alias("error_mean"), F.col(f"s{i}").alias("correct_std"))
                               for i, f in enumerate(features)]))
    long = wide.where((F.col("_nc") > 0) & (F.col("_nw") > 0)).select(*by, rows.alias("r")).select(*by, "r.*")
    diff = F.abs(F.col("error_mean") - F.col("correct_mean"))
    eff = F.when(F.col("correct_std") > eps, diff / F.col("correct_std")).otherwise(F.lit(0.0)) if normalise else diff
    return long.withColumn("effect", eff).select(*by, "feature", "effect", "correct_mean", "error_mean")


def error_vector_shift(df: DataFrame, features: str, names: Sequence[str], y: str = "y", pred: str = "pred",
                       normalise: bool = False, eps: float = 1e-10, by=()) -> DataFrame:
    """``error_feature_shift`` for every feature of an array column at once: the
    moments of the whole vector are one map-side aggregate per (group,
    correct), not an expression a feature."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    by = _by(by)
    rows = df.select(*by, (F.col(y) == F.col(pred)).alias("_ok"), array_to_vector(features).alias("_v")).where("_ok is not null")
    g = rows.groupBy(*by, "_ok").agg(Summarizer.metrics("mean", "variance", "count").summary(F.col("_v")).alias("s"))
    g = g.select(*by, "_ok", F.struct(vector_to_array("s.mean").alias("m"), vector_to_array("s.variance").alias("v"), F.col("s.count").alias("n")).alias("s"))
    wide = g.groupBy(*by).agg(F.first(F.when(F.col("_ok"), F.col("s")), ignorenulls=True).alias("c"),
                              F.first(F.when(~F.col("_ok"), F.col("s")), ignorenulls=True).alias("w"))
    cells = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("feature"), F.col("c.m").alias("correct_mean"), F.col("w.m").alias("error_mean"), F.col("c.v").alias("variance"))
    long = wide.where("c is not null and w is not null").select(*by, F.col("c.n").alias("_n"), F.explode(cells).alias("r")).select(*by, "_n", "r.*")
    # the summary's variance divides by n - 1; the effect takes the population's
    std = F.sqrt(F.col("variance") * (F.col("_n") - 1) / F.col("_n"))
    diff = F.abs(F.col("error_mean") - F.col("correct_mean"))
    eff = F.when(std > eps, diff / F.nullif(std, F.lit(0.0))).otherwise(F.lit(0.0)) if normalise else diff
    return long.withColumn("effect", eff).select(*by, "feature", "effect", "correct_mean", "error_mean")


def error_rate_bins(scored: DataFrame, by=(), y: str = "y", p: str = "p", pred: str = "pred",
                    bins: int = 10) -> DataFrame:
    """Bins [e_b, e_{b+1}) with edges np.linspace(0, 1, bins+1); p = 1 is in
    no bin; empty bins are omitted. (by..., bin, label, n, error_rate)."""
    step = 1.0 / bins
    idx = _arange_index(F.col(p), 0.0, step, bins + 1, last=1.0)
    d = scored.where((F.col(p) >= 0.0) & (F.col(p) < 1.0)).withColumn("bin", idx)
    g = d.groupBy(*_by(by), "bin").agg(F.count("*").alias("n"),
                                       F.count_if(F.col(y) != F.col(pred)).alias("_w"))
    lo = F.col("bin").cast("double") * step
    hi = F.when(F.col("bin") + 1 == bins, F.lit(1.0)).otherwise((F.col("bin") + 1).cast("double") * step)
    return g.select(*_by(by), "bin", F.format_string("%.1f-%.1f", lo, hi).alias("label"), "n",
                    (F.col("_w") / F.col("n")).alias("error_rate"))


# ------------------------------------------------------------ model comparison
def model_comparison(scored: DataFrame, model: str = "model", y: str = "y", p: str = "p",
                     pred: str = "pred") -> DataFrame:
    """One row per model: accuracy, precision, recall, f1, auc, nlos_recall
    (= recall of class 1), fn, fp."""
    m = binary_metrics(scored, [model], y, pred)
    a = roc_auc(scored, [model], y, p)
    return m.join(a, model).select(model, "accuracy", "precision", "recall", "f1", "auc",
                                   F.col("recall").alias("nlos_recall"), "fn", "fp")


def metrics_melt(wide: DataFrame, id_col: str = "model", metrics: Sequence[str] | None = None) -> DataFrame:
    metrics = list(metrics or [c for c, t in wide.dtypes if c != id_col and t == "double"])
    return wide.unpivot([id_col], metrics, "metric", "score")


def best_model(comparison: DataFrame, model: str = "model",
               maximise=("f1", "auc", "nlos_recall"), minimise=("fn",)) -> DataFrame:
    """(metric, best_model, value): first model in name order on ties."""
    metrics = [*maximise, *minimise]
    u = metrics_melt(comparison.select(model, *[F.col(m).cast("double").alias(m) for m in metrics]), model, metrics)
    key = F.when(F.col("metric").isin(list(minimise)), -F.col("score")).otherwise(F.col("score"))
    # small table: models x metrics
    w = Window.partitionBy("metric").orderBy(F.desc("_key"), F.col(model))
    return u.withColumn("_key", key).withColumn("_r", F.row_number().over(w)).where("_r = 1").select(
        "metric", F.col(model).alias("best_model"), F.col("score").alias("value"))


def metric_duel(comparison: DataFrame, a: str, b: str, model: str = "model",
                metrics: Sequence[str] = ("accuracy", "precision", "recall", "f1", "auc"),
                tol: float = 1e-3) -> DataFrame:
    """Two models per metric: values, difference and winner ('≈ equal' when
    |a - b| < tol)."""
    long = metrics_melt(comparison.select(model, *[F.col(m).cast("double").alias(m) for m in metrics]),
                        model, list(metrics))
    la = long.where(F.col(model) == a).select("metric", F.col("score").alias("score_a"))
    lb = long.where(F.col(model) == b).select("metric", F.col("score").alias("score_b"))
    j = la.join(lb, "metric")
    d = F.col("score_a") - F.col("score_b")
    return j.withColumns({"diff": d, "winner": F.when(F.abs(d) < tol, F.lit("≈ equal"))
                          .when(d > 0, F.lit(a)).otherwise(F.lit(b))})
