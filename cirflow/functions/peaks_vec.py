"""Vectorised peak search for Arrow batches (the fast engine).

The native array expressions in ``waves`` evaluate one lambda call per
sample and per peak; for the second-path search over millions of waves
that interpreted loop dominates. Here a whole Arrow batch of windows is one
NumPy matrix and every step is a whole-matrix operation:

* local maxima: for each rise into position i, the first later non-zero
  difference (a reverse running minimum over indices) decides whether the
  plateau starting at i ends in a fall; the peak sits at the plateau
  middle;
* prominence: for each peak, masked max / min over its row find the nearest
  strictly higher sample on each side and the lowest point in between.

Semantics equal the native expressions (and SciPy's ``find_peaks`` /
``peak_prominences`` with the window as the whole signal); tests check both
engines against each other and a plain-Python reference.
"""

from __future__ import annotations

import numpy as np
import pandas as pd

CHUNK_ROWS = 512          # rows per NumPy step: bounds the (peaks x length) matrices


def to_matrix(arrs) -> tuple[np.ndarray, np.ndarray]:
    """Ragged 1-D arrays -> (B, L) float64 matrix padded with NaN, lengths."""
    n = len(arrs)
    lens = np.fromiter((0 if a is None else len(a) for a in arrs), dtype=np.int64, count=n)
    width = int(lens.max()) if n else 0
    if n and (lens == width).all() and width > 0:
        return np.vstack([np.asarray(a, dtype=np.float64) for a in arrs]), lens
    X = np.full((n, max(width, 1)), np.nan)
    for i, a in enumerate(arrs):
        if lens[i]:
            X[i, :lens[i]] = np.asarray(a, dtype=np.float64)
    return X, lens


def maxima_mask(X: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """(B, L) bool: strict local maxima of each row's window [lo, hi) (a
    plateau counts once, at its middle; the window ends never count)."""
    B, L = X.shape
    mask = np.zeros((B, L), dtype=bool)
    if L < 3:
        return mask
    idx = np.arange(L - 1)
    d = X[:, 1:] - X[:, :-1]                                   # d[k] = x[k+1] - x[k]
    kval = (idx[None, :] >= lo[:, None]) & (idx[None, :] <= (hi - 2)[:, None])
    big = L + 1
    nxt = np.where((d != 0) & kval, idx[None, :], big)
    nxt = np.minimum.accumulate(nxt[:, ::-1], axis=1)[:, ::-1]  # first k' >= k with a change
    pos = np.arange(1, L - 1)                                   # candidate positions i
    rise = (d[:, :L - 2] > 0) & kval[:, :L - 2]                 # x[i-1] < x[i], inside the window
    k = nxt[:, 1:L - 1]                                         # first change at or after i
    ok = rise & (k < big)
    kk = np.where(ok, k, 0)
    ok &= np.take_along_axis(d, kk, axis=1) < 0                 # ... and it is a fall
    r, c = np.nonzero(ok)
    mask[r, (pos[c] + kk[r, c]) // 2] = True                    # plateau [i, k] -> middle
    return mask


def prominences(X: np.ndarray, lo: np.ndarray, hi: np.ndarray, r: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Prominence of sample p of row r inside that row's window [lo, hi)."""
    if len(r) == 0:
        return np.zeros(0)
    L = X.shape[1]
    rows = X[r]
    v = rows[np.arange(len(r)), p]
    idx = np.arange(L)[None, :]
    lo_r, hi_r = lo[r][:, None], hi[r][:, None]
    pc = p[:, None]
    inwin = (idx >= lo_r) & (idx < hi_r)
    higher = (rows > v[:, None]) & inwin
    lb = np.maximum(np.where(higher & (idx < pc), idx, -1).max(axis=1), lo[r] - 1)
    rb = np.minimum(np.where(higher & (idx > pc), idx, L + 1).min(axis=1), hi[r])
    lmin = np.where((idx > lb[:, None]) & (idx <= pc), rows, np.inf).min(axis=1)
    rmin = np.where((idx >= pc) & (idx < rb[:, None]), rows, np.inf).min(axis=1)
    return v - np.maximum(lmin, rmin)


def second_peak_batch(focus, fp: np.ndarray, start: int, gap: int, height: float,
                      min_prominence: float) -> pd.DataFrame:
    """Second-path peak per row of focus windows (see ``waves.second_peak``)."""
    n = len(focus)
    idx_out = np.full(n, np.nan)
    amp_out = np.full(n, np.nan)
    found = np.zeros(n, dtype=np.int32)
    for c0 in range(0, n, CHUNK_ROWS):
        c1 = min(n, c0 + CHUNK_ROWS)
        X, lens = to_matrix(focus[c0:c1])
        f = fp[c0:c1]
        valid = ~np.isnan(f)
        s = np.minimum(np.maximum(np.where(valid, f, 0).astype(np.int64) - start + gap, 0), lens - 1)
        search = valid & (s < lens - 1)
        lo = np.where(search, s, 0)
        hi = np.where(search, lens, 0)
        m = maxima_mask(X, lo, hi)
        with np.errstate(invalid="ignore"):
            m &= X >= height
        r, p = np.nonzero(m)
        prom = prominences(X, lo, hi, r, p)
        keep = prom >= min_prominence
        r, p, prom = r[keep], p[keep], prom[keep]
        if len(r):
            order = np.lexsort((p, -prom, r))                   # per row: max prominence, then first
            r, p = r[order], p[order]
            first = np.r_[True, r[1:] != r[:-1]]
            r, p = r[first], p[first]
            idx_out[c0 + r] = start + p
            amp_out[c0 + r] = X[r, p]
            found[c0 + r] = 1
    out = pd.DataFrame({"peak2_idx": idx_out, "peak2_amp": amp_out, "peak2_found": found})
    out.loc[found == 0, ["peak2_idx", "peak2_amp"]] = None
    return out


def num_peaks_batch(w, rel_height: float, tiny: float) -> np.ndarray:
    """Local maxima with x >= rel_height * max per row; 0 for a (near) zero max."""
    out = np.zeros(len(w))
    for c0 in range(0, len(w), CHUNK_ROWS):
        c1 = min(len(w), c0 + CHUNK_ROWS)
        X, lens = to_matrix(w[c0:c1])
        m = maxima_mask(X, np.zeros(len(lens), dtype=np.int64), lens)
        with np.errstate(invalid="ignore"):
            pk = np.max(np.where(np.isnan(X), -np.inf, X), axis=1)
            cnt = (m & (X >= rel_height * pk[:, None])).sum(axis=1)
        out[c0:c1] = np.where((lens == 0) | (pk < tiny), 0.0, cnt)
    return out


def shape_stats_batch(w, rel_height: float, lo: float, hi: float, tiny: float) -> pd.DataFrame:
    """All window shape statistics of a batch in one pass over the matrix:
    peak, first peak index, energy, population kurtosis / skewness (NULL for
    a constant window), rise time and the relative-height peak count."""
    n = len(w)
    cols = {k: np.full(n, np.nan) for k in ("peak", "peak_idx", "energy", "kurtosis", "skewness",
                                              "rise_time", "num_peaks")}
    for c0 in range(0, n, CHUNK_ROWS):
        c1 = min(n, c0 + CHUNK_ROWS)
        X, lens = to_matrix(w[c0:c1])
        valid = ~np.isnan(X)
        Z = np.where(valid, X, 0.0)
        has = lens > 0
        cnt = np.maximum(lens, 1)
        Xm = np.where(valid, X, -np.inf)
        pk = Xm.max(axis=1)
        pidx = Xm.argmax(axis=1)
        mean = Z.sum(axis=1) / cnt
        d = np.where(valid, X - mean[:, None], 0.0)
        d2 = d * d
        m2, m3, m4 = d2.sum(axis=1) / cnt, (d2 * d).sum(axis=1) / cnt, (d2 * d2).sum(axis=1) / cnt
        with np.errstate(invalid="ignore", divide="ignore"):
            kurt = np.where(m2 > 0, m4 / (m2 * m2) - 3.0, np.nan)
            skew = np.where(m2 > 0, m3 / np.power(m2, 1.5), np.nan)
            i_hi = np.argmax(Xm >= hi * pk[:, None], axis=1)
            i_lo = np.argmax(Xm >= lo * pk[:, None], axis=1)
        rise = np.where(pk < tiny, 0.0, (i_hi - i_lo).astype(np.float64))
        m = maxima_mask(X, np.zeros(len(lens), dtype=np.int64), lens)
        with np.errstate(invalid="ignore"):
            npk = (m & (X >= rel_height * pk[:, None])).sum(axis=1)
        npk = np.where(pk < tiny, 0.0, npk)
        for k, v in (("peak", pk), ("peak_idx", pidx.astype(np.float64)), ("energy", (Z * Z).sum(axis=1)),
                     ("kurtosis", kurt), ("skewness", skew), ("rise_time", rise), ("num_peaks", npk)):
            cols[k][c0:c1] = np.where(has, v, np.nan)
    out = pd.DataFrame(cols)
    return out.astype(object).where(out.notna(), None) if out.isna().any().any() else out


def prominences_batch(w, height: float | None) -> list:
    """Per row: [{pos, prominence}] for every local maximum (optionally with
    x >= height), prominence measured over the whole row."""
    out = []
    for c0 in range(0, len(w), CHUNK_ROWS):
        c1 = min(len(w), c0 + CHUNK_ROWS)
        X, lens = to_matrix(w[c0:c1])
        lo = np.zeros(len(lens), dtype=np.int64)
        m = maxima_mask(X, lo, lens)
        if height is not None:
            with np.errstate(invalid="ignore"):
                m &= X >= height
        r, p = np.nonzero(m)                      # row-major: positions ascending per row
        prom = prominences(X, lo, lens, r, p)
        rows = [[] for _ in range(c1 - c0)]
        for ri, pi, pv in zip(r.tolist(), p.tolist(), prom.tolist()):
            rows[ri].append({"pos": pi, "prominence": pv})
        out.extend(rows)
    return out
