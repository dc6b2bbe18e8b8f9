"""Plain-Python peak search with SciPy's find_peaks / peak_prominences
semantics (used only by the tests)."""


def maxima(x):
    peaks, i, n = [], 1, len(x)
    while i < n - 1:
        if x[i - 1] < x[i]:
            ahead = i + 1
            while ahead < n - 1 and x[ahead] == x[i]:
                ahead += 1
            if x[ahead] < x[i]:
                peaks.append((i + ahead - 1) // 2)
                i = ahead
        i += 1
    return peaks


def prominence(x, p):
    v = x[p]
    i, lmin = p, v
    while i >= 0 and x[i] <= v:
        lmin = min(lmin, x[i])
        i -= 1
    i, rmin = p, v
    while i < len(x) and x[i] <= v:
        rmin = min(rmin, x[i])
        i += 1
    return v - max(lmin, rmin)


def second_peak(w, fp, start, length, gap, height, min_prom):
    focus = w[start:start + length]
    n = len(focus)
    s = min(max(int(fp) - start + gap, 0), n - 1)
    if s >= n - 1:
        return None
    sw = focus[s:]
    best = None
    for p in maxima(sw):
        if sw[p] >= height:
            pr = prominence(sw, p)
            if pr >= min_prom and (best is None or pr > best[0]):
                best = (pr, p)
    return None if best is None else (float(start + s + best[1]), float(sw[best[1]]))
