import random

import pytest
from pyspark.sql import functions as F

from cirflow.functions import fast as FA
from cirflow.functions import waves as W
from tests import peak_reference as R

CASES = {
    "plain": ([0, 1, 5, 1, 0], [2], [5.0]),
    "flat_top": ([0, 3, 3, 3, 0], [2], [3.0]),
    "even_flat_top": ([0, 3, 3, 0], [1], [3.0]),
    "plateau_at_end": ([0, 3, 3], [], []),
    "edge_maxima": ([9, 1, 9], [], []),
    "nested": ([0, 5, 2, 4, 1, 9, 0], [1, 3, 5], [4.0, 2.0, 9.0]),
    "equal_peaks": ([0, 5, 1, 5, 0], [1, 3], [5.0, 5.0]),
    "all_zero": ([0, 0, 0], [], []),
    "constant": ([4, 4, 4], [], []),
    "len1": ([7], [], []),
    "len2": ([7, 8], [], []),
}


@pytest.fixture(scope="module")
def hand(spark):
    rows = [(k, [float(v) for v in w]) for k, (w, _, _) in CASES.items()]
    df = spark.createDataFrame(rows, "k string, w array<double>")
    out = df.select("k", W.wave_local_maxima("w").alias("mx"), W.wave_prominences("w").alias("pr"),
                    W.wave_peak_idx("w").alias("pi"), W.wave_rise_time("w").alias("rt"),
                    W.wave_kurtosis("w").alias("ku"), W.wave_skewness("w").alias("sk"))
    return {r["k"]: r for r in out.collect()}


@pytest.mark.parametrize("name", list(CASES))
def test_maxima_and_prominence(hand, name):
    _, mx, pr = CASES[name]
    r = hand[name]
    assert list(r["mx"]) == mx
    assert [p["prominence"] for p in r["pr"]] == pr


def test_constant_and_zero(hand):
    for k in ("all_zero", "constant"):
        assert hand[k]["pi"] == 0 and hand[k]["rt"] == 0.0
        assert hand[k]["ku"] is None and hand[k]["sk"] is None


def test_align_edges(spark):
    w = [float(i + 1) for i in range(1016)]
    df = spark.createDataFrame([(3.0, w), (1010.0, w), (2000.0, w), (-200.0, w)], "fp double, w array<double>")
    out = [r[0] for r in df.select(W.wave_align("w", "fp")).collect()]
    assert out[0][:27] == [0.0] * 27 and out[0][27:30] == [1.0, 2.0, 3.0] and len(out[0]) == 120
    assert out[1][:36] == [float(i + 1) for i in range(980, 1016)] and out[1][36:] == [0.0] * 84
    assert out[2] == [0.0] * 120 and out[3] == [0.0] * 120


def test_moments_match_numpy(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    waves = [rng.gamma(2.0, 10.0, 50).round().tolist() for _ in range(20)]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(waves)], "i int, w array<double>")
    got = df.select("i", W.wave_kurtosis("w").alias("k"), W.wave_skewness("w").alias("s")).orderBy("i").collect()
    for r, w in zip(got, waves):
        x = np.asarray(w)
        d = x - x.mean()
        m2, m3, m4 = (d ** 2).mean(), (d ** 3).mean(), (d ** 4).mean()
        assert r["k"] == pytest.approx(m4 / m2 ** 2 - 3, rel=1e-9)
        assert r["s"] == pytest.approx(m3 / m2 ** 1.5, rel=1e-9)


def _random_waves(n, seed):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        length = rnd.randint(1, 60)
        w = [float(rnd.choice([0, 1, 2, 3, 3, 5, 8, 13, 40, 60])) for _ in range(length)]
        out.append((i, float(rnd.randint(-20, 60)), w))
    return out


def test_engines_match_reference(spark):
    data = _random_waves(600, 7)
    df = spark.createDataFrame(data, "i int, fp double, w array<double>")
    params = dict(start=2, length=40, gap=3, height=3.0, min_prominence=4.0)
    out = df.select("i", W.wave_local_maxima("w").alias("mx"), W.wave_prominences("w").alias("pr"),
                    FA.prominences("w").alias("pr_vec"),
                    W.second_peak("w", "fp", **params).alias("nat"), FA.second_peak("w", "fp", **params).alias("vec"),
                    W.wave_num_peaks("w").alias("np_nat"), FA.num_peaks("w").alias("np_vec")).orderBy("i").collect()
    for r, (_, fp, w) in zip(out, data):
        mx = R.maxima(w)
        assert list(r["mx"]) == mx
        assert [p["prominence"] for p in r["pr"]] == [R.prominence(w, p) for p in mx]
        assert [(p["pos"], p["prominence"]) for p in r["pr_vec"]] == [(p, R.prominence(w, p)) for p in mx]
        ref = R.second_peak(w, fp, params["start"], params["length"], params["gap"],
                            params["height"], params["min_prominence"])
        for got in (r["nat"], r["vec"]):
            if ref is None:
                assert got["peak2_found"] == 0 and got["peak2_idx"] is None
            else:
                assert (got["peak2_idx"], got["peak2_amp"], got["peak2_found"]) == (ref[0], ref[1], 1)
        pk = max(w)
        exp = 0.0 if pk < 1e-10 else float(sum(1 for p in mx if w[p] >= 0.3 * pk))
        assert r["np_nat"] == exp and r["np_vec"] == exp


def test_second_peak_search_start_at_end(spark):
    w = [float(x) for x in range(120)]
    df = spark.createDataFrame([(200.0, w)], "fp double, w array<double>")
    r = df.select(W.second_peak("w", "fp", start=0, length=120).alias("s")).first()["s"]
    assert r["peak2_found"] == 0 and r["peak2_idx"] is None


def test_vectorized_shape_stats_match_native(spark):
    from cirflow.operators import features as FE
    data = _random_waves(400, 11) + [(1000, 0.0, [4.0, 4.0, 4.0]), (1001, 0.0, [0.0, 0.0])]
    df = spark.createDataFrame(data, "i int, fp double, w array<double>")
    nat = FE.shape_features(df, "w", engine="native").drop("w", "fp")
    vec = FE.shape_features(df, "w", engine="vectorized").drop("w", "fp")
    a = {r["i"]: r for r in nat.collect()}
    for r in vec.collect():
        for k in ("CIR_peak", "CIR_peak_idx", "CIR_energy", "CIR_kurtosis", "CIR_skewness",
                  "CIR_rise_time", "CIR_num_peaks"):
            if a[r["i"]][k] is None:
                assert r[k] is None, (r["i"], k)
            else:
                assert r[k] == pytest.approx(a[r["i"]][k], rel=1e-9, abs=1e-9), (r["i"], k)
