"""Whitening and hard negatives against plain versions."""
import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from cirflow.llm import hard_negatives, queries, whitening
from cirflow.llm.common import table

from ..conftest import SF01


@pytest.mark.parametrize("d", [1, 2, 3, 7, 33, 64])
def test_components_equal_an_eigensolver(d):
    rng = np.random.default_rng(d)
    x = rng.normal(size=(400, d))
    wide = x * 10 ** rng.uniform(-5, 3, d)
    for v in (x.T @ x / 400, wide.T @ wide / 400, np.eye(d), np.zeros((d, d)), np.ones((d, d)), np.diag([5.0] * (d - d // 2) + [1e-9] * (d // 2))):
        values, vectors = whitening.components(v)
        want = np.linalg.eigvalsh(v)[::-1][:8]
        size = max(np.linalg.norm(v), 1e-300)
        assert values.shape == want.shape and np.abs(values - want).max() <= 1e-13 * size
        assert np.abs(v @ vectors - vectors * values).max() <= 1e-13 * size
        assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13


def test_polar_factor_of_an_ill_conditioned_matrix():
    rng = np.random.default_rng(5)
    q, _ = np.linalg.qr(rng.normal(size=(40, 40)))
    e = np.concatenate([10.0 ** -np.arange(0, 10, 0.5), -10.0 ** -np.arange(0, 10, 0.5)])
    u = whitening.polar(q * e @ q.T)
    assert np.abs(u @ u - np.eye(40)).max() < 1e-12 and np.abs(u - q * np.sign(e) @ q.T).max() < 1e-5


def plain_whitening(rows):
    """{(id, component): (n, deviation, |whitened|, explained)} of vectors of one length, by an eigensolver."""
    ok = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) and abs(c) < 2 ** 32 for c in v)]
    x = [[int(np.floor(1024.0 * c)) + 100000 for c in v] for _, v in ok]
    n, s = len(x), [sum(c) for c in zip(*x)]
    mean = np.array([a / n for a in s])
    y = np.array(x, float) - mean
    v = y.T @ y / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:8], q[:, ::-1][:, :8]
    z = y @ q / np.sqrt(e)
    return [(i, k + 1, n, sum((n * a - b) ** 2 for a, b in zip(x[r], s)), abs(z[r, k]), e[k] / np.trace(v)) for r, (i, _) in enumerate(ok) for k in range(len(e))]


def check_whitening(got, want):
    got = sorted((r.vec_id is None, r.vec_id or 0, r.component, r.n, r.deviation, abs(r.whitened), r.explained, r.identity_error) for r in got)
    want = sorted((i is None, i or 0, *rest) for i, *rest in want)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[5] == pytest.approx(w[5], rel=1e-6, abs=1e-7) and g[6] == pytest.approx(w[6], rel=1e-9) and g[7] < 1e-9


def test_whitening_query_equals_a_plain_version(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF01, "embeddings").collect()]
    check_whitening(queries.op11_whitening(spark, SF01).collect(), plain_whitening(rows))


def test_whitening_edges(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(0, 1, 5).tolist()) for i in range(40)] + [(3, [1.0] * 5)] * 3 + [(None, [2.0] * 5), (91, None), (92, [1.0, None, 1.0, 1.0, 1.0]), (93, [float("nan")] * 5),
                                                                  (94, [float("-inf")] * 5), (95, [2.0 ** 33] * 5), (96, [])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, component string, n int")
    check_whitening(whitening.whiten(df).collect(), plain_whitening(rows))
    assert whitening.whiten(df.where("false")).count() == 0
    # no variance at all, and in one direction; each length is whitened on its own
    same = spark.createDataFrame([(1, [3.0, 4.0]), (2, [3.0, 4.0]), (7, [1.0]), (8, [2.0]), (9, [2.0, 4.0, 6.0]), (9, [3.0, 4.0, 5.0])], "vec_id long, embedding array<float>")
    got = whitening.whiten(same).collect()
    two = [r for r in got if r.vec_id in (1, 2)]
    assert len(two) == 4 and all(r.whitened is None and r.identity_error is None for r in two)
    one = [r for r in got if r.vec_id in (7, 8)]
    assert sorted(r.whitened for r in one) == pytest.approx([-1, 1]) and {r.n for r in one} == {2} and one[0].explained == 1.0
    three = [r for r in got if r.vec_id == 9]
    assert len(three) == 6 and sum(r.whitened is not None for r in three) == 2 and max(r.identity_error for r in three) < 1e-9


def test_deviation_beyond_a_long():
    x = np.array([[2 ** 41, -2 ** 41], [5, 7]])
    assert whitening.deviations(x, 3, np.array([0, 0], object)) == [None, 9 * 74]
    assert whitening.deviations(x, 3 << 40, np.array([0, 0], object))[0] is None


@pytest.mark.parametrize("size", [3, 1 << 12, 1 << 24, 1 << 30])
def test_packed_products_are_exact(size):
    rng = np.random.default_rng(size)
    a, b = rng.integers(-size, size, (7, 5)), rng.integers(-size, size, (13, 5))
    want = a.astype(object) @ b.T.astype(object)
    assert (hard_negatives.products(a, b).astype(object) == want).all()
    assert (hard_negatives.products(a[:1], b[:1]).astype(object) == want[:1, :1]).all()
    assert (hard_negatives.products(a * 0, b) == 0).all() and (hard_negatives.products(a, b * 0 + 3).astype(object) == a.sum(1)[:, None] * 3).all()


def plain_negatives(rows, every):
    ok = [(i, label, [int(np.floor(256.0 * c)) for c in v]) for i, v, label in rows if i is not None and v is not None and label is not None and all(c is not None and np.isfinite(c) for c in v)]
    ok = [r for r in ok if sum(c * c for c in r[2]) < 2 ** 62]
    out = collections.Counter()
    for i, label, x in ok:
        if i % every:
            continue
        scores = [(-sum(p * q for p, q in zip(x, y)), j, m) for j, m, y in ok if j != i and len(x) == len(y) and x]
        scores = sorted((s, j, m == label) for s, j, m in scores)
        for s, j, _ in [r for r in scores if r[2]][:5]:
            near = [r for r in scores if not r[2] and 50 * -s <= 100 * -r[0] <= 95 * -s][:3]
            out.update((i, j, k + 1, r[1], -s, -r[0]) for k, r in enumerate(near))
    return out


def test_negatives_equal_a_plain_version(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "TILE", 16)
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", 8 * 8 * 5)          # five anchors a block
    rng = np.random.default_rng(8)
    centres = rng.normal(0, 1, (4, 8))
    rows = [(i, (centres[i % 4] + rng.normal(0, 0.7, 8)).tolist(), i % 3) for i in range(300)]
    rows += [(300 + i, rows[8][1], i % 3) for i in range(40)]              # ties
    rows += [(10, rows[10][1], 1), (10, rows[10][1], 1), (10, rows[4][1], 2), (11, rows[11][1], 2)]   # repeated rows and ids
    rows += [(400, None, 0), (410, [], 0), (420, [1.0, None] * 4, 0), (430, [float("nan")] * 8, 0), (440, rows[0][1], None), (None, rows[0][1], 0), (450, [1.0, 2.0], 0), (460, [1.0, 2.0], 0),
             (470, [1.0, 2.0], 1), (480, [0.7, 1.0], 1), (490, [1e30] * 8, 1), (500, [2.0 ** 30, 0.0], 1), (-50, rows[3][1], 7), (510, [0.0] * 8, 2), (520, [-1.0] * 8, 2)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, place string, x int")
    want = plain_negatives(rows, 10)
    got = collections.Counter(map(tuple, hard_negatives.mine(df, F.col("id") % 10 == 0).collect()))
    assert got == want and sum(want.values()) > 200
    assert hard_negatives.mine(df.where("false"), F.col("id") % 10 == 0).count() == 0
    assert hard_negatives.mine(df.where("vec_id = 1"), F.col("id") % 10 == 0).count() == 0


def test_negatives_of_large_components(spark):
    rng = np.random.default_rng(9)
    rows = [(i, (rng.normal(0, 1, 6) * 2 ** 18).tolist(), i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert collections.Counter(map(tuple, hard_negatives.mine(df, F.col("id") % 10 == 0).collect())) == plain_negatives(rows, 10)
