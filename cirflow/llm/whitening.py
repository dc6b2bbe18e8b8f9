"""Whitening of embeddings by QDWH spectral divide and conquer.

Entries become whole numbers (a fixed grid and a shift that keeps them
positive), so counts and sums over all rows are exact at any order of addition.
Each task sums its rows' entries, then their centred products; the sums of d
and d * d numbers are added over tasks and only the totals, whose size is that
of the dimension and not of the data, reach the driver.

Components are found there by spectral divide and conquer: the polar factor of
the covariance shifted by the mean eigenvalue is its matrix sign, half of sign
plus identity the projector on the eigenvectors above the shift. Orthonormal
bases of the two invariant subspaces split the matrix into two smaller ones,
until a part is a multiple of the identity; parts below the wanted components
are left unsplit. The polar factor comes from Halley's iteration with dynamic
weights, each step a QR decomposition; it converges in about six steps
whatever the condition, and the mean always lies between the extreme eigenvalues.

The mean and the scaled components are broadcast; whitening is one map over rows.

Rows without a vector, with null or non-finite entries, or entries of 2^32 and
more in size are dropped. Vectors of each length are whitened on their own;
empty ones have no component. A component without variance (equal rows, a
constant entry) has ``whitened`` null and is not in ``identity_error``. A
``deviation`` beyond a long is null. Null and repeated ids are rows like others,
extra columns are dropped, an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, share

#: Components returned; grid steps to one; number added to an entry.
COMPONENTS, SCALE, SHIFT = 8, 1024, 100_000
#: Entries of this size and more are out of range.
LARGEST = 2.0 ** 32
_EPS = np.finfo(float).eps


# ---- spectral divide and conquer of one symmetric matrix
def polar(a: np.ndarray, steps: int = 30) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by QR-based dynamically weighted Halley steps."""
    m = len(a)
    x = a / max(np.linalg.norm(a), np.finfo(float).tiny)
    try:                                                     # no larger than the smallest singular value
        low = min(1.0, max(1 / float(np.linalg.norm(np.linalg.inv(x))), 1e-17))
    except np.linalg.LinAlgError:
        low = 1e-17
    for _ in range(steps):
        square = low * low
        d = np.cbrt(4 * (1 - square) / (square * square))
        wa = np.sqrt(1 + d) + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * np.sqrt(1 + d)))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, np.eye(m)]))
        new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * q[:m] @ q[m:].T
        new = (new + new.T) / 2
        low = min(1.0, low * (wa + wb * square) / (1 + wc * square))
        moved = np.linalg.norm(new - x)
        x = new
        if abs(1 - low) < 1e-15 and moved < 1e-14 * m:
            break
    return x


def split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of the invariant subspaces of ``a`` above and below its mean eigenvalue."""
    m = len(a)
    above = (polar(a - np.trace(a) / m * np.eye(m)) + np.eye(m)) / 2
    k = min(max(int(round(np.trace(above))), 1), m - 1)
    start = np.random.default_rng(m).standard_normal((m, m))
    parts = []
    for projector, width in ((above, start[:, :k]), (np.eye(m) - above, start[:, k:])):
        for _ in range(2):
            width, _ = np.linalg.qr(projector @ width)
        parts.append(width)
    q, _ = np.linalg.qr(np.hstack(parts))
    return q[:, :k], q[:, k:]


def components(v: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues of a covariance, falling, and their unit eigenvectors (columns)."""
    d = len(v)
    size = np.linalg.norm(v)
    values, vectors = [], []
    todo = [np.eye(d)] if d else []                          # the last part holds the largest eigenvalues
    while todo and len(values) < most:
        basis = todo.pop()
        a = basis.T @ v @ basis
        a = (a + a.T) / 2
        m = len(a)
        if m == 1 or np.linalg.norm(a - np.trace(a) / m * np.eye(m)) <= _EPS * size:
            for c in basis.T:
                values.append(float(c @ v @ c))
                vectors.append(c)
        else:
            high, low = split(a)
            todo += [basis @ low, basis @ high]
    order = np.argsort(-np.array(values), kind="stable")[:most]
    return np.array(values)[order], np.array(vectors).reshape(-1, d)[order].T


# ---- sums over rows
def _groups(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The rows of each vector length, and their entries on the grid."""
    col = column(batch, "v")
    if not len(col):
        return
    dims = np.diff(np.asarray(col.offsets))
    for d in np.unique(dims).tolist():
        rows = batch.filter(pa.array(dims == d)) if (dims != d).any() else batch
        x = np.asarray(column(rows, "v").flatten(), np.float64).reshape(rows.num_rows, d)
        yield rows, np.floor(SCALE * x).astype(np.int64) + SHIFT


def _sums(rows: DataFrame, kind: str, of: Callable[[np.ndarray], np.ndarray]) -> dict[int, np.ndarray]:
    """For each length the sum over all rows of the matrices ``of`` returns; only the totals reach the driver."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in _groups(batch):
                if x.shape[1]:
                    sums[x.shape[1]] = sums.get(x.shape[1], 0) + of(x)
        for d, m in sums.items():
            i, j = (k.ravel() for k in np.indices(m.shape))
            v = [str(y) for y in m.ravel()] if kind == "string" else m.ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), d), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(v)], names=["d", "i", "j", "v"])

    number = F.col("v").cast("decimal(28,0)") if kind == "string" else F.col("v")
    found = rows.mapInArrow(run, f"d int, i int, j int, v {kind}").groupBy("d", "i", "j").agg(F.sum(number).alias("v")).collect()
    out: dict[int, dict] = {}
    for r in found:
        out.setdefault(r.d, {})[r.i, r.j] = int(r.v) if kind == "string" else r.v
    return {d: np.array([[m[i, j] for j in range(max(m)[1] + 1)] for i in range(max(m)[0] + 1)], object if kind == "string" else float) for d, m in out.items()}


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """For each row the exact sum over dimensions of (n * x - sum)^2; null beyond a long."""
    if n * (int(np.abs(x).max(initial=0)) + 1) + max(abs(int(s)) for s in sums) < 1 << 62:
        off = n * x - np.array([int(s) for s in sums], np.int64)
        rough = (off.astype(np.float64) ** 2).sum(1)
        exact = (off * off).sum(1)                           # exact where the rough sum is far from a long's end
        if (rough < 2.0 ** 62).all():
            return exact.tolist()
    out = []
    for row in x.tolist():
        s = sum((n * a - int(b)) ** 2 for a, b in zip(row, sums, strict=True))
        out.append(s if s < 1 << 63 else None)
    return out


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) of every row kept and component."""
    kind = df.schema[key].dataType.simpleString()
    fine = F.coalesce(F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < LARGEST, F.lit(False))), F.lit(False))   # NaN is above all numbers
    rows = df.where(fine).select(F.col(key).alias("k"), F.transform(vector, lambda c: c.cast("double")).alias("v"))

    first = _sums(rows, "string", lambda x: np.vstack([x.sum(0), np.full(x.shape[1], len(x))]).astype(object))
    n = {d: int(m[1, 0]) for d, m in first.items()}
    sums = {d: m[0] for d, m in first.items()}
    means = {d: np.array([int(s) / n[d] for s in sums[d]]) for d in first}
    centred = lambda x: x - means[x.shape[1]]
    second = _sums(rows, "double", lambda x: centred(x).T @ centred(x))
    maps, explained = {}, {}
    for d, m in second.items():
        v = (m + m.T) / 2 / n[d]
        values, vectors = components(v, most)
        total = float(np.trace(v))
        some = values > d * _EPS * total                     # the others have no variance
        maps[d] = vectors[:, some] / np.sqrt(values[some])
        explained[d] = [float(e) / total if total > 0 else 0.0 for e in values]

    def products(x: np.ndarray) -> np.ndarray:
        z = np.column_stack([centred(x) @ maps[x.shape[1]], np.ones(len(x))])
        return z.T @ z

    errors = {}
    for d, m in _sums(rows, "double", products).items():
        k = maps[d].shape[1]
        mean = m[k, :k] / n[d]
        errors[d] = float(np.abs(m[:k, :k] / n[d] - np.outer(mean, mean) - np.eye(k)).max()) if k else None
    model = share(df.sparkSession, (n, sums, means, maps, explained, errors))  # numbers of the dimension times the components

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, means, maps, explained, errors = model.value
        for batch in batches:
            for some, x in _groups(batch):
                d = x.shape[1]
                if not d:
                    continue
                k, all_of = maps[d].shape[1], len(explained[d])
                z = np.full((len(x), all_of), np.nan)
                z[:, :k] = (x - means[d]) @ maps[d]
                far = pa.array(deviations(x, n[d], sums[d]), pa.int64())
                at = np.repeat(np.arange(len(x)), all_of)
                yield pa.RecordBatch.from_arrays(
                    [column(some, "k").take(pa.array(at)), pa.array(np.tile(np.arange(1, all_of + 1, dtype=np.int32), len(x))), pa.array(np.full(len(at), n[d])),
                     far.take(pa.array(at)), pa.array(z.ravel(), pa.float64(), mask=np.isnan(z.ravel())), pa.array(np.tile(explained[d], len(x))), pa.array([errors[d]] * len(at), pa.float64())],
                    names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, f"`{key}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
