"""Near-duplicate vectors by an epsilon grid order join.

Unit vectors at cosine c are at distance sqrt(2 - 2c), so links are pairs
within that epsilon. Vectors are projected on their leading principal
directions (covariance summed over all data), given the grid cell of width
epsilon they fall in, and sorted by label and cell. The sorted sequence is cut
into blocks. Two blocks can hold a link only if their bounding boxes in the
projection are within epsilon: projections never lengthen a distance. Block
pairs are found by an equal join on the cells of the first ``KEYED``
directions, each block also standing in the neighbouring cells. A pair of
blocks is one task's work: sequence intervals are halved and joined
recursively, distant ones skipped, small ones compared in double precision.

Equal vectors of a label are compared once. A task returns each vector's
number of links and a spanning forest, never all pairs. Vectors that are null,
empty, zero, or hold null or non-finite numbers link with nothing, and neither
do rows without label or id; vectors of different length are never compared.
Repeated rows count as other vectors. Extra columns are dropped.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, share, stored
from .components import components
from .near_text import forest

COSINE = 0.93
#: Principal directions of the projection, and those whose cells are join keys.
AXES, KEYED = 16, 3
BLOCK, LEAF = 1024, 128


def _unit(raw: np.ndarray) -> np.ndarray:
    x = raw.astype(np.float64)
    big = np.abs(x).max(1, keepdims=True)
    x = x / big                                              # no overflow in the squares
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(col.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim)


def directions(reps: DataFrame) -> dict[int, np.ndarray]:
    """For each vector length the leading principal directions (columns) of the
    unit vectors. Each task sums its outer products; the sums of d * d numbers
    are added over tasks, and only the totals reach the driver."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = np.asarray(column(batch, "dim"))
            for d in np.unique(dims).tolist():
                u = _unit(_matrix(column(batch, "vec").filter(pa.array(dims == d)), d))
                one = np.column_stack([u, np.ones(len(u))])
                sums[d] = sums.get(d, 0) + one.T @ one
        for d, m in sums.items():
            i, j = np.triu_indices(d + 1)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), d), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(m[i, j])],
                                             names=["dim", "i", "j", "v"])

    t = reps.select("dim", "vec").mapInArrow(run, "dim int, i int, j int, v double").groupBy("dim", "i", "j").agg(F.sum("v").alias("v")).toArrow()
    out = {}
    dim, i, j, v = (t.column(c).to_numpy() for c in ("dim", "i", "j", "v"))
    for d in np.unique(dim).tolist():
        m = np.zeros((d + 1, d + 1))
        mine = dim == d
        m[i[mine], j[mine]] = m[j[mine], i[mine]] = v[mine]
        n = m[d, d]
        mean = m[d, :d] / n
        values, vectors = np.linalg.eigh(m[:d, :d] / n - np.outer(mean, mean))
        out[d] = np.ascontiguousarray(vectors[:, ::-1][:, :AXES])
    return out


def _cells(reps: DataFrame, axes, eps: float) -> DataFrame:
    """Rows with their projection and the grid cells of its leading directions."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(column(batch, "dim"))
            for d in np.unique(dims).tolist():
                rows = batch.filter(pa.array(dims == d))
                y = _unit(_matrix(column(rows, "vec"), d)) @ axes.value[d]
                g = np.floor(y / eps).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(g.tolist(), pa.list_(pa.int32())), pa.array(y.tolist(), pa.list_(pa.float64()))],
                                                 names=[*rows.schema.names, "g", "y"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in reps.schema.fields)
    return reps.mapInArrow(run, f"{kinds}, g array<int>, y array<double>")


def _blocks(rows: DataFrame) -> DataFrame:
    """Cut each sorted partition into blocks of at most BLOCK vectors of one label and length."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, serial = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []

        def send(t: pa.Table) -> pa.RecordBatch:
            nonlocal serial
            serial += 1
            d = t.column("dim")[0].as_py()
            y = np.array(t.column("y").to_pylist())
            x = np.array(t.column("vec").to_pylist(), np.float64)
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + serial], pa.int64()), pa.array([t.column("label")[0].as_py()], pa.string()), pa.array([d], pa.int32()),
                 pa.array([y.min(0).tolist()], pa.list_(pa.float64())), pa.array([y.max(0).tolist()], pa.list_(pa.float64())),
                 pa.array([t.column("rep").to_pylist()], pa.list_(pa.int64())), pa.array([t.column("copies").to_pylist()], pa.list_(pa.int64())),
                 pa.array([y.tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary())],
                names=["block", "label", "dim", "lo", "hi", "reps", "copies", "y", "x"])

        def cut(t: pa.Table, all_of_it: bool):
            label, dim = t.column("label").to_pylist(), t.column("dim").to_pylist()
            start = 0
            for i in range(1, t.num_rows + 1):
                if i == t.num_rows and not all_of_it:
                    break
                if i == t.num_rows or i - start == BLOCK or (label[i], dim[i]) != (label[start], dim[start]):
                    yield send(t.slice(start, i - start))
                    start = i
            held[:] = t.slice(start).to_batches() if start < t.num_rows else []

        for batch in batches:
            if batch.num_rows:
                yield from cut(pa.Table.from_batches([*held, batch]), False)
        if held:
            yield from cut(pa.Table.from_batches(held), True)

    return rows.mapInArrow(run, "block bigint, label string, dim int, lo array<double>, hi array<double>, reps array<bigint>, copies array<bigint>, y binary, x binary")


def _join_intervals(a, b, ya, yb, eps: float, found, ia: int, na: int, ib: int, nb: int, cosine: float) -> None:
    """Recursive join of two sequence intervals; ``found(ia, ib, links)`` gets each compared rectangle."""
    la, ha, lb, hb = ya[ia:ia + na].min(0), ya[ia:ia + na].max(0), yb[ib:ib + nb].min(0), yb[ib:ib + nb].max(0)
    apart = np.maximum(0, np.maximum(la - hb, lb - ha))
    if (apart * apart).sum() > eps * eps * (1 + 1e-9):
        return
    if max(na, nb) <= LEAF:
        found(ia, ib, a[ia:ia + na] @ b[ib:ib + nb].T >= cosine)
        return
    for sa, ma in ((ia, na // 2), (ia + na // 2, na - na // 2)) if na > LEAF else ((ia, na),):
        for sb, mb in ((ib, nb // 2), (ib + nb // 2, nb - nb // 2)) if nb > LEAF else ((ib, nb),):
            if ma and mb:
                _join_intervals(a, b, ya, yb, eps, found, sa, ma, sb, mb, cosine)


def _compare(pairs: DataFrame, cosine: float, eps: float) -> DataFrame:
    """(kind, a, b): 'n' a vector and its number of links in a block pair; 'e' an edge of the pair's forest."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                d = r["dim"]
                ids_a, ids_b = np.array(r["reps_a"], np.int64), np.array(r["reps_b"], np.int64)
                ca, cb = np.array(r["copies_a"], np.int64), np.array(r["copies_b"], np.int64)
                xa, xb = (_unit(np.frombuffer(r[c], np.float64).reshape(-1, d)) for c in ("x_a", "x_b"))
                ya, yb = np.frombuffer(r["y_a"], np.float64).reshape(len(ids_a), -1), np.frombuffer(r["y_b"], np.float64).reshape(len(ids_b), -1)
                same = r["block_a"] == r["block_b"]
                m = np.zeros((len(ids_a), len(ids_b)), bool)

                def found(i, j, links, m=m):
                    m[i:i + links.shape[0], j:j + links.shape[1]] = links

                _join_intervals(xa, xb, ya, yb, eps, found, 0, len(ids_a), 0, len(ids_b), cosine)
                if same:
                    m |= m.T                                 # one value for both directions
                    np.fill_diagonal(m, False)
                na, nb = m @ cb, m.T @ ca
                out = [("n", int(k), int(v)) for k, v in zip(ids_a, na) if v]
                if not same:
                    out += [("n", int(k), int(v)) for k, v in zip(ids_b, nb) if v]
                rows, cols = np.flatnonzero(m.any(1)), np.flatnonzero(m.any(0))
                if len(rows):
                    if same:
                        label = forest(m[np.ix_(rows, rows)])
                        out += [("e", int(ids_a[rows[i]]), int(ids_a[rows[j]])) for i, j in enumerate(label.tolist()) if i != j]
                    else:
                        k = len(rows)
                        full = np.zeros((k + len(cols), k + len(cols)), bool)
                        full[:k, k:] = m[np.ix_(rows, cols)]
                        full[k:, :k] = full[:k, k:].T
                        both = np.concatenate([ids_a[rows], ids_b[cols]])
                        out += [("e", int(both[i]), int(both[j])) for i, j in enumerate(forest(full).tolist()) if i != j]
                kind, a, b = zip(*out, strict=True) if out else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(kind, pa.string()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["kind", "a", "b"])

    return pairs.mapInArrow(run, "kind string, a bigint, b bigint")


def block_pairs(heads: DataFrame, eps: float) -> DataFrame:
    """(block_a, block_b), a <= b: blocks of one label and length whose boxes are within eps."""

    def cells(df: DataFrame, side: str, reach: int) -> DataFrame:
        df = df.select(F.col("block").alias(f"block_{side}"), "label", "dim", F.col("lo").alias(f"lo_{side}"), F.col("hi").alias(f"hi_{side}"))
        for k in range(KEYED):
            lo, hi = (F.coalesce(F.floor(F.get(f"{x}_{side}", F.lit(k)) / eps), F.lit(0)) for x in ("lo", "hi"))
            df = df.withColumn(f"c{k}", F.explode(F.sequence(lo - reach, hi + reach)))
        return df

    near = F.aggregate(F.zip_with(F.zip_with("lo_a", "hi_b", lambda p, q: F.greatest(p - q, F.lit(0.0))),
                                  F.zip_with("lo_b", "hi_a", lambda p, q: F.greatest(p - q, F.lit(0.0))), lambda p, q: F.greatest(p, q)),
                       F.lit(0.0), lambda s, x: s + x * x) <= eps * eps * (1 + 1e-9)
    keys = ["label", "dim", *[f"c{k}" for k in range(KEYED)]]
    return (cells(heads, "a", 0).join(cells(heads, "b", 1), keys).where((F.col("block_a") <= F.col("block_b")) & near)
            .select("block_a", "block_b").union(
                # a box stands in the other's cells widened by one, seen from either side
                cells(heads, "b", 0).join(cells(heads, "a", 1), keys).where((F.col("block_a") <= F.col("block_b")) & near).select("block_a", "block_b"))
            .distinct())


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE) -> DataFrame:
    """(key, n_links, component_id, kept) of every row."""
    eps = math.sqrt(2 - 2 * cosine)
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    fine = (F.col(key).isNotNull() & F.col(label).isNotNull() & F.coalesce(F.size(vector) > 0, F.lit(False))
            & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False)) & F.exists(v, lambda x: x != 0))
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(label).cast("string").alias("label"), F.when(fine, v).alias("vec"))
    rows = rows.withColumn("h1", F.when(F.col("vec").isNotNull(), F.xxhash64("label", "vec"))).withColumn("h2", F.hash("vec", "label"))
    same = stored(rows.where("vec is not null").groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "vec-same")
    reps = (rows.where("vec is not null").join(same, ["h1", "h2"]).where("id = rep")
            .groupBy("rep", "h1", "h2").agg(F.first("label").alias("label"), F.first("vec").alias("vec"), F.first("copies").alias("copies"))
            .select("rep", "label", F.size("vec").alias("dim"), "vec", "copies"))
    reps = stored(reps, "vec-reps")
    axes = share(df.sparkSession, directions(reps))          # AXES * d numbers for each length
    grid = _cells(reps, axes, eps).select("*", *[F.get("g", F.lit(k)).alias(f"g{k}") for k in range(AXES // 2)])
    order = ["label", "dim", *[f"g{k}" for k in range(AXES // 2)], "rep"]
    blocks = stored(_blocks(grid.repartitionByRange(*order).sortWithinPartitions(*order).select("label", "dim", "rep", "copies", "y", "vec")), "vec-blocks")
    pairs = stored(block_pairs(blocks.select("block", "label", "dim", "lo", "hi"), eps), "vec-pairs")
    side = lambda s: blocks.select(F.col("block").alias(f"block_{s}"), *([F.col("dim")] if s == "a" else []), *[F.col(c).alias(f"{c}_{s}") for c in ("reps", "copies", "x", "y")])
    found = stored(_compare(pairs.join(side("a"), "block_a").join(side("b"), "block_b"), cosine, eps), "vec-links")
    counts = found.where("kind = 'n'").groupBy(F.col("a").alias("rep")).agg(F.sum("b").alias("others"))
    classes = components(found.where("kind = 'e'").select("a", "b"))
    info = stored(same.join(counts, "rep", "left").join(classes, F.col("rep") == F.col("node"), "left")
                  .select("h1", "h2", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component")), "vec-info")
    return (rows.select("id", "h1", "h2").join(info, ["h1", "h2"], "left")
            .select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "id").cast("long").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True))))
