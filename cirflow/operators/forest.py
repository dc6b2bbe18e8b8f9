"""Random forests of any depth, grown as Spark jobs.

Rows are binned once, as for boosting. A row's weight in a tree is the number
of times a bootstrap draws it (Poisson of mean one, from a hash of row and
tree), times its class weight: none, ``balanced`` (counts of the rows) or
``balanced_subsample`` (counts of the tree's own draw). All trees grow at the
same time. A level is one job: tasks sum (weight * y, weight, rows) by (tree,
node, feature, bin) for the features a node may look at; the sums are added
up and searched where they land. Nodes of at most ``FINISH_ROWS`` rows go to
one task each, which grows them to the end with the same functions.

The cut with the largest decrease of the weighted variance of y is taken; for
labels 0 and 1 that is the cut of the largest decrease of Gini. A node's
features are drawn by (seed, tree, path to the node). Leaves hold the weighted
mean, so that a classifier's probability is the mean over trees. Missing values
go to the better side.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cirflow.operators import boosting as B
from cirflow.session import stored

#: Rows of a node that one task may finish (its memory is bounded by them, about 100 bytes a row).
FINISH_ROWS = 200_000
#: Bytes of histograms that a task sums in one job; nodes in a row of the table of trees; rows that share one copy of it.
HIST_BYTES, PIECE_NODES, COPY_ROWS = 128 << 20, 256, 1_000_000


@dataclass(frozen=True)
class Params:
    """Settings under their usual names; the defaults are those of the random-forest classifier."""

    n_estimators: int = 200
    max_depth: int | None = None
    min_samples_split: int = 2
    min_samples_leaf: int = 1
    max_features: str | float = "sqrt"          # or a share of the features, 1.0 for all
    class_weight: str | None = None             # "balanced", "balanced_subsample"
    bootstrap: bool = True
    seed: int = 42


#: The settings of the range regressor's forest.
RANGE_REGRESSOR = Params(n_estimators=100, max_features=1.0)
#: Sums without shrinkage: leaf = sum(w * y) / sum(w).
_PLAIN = B.Params(learning_rate=1.0, reg_lambda=0.0, min_child_weight=0.0)
#: Cumulative chances of 0, 1, 2, ... draws.
_DRAWS = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])


def draws(row: np.ndarray, tree: int, p: Params) -> np.ndarray:
    """How often a tree's bootstrap draws each row (by its hash)."""
    if not p.bootstrap:
        return np.ones(len(row))
    turn = B._hash(np.array([p.seed * 1_000_003 + 7_000_000_001 + tree], np.uint64))
    u = (B._hash(row.view(np.uint64) ^ turn) >> np.uint64(11)).astype(float) / (1 << 53)
    return np.searchsorted(_DRAWS, u, "right").astype(float)


def features_of(tree: int, path: int, width: int, p: Params) -> np.ndarray:
    """The features a node may look at; ``path`` numbers nodes by their place (root 1, children 2n and 2n + 1, mod 2^63)."""
    return features_at(tree, np.array([path], np.uint64), width, p)[0]


def features_at(tree: int, paths: np.ndarray, width: int, p: Params) -> np.ndarray:
    """``features_of`` many nodes: those of the smallest hashes of (seed, tree, path, feature)."""
    share = {"sqrt": math.sqrt(width), "log2": math.log2(max(width, 2))}.get(p.max_features) if isinstance(p.max_features, str) else p.max_features * width
    k = max(1, min(width, int(share)))
    if k >= width:
        return np.tile(np.arange(width), (len(paths), 1))
    turn = B._hash(np.array([p.seed * 1_000_003 + 13_000_000_007 + tree], np.uint64))
    keys = B._hash(B._hash(paths.astype(np.uint64)[:, None] ^ turn) + np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return np.sort(np.argpartition(keys, k - 1, axis=1)[:, :k], axis=1)


def _child(path: int, side: int) -> int:
    return (2 * path + side) & ((1 << 63) - 1)


def _histograms(bins: np.ndarray, slot: np.ndarray, wy: np.ndarray, w: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Sums (slots, features of the slot, bins, 3)."""
    slots, k = columns.shape
    out = np.empty((slots, k, B.BINS, 3))
    rows = np.arange(len(slot))
    for c in range(k):
        key = slot * B.BINS + bins[rows, columns[slot, c]]
        for i, x in enumerate((-wy, w, None)):
            out[:, c, :, i] = np.bincount(key, x, slots * B.BINS).reshape(slots, B.BINS)
    return out


def grow(bins: np.ndarray, y: np.ndarray, w: np.ndarray, tree: int, path: int, depth: int, p: Params) -> B.Tree:
    """A whole (sub)tree over rows at hand with positive weight; ``depth`` and ``path`` are those of its root."""
    out, width = B.Levels(), bins.shape[1]
    if not len(bins):
        return B.Tree()
    g = -w * y
    rows, start, paths = np.arange(len(bins)), np.array([0, len(bins)]), np.array([path], np.uint64)
    while True:
        total = B.sums_of(w[rows], start)
        mean = -B.sums_of(g[rows], start) / np.where(total > 0, total, 1.0)
        size, one = np.diff(start), y[rows]
        mixed = np.minimum.reduceat(one, start[:-1]) != np.maximum.reduceat(one, start[:-1])
        live = np.flatnonzero((size >= max(p.min_samples_split, 2)) & mixed & (width > 0) & (p.max_depth is None or depth < p.max_depth))
        kept = np.zeros(len(size), bool)
        kept[live] = True
        # variances are the same around each node's mean, where sums are small and rounding with them
        near = np.empty(len(g))
        near[rows] = g[rows] + w[rows] * np.repeat(mean, size)
        gain, feature, cut, missing = B.node_cuts(bins, near, w, rows[np.repeat(kept, size)], np.concatenate([[0], size[live].cumsum()]).astype(np.int64), features_at(tree, paths[live], width, p), _PLAIN, p.min_samples_leaf)
        good = gain > 1e-9 * np.maximum(total[live], 1e-300)
        split = live[good]
        out.add(mean, total, split, feature[good], cut[good], missing[good], gain[good])
        if not len(split):
            return out.tree()
        rows, start = B.parted(bins, rows, start, split, feature[good], cut[good], missing[good])
        # children are 2n and 2n + 1, mod 2^63
        paths, depth = ((2 * paths[split])[:, None] + np.arange(2, dtype=np.uint64) & np.uint64((1 << 63) - 1)).ravel(), depth + 1


_STATE = "row bigint, y double, x binary"
_NAMES = ["row", "y", "x"]


def _rows(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.asarray(batch.column(0)), np.asarray(batch.column(1)), np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(batch.num_rows, width)


_NODE = np.dtype([("feature", "<i4"), ("cut", "<i4"), ("missing_left", "?"), ("left", "<i4"), ("right", "<i4"), ("value", "<f8"), ("gain", "<f8"), ("cover", "<f8")])
_PIECES = "number int, node int, part int, nodes binary"
#: The place of a row behind the pieces of its tree.
_LAST = (1 << 31) - 1


def _pieces(number: int, node: int, tree: B.Tree) -> pa.RecordBatch:
    """A subtree as rows of the table of trees."""
    all_nodes = np.empty(len(tree.feature), _NODE)
    for name in _NODE.names:
        all_nodes[name] = getattr(tree, name)
    blobs = [all_nodes[a:a + PIECE_NODES].tobytes() for a in range(0, len(all_nodes), PIECE_NODES)]
    return pa.RecordBatch.from_arrays([pa.array([number] * len(blobs), pa.int32()), pa.array([node] * len(blobs), pa.int32()), pa.array(range(len(blobs)), pa.int32()), pa.array(blobs, pa.binary())],
                                      names=["number", "node", "part", "nodes"])


class Trees(Sequence):
    """The trees of a fit, put together from the table when one is asked for."""

    def __init__(self, heads: list[B.Tree], table: DataFrame):
        self.heads, self.table = heads, table

    def __len__(self) -> int:
        return len(self.heads)

    def _some(self, numbers: range) -> Iterator[B.Tree]:
        found: dict[tuple[int, int], list[tuple[int, bytes]]] = {}
        for r in self.table.where(F.col("number").between(numbers.start, numbers.stop - 1)).collect():
            found.setdefault((r["number"], r["node"]), []).append((r["part"], bytes(r["nodes"])))
        for t in numbers:
            tree = B.Tree(**{k: list(v) for k, v in self.heads[t].__dict__.items()})
            for (_, node), parts in sorted((k, v) for k, v in found.items() if k[0] == t):
                nodes = np.frombuffer(b"".join(x for _, x in sorted(parts)), _NODE)
                tree.graft(node, B.Tree(**{k: nodes[k].tolist() for k in _NODE.names}))
            yield tree

    def __getitem__(self, i):
        if isinstance(i, slice):
            return [self[j] for j in range(*i.indices(len(self)))]
        i = range(len(self))[i]
        return next(self._some(range(i, i + 1)))

    def __iter__(self) -> Iterator[B.Tree]:
        for a in range(0, len(self), 20):
            yield from self._some(range(a, min(a + 20, len(self))))


@dataclass
class Forest(B.Boosted):
    """A fitted forest; its margin is the sum of the trees' means over their number."""

    regression: bool = False
    #: The nodes of each tree's head below which the table goes on.
    below: dict[int, list[int]] | None = None

    def predict(self, df: DataFrame, features: str = "features", keep: tuple[str, ...] = ("id", "y"), threshold: float = 0.5) -> DataFrame:
        """(keep..., p, pred) of a classifier, (keep..., p) of a regressor."""
        m = self.margins(df.select(*keep, features), features, "_sum").select(*keep, (F.col("_sum") / max(len(self.trees), 1)).alias("p"))
        return m if self.regression else m.withColumn("pred", (F.col("p") >= threshold).cast("int"))

    def margins(self, df: DataFrame, features: str = "features", out: str = "margin") -> DataFrame:
        """``df`` with the sum of the trees' outputs. Rows go through the heads, then to the pieces of every tree they reach."""
        if not self.below:
            return super().margins(df, features, out)
        rest = [c for c in df.columns if c != features]
        kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in rest)
        width, cuts, heads, below, table = len(self.cuts), self.cuts, self.trees.heads, self.below, self.trees.table

        def binned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bins = B.to_bins(B._matrix(batch.column(batch.num_columns - 1), width), cuts)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([r.tobytes() for r in bins], pa.binary())], names=["_row", *rest, "_x"])

        def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bins = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(batch.num_rows, width)
                for t, head in enumerate(heads):
                    node = head.leaves(bins)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(node), t, np.int32)), pa.array(node.astype(np.int32)), pa.array(np.full(len(node), _LAST, np.int32)), batch.column(1), batch.column(0)],
                                                     names=["number", "node", "part", "nodes", "row"])

        def answer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, parts, tree = None, [], None
            for batch in batches:
                number, node, part, row = (np.asarray(batch.column(i).to_numpy(zero_copy_only=False)) for i in (0, 1, 2, 4))
                edges = [0, *(np.flatnonzero((np.diff(number) != 0) | (np.diff(node) != 0)) + 1).tolist(), len(number)]
                for a, b in zip(edges, edges[1:]):
                    if a == b:
                        continue
                    if key != (number[a], node[a]):
                        key, parts, tree = (number[a], node[a]), [], None
                    blobs = batch.column(3).slice(a, b - a).to_pylist()
                    middle = int(np.searchsorted(part[a:b], _LAST))
                    parts += blobs[:middle]
                    if middle == b - a:
                        continue
                    if tree is None:
                        nodes = np.frombuffer(b"".join(parts), _NODE)
                        head = heads[key[0]]
                        # a head's own leaf has no pieces
                        tree = B.Tree(**{k: nodes[k] for k in _NODE.names}) if len(nodes) else B.Tree(value=[head.value[key[1]]])
                        parts = []
                    bins = np.frombuffer(b"".join(blobs[middle:]), np.uint8).reshape(-1, width)
                    yield pa.RecordBatch.from_arrays([pa.array(row[a + middle:b].astype(np.int64)), pa.array(np.full(len(bins), key[0], np.int32)), pa.array(tree.output(bins))], names=["_row", "number", "value"])

        rows = stored(df.select(F.monotonically_increasing_id().alias("_row"), *rest, B.vector(features, df).alias("_v")).mapInArrow(binned, f"_row bigint, {kinds}{', ' if rest else ''}_x binary"), "forest-rows")
        copies = max(1, math.ceil(rows.count() / COPY_ROWS))
        asked = rows.select("_row", "_x").mapInArrow(send, f"{_PIECES}, row bigint").withColumn("copy", F.pmod("row", F.lit(copies)).cast("int"))
        pieces = table.withColumn("row", F.lit(-1).cast("bigint")).withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        both = asked.unionByName(pieces).repartition(_tasks(df.sparkSession, copies * sum(map(len, below.values()))), "number", "node", "copy")
        found = both.sortWithinPartitions("number", "node", "copy", "part").drop("copy").mapInArrow(answer, "_row bigint, number int, value double")
        # added in the order of the trees, so that sums repeat
        total = found.groupBy("_row").agg(F.aggregate(F.array_sort(F.collect_list(F.struct("number", "value"))), F.lit(self.base), lambda s, x: s + x["value"]).alias(out))
        return rows.join(total, "_row").select(*rest, out)

    def importance(self) -> np.ndarray:
        """Mean decrease of impurity: each tree's shares, averaged, as a share of one."""
        share = np.zeros((len(self.trees), len(self.cuts)))
        for t, tree in enumerate(self.trees.heads if self.below else self.trees):
            for f, gain in zip(tree.feature, tree.gain):
                if f >= 0:
                    share[t, f] += gain
        if self.below:
            def gains(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for number, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                        nodes = np.frombuffer(blob, _NODE)
                        cut = nodes[nodes["feature"] >= 0]
                        which, at = np.unique(cut["feature"], return_inverse=True)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(which), number, np.int32)), pa.array(which.astype(np.int32)), pa.array(np.bincount(at, cut["gain"], len(which)), pa.float64())], names=["number", "feature", "gain"])

            for r in self.trees.table.select("number", "nodes").mapInArrow(gains, "number int, feature int, gain double").groupBy("number", "feature").agg(F.sum("gain").alias("gain")).collect():
                share[r["number"], r["feature"]] += r["gain"]
        of_tree = share.sum(1, keepdims=True)
        total = np.divide(share, of_tree, out=np.zeros_like(share), where=of_tree > 0).sum(0)
        return total / total.sum() if total.sum() > 0 else total


def _tasks(spark, groups: int) -> int:
    """Tasks for groups that are much work for few bytes: not put together by size, several a core where there are more groups."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")), min(groups, 1000))


def fit(df: DataFrame, params: Params = Params(), features: str = "features", label: str = "y", key: str = "id", regression: bool = False, finish_rows: int = FINISH_ROWS) -> Forest:
    """Fit on the rows of ``df`` with a label (0 or 1 unless ``regression``)."""
    p = params
    rows = df.where(F.col(label).isNotNull()).select(F.xxhash64(key).alias("row"), F.col(label).cast("double").alias("y"), B.vector(features, df).alias("v"))
    count, ones, width = rows.agg(F.count("*"), F.count_if(F.col("y") == 1), F.max(F.size("v"))).first()
    width = int(width or 0)
    cuts = B.feature_cuts(rows, "v", width) if count and width else [np.empty(0)] * width
    model = Forest(_PLAIN, cuts, 0.0, [], regression=regression)
    if not count:
        return model

    def binned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = B.to_bins(B._matrix(batch.column(2), width), cuts)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array([r.tobytes() for r in bins], pa.binary())], names=_NAMES)

    state = stored(rows.mapInArrow(binned, _STATE), "forest")
    numbers = range(p.n_estimators)

    # weights of the classes in every tree
    weights = np.ones((p.n_estimators, 2))
    if p.class_weight == "balanced":
        weights[:] = [count / (2 * max(count - ones, 1)), count / (2 * max(ones, 1))]
    elif p.class_weight == "balanced_subsample":
        def drawn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((p.n_estimators, 2))
            for batch in batches:
                row, y = np.asarray(batch.column(0)), np.asarray(batch.column(1))
                for t in numbers:
                    sums[t] += np.bincount((y == 1).astype(int), draws(row, t, p), 2)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(p.n_estimators, dtype=np.int32)), pa.array(sums[:, 0]), pa.array(sums[:, 1])], names=["tree", "n0", "n1"])

        for r in state.mapInArrow(drawn, "tree int, n0 double, n1 double").groupBy("tree").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).collect():
            n = np.array([r["n0"], r["n1"]])
            weights[r["tree"]] = n.sum() / (2 * np.maximum(n, 1))

    def weight(row: np.ndarray, y: np.ndarray, t: int) -> np.ndarray:
        w = draws(row, t, p)
        return w if regression else w * weights[t][(y == 1).astype(int)]

    trees = [B.Tree() for _ in numbers]

    def level_cuts(nodes: list[tuple[int, int]], level: dict[tuple[int, int], tuple[int, int]]) -> list[tuple[tuple[int, int], object]]:
        """The best cut of each node, from summed histograms."""
        columns = np.array([features_of(t, level[t, n][0], width, p) for t, n in nodes]) if width else np.empty((len(nodes), 0), int)
        by_tree = {t: [i for i, k in enumerate(nodes) if k[0] == t] for t in {k[0] for k in nodes}}

        def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                row, y, bins = _rows(batch, width)
                part = np.zeros((len(nodes), columns.shape[1], B.BINS, 3))
                for t, mine in by_tree.items():
                    w = weight(row, y, t)
                    slot_of = np.full(len(trees[t].feature), -1)
                    slot_of[[nodes[i][1] for i in mine]] = np.arange(len(mine))
                    slot = np.where(w > 0, slot_of[trees[t].leaves(bins)], -1)
                    r = np.flatnonzero(slot >= 0)
                    part[mine] = _histograms(bins[r], slot[r], w[r] * y[r], w[r], columns[mine])
                total = part if total is None else total + part
            if total is not None:
                for i in range(len(nodes)):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(columns.shape[1], i, np.int32)), pa.array(columns[i].astype(np.int32)), pa.array([h.tobytes() for h in total[i]], pa.binary())],
                                                     names=["node", "feature", "hist"])

        def best(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held_key, held = None, None

            def close():
                gain, cut, missing, left, total = B.best_cuts(held[None], _PLAIN, p.min_samples_leaf)
                return pa.RecordBatch.from_pylist([{"node": held_key[0], "feature": held_key[1], "gain": float(gain[0]), "cut": int(cut[0]), "missing": bool(missing[0]), "left": left[0].tolist(), "total": total[0].tolist()}], B._CUT)

            for batch in batches:
                for node, feature, blob in zip(*(c.to_pylist() for c in batch.columns)):
                    one = np.frombuffer(blob).reshape(B.BINS, 3)
                    if (node, feature) != held_key:
                        if held_key is not None:
                            yield close()
                        held_key, held = (node, feature), one.copy()
                    else:
                        held += one
            if held_key is not None:
                yield close()

        found = state.mapInArrow(sums, "node int, feature int, hist binary").repartition("node", "feature").sortWithinPartitions("node", "feature").mapInArrow(
            best, "node int, feature int, gain double, cut int, missing boolean, left array<double>, total array<double>")
        return [(nodes[r["node"]], r["b"]) for r in found.groupBy("node").agg(F.max_by(F.struct("feature", "gain", "cut", "missing", "left", "total"), F.struct("gain", -F.col("feature"))).alias("b")).collect()]

    level = {(t, 0): (1, count) for t in numbers}             # (tree, node): path, rows at most
    small: dict[tuple[int, int], tuple[int, int]] = {}        # (tree, node): path, depth
    depth = 0
    while level:
        small |= {k: (path, depth) for k, (path, n) in level.items() if n <= finish_rows}
        level = {k: v for k, v in level.items() if v[1] > finish_rows}
        if not level:
            break
        # as many nodes a job as a task can hold histograms of
        at_once = max(1, HIST_BYTES // (24 * B.BINS * max(1, len(features_of(0, 1, width, p)))))
        cut_rows = [c for at in range(0, len(level), at_once) for c in level_cuts(list(level)[at:at + at_once], level)]
        fresh = {}
        for (t, node), b in cut_rows:
            tree, path = trees[t], level[t, node][0]
            total, left = b["total"], b["left"]
            tree.value[node], tree.cover[node] = -total[0] / total[1] if total[1] else 0.0, total[1]
            if b["gain"] > 1e-9 * max(total[1], 1e-300) and total[2] >= p.min_samples_split and (p.max_depth is None or depth < p.max_depth):
                ends = tree.split(node, b["feature"], b["cut"], b["missing"], b["gain"])
                for side, (end, part) in enumerate(zip(ends, (left, [a - c for a, c in zip(total, left)]))):
                    tree.value[end], tree.cover[end] = -part[0] / part[1] if part[1] else 0.0, part[1]
                    fresh[t, end] = _child(path, side), int(round(part[2]))
        level, depth = fresh, depth + 1

    if small:
        of_tree: dict[int, list[int]] = {}
        for t, node in small:
            of_tree.setdefault(t, []).append(node)

        def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                row, y, bins = _rows(batch, width)
                for t, mine in of_tree.items():
                    w = weight(row, y, t)
                    node = trees[t].leaves(bins)
                    r = np.flatnonzero((w > 0) & np.isin(node, mine))
                    some = batch.take(pa.array(r))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(r), t, np.int32)), pa.array(node[r].astype(np.int32)), *some.columns], names=["tree", "node", *_NAMES])

        def finished(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            one = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            t, node = one.column(0)[0].as_py(), one.column(1)[0].as_py()
            row, y, bins = _rows(pa.RecordBatch.from_arrays(one.columns[2:], names=_NAMES), width)
            path, deep = small[t, node]
            return _pieces(t, node, grow(bins, y, weight(row, y, t), t, path, deep, p))

        def subtrees(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pa.RecordBatch] = []
            for batch in batches:
                key = np.asarray(batch.column(0)).astype(np.int64) << 32 | np.asarray(batch.column(1))
                edges = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
                for a, b in zip(edges, edges[1:]):
                    if a == b:
                        continue
                    piece = batch.slice(a, b - a)
                    if held and (held[0].column(0)[0], held[0].column(1)[0]) != (piece.column(0)[0], piece.column(1)[0]):
                        yield finished(held)
                        held = []
                    held.append(piece)
            if held:
                yield finished(held)

        sent = state.mapInArrow(send, f"tree int, node int, {_STATE}").repartition(_tasks(df.sparkSession, len(small)), "tree", "node").sortWithinPartitions("tree", "node", "row", "y")
        model.trees, model.below = Trees(trees, stored(sent.mapInArrow(subtrees, _PIECES), "forest-trees")), of_tree
        return model
    model.trees = trees
    return model
