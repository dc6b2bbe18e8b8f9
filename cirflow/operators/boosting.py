"""Second-order gradient boosting of histogram trees, as Spark jobs.

Features are cut into at most 254 bins at distributed quantiles (bin 0 holds
missing values) and written once, one byte a feature, with label, weight, a
row hash and the margin so far. A tree grows level by level. Each level is one
job: every task sums gradients, hessians and counts of its rows by (node,
feature, bin); these small histograms, not rows, are shuffled by (node,
feature), added up, and searched for the best cut where they land, so that one
line a node and feature reaches the driver. A node of at most ``FINISH_ROWS`` rows is sent
to one task that grows its subtree to the end with the same functions; while
the whole sample is that small, the task grows several trees in a row.

The margin is written again every ``ROUNDS_A_STORE`` trees (``ROUNDS_A_TASK`` where
one task holds the sample); jobs in between add the newer trees to it, so that
nothing is cached on an executor and a lost one costs the current job's tasks only.

Gain = T(GL)^2/(HL+lambda) + T(GR)^2/(HR+lambda) - T(G)^2/(H+lambda), T the soft
threshold by alpha; a cut needs ``min_child_weight`` of hessian on both sides.
Trees are pruned from below where the gain is under gamma. Missing values go
to the better side. Rows are sampled by a hash of (id, tree), columns by tree.

Early stopping adds up the loss of every prefix of the trees on the validation
rows in one pass, ends after ``patience`` rounds without a smaller one, and
cuts the model at the best round.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cirflow.session import scratch_path

#: Rows of a node that one task may finish (its memory is bounded by them); trees between two writes of the margin, and where one
#: task grows whole trees and none is tried on validation rows.
FINISH_ROWS, ROUNDS_A_STORE, ROUNDS_A_TASK = 200_000, 10, 100
BINS = 256
#: Rows of a node whose cuts are found by sorting, alone or where histograms can be shared; numbers of a tile of such nodes.
SORTED_ROWS, SHARED_ROWS, TILE = 512, 256, 1 << 16
#: Smallest gain of a cut.
LEAST_GAIN = 1e-6


@dataclass(frozen=True)
class Params:
    """Settings under their usual names; the defaults are those of the pair classifier."""

    n_estimators: int = 200
    max_depth: int = 6
    learning_rate: float = 0.1
    subsample: float = 0.8
    colsample_bytree: float = 0.8
    min_child_weight: float = 1.0
    gamma: float = 0.0
    reg_alpha: float = 0.0
    reg_lambda: float = 1.0
    scale_pos_weight: float = 1.0
    objective: str = "logistic"          # or "squared"
    seed: int = 42


#: The settings of the range regressor.
RANGE_REGRESSOR = Params(n_estimators=1200, max_depth=8, learning_rate=0.015, subsample=0.85, colsample_bytree=0.85,
                         min_child_weight=5.0, reg_lambda=2.0, objective="squared")


@dataclass
class Tree:
    """Nodes as parallel lists; node 0 is the root, ``feature`` -1 marks a leaf."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    cover: list[float] = field(default_factory=lambda: [0.0])

    def split(self, at: int, feature: int, cut: int, missing_left: bool, gain: float) -> tuple[int, int]:
        self.feature[at], self.cut[at], self.missing_left[at], self.gain[at] = feature, cut, missing_left, gain
        ends = []
        for side in (self.left, self.right):
            side[at] = len(self.feature)
            ends.append(side[at])
            for name, blank in (("feature", -1), ("cut", 0), ("missing_left", False), ("left", -1), ("right", -1), ("value", 0.0), ("gain", 0.0), ("cover", 0.0)):
                getattr(self, name).append(blank)
        return ends[0], ends[1]

    def graft(self, at: int, other: Tree) -> None:
        """Hang another tree on leaf ``at``."""
        place = {0: at}
        for i, f in enumerate(other.feature):                # parents come before their children
            j = place[i]
            if f >= 0:
                place[other.left[i]], place[other.right[i]] = self.split(j, f, other.cut[i], other.missing_left[i], other.gain[i])
            self.value[j], self.cover[j] = other.value[i], other.cover[i]

    def prune(self, gamma: float) -> None:
        for i in reversed(range(len(self.feature))):
            if self.feature[i] >= 0 and self.gain[i] < gamma and self.feature[self.left[i]] < 0 and self.feature[self.right[i]] < 0:
                self.feature[i] = self.left[i] = self.right[i] = -1

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The node each row of bins ends in."""
        feature, cut, missing, left, right = (np.array(x) for x in (self.feature, self.cut, self.missing_left, self.left, self.right))
        at = np.zeros(len(bins), np.int64)
        rows = np.arange(len(bins))
        while len(rows):
            rows = rows[feature[at[rows]] >= 0]
            node = at[rows]
            b = bins[rows, feature[node]]
            at[rows] = np.where(np.where(b == 0, missing[node], b <= cut[node]), left[node], right[node])
        return at

    def output(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.leaves(bins)]


# ---- the arithmetic of one node
def gradients(margin: np.ndarray, y: np.ndarray, w: np.ndarray, objective: str) -> tuple[np.ndarray, np.ndarray]:
    if objective == "squared":
        return w * (margin - y), w.copy()
    p = 1 / (1 + np.exp(-margin))
    return w * (p - y), w * np.maximum(p * (1 - p), 1e-16)


def _shrunk(g, p: Params):
    if not p.reg_alpha:
        return g
    return np.sign(g) * np.maximum(np.abs(g) - p.reg_alpha, 0.0)


def score(g, h, p: Params):
    return _shrunk(g, p) ** 2 / (h + p.reg_lambda + 1e-300)


def leaf_value(g: float, h: float, p: Params) -> float:
    return float(-p.learning_rate * _shrunk(g, p) / (h + p.reg_lambda)) if h + p.reg_lambda > 0 else 0.0


def leaf_values(g: np.ndarray, h: np.ndarray, p: Params) -> np.ndarray:
    return np.where(h + p.reg_lambda > 0, -p.learning_rate * _shrunk(g, p) / np.where(h + p.reg_lambda > 0, h + p.reg_lambda, 1.0), 0.0)


def histograms(bins: np.ndarray, slot: np.ndarray, g: np.ndarray, h: np.ndarray, slots: int, columns: np.ndarray) -> np.ndarray:
    """Sums (slots, columns, bins, 3) of gradient, hessian and rows; ``slot`` numbers the rows' nodes."""
    out = np.empty((slots, len(columns), BINS, 3))
    across = np.ascontiguousarray(bins[:, columns].T)
    for c in range(len(columns)):
        key = across[c].astype(np.int64) if slots == 1 else slot * BINS + across[c]
        for k, weight in enumerate((g, h, None)):
            out[:, c, :, k] = np.bincount(key, weight, slots * BINS).reshape(slots, BINS)
    return out


def gains(left_g: np.ndarray, left_h: np.ndarray, right_g: np.ndarray, right_h: np.ndarray, parent: np.ndarray, p: Params) -> np.ndarray:
    """``score`` of both sides less the parent's, in as few passes as there can be."""
    out = _shrunk(left_g, p) ** 2
    out /= left_h + p.reg_lambda + 1e-300
    right = _shrunk(right_g, p) ** 2
    right /= right_h + p.reg_lambda + 1e-300
    out += right
    out -= parent
    return out


def plane_cuts(g: np.ndarray, h: np.ndarray, n: np.ndarray, p: Params, least_rows: int = 1) -> tuple[np.ndarray, ...]:
    """``best_cuts`` of gradients, hessians and rows (histograms, bins): gain, cut, side of the missing."""
    at = np.arange(len(g))
    all_g, all_h, all_n = (x.sum(1)[:, None] for x in (g, h, n))
    first_g, first_n = g[:, 1:-1].cumsum(1), n[:, 1:-1].cumsum(1)          # cut after bin 1, 2, ...
    first_h = first_n if h is n else h[:, 1:-1].cumsum(1)
    parent = score(all_g, all_h, p)
    best = None
    for way in range(1 + bool(n[:, 0].any())):
        left_g, left_h, left_n = (first_g, first_h, first_n) if not way else (first_g + g[:, :1], first_h + h[:, :1], first_n + n[:, :1])
        right_h = all_h - left_h
        ok = (left_n >= least_rows) & (left_n <= all_n - least_rows)
        if p.min_child_weight:
            ok &= (left_h >= p.min_child_weight) & (right_h >= p.min_child_weight)
        with np.errstate(all="ignore"):
            gain = gains(left_g, left_h, all_g - left_g, right_h, parent, p)
        np.copyto(gain, -np.inf, where=~ok)
        gain = gain.astype(np.float32)                       # sums in another order give the same ties
        cut = gain.argmax(1)
        found = gain[at, cut].astype(float), cut + 1, np.full(len(g), bool(way))
        best = found if best is None else tuple(np.where(found[0] > best[0], a, b) for a, b in zip(found, best))
    return best


def best_cuts(hist: np.ndarray, p: Params, least_rows: int = 1) -> tuple[np.ndarray, ...]:
    """For each histogram (bins, 3): gain, cut (left: bin <= cut), side of the missing, and (g, h, rows) left and in all.
    Of equal gains the first cut counts, missing values right before left."""
    gain, cut, missing = plane_cuts(*(np.ascontiguousarray(hist[..., i]) for i in range(3)), p, least_rows)
    left = np.stack([x[1:c + 1].cumsum(0)[-1] + (x[0] if m else 0.0) for x, c, m in zip(hist, cut, missing)]) if len(hist) else np.zeros((0, 3))
    return gain, cut, missing, left, hist.sum(1)


def node_cut(bins: np.ndarray, g: np.ndarray, h: np.ndarray, columns: np.ndarray, p: Params, least_rows: int = 1) -> tuple[float, int, int, bool]:
    """(gain, feature, cut, missing_left) of the best cut of one node's rows: of equal gains the first feature and cut.
    Few rows are sorted, many are put into histograms; both find the same cut."""
    sub = bins[:, columns]
    if len(sub) <= SORTED_ROWS and sub.min(initial=1) > 0:
        order = sub.argsort(0, kind="stable")
        b = np.take_along_axis(sub, order, 0)
        left_g, left_h = g[order].cumsum(0)[:-1], h[order].cumsum(0)[:-1]
        all_g, all_h, left = g.sum(), h.sum(), np.arange(1, len(b))[:, None]
        right_h = all_h - left_h
        ok = (b[1:] != b[:-1]) & (left_h >= p.min_child_weight) & (right_h >= p.min_child_weight) & (left >= least_rows) & (len(b) - left >= least_rows)
        gain = np.where(ok, score(left_g, left_h, p) + score(all_g - left_g, right_h, p) - score(all_g, all_h, p), -np.inf).astype(np.float32)
        at = gain.argmax(0)
        best = gain[at, np.arange(len(columns))]
        c = int(best.argmax())
        return float(best[c]), int(columns[c]), int(b[at[c], c]), False
    gain, cut, missing, _, _ = best_cuts(histograms(bins, np.zeros(len(bins), np.int64), g, h, 1, columns)[0], p, least_rows)
    c = int(gain.argmax())
    return float(gain[c]), int(columns[c]), int(cut[c]), bool(missing[c])


def node_cuts(bins: np.ndarray, g: np.ndarray, h: np.ndarray, rows: np.ndarray, start: np.ndarray, columns: np.ndarray, p: Params, least_rows: int = 1) -> tuple[np.ndarray, ...]:
    """``node_cut`` of many nodes: (gain, feature, cut, missing_left). Node i has the rows ``rows[start[i]:start[i + 1]]`` and
    looks at ``columns[i]``. Nodes of few rows are sorted together, padded to the same length; where each node looks at every
    column, larger ones share their histograms' sums."""
    count, k = columns.shape
    gain, feature, cut, missing = np.full(count, -np.inf), np.zeros(count, np.int64), np.zeros(count, np.int64), np.zeros(count, bool)
    size = np.diff(start)
    every = bool(columns.size) and k == bins.shape[1] and bool((columns == np.arange(k)).all())
    plain = bool((h == 1).all())                             # then hessians are numbers of rows
    most = SHARED_ROWS if every else SORTED_ROWS
    alone = np.flatnonzero(size > most).tolist()
    low = 1
    while low < most:
        length = 2 * low
        some = np.flatnonzero((size > low) & (size <= length))
        low, step = length, max(1, TILE // (length * max(k, 1)))
        shift = np.uint32(length.bit_length() - 1)           # (numbers of 32 bits are sorted several times as fast as those of 16)
        place, left = np.arange(length, dtype=np.uint32), np.arange(1.0, length)
        for a in range(0, len(some) if k else 0, step):
            part = some[a:a + step]
            n = size[part]
            inside = place < n[:, None]
            at = rows[np.where(inside, start[part][:, None] + place, start[part][:, None])]
            b = bins[at].transpose(0, 2, 1) if every else bins[at[:, None, :], columns[part][:, :, None]]
            blank = ~b.all((1, 2))
            if blank.any():                                  # missing values go either way: histograms
                alone += part[blank].tolist()
                part, n, inside, at, b = part[~blank], n[~blank], inside[~blank], at[~blank], b[~blank]
                if not len(part):
                    continue
            key = b.astype(np.uint32, order="C")
            key <<= shift
            key |= (place | np.where(inside, np.uint32(0), np.uint32(BINS << int(shift))))[:, None]
            key.sort(-1)
            order = (key[..., :-1] & np.uint32(length - 1)) + (np.arange(len(part)) * length)[:, None, None]
            key >>= shift
            ok = key[..., 1:] != key[..., :-1]
            gs = np.where(inside, g[at], 0.0)
            left_g, all_g = gs.ravel()[order].cumsum(-1), gs.sum(1)[:, None, None]
            if plain:
                left_h, all_h = left, n[:, None, None].astype(float)
            else:
                hs = np.where(inside, h[at], 0.0)
                left_h, all_h = hs.ravel()[order].cumsum(-1), hs.sum(1)[:, None, None]
            right_h = all_h - left_h
            ok &= ((left >= least_rows) & (left <= n[:, None] - least_rows))[:, None]
            if p.min_child_weight:
                ok &= (left_h >= p.min_child_weight) & (right_h >= p.min_child_weight)
            with np.errstate(all="ignore"):
                found = gains(left_g, left_h, all_g - left_g, right_h, score(all_g, all_h, p), p)
            np.copyto(found, -np.inf, where=~ok)
            found = found.astype(np.float32).reshape(len(part), -1)
            best = found.argmax(1)
            c, i = best // (length - 1), best % (length - 1)
            gain[part], feature[part] = found[np.arange(len(part)), best], columns[part, c]
            cut[part] = key[np.arange(len(part)), c, i]
    if every and alone:
        across, step = np.ascontiguousarray(bins.T), max(1, TILE // (BINS * k))
        for a in range(0, len(alone), step):
            part = np.array(alone[a:a + step])
            r = np.concatenate([rows[start[i]:start[i + 1]] for i in part])
            slot, sums, i = np.repeat(np.arange(len(part)) * BINS, size[part]), np.empty((3, len(part), k, BINS)), np.arange(len(part))
            weights = (g[r], None if plain else h[r], None)
            for c in range(k):
                key = slot + across[c][r]
                for j, x in enumerate(weights):
                    if j != 1 or not plain:
                        sums[j, :, c] = np.bincount(key, x, len(part) * BINS).reshape(-1, BINS)
            by_g, by_h, by_n = sums.reshape(3, -1, BINS)
            found, ends, side = (x.reshape(len(part), k) for x in plane_cuts(by_g, by_n if plain else by_h, by_n, p, least_rows))
            c = found.argmax(1)
            gain[part], feature[part], cut[part], missing[part] = found[i, c], c, ends[i, c], side[i, c]
        return gain, feature, cut, missing
    for i in alone:
        r = rows[start[i]:start[i + 1]]
        gain[i], feature[i], cut[i], missing[i] = node_cut(bins[r], g[r], h[r], columns[i], p, least_rows)
    return gain, feature, cut, missing


def parted(bins: np.ndarray, rows: np.ndarray, start: np.ndarray, nodes: np.ndarray, feature: np.ndarray, cut: np.ndarray, missing_left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows of the cut ``nodes``' children, left before right, and where each child's rows start."""
    size = np.diff(start)[nodes]
    own = np.repeat(np.arange(len(nodes)), size)
    r = rows[np.arange(len(own)) + np.repeat(start[nodes] - np.concatenate([[0], size.cumsum()[:-1]]), size)] if len(nodes) else rows[:0]
    b = bins[r, feature[own]]
    child = 2 * own + ~np.where(b == 0, missing_left[own], b <= cut[own])
    return r[child.argsort(kind="stable")], np.concatenate([[0], np.bincount(child, minlength=2 * len(nodes)).cumsum()]).astype(np.int64)


def sums_of(x: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Sum of each node's values; no node is without rows."""
    return np.add.reduceat(x, start[:-1]) if len(start) > 1 else np.zeros(0)


class Levels:
    """Nodes of a tree written level by level; the children of a level's cut nodes, in order, are the next level."""

    def __init__(self):
        self.parts, self.first = [], 0

    def add(self, value: np.ndarray, cover: np.ndarray, split: np.ndarray, feature=(), cut=(), missing_left=(), gain=()) -> None:
        n = len(value)
        one = {"feature": np.full(n, -1), "cut": np.zeros(n, int), "missing_left": np.zeros(n, bool), "left": np.full(n, -1), "right": np.full(n, -1), "value": value, "gain": np.zeros(n), "cover": cover}
        for name, x in (("feature", feature), ("cut", cut), ("missing_left", missing_left), ("gain", gain)):
            one[name][split] = x
        self.first += n
        one["left"][split] = self.first + 2 * np.arange(len(split))
        one["right"][split] = one["left"][split] + 1
        self.parts.append(one)

    def tree(self) -> Tree:
        return Tree(**{k: np.concatenate([x[k] for x in self.parts]).tolist() for k in self.parts[0]})


def sides(bins: np.ndarray, rows: np.ndarray, feature: int, cut: int, missing_left: bool) -> tuple[np.ndarray, np.ndarray]:
    b = bins[rows, feature]
    left = (b <= cut) & (b > 0) | (b == 0) & missing_left
    return rows[left], rows[~left]


def grow(bins: np.ndarray, g: np.ndarray, h: np.ndarray, columns: np.ndarray, p: Params, depth: int) -> Tree:
    """A whole tree over rows at hand."""
    out = Levels()
    rows, start = np.arange(len(bins)), np.array([0, len(bins)])
    if not len(bins):
        return Tree()
    bins, own_columns = bins[:, columns], np.arange(len(columns))
    for d in range(depth + 1):
        a, b = sums_of(g[rows], start), sums_of(h[rows], start)
        value = leaf_values(a, b, p)
        # too light for two sides: a leaf
        live = np.flatnonzero((np.diff(start) >= 2) & (b >= 2 * p.min_child_weight)) if d < depth and len(columns) else np.empty(0, np.int64)
        own = np.flatnonzero(np.repeat(np.isin(np.arange(len(b)), live), np.diff(start)))
        gain, feature, cut, missing = node_cuts(bins, g, h, rows[own], np.concatenate([[0], np.diff(start)[live].cumsum()]).astype(np.int64), np.tile(own_columns, (len(live), 1)), p)
        good = gain > LEAST_GAIN
        split = live[good]
        out.add(value, b, split, columns[feature[good]], cut[good], missing[good], gain[good])
        if not len(split):
            break
        rows, start = parted(bins, rows, start, split, feature[good], cut[good], missing[good])
    return out.tree()


# ---- sampling, the same on the driver and in tasks
def _hash(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sampled(row: np.ndarray, number: int, p: Params) -> np.ndarray:
    """Whether each row (by its hash) is in the sample of tree ``number``."""
    if p.subsample >= 1:
        return np.ones(len(row), bool)
    turn = _hash(np.array([p.seed * 1_000_003 + number], np.uint64))
    return _hash(row.view(np.uint64) ^ turn) >> np.uint64(11) < np.uint64(int(p.subsample * (1 << 53)))


def columns_of(number: int, features: int, p: Params) -> np.ndarray:
    k = max(1, int(round(features * p.colsample_bytree)))
    return np.sort(np.random.default_rng([p.seed, number]).permutation(features)[:k])


# ---- tables
def vector(features: str, df: DataFrame) -> Column:
    """An ML vector or an array column as an array of doubles."""
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(F.col(features)) if df.schema[features].dataType.simpleString() == "vector" else F.transform(features, lambda x: x.cast("double"))


def feature_cuts(df: DataFrame, features: str, width: int) -> list[np.ndarray]:
    """At most 254 ascending cuts for each feature, at the quantiles of its values; one aggregate over the rows."""
    places = F.array(*[F.lit(i / (BINS - 1)) for i in range(BINS)])
    v = df.select(vector(features, df).alias("v")).select(*[F.nanvl(F.get("v", F.lit(i)), F.lit(None).cast("double")).alias(f"x{i}") for i in range(width)])
    row = v.agg(*[F.percentile_approx(f"x{i}", places, 10_000).alias(f"x{i}") for i in range(width)]).first()
    return [np.unique(np.array(x or [], float))[1:BINS - 1] for x in row]


def _matrix(col: pa.Array, width: int) -> np.ndarray:
    """Rows of doubles, missing entries (and vectors) as NaN."""
    rows = [v if v is not None and len(v) == width else [None] * width for v in col.to_pylist()] if col.null_count or (np.diff(np.asarray(col.offsets)) != width).any() else None
    if rows is not None:
        return np.array([[np.nan if x is None else x for x in v] for v in rows], float).reshape(len(rows), width)
    return np.asarray(col.flatten().to_numpy(zero_copy_only=False), float).reshape(len(col), width)


def to_bins(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Bin of each entry: 0 if missing, else one more than the number of cuts at or below it."""
    out = np.empty(x.shape, np.uint8)
    for f, c in enumerate(cuts):
        out[:, f] = np.where(np.isnan(x[:, f]), 0, np.searchsorted(c, x[:, f], "right") + 1)
    return out


_CUT = pa.schema([("node", pa.int32()), ("feature", pa.int32()), ("gain", pa.float64()), ("cut", pa.int32()), ("missing", pa.bool_()), ("left", pa.list_(pa.float64())), ("total", pa.list_(pa.float64()))])
_TREE = pa.schema([("node", pa.int32()), ("number", pa.int32()), *[(c, pa.list_(pa.int32())) for c in ("feature", "cut")], ("missing_left", pa.list_(pa.bool_())),
                   *[(c, pa.list_(pa.int32())) for c in ("left", "right")], *[(c, pa.list_(pa.float64())) for c in ("value", "gain", "cover")]])
_STATE = "row bigint, y double, w double, val boolean, x binary, margin double"


def _parts(batch: pa.RecordBatch, width: int) -> dict[str, np.ndarray]:
    at = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
    out = {n: np.asarray(at[n]) for n in ("row", "y", "w", "margin")}
    out["bins"] = np.frombuffer(b"".join(at["x"].to_pylist()), np.uint8).reshape(-1, width)
    return out


@dataclass
class Boosted:
    """A fitted model: trees over cut numbers, and the cuts."""

    params: Params
    cuts: list[np.ndarray]
    base: float
    trees: list[Tree]
    #: Validation loss of each prefix of the trees, and the rounds (from 0) that are best and last trained.
    losses: list[float] = field(default_factory=list)
    best_round: int = -1
    last_round: int = -1

    def threshold(self, feature: int, cut: int) -> float:
        return float(self.cuts[feature][cut - 1]) if cut <= len(self.cuts[feature]) else float("inf")

    def nodes(self, spark: SparkSession) -> DataFrame:
        """(tree, node, feature, threshold, missing_left, left, right, value, gain, cover): left is below the threshold
        (infinite where only missing values go right)."""
        rows = [(t, i, f, self.threshold(f, m.cut[i]) if f >= 0 else None, m.missing_left[i], m.left[i], m.right[i], m.value[i], m.gain[i], m.cover[i])
                for t, m in enumerate(self.trees) for i, f in enumerate(m.feature)]
        return spark.createDataFrame(rows, "tree int, node int, feature int, threshold double, missing_left boolean, left int, right int, value double, gain double, cover double")

    def importance(self) -> np.ndarray:
        """Mean gain of each feature's cuts, as a share of one."""
        total, count = np.zeros(len(self.cuts)), np.zeros(len(self.cuts))
        for m in self.trees:
            for f, gain in zip(m.feature, m.gain):
                if f >= 0:
                    total[f] += gain
                    count[f] += 1
        mean = total / np.maximum(count, 1)
        return mean / mean.sum() if mean.sum() > 0 else mean

    def margins(self, df: DataFrame, features: str = "features", out: str = "margin") -> DataFrame:
        """``df`` with the model's margin; the trees go along with the task."""
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != features)
        rest = [c for c in df.columns if c != features]
        width, cuts, trees, base = len(self.cuts), self.cuts, self.trees, self.base

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bins = to_bins(_matrix(batch.column(len(rest)), width), cuts)
                total = np.full(batch.num_rows, base)
                for t in trees:
                    total += t.output(bins)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(total)], names=[*rest, out])

        return df.select(*rest, vector(features, df).alias("_v")).mapInArrow(run, f"{kinds}{', ' if rest else ''}`{out}` double")

    def predict(self, df: DataFrame, features: str = "features", keep: tuple[str, ...] = ("id", "y"), threshold: float = 0.5) -> DataFrame:
        """(keep..., p, pred) of a classifier, (keep..., p) of a regressor."""
        m = self.margins(df.select(*keep, features), features, "_margin")
        if self.params.objective == "squared":
            return m.select(*keep, F.col("_margin").alias("p"))
        return m.select(*keep, (F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("_margin")))).alias("p")).withColumn("pred", (F.col("p") >= threshold).cast("int"))


class _Fit:
    """The state of a fit: the stored rows and the trees their margin does not hold yet."""

    def __init__(self, df: DataFrame, features: str, label: str, key: str, valid: Column | None, p: Params, finish_rows: int):
        self.spark, self.p, self.finish_rows = df.sparkSession, p, finish_rows
        train = df if valid is None else df.where(~valid)
        first = train.agg(F.max(F.size(vector(features, df))), F.avg(F.col(label).cast("double")), F.count(label)).first()
        self.width, self.base = int(first[0] or 0), float(first[1] or 0.0) if p.objective == "squared" else 0.0
        self.rows = int(first[2])                            # an upper bound of a sample's rows
        self.cuts = feature_cuts(train, features, self.width) if self.rows and self.width else [np.empty(0)] * self.width
        weight = F.when(F.col(label) == 1, F.lit(p.scale_pos_weight)).otherwise(F.lit(1.0)) if p.objective == "logistic" else F.lit(1.0)
        rows = df.where(F.col(label).isNotNull()).select(F.xxhash64(key).alias("row"), F.col(label).cast("double").alias("y"), weight.cast("double").alias("w"),
                                                         F.coalesce(valid, F.lit(False)).alias("val") if valid is not None else F.lit(False).alias("val"), vector(features, df).alias("v"))
        width, cuts, base = self.width, self.cuts, self.base

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bins = to_bins(_matrix(batch.column(4), width), cuts)
                yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array([r.tobytes() for r in bins], pa.binary()), pa.array(np.full(len(bins), base))],
                                                 names=["row", "y", "w", "val", "x", "margin"])

        self.state = self._write(rows.mapInArrow(run, _STATE))
        self.trees: list[Tree] = []
        self.stored = 0

    def _write(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, "boosting")
        df.write.partitionBy("val").parquet(path)
        return self.spark.read.schema(_STATE).parquet(path)

    def _newer(self) -> list[Tree]:
        return self.trees[self.stored:]

    def store(self) -> None:
        newer, width = self._newer(), self.width

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                r = _parts(batch, width)
                yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(r["margin"] + sum(t.output(r["bins"]) for t in newer))], names=batch.schema.names)

        if newer:
            self.state = self._write(self.state.select("row", "y", "w", "val", "x", "margin").mapInArrow(run, _STATE))
            self.stored = len(self.trees)

    def losses(self) -> list[float]:
        """Mean validation loss after each tree that the stored margin does not hold."""
        newer, width, objective = self._newer(), self.width, self.p.objective

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, rows = np.zeros(len(newer)), 0
            for batch in batches:
                r = _parts(batch, width)
                margin, y = r["margin"].copy(), r["y"]
                rows += len(y)
                for i, t in enumerate(newer):
                    margin += t.output(r["bins"])
                    sums[i] += ((margin - y) ** 2).sum() if objective == "squared" else np.logaddexp(0, np.where(y > 0, -margin, margin)).sum()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(newer), dtype=np.int32)), pa.array(sums), pa.array(np.full(len(newer), rows))], names=["round", "loss", "n"])

        found = self.state.where("val").select("row", "y", "w", "val", "x", "margin").mapInArrow(run, "round int, loss double, n bigint").groupBy("round").agg(F.sum("loss").alias("loss"), F.sum("n").alias("n")).collect()
        mean = {r["round"]: r["loss"] / r["n"] if r["n"] else 0.0 for r in found}
        return [mean.get(i, 0.0) ** (0.5 if objective == "squared" else 1.0) for i in range(len(newer))]

    def add(self, most: int) -> None:
        """Grow the next tree, or, if one task may hold the sample, the next trees, ``most`` of them at most."""
        if self.rows <= self.finish_rows:
            self.trees += self._finish([], Tree(), most)[-1]
            return
        p, number = self.p, len(self.trees)
        columns = columns_of(number, self.width, p)
        tree, level, small, counts = Tree(), [0], [], {0: self.rows}
        for depth in range(p.max_depth + 1):
            small += [(node, depth) for node in level if counts[node] <= self.finish_rows]
            level = [node for node in level if counts[node] > self.finish_rows]
            if not level:
                break
            fresh = []
            for r in self._level(tree, level, columns):
                g, h = r["total"][0], r["total"][1]
                tree.value[r["node"]], tree.cover[r["node"]] = leaf_value(g, h, p), h
                if depth < p.max_depth and r["gain"] > LEAST_GAIN:
                    ends = tree.split(r["node"], r["feature"], r["cut"], r["missing"], r["gain"])
                    for end, part in zip(ends, (r["left"], [t - a for t, a in zip(r["total"], r["left"])])):
                        counts[end] = int(round(part[2]))
                        tree.value[end], tree.cover[end] = leaf_value(part[0], part[1], p), part[1]
                    fresh += ends
            level = fresh if depth + 1 < p.max_depth else []  # a last level needs no histogram: its sums are known
        small = [(node, depth) for node, depth in small if depth < p.max_depth]
        if small:
            for node, sub in self._finish(small, tree, 1)[0].items():
                tree.graft(node, sub)
        tree.prune(p.gamma)
        self.trees.append(tree)

    def _level(self, tree: Tree, level: list[int], columns: np.ndarray) -> list[dict]:
        """The best cut of each node of a level, from summed histograms."""
        newer, width, p, number = self._newer(), self.width, self.p, len(self.trees)

        def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                r = _parts(batch, width)
                slot_of = np.full(len(tree.feature), -1)
                slot_of[level] = np.arange(len(level))
                slot = np.where(sampled(r["row"], number, p), slot_of[tree.leaves(r["bins"])], -1)
                rows = np.flatnonzero(slot >= 0)
                bins = r["bins"][rows]
                margin = r["margin"][rows] + sum(t.output(bins) for t in newer)
                g, h = gradients(margin, r["y"][rows], r["w"][rows], p.objective)
                part = histograms(bins, slot[rows], g, h, len(level), columns)
                total = part if total is None else total + part
            if total is not None:
                for s, node in enumerate(level):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(columns), node, np.int32)), pa.array(columns.astype(np.int32)),
                                                      pa.array([total[s, c].tobytes() for c in range(len(columns))], pa.binary())], names=["node", "feature", "hist"])

        def best(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, held = None, None

            def close():
                gain, cut, missing, left, total = best_cuts(held[None], p)
                return pa.RecordBatch.from_pylist([{"node": key[0], "feature": key[1], "gain": float(gain[0]), "cut": int(cut[0]), "missing": bool(missing[0]), "left": left[0].tolist(), "total": total[0].tolist()}], _CUT)

            for batch in batches:
                for node, feature, blob in zip(*(c.to_pylist() for c in batch.columns)):
                    one = np.frombuffer(blob).reshape(BINS, 3)
                    if (node, feature) != key:
                        if key is not None:
                            yield close()
                        key, held = (node, feature), one.copy()
                    else:
                        held += one
            if key is not None:
                yield close()

        parts = self.state.where("not val").select("row", "y", "w", "val", "x", "margin").mapInArrow(sums, "node int, feature int, hist binary")
        found = parts.repartition("node", "feature").sortWithinPartitions("node", "feature").mapInArrow(best, "node int, feature int, gain double, cut int, missing boolean, left array<double>, total array<double>")
        best_of: dict[int, dict] = {}                        # a line a node and feature, of at most 2^depth nodes
        for r in found.collect():
            held = best_of.get(r["node"])
            if held is None or (r["gain"], -r["feature"]) > (held["gain"], -held["feature"]):
                best_of[r["node"]] = r.asDict()
        return list(best_of.values())

    def _finish(self, small: list[tuple[int, int]], tree: Tree, most: int) -> list:
        """Grow small nodes to the end, each in one task: [{node: subtree}]; or, without nodes, whole trees: [trees]."""
        newer, width, p, number = self._newer(), self.width, self.p, len(self.trees)
        columns = [columns_of(number + i, width, p) for i in range(most)]
        depths = dict(small) or {0: 0}

        def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                r = _parts(batch, width)
                node = tree.leaves(r["bins"])
                keep = np.isin(node, list(depths))
                if small:
                    keep &= sampled(r["row"], number, p)
                rows = np.flatnonzero(keep)
                margin = r["margin"][rows] + sum(t.output(r["bins"][rows]) for t in newer)
                names = batch.schema.names
                some = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([pa.array(node[rows].astype(np.int32)), *(some.column(names.index(c)) for c in ("row", "y", "w", "x")), pa.array(margin, pa.float64())],
                                                 names=["node", "row", "y", "w", "x", "margin"])

        def ready(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            r, node = _parts(t, width), t.column(0)[0].as_py()
            margin = r["margin"].copy()
            for i in range(most):
                keep = np.arange(len(margin)) if small else np.flatnonzero(sampled(r["row"], number + i, p))
                g, h = gradients(margin[keep], r["y"][keep], r["w"][keep], p.objective)
                one = grow(r["bins"][keep], g, h, columns[i], p, p.max_depth - depths[node])
                if not small:
                    one.prune(p.gamma)
                margin += one.output(r["bins"])
                yield pa.RecordBatch.from_pylist([{"node": node, "number": i, **one.__dict__}], _TREE)

        def subtrees(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pa.RecordBatch] = []
            for batch in batches:
                node = np.asarray(batch.column(0))
                edges = [0, *(np.flatnonzero(np.diff(node)) + 1).tolist(), len(node)]
                for a, b in zip(edges, edges[1:]):
                    if a == b:
                        continue
                    if held and held[0].column(0)[0].as_py() != node[a]:
                        yield from ready(held)
                        held = []
                    held.append(batch.slice(a, b - a))
            if held:
                yield from ready(held)

        rows = self.state.where("not val").select("row", "y", "w", "val", "x", "margin").mapInArrow(send, "node int, row bigint, y double, w double, x binary, margin double")
        kinds = "node int, number int, feature array<int>, cut array<int>, missing_left array<boolean>, left array<int>, right array<int>, value array<double>, gain array<double>, cover array<double>"
        # a fixed order of rows, so that sums and trees repeat
        found = rows.repartition("node").sortWithinPartitions("node", "row", "y").mapInArrow(subtrees, kinds).collect()
        made = {(r["node"], r["number"]): Tree(**{k: list(r[k]) for k in Tree().__dict__}) for r in found}
        return [{node: t for (node, _), t in made.items()}] if small else [[made.get((0, i), Tree()) for i in range(most)]]


def fit(df: DataFrame, params: Params = Params(), features: str = "features", label: str = "y", key: str = "id", valid: Column | None = None,
        patience: int | None = None, finish_rows: int = FINISH_ROWS) -> Boosted:
    """Fit on the rows of ``df`` (null labels are left out). ``valid`` marks the validation rows: they train nothing; with
    ``patience`` rounds without a smaller loss on them the fit ends and keeps the trees up to the best round."""
    if patience is not None and valid is None:
        raise ValueError("patience needs validation rows")
    state = _Fit(df, features, label, key, valid, params, finish_rows)
    model = Boosted(params, state.cuts, state.base, state.trees)
    rounds = ROUNDS_A_TASK if valid is None and state.rows <= finish_rows else ROUNDS_A_STORE
    while len(state.trees) < params.n_estimators and state.rows and state.width:
        end = min(len(state.trees) + rounds, params.n_estimators)
        while len(state.trees) < end:
            state.add(end - len(state.trees))
        if valid is not None:
            model.losses += state.losses()
            if patience is not None and stopped(model.losses, patience) is not None:
                break
        if end < params.n_estimators:
            state.store()
    if model.losses and patience is not None:
        end = stopped(model.losses, patience)
        model.last_round = len(model.losses) - 1 if end is None else end
        model.losses = model.losses[:model.last_round + 1]
        model.best_round = int(np.argmin(model.losses))
        model.trees = state.trees[:model.best_round + 1]
    else:
        model.trees, model.last_round = state.trees, len(state.trees) - 1
        model.best_round = model.last_round
    return model


def stopped(losses: list[float], patience: int) -> int | None:
    """The round at which ``patience`` rounds have passed without a smaller loss, if any."""
    best = 0
    for i, x in enumerate(losses):
        if x < losses[best]:
            best = i
        elif i - best >= patience:
            return i
    return None
