"""Near-duplicate texts by an LSH forest.

Each distinct shingle set gets ``BANDS * DEPTH`` min-hashes. Order t sorts the
sets by the signature from its own place on (and round). Sets that share the
first ``DEPTH`` values of an order are a run of it, a region, and its members are
the candidates. A region of at most ``BLOCK`` members is compared as it is. The
members of a larger one are sorted by the next values of the order, and the run is
cut where neighbours have the shortest common prefix until no part has more than
``BLOCK``; parts are compared whole, so that the closest meet first. All
comparisons are on full sets and return a spanning forest of the links, never all
pairs. Links make components; regions that lie in one component are done.

What is left in a region depends on the members outside its largest component.
Up to ``LARGE`` of them are compared across all parts, with one another and with
that component, so nothing is lost and the work is linear in the region. With
more, the region is split by another order's first values, and so on, region by
region, up to ``LEVELS`` times: only candidates that agree on 8, 12, 16 values meet
then, which keeps the comparisons of boilerplate from growing with its square.
Every set of orders is visited once, and only orders whose regions are open
themselves are added: in all others the pair has met already. At the last level
everything left is compared.

A pair at similarity 0.8 agrees on a number of orders B that is binomial(24,
0.8^4). It meets if B >= 1: 0.999997; where all its regions are split once, if
B >= 2: 0.99994; twice 0.9995, thrice 0.997; at 0.9 all but surely.

Null texts and texts without words have an empty set and link with nothing.
Rows that share a document id and set are one document; a null id never links.
Extra columns are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, may_be_in, shingle_sets, stored, text_chunks
from .components import components

#: Orders, values that make a region, and bands of values in a signature (one an order).
TREES, DEPTH, BANDS = 24, 4, 24
#: Members outside the largest component that are compared across a region, and members of a part.
LARGE, BLOCK = 512, 256
#: Times a region may be split by another order, and values by which its members are sorted.
LEVELS, AHEAD = 3, 8
#: Linked: 100 * intersection >= PERCENT * union.
PERCENT = 80
_RNG = np.random.default_rng(11)
_MUL = _RNG.integers(1, 1 << 63, BANDS * DEPTH, dtype=np.uint64) | np.uint64(1)
_ADD = _RNG.integers(1, 1 << 63, BANDS * DEPTH, dtype=np.uint64)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Min-hashes of sets that are not empty, one row each."""
    flat = np.concatenate(sets)
    first = np.cumsum([0, *map(len, sets)])[:-1]
    out = np.empty((len(sets), BANDS * DEPTH), np.uint32)
    for j in range(BANDS * DEPTH):
        out[:, j] = np.minimum.reduceat((flat * _MUL[j] + _ADD[j]) >> np.uint64(32), first)
    return out


def features(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5) -> DataFrame:
    """(k, n, digest, sig): set size, digest of the set and its signature (null without words)."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offs in text_chunks(batch):
                sets = shingle_sets(data, offs, size)
                full = [s for s in sets if len(s)]
                sig = iter(signatures(full).view(np.int32).tolist() if full else [])
                yield pa.RecordBatch.from_arrays(
                    [column(rows, "k"), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                     pa.array([next(sig) if len(s) else None for s in sets], pa.list_(pa.int32()))], names=["k", "n", "digest", "sig"])

    return df.select(F.col(key).alias("k"), F.col(text).alias("text")).mapInArrow(run, f"k {kind}, n bigint, digest binary, sig array<int>")


def _band(t: int) -> Column:
    """The name of a set's region in order t; regions of several orders are named by the xor of these."""
    return F.xxhash64(F.lit(t), F.slice("sig", t * DEPTH + 1, DEPTH))


def _sizes(keys: DataFrame) -> DataFrame:
    """(region, size, print): regions that can hold a link between different components."""
    found = keys.groupBy("region").agg(F.count("*").alias("size"), F.min("n").alias("low"), F.max("n").alias("high"),
                                       F.min("component").alias("c0"), F.max("component").alias("c1"), F.sum(F.xxhash64("rep") % (1 << 40)).alias("print"))
    found = found.where("c0 < c1").where((F.col("size") > 2) | (F.col("low") * 100 >= F.col("high") * PERCENT))
    return stored(found.select("region", "size", "print"), "regions")


def regions(reps: DataFrame) -> DataFrame:
    """(region, rep, n, last, size): the members of the regions of all orders; ``last`` is the order."""
    at = F.posexplode(F.array([_band(t) for t in range(TREES)]))
    keys = reps.select("rep", "n", F.col("rep").alias("component"), at.alias("last", "region"))
    found = _sizes(keys)
    # one of those with the same members; large ones stay, as each may have to be split
    large = F.col("size") > LARGE
    once = found.groupBy("size", F.when(large, F.col("region")).otherwise(F.col("print")).alias("as"), large).agg(F.min("region").alias("region"))
    return keys.join(stored(once.select("region", "size"), "regions"), "region").select("region", "rep", "n", "last", "size")


def split(left: DataFrame, reps: DataFrame) -> DataFrame:
    """(region, rep, n, last, size, may): regions split by each later order among ``may`` (bits), where
    members of unlike components still agree."""
    bands = stored(reps.select("rep", F.array([_band(t) for t in range(BANDS)]).alias("bands")).join(left.select("rep").distinct(), "rep"), "near-bands")
    later = F.expr(f"filter(sequence(0, {BANDS - 1}), j -> j > last and (may & shiftleft(1, j)) != 0)")
    rows = left.join(bands, "rep").select("region", "rep", "n", "component", "may", "bands", F.explode(later).alias("next"))
    keys = stored(rows.select(F.col("region").bitwiseXOR(F.expr("bands[next]")).alias("region"), "rep", "n", "component", F.col("next").alias("last"), "may"), "near-split")
    return keys.join(_sizes(keys).select("region", "size"), "region").select("region", "rep", "n", "last", "size", "may")


def _cut(a: int, b: int, prefix: np.ndarray, most: int, marks: list[int]) -> None:
    """Marks where the parts of the run a..b start: cut at the shortest common prefix (``prefix`` is that
    of each row with the one before) in its middle half while it has more than ``most`` rows."""
    todo = [(a, b)]
    while todo:
        a, b = todo.pop()
        if b - a <= most:
            marks.append(a)
            continue
        lo, hi = a + max(1, (b - a) // 4), b - (b - a) // 4
        at = lo + int(prefix[lo:hi].argmin())
        todo += [(a, at), (at, b)]


def parts(members: DataFrame, reps: DataFrame) -> DataFrame:
    """(region, rep, own, i, j): each member once. A region of at most BLOCK members is one part; the members of
    larger ones are sorted by the next values of the order, and the run is cut by common prefixes."""
    block = BLOCK
    part = F.lit(0).cast("long")
    small = members.where(F.col("size") <= block).select("region", "rep", part.alias("own"))
    ahead = F.expr(f"slice(concat(sig, sig), (last + 1) * {DEPTH} + 1, {AHEAD})").alias("ahead")
    large = members.where(F.col("size") > block).select("region", "rep", "last").join(reps.select("rep", "sig"), "rep").select("region", "rep", ahead)
    large = stored(large, "near-runs")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            region = column(batch, "region").to_numpy(zero_copy_only=False)
            values = column(batch, "ahead").flatten().to_numpy(zero_copy_only=False).reshape(m, AHEAD)
            same = np.append(np.zeros((1, AHEAD), bool), values[1:] == values[:-1], axis=0)
            prefix = np.where(same.all(1), AHEAD, same.argmin(1))
            first = np.flatnonzero(np.append(True, region[1:] != region[:-1])).tolist()
            marks: list[int] = []
            for a, b in zip(first, [*first[1:], m], strict=True):
                _cut(a, b, prefix, block, marks)
            own = np.zeros(m, np.int64)
            own[marks] = 1
            own = base + np.cumsum(own)
            base = int(own[-1])
            yield pa.RecordBatch.from_arrays([column(batch, "region"), column(batch, "rep"), pa.array(own)], names=["region", "rep", "own"])

    runs = large.repartitionByRange("region", "ahead", "rep").sortWithinPartitions("region", "ahead", "rep").mapInArrow(run, "region bigint, rep bigint, own bigint")
    runs = stored(runs, "near-runs")
    return small.unionAll(runs).select("region", "rep", "own", F.col("own").alias("i"), F.col("own").alias("j"))


def open_regions(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Members of the regions of several parts and several components, with their component, the region's
    largest one (``main``) and its members in and outside of that."""
    rows = members.where(F.col("size") > BLOCK).join(classes, F.col("rep") == F.col("node"), "left").drop("node", "size")
    rows = stored(rows.withColumn("component", F.coalesce("component", "rep")), "near-left")
    sums = rows.groupBy("region", "component").agg(F.count("*").alias("m"))
    sums = sums.groupBy("region").agg(F.max(F.struct("m", "component")).alias("top"), F.sum("m").alias("all")).where("all > top.m")
    sums = sums.select("region", F.col("top.component").alias("main"), F.col("top.m").alias("inside"), (F.col("all") - F.col("top.m")).alias("outside"))
    return stored(rows.join(stored(sums, "near-left"), "region"), "near-left")


def across(left: DataFrame) -> DataFrame:
    """(region, rep, own, i, j): members outside a region's largest component with one another and with that
    component, in pairs of hash blocks. What is connected already is not compared again."""
    blocks = lambda n: F.ceil(F.col(n) / BLOCK)                         # noqa: E731
    mark, other = F.xxhash64("region", "rep"), F.col("component") != F.col("main")
    rows = left.select("region", "rep", other.alias("other"), blocks("outside").alias("others"), blocks("inside").alias("mains"), mark.alias("mark"))
    rows = rows.withColumn("own", F.when(F.col("other"), F.pmod("mark", "others")).otherwise(F.col("others") + F.pmod("mark", "mains")))
    to = F.explode(F.sequence(F.lit(0).cast("long"), F.when(F.col("other"), F.col("others") + F.col("mains")).otherwise(F.col("others")) - 1))
    return stored(rows.select("region", "rep", "own", to.alias("to")).select("region", "rep", "own", F.least("own", "to").alias("i"), F.greatest("own", "to").alias("j")), "near-left")


def linked(sets: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """Matrix of links between sets, from full intersections."""
    n = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets)
    who = np.repeat(np.arange(len(sets)), n)
    _, at, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count[at] > 1                                   # others meet in no pair
    who, at = who[shared], at[shared]
    both = np.zeros((len(sets), len(sets)), np.float64)
    if len(at):
        ids = np.unique(at, return_inverse=True)[1]
        order = np.argsort(ids, kind="stable")
        ids, who = ids[order], who[order]
        for lo in range(0, int(ids[-1]) + 1, 4096):
            a, b = np.searchsorted(ids, (lo, lo + 4096))
            m = np.zeros((len(sets), min(4096, int(ids[-1]) + 1 - lo)), np.float32)
            m[who[a:b], ids[a:b] - lo] = 1
            both += m @ m.T
    union = n[:, None] + n[None, :] - both
    out = 100 * both >= percent * union
    out[n == 0] = False
    out[:, n == 0] = False
    return out


def forest(links: np.ndarray) -> np.ndarray:
    """The smallest index each row reaches by the links (symmetric matrix)."""
    label = np.arange(len(links))
    links = links | np.eye(len(links), dtype=bool)
    while True:
        new = np.where(links, label[None, :], len(label)).min(1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _links(ids: list[int], own: list[int], texts: list[str | None], size: int) -> list[tuple[int, int]]:
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    sets = shingle_sets(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), size)
    if len(sets) == 2:
        a, b = sets
        both = len(np.intersect1d(a, b, assume_unique=True)) if 100 * min(len(a), len(b)) >= PERCENT * max(len(a), len(b), 1) else 0
        return [(ids[0], ids[1])] if both and 100 * both >= PERCENT * (len(a) + len(b) - both) else []
    m = linked(sets)
    if len(set(own)) == 1:
        return [(ids[i], ids[j]) for i, j in enumerate(forest(m).tolist()) if i != j]
    # two blocks: what each connects within itself its own task returns; here one edge for what they add
    o = np.array(own)
    inside = forest(m & (o[:, None] == o[None, :]))
    parts, at = np.unique(inside, return_inverse=True)
    joined = np.zeros((len(parts), len(parts)), bool)
    r, c = np.nonzero(m & (o[:, None] != o[None, :]))
    joined[at[r], at[c]] = True
    return [(ids[parts[i]], ids[parts[j]]) for i, j in enumerate(forest(joined).tolist()) if i != j]


def links(df: DataFrame, members: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5) -> DataFrame:
    """(a, b): edges that connect what the verified links of each block, or pair of blocks, connect."""
    # only texts of members are sent; one plan at every size
    texts = may_be_in(df.select(F.col(key).alias("rep"), F.col(text).alias("text")), "rep", members.select("rep").distinct(), "sent").where("sent").drop("sent")
    rows = (members.join(texts.hint("merge"), "rep")
            .select("region", "i", "j", "own", "rep", "text").repartition("region", "i", "j").sortWithinPartitions("region", "i", "j", "rep"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []
        out: list[tuple[int, int]] = []

        def close():
            if len(held) > 1:
                own, ids, texts = map(list, zip(*held, strict=True))
                out.extend(_links(ids, own, texts, size))

        def send():
            a, b = zip(*out, strict=True) if out else ((), ())
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            cols = [column(batch, c).to_pylist() for c in ("region", "i", "j", "own", "rep", "text")]
            for region, i, j, own, rep, body in zip(*cols, strict=True):
                if (region, i, j) != group:
                    close()
                    group, held = (region, i, j), []
                held.append((own, rep, body))
            yield send()
        close()
        yield send()

    return rows.mapInArrow(run, "a bigint, b bigint")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5) -> DataFrame:
    """(key, n_shingles, component_id, kept) of every row: the set's size, the
    smallest id reachable by links, and whether that is the row itself."""
    found = stored(features(df, key, text, size), "near-features")
    same = stored(found.where("digest is not null and k is not null").groupBy("digest").agg(F.min("k").alias("rep")), "near-same")
    reps = found.join(same, "digest").where("k = rep").select(F.col("rep").cast("long").alias("rep"), "n", "sig")
    reps = stored(reps, "near-reps")
    members = stored(regions(reps), "near-members")
    edges = links(df, parts(members, reps), key, text, size)
    for level in range(LEVELS + 1):
        classes = stored(components(stored(edges, "near-links")), "near-classes")
        known = classes.select(F.col("node").alias("a"), F.col("component").alias("b"))
        left = open_regions(members, classes)
        if left.isEmpty():
            break
        shallow = F.col("outside") <= LARGE if level < LEVELS else F.lit(True)
        edges = links(df, across(left.where(shallow)), key, text, size).unionAll(known)
        deep = left.where(~shallow)
        if deep.isEmpty():
            classes = stored(components(stored(edges, "near-links")), "near-classes")
            break
        if level == 0:
            # orders that may be added: those whose region is split too
            own = deep.groupBy("rep").agg((F.bit_or(F.expr("shiftleft(1, last)")).bitwiseOR(F.lit((1 << BANDS) - (1 << TREES)))).alias("may"))
            deep = deep.join(stored(own, "near-may"), "rep")
        members = stored(split(deep, reps), "near-members")
        edges = edges.unionAll(links(df, parts(members, reps), key, text, size))
    ids = found.join(same, "digest", "left").select("k", "n", "rep")
    return (ids.join(classes, F.col("rep") == F.col("node"), "left")
            .select(F.col("k").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "rep", "k").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True))))
