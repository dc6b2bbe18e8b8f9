"""Hard negatives by Kronecker-packed products.

Anchors are a stated query set, searched against all rows. Components become
whole numbers, so scores are exact inner products. Candidates are packed:
components, biased to be positive, of several rows stand in separated fields of
one wide integer, an anchor multiplies each packed component once, and the sum
holds the scores of all packed rows, field by field. Fields are as wide as the
largest possible score of the tile; whole words stay below 2^52, where double
precision is exact and a matrix product is one call. Wider ones are Python
integers, of any width.

Anchors are numbered and cut into blocks of at most ``BLOCK_BYTES``, which bounds
what is broadcast. Each block is two scans of all rows over at most ``SLABS``
tasks, with no shuffle of vectors: first every task keeps the best positives of
each anchor, then, their scores known, the best negatives of each window. Only
these few rows a task are shuffled and ranked. Blocks run side by side.

Rows without id, label or vector, or with null or non-finite components take no
part, nor do rows whose whole-number vector has a squared length of 2^62 and
more (scores would not fit a long). Vectors of different length are never
compared. Repeated rows count as rows of their own; a row never finds its own
id. Extra columns are dropped, an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import column, share, stored
from .mixing import numbered

SCALE, POSITIVES, NEGATIVES = 256, 5, 3
#: A negative's score lies between these percentages of the positive's.
LOW, HIGH = 50, 95
#: Bytes of anchors in a block; tasks of a scan; blocks at work at a time; rows and anchors of a tile.
BLOCK_BYTES, SLABS, SIDE_BY_SIDE, TILE = 16 << 20, 32, 8, 1024
#: Bits of a whole number that a double holds exactly, less a sign.
WORD_BITS = 52
_LEAST = -(1 << 62)


def products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products (anchors x rows) of whole numbers, several rows a multiplication."""
    n, low = len(rows), int(rows.min())
    b = rows - low                                           # no field is negative
    most = int(np.abs(anchors).astype(object).sum(1).max()) * int(b.max())
    bits = (2 * most + 1).bit_length()
    kind, fields = (np.float64, WORD_BITS // bits) if bits <= WORD_BITS else (object, 4)
    fields = min(fields, n)
    width = -(-n // fields)
    words = np.zeros((rows.shape[1], width), kind)
    for f in range(fields):
        part = b[f * width:(f + 1) * width].T.astype(kind)
        words[:, :part.shape[1]] += part * kind(1 << bits * f) if kind is np.float64 else part << bits * f
    whole = np.int64 if kind is np.float64 else object
    sums = (anchors.astype(kind) @ words).astype(whole) + sum(most << bits * f for f in range(fields))
    out = np.empty((len(anchors), fields * width), np.int64)
    back = low * anchors.astype(whole).sum(1)[:, None] - most
    for f in range(fields):
        out[:, f * width:(f + 1) * width] = ((sums >> bits * f) & ((1 << bits) - 1)) + back
    return out[:, :n]


class Best:
    """The ``k`` best (score, id) of each of ``n`` groups: higher scores first, ties by smaller id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.rows = (np.empty(0, np.int64),) * 3             # group, score, id, in order
        self.least = np.full(n, _LEAST)                      # a row below it is not among the best

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(group):
            return
        g, s, i = (np.concatenate(x) for x in zip(self.rows, (group, score, ids), strict=True))
        order = np.lexsort((i, -s, g))
        g, s, i = g[order], s[order], i[order]
        rank = np.arange(len(g)) - np.searchsorted(g, g)
        full = rank == self.k - 1
        self.least[g[full]] = s[full]
        top = rank < self.k
        self.rows = g[top], s[top], i[top]


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """(ids, vectors, labels) of each vector length."""
    col = column(batch, "x")
    if not len(col):
        return
    dims = np.diff(np.asarray(col.offsets))
    for d in np.unique(dims).tolist():
        rows = batch.filter(pa.array(dims == d)) if (dims != d).any() else batch
        yield np.asarray(column(rows, "id")), np.asarray(column(rows, "x").flatten(), np.int64).reshape(rows.num_rows, d), column(rows, "label")


def _tiles(batches: Iterable[pa.RecordBatch], anchors: dict) -> Iterator[tuple[dict, np.ndarray, np.ndarray, np.ndarray]]:
    """(anchors of the length, ids, vectors, label numbers among the anchors' or -1) of each run of rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, TILE):
            for ids, x, labels in _matrices(batch.slice(at, TILE)):
                if (block := anchors.get(x.shape[1])) is not None and x.shape[1]:
                    yield block, ids, x, np.asarray(pc.fill_null(pc.index_in(labels, value_set=block["labels"]), -1))


def _sent(found: Iterable[tuple[np.ndarray, np.ndarray, Best]], slots: int) -> Iterator[pa.RecordBatch]:
    for places, lead, best in found:
        g, s, i = best.rows
        yield pa.RecordBatch.from_arrays([pa.array(places[lead[g // slots]]), pa.array((g % slots).astype(np.int32)), pa.array(s), pa.array(i)], names=["place", "slot", "score", "id"])


def _positives(rows: DataFrame, model, k: int) -> DataFrame:
    """(place, slot, score, id): each task's best rows of every anchor's label; slot is 0."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int, int], tuple[np.ndarray, np.ndarray, Best]] = {}
        for block, ids, x, code in _tiles(batches, model.value):
            for c in np.unique(code[code >= 0]).tolist():
                some = code == c
                mine = np.flatnonzero(block["code"] == c)
                for at in range(0, len(mine), TILE):
                    lead = mine[at:at + TILE]
                    best = held.setdefault((x.shape[1], c, at), (block["place"], lead, Best(len(lead), k)))[2]
                    s = products(block["x"][lead], x[some])
                    a, r = np.nonzero((s >= best.least[:, None]) & (block["id"][lead][:, None] != ids[some][None, :]))
                    best.add(a, s[a, r], ids[some][r])
        yield from _sent(held.values(), 1)

    return rows.mapInArrow(run, "place bigint, slot int, score bigint, id bigint")


def _negatives(rows: DataFrame, model, slots: int, k: int) -> DataFrame:
    """(place, slot, score, id): each task's best rows of other labels in the window of every positive."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, Best]] = {}
        for block, ids, x, code in _tiles(batches, model.value):
            for at in range(0, len(block["id"]), TILE):
                lead = np.arange(at, min(at + TILE, len(block["id"])))
                best = held.setdefault((x.shape[1], at), (block["place"], lead, Best(len(lead) * slots, k)))[2]
                s = products(block["x"][lead], x)
                fit = (block["code"][lead][:, None] != code[None, :]) & (block["id"][lead][:, None] != ids[None, :])
                for slot in range(slots):
                    least = np.maximum(block["low"][lead, slot], best.least[slot::slots])
                    a, r = np.nonzero(fit & (s >= least[:, None]) & (s <= block["high"][lead, slot][:, None]))
                    best.add(a * slots + slot, s[a, r], ids[r])
        yield from _sent(held.values(), slots)

    return rows.mapInArrow(run, "place bigint, slot int, score bigint, id bigint")


def _first(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each (place, slot), ranked from 1."""
    rank = F.row_number().over(Window.partitionBy("place", "slot").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def whole_numbers(df: DataFrame, key: str, vector: str, label: Column, scale: int = SCALE) -> DataFrame:
    """(id, label, x) of the rows that take part."""
    value = lambda c: c.cast("double") * scale
    fine = F.coalesce(F.forall(vector, lambda c: F.coalesce(F.abs(value(c)) < 2.0 ** 31, F.lit(False))), F.lit(False))
    rows = df.where(fine & F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), label.cast("string").alias("label"), F.transform(vector, lambda c: F.floor(value(c)).cast("long")).alias("x"))
    length = F.aggregate("x", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    return rows.where(F.col("label").isNotNull() & (length < 2.0 ** 62))


def mine(df: DataFrame, anchors: Column, key: str = "vec_id", vector: str = "embedding", label: Column | str = "label", positives: int = POSITIVES,
         negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each row that ``anchors``
    (a condition on the id, named ``id``) selects, and each of its best rows of the same label, the best rows of other
    labels that score between ``low`` and ``high`` percent of the positive."""
    spark = df.sparkSession
    rows = whole_numbers(df, key, vector, F.col(label) if isinstance(label, str) else label, scale)
    asked = numbered(rows.where(anchors).groupBy("id", "label", "x").agg(F.count("*").alias("copies")), F.col("id"), F.xxhash64("label", "x"))
    asked = stored(asked, "anchors")
    count, widest = asked.agg(F.count("*"), F.max(F.size("x"))).first()
    per = max(1, BLOCK_BYTES // (8 * max(widest or 1, 1)))
    path = scratch_path(spark, "hard-negatives")
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    scanned = rows.coalesce(SLABS)

    def block(b: int) -> None:
        t = asked.where(F.col("place").between(b * per, (b + 1) * per - 1)).select("place", "id", "label", "x", "copies").toArrow()   # at most BLOCK_BYTES
        lead = {}
        for part in t.combine_chunks().to_batches():
            dims = np.diff(np.asarray(column(part, "x").offsets))
            for d in np.unique(dims).tolist():
                mine = part.filter(pa.array(dims == d))
                labels = column(mine, "label").unique()
                lead[d] = {"place": np.asarray(column(mine, "place")), "id": np.asarray(column(mine, "id")), "copies": np.asarray(column(mine, "copies")), "labels": labels,
                           "code": np.asarray(pc.index_in(column(mine, "label"), value_set=labels)), "x": np.asarray(column(mine, "x").flatten(), np.int64).reshape(mine.num_rows, d)}
        model = share(spark, lead)
        best = _first(_positives(scanned, model, positives), positives).select("place", "rank", "score", "id").toArrow()   # a few rows an anchor of the block
        score = dict(zip(zip(best["place"].to_pylist(), best["rank"].to_pylist()), zip(best["score"].to_pylist(), best["id"].to_pylist())))
        pairs = {}                                           # (place, slot): what a found row needs
        for m in lead.values():
            m["low"], m["high"] = np.zeros((len(m["id"]), positives), np.int64), np.full((len(m["id"]), positives), -1)
            for r, (place, anchor, copies) in enumerate(zip(m["place"].tolist(), m["id"].tolist(), m["copies"].tolist(), strict=True)):
                for slot in range(positives):
                    if (place, slot + 1) in score:
                        s, found = score[place, slot + 1]
                        m["low"][r, slot], m["high"][r, slot] = -(-low * s // 100), high * s // 100
                        pairs[place, slot] = anchor, found, s, copies
        model, named = share(spark, lead), share(spark, pairs)

        def name(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = [(a, p, r, i, ps, s) for place, slot, s, i, r in zip(*(column(batch, c).to_pylist() for c in ("place", "slot", "score", "id", "rank")), strict=True)
                       for a, p, ps, copies in [named.value[place, slot]] for _ in range(copies)]
                cols = list(zip(*out, strict=True)) if out else [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                                                 names=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

        found = _first(_negatives(scanned, model, positives, negatives), negatives).select("place", "slot", "score", "id", "rank")
        found.mapInArrow(name, schema).write.parquet(f"{path}/block-{b}")

    blocks = -(-count // per)
    if not blocks:
        return spark.createDataFrame([], schema)
    with ThreadPool(min(blocks, SIDE_BY_SIDE)) as pool:      # jobs of a few tasks each; Spark schedules them together
        pool.map(block, range(blocks))
    return spark.read.schema(schema).parquet(*[f"{path}/block-{b}" for b in range(blocks)])
