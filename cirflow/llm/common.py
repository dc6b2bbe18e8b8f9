"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: The ASCII white space that separates words: space and 0x09-0x0D.
SPACES = b" \t\n\x0b\x0c\r"
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
#: Maps A-Z to a-z and every other byte to itself.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Text bytes that a worker handles at a time; bounds its memory, whole documents always.
CHUNK_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_part(key: Column, modulus: int, part: int) -> Column:
    """True where crc32(key as text) mod ``modulus`` is ``part``; null keys are never in the part."""
    crc = F.crc32(key.cast("string").cast("binary"))
    return F.coalesce(crc % F.lit(modulus) == F.lit(part), F.lit(False))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later plans
    start from files that every executor can read again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bits of a bitmap of ids (2 MB), in words of 64.
BITMAP_BITS = 1 << 24


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def may_be_in(df: DataFrame, key: str, ids: DataFrame, flag: str) -> DataFrame:
    """``df`` with ``flag``: false where the key is surely not among ``ids`` (one column), so that only the others need
    an exact join. The ids become a bitmap of hashes, at most BITMAP_BITS / 64 rows, which is broadcast: one plan at
    every size; more ids only make it less sharp."""
    place = F.pmod(F.xxhash64(F.col(ids.columns[0])), F.lit(BITMAP_BITS))
    bits = ids.select(place.alias("p")).select(F.expr("p div 64").alias("w"), F.expr("shiftleft(1L, cast(p % 64 as int))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b"))
    bits = stored(bits, "bitmap")
    w, b, p = (fresh(df, x) for x in ("_word", "_bits", "_place"))
    rows = df.withColumn(p, F.pmod(F.xxhash64(F.col(key).cast(ids.schema[0].dataType)), F.lit(BITMAP_BITS)))
    rows = rows.join(F.broadcast(bits.select(F.col("w").alias(w), F.col("b").alias(b))), F.expr(f"`{p}` div 64") == F.col(w), "left")
    hit = F.coalesce(F.expr(f"(`{b}` & shiftleft(1L, cast(`{p}` % 64 as int))) != 0"), F.lit(False)) & F.col(key).isNotNull()
    return rows.withColumn(flag, hit).drop(w, b, p)


def text_chunks(batch: pa.RecordBatch, column: str = "text",
                limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut a batch into runs of whole rows of about ``limit`` text bytes.

    Yields (rows, bytes, offsets): the UTF-8 bytes of the rows' texts one after
    the other and where each row starts (one more offset at the end); null is empty.
    """
    col = pc.fill_null(batch.column(batch.schema.get_field_index(column)), "")
    if col.offset or len(col) == 0:
        col = pa.concat_arrays([col]) if len(col) else col
    if not len(col):
        return
    wide = pa.types.is_large_string(col.type)
    offs = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.empty(0, np.uint8)
    start = 0
    while start < len(col):
        stop = int(np.searchsorted(offs, offs[start] + limit, "right")) - 1
        stop = min(max(stop, start + 1), len(col))
        yield batch.slice(start, stop - start), data[offs[start]:offs[stop]], offs[start:stop + 1] - offs[start]
        start = stop


def spread(data: np.ndarray, offs: np.ndarray, before: int, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Copy the rows' bytes with ``before`` bytes of value ``gap`` ahead of each
    row and one after the last; returns the array and where each row starts."""
    n = len(offs) - 1
    out = np.full(len(data) + before * n + 1, gap, np.uint8)
    lens = np.diff(offs)
    starts = offs[:-1] + before * (np.arange(n) + 1)
    out[np.arange(len(data)) + np.repeat(before * (np.arange(n) + 1), lens)] = data
    return out, starts


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def share(spark: SparkSession, value):
    """Broadcast a value whose size the caller has bounded."""
    return spark.sparkContext.broadcast(value)


def joined(base: str, *parts: str) -> str:
    return os.path.join(base, *parts)


#: Random numbers for each byte at each of the first 64 places of a word.
_WORD_TABLE = np.random.default_rng(7).integers(1, 1 << 63, (64, 256), dtype=np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash, row) of each lower-cased word of all texts, in order."""
    flat, starts = spread(LOWER[data], offs, 1, 32)
    space = IS_SPACE[flat]
    first = np.flatnonzero(~space & np.append(True, space[:-1]))
    if not len(first):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    place = np.arange(len(flat), dtype=np.int32)
    place[first[0]:] -= np.repeat(first, np.diff(np.append(first, len(flat)))).astype(np.int32)
    place[:first[0]] = 0
    value = _WORD_TABLE[place & 63, flat]
    far = place > 63
    if far.any():
        value[far] *= (2 * (place[far] >> 6) + 1).astype(np.uint64)
    value[space] = 0
    return mix64(np.add.reduceat(value, first)), np.searchsorted(starts, first, "right") - 1


def shingle_sets(data: np.ndarray, offs: np.ndarray, size: int = 2) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than ``size`` make one shingle, none make none."""
    h, row = word_hashes(data, offs)
    n = np.bincount(row, minlength=len(offs) - 1)
    ends = np.cumsum(n)
    out = []
    roll = np.zeros(len(h), np.uint64)
    for k in range(size):
        roll[:len(h) - k] = roll[:len(h) - k] * np.uint64(0x9E3779B97F4A7C15) + h[k:]
    roll = mix64(roll + np.uint64(size))
    for i, (m, e) in enumerate(zip(n.tolist(), ends.tolist(), strict=True)):
        if m >= size:
            out.append(np.unique(roll[e - m:e - size + 1]))
        elif m:
            x = np.zeros(1, np.uint64)
            for w in h[e - m:e]:
                x = x * np.uint64(0x9E3779B97F4A7C15) + w
            out.append(mix64(x + np.uint64(1000 + m)))
        else:
            out.append(np.empty(0, np.uint64))
    return out
