"""Connected components of an edge table, by alternating large and small stars.

Each round hangs every node's larger neighbours on its smallest one, then its
smaller neighbours; the number of rounds grows with the logarithm of the
longest path. Every round's edges are written to the shared folder, so a lost
executor costs at most one round. A node with very many edges is no single
task: minima are summed before the shuffle, and the join back is between two
stored tables, which Spark splits where a key is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): component is the smallest node reachable. Nodes without
    an edge are absent; null ends and loops are ignored."""
    e = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    e = stored(e, "components")
    sign = None
    while True:
        count = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % 1_000_003).alias("s"), F.sum("v").alias("t")).first()
        if count["n"] == 0 or (now := tuple(count)) == sign:
            break
        sign = now
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stored(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "components")
        large = stored(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "components")
        low = stored(large.groupBy("u").agg(F.min("v").alias("m")), "components")
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stored(small.unionAll(low.select("u", F.col("m").alias("v"))).distinct(), "components")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
