"""Mixing sources to target weights by entropy balancing. DataFrame functions only.

Sources take weights in turn and share ``portion`` of all words; a target stops
at ``most`` times its source's size and the excess goes to the others by weight.
Among all document rates that meet a source's target, the balanced ones are
nearest in entropy to taking every document once: rate = exp(lambda * size),
at most ``most``. Lambda solves the convex dual, one number a source, by Newton
steps that stay inside a bracket; each step is one aggregation over the table
of (source, size) counts, which the documents were summed into once.

Rates become copies by systematic rounding along the sizes of a source: the
sum of the fractions decides how many documents of each size get one copy more,
so a source misses its target by less than one document. Which ones is decided by
a hash of the id: whole hash buckets, and within the one bucket where the
number runs out by rank. Buckets are the square root of a size's count, so
neither their number nor their size is that of a hot group.

Null and empty texts have size 0 and take nothing. Null sources are one source,
the last. Rows are taken each for itself; repeated ids are ranked together.
With an empty table the result is empty.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

WEIGHTS = (3.0, 1.0, 2.0)
PORTION, MOST = 1.5, 2.0
WORD = r"[^\x20\x09-\x0D]+"
STEPS, NEAR = 80, 1e-7
#: Places where the systematic rounding may begin; each source takes the one that misses least.
STARTS = 64


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` with ``place``, 0, 1, ... by the order: sorted over partitions, written
    once, and numbered by the rows that earlier partitions hold."""
    rows = stored(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "numbered")
    rows = rows.withColumn("part", F.shiftright("at", 33)).withColumn("row", F.col("at").bitwiseAND((1 << 33) - 1))
    sizes = rows.groupBy("part").agg(F.count("*").alias("n"))            # one row a partition
    ahead = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("ahead"))
    return rows.join(ahead, "part").withColumn("place", F.col("ahead") + F.col("row")).drop("at", "part", "row", "ahead")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, portion: float = PORTION, most: float = MOST) -> DataFrame:
    """(sid, source, source_size, target) of each source; ``sizes`` has (source, source_size, docs)."""
    rows = numbered(sizes, F.col("source").isNull(), F.col("source")).withColumnRenamed("place", "sid")
    weight = reduce(lambda x, i: x.when(F.col("sid") % len(weights) == i, weights[i]), range(len(weights)), F.when(F.lit(False), 0.0))
    rows = stored(rows.withColumn("weight", weight).withColumn("cap", most * F.col("source_size")), "sources")
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = 0.0, -1
    full = lambda: F.col("cap") <= F.col("weight") * F.lit(level)
    while True:                                               # three numbers a round reach the driver
        r = rows.agg(F.coalesce(F.sum(F.when(full(), F.col("cap"))), F.lit(0.0)).alias("taken"),
                     F.coalesce(F.sum(F.when(~full(), F.col("weight"))), F.lit(0.0)).alias("open"), F.count(F.when(full(), 1)).alias("n")).first()
        if r["open"] == 0 or r["n"] == stopped:
            break
        stopped, level = r["n"], (portion * total - r["taken"]) / r["open"]
    return rows.withColumn("target", F.least("cap", F.col("weight") * F.lit(float(level)))).drop("weight", "cap")


def balance(cells: DataFrame, sources: DataFrame, most: float = MOST) -> DataFrame:
    """(sid, lam): the dual solution of each source. ``cells`` has (sid, size, n, z), z the scaled size."""
    lam = sources.select("sid", "target", F.log(F.try_divide("target", "source_size")).alias("lam"), F.lit(-1e5).alias("lo"), F.lit(1e5).alias("hi"))
    lam = stored(lam.where("source_size > 0"), "balance")
    grow = F.exp(F.least(F.col("lam") * F.col("z"), F.lit(50.0)))
    for _ in range(STEPS):
        mass = F.col("n") * F.col("size")
        sums = (cells.join(lam, "sid").groupBy("sid")
                .agg(F.sum(mass * F.least(grow, F.lit(most))).alias("got"), F.sum(F.when(grow < most, mass * F.col("z") * grow).otherwise(0.0)).alias("slope"),
                     F.first("target").alias("target"), F.first("lam").alias("lam"), F.first("lo").alias("lo"), F.first("hi").alias("hi")))
        low = F.col("got") < F.col("target")
        sums = sums.withColumn("lo", F.when(low, F.col("lam")).otherwise(F.col("lo"))).withColumn("hi", F.when(low, F.col("hi")).otherwise(F.col("lam")))
        newton = F.col("lam") + (F.col("target") - F.col("got")) / F.nullif("slope", F.lit(0.0))
        inside = (newton > F.col("lo")) & (newton < F.col("hi"))
        half = F.when((F.col("lo") > -1e5) & (F.col("hi") < 1e5), (F.col("lo") + F.col("hi")) / 2).when(low, F.abs("lam") * 4 + 1).otherwise(-F.abs("lam") * 4 - 1)
        miss = F.abs(F.col("got") - F.col("target")) / F.greatest("target", F.lit(1.0))
        lam = stored(sums.select("sid", "target", F.when(miss <= NEAR, F.col("lam")).when(F.coalesce(inside, F.lit(False)), newton).otherwise(F.greatest(F.lit(-1e5), F.least(F.lit(1e5), half))).alias("lam"),
                                 "lo", "hi", miss.alias("miss")), "balance")
        worst = lam.agg(F.max("miss")).first()[0]
        lam = lam.drop("miss")
        if worst is None or worst <= NEAR:
            break
    return lam.select("sid", "lam")


def mix(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = WEIGHTS,
        portion: float = PORTION, most: float = MOST) -> DataFrame:
    """(key, size, source_size, target, taken, copies, rate) of every row."""
    rows = stored(df.select(F.col(key).alias("k"), F.col(source).alias("source"), words(F.col(text)).alias("size")), "mix-sizes")
    counts = stored(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-counts")
    sources = targets(counts.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("docs"),
                                                   F.sum(F.col("n") * F.col("size") * F.col("size").cast("double")).alias("squares")), weights, portion, most)
    sources = stored(sources, "mix-sources")
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    cells = counts.join(sources, same(counts, sources)).select("sid", "size", "n", "target", "source_size", F.try_divide(F.col("size") * F.col("source_size").cast("double"), F.col("squares")).alias("z"))
    cells = stored(cells, "mix-cells")
    # full sources take every document to the most; the others are balanced
    open_ = F.col("target") < most * F.col("source_size") * (1 - 1e-12)
    lam = balance(cells.where("size > 0").where(open_).select("sid", "size", "n", "z"), sources.where(open_).where("target > 0"), most)
    rate = F.when(F.col("size") == 0, 0.0).when(~open_, most).when(F.col("target") <= 0, 0.0).otherwise(F.least(F.exp(F.least(F.col("lam") * F.col("z"), F.lit(50.0))), F.lit(most)))
    cells = cells.join(lam, "sid", "left").withColumn("rate", rate).withColumn("whole", F.floor("rate")).withColumn("part", (F.col("rate") - F.col("whole")) * F.col("n"))
    run = F.sum("part").over(Window.partitionBy("sid").orderBy("size").rowsBetween(Window.unboundedPreceding, 0))
    cells = stored(cells.withColumn("run", run), "mix-run")
    more = F.greatest(F.lit(0), F.least(F.col("n"), F.floor(F.col("run") + F.col("start")) - F.floor(F.col("run") - F.col("part") + F.col("start"))))
    tries = (cells.withColumn("start", F.explode(F.array(*[F.lit((i + 0.5) / STARTS) for i in range(STARTS)]))).groupBy("sid", "start")
             .agg(F.abs(F.sum((more - F.col("part")) * F.col("size"))).alias("off")).groupBy("sid").agg(F.min(F.struct("off", "start"))["start"].alias("start")))
    cells = cells.join(stored(tries, "mix-start"), "sid").withColumn("more", more)
    # by hash buckets: all of a bucket, none, or by rank in the one where the number runs out
    cells = stored(cells.withColumn("buckets", F.when((F.col("more") > 0) & (F.col("more") < F.col("n")), F.ceil(F.sqrt("n"))).otherwise(F.lit(1)))
                   .join(sources.select("sid", "source"), "sid").select("source", "size", "sid", "source_size", "target", "rate", "whole", "more", "buckets", F.col("n").alias("in_cell")), "mix-cells")
    mark = F.pmod(F.xxhash64(F.lit("mix"), "k"), F.lit(1 << 40))
    rows = rows.withColumn("mark", mark)
    cells = cells.withColumnRenamed("source", "s").withColumnRenamed("size", "z")
    placed = rows.join(cells, rows["source"].eqNullSafe(cells["s"]) & (rows["size"] == cells["z"])).drop("s", "z", "source")
    placed = stored(placed.withColumn("bucket", F.floor(F.col("mark") / float(1 << 40) * F.col("buckets"))), "mix-placed")
    sizes = placed.where("buckets > 1").groupBy("sid", "size", "bucket").agg(F.count("*").alias("m"), F.first("more").alias("more"))
    upto = F.sum("m").over(Window.partitionBy("sid", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    sizes = stored(sizes.withColumn("upto", upto).select("sid", "size", "bucket", F.greatest(F.lit(0), F.least("m", F.col("more") - F.col("upto") + F.col("m"))).alias("take"), "m"), "mix-buckets")
    some = placed.where("buckets > 1").join(sizes, ["sid", "size", "bucket"])
    rank = F.row_number().over(Window.partitionBy("sid", "size", "bucket").orderBy("mark", "k"))
    out = ["k", "size", "source_size", "target", "whole", "extra", "rate"]
    whole = placed.where("buckets = 1").withColumn("extra", (F.col("more") == F.col("in_cell")).cast("int")).select(*out)
    clear = some.where("take = 0 or take = m").withColumn("extra", (F.col("take") > 0).cast("int")).select(*out)
    edge = some.where("take > 0 and take < m").withColumn("extra", (rank <= F.col("take")).cast("int")).select(*out)
    copies = F.col("whole") + F.col("extra")
    return whole.unionAll(clear).unionAll(edge).select(F.col("k").alias(key), "size", F.col("source_size").cast("long").alias("source_size"), "target",
                                                       F.when(F.col("size") > 0, copies * F.col("size")).otherwise(0).cast("long").alias("taken"),
                                                       F.when(F.col("size") > 0, copies).otherwise(0).cast("int").alias("copies"), "rate")
