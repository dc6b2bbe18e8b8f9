"""A training corpus from documents: five stages, each written and read again.

Rows without an id cannot be named: they stay through every stage, once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cirflow.llm import bpe, langid, mixing, near_text, secret_scan
from cirflow.llm.common import fresh, may_be_in, stored, table
from cirflow.llm.queries import _vocabulary

#: Words of a shingle in near_dedup; documents are linked at a Jaccard similarity of 0.8 of these sets.
SHINGLE = 5


#: Rows that reach a Python worker at a time: texts have no bound, so few.
BATCH_ROWS = 500


def _bounded(spark: SparkSession) -> None:
    """Small Arrow batches, for the memory of executors and their workers; a smaller setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without a letter, or mostly in a script that no language here is written in, go."""
    _bounded(spark)
    return langid.accepted(docs, langid.model(langid.train(docs)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles), that with the smallest id.
    Rows of one id with unlike texts are documents of their own."""
    _bounded(spark)
    # ids of several rows, from the ids alone; the texts of all other inputs need no shuffle
    twice = stored(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "near-twice")
    if twice.isEmpty():
        return _without(docs, "doc_id", _gone(docs, "doc_id")).select(*docs.columns)
    # a number for each (id, text), in the order of the ids
    mark, row, r = (fresh(docs, x) for x in ("_mark", "_row", "_first"))
    marked = docs.withColumn(mark, F.sha2(F.coalesce("text", F.lit("")), 256))
    named = marked.where("doc_id is not null")
    numbers = stored(named.select("doc_id", mark).distinct().orderBy("doc_id", mark).withColumn(row, F.monotonically_increasing_id()), "near-numbers")
    rows = named.join(numbers, ["doc_id", mark]).unionByName(marked.where("doc_id is null").withColumn(row, F.lit(None).cast("long")))
    rows = stored(rows.select(row, *docs.columns), "near-rows")
    left = _without(rows, row, _gone(rows, row))
    again = stored(rows.where(F.col(row).isNotNull()).groupBy(row).agg(F.count("*").alias("n")).where("n > 1").select(row), "near-again")
    # rows equal in id and text: the first by their other columns
    order = F.to_json(F.struct(*[c for c in docs.columns if c != "text"]))
    first = left.join(again, row, "left_semi").groupBy(row).agg(F.min_by(F.struct(*docs.columns), order).alias(r)).select(f"{r}.*")
    return _without(left, row, again).select(*docs.columns).unionByName(first)


def _gone(docs: DataFrame, key: str) -> DataFrame:
    """Keys of the documents that are near duplicates of one with a smaller key."""
    return stored(near_text.near_duplicates(docs, key, size=SHINGLE).where("not kept").select(key).distinct(), "near-gone")


def _without(docs: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """The rows whose key is not among ``ids``; only rows that may be are joined."""
    flag = fresh(docs, "_maybe")
    rows = may_be_in(docs, key, ids, flag)
    return rows.where(~F.col(flag)).unionByName(rows.where(flag).join(ids.hint("merge"), key, "left_anti")).drop(flag)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, secrets masked in the text; n_chars follows."""
    _bounded(spark)
    return secret_scan.mask(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; rows of one id and unlike sizes each as often as the mix takes them."""
    _bounded(spark)
    size, copies = fresh(docs, "_size"), fresh(docs, "_copies")
    taken = mixing.mix(docs).where("doc_id is not null").groupBy("doc_id", F.col("size").alias(size)).agg(F.max("copies").alias(copies))
    taken = stored(taken, "mix-copies")
    # one plan at every size: the ids grow with the documents, so they are never broadcast
    rows = docs.withColumn(size, mixing.words(F.col("text"))).join(taken.hint("merge"), ["doc_id", size], "left").withColumn(copies, F.coalesce(copies, F.lit(1)))
    return rows.where(F.col(copies) > 0).withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_merged, decoded, n_tokens) of each row."""
    _bounded(spark)
    out = bpe.encode_decode(docs, _vocabulary(spark))
    return out.withColumn("n_tokens", (F.length("ids") / 4).cast("long"))


STAGES = [("language", language), ("near_dedup", near_dedup), ("secrets", secrets), ("mixture", mixture), ("tokens", tokens)]
#: Fitted models and token ids have no SQL form; the tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
