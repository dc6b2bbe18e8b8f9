"""One query for each operator: whole tables in, digest columns out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, hard_negatives, langid, lm, mixing, near_text, near_vec, pii, quality, secret_scan, toxicity, warc, whitening
from .common import crc_part, table

VOCABULARY = "byte_bpe_50k.json"


def _vocabulary(spark: SparkSession, path: str | None = None):
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    return bpe.load_vocabulary(spark, path)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.read_archives(spark, warc.archive(table(spark, sf_dir, "pages")),
                                 ["record_id", "type", "refers_to", "header_digest", "header_length", "payload_bytes", "payload_digest"])
    number = lambda c: F.col(c).substr(F.lit(len("urn:page:") + 1), F.length(c)).try_cast("bigint")
    return records.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), number("refers_to").alias("refers_to"),
                          ((F.col("payload_bytes") == F.col("header_length")) & (F.col("payload_digest") == F.col("header_digest"))).alias("headers_agree"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    base = [r.kind for r in secret_scan.BASE]

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(list(kinds)))

    return found.select("doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in base], F.sha2(_listed(of(*base)), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = crc_part(F.col("doc_id"), 7, 2)
    return lm.score(docs, lm.fit(docs.where(~held)), held)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = crc_part(F.col("doc_id"), 3, 1)
    model = toxicity.fit(docs.where(~held), table(spark, sf_dir, "labels"))
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return toxicity.score(docs, model, held).withColumn("spans", spans)


def op6_near_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_text.near_duplicates(table(spark, sf_dir, "documents"), size=2)


def op7_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vec.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = bpe.encode_decode(table(spark, sf_dir, "documents"), _vocabulary(spark))
    return tokens.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                         F.sha2("decoded", 256).alias("decoded_sha256"), "n_merged")


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.model(langid.train(docs.where(~crc_part(F.col("doc_id"), 4, 2))))
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["lang"], s["first_word"], s["words"])), ",")
    return langid.predict(docs, model).select("doc_id", crc_part(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score", spans.alias("spans"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, label=label)


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.concat("base", "more")).alias("spans"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_warc, op2_secret_scan, op3_source_mix, op4_lm_score, op5_toxicity, op6_near_text, op7_near_vectors, op8_quality, op9_bpe, op10_langid,
                             op11_whitening, op12_hard_negatives, op13_pii)}

_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
SQL: dict[str, str] = {
    "op1_warc": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body) AS n, sha1(body) AS h, max(page_id) OVER (PARTITION BY sha1(body)) AS first FROM p)
SELECT page_id, n::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('{_ALPHABET}',
    ((('0x' || substr(h, (5 * (i // 4) + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id < first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < first THEN first END AS refers_to, true AS headers_agree
FROM d""",
    "op6_near_text": r"""
WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
        ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END) AS g FROM t),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
x AS (SELECT s.doc_id, g, n FROM s JOIN n USING (doc_id)),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT c.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, c.doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)""",
    "op7_near_vectors": """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a), n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT c.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, component_id, c.vec_id = component_id AS kept FROM c LEFT JOIN n ON n.a = c.vec_id""",
    "op12_hard_negatives": """
WITH v AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT a.id AS anchor, b.id AS other, a.label = b.label AS same, list_sum(list_transform(range(1, len(a.x) + 1), lambda i: a.x[i] * b.x[i]))::BIGINT AS score
  FROM v a JOIN v b ON a.id <> b.id AND len(a.x) = len(b.x) WHERE a.id % 50 = 0),
p AS (SELECT anchor, other, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5)
SELECT p.anchor AS anchor_id, p.other AS positive_id, (row_number() OVER w)::INTEGER AS rank, s.other AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
WINDOW w AS (PARTITION BY p.anchor, p.other ORDER BY s.score DESC, s.other) QUALIFY row_number() OVER w <= 3""",
}
