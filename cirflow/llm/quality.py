"""Quality of texts by how far they diverge from their language. DataFrame functions only.

Every text gets the base counts (words, word characters, symbols, repeated
lines, words in repeated eight-word windows), a histogram of character classes
and one of its language's common words. The references are the summed
histograms of all texts of a language that pass the base rules. A text is kept
if it passes the base rules and, where it is long enough to tell, both
histograms lie within a Jensen-Shannon distance of the reference.

Null texts are empty: no words, so they fail the base rules. Texts whose
language is null or has no list of common words are compared with the character
classes of all texts together. Repeated rows are judged each for itself; extra
columns are dropped.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

BLANK = " \t\n\x0b\x0c\r"
#: Frequent function words.
COMMON = {
    "en": "the of and to in a is that it for on was be with as by at are this from".split(),
    "de": "der die und in den von zu das mit sich des auf ist im dem nicht ein eine als auch".split(),
    "fr": "de la le et les des en un du une que est dans qui par pour au sur il pas".split(),
    "es": "de la que el en y a los se del las un por con no una su para es lo".split(),
}
WINDOW = 8
MIN_WORDS, MOST_REPEATED = 20, 30
#: Least word characters and words of a text whose histograms can tell, and the largest
#: distances; that of words grows by the sampling noise of n words, WORD_NOISE / sqrt(n).
CHAR_GUARD, WORD_GUARD = 200, 60
CHAR_LIMIT, WORD_LIMIT, WORD_NOISE = 0.30, 0.21, 1.1
CLASSES = ("upper", "digit", "mark", "symbol", "foreign", "space", "other")


def bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, also inside lambdas."""
    return F.transform(F.array(value), use)[0]


def repeated(windows: Column, width: int = WINDOW) -> Column:
    """Words inside windows that occur twice or more, from the windows' hashes in order."""

    def again(s: Column) -> Column:
        same = lambda x, k: F.coalesce(x["h"] == F.get(s, k)["h"], F.lit(False))
        return F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1))

    def covered(p: Column) -> Column:
        return F.aggregate(F.transform(p, lambda x, k: F.coalesce(F.least(F.lit(width), F.get(p, k + 1) - x), F.lit(width))), F.lit(0), lambda s, x: s + x)

    pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    places = bound(pairs, lambda s: F.array_sort(F.transform(again(s), lambda x: x["i"])))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), bound(places, covered)).otherwise(F.lit(0)).cast("long")


def measures(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One narrow row a text: base counts, character classes and common words."""
    t = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(F.col(key).alias("k"), F.col(lang).alias("lang"), t.alias("t"))
    body = F.btrim("t", F.lit(BLANK))
    rows = rows.withColumn("w", F.when(F.length(body) == 0, F.array().cast("array<string>")).otherwise(F.split(body, r"[\x20\x09-\x0D]+")))
    rows = rows.withColumn("h", F.when(F.size("w") >= WINDOW, F.transform(F.sequence(F.lit(1), F.size("w") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("w", i, WINDOW))))
                           .otherwise(F.array().cast("array<bigint>")))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumn("l", lines)
    every = sorted({w for ws in COMMON.values() for w in ws})
    listed = reduce(lambda c, x: c.when(F.col("lang") == x[0], F.array(*map(F.lit, x[1]))), COMMON.items(), F.when(F.lit(False), F.array(F.lit(""))))
    rows = rows.withColumn("c", F.filter(F.transform("w", F.lower), lambda x: x.isin(every))).withColumn("list", listed)
    n = lambda p: F.regexp_count("t", F.lit(p)).cast("long")
    rows = rows.select(
        "k", "lang", F.size("w").cast("long").alias("n_words"), F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        n("[#*$%&|<>]").alias("n_symbols"), (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        repeated(F.col("h")).alias("n_repeat_words"), F.length("t").cast("long").alias("chars"),
        n("[A-Z]").alias("upper"), n("[0-9]").alias("digit"), n(r"[.,;:!?'\x22()\x2D]").alias("mark"), n(r"[^\x00-\x7F]").alias("foreign"),
        F.when(F.col("list").isNotNull(), F.transform("list", lambda x: (F.size("c") - F.size(F.array_remove("c", x))).cast("long"))).alias("common"))
    classes = [F.col("upper"), F.col("digit"), F.col("mark"), F.col("n_symbols"), F.col("foreign"), F.col("chars") - F.col("word_chars")]
    rest = F.col("chars") - reduce(lambda a, b: a + b, classes)
    total = F.aggregate("common", F.lit(0).cast("long"), lambda s, x: s + x)
    return rows.select("k", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       F.array(*classes, rest).alias("classes"), F.when(F.col("common").isNotNull(), F.concat("common", F.array(F.col("n_words") - total))).alias("common"))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two arrays of counts; null if one is null or empty."""
    add = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    share = lambda a: bound(add(a), lambda s: F.transform(a, lambda x: x / F.nullif(s, F.lit(0.0))))
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    terms = F.zip_with(share(p), share(q), lambda x, y: part(x, (x + y) / 2) + part(y, (x + y) / 2))
    return F.sqrt(F.greatest(F.lit(0.0), add(terms) / 2))


def references(rows: DataFrame) -> tuple[dict[str, list[float]], dict[str, list[float]], list[float]]:
    """Summed histograms of each listed language, and of all texts: a few dozen numbers."""
    good = rows.where("not base_failed")
    known = F.when(F.col("lang").isin(list(COMMON)), F.col("lang")).otherwise(F.lit(""))
    sums = lambda c: good.select(known.alias("lang"), F.posexplode(c).alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x")).orderBy("lang", "i").collect()
    chars: dict[str, list[float]] = {}
    commons: dict[str, list[float]] = {}
    for r in sums("classes"):
        chars.setdefault(r["lang"], []).append(float(r["x"]))
    for r in sums("common"):
        commons.setdefault(r["lang"], []).append(float(r["x"]))
    everything = [sum(v) for v in zip(*chars.values(), strict=True)] if chars else [0.0] * len(CLASSES)
    return chars, commons, everything


def judge(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(key, n_words, the base counts, base_failed, kept, char_distance, word_distance)."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    rows = stored(measures(df, key, text, lang).withColumn("base_failed", failed), "quality")
    chars, commons, everything = references(rows)
    lit = lambda v: F.array(*[F.lit(float(x)) for x in v])
    char_ref = reduce(lambda c, x: c.when(F.col("lang") == x[0], lit(x[1])), ((k, v) for k, v in chars.items() if k), F.when(F.lit(False), lit(everything))).otherwise(lit(everything))
    word_ref = reduce(lambda c, x: c.when(F.col("lang") == x[0], lit(x[1])), ((k, v) for k, v in commons.items() if k), F.when(F.lit(False), lit([0.0])))
    real = lambda c: F.transform(c, lambda x: x.cast("double"))
    rows = (rows.withColumn("char_distance", F.when(F.col("word_chars") >= CHAR_GUARD, distance(real("classes"), char_ref)))
            .withColumn("word_distance", F.when(F.col("n_words") >= WORD_GUARD, distance(real("common"), word_ref))))
    good = (F.coalesce(F.col("char_distance"), F.lit(0.0)) <= CHAR_LIMIT) & (F.coalesce(F.col("word_distance"), F.lit(0.0)) <= WORD_LIMIT + WORD_NOISE / F.sqrt(F.greatest("n_words", F.lit(1))))
    return rows.select(F.col("k").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                       (~F.col("base_failed") & good).alias("kept"), "char_distance", "word_distance")
