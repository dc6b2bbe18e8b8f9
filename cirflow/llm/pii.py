"""Personal data by bootstrapped contextual extraction. DataFrame functions only.

Base entities (e-mail and IP addresses, card and phone numbers) are found by
regular expressions and checked (parts, digits, Luhn). They are the seeds.
Identifier-shaped units of the texts, seeds and others, stand in lexical
patterns: the word before, or the word after. Units and patterns form a graph.
Each round scores the patterns by the share of their word's occurrences in the
whole corpus that are at a member, and the units by the patterns they stand in
(noisy or); seeds are members of their kind throughout. A pattern counts with
``SUPPORT`` different members and a share of ``SHARE`` or more. Rounds go on
until the patterns stay the same, ``ROUNDS`` at most. What counts discovers: the
units in those patterns become spans of the kind with ``_like`` added.

Patterns whose word is more often away from any unit can never count and are
left out before the first round, so no join has a frequent word as its key.

Expressions are possessive: no backtracking, and no recursion over a long run.
Positions are code points, ends exclusive. Null texts are empty. Rows are taken
each for itself; equal texts are looked up once. Extra columns are dropped, an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

KINDS = ("email", "ip", "card", "phone")
LIKE = "_like"
#: Different members that a pattern needs, and their share of its word's occurrences.
SUPPORT, SHARE = 3, 0.5
#: Score from which a unit is a member; rounds at most.
MEMBER, ROUNDS = 0.5, 8
#: Characters of an identifier at least, and of a context word at most.
SHORTEST, LONGEST_WORD = 5, 64
#: Elements whose running sums are built one by one.
STRIDE = 128

_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
#: The contract's expressions, possessive, and begun only where a run begins (or the last match ended).
EXPRESSIONS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = r"0*+(?:(?<=0)|25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?)"
_JOIN = "@._%+#/-"
_RUN = f"[A-Za-z0-9{_JOIN}]"
#: Units: phone numbers, grouped cards, and runs with a digit.
UNIT = (rf"\+[0-9][\x20().0-9-]+[0-9]|(?<!{_RUN})[0-9]{{4}}(?:[\x20-][0-9]{{2,7}}){{2,4}}+(?![0-9])"
        rf"|(?<!{_RUN})(?=[A-Za-z{_JOIN}]*+[0-9]){_RUN}++")
_SPACE = r"[\x20\x09-\x0D]"
_SPAN = "array<struct<start:int,value:string>>"


def _fits(kind: str, v: Column) -> Column:
    """Whether a match of a kind's expression is an entity."""
    digits = F.regexp_replace(v, "[^0-9]", "")
    if kind == "ip":
        return v.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return F.length(digits).between(13, 19) & F.when(F.length(digits).between(13, 19), F.call_function("luhn_check", digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _guard(kind: str, text: Column) -> Column:
    return {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}.get(kind, text.rlike("[0-9]"))


def starts(pieces: Column, found: Column) -> Column:
    """Where each match begins, from the text between the matches and the matches; two levels
    of running sums, so that a text of very many matches costs no square of them."""
    ahead = lambda sums, x: F.array_append(sums, F.element_at(sums, -1) + x)
    steps = F.zip_with(F.slice(pieces, F.lit(1), F.size(found)), found, lambda p, f: F.length(p) + F.length(f))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(found) - 1) / STRIDE).cast("int")), lambda b: F.slice(steps, b * STRIDE + 1, F.lit(STRIDE)))
    inner = F.transform(blocks, lambda s: F.aggregate(s, F.array(F.lit(0)), ahead))
    outer = F.aggregate(inner, F.array(F.lit(0)), lambda sums, s: ahead(sums, F.element_at(s, -1)))
    before = F.flatten(F.zip_with(inner, F.slice(outer, F.lit(1), F.size(inner)), lambda s, o: F.transform(F.slice(s, F.lit(1), F.size(s) - 1), lambda x: x + o)))
    return F.zip_with(before, F.slice(pieces, F.lit(1), F.size(found)), lambda b, p: b + F.length(p))


def located(df: DataFrame, name: str, text: str, expression: str, guard: Column) -> DataFrame:
    """``df`` with ``name``, the (start, value) of each match, and ``name_pieces``, the text around them."""
    none = F.array().cast("array<string>")
    df = df.withColumn(f"{name}_found", F.when(guard, F.regexp_extract_all(text, F.lit(expression), F.lit(0))).otherwise(none))
    df = df.withColumn(f"{name}_pieces", F.when(F.size(f"{name}_found") > 0, F.split(text, expression, -1)).otherwise(none))
    df = df.withColumn(f"{name}_at", F.when(F.size(f"{name}_found") > 0, starts(F.col(f"{name}_pieces"), F.col(f"{name}_found"))))
    return df.withColumn(name, F.when(F.size(f"{name}_found") > 0, F.zip_with(f"{name}_at", f"{name}_found", lambda s, v: F.struct(s.alias("start"), v.alias("value"))))
                         .otherwise(F.array().cast(_SPAN))).drop(f"{name}_found", f"{name}_at")


def base(df: DataFrame, text: str) -> DataFrame:
    """``df`` with ``spans``: (kind, start, end) of the base entities, by kind as listed, then start."""
    for kind in KINDS:
        df = located(df, f"_{kind}", text, EXPRESSIONS[kind], _guard(kind, F.col(text))).drop(f"_{kind}_pieces")

    def spans(kind: str) -> Column:
        return F.transform(F.filter(f"_{kind}", lambda s: _fits(kind, s["value"])),
                           lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), (s["start"] + F.length(s["value"])).alias("end")))

    return df.withColumn("spans", F.concat(*map(spans, KINDS))).drop(*[f"_{k}" for k in KINDS])


def _digest(text: Column) -> Column:
    """Names a text; null where it has no digit, so no unit."""
    return F.when(text.rlike("[0-9]"), F.md5(text))


def units(texts: DataFrame) -> DataFrame:
    """(digest, copies, start, end, value, kind, side, word): the units of each different text, once for the word before and
    once for the word after; kind is that of a seed, else null."""
    df = texts.withColumn("digest", _digest(F.col("text"))).where("digest is not null")
    df = df.groupBy("digest").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    df = located(df, "u", "text", UNIT, F.lit(True))
    # what a unit needs of the text around it goes with it; the whole list of pieces does not
    near = F.transform("u_pieces", lambda p: F.struct(F.right(p, F.lit(2 * LONGEST_WORD)).alias("tail"), F.left(p, F.lit(2 * LONGEST_WORD)).alias("head")))
    parts = F.arrays_zip(F.col("u").alias("u"), near.alias("ahead"), F.slice(near, 2, F.size("u")).alias("behind"))
    df = df.select("digest", "copies", F.explode(F.slice(parts, F.lit(1), F.size("u"))).alias("p")).select("digest", "copies", "p.u", F.col("p.ahead.tail").alias("tail"), F.col("p.behind.head").alias("head"))
    before = F.lower(F.regexp_extract("tail", rf"([^\x20\x09-\x0D]++){_SPACE}*+$", 1))
    after = F.lower(F.regexp_extract("head", rf"^{_SPACE}*+([^\x20\x09-\x0D]++)", 1))
    head = F.length(F.regexp_extract("u.value", rf"^([{_JOIN}]*+)", 1))
    # a sign before a phone number belongs to it
    head = F.when(F.col("u.value").rlike(r"^\+[0-9]"), 0).otherwise(head)
    value = F.regexp_replace(F.substr("u.value", head + 1), rf"(?<![{_JOIN}])[{_JOIN}]++$", "")
    df = df.select("digest", "copies", (F.col("u.start") + head).alias("start"), value.alias("value"), before.alias("before"), after.alias("after"))
    kind = F.coalesce(*[F.when(F.col("value").rlike(f"^(?:{EXPRESSIONS[k]})$") & _fits(k, F.col("value")), F.lit(k)) for k in KINDS])
    df = df.withColumn("end", F.col("start") + F.length("value")).withColumn("kind", kind).where(F.col("kind").isNotNull() | (F.length("value") >= SHORTEST))
    sides = F.explode(F.array(F.struct(F.lit("before").alias("side"), F.col("before").alias("word")), F.struct(F.lit("after").alias("side"), F.col("after").alias("word"))))
    df = df.select("digest", "copies", "start", "end", "value", "kind", sides.alias("p")).select("digest", "copies", "start", "end", "value", "kind", "p.side", "p.word")
    return df.where(F.col("word").rlike(r"\p{L}") & (F.length("word") <= LONGEST_WORD))


def graph(seen: DataFrame, texts: DataFrame, support: int = SUPPORT, share: float = SHARE) -> DataFrame:
    """(side, word, value, kind, n, total): how often a unit stands in a pattern, and how often the pattern's word
    occurs in all texts; only patterns that could count if all their units were members."""
    edges = stored(seen.groupBy("side", "word", "value").agg(F.sum("copies").alias("n"), F.first("kind", ignorenulls=True).alias("kind")), "pii-edges")
    patterns = edges.groupBy("side", "word").agg(F.sum("n").alias("all"), F.count("*").alias("values")).where(F.col("values") >= support)
    patterns = stored(patterns.select("side", "word", "all"), "pii-patterns")
    words = texts.select(F.explode(F.split(F.lower("text"), f"{_SPACE}++")).alias("word")).groupBy("word").agg(F.count("*").alias("total"))
    totals = patterns.join(words, "word", "left").withColumn("total", F.greatest("all", F.coalesce("total", F.lit(0))))
    return stored(edges.join(totals.where(F.col("all") >= share * F.col("total")).select("side", "word", "total"), ["side", "word"]), "pii-graph")


def score(edges: DataFrame, support: int = SUPPORT, share: float = SHARE, rounds: int = ROUNDS) -> DataFrame:
    """(side, word, kind, share, support): the patterns that count after the last round."""
    seeds = edges.where("kind is not null").select("value", "kind").distinct().withColumn("member", F.lit(1.0))
    others = edges.where("kind is null").select("side", "word", "value")
    members, sign = stored(seeds, "pii-members"), None
    for _ in range(rounds):
        found = edges.select("side", "word", "value", "n", "total").join(members, "value").groupBy("side", "word", "kind").agg(
            (F.sum(F.col("n") * F.col("member")) / F.first("total")).alias("share"), F.count_if(F.col("member") >= MEMBER).alias("support"))
        found = stored(found.where((F.col("share") >= share) & (F.col("support") >= support)), "pii-scored")
        now = tuple(found.agg(F.count("*"), F.sum(F.xxhash64("side", "word", "kind") % 1_000_003), F.round(F.sum("share"), 6)).first())
        if now == sign:
            break
        sign = now
        chance = F.lit(1.0) - F.exp(F.sum(F.log(F.lit(1.0) - F.least("share", F.lit(0.999)))))
        more = others.join(found.select("side", "word", "kind", "share"), ["side", "word"]).groupBy("value", "kind").agg(chance.alias("member"))
        members = stored(seeds.unionByName(more), "pii-members")
    return found


def discovered(seen: DataFrame, patterns: DataFrame) -> DataFrame:
    """(digest, more): the spans that the patterns discover in each text, by kind as listed, then start."""
    hit = seen.where("kind is null").join(patterns.select("side", "word", F.col("kind").alias("like"), "share"), ["side", "word"])
    order = F.struct("share", *[(F.col("like") == k).alias(k) for k in KINDS])
    one = hit.groupBy("digest", "start", "end").agg(F.max_by("like", order).alias("like"))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("like"))
    spans = F.array_sort(F.collect_list(F.struct(rank.alias("rank"), "start", "end", F.concat("like", F.lit(LIKE)).alias("kind"))))
    return one.groupBy("digest").agg(F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("more"))


def find(df: DataFrame, key: str = "doc_id", text: str = "text", support: int = SUPPORT, share: float = SHARE, rounds: int = ROUNDS) -> DataFrame:
    """(key, base, more) of every row: arrays of (kind, start, end), the base entities and what the patterns discover;
    discovered spans never overlap base ones."""
    rows = df.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    seen = stored(units(rows.select("text")), "pii-units")
    patterns = score(graph(seen, rows.select("text"), support, share), support, share, rounds)
    more = stored(discovered(seen, patterns), "pii-discovered")
    named = base(rows.withColumn("digest", _digest(F.col("text"))), "text").select("k", "digest", "spans")
    out = named.join(more, "digest", "left").withColumn("more", F.filter(F.coalesce("more", F.array().cast(more.schema["more"].dataType)),
                                                                        lambda f: ~F.exists("spans", lambda b: (b["start"] < f["end"]) & (f["start"] < b["end"]))))
    return out.select(F.col("k").alias(key), F.col("spans").alias("base"), "more")
