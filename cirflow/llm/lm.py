"""Language model: a probabilistic suffix tree over the bytes of the tokens.

A text is its lower-cased words, each followed by a space, and an end symbol.
All training texts are counted: six-byte sequences, summed in each task, then
over tasks. A context of up to five bytes becomes a state if its share of the
corpus is at least ``MIN_SHARE`` and its next-byte distribution differs enough
from that of the context without its oldest byte: share times
Kullback-Leibler divergence at least ``MIN_GAIN`` nats. At most 5 / MIN_SHARE
contexts can pass, whatever the corpus, so the tree fits a broadcast. States
mix their counts with their parent's distribution (Witten-Bell); the root adds
one. A text is scored in the longest suffix states, by an automaton whose
states are the tree's contexts and their parts.

Beside it stands the add-one unigram model over whole tokens, with counts over
the whole training corpus: the most frequent tokens (at most ``HOT_WORDS``) are
looked up in a broadcast dictionary, all others by a join.

Null texts are empty: one end token. Null keys belong to the training part.
With no training text the tree is a uniform root. Repeated rows are scored
each for itself; extra columns are dropped.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import IS_SPACE, LOWER, column, share, spread, stored, text_chunks

DEPTH = 5
END = 10
MIN_SHARE = 1e-6
MIN_GAIN = 1e-7
#: Nats of gain asked for each half logarithm of the count and kind of next byte.
TEST = 0.6
HOT_WORDS = 300_000
#: Distinct tokens and sequences that a task holds before it sends partial sums.
HELD = 1_000_000


def stream(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts as the model sees them, each behind DEPTH end symbols,
    and where each text's first byte stands."""
    flat, starts = spread(LOWER[data], offs, DEPTH + 2, END)
    flat = np.append(flat, np.uint8(END))
    rows = len(offs) - 1
    space = IS_SPACE[flat]
    keep = ~space
    keep[1:] |= ~space[:-1]                        # the one space behind each word
    stops = starts + np.diff(offs)
    ends = stops + 1                               # the end symbol
    pads = (starts[:, None] - 1 - np.arange(DEPTH)[None, :]).reshape(-1)
    flat[space] = 32
    flat[ends] = END
    flat[pads] = END
    keep[ends] = True
    keep[pads] = True
    seq = flat[keep]
    new = np.cumsum(keep) - 1
    return seq, new[starts - 1] + 1 if rows else np.empty(0, np.int64)


def _targets(n: int, starts: np.ndarray) -> np.ndarray:
    """All positions but the end symbols ahead of the texts."""
    mask = np.ones(n, bool)
    if len(starts):
        mask[(starts[:, None] - 1 - np.arange(DEPTH)[None, :]).reshape(-1)] = False
        mask[:starts[0]] = False
    return mask


def _sequences(seq: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    code = np.zeros(len(seq), np.int64)
    for k in range(DEPTH + 1):
        code[k:] |= seq[:len(seq) - k].astype(np.int64) << (8 * k)
    code = np.sort(code[_targets(len(seq), starts)])
    first = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.empty(0, np.int64)
    return code[first], np.diff(np.append(first, len(code)))


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    code = np.concatenate([p[0] for p in parts])
    n = np.concatenate([p[1] for p in parts])
    order = np.argsort(code, kind="stable")
    code, n = code[order], n[order]
    first = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.empty(0, np.int64)
    return code[first], np.add.reduceat(n, first) if len(first) else n


def _out(words, code, n, size: int = 100_000) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(n), size):
        w = pa.array(words[i:i + size], pa.binary()) if words is not None else pa.nulls(len(n[i:i + size]), pa.binary())
        c = pa.array(code[i:i + size], pa.int64()) if code is not None else pa.nulls(len(n[i:i + size]), pa.int64())
        yield pa.RecordBatch.from_arrays([w, c, pa.array(n[i:i + size], pa.int64())], names=["word", "code", "n"])


def count(df: DataFrame, text: str = "text") -> DataFrame:
    """(word, code, n): token counts (code null; the end token is the empty word)
    and counts of six-byte sequences (word null) of all rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter[bytes] = Counter()
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for rows, data, offs in text_chunks(batch):
                seq, starts = stream(data, offs)
                words.update(seq[starts[0]:].tobytes().replace(b"\n", b" ").split())
                words[b""] += rows.num_rows
                parts.append(_sequences(seq, starts))
                if len(parts) > 8:
                    parts = [_merged(parts)]
                if len(words) > HELD:
                    yield from _out(list(words), None, np.fromiter(words.values(), np.int64))
                    words.clear()
                if len(parts) == 1 and len(parts[0][0]) > 2 * HELD:
                    yield from _out(None, *parts[0])
                    parts = []
        if words:
            yield from _out(list(words), None, np.fromiter(words.values(), np.int64))
        if parts:
            yield from _out(None, *_merged(parts))

    raw = df.select(F.col(text).alias("text")).mapInArrow(run, "word binary, code bigint, n bigint")
    return raw.groupBy("word", "code").agg(F.sum("n").alias("n"))


def contexts(counts: DataFrame, min_share: float = MIN_SHARE) -> DataFrame:
    """(k, code, n): for k = 0..DEPTH the counts of (context of k bytes, next byte)
    of all contexts that hold ``min_share`` of the corpus; at most 1 / min_share contexts a level."""
    grams = counts.where(F.col("code").isNotNull())
    level = F.explode(F.array([F.struct(F.lit(k).alias("k"), F.lit((1 << 8 * (k + 1)) - 1).cast("long").alias("m")) for k in range(DEPTH + 1)])).alias("l")
    sums = (grams.select("code", "n", level)
            .select(F.col("l.k").alias("k"), F.col("code").bitwiseAND(F.col("l.m")).alias("code"), "n")
            .groupBy("k", "code").agg(F.sum("n").alias("n")))
    total = grams.agg(F.sum("n")).first()[0] or 0
    heavy = (sums.withColumn("ctx", F.shiftright("code", 8)).groupBy("k", "ctx").agg(F.collect_list(F.struct("code", "n")).alias("next"), F.sum("n").alias("all"))
             .where(F.col("all") >= F.lit(min_share * total)))          # at most 256 next bytes a context
    return heavy.select("k", F.explode("next").alias("x")).select("k", "x.code", "x.n")


def tree(rows: DataFrame, min_gain: float = MIN_GAIN) -> dict:
    """The automaton: symbol classes, transitions and log10 probabilities."""
    t = rows.toArrow()
    k = t.column("k").to_numpy()
    code, n = t.column("code").to_numpy(), t.column("n").to_numpy().astype(float)
    tables = []
    for level in range(DEPTH + 1):
        mine = k == level
        order = np.argsort(code[mine])
        tables.append((code[mine][order], n[mine][order]))
    seen = np.unique(tables[0][0]) if len(tables[0][0]) else np.empty(0, np.int64)
    symbol = np.full(256, len(seen), np.int32)      # the last class: bytes that training has not
    symbol[seen] = np.arange(len(seen))
    a = len(seen) + 1
    total = tables[0][1].sum()
    # keep contexts by the divergence from the context without its oldest byte
    kept: list[np.ndarray] = [np.zeros(1, np.int64)]
    rows_of: list[tuple] = []
    for level in range(1, DEPTH + 1):
        c, m = tables[level]
        pc, pm = tables[level - 1]
        ctx, first, which = np.unique(c >> 8, return_index=True, return_inverse=True) if len(c) else (c, c, c)
        size = np.bincount(which, m, len(ctx)) if len(c) else m
        pctx, pwhich = np.unique(pc >> 8, return_inverse=True)
        psize = np.bincount(pwhich, pm, len(pctx))
        low = (1 << 8 * level) - 1
        at = np.searchsorted(pc, c & low)
        gain = m * (np.log(m / size[which]) - np.log(pm[at] / psize[np.searchsorted(pctx, (c & low) >> 8)])) if len(c) else m
        gain = np.bincount(which, gain, len(ctx)) if len(c) else m
        sure = 0.5 * np.bincount(which, minlength=len(ctx)) * np.log(np.maximum(size, 2)) if len(c) else m
        kept.append(ctx[(gain >= min_gain * total) & (gain >= TEST * sure)] if len(c) else ctx)
        rows_of.append((c, m, ctx, which, size))
    # all parts of kept contexts are states, so that every step can be taken
    states = [set(x.tolist()) for x in kept]
    for level in range(DEPTH, 1, -1):
        low = (1 << 8 * (level - 1)) - 1
        states[level - 1] |= {s & low for s in states[level]} | {s >> 8 for s in states[level]}
    levels = [np.array(sorted(s), np.int64) for s in states]
    base = np.cumsum([0, *map(len, levels)])
    step = np.zeros((base[-1], a), np.int32)
    prob = np.zeros((base[-1], a))
    prob[0] = 1.0
    if len(seen):
        prob[0, :len(seen)] += tables[0][1]
    prob[0] /= total + 256
    for level in range(DEPTH + 1):
        s = levels[level]
        if not len(s):
            continue
        own = slice(base[level], base[level + 1])
        if level:
            up = base[level - 1] + np.searchsorted(levels[level - 1], s & ((1 << 8 * (level - 1)) - 1))
            step[own], prob[own] = step[up], prob[up]
            c, m, ctx, which, size = rows_of[level - 1]
            here = np.isin(ctx, kept[level])
            kinds = np.bincount(which, minlength=len(ctx))
            st = base[level] + np.searchsorted(s, ctx[here])
            prob[st] *= (kinds[here] / (size[here] + kinds[here]))[:, None]
            rows = here[which]
            st_row = base[level] + np.searchsorted(s, ctx[which[rows]])
            prob[st_row, symbol[c[rows] & 255]] += m[rows] / (size + kinds)[which[rows]]
        if level < DEPTH and len(levels[level + 1]):
            nxt = levels[level + 1]
            ok = np.isin(nxt >> 8, s)
            step[base[level] + np.searchsorted(s, nxt[ok] >> 8), symbol[nxt[ok] & 255]] = base[level + 1] + np.flatnonzero(ok)
    return {"symbol": symbol, "step": step.reshape(-1), "log": np.log10(prob).astype(np.float32).reshape(-1), "classes": a,
            "states": int(base[-1]), "kept": int(sum(map(len, kept)))}


def text_scores(m: dict, seq: np.ndarray, starts: np.ndarray, width: int = 512) -> np.ndarray:
    """log10 probability of each text; equal pieces of the stream advance
    together, each from DEPTH bytes ahead of it: the state holds no more."""
    if not len(starts):
        return np.empty(0)
    lanes = -(-len(seq) // width)
    sym = np.zeros(lanes * width + DEPTH, np.int32)
    sym[DEPTH:DEPTH + len(seq)] = m["symbol"][seq]
    steps = np.ascontiguousarray(np.lib.stride_tricks.as_strided(sym, (lanes, width + DEPTH), (4 * width, 4)).T)
    out = np.empty((width, lanes), np.float32)
    state, a = np.zeros(lanes, np.int32), np.int32(m["classes"])
    for i in range(width + DEPTH):
        at = state * a + steps[i]
        if i >= DEPTH:
            out[i - DEPTH] = m["log"][at]
        state = m["step"][at]
    logs = np.ascontiguousarray(out.T).reshape(-1)[:len(seq)].astype(np.float64)
    logs[~_targets(len(seq), starts)] = 0
    return np.add.reduceat(logs, starts)


def fit(df: DataFrame, text: str = "text") -> tuple[DataFrame, dict, dict]:
    """(vocabulary with counts, its totals, suffix tree) of all rows."""
    counts = stored(count(df, text), "lm-counts")
    vocabulary = counts.where(F.col("word").isNotNull()).select("word", "n")
    total = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("N"), F.count("*").alias("V")).first()
    return vocabulary, {"N": int(total["N"]), "V": int(total["V"])}, tree(contexts(counts))


def hot_words(vocabulary: DataFrame, limit: int = HOT_WORDS) -> tuple[dict[bytes, int], int]:
    """The tokens with at least some count, at most ``limit`` of them, and that
    count: the smallest of steps of an eighth of a power of two that keeps the bound."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 8).cast("int")
    steps = sorted(((r["s"], r["words"]) for r in vocabulary.groupBy(step.alias("s")).agg(F.count("*").alias("words")).collect()), reverse=True)
    held, least = 0, None
    for s, words in steps:
        if held + words > limit:
            break
        held, least = held + words, s
    if least is None:
        return {}, 1 << 62
    t = vocabulary.where(step >= least).toArrow()
    return dict(zip(t.column("word").to_pylist(), t.column("n").to_pylist(), strict=True)), held


def score(df: DataFrame, fitted: tuple[DataFrame, dict, dict], held_out: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) of all rows."""
    vocabulary, totals, suffixes = fitted
    spark = df.sparkSession
    hot, _ = hot_words(vocabulary)
    shared = share(spark, {"hot": {w: (math.log10(n + 1)) for w, n in hot.items()}, "tree": suffixes})
    kind = df.schema[key].dataType.simpleString()
    rest_type = pa.list_(pa.struct([("word", pa.binary()), ("tf", pa.int64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        hot, suffixes = model["hot"], model["tree"]
        for batch in batches:
            for rows, data, offs in text_chunks(batch):
                seq, starts = stream(data, offs)
                scores = text_scores(suffixes, seq, starts)
                stops = np.append(starts[1:] - DEPTH - 1, len(seq) - 1)
                raw = seq.tobytes()
                tokens, known, base, rest = [], [], [], []
                for s, e in zip(starts.tolist(), stops.tolist(), strict=True):
                    words = raw[s:e].split()
                    words.append(b"")
                    logs = [x for x in map(hot.get, words) if x is not None]
                    tokens.append(len(words))
                    known.append(len(logs))
                    base.append(math.fsum(logs))
                    rest.append([{"word": w, "tf": n} for w, n in Counter([w for w in words if w not in hot]).items()] if len(logs) < len(words) else [])
                yield pa.RecordBatch.from_arrays(
                    [column(rows, "rid"), column(rows, "k"), column(rows, "held_out"), pa.array(tokens, pa.int64()), pa.array(known, pa.int64()),
                     pa.array(base, pa.float64()), pa.array(scores, pa.float64()), pa.array(rest, rest_type)],
                    names=["rid", key, "held_out", "n_tokens", "known", "base", "score", "rest"])

    rows = df.select(F.monotonically_increasing_id().alias("rid"), F.col(key).alias("k"), held_out.alias("held_out"), F.col(text).alias("text"))
    scored = stored(rows.mapInArrow(run, f"rid bigint, `{key}` {kind}, held_out boolean, n_tokens bigint, known bigint, base double, score double, "
                                         "rest array<struct<word:binary,tf:bigint>>"), "lm-scored")
    rare = (scored.select("rid", F.explode("rest").alias("x")).select("rid", "x.word", "x.tf").join(vocabulary, "word", "left")
            .groupBy("rid").agg(F.sum(F.when(F.col("n").isNotNull(), F.col("tf")).otherwise(0)).alias("known_rare"),
                                F.sum(F.col("tf") * F.log10(F.coalesce(F.col("n"), F.lit(0)) + 1.0)).alias("base_rare")))
    size = math.log10(totals["N"] + totals["V"] + 1)
    return (scored.drop("rest").join(rare, "rid", "left")
            .select(key, "held_out", "n_tokens", (F.col("known") + F.coalesce("known_rare", F.lit(0))).alias("n_known"),
                    F.lit(totals["N"]).cast("long").alias("train_tokens"),
                    (F.col("base") + F.coalesce("base_rare", F.lit(0.0)) - F.col("n_tokens") * F.lit(size)).alias("base_score"), "score"))
