"""Language of documents by script ranges, per-word scores and Viterbi.

Per language, letter trigrams over all training documents are counted (one
fixed-size table per language), and the scripts that hold at least a hundredth
of its letters. A word scores the sum of its smoothed trigram log
probabilities, only for the languages that write in its scripts. Viterbi with a
penalty for each switch labels the words; runs of one label are spans. The
document gets the language with most letters.

Null texts and texts without a letter are ``und`` with score 0. Ties go to the
language that comes first by name. With no training row every text is ``und``.
Repeated rows are labelled each for itself; extra columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import IS_SPACE, LOWER, column, share, spread, text_chunks

#: Letter classes of the trigrams: 0 no letter, a-z, then parts of UTF-8 letters.
CLASS = np.zeros(256, np.uint8)
CLASS[97:123] = np.arange(1, 27)
CLASS[0x80:0xC0] = 27 + np.arange(64) % 32
CLASS[0xC2:0xC4] = 59
CLASS[0xC4:0xE0] = 60
CLASS[0xE0:0xF0] = 61
CLASS[0xF0:0xF5] = 62
CODES = 1 << 18
#: Script of a letter by its first UTF-8 byte (ranges of code points).
SCRIPTS = ("latin", "greek", "cyrillic", "armenian_hebrew", "arabic", "indic", "kana_cjk", "han", "hangul", "other")
SCRIPT_BIT = np.zeros(256, np.uint16)
SCRIPT_BIT[97:123] = SCRIPT_BIT[65:91] = 1
SCRIPT_BIT[0xC3:0xCC] = 1
SCRIPT_BIT[0xCD:0xD0] = 2
SCRIPT_BIT[0xD0:0xD4] = 4
SCRIPT_BIT[0xD4:0xD8] = 8
SCRIPT_BIT[0xD8:0xDC] = 16
SCRIPT_BIT[0xE0] = 32
SCRIPT_BIT[0xE3] = 64
SCRIPT_BIT[0xE4:0xEA] = 128
SCRIPT_BIT[0xEA:0xEE] = 256
SCRIPT_BIT[0xF0:0xF5] = 512
SMOOTH = 1.0
SWITCH = 8.0
OUT_OF_SCRIPT = 20.0


def _codes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spaced bytes, row starts, and the trigram class code that ends at each byte."""
    flat, starts = spread(LOWER[data], offs, 2, 32)
    c = CLASS[flat].astype(np.int32)
    code = c.copy()
    code[1:] |= c[:-1] << 6
    code[2:] |= c[:-2] << 12
    return flat, starts, code


def train(df: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, code, n): trigram counts of all rows with a language; codes from
    CODES on count letters per script. Tasks sum before they send: at most
    CODES + 10 rows a language and task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for rows, data, offs in text_chunks(batch):
                flat, starts, code = _codes(data, offs)
                langs = column(rows, "lang").to_pylist()
                names = sorted(set(langs))
                row_lang = np.array([names.index(x) for x in langs])
                where = np.zeros(len(flat), np.int64)
                ends = np.append(starts[1:] - 2, len(flat))
                where[:] = np.repeat(row_lang, np.diff(np.append(0, ends)))
                live = np.flatnonzero(code & 0xFFF)
                n = np.bincount(where[live] * CODES + code[live], minlength=len(names) * CODES).reshape(len(names), CODES)
                for i, name in enumerate(names):
                    t = total.setdefault(name, np.zeros(CODES + 16, np.int64))
                    t[:CODES] += n[i]
                    bits = SCRIPT_BIT[flat[where == i]]
                    for s in range(len(SCRIPTS)):
                        t[CODES + s] += np.count_nonzero(bits == 1 << s)
        for name, t in total.items():
            at = np.flatnonzero(t)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(t[at], pa.int64())],
                                             names=["lang", "code", "n"])

    rows = df.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "lang string, code int, n bigint").groupBy("lang", "code").agg(F.sum("n").alias("n"))


def model(counts: DataFrame) -> dict:
    """Score tables from the counts: (names, log probabilities, scripts). At most
    CODES + 10 numbers a language reach the driver."""
    t = counts.toArrow()
    lang, code, n = (t.column(c).combine_chunks() for c in ("lang", "code", "n"))
    lang = np.array(lang.to_pylist(), object)
    code, n = code.to_numpy(zero_copy_only=False), n.to_numpy(zero_copy_only=False)
    names = sorted(set(lang.tolist()))
    logs = np.zeros((len(names), CODES), np.float32)
    scripts = np.zeros(len(names), np.uint16)
    for i, name in enumerate(names):
        mine = lang == name
        full = np.zeros(CODES + 16)
        full[code[mine]] = n[mine]
        tri = full[:CODES].reshape(64, 64, 64)
        last = tri.sum((0, 1)) + 0.5
        base = last / last.sum()
        two = tri.sum(0)
        two = (two + 8 * base) / (two.sum(1, keepdims=True) + 8)
        p = (tri + SMOOTH * 32 * two[None]) / (tri.sum(2, keepdims=True) + SMOOTH * 32)
        logs[i] = np.log(p).reshape(-1)
        letters = full[CODES:CODES + len(SCRIPTS)]
        scripts[i] = sum(1 << s for s in range(len(SCRIPTS)) if letters[s] >= 0.01 * max(1.0, letters.sum()))
    quiet = (np.arange(CODES) & 0xFFF) == 0
    logs[:, quiet] = 0
    return {"names": names, "logs": logs, "scripts": scripts}


def viterbi(scores: np.ndarray, starts: np.ndarray, lens: np.ndarray, switch: float) -> np.ndarray:
    """Best label of each word, for many sequences in step; equal paths keep the
    label, then take the first label."""
    n, k = scores.shape
    kind = np.min_scalar_type(max(k - 1, 0))                 # holds every label
    back = np.zeros((n, k), kind)
    order = np.argsort(-lens, kind="stable")
    starts, lens = starts[order], lens[order]
    live = np.searchsorted(-lens, -np.arange(1, (lens[0] if len(lens) else 0) + 1), "right")
    value = np.zeros((len(lens), k))
    own = np.arange(k, dtype=kind)
    for t, m in enumerate(live.tolist()):
        at = starts[:m] + t
        v = value[:m]
        if t:
            top = v.argmax(1)
            best = v[np.arange(m), top][:, None] - switch
            back[at] = np.where(v >= best, own, top[:, None].astype(kind))
            np.maximum(v, best, out=v)
        v += scores[at]
    path = np.zeros(n, kind)
    now = value.argmax(1).astype(kind) if len(lens) else np.empty(0, kind)
    for t in range(len(live) - 1, -1, -1):
        m = int(live[t])
        at = starts[:m] + t
        path[at] = now[:m]
        if t:
            now[:m] = back[at, now[:m]]
    return path


def _label(rows, data, offs, m) -> tuple[list, list, list, np.ndarray]:
    """Language, score and spans of each row, and the share of its letters that are in a script of their language."""
    names, logs, scripts = m["names"], m["logs"], m["scripts"]
    k, n_rows = len(names), rows.num_rows
    flat, starts, code = _codes(data, offs)
    space = IS_SPACE[flat]
    first = np.flatnonzero(~space & np.append(True, space[:-1]))       # every row has spaces ahead
    langs, score, spans, fit = ["und"] * n_rows, [0.0] * n_rows, [[] for _ in range(n_rows)], np.zeros(n_rows)
    if not len(first) or not k:
        return langs, score, spans, fit
    row = np.searchsorted(starts, first, "right") - 1
    words = np.empty((len(first), k), np.float32)
    for i in range(k):
        words[:, i] = np.add.reduceat(logs[i][code], first)
    bits = np.bitwise_or.reduceat(SCRIPT_BIT[flat], first)
    written = (bits[:, None] & scripts[None, :]) == bits[:, None]
    some = written.any(1)
    words -= np.where(written | ~some[:, None], 0, OUT_OF_SCRIPT).astype(np.float32)
    words[bits == 0] = 0
    words -= words.max(1, keepdims=True)
    lens = np.bincount(row, minlength=n_rows)
    at = np.append(0, np.cumsum(lens))[:-1]
    full = lens > 0
    path = viterbi(words, at[full], lens[full], SWITCH)
    letters = np.add.reduceat((CLASS[flat] > 0).astype(np.int32) - ((flat & 0xC0) == 0x80), first)
    weight = np.bincount(row * k + path.astype(np.int64), weights=letters, minlength=n_rows * k).reshape(n_rows, k)
    fit = np.bincount(row, weights=letters * written[np.arange(len(row)), path], minlength=n_rows) / np.maximum(np.bincount(row, weights=letters, minlength=n_rows), 1)
    texts = None
    edge = np.flatnonzero(np.append(True, (path[1:] != path[:-1]) | (row[1:] != row[:-1])))
    for e, stop in zip(edge.tolist(), [*edge[1:].tolist(), len(path)], strict=True):
        spans[row[e]].append({"lang": names[path[e]], "first_word": int(e - at[row[e]]), "words": stop - e})
    ascii_letter = np.add.reduceat(((flat >= 97) & (flat <= 122)).astype(np.int32), np.maximum(starts - 1, 0)) if len(starts) else []
    for r in range(n_rows):
        if not full[r]:
            continue
        if not ascii_letter[r]:
            texts = texts or column(rows, "text").to_pylist()
            if not any(ch.isalpha() for ch in texts[r]):
                spans[r] = []
                continue
        w = weight[r]
        best = int(w.argmax())
        langs[r], score[r] = names[best], float(min(1.0, w[best] / w.sum())) if w.sum() > 0 else 1.0 / k
    return langs, score, spans, fit


def predict(df: DataFrame, fitted: dict, key: str = "doc_id", text: str = "text", keep: Column | None = None) -> DataFrame:
    """(key, lang_pred, score, spans): the score is the share of the letters that
    the path gives to the language; spans are runs of words of one language."""
    shared = share(df.sparkSession, fitted)
    kind = df.schema[key].dataType.simpleString()
    span = pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int64()), ("words", pa.int64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offs in text_chunks(batch):
                langs, score, spans, _ = _label(rows, data, offs, shared.value)
                yield pa.RecordBatch.from_arrays([column(rows, "k"), pa.array(langs, pa.string()), pa.array(score, pa.float64()), pa.array(spans, span)],
                                                 names=[key, "lang_pred", "score", "spans"])

    return df.select(F.col(key).alias("k"), F.col(text).alias("text")).mapInArrow(
        run, f"`{key}` {kind}, lang_pred string, score double, spans array<struct<lang:string,first_word:bigint,words:bigint>>")


def accepted(df: DataFrame, fitted: dict, least: float = 0.4, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows whose text has a language, with at least ``least`` of its letters in a script that their span's language
    is written in: a text of several languages stays. A null ``lang`` takes the prediction. All columns stay."""
    shared = share(df.sparkSession, fitted)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            for rows, data, offs in text_chunks(batch, text):
                plain = pa.RecordBatch.from_arrays([rows.column(at)], names=["text"])
                langs, _, _, fit = _label(plain, data, offs, shared.value)
                keep = [x != "und" and f >= least for x, f in zip(langs, fit.tolist(), strict=True)]
                own = rows.schema.get_field_index(lang)
                filled = pa.array([o if o is not None else p for o, p in zip(rows.column(own).to_pylist(), langs, strict=True)], pa.string())
                yield pa.RecordBatch.from_arrays([filled if i == own else c for i, c in enumerate(rows.columns)], names=rows.schema.names).filter(pa.array(keep, pa.bool_()))

    return df.mapInArrow(run, df.schema)
