"""Toxic spans and document scores by a linear-chain conditional random field.

Tokens are words between white space, A-Z lower-cased, letters and digits only.
Their features are the word and its first four, five and six bytes. Labels
exist for documents, so tokens get theirs from the training documents: a token
of a toxic document is offending if one of its features is found in toxic
documents far more often than chance allows (log-likelihood ratio) and hardly
ever in others. The field is then fitted by gradient steps on its likelihood.
Forward-backward marginals give each token's probability; runs of likely
tokens are the offending spans, and a logistic function of the largest and the
summed marginal is the document's score.

The fit sees at most ``FIT_ROWS`` labelled rows, chosen by a hash of the key: a
bounded sample, one task's work. Scoring sees every whole text.
Null and empty texts have no token and score lowest; without labelled rows of
both classes every text scores 0. Repeated rows are scored each for itself;
extra columns are dropped; null labels and null keys do not train.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import IS_SPACE, LOWER, column, share, spread, text_chunks

FIT_ROWS = 6_000
PREFIXES = (4, 5, 6)
#: Log-likelihood ratio, documents and share of them that make a feature offending.
LEAST_G2, LEAST_DOCS, LEAST_SHARE = 16.0, 4, 0.9
STEPS, RATE, RIDGE = 30, 0.1, 1e-5
SLOTS = 1 << 20
LETTER = np.zeros(256, bool)
LETTER[list(range(48, 58)) + list(range(97, 123)) + list(range(128, 256))] = True
#: Random numbers for each byte at each place; longer words take the last place turned.
_RNG = np.random.default_rng(20240229)
_TABLE = _RNG.integers(1, 1 << 63, (64, 256), dtype=np.uint64)
_TABLE[:, ~LETTER] = 0
_SALTS = _RNG.integers(1, 1 << 63, 1 + len(PREFIXES), dtype=np.uint64)


def tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(features, row, start, end) of the tokens of all texts; start and end are
    bytes in ``data``. Features are 64-bit hashes: the word and its prefixes."""
    flat, starts = spread(LOWER[data], offs, 1, 32)
    space = IS_SPACE[flat]
    first = np.flatnonzero(~space & np.append(True, space[:-1]))
    if not len(first):
        none = np.empty(0, np.int64)
        return np.empty((0, 1 + len(PREFIXES)), np.uint64), none, none, none
    last = np.flatnonzero(~space & np.append(space[1:], True)) + 1
    letters = np.cumsum(LETTER[flat], dtype=np.int32)
    ahead = np.where(first > 0, letters[first - 1], 0)
    place = letters.copy()
    place[first[0]:] -= np.repeat(ahead, np.diff(np.append(first, len(flat))))
    place = np.maximum(place - 1, 0)
    value = _TABLE[place & 63, flat]
    far = place > 63
    if far.any():
        value[far] *= (2 * (place[far] >> 6) + 1).astype(np.uint64)
    value[~LETTER[flat]] = 0
    out = np.empty((len(first), 1 + len(PREFIXES)), np.uint64)
    out[:, 0] = np.add.reduceat(value, first)
    for j, k in enumerate(PREFIXES):
        out[:, j + 1] = np.add.reduceat(np.where(place < k, value, 0), first)
    out ^= _SALTS[None, :]
    row = np.searchsorted(starts, first, "right") - 1
    shift = row + 1
    return out, row, first - shift, last - shift


def lanes(n: int, width: int = 128) -> tuple[int, int]:
    """(steps, pieces) that hold n tokens: piece after piece, all pieces in step."""
    return width, max(1, -(-n // width))


def in_lanes(x: np.ndarray, fill, width: int = 128) -> np.ndarray:
    """Tokens in order -> (steps, pieces, ...)."""
    w, l = lanes(len(x), width)
    full = np.full((w * l, *x.shape[1:]), fill, x.dtype)
    full[:len(x)] = x
    return np.ascontiguousarray(np.swapaxes(full.reshape(l, w, *x.shape[1:]), 0, 1))


def _forward(x: np.ndarray, begins: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Forward messages (steps, 2, pieces), scaled to sum 1. First the effect of
    each piece on the two unit vectors, then the entry vectors in order, then
    every step. Where a text begins, nothing is carried over."""
    w, l = x.shape
    same = ~begins

    def step(i, p, q):
        s = p + q
        p, q = np.where(same[i], t[0] * p + t[2] * q, s), x[i] * np.where(same[i], t[1] * p + t[3] * q, s)
        return p, q

    p, q = np.zeros((2, l)), np.zeros((2, l))
    p[0], q[1] = 1, 1
    for i in range(w):
        p, q = step(i, p, q)
        s = (p + q).sum(0)
        p, q = p / s, q / s
    entry = np.empty((2, l))
    u, v = 0.5, 0.5
    for i, (a, b, c, d) in enumerate(np.stack([p[0], p[1], q[0], q[1]], 1).tolist()):
        entry[0, i], entry[1, i] = u, v
        u, v = a * u + b * v, c * u + d * v
        u, v = u / (u + v), v / (u + v)
    out = np.empty((w, 2, l))
    p, q = entry
    for i in range(w):
        p, q = step(i, p, q)
        s = p + q
        p, q = p / s, q / s
        out[i, 0], out[i, 1] = p, q
    return out


def _backward(x: np.ndarray, begins: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Backward messages (steps, 2, pieces): what follows a token, given its label."""
    w, l = x.shape
    same = ~begins

    def step(i, p, q):                                      # from behind token i to ahead of it
        z = x[i] * q
        return np.where(same[i], t[0] * p + t[1] * z, 1), np.where(same[i], t[2] * p + t[3] * z, 1)

    def scaled(p, q):
        s = p + q
        return p / s, q / s

    p, q = np.zeros((2, l)), np.zeros((2, l))
    p[0], q[1] = 1, 1
    cut = begins.any(0)                                     # a text begins here: what follows does not matter
    for i in range(w - 1, -1, -1):
        p, q = step(i, p, q)
        s = (p + q).sum(0)
        p, q = p / s, q / s
    entry = np.empty((2, l))
    u, v = 0.5, 0.5
    for i, (a, b, c, d, known) in zip(range(l - 1, -1, -1), np.stack([p[0], p[1], q[0], q[1], cut], 1)[::-1].tolist(), strict=True):
        entry[0, i], entry[1, i] = u, v
        u, v = (a, c) if known else (a * u + b * v, c * u + d * v)
        u, v = u / (u + v), v / (u + v)
    out = np.empty((w, 2, l))
    p, q = entry
    for i in range(w - 1, -1, -1):
        out[i, 0], out[i, 1] = p, q
        p, q = scaled(*step(i, p, q))
    return out


def _ahead(x: np.ndarray) -> np.ndarray:
    """The value of the token before each token (the first gets its own)."""
    out = np.empty_like(x)
    out[1:] = x[:-1]
    out[0, ..., 1:] = x[-1, ..., :-1]
    out[0, ..., 0] = x[0, ..., 0]
    return out


def lane_marginals(score: np.ndarray, begins: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of label 1 of each token, and the summed probabilities of the
    label pairs 00, 01, 10, 11 inside texts; all as (steps, pieces)."""
    x, t = np.exp(np.clip(score, -30, 30)), np.exp(trans)
    alpha, beta = _forward(x, begins, t), _backward(x, begins, t)
    prob = alpha[:, 1] * beta[:, 1]
    prob /= prob + alpha[:, 0] * beta[:, 0]
    before = _ahead(alpha)
    pair = np.stack([before[:, 0] * beta[:, 0] * t[0], before[:, 0] * x * beta[:, 1] * t[1], before[:, 1] * beta[:, 0] * t[2], before[:, 1] * x * beta[:, 1] * t[3]])
    pair /= pair.sum(0)
    return prob, (pair * ~begins).sum((1, 2))


def marginals(score: np.ndarray, begins: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Probability of label 1 of each token; ``begins`` marks the first of each text."""
    if not len(score):
        return np.empty(0)
    prob, _ = lane_marginals(in_lanes(score, -30.0), in_lanes(begins, True), trans)
    return prob.T.reshape(-1)[:len(score)]


def _begins(row: np.ndarray) -> np.ndarray:
    return np.append(True, row[1:] != row[:-1]) if len(row) else np.empty(0, bool)


def _evidence(prob: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    top, total = np.zeros(rows), np.bincount(row, prob, rows) if len(row) else np.zeros(rows)
    np.maximum.at(top, row, prob)
    top = np.clip(top, 1e-6, 1 - 1e-6)
    return np.stack([np.log(top / (1 - top)), np.log1p(total), np.ones(rows)], 1)


def learn(data: np.ndarray, offs: np.ndarray, toxic: np.ndarray) -> dict | None:
    """Fit on some labelled texts; None if a class is missing."""
    rows = len(toxic)
    if not rows or toxic.min() == toxic.max():
        return None
    feats, row, _, _ = tokens(data, offs)
    if not len(row):
        return None
    keys, ids = np.unique(feats, return_inverse=True)
    ids = ids.reshape(feats.shape).astype(np.int32)
    pairs = np.unique(ids.astype(np.int64) * rows + row[:, None])
    docs = np.bincount(pairs // rows, minlength=len(keys)).astype(float)
    bad = np.bincount(pairs // rows, toxic[pairs % rows], len(keys))
    n, n1 = float(rows), float(toxic.sum())
    cells = np.stack([bad, docs - bad, n1 - bad, n - n1 - docs + bad])
    fair = np.stack([docs * n1, docs * (n - n1), (n - docs) * n1, (n - docs) * (n - n1)]) / n
    with np.errstate(divide="ignore", invalid="ignore"):
        g2 = 2 * np.where(cells > 0, cells * np.log(cells / fair), 0).sum(0)
    mark = (g2 >= LEAST_G2) & (bad >= LEAST_DOCS) & (bad >= LEAST_SHARE * docs)
    label = mark[ids].any(1) & (toxic[row] > 0)
    used = np.flatnonzero(docs >= 3)
    slot = np.full(len(keys), len(used), np.int32)
    slot[used] = np.arange(len(used))
    ids = slot[ids]
    begins = _begins(row)
    # Adam on the likelihood; padding tokens are texts of one unknown word each
    size = len(used) + 1 + 1 + 4
    bias, first = len(used) + 1, len(used) + 2
    ids_l, begins_l, label_l = in_lanes(ids, len(used)), in_lanes(begins, True), in_lanes(label, False)
    live = in_lanes(np.ones(len(label), bool), False)
    w, m1, m2 = np.zeros(size), np.zeros(size), np.zeros(size)
    flat = ids_l.reshape(-1)
    ones = max(1, int(label.sum()))
    # the start: each feature's log odds among the tokens, shared out over a token's features
    seen = np.bincount(ids.reshape(-1), minlength=len(used) + 1)
    hits = np.bincount(ids.reshape(-1), np.repeat(label, ids.shape[1]), len(used) + 1)
    w[bias] = np.log((label.sum() + 1) / (len(label) - label.sum() + 1))
    w[:len(used) + 1] = (np.log((hits + 0.1) / (seen - hits + 1)) - w[bias]) / ids.shape[1]
    w[len(used)] = 0
    inner = np.flatnonzero(~begins)
    real = np.bincount(2 * label[inner - 1] + label[inner], minlength=4).astype(float)
    for step in range(1, STEPS + 1):
        prob, pair = lane_marginals(w[bias] + w[:len(used) + 1][ids_l].sum(2), begins_l, w[first:])
        gap = (prob - label_l) * live
        grad = np.empty(size)
        grad[:len(used) + 1] = np.bincount(flat, np.repeat(gap.reshape(-1), ids.shape[1]), len(used) + 1)
        grad[bias] = gap.sum()
        grad[first:] = pair - real
        grad = grad / ones + RIDGE * w
        grad[len(used)] = 0                                  # features too rare to learn
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad * grad
        w -= RATE * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.99 ** step)) + 1e-6)
    strong = np.flatnonzero(np.abs(w[:len(used)]) > 0.05)
    strong = strong[np.argsort(np.abs(w[strong]), kind="stable")]
    key_at, weight_at = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.float32)
    at = (keys[used][strong] >> np.uint64(20)) & np.uint64(SLOTS - 1)
    key_at[at], weight_at[at] = keys[used][strong], w[strong]   # of two in a slot the stronger stays
    model = {"keys": key_at, "weights": weight_at, "bias": float(w[bias]), "trans": w[first:].copy(), "logit": np.array([1.0, 0.0, 0.0])}
    x = _evidence(marginals(emissions(model, feats), begins, model["trans"]), row, rows)
    v = np.zeros(3)
    for _ in range(30):                                      # ridge logistic regression by Newton steps
        p = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(3)
        v = v - np.linalg.solve(h, x.T @ (p - toxic) + 0.01 * v)
    model["logit"] = v
    return model


def emissions(model: dict, feats: np.ndarray) -> np.ndarray:
    at = (feats >> np.uint64(20)) & np.uint64(SLOTS - 1)
    return model["bias"] + np.where(model["keys"][at] == feats, model["weights"][at], 0).sum(1, dtype=np.float64)


def fit(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> dict | None:
    """Fit on at most FIT_ROWS labelled rows, in one task."""
    y = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(label).cast("int").alias("y"))
    some = df.where(F.col(key).isNotNull()).select(F.col(key).alias("k")).distinct().join(y, "k")
    mix = F.xxhash64(F.lit("toxicity"), F.col("k").cast("string"))
    picked = some.orderBy(mix, "k", "y").limit(FIT_ROWS)
    rows = df.select(F.col(key).alias("k"), F.col(text).alias("text")).join(F.broadcast(picked), "k")   # at most FIT_ROWS keys

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        model = None
        if got:
            t = pa.Table.from_batches(got).sort_by("k")
            texts = [(x or "").encode("utf-8", "surrogatepass") for x in t.column("text").to_pylist()]
            data = np.frombuffer(b"".join(texts), np.uint8)
            model = learn(data, np.cumsum([0, *map(len, texts)]), t.column("y").to_numpy().astype(float))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    out = rows.repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(bytes(out[0]["model"])) if out else None


def score(df: DataFrame, model: dict | None, held_out: Column, key: str = "doc_id", text: str = "text", threshold: float = 0.7) -> DataFrame:
    """(key, held_out, score, predicted, spans): spans are (start, end) in code points."""
    shared = share(df.sparkSession, model)
    kind = df.schema[key].dataType.simpleString()
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for rows, data, offs in text_chunks(batch):
                n = rows.num_rows
                found: list[list] = [[] for _ in range(n)]
                scores = np.zeros(n)
                if model is not None:
                    feats, row, start, end = tokens(data, offs)
                    prob = marginals(emissions(model, feats), _begins(row), model["trans"])
                    scores = 1 / (1 + np.exp(-np.clip(_evidence(prob, row, n) @ model["logit"], -30, 30)))
                    for i in np.flatnonzero(prob >= 0.5).tolist():
                        r = int(row[i])
                        point = lambda at, r=r: int(np.count_nonzero((data[offs[r]:at] & 0xC0) != 0x80))
                        if found[r] and i and row[i - 1] == r and prob[i - 1] >= 0.5:
                            found[r][-1]["end"] = point(end[i])
                        else:
                            found[r].append({"start": point(start[i]), "end": point(end[i])})
                yield pa.RecordBatch.from_arrays([column(rows, "k"), column(rows, "held_out"), pa.array(scores, pa.float64()),
                                                  pa.array((scores >= threshold).astype(np.int32), pa.int32()), pa.array(found, span)],
                                                 names=[key, "held_out", "score", "predicted", "spans"])

    return df.select(F.col(key).alias("k"), held_out.alias("held_out"), F.col(text).alias("text")).mapInArrow(
        run, f"`{key}` {kind}, held_out boolean, score double, predicted int, spans array<struct<start:bigint,end:bigint>>")
