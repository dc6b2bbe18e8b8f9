"""Byte-level BPE by speculation and verification.

A greedy longest match proposes the tokens of a word. A proposal is the BPE
result exactly when every token stands for itself and every two neighbours are
compatible: encoding the bytes of both together gives the two back. Pairs are
tested for all new words of a batch at once with array look-ups; only words
with an incompatible pair (or a token that BPE never reaches) go through exact
merging.

Nulls count as empty texts and encode to no tokens. A special token's string
inside a text becomes its one id, as the public library does. Repeated rows
are encoded each for itself; extra columns are dropped except the key.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import column, share, text_chunks

#: Fixed value: the word pattern of this family of vocabularies.
WORD = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d"
    r"| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: Words of a generation that a worker remembers (two at most); bounds memory only.
CACHE_WORDS = 60_000
#: Rows decoded together.
DECODE_ROWS = 200
#: No merge; widths of the matrices in which words are merged in step.
NONE = np.iinfo(np.int64).max
WIDTHS = (8, 16, 32, 64)
#: Shared between the tasks of one Python worker.
_LOADED: dict[str, "Vocabulary"] = {}


def printable_bytes() -> dict[str, int]:
    """The vocabulary file writes each byte as one printable character: printable
    Latin-1 bytes as themselves, the others as 256, 257, ... in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens and merges of one vocabulary file as dictionaries and sorted arrays."""

    def __init__(self, text: str):
        spec = json.loads(text)
        byte = printable_bytes()
        raw = lambda s: bytes(byte[c] for c in s)
        self.ids = {raw(s): i for s, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        size = max([*self.ids.values(), *self.special.values()]) + 1
        self.bytes = [b""] * size
        for b, i in self.ids.items():
            self.bytes[i] = b
        for s, i in self.special.items():
            self.bytes[i] = s.encode()
        self.bytes_array = pa.array(self.bytes, pa.binary())
        self.lengths = np.fromiter(map(len, self.bytes), np.int64, size)
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.longest = max(map(len, self.ids))
        self.size = size
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        self.left = np.zeros(size, np.int64)
        self.right = np.zeros(size, np.int64)
        self.rank = np.full(size, -1, np.int64)      # -1: a single byte
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            a, b = self.ids[raw(a)], self.ids[raw(b)]
            c = self.ids[self.bytes[a] + self.bytes[b]]
            self.merges.setdefault((a, b), (r, c))
            if self.rank[c] < 0:
                self.left[c], self.right[c], self.rank[c] = a, b, r
        keys = np.array([a * size + b for a, b in self.merges], np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.array([r for r, _ in self.merges.values()], np.int64)[order]
        self.stands: dict[int, bool] = {}            # token -> BPE of its bytes gives it back
        self.of_rank = np.zeros(len(spec["model"]["merges"]), np.int64)
        for r, c in self.merges.values():
            self.of_rank[r] = c
        self.of_byte = np.array([self.ids.get(bytes([b]), 0) for b in range(256)], np.int64)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair: does BPE keep the border between the two tokens?

        The merges that formed the pieces next to the border are undone, latest
        first. If the two pieces could merge before either was merged away, the
        border would vanish. Of two equal merges the left one comes first.
        """
        ok = np.ones(len(a), bool)
        live = np.arange(len(a))
        x, y = a.astype(np.int64), b.astype(np.int64)
        limit = np.full(len(a), np.iinfo(np.int64).max)
        while len(live):
            keys = x * self.size + y
            at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            lost = (self.pair_keys[at] == keys) & (self.pair_ranks[at] < limit)
            ok[live[lost]] = False
            rx, ry = self.rank[x], self.rank[y]
            go = ~lost & ((rx >= 0) | (ry >= 0))
            live, x, y, rx, ry = live[go], x[go], y[go], rx[go], ry[go]
            undo_left = rx > ry
            limit = np.where(undo_left, rx, ry + 1)
            x, y = np.where(undo_left, self.right[x], x), np.where(undo_left, y, self.left[y])
        return ok

    def greedy(self, word: bytes) -> list[int]:
        ids, out, i, n = self.ids, [], 0, len(word)
        while i < n:
            j = min(n, i + self.longest)
            while (t := ids.get(word[i:j])) is None:
                j -= 1
            out.append(t)
            i = j
        return out

    def merge(self, word: bytes) -> list[int]:
        """Exact merging with a heap of (rank, place); O(n log n) for any length."""
        ids = [self.ids[word[i:i + 1]] for i in range(len(word))]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m[0], i, m[1], ids[i], ids[i + 1]) for i in range(n - 1) if (m := self.merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, c, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] == a else n
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = c, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if m := self.merges.get((c, ids[after[i]])):
                    heapq.heappush(heap, (m[0], i, m[1], c, ids[after[i]]))
            if (h := before[i]) >= 0 and (m := self.merges.get((ids[h], c))):
                heapq.heappush(heap, (m[0], h, m[1], ids[h], c))
        return [t for t in ids if t >= 0]

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair's merge, or NONE."""
        keys = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == keys) & (a >= 0) & (b >= 0), self.pair_ranks[at], NONE)

    def merge_all(self, words: list[bytes]) -> list[list[int]]:
        """``merge`` of many words in step: each round finds every word's first merge of the lowest rank and
        does it. Words of like length share a matrix; very long ones are merged one by one."""
        out: list = [None] * len(words)
        lens = np.fromiter(map(len, words), np.int64, len(words))
        low = 0
        for width in WIDTHS:
            live = np.flatnonzero((lens > low) & (lens <= width))
            low = width
            if not len(live):
                continue
            t = np.full((len(live), width + 1), -1, np.int64)                # a blank at the end
            t[np.arange(width + 1) < lens[live][:, None]] = self.of_byte[np.frombuffer(b"".join(words[i] for i in live.tolist()), np.uint8)]
            r = np.full((len(live), width + 1), NONE, np.int64)              # rank of the pair that begins here
            r[:, :-1] = self._ranks(t[:, :-1], t[:, 1:])
            places = np.arange(width)
            while len(live):
                j = r.argmin(1)
                rank = r[np.arange(len(live)), j]
                done = rank == NONE
                if done.any():
                    for i, row in zip(live[done].tolist(), t[done]):
                        out[i] = row[row >= 0].tolist()
                    go = ~done
                    live, t, r, j, rank = live[go], t[go], r[go], j[go], rank[go]
                rows = np.arange(len(live))
                token = self.of_rank[rank]
                source = places + (places > j[:, None])
                t[:, :-1] = np.take_along_axis(t, source, 1)
                r[:, :-1] = np.take_along_axis(r, source, 1)
                t[rows, j] = token
                r[rows, j] = self._ranks(token, t[rows, j + 1])
                some = np.flatnonzero(j > 0)
                r[some, j[some] - 1] = self._ranks(t[some, j[some] - 1], token[some])
        for i in np.flatnonzero(lens > low).tolist():
            out[i] = self.merge(words[i])
        return [x if x is not None else [] for x in out]

    def encode_words(self, words: list[str]) -> tuple[list[list[int]], np.ndarray]:
        """Tokens of each word, and whether the greedy proposal was kept."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        proposed = [[t] if (t := self.ids.get(w)) is not None else self.greedy(w) for w in raw]
        flat = np.fromiter((t for p in proposed for t in p), np.int64)
        lens = np.fromiter(map(len, proposed), np.int64, len(proposed))
        word = np.repeat(np.arange(len(raw)), lens)
        kept = np.ones(len(raw), bool)
        inner = np.flatnonzero(word[1:] == word[:-1]) if len(word) else np.empty(0, np.int64)
        keys, back = np.unique(flat[inner] * self.size + flat[inner + 1], return_inverse=True)
        good = self.compatible(keys // self.size, keys % self.size)
        kept[word[inner[~good[back]]]] = False
        for t in np.unique(flat).tolist():
            if t not in self.stands:
                self.stands[t] = self.merge(self.bytes[t]) == [t]
        bad = [t for t in np.unique(flat).tolist() if not self.stands[t]]
        if bad:
            kept[word[np.isin(flat, bad)]] = False
        failed = np.flatnonzero(~kept).tolist()
        for i, tokens in zip(failed, self.merge_all([raw[i] for i in failed]), strict=True):
            proposed[i] = tokens
        return proposed, kept


def _vocabulary(shared) -> Vocabulary:
    text = shared.value
    if text not in _LOADED:
        _LOADED.clear()
        _LOADED[text] = Vocabulary(text)
    return _LOADED[text]


def _pieces(v: Vocabulary, text: str) -> list[str]:
    """Words of a text; a special token's string stands for itself."""
    if v.split_special is None or not any(s in text for s in v.special):
        return WORD.findall(text)
    out: list[str] = []
    for part in v.split_special.split(text):
        out += [part] if part in v.special else WORD.findall(part)
    return out


def load_vocabulary(spark, path: str):
    """The vocabulary file's text for all tasks; its size is fixed (about 1.5 MB)."""
    with open(path, encoding="utf-8") as f:
        return share(spark, f.read())


def _encode_batches(vocabulary, key: str):
    """A function from batches (k, text) to batches (key, ids, n_merged)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _vocabulary(vocabulary)
        # two generations of words: when the young one is full it becomes the old one
        cache: dict[str, bytes] = {}
        old: dict[str, bytes] = {}
        special = {s: np.array([i], "<u4").tobytes() for s, i in v.special.items()}
        merged: set[str] = set()
        for batch in batches:
            for rows, _, _ in text_chunks(batch):
                docs = [_pieces(v, t) if t else [] for t in column(rows, "text").to_pylist()]
                if len(cache) > CACHE_WORDS:
                    cache, old = {}, cache
                    merged &= old.keys()
                cache.update(special)
                new = {w for d in docs for w in d}.difference(cache)
                again = new & old.keys()
                cache.update((w, old[w]) for w in again)
                new = list(new - again)
                tokens, kept = v.encode_words(new)
                cache.update((w, np.array(t, "<u4").tobytes()) for w, t in zip(new, tokens, strict=True))
                merged.update(w for w, k in zip(new, kept.tolist(), strict=True) if not k)
                get = cache.__getitem__
                yield pa.RecordBatch.from_arrays(
                    [column(rows, "k"), pa.array([b"".join(map(get, d)) for d in docs], pa.binary()),
                     pa.array([sum(map(merged.__contains__, d)) if merged else 0 for d in docs], pa.int64())],
                    names=[key, "ids", "n_merged"])

    return run


def _decode_batches(vocabulary, ids: str, out: str):
    """A function from batches to the same batches with the text of their ids."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _vocabulary(vocabulary)
        for batch in batches:
            packed = column(batch, ids).to_pylist()
            texts = []
            for a in range(0, len(packed), DECODE_ROWS):
                some = packed[a:a + DECODE_ROWS]
                # the tokens' bytes of all rows, one after the other
                all_ids = np.frombuffer(b"".join(x for x in some if x), "<u4")
                taken = v.bytes_array.take(pa.array(all_ids))
                raw = taken.buffers()[2].to_pybytes() if taken.buffers()[2] is not None else b""
                ends = np.concatenate([[0], v.lengths[all_ids].cumsum()])
                at = np.cumsum([0, *(len(x) // 4 if x else 0 for x in some)])
                edges = ends[at].tolist()
                texts += [None if x is None else raw[i:j].decode("utf-8", "replace") for x, i, j in zip(some, edges, edges[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, out])

    return run


def _rows(df: DataFrame, key: str, text: str) -> tuple[DataFrame, str]:
    return df.select(F.col(key).alias("k"), F.col(text).alias("text")), f"`{key}` {df.schema[key].dataType.simpleString()}, ids binary, n_merged bigint"


def encode(df: DataFrame, vocabulary, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, n_merged): ids are little-endian unsigned 32-bit integers, one
    after the other; n_merged counts the words that needed exact merging."""
    rows, schema = _rows(df, key, text)
    return rows.mapInArrow(_encode_batches(vocabulary, key), schema)


def decode(df: DataFrame, vocabulary, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the text of packed ids; bytes that are no UTF-8 become U+FFFD. Null ids give null."""
    return df.mapInArrow(_decode_batches(vocabulary, ids, out), StructType([*df.schema.fields, StructField(out, StringType())]))


def encode_decode(df: DataFrame, vocabulary, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``decode`` of ``encode`` in the same worker: (key, ids, n_merged, decoded)."""
    rows, schema = _rows(df, key, text)
    first, then = _encode_batches(vocabulary, key), _decode_batches(vocabulary, "ids", "decoded")
    return rows.mapInArrow(lambda batches: then(first(batches)), f"{schema}, decoded string")
