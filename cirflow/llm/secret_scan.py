"""Secret scan: every rule in one deterministic automaton, one pass over bytes.

The rules' expressions compile to one minimal automaton whose states name the
rules that end there. A pass over all bytes of a batch, all texts in one row of
bytes, tells which text holds which rule. Only there the spans are found, by
rule: an automaton of the reversed expression marks where matches start, and an
anchored one walks to the longest end; matches do not overlap within a rule.

Null and empty texts hold nothing. Offsets count code points. Repeated rows are
scanned each for itself; extra columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .automaton import RESET, Automaton, parse, reverse, shortest
from .common import column, spread, text_chunks


@dataclass(frozen=True)
class Rule:
    """``head`` then ``body``; a match counts if it has ``least`` characters and its body ``least_body``."""
    kind: str
    head: str
    body: str
    least: int = 0
    least_body: int = 0


#: The rules that results always report, in the order of kinds.
BASE = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", r"[A-Za-z0-9+/_.=-]+", least_body=6),
    Rule("access", "", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", "", r"[0-9a-f]{24,}", least=24),
)
#: Published prefixes and forms of further credentials.
MORE = (
    Rule("github", "", r"gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("google", "", r"AIza[A-Za-z0-9_-]+", least=39),
    Rule("slack", "", r"xox[abprs]-[A-Za-z0-9-]+", least=20),
    Rule("jwt", "", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", least=30),
    Rule("pem", "", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE + MORE
_COMPILED: dict[tuple, "Scanner"] = {}


class Scanner:
    def __init__(self, rules: tuple[Rule, ...]):
        trees = [parse(r.head + r.body) for r in rules]
        self.rules = rules
        self.all = Automaton([shortest(t) for t in trees], anchored=False)
        self.starts = [Automaton([reverse(t)], anchored=False) for t in trees]
        self.whole = [Automaton([t], anchored=True) for t in trees]
        self.heads = [Automaton([parse(r.head)], anchored=True) if r.head else None for r in rules]

    def spans(self, r: int, data: bytes) -> list[tuple[int, int]]:
        """Leftmost longest matches of one rule that do not overlap, in bytes; short ones are dropped."""
        rule, begin = self.rules[r], self.starts[r]
        back = begin.scan(np.frombuffer(data, np.uint8)[::-1])
        out, stop = [], 0
        for s in (len(data) - 1 - np.flatnonzero(begin.ends[back]))[::-1].tolist():
            if s < stop:
                continue
            stop = self.whole[r].longest(data, s)
            body = self.heads[r].longest(data, s) if self.heads[r] else s
            if stop - s >= rule.least and stop - body >= rule.least_body:
                out.append((s, stop))
        return out

    def scan(self, data: np.ndarray, offs: np.ndarray) -> list[list[tuple[int, int, int]]]:
        """(start, rule, end) of each text in code points, by start and rule."""
        flat, starts = spread(data, offs, 1, RESET)
        marks = self.all.ends[self.all.scan(flat)]
        out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(offs) - 1)]
        if not len(out):
            return out
        found = np.bitwise_or.reduceat(marks, starts - 1)
        for row in np.flatnonzero(found).tolist():
            piece = data[offs[row]:offs[row + 1]]
            raw = piece.tobytes()
            hits = [(s, r, e) for r in range(len(self.rules)) if found[row] >> r & 1 for s, e in self.spans(r, raw)]
            if hits:
                point = np.append(0, np.cumsum((piece & 0xC0) != 0x80))
                out[row] = sorted((int(point[s]), r, int(point[e])) for s, r, e in hits)
        return out


def _scanner(rules: tuple[Rule, ...]) -> Scanner:
    if rules not in _COMPILED:
        _COMPILED[rules] = Scanner(rules)
    return _COMPILED[rules]


def scan(df: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(key, spans): spans are (kind, start, end) by start, then by the order of the rules."""
    kind = df.schema[key].dataType.simpleString()
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(rules)
        for batch in batches:
            for rows, data, offs in text_chunks(batch):
                found = [[{"kind": rules[r].kind, "start": s, "end": e} for s, r, e in x] for x in scanner.scan(data, offs)]
                yield pa.RecordBatch.from_arrays([column(rows, "k"), pa.array(found, span)], names=[key, "spans"])

    return df.select(F.col(key).alias("k"), F.col(text).alias("text")).mapInArrow(
        run, f"`{key}` {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>")


def mask(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, with_mask: str = "[secret]") -> DataFrame:
    """The same rows with each span (overlapping ones together) replaced in the text; null stays null."""
    schema = df.schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(rules)
        for batch in batches:
            for rows, data, offs in text_chunks(batch, text):
                at = rows.schema.get_field_index(text)
                texts = rows.column(at).to_pylist()
                for i, hits in enumerate(scanner.scan(data, offs)):
                    if hits:
                        parts, stop = [], 0
                        for s, _, e in hits:
                            if s >= stop:
                                parts += [texts[i][stop:s], with_mask]
                            stop = max(stop, e)
                        texts[i] = "".join([*parts, texts[i][stop:]])
                yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if k == at else c for k, c in enumerate(rows.columns)], names=rows.schema.names)

    return df.mapInArrow(run, schema)
