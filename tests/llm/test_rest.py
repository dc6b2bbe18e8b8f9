"""Vectors, archives, components and the pipeline."""
import base64
import collections
import gzip
import hashlib
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cirflow.llm import near_vec, queries, warc
from cirflow.llm.common import table
from cirflow.llm.components import components

from ..conftest import SF01


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 400)] + [(5, 5), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(100, 161)} == {100} and {got[i] for i in range(200, 400)} == {7} and 5 not in got
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute(rows, cosine=0.93):
    ok = [(i, np.array(v, float), c) for i, v, c in rows if i is not None and v and c is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, near = collections.Counter(), {i: {i} for i, _, _ in rows}
    for a in range(len(ok)):
        for b in range(len(ok)):
            (i, x, p), (j, y, q) = ok[a], ok[b]
            if a != b and p == q and len(x) == len(y) and x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= cosine:
                links[i] += 1
                near[i].add(j)
    while any(new != near[i] for i in near if (new := set().union(*(near[j] for j in near[i])))):
        near = {i: set().union(*(near[j] for j in near[i])) for i in near}
    return {i: (links[i], i if i is None else min(near[i])) for i, _, _ in rows}


def test_near_vectors_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(near_vec, "BLOCK", 32)
    monkeypatch.setattr(near_vec, "LEAF", 4)
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 1, (6, 16))
    rows = [(i, (centres[i % 6] * (1 + i % 2) + rng.normal(0, 0.25, 16)).tolist(), i % 2) for i in range(300)]
    rows += [(300 + i, rows[0][1], 0) for i in range(20)]
    rows += [(400, None, 0), (401, [], 0), (402, [0.0] * 16, 0), (403, [1.0, None] * 8, 0), (404, [float("nan")] * 16, 0), (405, rows[0][1], None), (406, [1.0, 2.0], 0), (407, [1.0, 2.0], 0)]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "vec_id long, embedding array<double>, label int, copies string")
    want = brute(rows)
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vec.near_duplicates(df).collect()}
    assert got == want and sum(v[0] for v in want.values()) > 300
    assert near_vec.near_duplicates(df.where("false")).count() == 0


@pytest.fixture(scope="module")
def pages(spark):
    own = [(900, None, None, "x"), (901, "u", "", "x"), (902, "é\r\n", "abc", "x"), (None, "u", "abc", "x"), (903, "u", "y" * 300000, "x"), (904, None, "y" * 300000, "x"), (904, None, "y" * 300000, "x")]
    df = table(spark, SF01, "pages").withColumn("payload", F.lit("x"))
    return df.unionByName(spark.createDataFrame(own, "page_id long, url string, html string, payload string"))


def test_archive_round_trip(spark, pages):
    path = warc.archive(pages)
    got = warc.read_archives(spark, path).collect()
    html = [(r.page_id, (r.html or "").encode()) for r in pages.collect()]
    first = {}
    for i, b in html:
        first[b] = max(first.get(b, -1), -1 if i is None else i)
    sha = lambda b: base64.b32encode(hashlib.sha1(b).digest()).decode()
    want = collections.Counter((i, len(b), sha(b), first[b] if (i is None or i < first[b]) else None) for i, b in html)
    num = lambda s: None if s in (None, "urn:page:none") else int(s.removeprefix("urn:page:"))
    assert collections.Counter((num(r.record_id), r.payload_bytes, r.payload_digest, num(r.refers_to)) for r in got) == want
    bodies = {i: b for i, b in html}
    assert all(r.payload is not None and bytes(r.payload) == bodies[num(r.record_id)] for r in got if r.type == "response")
    assert all(r.payload is None for r in got if r.type == "revisit")
    some = warc.read_archives(spark, path, ["record_id", "type"]).where("type = 'revisit'")
    assert some.count() == sum(r.type == "revisit" for r in got)
    one = warc.read_archives(spark, path, ["uri", "record_id"]).where("record_id = 'urn:page:903'").collect()
    assert [r.uri for r in one] == ["u"]
    assert warc.read_archives(spark, warc.archive(pages.where("false"))).count() == 0


def test_reads_foreign_archives(spark, tmp_path):
    recs = [warc.record(f"urn:page:{i}", "response", f"http://h/{i}", None, b"p" * (i * 70000), i * 70000, warc.digest(b"p" * (i * 70000))) for i in range(4)]
    os.makedirs(tmp_path / "w")
    (tmp_path / "w" / "plain.warc").write_bytes(b"".join(recs))
    (tmp_path / "w" / "nosize.warc.gz").write_bytes(b"".join(map(gzip.compress, recs)))
    (tmp_path / "w" / "sized.warc.gz").write_bytes(b"".join(map(warc.member, recs)))
    df = warc.read_archives(spark, f"file://{tmp_path}/w")
    assert sorted(r.payload_bytes for r in df.collect()) == sorted([0, 70000, 140000, 210000] * 3)
    assert warc.read_archives(spark, f"file://{tmp_path}/w", ["payload_digest", "uri"]).where("uri in ('http://h/1', 'http://h/3')").count() == 6


class _Counted:
    def __init__(self, raw):
        self.raw, self.at, self.reads = raw, 0, []

    def read(self, n):
        self.reads.append(n)
        out = self.raw[self.at:self.at + n]
        self.at += len(out)
        return out


def test_unwanted_payloads_are_stepped_over(monkeypatch):
    raw = b"".join(warc.member(warc.record(f"r{i}", "response", None, None, os.urandom(500000), 500000, "x")) for i in range(3))
    inflated = []
    real = warc.zlib.decompressobj

    class Spy:
        def __init__(self, *a):
            self.d = real(*a)

        def decompress(self, x):
            out = self.d.decompress(x)
            inflated.append(len(out))
            return out

        eof = property(lambda self: self.d.eof)
        unused_data = property(lambda self: self.d.unused_data)

    monkeypatch.setattr(warc.zlib, "decompressobj", Spy)
    heads = [h["warc-record-id"] for h, _ in warc.gzip_records(_Counted(raw))]
    assert heads == ["<r0>", "<r1>", "<r2>"] and sum(inflated) < 20000


def kept_ids(texts):
    """The smallest id of each group of near duplicates, over all pairs that share a five-word shingle."""
    sets, at = {}, collections.defaultdict(list)
    for i, t in texts.items():
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))))
        sets[i] = {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
        for g in sets[i]:
            at[g].append(i)
    least = {i: i for i in texts}
    links = set()
    for i, g in sets.items():
        shared = collections.Counter(j for x in g for j in at[x] if j < i)
        links |= {(i, j) for j, n in shared.items() if 100 * n >= 80 * (len(g) + len(sets[j]) - n)}
    changed = True
    while changed:
        changed = False
        for i, j in links:
            m = min(least[i], least[j])
            changed |= least[i] != m or least[j] != m
            least[i] = least[j] = m
    return {i for i in texts if least[i] == i}


def test_pipeline_stages(spark):
    import corpus_pipeline as P

    docs = table(spark, SF01, "documents")
    out = docs
    kept = {}
    for name, stage in P.STAGES:
        before = out
        out = stage(spark, before, SF01).cache()
        kept[name] = out
        if name != "tokens":
            assert out.columns == docs.columns
        if name == "near_dedup":
            want = kept_ids({r.doc_id: r.text for r in before.collect()})
            assert {r.doc_id for r in out.collect()} == want and out.count() == len(want)
    assert kept["language"].count() >= 0.99 * docs.count()
    assert kept["secrets"].count() == kept["near_dedup"].count()
    assert kept["tokens"].count() == kept["mixture"].count()
    assert queries.secret_scan.scan(kept["secrets"]).where("size(spans) > 0").count() == 0
    texts = collections.Counter((r.doc_id, r.text) for r in kept["mixture"].collect())
    assert collections.Counter((r.doc_id, r.decoded) for r in kept["tokens"].collect()) == texts


def test_pipeline_edges(spark, messy, empty):
    import corpus_pipeline as P

    clash = messy.selectExpr("*", *[f"{i} as {c}" for i, c in enumerate(("_row", "_mark", "_copies", "_size", "_word", "_bits", "_place", "_maybe", "_first", "n", "count"))])
    for start in (messy, clash, empty):
        out = start
        for _, stage in P.STAGES:
            out = stage(spark, out, SF01)
        ids = [r.doc_id for r in out.collect()]
        assert set(ids) <= {1, 6, 8, 9, 10, 11, None} and (start is not empty) == bool(ids)


def test_near_dedup_takes_five_words(spark):
    """Against all pairs of five-word sets, with copies that only two-word sets link."""
    import corpus_pipeline as P

    rng = random.Random(12)
    rows = []
    for g in range(8):
        base = [f"g{g}w{i}" for i in range(200)]
        for changed in (0, 0, 2, 3, 9, 60):
            ws = list(base)
            for at in rng.sample(range(200), changed):
                ws[at] = f"d{len(rows)}_{at}"
            rows.append((len(rows), " ".join(ws)))
    sets = {i: {tuple(w[j:j + 5]) for j in range(len(w) - 4)} for i, t in rows for w in [t.split()]}
    least = {i: i for i in sets}
    for _ in sets:
        for i in sets:
            least[i] = min(least[j] for j in sets if j == i or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(r.doc_id for r in P.near_dedup(spark, docs, SF01).collect())
    assert got == sorted(i for i in least if least[i] == i) and len(got) > 16


def test_near_dedup_keeps_unlike_rows_of_one_id(spark):
    """An id with a near copy and an unlike text loses only the copy; equal rows leave the first by their other columns."""
    import corpus_pipeline as P

    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a, "s"), (2, a + " more", "s"), (2, b, "s"), (3, c, "z"), (3, c, "y"), (4, "", "s"), (None, a, "s"), (None, a, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    want = [(1, a, "s"), (2, b, "s"), (3, c, "y"), (4, "", "s"), (None, a, "s"), (None, a, "s")]
    assert collections.Counter(map(tuple, P.near_dedup(spark, docs, SF01).collect())) == collections.Counter(want)


def test_bitmap_hides_no_id(spark, monkeypatch):
    from cirflow.llm import common

    monkeypatch.setattr(common, "BITMAP_BITS", 256)
    df = spark.range(5000).withColumnRenamed("id", "k").withColumn("w", F.lit(1))
    ids = spark.range(0, 5000, 97).withColumnRenamed("id", "rep")
    rows = common.may_be_in(df, "k", ids, "maybe")
    hit = {r.k for r in rows.where("maybe").collect()}
    assert rows.count() == 5000 and rows.columns == ["k", "w", "maybe"] and set(range(0, 5000, 97)) <= hit and len(hit) < 2000
    nulls = spark.createDataFrame([(None,), (3,)], "k long")
    assert {r.k: r.m for r in common.may_be_in(nulls, "k", ids.where("rep < 0"), "m").collect()} == {None: False, 3: False}
