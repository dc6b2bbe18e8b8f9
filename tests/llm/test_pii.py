"""Personal data: base entities against regular expressions, discovery against a plain bootstrapping."""
import hashlib
import math
import random
import re

from pyspark.sql import functions as F

from cirflow.llm import pii, queries
from cirflow.llm.common import table

from ..conftest import SF01

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10 == 0


def fits(kind, v):
    digits = re.sub("[^0-9]", "", v)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in v.split(".")), "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]


def base_spans(t):
    return [(k, m.start(), m.end()) for k, r in BASE.items() for m in re.finditer(r, t) if fits(k, m[0])]


def got_of(df):
    return {r.doc_id: ([tuple(s) for s in r.base], [tuple(s) for s in r.more]) for r in df.collect()}


def test_base_entities_equal_regular_expressions(spark):
    rng = random.Random(13)
    parts = ["a", "b.c", "@", ".", "_x", "é", " ", "-", "+1", "+", "(017)", "555", "7713", "4111111111111111", "4111 1111 1111 1111", "192.168.0.1", "255", "256", ".1", "0", "000", "00255", "\n", "漢", "\U0001f600", "%", "=", "12345678"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(3000)]
    texts += ["", "1" * 60000, "1 " * 30000, "1." * 30000, "a." * 30000 + "@" + "b." * 30000 + "c", "a@" * 20000, "+" * 20000 + "+1" * 20000, "x9-" * 20000, "a@b.c_x@d.e@f.g", "1.2.3.4.5.6.7.8 0.0.0.0 00.0.000.0255 1.2.3.256", "é" * 70000 + "u@v.w 10.0.0.1 " * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    got = got_of(pii.find(df))
    want = {i: base_spans(t) for i, t in enumerate(texts)}
    assert {i: g[0] for i, g in got.items()} == want
    assert all(sum(k == x for w in want.values() for k, *_ in w) > 50 for x in BASE)


def test_query_digest(spark):
    docs = {r.doc_id: r.text or "" for r in table(spark, SF01, "documents").collect()}
    rows = queries.op13_pii(spark, SF01).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = base_spans(docs[r.doc_id])
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest() and r.spans.startswith(listed)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for k, *_ in want) for x in BASE)


def test_query_uses_no_python(spark):
    for df in (pii.find(table(spark, SF01, "documents")), pii.units(table(spark, SF01, "documents").select("text"))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|MapIn", plan)


# ---- discovery
def corpus():
    """Contexts that only identifiers follow or precede, members among them that no expression finds, and frequent words."""
    rng = random.Random(21)
    words = [f"w{c}" for c in "abcdefghijklmnop"] + ["the", "of", "and"]
    docs = []

    def doc(*units):
        ws = [rng.choice(words) for _ in range(30)]
        for u in units:
            at = rng.randrange(1, len(ws))
            ws[at:at] = u
        docs.append(" ".join(ws))

    for i in range(6):
        doc(["mailto:", f"user{i}@mail.example.com,"], ["the", f"10.0.0.{i}"])
        doc(["CallMe", f"+1 (555) 555-01{i}0", "thanks"])
    for i in range(3):
        doc(["mailto:", f"user{i}[at]mail", "or", "mailto:", f"user{i}#mail{i}.example"])     # the second is one unit
        doc(["callme", f"00-1555-55{i}777", "thanks"])
        for _ in range(2):
            doc([f"00-1555-55{i}777", "obrigado"], ["the", f"item{i}000"])
        doc([f"XX-99{i}-1234", "obrigado"])                                              # found in the second round
    doc(["of", "2024."], ["mailto:", "nobody"])
    docs += docs[:4]
    return [(i, d) for i, d in enumerate(docs)]


def plain_discovery(docs, support=3, share=0.5, rounds=8):
    run = r"[A-Za-z0-9@._%+#/-]"
    unit = re.compile(rf"\+[0-9][\x20().0-9-]+[0-9]|(?<!{run})[0-9]{{4}}(?:[\x20-][0-9]{{2,7}}){{2,4}}(?![0-9])|(?<!{run})(?=[A-Za-z@._%+#/-]*[0-9]){run}+")
    total, seen = {}, []
    for i, t in docs:
        for w in t.lower().split():
            total[w] = total.get(w, 0) + 1
        ms = list(unit.finditer(t))
        for n, m in enumerate(ms):
            v = m[0] if re.match(r"\+[0-9]", m[0]) else m[0].lstrip("@._%+#/-")
            start, v = m.end() - len(v), v.rstrip("@._%+#/-")
            kind = next((k for k, r in BASE.items() if re.fullmatch(r, v) and fits(k, v)), None)
            if kind is None and len(v) < 5:
                continue
            left = t[ms[n - 1].end() if n else 0:m.start()].lower().split()[-1:]
            right = t[m.end():ms[n + 1].start() if n + 1 < len(ms) else len(t)].lower().split()[:1]
            for side, w in (("before", left), ("after", right)):
                if w and re.search("[^\\W\\d_]", w[0]):
                    seen.append((i, start, start + len(v), v, kind, (side, w[0])))
    edges, kinds = {}, {}
    for _, _, _, v, kind, p in seen:
        edges[p, v] = edges.get((p, v), 0) + 1
        kinds[v] = kind
    everything = {p: max(total.get(p[1], 0), sum(n for (q, _), n in edges.items() if q == p)) for p, _ in edges}
    member = {(v, k): 1.0 for v, k in kinds.items() if k}
    scored = {}
    for _ in range(rounds):
        scored = {}
        for p in everything:
            for k in BASE:
                mine = [(n, member[v, k]) for (q, v), n in edges.items() if q == p and (v, k) in member]
                s = sum(n * m for n, m in mine) / everything[p]
                if s >= share and sum(m >= 0.5 for _, m in mine) >= support:
                    scored[p, k] = s
        more = {}
        for (p, v) in edges:
            for k in BASE:
                if kinds[v] is None and (p, k) in scored:
                    more.setdefault((v, k), []).append(scored[p, k])
        member = {(v, k): 1.0 for v, k in kinds.items() if k} | {x: 1 - math.prod(1 - min(s, 0.999) for s in ss) for x, ss in more.items()}
    out = {i: [] for i, _ in docs}
    text = dict(docs)
    for i, s, e in {(i, s, e) for i, s, e, *_ in seen}:
        ways = [(scored[p, k], k) for j, a, b, v, kind, p in seen if (j, a, b) == (i, s, e) and kind is None for k in BASE if (p, k) in scored]
        if ways and not any(a < e and s < b for _, a, b in base_spans(text[i])):
            out[i].append((max(ways)[1] + "_like", s, e))
    return {i: sorted(x, key=lambda f: (list(BASE).index(f[0][:-5]), f[1])) for i, x in out.items()}


def test_discovery_equals_a_plain_bootstrapping(spark):
    docs = corpus()
    want = plain_discovery(docs)
    found = {docs[i][1][s:e] for i, x in want.items() for _, s, e in x}
    assert "user1#mail1.example" in found and "00-1555-551777" in found and "XX-991-1234" in found and not any("item" in f or "2024" in f for f in found)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, digest string, copies int").repartition(5)
    got = got_of(pii.find(df))
    assert {i: g[1] for i, g in got.items()} == want and {i: g[0] for i, g in got.items()} == {i: base_spans(t) for i, t in docs}


def test_edges(spark, messy, empty):
    got = sorted(((r.doc_id, len(r.base), len(r.more)) for r in pii.find(messy).collect()), key=str)
    assert len(got) == messy.count() and not any(b or m for _, b, m in got)
    assert pii.find(empty).count() == 0
    twice = spark.createDataFrame([(1, "a@b.cd"), (1, "a@b.cd"), (1, None), (None, "x 10.1.1.1")], "doc_id long, text string")
    assert sorted(((r.doc_id or 0, len(r.base)) for r in pii.find(twice).collect())) == [(0, 1), (1, 0), (1, 1), (1, 1)]
    assert pii.find(twice.withColumn("more", F.lit(1)).withColumn("k", F.lit(2))).columns == ["doc_id", "base", "more"]
