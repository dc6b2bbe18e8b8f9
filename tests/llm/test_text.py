"""Operators over documents against brute force, with awkward rows."""
import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cirflow.llm import automaton, bpe, langid, lm, mixing, near_text, quality, queries, secret_scan, toxicity
from cirflow.llm.common import crc_part, shingle_sets, table

from ..conftest import SF01


def rows_of(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def words(text):
    return (text or "").encode().lower().split()


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text for r in table(spark, SF01, "documents").collect()}


# ---- secrets
ASSIGN = re.compile(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secret_spans(t):
    out = [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(t) if len(m[1]) >= 6]
    out += [(m.start(), "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    order = ["assign", "access", "hex"]
    return [(k, s, e) for s, k, e in sorted(out, key=lambda x: (x[0], order.index(x[1])))]


def test_secret_spans_equal_regular_expressions():
    rng = random.Random(3)
    parts = ["token", "=", ":", "secret", "é", " ", "\"", "'", "api_key", "APIKEY", "Password", "abcdef", "0123456789abcdef", "AKIA", "ABCDEFGHIJ0123456789", "ſecret", "toKen", "\n", "f" * 30]
    scanner = secret_scan.Scanner(secret_scan.BASE)
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(500)] + ["", "token=token:abcdefgh", "f" * 3000]
    raw = [t.encode() for t in texts]
    got = scanner.scan(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    for t, g in zip(texts, got, strict=True):
        assert [(secret_scan.BASE[r].kind, s, e) for s, r, e in g] == secret_spans(t)


def test_secret_query_digest(spark, docs):
    for r in queries.op2_secret_scan(spark, SF01).collect():
        want = secret_spans(docs[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in want).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for k, _, _ in want) for x in ("assign", "access", "hex"))


def test_secret_edges(messy, empty):
    assert {len(r["spans"]) for r in rows_of(secret_scan.scan(messy)) if r["doc_id"] != 8} == {0}
    assert secret_scan.scan(empty).count() == 0 and secret_scan.mask(empty).columns == empty.columns
    masked = {r["doc_id"]: r for r in rows_of(secret_scan.mask(messy))}
    assert masked[8]["text"] == '[secret]" é [secret]' and masked[3]["text"] is None and masked[1]["k"] == "x"


def test_automaton_is_minimal_and_rejects_bad_patterns():
    assert automaton.Automaton([automaton.parse("(ab|ab|a[b])")], anchored=True).size == 4
    with pytest.raises(ValueError):
        automaton.parse("a)b")


# ---- BPE
def test_bpe_equals_library(spark, docs):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(P.path(queries.VOCABULARY))
    for r in queries.op9_bpe(spark, SF01).collect():
        ids = lib.encode(docs[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_edges(spark, messy, empty):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    lib, vocabulary = Tokenizer.from_file(P.path(queries.VOCABULARY)), queries._vocabulary(spark)
    want = sorted((-1 if r.doc_id is None else r.doc_id, lib.encode(r.text or "", add_special_tokens=False).ids) for r in messy.collect())
    both = bpe.decode(bpe.encode(messy, vocabulary), vocabulary).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in both) == want
    assert sorted(r.decoded for r in both) == sorted(r.text or "" for r in messy.collect())
    assert bpe.encode_decode(empty, vocabulary).count() == 0


# ---- language
def test_language_held_out_accuracy_and_path(spark):
    truth = {r.doc_id: r.lang for r in table(spark, SF01, "documents").collect()}
    got = [r for r in queries.op10_langid(spark, SF01).collect() if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in got) >= 0.98 * len(got) and all(0 <= r.score <= 1 for r in got)


def test_viterbi_equals_enumeration():
    import itertools

    rng = np.random.default_rng(1)
    scores = rng.normal(0, 3, (6, 3))
    value = lambda p: sum(scores[i, x] for i, x in enumerate(p)) - 2.0 * sum(a != b for a, b in itertools.pairwise(p))
    best = max(itertools.product(range(3), repeat=6), key=value)
    assert tuple(langid.viterbi(scores.copy(), np.array([0]), np.array([6]), 2.0)) == best


def test_language_edges(messy, empty):
    model = langid.model(langid.train(messy))
    got = {r["doc_id"]: r for r in rows_of(langid.predict(messy, model))}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (3, 4, 5, 7))
    assert got[None]["lang_pred"] == "de" and got[11]["lang_pred"] != "und"
    none = langid.model(langid.train(empty))
    assert {r["lang_pred"] for r in rows_of(langid.predict(messy, none))} == {"und"} and langid.predict(empty, model).count() == 0
    assert {r.doc_id for r in langid.accepted(messy, model).collect()}.isdisjoint({3, 4, 5, 7})


# ---- language model
def test_language_model(spark, docs):
    train = collections.Counter()
    for i, t in docs.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            train.update([*words(t), b""])
    n, v = sum(train.values()), len(train)
    rows = queries.op4_lm_score(spark, SF01).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ws = [*words(docs[r.doc_id]), b""]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(w in train for w in ws), n)
        assert math.isclose(r.base_score, sum(math.log10((train[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
        assert r.score < 0


def test_suffix_tree_states_are_distributions(spark, messy):
    _, totals, tree = lm.fit(messy)
    p = 10.0 ** tree["log"].reshape(tree["states"], -1).astype(float)
    weight = np.append(np.ones(tree["classes"] - 1), 256 - tree["classes"] + 1)
    assert abs((p * weight).sum(1) - 1).max() < 1e-5 and totals["N"] == sum(len(words(r.text)) + 1 for r in messy.collect())


def test_language_model_edges(messy, empty):
    held = crc_part(F.col("doc_id"), 7, 2)
    out = lm.score(messy, lm.fit(empty), held).collect()
    assert len(out) == 13 and all(r.n_known == 0 and r.train_tokens == 0 for r in out)
    assert lm.score(empty, lm.fit(messy), held).count() == 0


# ---- toxicity
def test_marginals_equal_enumeration():
    import itertools

    rng = np.random.default_rng(2)
    s, t = rng.normal(0, 2, 5), rng.normal(0, 1, 4)
    weight = {p: math.exp(sum(s[i] * x for i, x in enumerate(p)) + sum(t[2 * a + b] for a, b in itertools.pairwise(p))) for p in itertools.product((0, 1), repeat=5)}
    z = sum(weight.values())
    want = [sum(w for p, w in weight.items() if p[i]) / z for i in range(5)]
    twice = toxicity.marginals(np.concatenate([s, s]), np.array([True, False, False, False, False] * 2), t)
    assert np.allclose(twice, want * 2)


def test_toxicity_held_out(spark):
    labels = {r.doc_id: r.toxic for r in table(spark, SF01, "labels").collect()}
    got = [(labels[r.doc_id], r.predicted, r.score) for r in queries.op5_toxicity(spark, SF01).collect() if r.held_out and r.doc_id in labels]
    assert all(p == (s >= 0.7) and 0 <= s <= 1 for _, p, s in got)
    assert sum(p for y, p, _ in got if y) >= 0.6 * sum(y for y, _, _ in got) and not any(p for y, p, _ in got if not y)


def test_toxicity_edges(spark, messy, empty):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (4, 0)], "doc_id long, toxic int")
    model = toxicity.fit(messy, labels)
    held = crc_part(F.col("doc_id"), 3, 1)
    assert toxicity.score(messy, model, held).count() == 13 and toxicity.score(empty, model, held).count() == 0
    assert toxicity.fit(empty, labels) is None and {r.score for r in toxicity.score(messy, None, held).collect()} == {0.0}


# ---- near duplicates
def test_linked_equals_sets():
    rng = random.Random(5)
    base = [rng.randrange(1 << 60) for _ in range(60)]
    sets = [np.unique(np.array([x if rng.random() > p else rng.randrange(1 << 60) for x in base], np.uint64)) for p in (0, 0, 0.05, 0.1, 0.12, 0.3, 0.6)] + [np.empty(0, np.uint64)]
    got = near_text.linked(sets)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            x, y = set(a.tolist()), set(b.tolist())
            assert i == j or got[i, j] == (bool(x) and bool(y) and 100 * len(x & y) >= 80 * len(x | y))


def test_near_text_components(spark, docs):
    """Against all pairs that share a shingle."""
    sets = {i: frozenset(shingle_sets(np.frombuffer(b := (t or "").encode(), np.uint8), np.array([0, len(b)]))[0].tolist()) for i, t in docs.items()}
    held, parent = collections.defaultdict(list), {i: i for i in docs}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sorted(docs):
        count = collections.Counter(j for g in sets[i] for j in held[g])
        for g in sets[i]:
            held[g].append(i)
        for j, n in count.items():
            if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    for r in queries.op6_near_text(spark, SF01).collect():
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), find(r.doc_id), find(r.doc_id) == r.doc_id)


def test_large_regions_lose_no_link(spark, monkeypatch):
    """A hub whose copies link with nothing but it, in regions of many small blocks."""
    monkeypatch.setattr(near_text, "BLOCK", 8)
    monkeypatch.setattr(near_text, "LARGE", 64)
    rng = random.Random(9)
    hub = [f"w{i}" for i in range(200)]
    rows = [(0, " ".join(hub))]
    for k in range(1, 150):
        ws = list(hub)
        for at in rng.sample(range(200), 9):
            ws[at] = f"v{k}_{at}"
        rows.append((k, " ".join(ws)))
    got = near_text.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=2).collect()
    assert sum(r.component_id == 0 for r in got) >= 150


def test_large_regions_keep_all_pairs_of_depth_four(spark, monkeypatch):
    """Cut regions lose no link that whole ones find, also with few orders; with all orders no copy is lost."""
    monkeypatch.setattr(near_text, "BLOCK", 8)
    rng = random.Random(10)
    hub = [f"w{i}" for i in range(200)]
    rows = [(0, " ".join(hub))]
    for k in range(1, 150):
        ws = list(hub)
        for at in rng.sample(range(200), 10):
            ws[at] = f"v{k}_{at}"
        rows.append((k, " ".join(ws)))
    df = spark.createDataFrame(rows, "doc_id long, text string")

    def classes(large, trees):
        monkeypatch.setattr(near_text, "LARGE", large)
        monkeypatch.setattr(near_text, "TREES", trees)
        return {r.doc_id: r.component_id for r in near_text.near_duplicates(df, size=2).collect()}

    assert set(classes(16, near_text.TREES).values()) == {0}
    assert classes(16, 3) == classes(1 << 30, 3)


def boilerplate(n, copies, seed=3):
    """Texts that share 60 of 90 words; of every one a copy with its last words changed, if asked for."""
    rng = random.Random(seed)
    common, rows = [f"w{i}" for i in range(60)], []
    for k in range(n):
        ws = common + [f"o{k}_{i}" for i in range(30)]
        rows.append((len(rows), " ".join(ws)))
        if copies:
            change = rng.choice((3, 5, 7, 9))
            rows.append((len(rows), " ".join(ws[:-change] + [f"c{k}_{i}" for i in range(change)])))
    return rows


def test_split_regions_keep_copies(spark, monkeypatch):
    """Copies at 0.8 to 0.95 among texts with the same boilerplate, in regions that are split."""
    monkeypatch.setattr(near_text, "BLOCK", 8)
    monkeypatch.setattr(near_text, "LARGE", 16)
    rows = boilerplate(150, True)
    got = {r.doc_id: r.component_id for r in near_text.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=2).collect()}
    assert got == {i: i - i % 2 for i, _ in rows}


def test_boilerplate_comparisons(spark, monkeypatch):
    """Texts with the same boilerplate that link with nothing: comparisons grow far below the square."""
    monkeypatch.setattr(near_text, "BLOCK", 8)
    monkeypatch.setattr(near_text, "LARGE", 16)
    links, made = near_text.links, []

    def counted(df, members, *args):
        made[-1] += sum(r["count"] ** 2 for r in members.groupBy("region", "i", "j").count().collect())
        return links(df, members, *args)

    monkeypatch.setattr(near_text, "links", counted)
    for n in (200, 800):
        made.append(0)
        got = near_text.near_duplicates(spark.createDataFrame(boilerplate(n, False), "doc_id long, text string"), size=2).collect()
        assert all(r.kept for r in got) and len(got) == n
    power = math.log(made[1] / made[0]) / math.log(4)
    print("comparisons", made, "power", power)
    assert power < 1.5


def test_runs_are_cut_at_short_prefixes():
    marks = []
    near_text._cut(0, 10, np.array([0, 8, 8, 8, 1, 8, 8, 8, 8, 8]), 6, marks)
    assert sorted(marks) == [0, 4]
    marks = []
    near_text._cut(0, 1000, np.full(1000, 8), 7, marks)
    assert max(np.diff([*sorted(marks), 1000])) <= 7 and min(marks) == 0


def test_near_text_edges(messy, empty):
    got = collections.Counter((r["doc_id"], r["component_id"], r["n_shingles"]) for r in rows_of(near_text.near_duplicates(messy, size=2)))
    assert got[(2, 1, 13)] == 2 and got[(3, 3, 0)] == got[(4, 4, 0)] == got[(5, 5, 0)] == 1 and got[(9, 9, 1)] == 1 and got[(6, 6, 1)] == 1
    assert near_text.near_duplicates(empty).count() == 0


# ---- mixing
def test_mix(spark, docs):
    rows = queries.op3_source_mix(spark, SF01).collect()
    source = {r.doc_id: r.source for r in table(spark, SF01, "documents").collect()}
    size, taken, target = collections.Counter(), collections.Counter(), {}
    for r in rows:
        assert r.size == len(words(docs[r.doc_id])) and 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        size[source[r.doc_id]] += r.size
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    names = sorted(size)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    want, left = {}, set(names)
    while left:
        level = (1.5 * sum(size.values()) - sum(want.values())) / sum(weight[s] for s in left)
        full = {s for s in left if weight[s] * level > 2 * size[s]}
        want |= {s: 2 * size[s] for s in full} if full else {s: weight[s] * level for s in left}
        left = left - full if full else set()
    for s in names:
        assert math.isclose(target[s], want[s], rel_tol=1e-9) and abs(taken[s] - want[s]) <= 0.03 * want[s]
    again = queries.op3_source_mix(spark, SF01).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in rows)


def test_mix_edges(messy, empty):
    got = rows_of(mixing.mix(messy))
    assert len(got) == 13 and all(r["taken"] == 0 for r in got if r["size"] == 0) and all(r["taken"] <= 2 * r["size"] for r in got)
    assert mixing.mix(empty).count() == 0


# ---- quality
def quality_counts(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    cover = {j for i in range(len(w) - 7) if seen[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover)


def test_quality_counts_and_verdict(spark, docs):
    labels = {r.doc_id: r.quality for r in table(spark, SF01, "labels").collect()}
    rows = queries.op8_quality(spark, SF01).collect()
    for r in rows:
        want = quality_counts(docs[r.doc_id] or "")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0]) and not (r.base_failed and r.kept)
    good = [r.kept for r in rows if labels.get(r.doc_id) == 1 and not r.base_failed]
    bad = [r.kept for r in rows if labels.get(r.doc_id) == 0]
    assert sum(good) == len(good) and sum(bad) <= 0.4 * len(bad)


def test_quality_edges(messy, empty):
    got = {r["doc_id"]: r for r in rows_of(quality.judge(messy))}
    assert got[3]["n_words"] == 0 and got[3]["base_failed"] and got[6]["n_repeat_words"] == 30000 and got[6]["n_words"] == 30000
    assert quality.judge(empty).count() == 0


def test_quality_and_mixing_run_no_python(spark, capsys):
    for q in (queries.op8_quality, queries.op3_source_mix):
        q(spark, SF01).explain()
    assert not re.search("Python|Arrow|Pandas", capsys.readouterr().out)


def test_many_labels_and_mixed_texts(spark):
    """300 languages, the best of them number 299; a clean text of four equal parts stays, one in an unknown script goes."""
    scores = np.zeros((4, 300))
    scores[:, 299] = 5
    assert langid.viterbi(scores, np.array([0]), np.array([4]), 2.0).tolist() == [299] * 4
    docs_ = table(spark, SF01, "documents").where("lang is not null")
    model = langid.model(langid.train(docs_))
    parts = [" ".join(docs_.where(F.col("lang") == n).where("n_chars > 400").orderBy("doc_id").first().text.split()[:40]) for n in model["names"][:4]]
    mixed = spark.createDataFrame([(1, " ".join(parts), None), (2, "\u041f\u0440\u0438\u0432\u0435\u0442 " * 30, None)], "doc_id long, text string, lang string")
    assert [r.doc_id for r in langid.accepted(mixed, model).collect()] == [1]
    spans = langid.predict(mixed.where("doc_id = 1"), model).first().spans
    assert {s.lang for s in spans} == set(model["names"][:4])


def test_merging_in_step_equals_merging_one_by_one():
    import public_tokenizers

    v = bpe.Vocabulary(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read())
    rng = random.Random(4)
    words_ = ["".join(rng.choice("abcdefghijklmnopqrst aeiou\u00e9\u00df\u6f22") for _ in range(rng.randrange(0, 90))).encode() for _ in range(800)] + [b"", b"a", b"aaaaaaaaaaaaaaaaaaaaaaa", b"the" * 40]
    assert v.merge_all(words_) == [v.merge(w) for w in words_]
