"""Operators 11 to 13: brute force, edge cases, and the parts of their methods."""

import hashlib
import random
import re
from itertools import permutations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from capstan.llm import filter_audit, fill_middle, pii

CLASH = "row long, id string, s string, key string, part string, spans string, code string, form string, `a.b` string"
REST = (None,) * 9
UNIT = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")
LONG = " ".join(f"word{i % 977}" for i in range(60_000)) + " \n"
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def docs_of(spark, pairs, source="s1"):
    return spark.createDataFrame([(i, t, "en", source, None, *REST) for i, t in pairs],
                                 "doc_id long, text string, lang string, source string, n_chars long, " + CLASH)


@pytest.fixture(scope="module")
def mixed(spark):
    return docs_of(spark, [(None, None), (None, "same text"), (1, None), (1, ""), (2, "same text"), (2, "same text"), (3, "same text"),
                           (4, LONG), (5, LONG), (6, "\t \n"), (7, "é"), (8, "a\n\nb\n"), (9, "x <S> y")]).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return docs_of(spark, [(0, "x")]).where("doc_id < 0")


# -- fill in the middle ------------------------------------------------------

def brute_fim(key, text, fim=50, spm=80):
    u = UNIT.findall(text)
    h = hashlib.sha256(f"42:{key}".encode()).hexdigest()
    h = [int(h[i:i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= fim:
        return len(u), "plain", None, None, text
    a, b = sorted(x % (len(u) + 1) for x in h[:2])
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    form = "spm" if h[3] % 100 < spm else "psm"
    return len(u), form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


def test_fim_edges(spark, mixed, empty):
    got = fill_middle.fill_in_middle(mixed, fim_percent=100)
    rows = got.select("row.doc_id", "n", "form", "prefix_chars", "middle_chars", "output", fill_middle.restored(F.col("output"), F.col("form")).alias("back")).collect()
    want = sorted((brute_fim("" if i is None else i, t or "", 100) for i, t in mixed.select("doc_id", "text").collect()), key=repr)
    assert sorted((tuple(r)[1:6] for r in rows), key=repr) == want
    assert sorted(r.back for r in rows) == sorted(t or "" for (t,) in mixed.select("text").collect())
    assert {r.form for r in rows} == {"plain", "psm", "spm"} or len({r.form for r in rows}) == 2
    assert fill_middle.fill_in_middle(empty).collect() == []


def test_units_of_random_texts():
    rng = random.Random(5)
    shared = ["".join(rng.choice("ab é\n\t") for _ in range(3000)) for _ in range(3)]
    cache = fill_middle.Summaries(40_000)
    for n in range(60):
        text = "".join(rng.choice(["a", "é ", " ", "\n", "xyz ", " ", shared[n % 3][:rng.randrange(3000)]]) for _ in range(rng.randrange(12)))
        data, units = text.encode(), UNIT.findall(text)
        made = fill_middle.Units(data, cache)
        assert made.count == len(units)
        for k in range(0, len(units) + 1, 1 + len(units) // 50):
            head = "".join(units[:k])
            assert made.cut(k) == (len(head.encode()), len(head))


def test_chunks_follow_content_and_are_remembered():
    rng = np.random.default_rng(1)
    body = rng.integers(97, 123, 50_000, np.uint8).tobytes()
    ends = fill_middle.chunk_ends(body, block=4096)
    assert ends == fill_middle.chunk_ends(body) and ends[-1] == len(body) and 60 < len(ends) < 140
    # the same passage behind other text is chunked alike after its first window
    moved = [e - 777 for e in fill_middle.chunk_ends(b"q" * 777 + body)]
    assert [e for e in ends if e > 64] == [e for e in moved if e > 64]
    cache = fill_middle.Summaries()
    fill_middle.Units(body, cache)
    before = cache.hits
    fill_middle.Units(b"q" * 777 + body, cache)
    assert cache.hits - before >= len(ends) - 3


def test_a_hash_collision_is_not_believed():
    cache = fill_middle.Summaries()
    a = cache.get(b"one two")
    cache.known = {k: (b"other bytes", (9, 9, 9, 9)) for k in cache.known}
    assert cache.get(b"one two") == a == (1, 1, 2, 7)


# -- filter audit ------------------------------------------------------------

def test_path_counts():
    for n in (1, 2, 5):
        forward, backward = filter_audit.paths(n)
        for s in range(1 << n):
            k = s.bit_count()
            assert (forward[s], backward[s]) == (factorial(k), factorial(n - k))


def fails(text, first):
    w = re.findall("[^\x20\x09-\x0d]+", text)
    return (("A" if len(w) < 200 else "") + ("B" if 100 * len(set(w)) < 50 * len(w) else "")
            + ("C" if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text) else "") + ("D" if re.search("[#$%&*|]", text) else "") + ("E" if not first else ""))


def brute_audit(docs, labels):
    low = {}
    for i, _, t in docs:
        if i is not None:
            low[t or ""] = min(low.get(t or "", i), i)
    rows = [(s or "", fails(t or "", i is None or low[t or ""] == i), labels.get(i, (0, 0))) for i, s, t in docs]
    out = {}
    for part in {r[0] for r in rows}:
        own, gone = [r for r in rows if r[0] == part], {}
        for order in map("".join, permutations("ABCDE")):
            for k, f in enumerate(order):
                before = [r for r in own if set(r[1]) & set(order[:k])]
                here = [r for r in own if f in r[1] and not set(r[1]) & set(order[:k])]
                gone[f] = gone.get(f, 0) + len(here)
                out[part, order, k + 1] = [len(own) - len(before) - len(here), len(here), sum(f in r[1] for r in before),
                                           sum(r[1] == f for r in own), sum(r[2][0] for r in here), sum(r[2][1] for r in here)]
        for (p, order, k), row in out.items():
            if p == part:
                row.append(gone[order[k - 1]])
    return {k: tuple(v) for k, v in out.items()}


def audited(docs, labels):
    got = filter_audit.order_steps(filter_audit.failure_counts(docs, labels), "ABCDE").collect()
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good, r.toxic, r.shapley) for r in got}


def test_audit_is_brute_force(spark, mixed, empty):
    rng = random.Random(3)
    more = [(10 + i, " ".join(rng.choice(["A", "b", "C#", "dd", f"w{i % 4}"]) for _ in range(rng.choice([1, 5, 260])))) for i in range(30)]
    docs = mixed.union(docs_of(spark, more, None)).union(docs_of(spark, [(i, "copy") for i in range(50, 90)], "hot"))
    labels = spark.createDataFrame([(2, 1, 0), (2, 0, 1), (3, None, 1), (None, 1, 1), (55, 1, 0), (56, 0, None), (11, 1, 1)], "doc_id long, quality int, toxic int")
    marks = {2: (1, 1), 3: (0, 1), 55: (1, 0), 11: (1, 1)}
    assert audited(docs, labels) == brute_audit([tuple(r) for r in docs.select("doc_id", "source", "text").collect()], marks)
    assert audited(empty, labels) == {}
    few = audited(docs.where("doc_id = 7"), labels.where("doc_id < 0"))
    assert len(few) == 600 and {k[0] for k in few} == {"s1"}


# -- personal data -----------------------------------------------------------

def luhn(d):
    return sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(d))) % 10 == 0


def brute_base(text):
    out = []
    for k, (kind, p) in enumerate(PLAIN.items()):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            ok = (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))
                  or kind == "card" and 12 <= len(d) <= 19 and luhn(d) or kind == "phone" and 9 <= len(d) <= 15)
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


HARD = [
    "1.2.3.4.5.6.7.8 a@b@c.d a@b.c_d@e.f x@y.z. 007.1.1.256 0.0.0.0 300.1.1.1 000255.1.1.1 +1 2-3 4 +49 (0) 171 2345678",
    "é" * 500 + " 4111 1111 1111 1111 and 4111111111111112 or +1 (826) 555-4081 190.137.223.204 end",
    "9" * 5000 + " " + "a" * 2000 + " a.b@c" + ".d" * 3000 + " +1" + "(" * 5000,
    " ".join(f"{i % 256}.1.{i % 7}.9 u{i}@h{i}.org" for i in range(3000)),
    "mail bob [at] site [dot] com, tel (555) 234-5678 or 555-234-5679, 2001:db8:0:0:0:0:0:1, 7536784127813050 4845168114407329",
]


@pytest.fixture(scope="module")
def found(spark, mixed):
    docs = mixed.union(docs_of(spark, [(100 + i, t) for i, t in enumerate(HARD)]))
    return docs, pii.find_pii(docs).select("row.doc_id", "spans").collect()


def test_base_spans_are_brute_force(found):
    docs, rows = found
    want = sorted(((i, brute_base(t or "")) for i, t in docs.select("doc_id", "text").collect()), key=repr)
    assert sorted(((r.doc_id, [(s.start, s.kind, s.stop) for s in r.spans if s.base]) for r in rows), key=repr) == want


def test_spans_of_a_kind_are_disjoint_and_added_ones_sound(found):
    _, rows = found
    got = {r.doc_id: r.spans for r in rows if r.doc_id}
    for spans in got.values():
        for k in range(4):
            own = [s for s in spans if s.kind == k]
            assert all(a.stop <= b.start for a, b in zip(own, own[1:]))
    texts = [HARD[1][s.start:s.stop] for s in got[101] if not s.base]
    assert texts == ["+1 (826) 555-4081"]
    texts = {HARD[4][s.start:s.stop] for s in got[104] if not s.base}
    assert texts >= {"bob [at] site [dot] com", "(555) 234-5678", "555-234-5679", "2001:db8:0:0:0:0:0:1", "4845168114407329"}


def test_very_long_runs(spark):
    text = "9" * 200_000 + " " + "a" * 300_000 + " a@b.co " + "1." * 50_000 + " +1" + "(" * 100_000
    got = pii.find_pii(docs_of(spark, [(1, text)])).collect()[0].spans
    assert [(s.start, s.kind) for s in got if s.base] == [(500_002, 0), *((500_009 + 8 * i, 1) for i in range(12_500))]


def test_no_text_no_spans(spark, empty):
    assert pii.find_pii(empty).collect() == []
    clean = docs_of(spark, [(1, "Chapter 4.0, pages 12 to 19 of 2024; look at it. Version 3."), (2, None), (3, "no number at all")])
    assert all(r.spans == [] for r in pii.find_pii(clean).collect())


def model(rows, rounds, strength, steps):
    """The two models in NumPy."""
    on = np.array([[k in r.on for k in range(22)] for r in rows], float)
    n = np.array([r.n for r in rows])
    yes, no, share = np.array([.1, .3, .6] * 6), np.array([.6, .3, .1] * 6), 0.5
    start = yes.copy(), no.copy()
    post = lambda: 1 / (1 + np.exp(-(np.log(share / (1 - share)) + on[:, :18] @ (np.log(yes) - np.log(no)))))
    for _ in range(rounds):
        y = post()
        yes, no = ((strength * s + (n * g) @ on[:, :18]) / (strength + (n * g).sum()) for s, g in zip(start, (y, 1 - y)))
        share = (1 + (n * y).sum()) / (2 + n.sum())
    y, w, bias = post(), np.zeros(22), 0.0
    for _ in range(steps):
        a, b = n * y / (1 + (n * y).sum()) / 2, n * (1 - y) / (1 + (n * (1 - y)).sum()) / 2
        miss = a - (a + b) / (1 + np.exp(-(bias + on @ w)))
        bias, w = bias + 2 * miss.sum(), w * (1 - 2e-3) + 2 * miss @ on
    return share, yes, no, bias, w


def test_models_are_brute_force(spark):
    found = docs_of(spark, [(i, t) for i, t in enumerate(HARD)]).select(F.concat(*(F.expr(pii.candidates(k)) for k in pii.KINDS)).alias("spans"))
    counts = found.select(F.explode("spans").alias("c")).groupBy("c.kind", "c.code").agg(F.count("*").alias("n")).withColumn("on", pii.on(F.col("code"))).collect()
    for r in pii.fit(found, rounds=7, strength=5.0, steps=20).collect():
        share, yes, no, bias, w = model([c for c in counts if c.kind == r.kind], 7, 5.0, 20)
        assert np.allclose([r.labels.share, *r.labels.yes, *r.labels.no, r.spans.bias, *r.spans.weights], [share, *yes, *no, bias, *w])


def test_no_python_in_the_plan(spark, mixed):
    plan = mixed.select(F.concat(*(F.expr(pii.candidates(k)) for k in pii.KINDS)).alias("spans"))
    assert not re.search("Python|Arrow|Pandas", plan._jdf.queryExecution().toString())
