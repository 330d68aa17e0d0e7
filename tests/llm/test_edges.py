"""Nulls, empty and very long texts, ties, repeated rows, empty tables and
clashing column names, for every operator and every pipeline stage."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from capstan.llm import decontamination, html_text, language_id, packing, quality, simhash, substring_dedup, warc
from capstan.llm.components import components
from capstan.llm.exact_dedup import exact_groups
from capstan.llm.line_dedup import drop_common_lines

LONG = " ".join(f"word{i % 5000}" for i in range(60_000))
#: Column names that the operators use themselves.
CLASH = "row long, id string, th string, s string, key string, run int, hits string, kept string, n string, score string, digest string, `a.b` string"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, " + CLASH
REST = (None,) * 12


def docs_of(spark, pairs):
    return spark.createDataFrame([(i, t, "en", None, None, *REST) for i, t in pairs], DOCS)


@pytest.fixture(scope="module")
def mixed(spark):
    """Null and repeated ids, null, empty, equal and long texts."""
    pairs = [(None, None), (None, "same text here"), (1, None), (1, ""), (2, "Same text HERE"), (2, "Same text HERE"),
             (3, "same text here"), (4, LONG), (5, LONG), (6, "\t \n"), (7, "é"), (8, "a\n\nb\n")]
    return docs_of(spark, pairs).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return docs_of(spark, [(0, "x")]).where("doc_id < 0")


def test_substring(mixed, empty):
    got = substring_dedup.remove_repeats(mixed).collect()
    assert substring_dedup.remove_repeats(empty).collect() == []
    assert len(got) == 12 and {(r.row.doc_id, r.n_words, r.n_removed) for r in got} >= {(None, 0, 0), (4, 60_000, 0), (5, 60_000, 60_000), (6, 0, 0), (8, 2, 0)}
    assert "a.b" in got[0].row.asDict()


def test_substring_ids_and_positions(spark):
    run = " ".join(f"p{i}" for i in range(13))
    df = docs_of(spark, [(None, f"x {run} y"), (3, f"a b {run}"), (9, f"{run} {run} z"), (3, f"other {run}"), (7, run[3:])])
    got = sorted(((r.row.doc_id, r.n_removed, r.kept) for r in substring_dedup.remove_repeats(df).collect()), key=repr)
    assert got == sorted([(None, 13, "x y"), (3, 0, f"a b {run}"), (3, 0, f"other {run}"), (9, 26, "z"), (7, 0, run[3:])], key=repr)


def brute_removed(docs, window):
    least = {}
    for i, t in docs:
        w = t.split()
        for p in range(len(w) - window + 1):
            k = tuple(w[p:p + window])
            least[k] = min(i, least.get(k, i))
    out = []
    for i, t in docs:
        w, gone = t.split(), set()
        for p in range(len(w) - window + 1):
            if least[tuple(w[p:p + window])] < i:
                gone.update(range(p, p + window))
        out.append((i, len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out)


@pytest.mark.parametrize("window", [2, 4, 5, 13, 25])
def test_substring_is_brute_force_for_other_windows(spark, window):
    rng = random.Random(window)
    docs = [(i, " ".join(rng.choice("ab" if i % 3 else "abcdefgh") for _ in range(rng.choice([0, 3, 40, 90])))) for i in range(60)]
    got = substring_dedup.remove_repeats(docs_of(spark, docs), window=window, chunk_words=50)
    assert sorted((r.row.doc_id, r.n_removed, r.kept) for r in got.collect()) == brute_removed(docs, window)


def test_exact(mixed, empty):
    got = [(r.id, r.keep_id, r.group_size, r.kept) for r in exact_groups(mixed, keep="max").collect()]
    assert exact_groups(empty).collect() == []
    assert sorted(got, key=repr) == sorted([
        (None, 1, 3, False), (1, 1, 3, True), (1, 1, 3, False), (None, 3, 4, False), (2, 3, 4, False), (2, 3, 4, False), (3, 3, 4, True),
        (4, 5, 2, False), (5, 5, 2, True), (6, 6, 1, True), (7, 7, 1, True), (8, 8, 1, True)], key=repr)
    low = [r for r in exact_groups(mixed).collect() if r.group_size == 4]
    assert {r.keep_id for r in low} == {2} and sum(r.kept for r in low) == 1  # of two equal rows one stays


def test_exact_large_group(spark):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    got = exact_groups(df).where("group_size > 1").agg(F.count("*"), F.min("group_size"), F.max("keep_id"), F.sum(F.col("kept").cast("int"))).first()
    assert tuple(got) == (1667, 1667, 0, 1)


def test_html(spark):
    pages = spark.createDataFrame([(1, None, None, "r"), (1, None, "", "r"), (None, "u", "<p>a &amp; b<p>c", "r"), (2, "u", "<p>" + "x " * 200_000, "r"),
                                   (3, "u", "<article><p>Body text.</p><div class='comments'><p>Nice</p></div></article><aside>s</aside>", "r"),
                                   (4, "u", "<![if x]><b>z", "r")], "page_id long, url string, html string, text string")
    got = {(r.row.page_id, r.text[:20], r.n_chars) for r in html_text.extract_text(pages).collect()}
    assert got == {(1, "", 0), (None, "a & b\nc", 7), (2, "x " * 10, 399_999), (3, "Body text.", 10), (4, "z", 1)}
    assert html_text.extract_text(pages.where("page_id > 9")).collect() == []


PAGE = """<html><head><title>t</title><script>var a = "<p>no</p>";</script><style>p{{}}</style></head><body>
<header><a href=/>Site</a></header><nav><ul><li>One</li><li>Two</li></ul></nav><div class="cookie-notice">We use cookies on this site, please agree to that now.</div>
<div id="wrap" class="has-sidebar">{body}<div class="sidebar"><p>Links to many other good pages of this site and others</p></div></div>
<form><label>Mail</label><input></form><div class="advert">Buy now, cheap and good, all that you ever wanted</div><footer>(c) us</footer></body></html>"""


@pytest.mark.parametrize("name", ["reader-comments", "commentList", "cookiebanner", "ad-slot", "rightSidebar", "site_notice", "post-comments"])
def test_html_furniture_by_name(name):
    body = f"<article><p>The article text goes here and on.</p><div class='{name}'><p>Not part of the article at all, really.</p></div></article>"
    assert html_text.main_text(PAGE.format(body=body)) == "The article text goes here and on."


@pytest.mark.parametrize("name", ["notice", "notices", "notification", "alert notice", "site-notice", "sitenotice", "notice-bar", "noticebar", "readercomments", "casino-banner"])
def test_html_notices_are_furniture(name):
    body = f"<article><p>The article text goes here and on.</p><div class='{name}'><p>Not part of the article at all, really.</p></div></article>"
    assert html_text.main_text(PAGE.format(body=body)) == "The article text goes here and on."


@pytest.mark.parametrize("name", ["commentary", "noticeable", "cookiecutter", "sponsorship", "hasSidebar", "has-left-sidebar", "no-comments", "page_has_sidebar"])
def test_html_names_that_are_no_furniture(name):
    body = f"<div class='{name}'><p>The article text goes here and on.</p></div>"
    assert html_text.main_text(PAGE.format(body=body)) == "The article text goes here and on."


@pytest.mark.parametrize("body", [
    "<article><h1>Head</h1><p>First  long\nparagraph of the text, that is it.</p><p>Hi.</p><section id=comments><p>A comment that is rather long, as they are.</p></section></article>",
    "<main><h1>Head</h1><p>First long paragraph of the text, that is it.</p><p>Hi.</p></main>",
    "<div class='post-content'><h1>Head</h1><p>First long paragraph of the text, that is it.<p>Hi.</div>",
    "<div><h1>Head</h1><p>First long paragraph of the text, that is it.</p><p>Hi.</p></div>"])
def test_html_main_text(body):
    assert html_text.main_text(PAGE.format(body=body)) == "Head\nFirst long paragraph of the text, that is it.\nHi."


@pytest.mark.parametrize("head, body", [
    ("<head><title>t</title>", "<body><article><p>Text.</p></article></body>"), ("<head><title>t</title>", "<article><p>Text.</p></article>"),
    ("<head><head><meta charset=utf-8><title>t</title>", "<p>Text."), ("<head><title>t</title><style>p{}</style>", "Text."),
    ("<head><noscript><p>Needs scripts</p><img src=x></noscript><title>t</title>", "<div>Text.</div>"),
    ("<head><template><div>none</div></template><script>a</script>", "<body><p>Text."), ("<head><title>t</title></head>", "<body><p>Text.</body>")])
def test_html_head_without_end_tag(head, body):
    assert html_text.main_text(f"<!DOCTYPE html><html>{head}{body}</html>") == "Text."


LINES = "A long paragraph of the text, that goes on and on and on, much longer than the others. " * 20


@pytest.mark.parametrize("body, want", [
    ("<h1>Title</h1><div>{0}</div><p>closing paragraph</p>", "Title\n{0}\nclosing paragraph"),
    ("<h1>Title</h1><p>The lead.</p><div class='entry-content'><p>{0}</p></div><p>closing</p>", "Title\nThe lead.\n{0}\nclosing"),
    ("<div><h1>Title<br>of two lines</h1><i>by one</i></div><div><p>{0}</p><p>{0}</p></div>", "Title\nof two lines\nby one\n{0}\n{0}"),
    ("<h1>Title</h1>" + "<ul><li>a</li></ul>" * 9 + "<div><p>{0}</p></div>", "Title\n" + "a\n" * 9 + "{0}"),
    ("<div id=w><div>{0}</div><div>One more.</div><div class=ad>Buy</div><div class=ad>Buy</div><div>The end.</div></div>", "{0}\nOne more.\nThe end."),
    ("<article><p>{0}</p></article>" + "<article><p>Short</p></article>" * 9, "{0}" + "\nShort" * 9),
    ("<div class=post><p>{0}</p></div><div class=post>Short one</div>", "{0}\nShort one"),
    ("<div id=top><a href=/>Home</a> <a href=/x>News</a></div><div><p>{0}</p><p>The end.</p></div>", "{0}\nThe end."),
    ("<div><p>{0}</p></div><article><p>A teaser.</p></article>", "{0}\nA teaser."),
    ("<article><h1>Title</h1><p>{0}</p></article><article class='comment'><p>Nice</p></article>", "Title\n{0}"),
    ("<h1>Title</h1><article><p>{0}</p></article>", "Title\n{0}")])
def test_html_region_is_whole(body, want):
    assert html_text.main_text(f"<html><body><nav>Menu</nav>{body.format(LINES)}<footer>(c)</footer></body></html>") == want.format(LINES.strip())


def test_lines(mixed, empty, spark):
    got = [(r.row.doc_id, r.text, r.n_lines, r.n_dropped) for r in drop_common_lines(mixed).collect()]
    assert sorted(got, key=repr) == sorted(((i, t or "", (t or "").count("\n") + 1, 0) for i, t in mixed.select("doc_id", "text").collect()), key=repr)
    assert drop_common_lines(empty).collect() == []
    df = docs_of(spark, [(i, f"own {i}\n  COMMON line\x0b\n\nÉnd") for i in range(9)] + [(9, "common LINE\nénd"), (9, "common LINE\nénd"), (None, "x\ncommon line")])
    got = {(r.row.doc_id, r.text, r.n_dropped) for r in drop_common_lines(df).collect()}
    assert got == {(i, f"own {i}\n\nÉnd", 1) for i in range(9)} | {(9, "énd", 1), (None, "x", 1)}  # É is no A-Z; 9 documents
    assert {r.n_dropped for r in drop_common_lines(df, min_docs=12).collect()} == {0}
    assert {r.text for r in drop_common_lines(df, min_docs=1).collect()} == {"\n".join([""])}


def test_archives(spark, tmp_path):
    rng = random.Random(1)
    pages = [(i, None if i % 7 == 0 else f"http://h/{i}\r\nx", None if i % 5 == 0 else rng.choice(["é", "hot", str(i), "\x1f\x8b\x08" * 9, "y" * 300_000]), 1) for i in range(60)]
    pages += [(None, None, "hot", 1), (3, None, "again", 2), (3, None, "again", 2)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, offset long")
    files = warc.write_archives(df, str(tmp_path / "w"), file_bytes=4000)
    got = warc.read_archives(files, split_bytes=300).where("record_type <> 'warcinfo'").collect()
    first = {}
    for i, _, h, _ in pages:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = sorted(((i, len((h or "").encode()), None if first[h or ""] == i else first[h or ""]) for i, _, h, _ in pages), key=repr)
    assert sorted(((r.id, r.payload_bytes, r.refers_to) for r in got), key=repr) == want
    text = {(r.id, bytes(r.payload)) for r in got if r.record_type == "response"}
    assert text == {(i, h.encode()) for h, i in first.items()}
    assert warc.read_archives(warc.write_archives(df.where("page_id > 99"), str(tmp_path / "e"))).collect() == []
    assert {r.record_type for r in warc.read_archives(warc.write_archives(df, str(tmp_path / "m"), min_bytes=1 << 20)).collect()} == {"warcinfo", "response"}


def test_broken_archive_is_an_error(tmp_path):
    data = warc.record(1, "u", b"payload", hashlib.sha1(b"payload").hexdigest())
    (tmp_path / "x.warc.gz").write_bytes(b"junk" + data + b"more junk" + data[:-9])
    with open(tmp_path / "x.warc.gz", "rb") as f, pytest.raises(ValueError):
        list(warc.members(f, 0, 1 << 20))
    with open(tmp_path / "x.warc.gz", "rb") as f:
        assert [at for at, _ in warc.members(f, 0, 20)] == [4]


def test_simhash(mixed, empty):
    got = [(r.id, r.component_id, r.first) for r in simhash.simhash_groups(mixed).collect()]
    assert simhash.simhash_groups(empty).collect() == []
    assert sorted(r[:2] for r in got if r[0] in (4, 5, 7, 8)) == [(4, 4), (5, 4), (7, 7), (8, 8)]
    assert {r[1] for r in got if r[0] == 6} == {1} and {r[1] for r in got if r[0] in (2, 3)} == {2}
    assert simhash.fingerprint(b"") == simhash.fingerprint(b" \n") == 0
    assert simhash.fingerprint(LONG.encode()) == simhash.fingerprint(LONG.encode(), chunk=1000)


def test_pivot_links_are_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = set(base.tolist())
    for b in base.tolist():
        for _ in range(int(rng.choice([0, 3, 60]))):
            f = b
            for bit in rng.choice(64, int(rng.integers(1, 6)), replace=False):
                f ^= 1 << int(bit)
            fps.add(f)
    f = np.array(sorted(fps), np.uint64)
    near = [(i, j) for i in range(len(f)) for j in np.flatnonzero(np.bitwise_count(f[i] ^ f[i + 1:]) <= 3) + i + 1]
    forest = simhash._Forest(len(f))
    forest.join(np.array([a for a, _ in near]), np.array([b for _, b in near]))
    want = {}
    for i in range(len(f)):
        want.setdefault(forest.find(i), set()).add(int(f[i].view(np.int64)))
    df = spark.createDataFrame([(int(x),) for x in f.view(np.int64)], "fp long")
    got = {}
    for r in components(simhash.fingerprint_links(df)).collect():
        got.setdefault(r.root, set()).add(r.node)
    assert sorted(map(sorted, got.values())) == sorted(sorted(s) for s in want.values() if len(s) > 1)
    block, simhash.BLOCK = simhash.BLOCK, 8  # the way of large buckets gives the same links
    try:
        u, v = simhash._bucket_links(f, np.array([0]), 3, simhash.pivots())
    finally:
        simhash.BLOCK = block
    star = simhash._Forest(len(f))
    star.join(np.searchsorted(f, u), np.searchsorted(f, v))
    assert [star.find(i) for i in range(len(f))] == [forest.find(i) for i in range(len(f))]


def test_components_of_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300) if i % 100 != 99] + [(5, 5), (7, 6)], "u long, v long")
    assert {(r.node, r.root) for r in components(edges).collect()} == {(i, i // 100 * 100) for i in range(301) if i != 300}


PASSAGE = "the quick brown fox jumps over the lazy dog and runs away from all of them"


def test_leaks(mixed, empty, spark):
    bench = spark.createDataFrame([(1, PASSAGE, 0), (2, None, 0), (None, PASSAGE, 0), (3, "", 0), (4, "short one", 0), (0, PASSAGE.upper(), 0)], "item_id long, text string, hits long")
    df = docs_of(spark, [(1, f"x\n{PASSAGE[:20]}  {PASSAGE[20:]} y"), (2, PASSAGE.replace("quick", "quack")), (3, PASSAGE[:40]), (4, "z " + PASSAGE + " and " + PASSAGE), (None, PASSAGE)])
    got = {(r.row.doc_id, tuple((h.item_id, h.edits, h.places) for h in r.hits)) for r in decontamination.mark_leaks(df, bench).collect()}
    assert got == {(1, ((0, 0, 1),)), (2, ((0, 1, 1),)), (3, ()), (4, ((0, 0, 2),)), (None, ((0, 0, 1),))}
    assert {len(r.hits) for r in decontamination.mark_leaks(mixed, bench).collect()} == {0}
    assert {len(r.hits) for r in decontamination.mark_leaks(df, bench.where("item_id > 9")).collect()} == {0}
    assert decontamination.mark_leaks(empty, bench).collect() == []
    blocks = decontamination.mark_leaks(df, bench, block_chars=60)  # several blocks, the same leaks
    assert {(r.row.doc_id, bool(r.hits)) for r in blocks.collect()} == {(1, True), (2, True), (3, False), (4, True), (None, True)}


def test_short_passages_leak_verbatim(spark):
    bench = spark.createDataFrame([(1, "Short One"), (2, "what is 2+2?"), (3, "eightchr"), (4, "seven c"), (5, PASSAGE), (6, "abababab")], "item_id long, text string")
    df = docs_of(spark, [(1, "a short  one, and short one"), (2, "ashort one, short ones"), (3, "Q: What is 2+2? 4"), (4, "eightchr"), (5, "eightchrs seven c"),
                         (6, "eightchrs eightchr"), (7, "short onf"), (8, PASSAGE.replace("quick", "quack")), (9, "cabababab"), (10, "xabababab abababab")])
    got = {(r.row.doc_id, h.item_id, h.edits, h.start, h.places) for r in decontamination.mark_leaks(df, bench).collect() for h in r.hits}
    assert got == {(1, 1, 0, 2, 2), (3, 2, 0, 3, 1), (4, 3, 0, 0, 1), (6, 3, 0, 10, 1), (8, 5, 1, 0, 1), (10, 6, 0, 10, 1)}


def test_quality(mixed, empty, spark):
    labels = spark.createDataFrame([(4, 1), (5, 1), (2, 0), (None, 1), (3, None), (2, 0), (99, 0)], "doc_id long, quality int")
    model = quality.fit(mixed, labels)
    got = quality.score_quality(mixed, model).collect()
    assert len(got) == 12 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if not r.row.text}) == 1  # null and empty texts: the prior
    assert quality.score_quality(empty, model).collect() == []
    assert {r.score for r in quality.score_quality(mixed, quality.fit(empty, labels)).collect()} == {0.5}


def test_language(mixed, empty, spark):
    train = docs_of(spark, [(i, t) for i, t in enumerate(["the cat and the hat of that", "der Hund und das Haus der"] * 40)]).withColumn(
        "lang", F.when(F.col("doc_id") % 2 == 0, "en").otherwise("de"))
    model = language_id.fit(train.union(mixed.withColumn("lang", F.lit(None).cast("string"))))
    assert model.langs == ["de", "en"]
    got = {(r.row.doc_id, r.row.text): (r.lang_pred, r.score) for r in language_id.identify(mixed, model).collect()}
    assert got[None, None] == got[1, ""] == got[6, "\t \n"] == ("und", 0.0) and got[4, LONG][0] in model.langs
    assert model.predict(["THE hat", "das Haus", "123", None])[0] == ["en", "de", "und", "und"]
    assert language_id.identify(empty, model).collect() == []
    assert {r.lang_pred for r in language_id.identify(mixed, language_id.fit(empty)).collect()} == {"und"}


def test_language_of_long_texts(spark):
    """Whichever text is drawn first, the long ones do not take the sample."""
    junk = {"en": "zzyq xxkv " * 9000, "de": "qqwx vvjk " * 9000}
    own = {"en": "the cat and the hat of that", "de": "der Hund und das Haus der"}
    rows = [(i, junk[k] if i % 8 < 4 else junk[k][:50_000] + own[k] * 900 if i % 8 < 6 else own[k], k) for i in range(200) for k in own]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.predict(["the hat of that cat", "das Haus und der Hund"])[0] == ["en", "de"]


def test_language_sample_is_shared_out():
    texts = [language_id.normal(f"beginning{k} " + f"middle{k} " * 9000 + f"theend{k}") for k in "abc"] + [b"short one", b"and another"]
    own = [(len(t), language_id.pieces(t, 4000)) for t in texts]
    got = language_id.shared_out(own, 4000)
    assert 3900 <= len(got) <= 4000 and b"short one and another" in got
    assert all(1200 <= got.count(b"middle" + k) * 8 <= 1400 for k in (b"a", b"b", b"c"))
    assert len({i // 88 for i, _ in own[0][1]}) == 4  # from each quarter of the text
    assert language_id.shared_out(own[3:], 4000) == b"short one and another"
    assert language_id.shared_out([(9, language_id.pieces("éééé ".encode(), 4))], 3).decode() == "é"


def test_every_language_is_learned(spark):
    rng = random.Random(5)
    words = {f"l{k:03}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(4)] for k in range(300)}
    rows = [(i, " ".join(w), k) for k, w in words.items() for i in range(8 + (k < "l256"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs)
    assert model.langs == sorted(words)
    got = language_id.identify(docs.where("doc_id = 0").coalesce(1), model).collect()
    assert len(got) == 300 and all(r.lang_pred == r.row.lang for r in got)


def test_blocks_of_languages_do_not_matter():
    rng = random.Random(6)
    samples = {k: bytes(rng.choice(b"abcdefgh ") for _ in range(200)) for k in "vwxyz"} | {"u": b"same of two", "same": b"same of two"}
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(50)) for _ in range(40)] + ["same of two", "12", None]
    whole = language_id.Languages(samples, 99).predict(texts)
    assert whole[0][40:] == ["same", "und", "und"] and whole[1][40] == 0.5
    assert all(language_id.Languages(samples, n).predict(texts) == whole for n in (1, 2, 3))


def test_cross_parsing_is_brute_force():
    samples = {"a": b"abracadabra and abba", "b": b"the theme of these"}
    model = language_id.Model(samples)
    rng = random.Random(2)
    texts = [bytes(rng.choice(b"abcdrthes zq") for _ in range(n)) for n in (0, 1, 7, 300, 5000)]
    # parses that never fall into step, and phrases longer than a segment
    samples["c"] = b"aaaaaab" + bytes(rng.choice(b"xy") for _ in range(6000))
    model = language_id.Model(samples)
    texts += [b"a" * 15_000, b"abra" * 3000, samples["c"][7:] + b"x" + samples["c"][9:], b"a" * 2049]

    def phrases(text, sample):
        n, start = min(1, len(text)), 0
        for i in range(len(text)):
            if text[start:i + 1] not in sample:  # the phrase ends here
                n += 1
                start = i if text[i:i + 1] in sample else i + 1
        return n

    got = model.phrases(texts)
    assert got.tolist() == [[phrases(t, samples[k]) for t in texts] for k in ("a", "b", "c")]


def test_packing(mixed, empty):
    got = packing.pack(mixed, capacity=64).collect()
    total = sum(r.length for r in got)
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got) and max(r.offset + r.length for r in got) <= 64
    assert len({r.sequence_id for r in got}) <= -(-total // 64) + 2
    assert sorted((r.piece, r.start, r.length) for r in got if r.id is None)[0] == (0, 0, 1)
    assert packing.pack(empty).collect() == []
    enc = packing.encoder()
    assert enc("x<|endoftext|>y").tolist()[1] == 50256


@pytest.mark.parametrize("capacity", [1, 7, 100, 2048])
def test_plans_are_whole(capacity):
    rng = random.Random(capacity)
    for kinds in (0, 1, 4, 60, 600):
        histogram = {}
        for _ in range(kinds):
            histogram[rng.randint(1, capacity)] = rng.choice([1, 2, 40])
        p = packing.plan(histogram, capacity, groups=rng.choice([1, 5, 96]))
        length, first, sequence, per, offset = p.arrays()
        places = {}
        for s, n in histogram.items():
            own = [i for i in range(len(length)) if length[i] == s]
            for r in range(n):
                i = [j for j in own if first[j] <= r][-1]
                k = r - first[i]
                places.setdefault(int(sequence[i] + k // per[i]), []).append((int(offset[i] + k % per[i] * s), s))
        assert sorted(places) == list(range(p.sequences))
        for row in places.values():
            end = 0
            for o, s in sorted(row):
                assert o == end
                end += s
            assert end <= capacity


def test_stages(mixed, empty, spark, tmp_path):
    spark.createDataFrame([(1, PASSAGE)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(3, 1, 0), (5, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, mixed, str(tmp_path))
        if name != "best_fit_packing":
            assert out.dtypes == mixed.dtypes
            assert stage(spark, empty, str(tmp_path)).collect() == []
        if name == "simhash_near_dedup":  # of the two equal rows (2, ..) one stays
            assert sorted((r.doc_id, r.text) for r in out.collect() if r.doc_id == 2) == [(2, "Same text HERE")]
        else:
            assert out.count() >= 12
