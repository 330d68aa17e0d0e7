"""Property tests: column rules vs plain-Python statements of the same rule,
on generated batches (one Spark job per batch)."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from capstan.functions.ids import item_id
from capstan.functions.paths import blob_path, mask_sensitive, sharded_path, sharded_path_to_id
from capstan.functions.report import page_dim, parse_any_int, parse_int

SETTINGS = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
HEX = st.text("0123456789abcdef", min_size=40, max_size=40)
WORD = st.text(st.characters(min_codepoint=33, max_codepoint=126, blacklist_characters="/"), max_size=8)


def _col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {typ}")


def py_blob_path(folder, h, ext, prefix):
    if ext and not ext.startswith("."):
        ext = "." + ext
    return f"{prefix}{folder}/{h[0:2]}/{h[2:4]}/{h}{ext}"


@SETTINGS
@given(st.lists(st.tuples(WORD, HEX, WORD, WORD), min_size=1, max_size=60))
def test_blob_path(spark, rows):
    df = spark.createDataFrame(rows, "f string, h string, e string, p string")
    got = [r[0] for r in df.select(blob_path(F.col("f"), F.col("h"), F.col("e"), F.col("p"))).collect()]
    assert got == [py_blob_path(*r) for r in rows]


def py_sharded(name):
    return None if len(name) < 8 else f"/spool/{name[0:2]}/{name[2:4]}/{name[4:]}"


@SETTINGS
@given(st.lists(st.text("abcdef0123456789", max_size=20), min_size=1, max_size=60))
def test_sharded_path_roundtrip(spark, names):
    df = _col(spark, names).select(sharded_path(F.lit("/spool"), F.col("v")).alias("p"))
    df = df.select("p", sharded_path_to_id(F.col("p")).alias("i"))
    for name, r in zip(names, df.collect()):
        assert r.p == py_sharded(name)
        assert r.i == ("" if r.p is None else name)


def py_mask(v):
    b = v.encode()
    return "****" if len(b) <= 4 else (b[:2] + b"****" + b[-2:]).decode("utf-8", "replace")


@SETTINGS
@given(st.lists(st.text(st.characters(min_codepoint=32, max_codepoint=126), max_size=12), min_size=1, max_size=60))
def test_mask(spark, values):
    got = [r[0] for r in _col(spark, values).select(mask_sensitive(F.col("v"))).collect()]
    assert got == [py_mask(v) for v in values]


def py_item_id(v):
    if v.startswith(("http://", "https://")):
        parts = v.split("/")
        for i, p in enumerate(parts):
            if p == "details" and i + 1 < len(parts):
                return parts[i + 1]
        return parts[-1]
    return v


URLISH = st.lists(st.sampled_from(["details", "x", "", "item-1", "download"]), max_size=5).map(
    lambda ps: "/".join(ps))


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["https://archive.org/", "http://h/", ""]), URLISH), min_size=1, max_size=60))
def test_item_id(spark, rows):
    values = [a + b for a, b in rows]
    got = [r[0] for r in _col(spark, values).select(item_id(F.col("v"))).collect()]
    assert got == [py_item_id(v) for v in values]


PAGE_RX = re.compile(r"([0-9.]*)\s*x\s*([0-9.]*)")


def py_page_dim(s):
    m = PAGE_RX.search(s)
    if not m:
        return (0.0, 0.0)
    try:
        return (float(m.group(1)), float(m.group(2)))
    except ValueError:
        return (0.0, 0.0)


@SETTINGS
@given(st.lists(st.text("0123456789. xpts()A4", max_size=16), min_size=1, max_size=60))
def test_page_dim(spark, values):
    got = [(r.d.width, r.d.height) for r in _col(spark, values).select(page_dim(F.col("v")).alias("d")).collect()]
    want = []
    for v in values:
        w, h = py_page_dim(v)
        # float() accepts forms such as "1_0"/"inf" that cannot occur here;
        # a lone "." is not a number in either
        want.append((w, h))
    assert got == want


def py_int(s):
    return int(s) if re.fullmatch(r"[+-]?[0-9]+", s) and abs(int(s)) < 2**63 else 0


def py_any_int(s):
    for t in s.split():
        if re.fullmatch(r"[+-]?[0-9]+", t) and abs(int(t)) < 2**63:
            return int(t)
    return 0


@SETTINGS
@given(st.lists(st.text("0123456789+- abx", max_size=14), min_size=1, max_size=60))
def test_integer_parsing(spark, values):
    rows = _col(spark, values).select(parse_int(F.col("v")).alias("i"), parse_any_int(F.col("v")).alias("a")).collect()
    assert [r.i for r in rows] == [py_int(v) for v in values]
    assert [r.a for r in rows] == [py_any_int(v) for v in values]
