"""Archive records written and read back; filters; empty and truncated files."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from capstan.functions import http

from capstan.operators import filters as P
from capstan.operators import responses as R
from capstan.session import scratch_path
from capstan.sources import cdx, warc


def _response(body: bytes, ct: str, status: str = "200 OK") -> bytes:
    return (f"HTTP/1.1 {status}\r\nContent-Type: {ct}\r\nContent-Length: {len(body)}\r\n\r\n").encode() + body


def _write_records(spark, path):
    rows = [
        ("t", 0, "response", "<urn:1>", "2024-01-01T00:00:00Z", "http://a/x.pdf", warc.RESPONSE_TYPE if hasattr(warc, "RESPONSE_TYPE") else "application/http; msgtype=response",
         bytearray(_response(b"%PDF-1.4 data", "application/pdf"))),
        ("t", 1, "response", "<urn:2>", "2024-01-01T00:00:00Z", "http://a/y.html", "application/http; msgtype=response",
         bytearray(_response(b"<html></html>", "text/html"))),
        ("t", 2, "request", "<urn:3>", "2024-01-01T00:00:00Z", "http://a/y.html", "application/http; msgtype=request",
         bytearray(b"GET / HTTP/1.1\r\n\r\n")),
    ]
    df = spark.createDataFrame(rows, "warc_file string, record_idx long, warc_type string, record_id string, "
                                     "record_date string, target_uri string, content_type string, payload binary")
    warc.write_warc(df, path)


def test_roundtrip_and_filters(spark):
    path = scratch_path(spark, "t-warc")
    _write_records(spark, path)
    recs = warc.read_warc(spark, path)
    assert recs.count() == 3
    resp = R.responses(recs)
    assert resp.count() == 2
    pdf = P.apply(resp, [P.pdf_response, P.nonzero_content_length]).collect()
    assert [r.uri for r in pdf] == ["http://a/x.pdf"]
    assert bytes(pdf[0].body) == b"%PDF-1.4 data"
    # a second filter that is false removes everything
    assert P.apply(resp, [P.pdf_response, lambda df: F.lit(False)]).count() == 0


def test_random_access_by_offset(spark):
    path = scratch_path(spark, "t-warc2")
    _write_records(spark, path)
    idx = cdx.index_records(warc.read_warc(spark, path, payload=False))
    got = cdx.fetch(idx, path).collect()
    assert sorted(r.target_uri for r in got) == ["http://a/x.pdf", "http://a/y.html"]


REC = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: %s\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: %s\r\n\r\n%s\r\n\r\n"


def _rec(uri: bytes, block: bytes, length: bytes | None = None) -> bytes:
    return REC % (uri, length or str(len(block)).encode(), block)


def test_empty_and_truncated_files(spark):
    path = scratch_path(spark, "t-warc3")
    os.makedirs(path)
    open(os.path.join(path, "empty.warc.gz"), "wb").close()
    good = gzip.compress(_rec(b"u", b"abc"))
    with open(os.path.join(path, "cut.warc.gz"), "wb") as fh:
        fh.write(good + good[:10])
    with pytest.raises(Exception, match="cut.warc.gz"):  # nothing is lost silently
        warc.read_warc(spark, path).collect()
    rows = warc.read_warc(spark, path, onError="reject").orderBy("record_idx").collect()
    assert [(r.record_idx, bytes(r.payload or b""), r.error is None) for r in rows] == [(0, b"abc", True), (1, b"", False)]
    assert rows[1].record_offset == len(good)


def test_reading_goes_on_after_a_broken_record(spark):
    path = scratch_path(spark, "t-broken")
    os.makedirs(path)
    members = [gzip.compress(x) for x in (_rec(b"a", b"1"), b"no record at all", _rec(b"b", b"2", b"abc"), _rec(b"c", b"3"))]
    with open(os.path.join(path, "z.warc.gz"), "wb") as fh:
        fh.write(members[0] + members[1] + b"garbage" + members[2] + members[3])
    with open(os.path.join(path, "p.warc"), "wb") as fh:
        fh.write(_rec(b"a", b"1") + b"WORC/1.0\r\n\r\n" + _rec(b"b", b"2", b"-5") + _rec(b"c", b"3" * 3_000_000))
    got = warc.read_warc(spark, path, onError="reject").where("error is null").select("file_name", "target_uri", "content_length").collect()
    assert {tuple(r) for r in got} == {("z.warc.gz", "a", 1), ("z.warc.gz", "b", None), ("z.warc.gz", "c", 1),
                                       ("p.warc", "a", 1), ("p.warc", "b", None), ("p.warc", "c", 3_000_000)}
    over = warc.read_warc(spark, path, onError="reject", maxRecordBytes=1000).where("error = 'over-cap'").collect()
    assert [(r.target_uri, r.payload, r.content_length) for r in over] == [("c", None, 3_000_000)]


def test_large_header_block(spark):
    body = b"%PDF-1.4 body"
    for sep, end in ((b"\r\n", b"\r\n\r\n"), (b"\n", b"\n\n")):
        head = b"HTTP/1.1 200 OK" + sep + b"X-Pad: " + b"p" * 70_000 + sep + b"Content-Type: application/pdf"
        path = scratch_path(spark, "t-head")
        os.makedirs(path)
        with open(os.path.join(path, "h.warc"), "wb") as fh:
            fh.write(_rec(b"http://h/x", head + end + body))
        recs = warc.read_warc(spark, path)
        r = R.responses(recs).collect()
        assert [(x.http_content_type, bytes(x.body)) for x in r] == [("application/pdf", body)]
        assert recs.where(P.head_pdf(recs)).count() == 1


def test_bad_http_length_is_no_response(spark):
    df = spark.createDataFrame([(bytearray(b"HTTP/1.1 200 OK\r\nContent-Length: abc\r\n\r\nx"),), (bytearray(b"HTTP/1.1 200 OK\r\n\r\nx\n\ny\r\n\r\nz"),)], "p binary")
    h = http.split_http(F.col("p"))
    got = df.select(http.is_response(h).alias("ok"), http.body(F.col("p"), h).alias("b")).collect()
    assert [r.ok for r in got] == [False, True] and bytes(got[1].b) == b"x\n\ny\r\n\r\nz"


def test_fetch_from_shared_member_and_plain_file(spark):
    path = scratch_path(spark, "t-fetch")
    os.makedirs(path)
    member = gzip.compress(_rec(b"u1", b"1") + _rec(b"u2", b"2") + _rec(b"u3", b"3"))
    with open(os.path.join(path, "m.warc.gz"), "wb") as fh:
        fh.write(gzip.compress(_rec(b"u0", b"0")) + member)
    with open(os.path.join(path, "p.warc"), "wb") as fh:
        fh.write(_rec(b"q0", b"0") + _rec(b"q1", b"1"))
    off = len(gzip.compress(_rec(b"u0", b"0")))
    rows = [("m.warc.gz", off, None, "u3"), ("m.warc.gz", off, len(member), "u1"), ("m.warc.gz", off, None, None), ("p.warc", len(_rec(b"q0", b"0")), None, "q1"),
            ("m.warc.gz", off, 5, "u1"), ("none.warc.gz", 0, None, "u1"), ("m.warc.gz", off, None, "nowhere")]
    idx = spark.createDataFrame(rows, "filename string, compressed_offset long, compressed_record_size long, url string")
    got = cdx.fetch(idx, path).collect()
    assert sorted(bytes(r.payload) for r in got if r.error is None) == [b"1", b"1", b"1", b"3"]
    assert len(got) == 7 and sum(r.error is not None for r in got) == 3


def test_cdx_numbers_have_64_bits(spark):
    line = "a 2017 http://x/1 text/html 404 K - - 6000000000 5439151290 f.warc.gz"
    r = cdx.records(spark.createDataFrame([(line,)], "value string")).first()
    assert (r.compressed_record_size, r.compressed_offset) == (6_000_000_000, 5_439_151_290)


def test_content_type_filter_cases(spark):
    cases = [("application/pdf", True), ("application/pdf; charset=utf-8", True), ("text/html", False),
             ("application/json", False), ("", False)]
    df = spark.createDataFrame(cases, "http_content_type string, e boolean")
    for r in df.select(P.pdf_response(df).alias("g"), "e").collect():
        assert r.g == r.e


def test_cdx_lines(spark):
    path = scratch_path(spark, "t-cdx")
    os.makedirs(path)
    text = (" CDX N b a m s k r M S V g\n"
            "a 2017 http://x/1 text/html 404 K - - 562 543915129 f.warc.gz\n"
            "a 2017 http://x/2 text/html - K - - 562 1 f.warc.gz\n"
            "a 2017 http://x/3 text/html 200 K - 562 1 f.warc.gz\n"
            "a 2017 http://x/4 application/pdf 200 K - - 10 20 g.warc.gz")  # no final newline
    with open(os.path.join(path, "i.cdx"), "w") as fh:
        fh.write(text)
    p = cdx.read_cdx(spark, path)
    good = p.where("reason is null").orderBy("url").collect()
    assert [(r.url, r.response_code, r.compressed_offset) for r in good] == [
        ("http://x/1", 404, 543915129), ("http://x/4", 200, 20)]
    bad = {r.reason: r.n for r in p.where("reason is not null").groupBy("reason").agg(F.count("*").alias("n")).collect()}
    assert bad == {"header": 1, "bad-int": 1, "short": 1}


def test_type_selection_and_dechunk(spark):
    path = scratch_path(spark, "t-warc4")
    chunked = (b"HTTP/1.1 200 OK\r\nContent-Type: application/pdf\r\nTransfer-Encoding: chunked\r\n\r\n"
               b"4\r\n%PDF\r\n5;x=1\r\n-1.4!\r\n0\r\n\r\n")
    rows = [("c", 0, "response", None, None, "http://c/1", "application/http; msgtype=response", bytearray(chunked)),
            ("c", 1, "request", None, None, "http://c/1", "application/http; msgtype=request", bytearray(b"GET /"))]
    df = spark.createDataFrame(rows, "warc_file string, record_idx long, warc_type string, record_id string, "
                                     "record_date string, target_uri string, content_type string, payload binary")
    warc.write_warc(df, path)
    assert warc.read_warc(spark, path, warcTypes="response").count() == 1
    resp = R.responses(warc.read_warc(spark, path, dechunk="true")).collect()
    assert len(resp) == 1 and bytes(resp[0].body) == b"%PDF-1.4!"


def test_filter_pushdown_when_enabled(spark):
    path = scratch_path(spark, "t-warc5")
    _write_records(spark, path)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        df = warc.read_warc(spark, path).where(F.col("warc_type") == "request")
        assert [r.warc_type for r in df.collect()] == ["request"]
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")


def test_write_exports_and_dir_export(spark):
    from capstan.sinks.hashdir import write_dir_export

    path = scratch_path(spark, "t-warc6")
    _write_records(spark, path)
    recs = warc.read_warc(spark, path)
    root = scratch_path(spark, "t-export")
    names = R.write_exports(recs, root).collect()
    assert [(r.warc_file, r.filename) for r in names] == [("t", "x.pdf")]
    with open(os.path.join(root, "t", "x.pdf"), "rb") as fh:
        assert fh.read() == b"%PDF-1.4 data"
    root2 = scratch_path(spark, "t-dirx")
    pdfs = P.apply(R.responses(recs), [P.pdf_response])
    write_dir_export(pdfs, root2, content="body", size="size", prefix="pdf-", extension=".pdf")
    assert os.listdir(root2) == ["pdf-t-0.pdf"]


def test_plain_and_single_member_files(spark):
    path = scratch_path(spark, "t-warc7")
    os.makedirs(path)
    recs = b"".join(
        b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://p/%d\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n"
        % (i, len(body), body) for i, body in enumerate([b"one", b"", b"three" * 1000]))
    with open(os.path.join(path, "plain.warc"), "wb") as fh:
        fh.write(recs)
    with open(os.path.join(path, "whole.warc.gz"), "wb") as fh:
        fh.write(gzip.compress(recs))
    rows = warc.read_warc(spark, path).orderBy("file_name", "record_idx").collect()
    plain = [r for r in rows if r.file_name == "plain.warc"]
    whole = [r for r in rows if r.file_name == "whole.warc.gz"]
    assert [bytes(r.payload) for r in plain] == [b"one", b"", b"three" * 1000]
    assert [bytes(r.payload) for r in whole] == [b"one", b"", b"three" * 1000]
    # plain files: exact byte offsets of each record
    assert recs[plain[1].record_offset:].startswith(b"WARC/1.0")
    # one member: the records share its offset; its length is known at its end
    assert {r.record_offset for r in whole} == {0} and whole[-1].record_length is not None


def test_export_names_both_ways_agree(spark):
    path = scratch_path(spark, "t-names")
    pdf = bytearray(_response(b"%PDF-1.4 data", "application/pdf"))
    uris = ["http://a/x.pdf", "http://a/y", "http://b/x.pdf", "http://b/pdf_0002.pdf", "http://c/X.PDF", "http://a/x.pdf"]
    rows = [(f"f{i % 2}", i, "response", None, None, u, "application/http; msgtype=response", pdf) for i, u in enumerate(uris * 3)]
    df = spark.createDataFrame(rows, "warc_file string, record_idx long, warc_type string, record_id string, "
                                     "record_date string, target_uri string, content_type string, payload binary")
    warc.write_warc(df, path)
    recs = warc.read_warc(spark, path)
    cols = ["warc_file", "record_idx", "uri", "pdf_num", "filename"]
    a, b = (sorted(map(tuple, R.export_names(recs, in_reader_order=o).select(*cols).collect())) for o in (True, False))
    assert a == b and len(a) == 18 and len({(f, n) for f, _, _, _, n in a}) > 6
    with pytest.raises(Exception, match="not in order"):
        R.export_names(recs.orderBy(F.desc("record_idx"))).collect()


def test_coverage_says_what_numbers_the_exports():
    import inspect
    import os

    from capstan.plans import archive

    assert "in_reader_order" not in inspect.getsource(archive.q_export_names)  # the default
    with open(os.path.join(os.path.dirname(os.path.dirname(__file__)), "COVERAGE.md")) as f:
        w1 = [line for line in f if line.startswith("| W1 ")]
    assert [("_number_in_order" in x, "Q: export_names" in x) for x in w1] == [(True, True), (False, False)]
