from pyspark.sql import functions as F

from capstan.functions.hashing import file_info
from capstan.functions.links import weblinks
from capstan.functions.mime import detect_mimetype


def test_file_info_known_digests(spark):
    df = spark.createDataFrame([(bytearray(b""),), (bytearray(b"123"),), (bytearray(b"hello, world!"),)], "c binary")
    got = df.select(file_info(F.col("c")).alias("f")).collect()
    e = got[0].f
    assert (e.size, e.md5hex, e.sha1hex, e.mimetype) == (
        0, "d41d8cd98f00b204e9800998ecf8427e", "da39a3ee5e6b4b0d3255bfef95601890afd80709", "text/plain")
    assert e.sha256hex == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert got[1].f.sha1hex == "40bd001563085fc35165329ea1ff5c5ecbdbbeef"
    assert got[2].f.sha1hex == "1f09d30c707d53f3d16c530dd73d70a6ce7596a9"


def test_mimetype_ladder(spark):
    rows = [(bytearray(b"%PDF-1.7\n..."),), (bytearray(b"\xff\xd8\xff\xe0xx"),),
            (bytearray(b"\x89PNG\r\n\x1a\nxx"),), (bytearray(b"  <!DOCTYPE html><p>"),),
            (bytearray(b"plain words"),), (bytearray(b"\xc0\x80\xfe"),)]
    df = spark.createDataFrame(rows, "c binary")
    got = [r[0] for r in df.select(detect_mimetype(F.col("c"))).collect()]
    assert got == ["application/pdf", "image/jpeg", "image/png", "text/html; charset=utf-8",
                   "text/plain; charset=utf-8", "application/octet-stream"]


def test_mimetype_of_one_byte_text_and_late_markup(spark):
    rows = [(bytearray("café menu".encode("latin-1")),), (bytearray(b"it\x92s fine"),), (bytearray(b" " * 80 + b"<html>"),), (bytearray(b"\n%PDF-1.4"),),
            (bytearray(b"text \xe9 \x00"),)]
    got = [r[0] for r in spark.createDataFrame(rows, "c binary").select(detect_mimetype(F.col("c"))).collect()]
    assert got == ["text/plain; charset=iso-8859-1", "text/plain; charset=windows-1252", "text/html; charset=utf-8", "application/pdf",
                   "application/octet-stream"]


def test_weblinks_of_any_scheme(spark):
    text = "mailto:a@b.org, gopher://x.org/1 and svn+ssh://h/p; irc://i/c. tel:+49-30 xmpp:u@h not:this http://"
    got = spark.createDataFrame([(text,)], "t string").select(weblinks(F.col("t"))).first()[0]
    assert got == ["gopher://x.org/1", "irc://i/c", "mailto:a@b.org", "svn+ssh://h/p", "tel:+49-30", "xmpp:u@h"]


def test_weblinks_shapes(spark):
    text = ("see https://en.wikipedia.org/wiki/Sandbox_(software_development). and http://arXiv, "
            "https://www.crossref.org/ again https://www.crossref.org/ and "
            "ftp://ftp.example.org/pub/a.pdf; odd https://example.com/a\u200bb.")
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(weblinks(F.col("t"))).first()[0]
    assert got == sorted(set(got))
    assert "https://en.wikipedia.org/wiki/Sandbox_(software_development)" in got
    assert "http://arXiv" in got
    assert "https://www.crossref.org/" in got
    assert "ftp://ftp.example.org/pub/a.pdf" in got
    assert "https://example.com/ab" in got
    assert len(got) == 5


SOURCE_TEXT = b"import random\n\nwords = [\"water\", \"audio\"]\nprint(random.choice(words))\n"


def test_source_code_is_not_pdf(spark):
    from capstan.operators import derive

    blobs = spark.createDataFrame([(1, bytearray(SOURCE_TEXT))], "doc_id long, content binary")
    r = derive.extract(derive.gate(blobs, None).drop("content")).first()
    assert r.status == "not-pdf" and r.fileinfo.size == len(SOURCE_TEXT)
    assert r.err == "mimetype is text/plain; charset=utf-8"
