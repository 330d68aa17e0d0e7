from pyspark.sql import functions as F

from capstan.functions.ids import item_id
from capstan.functions.paths import (
    blob_path, export_filename, mask_sensitive, shard_prefix2, sharded_path,
    sharded_path_to_id, thumb_format,
)

H = "4e1243bd22c66e76c2ba9eddc1f91394e57f9f83"


def test_blob_path_cases(spark):
    rows = [("", H, "", ""), ("images", H, "", ""), ("images", H, "xml", ""), ("images", H, "xml", "dev-")]
    df = spark.createDataFrame(rows, "folder string, h string, ext string, prefix string")
    got = [r[0] for r in df.select(blob_path(F.col("folder"), F.col("h"), F.col("ext"), F.col("prefix"))).collect()]
    assert got == [
        f"/4e/12/{H}",
        f"images/4e/12/{H}",
        f"images/4e/12/{H}.xml",
        f"dev-images/4e/12/{H}.xml",
    ]


def test_sharded_path_cases(spark):
    rows = [("",), ("123",), ("34fc7a11cb38cf4911763696a41698c68e5ddbbe",),
            ("34fc7a11cb38cf4911763696a41698c68e5ddbbe.tei.xml",)]
    df = spark.createDataFrame(rows, "n string")
    got = [r[0] for r in df.select(sharded_path(F.lit("/spool"), F.col("n"))).collect()]
    assert got == [None, None, "/spool/34/fc/7a11cb38cf4911763696a41698c68e5ddbbe",
                   "/spool/34/fc/7a11cb38cf4911763696a41698c68e5ddbbe.tei.xml"]


def test_sharded_path_roundtrip_and_short(spark):
    df = spark.createDataFrame([("/spool/34/fc/7a11",), ("a/b",), ("",)], "p string")
    got = [r[0] for r in df.select(sharded_path_to_id(F.col("p"))).collect()]
    assert got == ["34fc7a11", "", ""]


def test_shard_prefix(spark):
    df = spark.createDataFrame([("abcdef",), ("a",)], "h string")
    assert [r[0] for r in df.select(shard_prefix2(F.col("h"))).collect()] == ["ab", ""]


def test_item_ids(spark):
    cases = [
        ("https://archive.org/details/OPENALEX-CRAWL-2025-09-20250922085855498-01863-01914-wbgrp-crawl047",
         "OPENALEX-CRAWL-2025-09-20250922085855498-01863-01914-wbgrp-crawl047"),
        ("OPENALEX-CRAWL-2025-09-20250922085855498-01863-01914-wbgrp-crawl047",
         "OPENALEX-CRAWL-2025-09-20250922085855498-01863-01914-wbgrp-crawl047"),
        ("http://archive.org/details/SOME-OTHER-ID", "SOME-OTHER-ID"),
        ("just-an-id", "just-an-id"),
        ("https://archive.org/details/ID_WITH_UNDERSCORES", "ID_WITH_UNDERSCORES"),
        ("https://archive.org/download/x/file.warc.gz", "file.warc.gz"),
    ]
    df = spark.createDataFrame(cases, "i string, e string")
    for r in df.select(item_id(F.col("i")).alias("g"), "e").collect():
        assert r.g == r.e


def test_mask(spark):
    df = spark.createDataFrame([("",), ("abcd",), ("abcde",), ("secretkey",)], "v string")
    assert [r[0] for r in df.select(mask_sensitive(F.col("v"))).collect()] == ["****", "****", "ab****de", "se****ey"]


def test_thumb_format(spark):
    df = spark.createDataFrame([("jpg",), ("JPEG",), ("png",), ("tiff",), ("bmp",)], "n string")
    got = [(r.t.flag, r.t.ext) for r in df.select(thumb_format(F.col("n")).alias("t")).collect()]
    assert got == [("-jpeg", ".jpg"), ("-jpeg", ".jpg"), ("-png", ".png"), ("-tiff", ".tiff"), ("-jpeg", ".jpg")]


def test_export_filename(spark):
    df = spark.createDataFrame([("http://x/a/Paper.PDF", 3), ("http://x/a/b.html", 7), (None, 12)], "u string, n int")
    got = [r[0] for r in df.select(export_filename(F.col("u"), F.col("n"))).collect()]
    assert got == ["Paper.PDF", "pdf_0007.pdf", "pdf_0012.pdf"]
