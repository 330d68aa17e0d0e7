from pyspark.sql import functions as F

from capstan.functions.report import legacy_extra, page_dim, parse_any_int, parse_info, with_info


def test_page_dim_cases(spark):
    rows = [(None,), ("",), ("abc",), ("x",), ("1.2.3 x 4",), ("100 100 ambiguous string",),
            ("612 x 792 pts (letter)",), ("595.32 x 841.92 pts (A4)",)]
    df = spark.createDataFrame(rows, "s string")
    got = [(r.d.width, r.d.height) for r in df.select(page_dim(F.col("s")).alias("d")).collect()]
    assert got == [(0, 0), (0, 0), (0, 0), (0, 0), (0, 0), (0, 0), (612.0, 792.0), (595.32, 841.92)]


def test_parse_info_empty_is_zero_values(spark):
    df = spark.createDataFrame([("",)], "t string")
    info = df.select(parse_info(F.col("t")).alias("i")).first().i
    assert info.title == "" and info.pages == 0 and info.tagged is False and info.filesize == 0


def test_parse_info_sample(spark):
    text = "\n".join([
        "Title:          A LaTeX paper",
        "Creator:        LaTeX with hyperref",
        "Tagged:         no",
        "Pages:          12",
        "Page size:      612 x 792 pts (letter)",
        "Page rot:       0",
        "File size:      341023 bytes",
        "Optimized:      yes",
        "PDF version:    1.5",
        "Strange Key:    ignored",
        "",
        "no colon here",
        "Pages:          13",
    ])
    df = spark.createDataFrame([(text,)], "t string")
    i = with_info(df, F.col("t"), "i").select("i").first().i
    assert i.title == "A LaTeX paper"
    assert i.creator == "LaTeX with hyperref"
    assert i.pages == 13  # duplicate key: last wins
    assert i.filesize == 341023 and i.optimized is True and i.tagged is False
    assert i.pdf_version == "1.5" and i.page_rot == 0
    x = df.select(legacy_extra(parse_info(F.col("t"))).alias("x")).first().x
    assert (x.page0width, x.page0height, x.page_count, x.pdf_version) == (612.0, 792.0, 13, "1.5")


def test_parse_any_int(spark):
    df = spark.createDataFrame([("341023 bytes",), ("about 12 pages 3",), ("none",), (None,)], "s string")
    assert [r[0] for r in df.select(parse_any_int(F.col("s"))).collect()] == [341023, 12, 0, 0]
