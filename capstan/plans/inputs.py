"""Inputs derived by rule from the driver tables.

Each is a pure function of driver columns, so the same rows can be restated
in SQL.  The rules give every case of the reference's logic a share of rows
(see FIXTURES.md section 2).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from capstan.functions.report import with_info
from capstan.tables import table, version

PDF_MAGIC_HEX = "255044462D312E340A"  # "%PDF-1.4\\n"
JPEG_HEAD_HEX = "FFD8FFE0"


def _m(c: str, n: int) -> Column:
    return F.pmod(F.col(c), F.lit(n))


# ---------------------------------------------------------------- blobs

def blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as blobs: PDF magic on two of three, rule-made outcomes."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "n_chars")
    body = F.encode(F.col("text"), "UTF-8")
    content = F.when(_m("doc_id", 3) != 2, F.concat(F.unhex(F.lit(PDF_MAGIC_HEX)), body)).otherwise(body)
    return d.select("doc_id", "source", "n_chars", "text", content.alias("content"))


_TABLES: dict[tuple[str, str], str] = {}


def blocklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashes of the blobs whose doc_id is a multiple of 29 (S10 stand-in).

    Like a user-supplied list, it is an input table: derived by a Spark job
    and written once per session to the shared scratch folder."""
    from capstan.session import scratch_path
    from capstan.sources import fsio

    key = (spark.sparkContext.applicationId, version(spark, sf_dir, "documents"))
    path = _TABLES.get(key)
    if path is None or not fsio.exists(path):
        path = scratch_path(spark, "blocklist")
        b = blobs(spark, sf_dir)
        b.where(_m("doc_id", 29) == 0).select(F.sha1("content").alias("sha1hex")).write.parquet(path)
        _TABLES[key] = path
    return spark.read.parquet(path)


def thumbnail_bytes(doc_id: Column) -> Column:
    """``doc_id % 120`` bytes that start like a JPEG image."""
    full = F.concat(F.unhex(F.lit(JPEG_HEAD_HEX)), F.encode(F.repeat(F.lit("t"), 116), "UTF-8"))
    return F.substring(full, 1, F.pmod(doc_id, F.lit(120)).cast("int"))


def report_text(doc_id: Column, n_chars: Column, source: Column) -> Column:
    """Info-report text per document: size cases, one unknown key, one
    duplicate key, blank lines and a line without a colon."""
    size = (
        F.when(F.pmod(doc_id, F.lit(4)) == 0, F.lit("612 x 792 pts (letter)"))
        .when(F.pmod(doc_id, F.lit(4)) == 1, F.lit("595.32 x 841.92 pts (A4)"))
        .when(F.pmod(doc_id, F.lit(4)) == 2, F.lit("100 100 ambiguous string"))
        .otherwise(F.lit(""))
    )
    pages = F.pmod(n_chars, F.lit(40)) + 1
    lines = [
        F.concat(F.lit("Title:          Doc "), doc_id.cast("string")),
        F.concat(F.lit("Producer:       "), source),
        F.lit("Custom Metadata: no"),
        F.concat(F.lit("Tagged:         "),
                 F.when(F.pmod(doc_id, F.lit(2)) == 0, F.lit("yes")).otherwise(F.lit("no"))),
        F.concat(F.lit("Pages:          "), pages.cast("string")),
        F.lit("Encrypted:      no"),
        F.concat(F.lit("Page size:      "), size),
        F.concat(F.lit("Page rot:       "),
                 F.when(F.pmod(doc_id, F.lit(3)) == 0, F.lit("abc")).otherwise(F.lit("90"))),
        F.concat(F.lit("File size:      "), n_chars.cast("string"), F.lit(" bytes")),
        F.concat(F.lit("PDF version:    1."), F.pmod(doc_id, F.lit(8)).cast("string")),
        F.lit(""),
        F.lit("Unknown Key:    ignored"),
        F.lit("no colon on this line"),
        F.when(F.pmod(doc_id, F.lit(5)) == 0,
               F.concat(F.lit("Pages:          "), (pages + 1).cast("string"))).otherwise(F.lit("")),
    ]
    return F.concat_ws("\n", *lines)


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blobs with the rule-made extractor outcomes (stand-in for external tools):
    text fails when doc_id % 17 = 5, is empty when doc_id % 19 = 7;
    thumbnail is doc_id % 120 bytes; metadata is the parsed report."""
    b = blobs(spark, sf_dir)
    text = F.when(_m("doc_id", 17) == 5, F.lit(None)).when(_m("doc_id", 19) == 7, F.lit("")).otherwise(F.col("text"))
    o = b.select(
        "doc_id", "content", "n_chars", "source",
        text.alias("text"),
        F.when(_m("doc_id", 17) == 5, F.lit("exit status 1")).alias("text_err"),
        thumbnail_bytes(F.col("doc_id")).alias("thumbnail"),
    )
    o = with_info(o, report_text(F.col("doc_id"), F.col("n_chars"), F.col("source")), "metadata")
    return o.drop("n_chars", "source")
