"""Document info reports as typed columns (S7, P24, F7-F10) and the JSON
report of the second info tool (S8)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WS = " \t\r\n\f\u000b"

# Report keys and the output field each one fills, with its kind
# (s = text, b = yes/no flag, i = integer, a = first integer token).
INFO_FIELDS = [
    ("Title", "title", "s"),
    ("Subject", "subject", "s"),
    ("Keywords", "keywords", "s"),
    ("Author", "author", "s"),
    ("Creator", "creator", "s"),
    ("Producer", "producer", "s"),
    ("CreationDate", "creation_date", "s"),
    ("ModDate", "mod_date", "s"),
    ("Custom Metadata", "custom_metadata", "b"),
    ("Metadata Stream", "metadata_stream", "b"),
    ("Tagged", "tagged", "b"),
    ("UserProperties", "user_properties", "b"),
    ("Suspects", "suspects", "b"),
    ("Form", "form", "s"),
    ("JavaScript", "javascript", "b"),
    ("Pages", "pages", "i"),
    ("Encrypted", "encrypted", "b"),
    ("Page size", "page_size", "s"),
    ("Page rot", "page_rot", "i"),
    ("File size", "filesize", "a"),
    ("Optimized", "optimized", "b"),
    ("PDF version", "pdf_version", "s"),
    ("PDF subtype", "pdf_subtype", "s"),
    ("Abbreviation", "abbreviation", "s"),
    ("Subtitle", "subtitle", "s"),
    ("Standard", "standard", "s"),
    ("Conformance", "conformance", "s"),
]

INT_RX = r"^[+-]?[0-9]+$"


def _strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WS))


def report_entries(text: Column) -> Column:
    """array<struct<k, v>>: one entry per ``key: value`` line."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), _strip)
    keyed = F.filter(lines, lambda x: (F.length(x) > 0) & (F.instr(x, ":") > 0))
    return F.transform(
        keyed,
        lambda x: F.struct(
            _strip(F.substring_index(x, ":", 1)).alias("k"),
            _strip(F.substring(x, F.instr(x, ":") + 1, 1 << 30)).alias("v"),
        ),
    )


def _last_value(entries: Column, key: str) -> Column:
    hits = F.filter(entries, lambda e: e["k"] == F.lit(key))
    return F.try_element_at(hits, F.lit(-1))["v"]


def parse_bool(v: Column) -> Column:
    """``yes`` is true, anything else false."""
    return F.coalesce(v == F.lit("yes"), F.lit(False))


def parse_int(v: Column) -> Column:
    """Base-10 integer, else 0."""
    return F.coalesce(F.when(v.rlike(INT_RX), (v).try_cast("bigint")), F.lit(0).cast("bigint"))


def parse_any_int(v: Column) -> Column:
    """First whitespace-separated token that is an integer, else 0."""
    toks = F.split(_strip(F.coalesce(v, F.lit(""))), r"\s+")
    ints = F.filter(toks, lambda t: t.rlike(INT_RX) & (t).try_cast("bigint").isNotNull())
    return F.coalesce((F.try_element_at(ints, F.lit(1))).try_cast("bigint"), F.lit(0).cast("bigint"))


def parse_info(text: Column) -> Column:
    """27-field struct from report text (S7, F8): duplicate key -> last wins,
    unknown keys ignored, missing keys take zero values.

    Prefer ``with_info`` on a DataFrame: it materialises the line split once
    instead of once per field."""
    return info_from_entries(report_entries(text))


def with_info(df, text: Column, out: str = "info"):
    """Add the parsed report as ``out``; the entries are computed in their
    own projection (not inlined 27 times by the optimizer)."""
    tmp = f"_{out}_entries"
    return df.withColumn(tmp, report_entries(text)).withColumn(out, info_from_entries(F.col(tmp))).drop(tmp)


def info_from_entries(entries: Column) -> Column:
    fields = []
    for key, name, kind in INFO_FIELDS:
        v = _last_value(entries, key)
        if kind == "s":
            out = F.coalesce(v, F.lit(""))
        elif kind == "b":
            out = parse_bool(v)
        elif kind == "i":
            out = parse_int(v)
        else:
            out = parse_any_int(v)
        fields.append(out.alias(name))
    return F.struct(*fields)


PAGE_DIM_RX = r"([0-9.]*)\s*x\s*([0-9.]*)"


def page_dim(page_size: Column) -> Column:
    """struct<width, height> from ``595.276 x 841.89 pts (A4)``; (0, 0)
    unless both numbers parse (F7)."""
    s = F.coalesce(page_size, F.lit(""))
    matched = F.regexp_instr(s, F.lit(PAGE_DIM_RX)) > 0
    w = (F.nullif(F.regexp_extract(s, PAGE_DIM_RX, 1), F.lit(""))).try_cast("double")
    h = (F.nullif(F.regexp_extract(s, PAGE_DIM_RX, 2), F.lit(""))).try_cast("double")
    ok = matched & w.isNotNull() & h.isNotNull()
    zero = F.lit(0.0)
    return F.struct(
        F.when(ok, w).otherwise(zero).alias("width"),
        F.when(ok, h).otherwise(zero).alias("height"),
    )


def legacy_extra(info: Column) -> Column:
    """page-0 size, page count and version from a parsed report."""
    dim = page_dim(info["page_size"])
    return F.struct(
        dim["height"].alias("page0height"),
        dim["width"].alias("page0width"),
        info["pages"].alias("page_count"),
        F.lit("").alias("permanent_id"),
        F.lit("").alias("update_id"),
        info["pdf_version"].alias("pdf_version"),
    )


PDFCPU_INFO = T.StructType(
    [
        T.StructField("appendOnly", T.BooleanType()),
        T.StructField("author", T.StringType()),
        T.StructField("bookmarks", T.BooleanType()),
        T.StructField("creationDate", T.StringType()),
        T.StructField("creator", T.StringType()),
        T.StructField("encrypted", T.BooleanType()),
        T.StructField("form", T.BooleanType()),
        T.StructField("hybrid", T.BooleanType()),
        T.StructField("keywords", T.ArrayType(T.StringType())),
        T.StructField("linearized", T.BooleanType()),
        T.StructField("modificationDate", T.StringType()),
        T.StructField("names", T.BooleanType()),
        T.StructField("pageCount", T.LongType()),
        T.StructField("pageMode", T.StringType()),
        T.StructField(
            "pageSizes",
            T.ArrayType(
                T.StructType(
                    [T.StructField("height", T.DoubleType()), T.StructField("width", T.DoubleType())]
                )
            ),
        ),
        T.StructField("permissions", T.LongType()),
        T.StructField("producer", T.StringType()),
        T.StructField("properties", T.StructType([T.StructField("PTEX.Fullbanner", T.StringType())])),
        T.StructField("signatures", T.BooleanType()),
        T.StructField("source", T.StringType()),
        T.StructField("subject", T.StringType()),
        T.StructField("tagged", T.BooleanType()),
        T.StructField("thumbnails", T.BooleanType()),
        T.StructField("title", T.StringType()),
        T.StructField("unit", T.StringType()),
        T.StructField("usingObjectStreams", T.BooleanType()),
        T.StructField("usingXRefStreams", T.BooleanType()),
        T.StructField("version", T.StringType()),
        T.StructField("watermarked", T.BooleanType()),
    ]
)

PDFCPU_SCHEMA = T.StructType(
    [
        T.StructField(
            "header",
            T.StructType(
                [T.StructField("creation", T.StringType()), T.StructField("version", T.StringType())]
            ),
        ),
        T.StructField("infos", T.ArrayType(PDFCPU_INFO)),
    ]
)


def parse_pdfcpu(json_text: Column) -> Column:
    """The JSON report as a typed struct (unknown fields ignored)."""
    return F.from_json(json_text, PDFCPU_SCHEMA)
