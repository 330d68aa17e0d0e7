"""Record and response predicates (P1-P12, P15) and their conjunction.

A filter is a ``Callable[[DataFrame], Column]`` (X1, X5) so user filters and
the built-in ones compose the same way; the conjunction keeps the given
order, which Catalyst respects for short-circuit evaluation of cheap tests.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capstan.functions.http import split_http

Filter = Callable[[DataFrame], Column]

RESPONSE_TYPE = "application/http; msgtype=response"


def has_target_uri(df: DataFrame) -> Column:  # P1
    return F.coalesce(F.col("target_uri"), F.lit("")) != F.lit("")


def is_http_response_record(df: DataFrame) -> Column:  # P2
    return F.coalesce(F.col("content_type") == F.lit(RESPONSE_TYPE), F.lit(False))


def has_record_length(df: DataFrame) -> Column:  # P3
    return F.col("content_length").isNotNull()


def pdf_response(df: DataFrame) -> Column:  # P5, case-sensitive prefix
    return F.coalesce(F.startswith(F.col("http_content_type"), F.lit("application/pdf")), F.lit(False))


def nonzero_content_length(df: DataFrame) -> Column:  # P6: missing -> reject
    raw = F.col("http_content_length_raw")
    n = raw.try_cast("bigint")
    return F.coalesce(raw.rlike(r"^[+-]?[0-9]+$") & (n != 0), F.lit(False))


def status_ok(df: DataFrame) -> Column:  # P10
    return F.coalesce(F.col("status_code") == 200, F.lit(False))


def loose_pdf(df: DataFrame) -> Column:
    """Response record, ``200`` in the status line, ``pdf`` in the
    lower-cased first Content-Type header."""
    return (
        (F.col("warc_type") == F.lit("response"))
        & F.coalesce(F.col("status_line").contains("200"), F.lit(False))
        & F.coalesce(F.lower(F.col("http_content_type")).contains("pdf"), F.lit(False))
    )


def head_pdf(df: DataFrame) -> Column:
    """Response record whose header block, of whatever size, has a status
    line with `` 200 `` and names ``application/pdf`` in any case."""
    h = split_http(F.col("payload"))
    named = F.exists(h["headers"], lambda x: F.lower(x["value"]).contains("application/pdf"))
    return (
        (F.coalesce(F.col("warc_type"), F.lit("")) == F.lit("response"))
        & F.coalesce(F.concat(h["status_line"], F.lit(" ")).contains(" 200 "), F.lit(False))
        & F.coalesce(named, F.lit(False))
    )


def over_cap(df: DataFrame, cap: int | None) -> Column:
    """P15 as a flag: whether the declared size (when > 0) or the actual size
    exceeds ``cap``; no cap (None) flags nothing.  No row is dropped."""
    if cap is None:
        return F.lit(False)
    declared = F.col("http_content_length")
    return ((declared > 0) & (declared > cap)) | (F.octet_length(F.col("body")) > cap)


def within_cap(cap: int | None) -> Filter:
    """P15 as a filter, for callers that want large responses left out."""
    return lambda df: ~over_cap(df, cap)


def all_of(filters: list[Filter]) -> Filter:
    """Conjunction in the given order; empty list keeps everything."""

    def f(df: DataFrame) -> Column:
        if not filters:
            return F.lit(True)
        return reduce(lambda a, b: a & b, (flt(df) for flt in filters))

    return f


def apply(df: DataFrame, filters: list[Filter]) -> DataFrame:
    return df.where(all_of(filters)(df))
