"""Capture index (CDX) lines (S6, P23) and fetching records by index.

Lines are whitespace-separated; the default field order is
``N b a m s k r M S V g``.  Kept: url (2), mime type (3), response code (4),
compressed record size (8), compressed offset (9), file name (10).  Header
lines (``CDX ...``) are dropped wherever they occur; a line with fewer than
11 fields or a non-integer code/size/offset (64 bits) is kept in ``_corrupt_record``
with a reason instead of failing the job.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

INT_RX = r"^[+-]?[0-9]+$"


def _int(field: Column) -> Column:
    return F.when(field.rlike(INT_RX), field.try_cast("bigint"))


def parse_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """All lines with parsed fields and a ``reason`` (null for good lines)."""
    t = F.btrim(F.col(value), F.lit(" \t\r\n\f\u000b"))
    f = F.split(t, r"\s+")
    code, size, offset = _int(F.get(f, 4)), _int(F.get(f, 8)), _int(F.get(f, 9))
    reason = (
        F.when(F.startswith(t, F.lit("CDX")), F.lit("header"))
        .when(F.length(t) == 0, F.lit("blank"))
        .when(F.size(f) < 11, F.lit("short"))
        .when(code.isNull() | size.isNull() | offset.isNull(), F.lit("bad-int"))
    )
    return lines.select(
        F.get(f, 2).alias("url"), F.get(f, 3).alias("mime_type"), code.alias("response_code"),
        size.alias("compressed_record_size"), offset.alias("compressed_offset"),
        F.get(f, 10).alias("filename"),
        F.when(reason.isNotNull(), F.col(value)).alias("_corrupt_record"),
        reason.alias("reason"),
    )


def records(lines: DataFrame, value: str = "value") -> DataFrame:
    """Good lines only."""
    p = parse_lines(lines, value)
    return p.where(F.col("reason").isNull()).drop("_corrupt_record", "reason")


def read_cdx(spark: SparkSession, path: str) -> DataFrame:
    """Parsed records and rejects of CDX text files."""
    return parse_lines(spark.read.text(path))


def index_records(warc_records: DataFrame) -> DataFrame:
    """Build index rows from archive records (read without payload)."""
    r = warc_records.where(F.col("warc_type") == "response")
    return r.select(
        F.col("target_uri").alias("url"), F.col("content_type").alias("mime_type"),
        F.col("record_length").alias("compressed_record_size"),
        F.col("record_offset").alias("compressed_offset"),
        F.col("file_name").alias("filename"),
    )


FETCH_SCHEMA = T.StructType([
    T.StructField("filename", T.StringType()),
    T.StructField("compressed_offset", T.LongType()),
    T.StructField("target_uri", T.StringType()),
    T.StructField("warc_type", T.StringType()),
    T.StructField("payload", T.BinaryType()),
    T.StructField("error", T.StringType()),
])


ARROW_FETCH = pa.schema([("filename", pa.string()), ("compressed_offset", pa.int64()), ("target_uri", pa.string()),
                         ("warc_type", pa.string()), ("payload", pa.binary()), ("error", pa.string())])


def _wanted(records: list, url: str | None) -> tuple[dict, bytes] | None:
    """Of the records at an offset, the one an index row means: the first with
    its URL (a response before others), or the first of all without a URL."""
    same = [r for r in records if url is None or r[0].get("warc-target-uri") == url]
    return next((r for r in same if r[0].get("warc-type") == "response"), same[0] if same else None)


OPEN_COST, READ_BLOCK = 1 << 20, 64 << 20


def read_ranges(index: DataFrame, open_cost: int = OPEN_COST, block: int = READ_BLOCK) -> DataFrame:
    """``index`` (filename, compressed_offset, compressed_record_size and
    any other columns) with the read range of each row, ``range_start`` to
    ``range_stop``.

    Rows of a file whose gap is at most ``open_cost`` bytes (what one more open
    or request is worth) share a range; equal and overlapping rows do.  A range
    begins anew at every ``block`` bytes of the file, so neither a range nor the
    window that finds it grows with a file or its rows' number beyond a block.
    Rows without a size (null, or not positive) have no range.
    """
    sized = F.col("compressed_record_size") > 0
    end = F.col("compressed_offset") + F.col("compressed_record_size")
    near = Window.partitionBy("filename", "_block").orderBy("compressed_offset", "_end")
    before = near.rowsBetween(Window.unboundedPreceding, -1)
    island = Window.partitionBy("filename", "_block", "_island")
    rows = index.withColumn("_end", F.when(sized, end)).withColumn(
        "_block", F.when(sized, F.floor(F.col("compressed_offset") / block)).otherwise(-1 - F.pmod(F.xxhash64("compressed_offset"), F.lit(4096))))
    rows = rows.withColumn("_reached", F.max("_end").over(before))
    new = F.col("_reached").isNull() | (F.col("compressed_offset") > F.col("_reached") + open_cost)
    rows = rows.withColumn("_island", F.sum(F.when(new, 1).otherwise(0)).over(near))
    rows = rows.withColumn("range_start", F.when(sized, F.min("compressed_offset").over(island))).withColumn(
        "range_stop", F.when(sized, F.max("_end").over(island)))
    return rows.drop("_end", "_block", "_reached", "_island")


def range_totals(ranged: DataFrame) -> DataFrame:
    """What a fetch will read: per file the number of ranges (opens), index rows
    and bytes."""
    each = ranged.where("range_start IS NOT NULL").groupBy("filename", "range_start", "range_stop").agg(F.count("*").alias("n"))
    return each.groupBy("filename").agg(F.count("*").alias("ranges"), F.sum("n").alias("rows"), F.sum(F.col("range_stop") - F.col("range_start")).alias("bytes"))


BATCH_BYTES = 32 << 20


def fetch(index: DataFrame, base_path: str, num_partitions: int | None = None, open_cost: int = OPEN_COST, block: int = READ_BLOCK) -> DataFrame:
    """Read the records named by index rows (filename, compressed_offset,
    compressed_record_size, and url if the index has it) from files under
    ``base_path``, gzip-compressed or plain.

    Every index row gives one row: the record (a member may hold several; the
    URL tells which) or, in ``error``, why there is none.  A null size reads to
    the end of the member or record.  Rows are planned into read ranges
    (``read_ranges``) and range-partitioned on (filename, range), so one large
    file is read by several tasks; a range is one open and one read, and a row
    that it does not settle (no size, or more bytes than the index says) is
    read by itself.
    """
    from capstan.session import range_partitions

    n = range_partitions(index.sparkSession, num_partitions)
    url = F.col("url") if "url" in index.columns else F.lit(None)
    idx = index.select("filename", F.col("compressed_offset").cast("bigint"),
                       F.col("compressed_record_size").cast("bigint"), url.cast("string").alias("url"))
    idx = read_ranges(idx, open_cost, block).withColumn("at", F.coalesce("range_start", "compressed_offset"))
    idx = idx.repartitionByRange(n, "filename", "at").sortWithinPartitions("filename", "at", "compressed_offset")
    base = base_path

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import io

        from capstan.sources.fsio import join, open_read
        from capstan.sources.warc import read_member, read_member_of

        broken = (OSError, ValueError, EOFError, TypeError, zlib.error)
        held, buffer, at, found, error = None, None, None, [], None  # index rows of one range, and of one member, follow each other
        rows, size = [], 0
        for b in batches:
            for name, off, length, url, start, stop, _ in zip(*(c.to_pylist() for c in b.columns)):
                if start is not None and held != (name, start, stop):
                    held, buffer = (name, start, stop), None
                    try:
                        with open_read(join(base, name)) as f:
                            f.seek(start)
                            buffer = f.read(stop - start)
                    except broken:
                        pass  # each row says why
                if at != (name, off, length):
                    at, found, error = (name, off, length), [], None
                    try:
                        if start is not None and buffer is not None:
                            found = read_member_of(io.BytesIO(memoryview(buffer)[off - start:off - start + length]), 0, length)
                    except broken:
                        found = []
                    try:
                        found = found or read_member(join(base, name), off, length)
                    except broken as exc:
                        error = f"{type(exc).__name__}: {exc}"
                hit = _wanted(found, url)
                why = None if hit else error or "no record with this URL at the offset"
                heads, payload = hit or ({}, None)
                rows.append({"filename": name, "compressed_offset": off, "target_uri": heads.get("warc-target-uri"),
                             "warc_type": heads.get("warc-type"), "payload": payload, "error": why})
                size += len(payload or b"")
                if size >= BATCH_BYTES or len(rows) >= 1024:
                    yield pa.RecordBatch.from_pylist(rows, ARROW_FETCH)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, ARROW_FETCH)

    return idx.mapInArrow(read, FETCH_SCHEMA)
