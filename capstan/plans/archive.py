"""Catalogue queries for archive files, capture indexes and item metadata.

The captures are derived from ``pages`` by rule (FIXTURES.md section 2),
written as WARC files by a Spark job into the shared checkpoint folder and
read back through the ``warc`` data source, so every query below exercises
the real reader.  The files are written once per session and input folder.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from capstan.functions import http
from capstan.operators import filters as P
from capstan.operators import responses as R
from capstan.plans.registry import query
from capstan.session import scratch_path
from capstan.sources import fsio, warc
from capstan.tables import table, version

CRLF = "\r\n"
RESPONSE_CT = "application/http; msgtype=response"
REQUEST_CT = "application/http; msgtype=request"
RECORD_DATE = "2024-01-01T00:00:00Z"
BODY_CAP = 4096

_WRITTEN: dict[tuple[str, str], str] = {}


def _m(n: int) -> Column:
    return F.pmod(F.col("page_id"), F.lit(n))


def capture_number() -> Column:
    """One capture file per 1,000 pages."""
    return F.floor(F.col("page_id") / 1000).cast("bigint")


def capture_content_type() -> Column:
    return (
        F.when(_m(5) == 0, F.lit("application/pdf"))
        .when(_m(5) == 1, F.lit("application/pdf; charset=utf-8"))
        .when(_m(5) == 2, F.lit("text/html"))
        .when(_m(5) == 3, F.lit("Application/PDF"))
        .otherwise(F.lit(""))
    )


def http_message() -> Column:
    """Response bytes: status line, optional Content-Type and Content-Length
    headers, blank line, body (the page html)."""
    ct = capture_content_type()
    html = F.encode(F.col("html"), "UTF-8")
    status = F.when(_m(7) == 6, F.lit("HTTP/1.1 404 Not Found")).otherwise(F.lit("HTTP/1.1 200 OK"))
    ct_line = F.when(ct != "", F.concat(F.lit("Content-Type: "), ct, F.lit(CRLF))).otherwise(F.lit(""))
    len_line = F.when(_m(11) == 10, F.lit("")).otherwise(
        F.concat(F.lit("Content-Length: "), F.octet_length(html).cast("string"), F.lit(CRLF)))
    head = F.concat(status, F.lit(CRLF), ct_line, len_line, F.lit(CRLF))
    return F.concat(F.encode(head, "UTF-8"), html)


def capture_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per page (a request record when page_id % 13 = 12) plus
    one warcinfo record at the start of every file."""
    p = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    is_req = _m(13) == 12
    recs = p.select(
        F.concat(F.lit("cap-"), capture_number().cast("string")).alias("warc_file"),
        F.col("page_id").alias("record_idx"),
        F.when(is_req, F.lit("request")).otherwise(F.lit("response")).alias("warc_type"),
        F.format_string("<urn:uuid:00000000-0000-4000-8000-%012d>", F.col("page_id")).alias("record_id"),
        F.lit(RECORD_DATE).alias("record_date"),
        F.col("url").alias("target_uri"),
        F.when(is_req, F.lit(REQUEST_CT)).otherwise(F.lit(RESPONSE_CT)).alias("content_type"),
        F.when(is_req, F.encode(F.concat(F.lit("GET / HTTP/1.1" + CRLF + "Host: example" + CRLF + CRLF)), "UTF-8"))
        .otherwise(http_message()).alias("payload"),
    )
    infos = recs.select("warc_file").distinct().select(
        "warc_file", F.lit(-1).cast("bigint").alias("record_idx"), F.lit("warcinfo").alias("warc_type"),
        F.lit(None).cast("string").alias("record_id"), F.lit(RECORD_DATE).alias("record_date"),
        F.lit(None).cast("string").alias("target_uri"), F.lit("application/warc-fields").alias("content_type"),
        F.encode(F.lit("software: capstan" + CRLF), "UTF-8").alias("payload"),
    )
    return recs.unionByName(infos)


def capture_files(spark: SparkSession, sf_dir: str) -> str:
    """Folder holding the capture WARC files (written once per session)."""
    key = (spark.sparkContext.applicationId, version(spark, sf_dir, "pages"))
    path = _WRITTEN.get(key)
    if path is None or not fsio.exists(path):
        path = scratch_path(spark, "captures")
        warc.write_warc(capture_rows(spark, sf_dir), path)
        _WRITTEN[key] = path
    return path


def records(spark: SparkSession, sf_dir: str, payload: bool = True, types: str | None = None) -> DataFrame:
    """Capture records; ``types`` keeps only those WARC types at the source
    (their payloads never leave the Python reader otherwise)."""
    opts = {"warcTypes": types} if types else {}
    return warc.read_warc(spark, capture_files(spark, sf_dir), payload=payload, **opts)


CAPTURES_SQL = """
cap AS (
  SELECT page_id, url, html, 'cap-' || CAST(page_id // 1000 AS VARCHAR) AS warc_file,
    page_id % 13 <> 12 AS is_response,
    CASE page_id % 5 WHEN 0 THEN 'application/pdf' WHEN 1 THEN 'application/pdf; charset=utf-8'
                     WHEN 2 THEN 'text/html' WHEN 3 THEN 'Application/PDF' ELSE '' END AS ct,
    CASE WHEN page_id % 7 = 6 THEN 404 ELSE 200 END AS status,
    page_id % 11 <> 10 AS has_len,
    CAST(strlen(html) AS BIGINT) AS body_len
  FROM pages
),
msg AS (
  SELECT *, 'HTTP/1.1 ' || CASE WHEN status = 404 THEN '404 Not Found' ELSE '200 OK' END || chr(13) || chr(10)
      || CASE WHEN ct <> '' THEN 'Content-Type: ' || ct || chr(13) || chr(10) ELSE '' END
      || CASE WHEN has_len THEN 'Content-Length: ' || CAST(body_len AS VARCHAR) || chr(13) || chr(10) ELSE '' END
      || chr(13) || chr(10) || html AS m
  FROM cap
)"""


@query("warc_records", sql="WITH " + CAPTURES_SQL + """
SELECT url AS uri, CAST(strlen(m) AS BIGINT) AS content_length FROM msg WHERE is_response
""")
def q_warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = records(spark, sf_dir, payload=False)
    r = P.apply(r, [P.has_target_uri, P.is_http_response_record, P.has_record_length])
    return r.select(F.col("target_uri").alias("uri"), "content_length")


@query("warc_pdf_responses", sql="WITH " + CAPTURES_SQL + """
SELECT url AS uri, status AS status_code, ct AS content_type, body_len AS size, sha1(html) AS body_sha1
FROM msg WHERE is_response AND starts_with(ct, 'application/pdf') AND has_len AND body_len <> 0
""")
def q_warc_pdf_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    resp = R.responses(records(spark, sf_dir))
    pdfs = P.apply(resp, [P.pdf_response, P.nonzero_content_length])
    staged = R.stage_for_intake(pdfs)
    return staged.select(F.col("url").alias("uri"), "status_code", "content_type",
                         F.col("declared").alias("size"), F.col("sha1hex").alias("body_sha1"))


@query("warc_capture_log", sql="WITH " + CAPTURES_SQL + """
SELECT status AS status_code, CASE WHEN has_len THEN body_len ELSE -1 END AS size, url AS uri
FROM msg WHERE is_response AND status = 200
""")
def q_warc_capture_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.capture_log(R.responses(records(spark, sf_dir)))


@query("warc_body_cap", sql="WITH " + CAPTURES_SQL + f"""
SELECT url AS uri, body_len AS size, body_len > {BODY_CAP} AS over_cap FROM msg
WHERE is_response AND starts_with(ct, 'application/pdf')
""")
def q_warc_body_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    resp = P.apply(R.responses(records(spark, sf_dir)), [P.pdf_response])
    return resp.select("uri", F.octet_length("body").cast("bigint").alias("size"), P.over_cap(resp, BODY_CAP).alias("over_cap"))


SINKS = {
    "hashdir": lambda df: F.lit(True),
    "dir": lambda df: F.lit(True),
    "log": P.status_ok,
}


@query("sink_fanout", sql="WITH " + CAPTURES_SQL + """,
c AS (SELECT * FROM msg WHERE is_response AND starts_with(ct, 'application/pdf'))
SELECT 'hashdir' AS sink, count(*) AS captures, CAST(coalesce(sum(body_len), 0) AS BIGINT) AS bytes FROM c
UNION ALL SELECT 'dir', count(*), CAST(coalesce(sum(body_len), 0) AS BIGINT) FROM c
UNION ALL SELECT 'log', count(*), CAST(coalesce(sum(body_len), 0) AS BIGINT) FROM c WHERE status = 200
""")
def q_sink_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    resp = P.apply(R.responses(records(spark, sf_dir)), [P.pdf_response])
    return R.fan_out_counts(resp, SINKS)


@query("warc_loose_filter", sql="WITH " + CAPTURES_SQL + """
SELECT url AS uri FROM msg WHERE is_response AND status = 200 AND contains(lower(ct), 'pdf')
""")
def q_warc_loose_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = records(spark, sf_dir, types="response")  # P8 needs response records only
    parsed = r.withColumn("_h", http.split_http(F.col("payload"))).select(
        "warc_type", F.col("target_uri").alias("uri"), F.col("_h.status_line").alias("status_line"),
        http.header(F.col("_h.headers"), "content-type").alias("http_content_type"),
    )
    return P.apply(parsed, [P.loose_pdf]).select("uri")


P9_SQL = """
p9f AS (
  SELECT warc_file, page_id, url, is_response AND status = 200 AND contains(lower(ct), 'application/pdf') AS hit FROM msg
)"""


@query("warc_counts", sql="WITH " + CAPTURES_SQL + "," + P9_SQL + """
SELECT warc_file, count(*) + 1 AS records, CAST(sum(CASE WHEN hit THEN 1 ELSE 0 END) AS BIGINT) AS pdfs
FROM p9f GROUP BY warc_file
""")
def q_warc_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.file_counts(records(spark, sf_dir))


@query("export_names", sql="WITH " + CAPTURES_SQL + "," + P9_SQL + """,
d AS (SELECT warc_file, page_id, url, row_number() OVER (PARTITION BY warc_file ORDER BY page_id) AS n
      FROM p9f WHERE hit),
w AS (SELECT *, CASE WHEN ends_with(lower(split_part(url, '/', -1)), '.pdf') THEN split_part(url, '/', -1)
                     ELSE printf('pdf_%04d.pdf', n) END AS wanted FROM d),
x AS (SELECT *, row_number() OVER (PARTITION BY warc_file, wanted ORDER BY page_id) AS k FROM w)
SELECT warc_file, url AS uri, CASE WHEN k = 1 THEN wanted ELSE printf('pdf_%04d.pdf', n) END AS filename FROM x
""")
def q_export_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    # P9 needs response records only
    return R.export_names(records(spark, sf_dir, types="response")).select("warc_file", "uri", "filename")


@query("export_names_shuffled", sql="WITH " + CAPTURES_SQL + "," + P9_SQL + """,
d AS (SELECT warc_file, page_id, url, row_number() OVER (PARTITION BY warc_file ORDER BY page_id) AS n FROM p9f WHERE hit),
w AS (SELECT *, CASE WHEN ends_with(lower(split_part(url, '/', -1)), '.pdf') THEN split_part(url, '/', -1)
                     ELSE printf('pdf_%04d.pdf', n) END AS wanted FROM d),
x AS (SELECT *, row_number() OVER (PARTITION BY warc_file, wanted ORDER BY page_id) AS k FROM w)
SELECT warc_file, url AS uri, n AS pdf_num, CASE WHEN k = 1 THEN wanted ELSE printf('pdf_%04d.pdf', n) END AS filename FROM x
""")
def q_export_names_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1, W3 for records that a shuffle took out of their files' order."""
    r = records(spark, sf_dir, types="response").repartition("target_uri")
    return R.export_names(r, in_reader_order=False).select("warc_file", "uri", "pdf_num", "filename")


def secure_and_long(df: DataFrame) -> Column:
    """A filter of a user's own: pages under https whose body is longer than its URL."""
    return F.startswith("uri", F.lit("https://")) & (F.octet_length("body") > F.octet_length(F.encode("uri", "UTF-8")))


@query("warc_own_filter", sql="WITH " + CAPTURES_SQL + """
SELECT url AS uri, body_len AS size FROM msg
WHERE is_response AND status = 200 AND starts_with(url, 'https://') AND body_len > strlen(url)
""")
def q_warc_own_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's filter in one conjunction with the library's."""
    resp = P.apply(R.responses(records(spark, sf_dir)), [P.status_ok, secure_and_long])
    return resp.select("uri", F.octet_length("body").cast("bigint").alias("size"))


# ------------------------------------------------------------------- CDX

CDX_HEADER = " CDX N b a m s k r M S V g"


def cdx_line_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index lines by rule: 11 fields; code '-' when page_id % 9 = 4; one
    field missing when page_id % 9 = 8; one header line."""
    p = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    ct = capture_content_type()
    mime = F.when(ct == "", F.lit("-")).otherwise(F.lower(F.split_part(ct, F.lit(";"), F.lit(1))))
    code = F.when(_m(9) == 4, F.lit("-")).otherwise(F.when(_m(7) == 6, F.lit("404")).otherwise(F.lit("200")))
    fields = [
        F.concat(F.lit("key"), F.col("page_id").cast("string")),
        F.concat(F.lit("20240101"), F.lpad(_m(1000000).cast("string"), 6, "0")),
        F.col("url"), mime, code,
        F.upper(F.substring(F.sha1(F.encode("html", "UTF-8")), 1, 32)),
        F.lit("-"), F.lit("-"),
        (F.octet_length(F.encode("html", "UTF-8")) + 200).cast("string"),
        (F.col("page_id") * 4096).cast("string"),
        F.concat(F.lit("cap-"), capture_number().cast("string"), F.lit(".warc.gz")),
    ]
    short = fields[:6] + fields[7:]
    line = F.when(_m(9) == 8, F.concat_ws(" ", *short)).otherwise(F.concat_ws(" ", *fields))
    header = spark.range(1).select(F.lit(CDX_HEADER).alias("value"))
    return p.select(line.alias("value")).unionByName(header)


def cdx_files(spark: SparkSession, sf_dir: str) -> str:
    key = (spark.sparkContext.applicationId, version(spark, sf_dir, "pages") + "#cdx")
    path = _WRITTEN.get(key)
    if path is None or not fsio.exists(path):
        path = scratch_path(spark, "cdx")
        cdx_line_rows(spark, sf_dir).write.mode("overwrite").text(path)
        _WRITTEN[key] = path
    return path


CDX_SQL = """
cdx AS (
  SELECT page_id, url,
    CASE page_id % 5 WHEN 0 THEN 'application/pdf' WHEN 1 THEN 'application/pdf'
                     WHEN 2 THEN 'text/html' WHEN 3 THEN 'application/pdf' ELSE '-' END AS mime_type,
    CASE WHEN page_id % 7 = 6 THEN 404 ELSE 200 END AS response_code,
    CAST(strlen(html) + 200 AS BIGINT) AS compressed_record_size,
    CAST(page_id AS BIGINT) * 4096 AS compressed_offset,
    'cap-' || CAST(page_id // 1000 AS VARCHAR) || '.warc.gz' AS filename
  FROM pages WHERE page_id % 9 NOT IN (4, 8)
)"""


@query("cdx_parse", sql="WITH " + CDX_SQL + """
SELECT url, mime_type, CAST(response_code AS BIGINT) AS response_code, compressed_record_size,
       compressed_offset, filename FROM cdx
""")
def q_cdx_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    from capstan.sources import cdx

    p = cdx.read_cdx(spark, cdx_files(spark, sf_dir))
    return p.where(F.col("reason").isNull()).drop("_corrupt_record", "reason")


@query("cdx_rejects", sql="""
SELECT reason, count(*) AS n FROM (
  SELECT CASE WHEN page_id % 9 = 8 THEN 'short' ELSE 'bad-int' END AS reason FROM pages WHERE page_id % 9 IN (4, 8)
  UNION ALL SELECT 'header'
) GROUP BY reason
""")
def q_cdx_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    from capstan.sources import cdx

    p = cdx.read_cdx(spark, cdx_files(spark, sf_dir))
    return p.where(F.col("reason").isNotNull()).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("cdx_fetch", sql="WITH " + CAPTURES_SQL + """
SELECT url, sha1(html) AS body_sha1 FROM msg WHERE is_response
""")
def q_cdx_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    from capstan.sources import cdx

    base = capture_files(spark, sf_dir)
    index = cdx.index_records(records(spark, sf_dir, payload=False))
    got = cdx.fetch(index, base)
    parsed = got.withColumn("_h", http.split_http(F.col("payload")))
    return parsed.select(F.col("target_uri").alias("url"),
                         F.sha1(http.body(F.col("payload"), F.col("_h"))).alias("body_sha1"))


@query("fetch_ranges", sql="WITH " + CDX_SQL + """,
b AS (SELECT *, compressed_offset + compressed_record_size AS stop, compressed_offset // 65536 AS block FROM cdx),
r AS (SELECT *, max(stop) OVER (PARTITION BY filename, block ORDER BY compressed_offset, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM b),
i AS (SELECT *, sum(CASE WHEN reached IS NULL OR compressed_offset > reached + 3000 THEN 1 ELSE 0 END)
                OVER (PARTITION BY filename, block ORDER BY compressed_offset, stop ROWS UNBOUNDED PRECEDING) AS island FROM r),
e AS (SELECT filename, count(*) AS n, max(stop) - min(compressed_offset) AS bytes FROM i GROUP BY filename, block, island)
SELECT filename, count(*) AS ranges, CAST(sum(n) AS BIGINT) AS rows, CAST(sum(bytes) AS BIGINT) AS bytes FROM e GROUP BY filename
""")
def q_fetch_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The read ranges of a fetch by index, as rows, opens and bytes."""
    from capstan.sources import cdx

    p = cdx.read_cdx(spark, cdx_files(spark, sf_dir)).where(F.col("reason").isNull())
    return cdx.range_totals(cdx.read_ranges(p, open_cost=3000, block=1 << 16))


LARGE_OFFSET = 5_439_151_290  # beyond 32 bits


@query("cdx_large_offset", sql=f"SELECT url, CAST(page_id AS BIGINT) * 4096 + {LARGE_OFFSET} AS compressed_offset, CAST(page_id AS BIGINT) + {LARGE_OFFSET} AS compressed_record_size FROM pages")
def q_cdx_large_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 with 64-bit sizes and offsets."""
    from capstan.sources import cdx

    p = table(spark, sf_dir, "pages").select("page_id", "url")
    line = F.concat_ws(" ", F.lit("k 20240101000000"), "url", F.lit("text/html 200 K - -"),
                       (F.col("page_id") + LARGE_OFFSET).cast("string"), (F.col("page_id") * 4096 + LARGE_OFFSET).cast("string"), F.lit("f.warc.gz"))
    return cdx.records(p.select(line.alias("value"))).select("url", "compressed_offset", "compressed_record_size")


def plain_record(length: Column, first_line: Column, uri: Column, block: Column) -> Column:
    """Bytes of one uncompressed record; header parts as given."""
    head = F.concat(first_line, F.lit(CRLF + "WARC-Type: response" + CRLF + "WARC-Target-URI: "), uri,
                    F.lit(CRLF + "Content-Type: " + RESPONSE_CT + CRLF + "Content-Length: "), length, F.lit(CRLF * 2))
    return F.concat(F.encode(head, "UTF-8"), block, F.encode(F.lit(CRLF * 2), "UTF-8"))


def _joined(rows: DataFrame, per_file: int) -> DataFrame:
    """file, data: the records (page_id, rec) of ``per_file`` pages, in order."""
    n = F.floor(F.col("page_id") / per_file).cast("bigint")
    one = rows.groupBy(n.alias("n")).agg(F.sort_array(F.collect_list(F.struct("page_id", "rec"))).alias("recs"))
    data = F.aggregate("recs", F.lit(b""), lambda a, r: F.concat(a, r["rec"]))
    return one.select(F.format_string("part-%06d.warc", "n").alias("path"), data.alias("content"))


@query("warc_rejects", sql="""
SELECT 'part-' || lpad(CAST(page_id // 50 AS VARCHAR), 6, '0') || '.warc' AS file,
       count(*) FILTER (page_id % 10 NOT IN (3, 7)) AS records, count(*) FILTER (page_id % 10 = 3) AS without_length,
       count(*) FILTER (page_id % 10 = 7) AS rejects
FROM pages GROUP BY 1
""")
def q_warc_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 and P3 on plain files with broken records: a length that is no number
    skips one record; a first line that is none gives a reject row."""
    from capstan.sinks.blobdir import write_blobs

    p = table(spark, sf_dir, "pages").select("page_id", "url", http_message().alias("m"))
    length = F.when(_m(10) == 3, F.lit("abc")).otherwise(F.octet_length("m").cast("string"))
    first = F.when(_m(10) == 7, F.lit("WORC/1.0")).otherwise(F.lit("WARC/1.0"))
    path = scratch_path(spark, "broken")
    write_blobs(_joined(p.select("page_id", plain_record(length, first, F.col("url"), F.col("m")).alias("rec")), 50), path)
    r = warc.read_warc(spark, path, onError="reject")
    return r.groupBy(F.col("file_name").alias("file")).agg(
        F.count_if(F.col("error").isNull() & P.has_record_length(r)).alias("records"),
        F.count_if(F.col("error").isNull() & ~P.has_record_length(r)).alias("without_length"), F.count_if(F.col("error").isNotNull()).alias("rejects"))


@query("cdx_fetch_shared_member", sql="SELECT url, sha1(html) AS body_sha1, page_id % 40 = 39 AS missing FROM pages WHERE page_id % 40 <> 39"
       " UNION ALL SELECT NULL, NULL, true FROM pages WHERE page_id % 40 = 39")
def q_cdx_fetch_shared_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J7 where one gzip member (or one plain file) holds the records of 40
    pages: the URL tells which record an index row means, a size is not
    given, and rows that name a missing file come back with an error."""
    import gzip

    from capstan.sinks.blobdir import write_blobs
    from capstan.sources import cdx

    p = table(spark, sf_dir, "pages").select("page_id", "url", http_message().alias("m"))
    rec = plain_record(F.octet_length("m").cast("string"), F.lit("WARC/1.0"), F.concat("url", F.lit("#"), F.col("page_id").cast("string")), F.col("m"))
    joined = _joined(p.select("page_id", rec.alias("rec")), 40)

    def pack(parts):
        import pyarrow as pa

        for b in parts:
            yield pa.RecordBatch.from_arrays([b.column("path"), pa.array([gzip.compress(x, mtime=0) for x in b.column("content").to_pylist()], pa.binary())],
                                             ["path", "content"])

    path = scratch_path(spark, "shared-member")
    write_blobs(joined.mapInArrow(pack, "path string, content binary"), path)
    name = F.format_string("part-%06d.warc", F.floor(F.col("page_id") / 40).cast("bigint"))
    index = p.select(F.concat("url", F.lit("#"), F.col("page_id").cast("string")).alias("url"),
                     F.when(_m(40) == 39, F.lit("no-such-file.warc.gz")).otherwise(name).alias("filename"),
                     F.lit(0).cast("bigint").alias("compressed_offset"), F.lit(None).cast("bigint").alias("compressed_record_size"))
    got = cdx.fetch(index, path)
    h = http.split_http(F.col("payload"))
    return got.select(F.regexp_replace("target_uri", "#[0-9]+$", "").alias("url"), F.sha1(http.body(F.col("payload"), h)).alias("body_sha1"),
                      F.col("error").isNotNull().alias("missing"))


@query("warc_chunked_bodies", sql="SELECT url AS uri, sha1(html) AS body_sha1 FROM pages")
def q_warc_chunked_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 on chunked responses: the hash is that of the body without framing."""
    html = F.encode("html", "UTF-8")
    n = F.octet_length(html)
    size = lambda c: F.encode(F.concat(F.lower(F.hex(c.cast("bigint"))), F.lit(CRLF)), "UTF-8")
    crlf = F.encode(F.lit(CRLF), "UTF-8")
    cut = F.floor(n / 2).cast("int")
    first, second = F.substring(html, F.lit(1), cut), F.substring(html, cut + 1, n)
    chunk = lambda data: F.when(F.octet_length(data) > 0, F.concat(size(F.octet_length(data)), data, crlf)).otherwise(F.lit(b""))
    head = F.encode(F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html" + CRLF + "Transfer-Encoding: chunked" + CRLF * 2), "UTF-8")
    rows = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("chunked-"), capture_number().cast("string")).alias("warc_file"), F.col("page_id").alias("record_idx"),
        F.lit("response").alias("warc_type"), F.lit(None).cast("string").alias("record_id"), F.lit(RECORD_DATE).alias("record_date"),
        F.col("url").alias("target_uri"), F.lit(RESPONSE_CT).alias("content_type"),
        F.concat(head, chunk(first), chunk(second), F.encode(F.lit("0" + CRLF * 2), "UTF-8")).alias("payload"))
    path = scratch_path(spark, "chunked")
    warc.write_warc(rows, path)
    return R.responses(warc.read_warc(spark, path)).select("uri", F.sha1("body").alias("body_sha1"))


@query("warc_chunked_errors", sql="""
SELECT url AS uri, CASE page_id % 6 WHEN 0 THEN 'chunked: bad chunk size b''-6''' WHEN 1 THEN 'chunked: no last chunk' WHEN 2 THEN 'chunked: cut chunk'
                                    WHEN 3 THEN 'chunked: no line end after a chunk' END AS error,
       CASE WHEN page_id % 6 > 3 THEN sha1(html) END AS body_sha1
FROM pages
""")
def q_warc_chunked_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 on chunked responses with broken framing: an error and no body."""
    raw = lambda text: F.encode(F.lit(text), "UTF-8")
    html, crlf, end = F.encode("html", "UTF-8"), raw(CRLF), raw("0" + CRLF * 2)
    size = lambda c: F.encode(F.concat(F.hex(c.cast("bigint")), F.lit(CRLF)), "UTF-8")
    n = F.octet_length(html)
    body = (F.when(_m(6) == 0, F.concat(raw("-6" + CRLF), html, crlf, end))
            .when(_m(6) == 1, F.concat(size(n), html, crlf)).when(_m(6) == 2, F.concat(size(n + 1), html))
            .when(_m(6) == 3, F.concat(size(n), html, end)).otherwise(F.concat(size(n), html, crlf, end)))
    head = raw("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html" + CRLF + "Transfer-Encoding: chunked" + CRLF * 2)
    rows = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("broken-"), capture_number().cast("string")).alias("warc_file"), F.col("page_id").alias("record_idx"),
        F.lit("response").alias("warc_type"), F.lit(None).cast("string").alias("record_id"), F.lit(RECORD_DATE).alias("record_date"),
        F.col("url").alias("target_uri"), F.lit(RESPONSE_CT).alias("content_type"), F.concat(head, body).alias("payload"))
    path = scratch_path(spark, "chunked")
    warc.write_warc(rows, path)
    read = warc.read_warc(spark, path)
    bodies = R.responses(read.where("error IS NULL")).select("uri", F.lit(None).cast("string").alias("error"), F.sha1("body").alias("body_sha1"))
    return bodies.union(read.where("error IS NOT NULL").select("target_uri", "error", F.lit(None).cast("string")))


@query("warc_split", sql="""
SELECT page_id // 1000 AS capture, count(*) AS records, CAST(sum(strlen(html)) AS BIGINT) AS bytes, min(page_id) AS first, max(page_id) AS last
FROM pages GROUP BY 1
""")
def q_warc_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 with every file read by several tasks: one record a page, the ranges
    of a file checked against each other."""
    path = scratch_path(spark, "split")
    rows = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("split-"), capture_number().cast("string")).alias("warc_file"), F.col("page_id").alias("record_idx"),
        F.lit("resource").alias("warc_type"), F.lit(None).cast("string").alias("record_id"), F.lit(RECORD_DATE).alias("record_date"),
        F.col("page_id").cast("string").alias("target_uri"), F.lit("text/html").alias("content_type"), F.encode("html", "UTF-8").alias("payload"))
    warc.write_warc(rows, path)
    got = warc.read_warc(spark, path, split_bytes=64 << 10)
    page = F.col("target_uri").cast("bigint")
    return got.groupBy(F.regexp_extract("warc_file", "([0-9]+)$", 1).cast("bigint").alias("capture")).agg(
        F.count("*").alias("records"), F.sum(F.octet_length("payload")).cast("bigint").alias("bytes"), F.min(page).alias("first"), F.max(page).alias("last"))


@query("backfill_plan", sql="WITH " + CDX_SQL + """,
""" + """arr AS (SELECT page_id, url, html FROM pages
        UNION ALL SELECT page_id, url, html FROM pages WHERE page_id % 8 = 1),
um AS (SELECT coalesce(nullif(CASE WHEN page_id % 3 = 0 THEN '' ELSE url END, ''),
                       nullif(CASE WHEN page_id % 6 = 0 THEN '' ELSE url || '#via-crawler' END, '')) AS url
       FROM arr)
SELECT filename, count(*) AS records, CAST(sum(compressed_record_size) AS BIGINT) AS bytes
FROM cdx WHERE url NOT IN (SELECT url FROM um WHERE url IS NOT NULL) GROUP BY filename
""")
def q_backfill_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from capstan.operators.backfill import backfill_plan
    from capstan.plans.spool import url_map_table
    from capstan.sources import cdx

    p = cdx.read_cdx(spark, cdx_files(spark, sf_dir))
    index = p.where(F.col("reason").isNull())
    return backfill_plan(index, url_map_table(spark, sf_dir))


# ------------------------------------------------------------------ items

def item_json_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item metadata documents: item ``item-{page_id div 10}`` holds the files
    of its ten pages, named ``.warc.gz`` for even and ``.cdx.gz`` for odd
    page ids."""
    p = table(spark, sf_dir, "pages").select("page_id", "html")
    ident = F.concat(F.lit("item-"), F.floor(F.col("page_id") / 10).cast("string"))
    name = F.concat(F.lit("crawl-"), F.lpad(F.col("page_id").cast("string"), 6, "0"),
                    F.when(_m(2) == 0, F.lit(".warc.gz")).otherwise(F.lit(".cdx.gz")))
    f = p.select(ident.alias("identifier"), F.col("page_id"), F.struct(
        F.lit("0").alias("crc32"), F.lit("Web ARChive GZ").alias("format"),
        F.md5(F.encode("html", "UTF-8")).alias("md5"), F.lit("1704067200").alias("mtime"),
        name.alias("name"), F.lit("original").alias("source"),
        F.octet_length(F.encode("html", "UTF-8")).cast("string").alias("size"),
    ).alias("file"))
    items = f.groupBy("identifier").agg(
        F.sort_array(F.collect_list(F.struct("page_id", "file"))).alias("fs"))
    doc = items.select(F.struct(
        F.lit(1704067200).alias("created"), F.lit("ia800000.example.org").alias("d1"),
        F.concat(F.lit("/items/"), F.col("identifier")).alias("dir"),
        F.transform("fs", lambda x: x["file"]).alias("files"),
        F.size("fs").alias("files_count"),
        F.struct(F.col("identifier").alias("identifier"), F.array(F.lit("test-collection")).alias("collection"),
                 F.lit("web").alias("mediatype")).alias("metadata"),
        F.lit("ia800000.example.org").alias("server"),
    ).alias("d"))
    return doc.select(F.to_json("d").alias("value"))


def item_files_path(spark: SparkSession, sf_dir: str) -> str:
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir) + "#items")
    path = _WRITTEN.get(key)
    if path is None or not fsio.exists(path):
        path = scratch_path(spark, "items")
        item_json_rows(spark, sf_dir).write.mode("overwrite").text(path)
        _WRITTEN[key] = path
    return path


@query("item_files", sql="""
SELECT 'item-' || CAST(page_id // 10 AS VARCHAR) AS identifier,
       'https://archive.org/download/item-' || CAST(page_id // 10 AS VARCHAR) || '/crawl-' || lpad(CAST(page_id AS VARCHAR), 6, '0') || '.warc.gz' AS file_url
FROM pages WHERE page_id % 2 = 0
""")
def q_item_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from capstan.sources import items

    return items.item_files(items.read_items(spark, item_files_path(spark, sf_dir))).select("identifier", "file_url")


@query("item_counts", sql="""
WITH f AS (SELECT page_id // 10 AS item, page_id,
                  row_number() OVER (PARTITION BY page_id // 10 ORDER BY page_id) AS position,
                  count(*) OVER (PARTITION BY page_id // 10) AS total,
                  count(*) FILTER (WHERE page_id % 2 = 0) OVER (PARTITION BY page_id // 10) AS files
           FROM pages)
SELECT 'item-' || CAST(item AS VARCHAR) AS identifier, position, total, files FROM f WHERE page_id % 2 = 0
""")
def q_item_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from capstan.sources import items

    return items.item_files(items.read_items(spark, item_files_path(spark, sf_dir))).select(
        "identifier", "position", "total", "files")


ITEMS_PER_PAGE = 7


def search_page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search result pages over the item identifiers, seven per page in item
    order; the last page has an empty cursor, and one more page after it
    (which must not be read) names a ghost item."""
    p = table(spark, sf_dir, "pages").select(F.floor(F.col("page_id") / 10).alias("item")).distinct()
    p = p.withColumn("page_no", F.floor(F.col("item") / ITEMS_PER_PAGE))
    per = p.groupBy("page_no").agg(
        F.sort_array(F.collect_list("item")).alias("its"))
    last = per.agg(F.max("page_no").alias("m")).scalar()
    pages = per.select(
        "page_no",
        F.transform("its", lambda i: F.struct(F.concat(F.lit("item-"), i.cast("string")).alias("identifier"))).alias("items"),
        F.size("its").alias("count"),
        F.when(F.col("page_no") == last, F.lit("")).otherwise(
            F.concat(F.lit("c"), (F.col("page_no") + 1).cast("string"))).alias("cursor"),
    )
    ghost = spark.range(1).select(
        (last + 1).alias("page_no"), F.array(F.struct(F.lit("item-ghost").alias("identifier"))).alias("items"),
        F.lit(1).alias("count"), F.lit("cX").alias("cursor"))
    both = pages.unionByName(ghost)
    return both.select(F.to_json(F.struct("page_no", "items", "count", "cursor")).alias("value"))


@query("collection_items", sql="""
SELECT DISTINCT 'item-' || CAST(page_id // 10 AS VARCHAR) AS identifier FROM pages
""")
def q_collection_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    from capstan.sources import items

    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir) + "#search")
    path = _WRITTEN.get(key)
    if path is None or not fsio.exists(path):
        path = scratch_path(spark, "search")
        search_page_rows(spark, sf_dir).write.mode("overwrite").text(path)
        _WRITTEN[key] = path
    return items.collection_items(items.read_search_pages(spark, path)).select("identifier")


@query("item_ids", sql="""
WITH x AS (SELECT page_id, 'item-' || CAST(page_id % 10 AS VARCHAR) AS ident FROM pages)
SELECT page_id,
  CASE page_id % 4 WHEN 0 THEN 'https://archive.org/details/' || ident WHEN 1 THEN ident
                   WHEN 2 THEN 'http://archive.org/download/' || ident || '/file.warc.gz'
                   ELSE 'https://archive.org/details/' || ident || '/' END AS input,
  CASE page_id % 4 WHEN 2 THEN 'file.warc.gz' ELSE ident END AS item_id
FROM x
""")
def q_item_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from capstan.functions.ids import item_id

    p = table(spark, sf_dir, "pages").select("page_id")
    ident = F.concat(F.lit("item-"), _m(10).cast("string"))
    inp = (
        F.when(_m(4) == 0, F.concat(F.lit("https://archive.org/details/"), ident))
        .when(_m(4) == 1, ident)
        .when(_m(4) == 2, F.concat(F.lit("http://archive.org/download/"), ident, F.lit("/file.warc.gz")))
        .otherwise(F.concat(F.lit("https://archive.org/details/"), ident, F.lit("/")))
    )
    x = p.select("page_id", inp.alias("input"))
    return x.select("page_id", "input", item_id(F.col("input")).alias("item_id"))


@query("collection_counts", sql="""
SELECT 'test-collection' AS collection, count(DISTINCT page_id // 10) AS items FROM pages
""")
def q_collection_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from capstan.sources import items

    return items.items_per_collection(items.read_items(spark, item_files_path(spark, sf_dir)))
