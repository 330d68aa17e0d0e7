"""Archive records to HTTP responses (P1-P4, F13) and what is done with
them: capture log (K6), sink fan-out (J6), per-file counts (A3), export
names (K10, F19, W1, W3), staging for intake (K11)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capstan.functions import http
from capstan.functions.paths import export_filename
from capstan.operators import filters as P
from capstan.operators.windows import running_number


def responses(records: DataFrame, keep_payload: bool = False) -> DataFrame:
    """Records that are HTTP responses, split into status, headers and body.

    P1, P2 and P3 run before the split; P4 after it.  The size is the
    declared Content-Length, -1 when unknown.
    """
    r = records.where(P.has_target_uri(records) & P.is_http_response_record(records)
                      & P.has_record_length(records))
    r = r.withColumn("_h", http.split_http(F.col("payload")))
    r = r.where(http.is_response(F.col("_h")))
    hdrs = F.col("_h.headers")
    out = r.select(
        *[c for c in records.columns if c != "payload" or keep_payload],
        F.col("target_uri").alias("uri"),
        F.col("_h.status_line").alias("status_line"),
        F.col("_h.status_code").alias("status_code"),
        http.headers_map(hdrs).alias("http_headers"),
        http.header(hdrs, "content-type").alias("http_content_type"),
        http.header(hdrs, "content-length").alias("http_content_length_raw"),
        http.declared_length(hdrs).alias("http_content_length"),
        http.body(F.col("payload"), F.col("_h")).alias("body"),
    )
    return out.withColumn("size", F.col("http_content_length"))


def capture_log(resp: DataFrame) -> DataFrame:
    """K6: status, size and URI of responses with status 200 (P10)."""
    return resp.where(P.status_ok(resp)).select("status_code", "size", "uri")


def stage_for_intake(resp: DataFrame) -> DataFrame:
    """K11 (re-aimed): captures as intake rows with URL and content type."""
    return resp.select(
        F.col("uri").alias("url"), F.col("http_content_type").alias("content_type"), "body",
        "status_code", F.col("size").alias("declared"),
        F.octet_length("body").cast("bigint").alias("size"),
        F.sha1("body").alias("sha1hex"),
    )


def fan_out_counts(resp: DataFrame, sinks: dict[str, Callable[[DataFrame], Column]]) -> DataFrame:
    """Every capture offered to every sink, in one pass.

    Each sink is a predicate on the capture; the counts for all sinks come
    from one aggregate (no cross join), unpivoted to one row per sink.
    """
    size = F.octet_length("body")
    aggs = []
    for name, pred in sinks.items():
        cond = pred(resp)
        aggs += [F.count_if(cond).cast("bigint").alias(f"{name}__n"),
                 F.coalesce(F.sum(F.when(cond, size)), F.lit(0)).cast("bigint").alias(f"{name}__b")]
    wide = resp.agg(*aggs)
    stack = ", ".join(f"'{n}', `{n}__n`, `{n}__b`" for n in sinks)
    return wide.selectExpr(f"stack({len(sinks)}, {stack}) AS (sink, captures, bytes)")


def file_counts(records: DataFrame) -> DataFrame:
    """A3: per capture file, records read and documents found."""
    return records.groupBy("warc_file").agg(
        F.count(F.lit(1)).cast("bigint").alias("records"),
        F.count_if(P.head_pdf(records)).cast("bigint").alias("pdfs"),
    )


def _number_in_order(batches):
    """W1 and W3 where a task sees whole files in record order: a counter and
    the names given so far, per file."""
    import pyarrow as pa

    at, last, n, given, done = None, None, 0, set(), set()
    for b in batches:
        numbers, first = [], []
        cols = (b.column(c).to_pylist() for c in ("warc_file", "record_idx", "last_segment"))
        for name, idx, segment in zip(*cols):
            if name != at:
                done.add(at)
                at, last, n, given = name, None, 0, set()
            if name in done or (last is not None and idx <= last):
                raise ValueError(f"records of {name} are not in order; use in_reader_order=False")
            last, n = idx, n + 1
            wanted = segment or f"pdf_{n:04d}.pdf"
            numbers.append(n)
            first.append(wanted not in given)
            given.add(wanted)
        yield pa.RecordBatch.from_arrays([b.column("warc_file"), b.column("record_idx"), b.column("uri"), pa.array(numbers, pa.int64()), pa.array(first, pa.bool_())],
                                         ["warc_file", "record_idx", "uri", "pdf_num", "is_first"])


def export_names(records: DataFrame, in_reader_order: bool = True) -> DataFrame:
    """Documents found by P9, numbered per file in record order (W1);
    named after the URL when it ends in .pdf (F19); a repeated name within
    a file keeps the first and numbers the rest (W3).

    ``records`` straight from the archive reader hold whole files in order in
    one task, so they are numbered there, without a shuffle; for any other
    table pass ``in_reader_order=False``."""
    docs = records.where(P.head_pdf(records)).select("warc_file", "record_idx", F.col("target_uri").alias("uri"))
    if in_reader_order:
        last = F.element_at(F.split(F.coalesce("uri", F.lit("")), "/"), -1)
        keyed = docs.withColumn("last_segment", F.when(F.endswith(F.lower(last), F.lit(".pdf")), last))
        got = keyed.mapInArrow(_number_in_order, "warc_file string, record_idx long, uri string, pdf_num long, is_first boolean")
        numbered = F.format_string("pdf_%04d.pdf", F.col("pdf_num"))
        return got.select("warc_file", "record_idx", "uri", "pdf_num",
                          export_filename(F.col("uri"), F.col("pdf_num")).alias("wanted"),
                          F.when(F.col("is_first"), export_filename(F.col("uri"), F.col("pdf_num"))).otherwise(numbered).alias("filename"))
    # The numbering reads its input several times; materialise the small key
    # table once (reliable checkpoint in the shared checkpoint folder) so the
    # archive files are scanned once.
    docs = docs.checkpoint(eager=True)
    docs = running_number(docs, ["warc_file"], "record_idx", "pdf_num")
    named = docs.withColumn("wanted", export_filename(F.col("uri"), F.col("pdf_num")))
    firsts = named.groupBy("warc_file", "wanted").agg(F.min("record_idx").alias("_first"))
    named = named.join(firsts, ["warc_file", "wanted"], "left")
    numbered = F.format_string("pdf_%04d.pdf", F.col("pdf_num"))
    return named.withColumn(
        "filename", F.when(F.col("record_idx") == F.col("_first"), F.col("wanted")).otherwise(numbered)
    ).drop("_first")


def write_exports(records: DataFrame, root: str) -> DataFrame:
    """Write the documents found by P9 as ``root/{warc_file}/{filename}``.

    Names are computed on key columns only; the bodies are joined to them on
    (warc_file, record_idx), one shuffle of the bodies.  The body is the
    payload after the header block (CRLFCRLF, else LFLF).
    """
    from capstan.sinks.blobdir import write_blobs

    names = export_names(records)
    bodies = records.where(P.head_pdf(records)).select(
        "warc_file", "record_idx", F.col("payload"), http.split_http(F.col("payload")).alias("_h"))
    bodies = bodies.select("warc_file", "record_idx",
                           http.after_header(F.col("payload"), F.col("_h")).alias("content"))
    out = names.join(bodies, ["warc_file", "record_idx"])
    write_blobs(out.select(F.concat_ws("/", "warc_file", "filename").alias("path"), "content"), root)
    return names
