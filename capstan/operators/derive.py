"""Per-document derivation: the extraction status machine (D5) and the hook
for a user-supplied extractor (X6, D1, D2, D4, D6, D7).

An extractor is described by outcome columns:

* ``text`` / ``text_err``        -- full text, or an error message
* ``thumbnail`` / ``thumb_err``  -- first-page image bytes, or an error
* ``metadata`` / ``meta_err``    -- parsed report struct, or an error
* ``read_err``                   -- the bytes could not be read

``extract`` turns them into one result row per blob with a status, in the
order the reference checks them; failures are rows, never exceptions (D7).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from capstan.functions.mime import detect_mimetype
from capstan.functions.links import weblinks
from capstan.functions.report import legacy_extra
from capstan.operators.joins import flag_membership

MIN_THUMBNAIL = 50  # fixed value: smaller images are taken as failures
PDF = "application/pdf"
TOO_LARGE = "too-large"


def with_fileinfo(blobs: DataFrame, content: str = "content") -> DataFrame:
    """Add ``sha1hex``, ``mimetype`` and the ``fileinfo`` struct (F1).

    SHA-1 and type are columns of their own and the struct is built from
    them, so a plan that never outputs ``fileinfo`` does not compute MD5 and
    SHA-256 (column pruning removes them)."""
    c = F.col(content)
    d = blobs.withColumn("sha1hex", F.sha1(c)).withColumn("mimetype", detect_mimetype(c))
    return d.withColumn("fileinfo", F.struct(
        F.octet_length(c).cast("bigint").alias("size"), F.md5(c).alias("md5hex"),
        F.col("sha1hex"), F.sha2(c, 256).alias("sha256hex"), F.col("mimetype"),
    ))


def gate(blobs: DataFrame, blocklist: DataFrame | None) -> DataFrame:
    """Cheap gates before any extractor runs: type (P18) and blocklist."""
    df = with_fileinfo(blobs) if "fileinfo" not in blobs.columns else blobs
    if blocklist is None:
        df = df.withColumn("blocked", F.lit(False))
    else:
        df = flag_membership(df, blocklist.select(F.col(blocklist.columns[0]).alias("sha1hex")),
                             "sha1hex", "blocked")
    return df.withColumn("is_pdf", F.col("mimetype") == F.lit(PDF))


def status_of(df: DataFrame) -> Column:
    """First match wins."""
    return (
        F.when(F.col("read_err").isNotNull(), F.lit(""))
        .when(~F.col("is_pdf"), F.lit("not-pdf"))
        .when(F.col("blocked"), F.lit("bad-pdf"))
        .when(F.col("text_err").isNotNull(), F.lit("parse-error"))
        .when(F.octet_length(F.coalesce(F.col("text"), F.lit(""))) == 0, F.lit("empty-pdf"))
        .when(F.col("thumb_err").isNotNull(), F.lit("parse-error"))
        .when(F.col("meta_err").isNotNull(), F.lit("parse-error"))
        .otherwise(F.lit("success"))
    )


def error_of() -> Column:
    return (
        F.when(F.col("read_err").isNotNull(), F.col("read_err"))
        .when(~F.col("is_pdf"), F.concat(F.lit("mimetype is "), F.col("mimetype")))
        .when(F.col("blocked"), F.lit("PDF known to cause processing issues"))
        .when(F.col("text_err").isNotNull(), F.concat(F.lit("text extraction failed: "), F.col("text_err")))
        .when(F.octet_length(F.coalesce(F.col("text"), F.lit(""))) == 0, F.lit("zero length text"))
        .when(F.col("thumb_err").isNotNull(),
              F.concat(F.lit("thumbnail extraction failed with: "), F.col("thumb_err")))
        .when(F.col("meta_err").isNotNull(),
              F.concat(F.lit("pdf info extraction failed with: "), F.col("meta_err")))
    )


OUTCOME_DEFAULTS = {
    "read_err": T.StringType(),
    "text": T.StringType(),
    "text_err": T.StringType(),
    "thumbnail": T.BinaryType(),
    "thumb_err": T.StringType(),
    "meta_err": T.StringType(),
}


def extract(outcomes: DataFrame) -> DataFrame:
    """Result rows (M9) from gated blobs that carry outcome columns.

    ``fileinfo`` is kept only where the reference keeps it (not for
    parse errors and empty text); a thumbnail under 50 bytes is dropped, and
    ``thumb_note`` says so.
    """
    df = outcomes
    for name, typ in OUTCOME_DEFAULTS.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(typ))
    if "metadata" not in df.columns:
        df = df.withColumn("metadata", F.lit(None))
    status = status_of(df)
    df = df.withColumn("status", status).withColumn("err", error_of())
    ok = F.col("status") == F.lit("success")
    keep_info = ~F.col("status").isin("parse-error", "empty-pdf")
    large = F.octet_length(F.col("thumbnail")) >= MIN_THUMBNAIL
    thumb = F.when(ok & large, F.col("thumbnail"))
    thumb_note = F.when(ok & ~large, F.lit("thumbnail below 50 bytes"))
    extra = legacy_extra(F.col("metadata")) if _has_info(df) else F.lit(None)
    return (
        df.withColumn("fileinfo", F.when(keep_info, F.col("fileinfo")))
        .withColumn("text", F.when(ok, F.col("text")))
        .withColumn("page0thumbnail", thumb)
        .withColumn("thumb_note", thumb_note)
        .withColumn("metadata", F.when(ok, F.col("metadata")))
        .withColumn("pdfextra", F.when(ok, extra))
        .withColumn("weblinks", F.when(ok, weblinks(F.col("text"))))
        .drop("thumbnail", "read_err", "text_err", "thumb_err", "meta_err", "is_pdf", "blocked", "mimetype")
    )


def _has_info(df: DataFrame) -> bool:
    dt = df.schema["metadata"].dataType
    return isinstance(dt, T.StructType) and "page_size" in dt.fieldNames()


def has_thumbnail_to_store(result: DataFrame) -> Column:
    """Stored only when strictly larger than 50 bytes."""
    return F.octet_length(result["page0thumbnail"]) > MIN_THUMBNAIL


# --------------------------------------------------------------------------
# User-supplied extractor hook (X6): a Python function over pandas batches.

HOOK_SCHEMA = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("text_err", T.StringType()),
        T.StructField("thumbnail", T.BinaryType()),
        T.StructField("thumb_err", T.StringType()),
        T.StructField("meta_report", T.StringType()),
        T.StructField("pdfcpu_report", T.StringType()),
        T.StructField("meta_err", T.StringType()),
    ]
)


class ExtractorError(Exception):
    """An exception raised by the extractor in a child process."""


def _call_in_process(fn: Callable[[bytes], dict], blob: bytes, timeout_s: float | None) -> dict:
    """Run ``fn(blob)`` in a forked child; terminate it when the time limit
    passes (a hung external program does not outlive its document)."""
    import multiprocessing as mp

    ctx = mp.get_context("fork")
    recv, send = ctx.Pipe(duplex=False)

    def child():
        try:
            send.send(("ok", fn(blob)))
        except BaseException as exc:  # reported to the parent as a value
            send.send(("err", f"{type(exc).__name__}: {exc}"))
        finally:
            send.close()

    proc = ctx.Process(target=child, daemon=True)
    proc.start()
    send.close()
    try:
        if not recv.poll(timeout_s):
            raise TimeoutError
        kind, value = recv.recv()
    except (TimeoutError, EOFError):
        proc.terminate()
        proc.join(5)
        if proc.is_alive():
            proc.kill()
        proc.join()
        raise TimeoutError from None
    finally:
        recv.close()
    proc.join()
    if kind == "err":
        raise ExtractorError(value)
    return value


def run_extractor(gated: DataFrame, fn: Callable[[bytes], dict],
                  timeout_s: float | None = 300.0, content: str = "content",
                  isolation: str = "thread") -> DataFrame:
    """Apply ``fn(bytes) -> dict`` (keys of ``HOOK_SCHEMA``) to rows that
    passed the cheap gates; other rows get null outcomes.

    One ``mapInPandas`` pass over the gated rows, no shuffle: the gate
    columns are computed on the JVM first (Catalyst cannot push a filter
    through ``mapInPandas``), the function is called only for PDF rows that
    are not blocklisted, and the content is dropped from the output.  A
    per-document time limit (D6) turns an overrun into ``text_err``; any
    exception becomes an error value (D7).  ``isolation="process"`` runs
    each document in a forked child that is terminated at the time limit;
    ``"thread"`` (default, cheaper) abandons an overrunning call.
    """
    # rejected documents send no bytes to Python
    gated = gated.withColumn(content, F.when(F.col("is_pdf") & ~F.col("blocked"), F.col(content)))
    keep = [f for f in gated.schema.fields if f.name != content]
    out_schema = T.StructType([*keep, *HOOK_SCHEMA.fields])
    names = [f.name for f in HOOK_SCHEMA.fields]

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import concurrent.futures as cf

        pool = cf.ThreadPoolExecutor(max_workers=1)
        for pdf in batches:
            outs = {n: [] for n in names}
            for blob, is_pdf, blocked in zip(pdf[content], pdf["is_pdf"], pdf["blocked"]):
                res = dict.fromkeys(names)
                if is_pdf and not blocked:
                    data = bytes(blob) if blob is not None else b""
                    try:
                        if isolation == "process":
                            got = _call_in_process(fn, data, timeout_s) or {}
                        else:
                            got = pool.submit(fn, data).result(timeout=timeout_s) or {}
                        res.update({k: v for k, v in got.items() if k in res})
                    except (cf.TimeoutError, TimeoutError):
                        res["text_err"] = "timeout"
                        pool.shutdown(wait=False, cancel_futures=True)
                        pool = cf.ThreadPoolExecutor(max_workers=1)
                    except ExtractorError as exc:  # already "Type: message"
                        res["text_err"] = str(exc)
                    except Exception as exc:  # a failure is a row (D7)
                        res["text_err"] = f"{type(exc).__name__}: {exc}"
                for n in names:
                    outs[n].append(res[n])
            out = pdf.drop(columns=[content])
            for n in names:
                out[n] = outs[n]
            yield out

    return gated.mapInPandas(apply, out_schema)


def run_xml_extractor(result: DataFrame, fn: Callable[[bytes], bytes], blobs: DataFrame,
                      key: str, max_size: int = 256 * 1024 * 1024, content: str = "content") -> DataFrame:
    """Structured XML for successful documents not larger than
    ``max_size`` (P14); failures leave ``xml`` null with ``xml_err`` set, to
    ``too-large`` for a document beyond the limit.

    The size gate and the status filter run before the Python step; only
    (key, content) of eligible rows go to Python, and the output joins back
    on ``key``.
    """
    fits = F.octet_length(content) <= max_size
    eligible = result.where(F.col("status") == "success").select(key).join(
        blobs.select(key, F.when(fits, F.col(content)).alias(content)), key)
    schema = T.StructType([result.schema[key], T.StructField("xml", T.BinaryType()),
                           T.StructField("xml_err", T.StringType())])

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            xs, errs = [], []
            for blob in pdf[content]:
                if blob is None:
                    xs.append(None)
                    errs.append(TOO_LARGE)
                    continue
                try:
                    xs.append(fn(bytes(blob)))
                    errs.append(None)
                except Exception as exc:  # a failure is a row (D7)
                    xs.append(None)
                    errs.append(f"{type(exc).__name__}: {exc}")
            yield pd.DataFrame({key: pdf[key], "xml": xs, "xml_err": errs})

    return result.join(eligible.mapInPandas(apply, schema), key, "left")
