"""End-to-end jobs: the reference's three flows composed from the operators.

* ``process_spool`` -- drain the spool (batch or, with ``stream=True``, a
  file stream with ``availableNow``): fingerprint, gate, run the extractor,
  store artifacts, write result rows and run statistics.
* ``extract_captures`` -- archive files -> HTTP responses -> filters ->
  sinks (content-addressed folder, plain folder, capture log, staged intake).
* ``intake_arrivals`` -- the ``serve`` flow as a stream: validate arrivals,
  skip / overwrite / insert against the spool, store accepted blobs.
* ``plan_backfill`` -- capture index minus URL map -> what to fetch.

Run as ``python -m capstan.jobs <job> ...`` (see ``--help``); the extractor is
given as ``module:function`` taking PDF bytes and returning a dict with
text / thumbnail / meta_report (and ``*_err`` on failure).
"""

from __future__ import annotations

import argparse
import importlib
import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from capstan.functions.report import parse_pdfcpu, with_info
from capstan.operators import artifacts, derive, stats
from capstan.operators import filters as P
from capstan.operators import responses as R
from capstan.sinks.blobdir import write_blobs
from capstan.sinks.hashdir import write_dir_export, write_hashdir
from capstan.sinks.results import to_result_json
from capstan.sources import cdx, fsio, warc
from capstan.sources.blocklist import default_blocklist
from capstan.sources.spool import list_spool, read_blocklist, read_spool
from capstan.streaming import drain


METRICS = "processed bigint, ok bigint"  # one row per batch, observed while its status is written


def _extract(blobs: DataFrame, extractor: Callable[[bytes], dict], blocklist: DataFrame | None,
             timeout_s: float, isolation: str = "thread") -> DataFrame:
    """Gate, extractor and status.  The bytes stay in the split that read
    them; the size of a split is the session's ``spark.sql.files`` setting."""
    out = derive.run_extractor(derive.gate(blobs, blocklist), extractor, timeout_s=timeout_s, isolation=isolation)
    out = with_info(out, F.col("meta_report"), "metadata")
    both = F.col("metadata").withField("pdfcpu", parse_pdfcpu(F.col("pdfcpu_report")))
    return derive.extract(out.withColumn("metadata", both).drop("meta_report", "pdfcpu_report"))


def store_artifacts(result: DataFrame, root: str) -> DataFrame:
    """K3/K5: write every artifact to ``root/{bucket}/{object_path}``.

    Keys are content addresses of the source document, so a second write
    of a key (a copy, a retry) writes the same bytes; no shuffle is needed.
    """
    rows = artifacts.fan_out(result, order="path")
    write_blobs(rows.select(F.concat_ws("/", "bucket", "object_path").alias("path"), "content"), root)
    return rows.drop("content")


def _process_batch(blobs: DataFrame, out: str, extractor, blocklist, timeout_s: float, tag: str,
                   isolation: str = "thread", xml_extractor=None, max_xml_size: int = 256 << 20) -> None:
    result = _extract(blobs, extractor, blocklist, timeout_s, isolation=isolation)
    if xml_extractor is not None:
        result = derive.run_xml_extractor(result, xml_extractor, blobs, "path", max_xml_size)
    # the extractor is the cost: its results go to a table once, and every output reads that
    kept = os.path.join(out, "extracted", tag)
    result.write.mode("overwrite").parquet(kept)
    result = blobs.sparkSession.read.schema(result.schema).parquet(kept)
    store_artifacts(result, os.path.join(out, "artifacts"))
    to_result_json(result, key="path").select("json").write.mode("overwrite").text(
        os.path.join(out, "results", tag))
    status, seen = stats.observed(result.select("path", "sha1hex", "status", "err"))
    status.write.mode("overwrite").parquet(os.path.join(out, "status", tag))
    totals = blobs.sparkSession.createDataFrame([(seen.get["processed"], seen.get["ok"])], METRICS)
    totals.coalesce(1).write.mode("overwrite").parquet(os.path.join(out, "metrics", tag))


def _remove(paths: DataFrame) -> DataFrame:
    """T2 for the batch run: remove the files of ``path``, one row per file."""
    def run(batches):
        for b in batches:
            for path in b.column("path").to_pylist():
                fsio.remove(path)
            yield b

    return paths.mapInArrow(run, "path string")


def process_spool(spark: SparkSession, spool_dir: str, out: str, extractor: Callable[[bytes], dict],
                  blocklist_path: str | None = None, timeout_s: float = 300.0, stream: bool = False,
                  max_files: int = 1000, remove_processed: bool = False,
                  isolation: str = "thread", xml_extractor: Callable[[bytes], bytes] | None = None) -> DataFrame:
    """The ``run`` flow.  Returns run statistics (A1) over everything written
    to ``out/status``, from metrics observed while it was written.

    The default blocklist always applies; ``blocklist_path`` adds to it.  With
    ``xml_extractor`` the structured XML (D4) is stored as an artifact too.
    ``remove_processed`` removes the spool files whose results are written.
    """
    blocklist = default_blocklist(spark)
    if blocklist_path:
        blocklist = blocklist.union(read_blocklist(spark, blocklist_path)).distinct()
    if not stream:
        blobs = read_spool(spark, spool_dir).select("path", "content")
        _process_batch(blobs, out, extractor, blocklist, timeout_s, "batch=0", isolation, xml_extractor)
        if remove_processed:
            _remove(spark.read.parquet(os.path.join(out, "status", "batch=0")).select("path")).write.mode(
                "overwrite").parquet(os.path.join(out, "removed", "batch=0"))
    else:
        s = drain.spool_stream(spark, spool_dir, max_files=max_files,
                               clean_source="delete" if remove_processed else "off")

        def each(batch: DataFrame, batch_id: int) -> None:
            _process_batch(batch.select("path", "content"), out, extractor, blocklist, timeout_s,
                           f"batch={batch_id}", isolation, xml_extractor)

        q = (s.writeStream.foreachBatch(each).option("checkpointLocation", os.path.join(out, "_checkpoint"))
             .trigger(availableNow=True).start())
        q.awaitTermination()
    return stats.of_metrics(spark.read.schema(METRICS).parquet(os.path.join(out, "metrics")))


SINK_NAMES = ("hashdir", "dir", "log", "intake")


def extract_captures(spark: SparkSession, warc_path: str, out: str, sinks: tuple[str, ...] = ("hashdir",),
                     pdf_only: bool = True, nonzero_length: bool = True, extension: str = ".pdf") -> dict:
    """The ``blobfetch`` flow: records -> responses -> filters -> sinks.

    With more than one sink the filtered responses are written to a table
    once and offered to every sink (J6).  Returns per-sink counts.
    """
    flt = ([P.pdf_response] if pdf_only else []) + ([P.nonzero_content_length] if nonzero_length else [])
    resp = P.apply(R.responses(warc.read_warc(spark, warc_path)), flt)
    if len(sinks) > 1:  # filtered once; later sinks read the table, not the archives
        kept = os.path.join(out, "filtered")
        resp.write.mode("overwrite").parquet(kept)
        resp = spark.read.schema(resp.schema).parquet(kept)
    counts = {}
    for name in sinks:
        seen = Observation()  # rows are counted by the write itself
        rows = resp.observe(seen, F.count(F.lit(1)).alias("n"))
        if name == "hashdir":
            write_hashdir(rows.select(F.col("body").alias("content")), os.path.join(out, "hashdir"), ext=extension)
        elif name == "dir":
            write_dir_export(rows, os.path.join(out, "dir"), content="body", size="size", extension=extension)
        elif name == "log":
            R.capture_log(rows).write.mode("overwrite").json(os.path.join(out, "log"))
        elif name == "intake":
            R.stage_for_intake(rows).write.mode("append").parquet(os.path.join(out, "intake"))
        else:
            raise ValueError(f"unknown sink {name}; choose from {SINK_NAMES}")
        counts[name] = seen.get["n"]
    return counts


def intake_arrivals(spark: SparkSession, arrivals_dir: str, spool_dir: str, tables: str,
                    max_size: int = 0, max_files: int = 100_000, remove_arrived: bool = False,
                    has_space=None, urls: DataFrame | None = None, max_bytes: int = 8 << 30,
                    min_free_percent: int = 0) -> DataFrame:
    """The ``serve`` flow as a stream over an arrivals folder: validate,
    de-duplicate against the spool, store accepted blobs content-addressed,
    record spool rows, URL map and rejects.  Returns the actions so far.

    The arrivals come from their own source (``streaming/arrivals.py``): empty
    and too large files are rows of the stream with their answer, a micro-batch
    is admitted by bytes and files, and with ``min_free_percent`` an admission
    is answered 429 while the spool's file system has less free space; its files
    are offered again by the next run.  ``has_space`` is any other probe, called
    once a micro-batch; files it turns away are recorded and not offered again.

    ``urls`` (name, url) gives the URL of an arrival by its file name (the
    request headers of the service), joined once when the arrivals are planned;
    accepted arrivals with one get a URL-map row.  ``remove_arrived`` deletes what this run answered for good.
    """
    from capstan.streaming import arrivals
    from capstan.streaming.intake import spool_intake_writer

    log = os.path.join(tables, "_arrivals")
    since = arrivals.taken(log)["n"]
    arrivals.announce(spark, arrivals_dir, log, max_bytes=max_bytes, max_files=max_files, urls=urls)
    s = arrivals.arrivals_stream(spark, log, max_size, min_free_percent, spool_dir if min_free_percent > 0 else None,
                                 with_urls=urls is not None)
    s = s.select("path", "length", "content", "code", F.sha1("content").alias("sha1hex"),
                 F.octet_length("content").cast("bigint").alias("size"), *(["url"] if urls is not None else []))
    arrivals.drain(s, spool_intake_writer(spool_dir, tables, max_size, has_space), os.path.join(tables, "_checkpoint"))
    if remove_arrived and has_space is None:
        arrivals.remove_answered(spark, log, since)
    actions = os.path.join(tables, "actions")
    if not fsio.exists(actions):
        return spark.createDataFrame([], "path string, sha1hex string, action string, code int, batch int")
    return spark.read.parquet(actions)


def plan_backfill(spark: SparkSession, cdx_path: str, url_map_path: str) -> DataFrame:
    """Index records whose URL has no entry in the URL map."""
    from capstan.operators.backfill import backfill_plan

    index = cdx.read_cdx(spark, cdx_path).where(F.col("reason").isNull())
    return backfill_plan(index, spark.read.parquet(url_map_path))


def _load(spec: str) -> Callable:
    mod, _, fn = spec.partition(":")
    return getattr(importlib.import_module(mod), fn)


def main(argv: list[str] | None = None) -> None:
    from capstan.session import get_spark

    ap = argparse.ArgumentParser(prog="capstan.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    r = sub.add_parser("run", help="process the spool")
    r.add_argument("--spool", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--extractor", required=True, help="module:function")
    r.add_argument("--blocklist")
    r.add_argument("--timeout", type=float, default=300.0)
    r.add_argument("--stream", action="store_true")
    r.add_argument("--max-files", type=int, default=1000)
    r.add_argument("--remove", action="store_true")
    r.add_argument("--isolate", action="store_true", help="one process per document, killed at the time limit")
    f = sub.add_parser("fetch", help="extract captures from archive files")
    f.add_argument("--warc", required=True)
    f.add_argument("--out", required=True)
    f.add_argument("--sink", action="append", choices=SINK_NAMES)
    f.add_argument("--all-types", action="store_true")
    i = sub.add_parser("intake", help="take arrivals into the spool (stream, availableNow)")
    i.add_argument("--arrivals", required=True)
    i.add_argument("--spool", required=True)
    i.add_argument("--tables", required=True)
    i.add_argument("--max-size", type=int, default=0)
    i.add_argument("--remove", action="store_true")
    i.add_argument("--min-free-percent", type=int, default=0,
                   help="answer 429 while the spool's file system has less free space (local mounts)")
    b = sub.add_parser("backfill", help="plan fetches for index records without an artifact")
    b.add_argument("--cdx", required=True)
    b.add_argument("--url-map", required=True)
    b.add_argument("--out", help="write the plan as JSON lines instead of printing it")
    a = ap.parse_args(argv)
    spark = get_spark()
    if a.job == "run":
        res = process_spool(spark, a.spool, a.out, _load(a.extractor), a.blocklist, a.timeout, a.stream,
                            a.max_files, a.remove, "process" if a.isolate else "thread")
        print(json.dumps(res.first().asDict()))
    elif a.job == "intake":
        acts = intake_arrivals(spark, a.arrivals, a.spool, a.tables, a.max_size, remove_arrived=a.remove,
                               min_free_percent=a.min_free_percent)
        for row in acts.groupBy("action", "code").count().collect():  # a handful of rows
            print(json.dumps(row.asDict()))
    elif a.job == "fetch":
        print(json.dumps(extract_captures(spark, a.warc, a.out, tuple(a.sink or ["hashdir"]),
                                          pdf_only=not a.all_types)))
    else:
        plan = plan_backfill(spark, a.cdx, a.url_map)  # one row per capture file
        if a.out:
            plan.write.mode("overwrite").json(a.out)
        else:
            for row in plan.toLocalIterator():  # a partition at a time
                print(json.dumps(row.asDict()))


if __name__ == "__main__":
    main()
