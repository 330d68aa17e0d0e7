"""Intake as a stream (T4, T6, T7): validate arrivals, keep the first copy of
each content, and write accepted blobs, URL-map rows and rejects from one
micro-batch, idempotently keyed by batch id."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capstan.operators.intake import ACCEPTED, EMPTY, MISMATCH, TOO_LARGE
from capstan.streaming.arrivals import SLOW_DOWN

MIN_FREE_PERCENT = 10  # fixed value: default free-space floor


def free_space_probe(path: str, min_percent: int = MIN_FREE_PERCENT):
    """T5: a probe for a locally mounted spool: true while at least
    ``min_percent`` of its file system is free."""
    import shutil

    def ok() -> bool:
        u = shutil.disk_usage(path)
        return u.free * 100 // u.total >= min_percent

    return ok


def codes(stream: DataFrame, max_size: int = 0) -> DataFrame:
    """Response code per arrival (stateless)."""
    size = F.col("length")
    too_large = F.lit(False) if max_size <= 0 else size > max_size
    code = F.when(too_large, F.lit(TOO_LARGE)).when(size == 0, F.lit(EMPTY)).otherwise(F.lit(ACCEPTED))
    return stream.withColumn("code", code)


def intake_batch_writer(out: str):
    """T4: one intake, several outputs, written per batch id (idempotent)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            ok = batch.where(F.col("code") == ACCEPTED)
            ok.select("sha1hex", "size", "path").write.mode("overwrite").parquet(
                f"{out}/spool/batch={batch_id}")
            ok.select(F.col("path").alias("url"), F.col("sha1hex").alias("sha1"),
                      F.current_timestamp().alias("timestamp")).write.mode("overwrite").parquet(
                f"{out}/url_map/batch={batch_id}")
            batch.where(F.col("code") != ACCEPTED).select("path", "code").write.mode("overwrite").parquet(
                f"{out}/rejects/batch={batch_id}")
            batch.groupBy("code").agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(
                f"{out}/codes/batch={batch_id}")
        finally:
            batch.unpersist()

    return write


def running_counts(stream: DataFrame) -> DataFrame:
    """Running count per code (complete mode)."""
    return stream.groupBy("code").agg(F.count(F.lit(1)).alias("n"))


def _together(spark: SparkSession, first: Callable[[], object], others: list[Callable[[], object]]) -> None:
    """Writes that do not read each other, as jobs at the same time; a failure
    is raised when all have ended.  ``first`` stays in the caller's thread,
    whose session knows the library's own writers."""
    with ThreadPoolExecutor(len(others)) as pool:
        done = [pool.submit(inheritable_thread_target(spark)(w)) for w in others]
        first()
    for d in done:
        d.result()


def written(taken: DataFrame, ok: DataFrame) -> DataFrame:
    """The contents of the arrivals that ``ok`` names.  The paths are dealt out
    with the arrivals: a broadcast of them would pass the driver once a batch."""
    return taken.join(ok.select("path").hint("shuffle_hash"), "path", "left_semi").select("content")


def spool_intake_writer(spool_dir: str, tables: str, max_size: int = 0, has_space=None, urls: DataFrame | None = None):
    """T4 with J1: the ``serve`` flow for one micro-batch of arrivals.

    ``batch`` rows carry path, length, content, sha1hex, size (and an
    optional ``url``).  Rows with a ``code`` other than 202, as the arrivals
    source gives, are recorded with that answer.  Valid arrivals are looked up in the index of earlier
    batches (``tables/index``, see ``KeyIndex``; the history itself is not
    read): equal size -> skip, other size -> overwrite, absent -> insert; within a batch the first
    arrival of a hash (by path) writes.  Accepted content is written to
    ``spool_dir/{shard}/{sha1}`` (content-addressed, idempotent); the spool
    table, URL map and rejects get a ``batch=<id>`` folder each, replaced if
    the batch is retried.  ``has_space`` (T5), when given, is called once
    per micro-batch on the driver; if it returns false, every arrival of the
    batch is answered 429 (``slow-down``), recorded with the rejects for a
    later retry, and nothing is stored.
    """
    from capstan.operators import intake as J
    from capstan.operators.keyindex import KeyIndex
    from capstan.sinks.hashdir import write_hashdir

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        index = KeyIndex(spark, f"{tables}/index")
        if has_space is not None and not has_space():
            slow = batch.select("path", "sha1hex", F.lit("slow-down").alias("action"),
                                F.lit(SLOW_DOWN).alias("code"))
            slow.write.mode("overwrite").parquet(f"{tables}/actions/batch={batch_id}")
            slow.select("path", "code", "action").write.mode("overwrite").parquet(
                f"{tables}/rejects/batch={batch_id}")
            return
        b = batch.withColumn("declared", F.col("length"))
        if urls is not None:  # by file name
            named = urls.select(F.col("name").alias("_name"), "url")
            b = b.withColumn("_name", F.substring_index("path", "/", -1)).join(named, "_name", "left").drop("_name")
        coded = "code" in b.columns
        b = b.persist(StorageLevel.DISK_ONLY)  # a micro-batch's bytes are read from the arrivals once
        cells = acts = None
        try:
            taken = b.where(F.col("code") == ACCEPTED).drop("code") if coded else b
            # read once, by this count: stages that start together would each read the arrivals
            cells = b.drop("content", "length").coalesce(spark.sparkContext.defaultParallelism).persist()
            cells.count()
            keys = cells.where(F.col("code") == ACCEPTED).drop("code") if coded else cells
            stored = index.lookup(keys.select("sha1hex"), before=batch_id)
            kept = ["path", "sha1hex", "size", *(["url"] if "url" in b.columns else []), "action", "code"]
            acts = J.actions(keys, stored, max_size, order="path", join="merge").select(*kept)
            if coded:
                name = F.when(F.col("code") == EMPTY, "empty").when(F.col("code") == TOO_LARGE, "too-large").when(
                    F.col("code") == SLOW_DOWN, "slow-down").when(F.col("code") == MISMATCH, "length-mismatch").otherwise("rejected")
                acts = acts.unionByName(cells.where(F.col("code") != ACCEPTED).withColumn("action", name).select(*kept))
            # decided once, keys only; few rows, so in no more parts than the cluster has cores
            acts = acts.coalesce(spark.sparkContext.defaultParallelism).persist()
            ok = acts.where(F.col("action").isin("insert", "overwrite"))
            entries = ok.count()
            outputs = {
                "spool": ok.select("sha1hex", "size", "path"),
                "actions": acts.select("path", "sha1hex", "action", "code"),
                "rejects": acts.where(F.col("code") != ACCEPTED).select("path", "code", "action"),
            }
            if "url" in b.columns:
                outputs["url_map"] = ok.where(F.col("url").isNotNull()).select(
                    "url", F.col("sha1hex").alias("sha1"), F.current_timestamp().alias("timestamp"))
            content = written(taken, ok)
            _together(spark, lambda: write_hashdir(content, spool_dir), [
                lambda kind=kind, rows=rows: rows.write.mode("overwrite").parquet(f"{tables}/{kind}/batch={batch_id}")
                for kind, rows in outputs.items()])
            # last: a batch that failed before this line is done again from its start
            index.add(ok.select("sha1hex", "size"), batch_id, rows=entries)
        finally:
            for kept_rows in (acts, cells, b):
                if kept_rows is not None:
                    kept_rows.unpersist()

    return write
