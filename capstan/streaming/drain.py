"""Draining the spool as a file stream.

The spool folder is planned in tasks and the plan is read with ``readStream``:
a plan file is one micro-batch, whose tasks read the files it names.  Each run
is ``trigger(availableNow=True)`` (a periodic drain), admission is bounded by
``max_files`` (T5).  Processed files can be removed by the source
(``cleanSource=delete``, T2; the removal of a file happens in a later run); that
is Spark's own ``binaryFile`` stream, which lists on the driver.
Results are written per micro-batch into ``{out}/batch={id}``, overwritten on
a retry of the same batch, so the output is exactly-once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capstan.functions.hashing import file_info
from capstan.session import range_partitions
from capstan.sources import fsio
from capstan.sources.spool import BINARY_SCHEMA, data_files, read_files
from capstan.streaming.arrivals import cut

PLAN = "path string, modificationTime timestamp, length bigint"


def plan_spool(spark: SparkSession, spool_dir: str, log: str, max_files: int) -> None:
    """Plan the files of the spool that ``log`` does not name yet (a file with
    another length or time is a new one), oldest first, ``max_files`` to a plan
    file.  A plan counts once its folder is complete; one that failed before is
    written again in its place."""
    done = [p for p, is_dir, _, _ in fsio.list_dir(log) if is_dir and fsio.exists(fsio.join(p, "_SUCCESS"))] if fsio.exists(log) else []
    files = data_files(spark, spool_dir)
    if done:
        files = files.join(spark.read.schema(PLAN).option("recursiveFileLookup", "true").parquet(*done), ["path", "modificationTime", "length"], "left_anti")
    plan = cut(files, F.lit(1), max_files, max_files, ("modificationTime", "path")).select("path", "modificationTime", "length", "admission")
    plan = plan.repartition(range_partitions(spark), "admission")
    plan.write.mode("overwrite").partitionBy("admission").parquet(fsio.join(log, f"plan-{len(done):08d}"))


def spool_stream(spark: SparkSession, spool_dir: str, max_files: int = 1000,
                 clean_source: str = "off", archive_dir: str | None = None, log: str | None = None) -> DataFrame:
    """A file stream over the files that are in the spool folder now.
    ``max_files`` is admission per micro-batch; nothing is left out.

    The plan is kept in ``log``, by default beside the spool folder, for all
    streams of one ``max_files``; every call adds the files that are new, and a
    stream's checkpoint knows what it has read of the plan.  A file that is gone
    when its turn comes has no row."""
    if clean_source != "off":
        return _own_stream(spark, spool_dir, max_files, clean_source, archive_dir)
    log = log or f"{spool_dir.rstrip('/')}-plan/files={max_files}"
    plan_spool(spark, spool_dir, log, max_files)
    names = (spark.readStream.schema(PLAN).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", "1")
             .parquet(log))
    return read_files(names.repartition(min(max_files, 4 * spark.sparkContext.defaultParallelism)), gone_ok=True)


def _own_stream(spark: SparkSession, spool_dir: str, max_files: int, clean_source: str, archive_dir: str | None) -> DataFrame:
    """Spark's ``binaryFile`` stream, which can remove what it has read.

    Each micro-batch names its files explicitly, and Spark lists more than 32
    explicit paths with a job of up to 10,000 tasks, however few task slots
    there are; unless the session says otherwise, the job gets four tasks a
    slot."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    if spark.conf.get(key) == "10000":  # the default
        spark.conf.set(key, str(4 * spark.sparkContext.defaultParallelism))
    r = (spark.readStream.format("binaryFile").schema(BINARY_SCHEMA)
         .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", str(max_files))
         .option("cleanSource", clean_source))
    if archive_dir:
        r = r.option("sourceArchiveDir", archive_dir)
    return r.load(spool_dir)


def fingerprint(stream: DataFrame) -> DataFrame:
    """F1 on each arrival; the content is dropped after hashing."""
    return stream.select("path", "modificationTime", "length",
                         file_info(F.col("content")).alias("fi")).select(
        "path", "modificationTime", "length", "fi.*")


def per_batch_writer(out: str, transform: Callable[[DataFrame], DataFrame] | None = None):
    """foreachBatch function writing each batch to its own folder (idempotent)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        b = transform(batch) if transform else batch
        # a micro-batch of many small files has many input splits; its few
        # output rows need no more files than the cluster has cores.
        n = batch.sparkSession.sparkContext.defaultParallelism
        b.coalesce(max(1, n)).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return write


def run_available(stream: DataFrame, out: str, checkpoint: str,
                  transform: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Process everything available now, then stop."""
    q = (stream.writeStream.foreachBatch(per_batch_writer(out, transform))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def dedupe_by_hash(stream: DataFrame, key: str = "sha1hex", event_time: str | None = None,
                   delay: str = "1 hour") -> DataFrame:
    """Drop arrivals whose content hash was seen before.

    With ``event_time`` the state is bounded by the watermark.  Without it
    the state keeps every hash, like a spool that never forgets: use it for
    bounded runs only (``availableNow`` over a folder), and a RocksDB state
    store on a cluster; for an endless intake use ``spool_intake_writer``,
    whose memory is a table.
    """
    if event_time is None:
        return stream.dropDuplicates([key])
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])
