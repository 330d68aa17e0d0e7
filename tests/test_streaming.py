"""Streaming: drain equals batch, source cleanup lags one run (T2), bounded
dedupe by watermark (T3), running counts (T6), per-batch idempotent writes."""

import os

from pyspark.sql import functions as F

from capstan.session import scratch_path
from capstan.sinks.blobdir import write_blobs
from capstan.sources.blocklist import default_blocklist
from capstan.streaming import drain, intake


def _spool(spark, rows):
    root = scratch_path(spark, "t-stream")
    write_blobs(spark.createDataFrame(rows, "path string, content binary"), root)
    return root


def test_drain_then_clean_source(spark):
    root = _spool(spark, [("aa/1", bytearray(b"one")), ("bb/2", bytearray(b"two")), ("bb/3", bytearray(b"one"))])
    out, ckpt = scratch_path(spark, "t-o"), scratch_path(spark, "t-c")
    s = drain.fingerprint(drain.spool_stream(spark, root, max_files=2, clean_source="delete"))
    drain.run_available(s.select("path", "sha1hex", "size"), out, ckpt)
    got = spark.read.parquet(out)
    assert got.count() == 3
    assert got.select("sha1hex").distinct().count() == 2
    # a second run has nothing new; files read earlier are removed by now
    drain.run_available(s.select("path", "sha1hex", "size"), out, ckpt)
    assert spark.read.parquet(out).count() == 3
    left = [f for _, _, fs in os.walk(root) for f in fs if not f.startswith(".")]
    assert len(left) < 3


def test_dedupe_unbounded_and_with_watermark(spark):
    root = _spool(spark, [("a/1", bytearray(b"x")), ("a/2", bytearray(b"x")), ("a/3", bytearray(b"y"))])
    for event_time in (None, "modificationTime"):
        out, ckpt = scratch_path(spark, "t-o"), scratch_path(spark, "t-c")
        s = drain.fingerprint(drain.spool_stream(spark, root, max_files=1))
        d = drain.dedupe_by_hash(s.select("sha1hex", "modificationTime"), event_time=event_time)
        drain.run_available(d.select("sha1hex"), out, ckpt)
        assert sorted(r.sha1hex for r in spark.read.parquet(out).collect()) == sorted(
            [r[0] for r in spark.createDataFrame([(bytearray(b"x"),), (bytearray(b"y"),)], "c binary")
             .select(F.sha1("c")).collect()])


def test_intake_stream_outputs_and_running_counts(spark):
    root = _spool(spark, [("a/1", bytearray(b"x" * 10)), ("a/2", bytearray(b"y" * 50)), ("a/3", bytearray(b"z"))])
    out, ckpt = scratch_path(spark, "t-o"), scratch_path(spark, "t-c")
    s = intake.codes(drain.fingerprint(drain.spool_stream(spark, root, max_files=10)), max_size=20)
    q = (s.writeStream.foreachBatch(intake.intake_batch_writer(out)).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.read.parquet(os.path.join(out, "spool")).count() == 2
    assert [r.code for r in spark.read.parquet(os.path.join(out, "rejects")).collect()] == [413]
    q2 = (intake.running_counts(s).writeStream.outputMode("complete").format("memory").queryName("t6codes")
          .option("checkpointLocation", scratch_path(spark, "t-c2")).trigger(availableNow=True).start())
    q2.awaitTermination()
    assert {r.code: r.n for r in spark.sql("select * from t6codes").collect()} == {202: 2, 413: 1}


def test_default_blocklist(spark):
    assert default_blocklist(spark).count() == 151


def test_stream_lists_in_tasks_and_keeps_to_new_files(spark):
    """No file of the spool is named to the driver's file index; a later run plans new files only."""
    root = _spool(spark, [(f"a/{i}", bytearray(b"x%d" % i)) for i in range(7)] + [("a/empty", bytearray()), ("_h/1", bytearray(b"h")), ("a/.h", bytearray(b"h"))])
    out, ckpt = scratch_path(spark, "t-o"), scratch_path(spark, "t-c")
    s = drain.spool_stream(spark, root, max_files=3)
    assert "FileScan binaryFile" not in s._jdf.queryExecution().toString() and "binaryFile" not in s._jdf.queryExecution().logical().toString()
    drain.run_available(drain.fingerprint(s).select("path", "sha1hex", "size"), out, ckpt)
    got = spark.read.parquet(out)
    assert sorted(r["count"] for r in got.groupBy("batch").count().collect()) == [1, 3, 3]
    assert {r.path for r in got.collect()} == {f"file:{root}/a/{i}" for i in range(7)}
    write_blobs(spark.createDataFrame([("b/new", bytearray(b"new"))], "path string, content binary"), root)
    drain.run_available(drain.fingerprint(drain.spool_stream(spark, root, max_files=3)).select("path", "sha1hex", "size"), out, ckpt)
    assert spark.read.parquet(out).count() == 8
