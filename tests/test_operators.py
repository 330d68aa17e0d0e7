"""Operators: extractor hook, running numbers under skew, intake, stats."""

import time

from pyspark.sql import Window
from pyspark.sql import functions as F

from capstan.operators import derive, stats
from capstan.operators.windows import running_number


def test_running_number_matches_row_number_with_hot_group(spark):
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 17).cast("string")).alias("g"),
        F.col("id").alias("o"))
    got = running_number(df, ["g"], "o", "rn", num_partitions=8)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("o")))
    assert got.select("g", "o", "rn").exceptAll(want.select("g", "o", "rn")).count() == 0
    assert got.count() == 3000


def test_extractor_hook_statuses(spark):
    def _fake(blob: bytes) -> dict:
        if b"boom" in blob:
            raise RuntimeError("tool crashed")
        if b"slow" in blob:
            time.sleep(3)
        text = blob.decode("utf-8", "replace").split("\n", 1)[-1]
        return {"text": text, "thumbnail": b"\xff\xd8\xff" + b"x" * 60}

    rows = [(1, bytearray(b"%PDF-1.4\nhello https://a.org/x")), (2, bytearray(b"not a pdf")),
            (3, bytearray(b"%PDF-1.4\nboom")), (4, bytearray(b"%PDF-1.4\n")), (5, bytearray(b"%PDF-1.4\nslow"))]
    blobs = spark.createDataFrame(rows, "doc_id long, content binary")
    gated = derive.gate(blobs, None)
    out = derive.run_extractor(gated, _fake, timeout_s=1.0)
    res = {r.doc_id: r for r in derive.extract(out).collect()}
    assert res[1].status == "success" and res[1].weblinks == ["https://a.org/x"]
    assert res[1].page0thumbnail is not None
    assert res[2].status == "not-pdf"
    assert res[3].status == "parse-error" and "tool crashed" in res[3].err and res[3].fileinfo is None
    assert res[4].status == "empty-pdf"
    assert res[5].status == "parse-error" and "timeout" in res[5].err


def test_blocklist_gate(spark):
    rows = [(1, bytearray(b"%PDF-1.4\nA")), (2, bytearray(b"%PDF-1.4\nB"))]
    blobs = spark.createDataFrame(rows, "doc_id long, content binary")
    bl = blobs.where("doc_id = 1").select(F.sha1("content").alias("sha1hex"))
    g = derive.gate(blobs, bl).withColumn("text", F.lit("t"))
    res = {r.doc_id: r.status for r in derive.extract(g.drop("content")).collect()}
    assert res == {1: "bad-pdf", 2: "success"}


def test_run_stats_empty_and_full(spark):
    empty = spark.createDataFrame([], "status string")
    r = stats.run_stats(empty).first()
    assert (r.processed, r.ok, r.success_ratio) == (0, 0, 1.0)
    full = spark.createDataFrame([("success",), ("not-pdf",)], "status string")
    r = stats.run_stats(full).first()
    assert (r.processed, r.ok, r.success_ratio) == (2, 1, 0.5)


def test_extractor_process_isolation_kills_overruns(spark):
    import os

    from capstan.session import scratch_path

    marks = scratch_path(spark, "t-pids")
    os.makedirs(marks)

    def extractor(blob):
        import os as _os
        import time as _time

        if b"hang" in blob:
            with open(_os.path.join(marks, str(_os.getpid())), "w"):
                pass
            _time.sleep(60)
        if b"boom" in blob:
            raise ValueError("bad input")
        return {"text": "ok"}

    rows = [(1, bytearray(b"%PDF-1.4\nhang")), (2, bytearray(b"%PDF-1.4\nfine")), (3, bytearray(b"%PDF-1.4\nboom"))]
    blobs = spark.createDataFrame(rows, "doc_id long, content binary")
    t0 = time.time()
    out = derive.run_extractor(derive.gate(blobs, None), extractor, timeout_s=1.0, isolation="process")
    res = {r.doc_id: r for r in derive.extract(out).collect()}
    assert time.time() - t0 < 45
    assert res[1].status == "parse-error" and "timeout" in res[1].err
    assert res[2].status == "success"
    assert res[3].status == "parse-error" and res[3].err.endswith("ValueError: bad input")
    pids = [int(p) for p in os.listdir(marks)]
    assert pids
    for pid in pids:  # the hung child was terminated
        try:
            os.kill(pid, 0)
            alive = open(f"/proc/{pid}/status").read().find("zombie") < 0
        except (ProcessLookupError, FileNotFoundError):
            alive = False
        assert not alive
