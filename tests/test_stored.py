"""Stored tables that grow: puts merged into the artifact store, the bucketed
URL index, read ranges of a fetch."""

import os
import re

from pyspark.sql import functions as F

from capstan.operators import artifacts
from capstan.operators.urlindex import UrlIndex
from capstan.session import scratch_path
from capstan.sources import cdx, fsio


def puts(spark, rows):
    df = spark.createDataFrame(rows, "seq long, sha1hex string, content string")
    return artifacts.put_requests(df.select("seq", F.lit("blobs").alias("folder"), "sha1hex", F.lit("txt").alias("ext"), F.lit("").alias("prefix"),
                                            F.lit("").alias("bucket"), F.encode("content", "UTF-8").alias("content")))


def test_a_put_rewrites_only_its_partitions(spark):
    path = scratch_path(spark, "store")
    a, b = "aa" + "0" * 38, "bb" + "0" * 38
    artifacts.merge_into(path, puts(spark, [(1, a, "one"), (2, b, "two"), (3, "short", "x")]), "seq", 0)
    files = lambda shard: {f: m for f, _, m in fsio.walk_files(path) if f"shard={shard}" in f and f.endswith(".parquet")}
    before = files("bb")
    for _ in range(2):  # the second time changes nothing
        artifacts.merge_into(path, puts(spark, [(5, a, "new"), (4, a, "older"), (6, a[:-1] + "1", "more")]), "seq", 1)
        got = {r.object_path.rsplit("/", 1)[1]: (r.size, r.batch) for r in spark.read.parquet(path).collect()}
        assert got == {a + ".txt": (3, 1), a[:-1] + "1.txt": (4, 1), b + ".txt": (3, 0)}
    assert files("bb") == before
    artifacts.merge_into(path, puts(spark, [(9, a, "late")]), "seq", 0)  # an old batch does not win
    assert {r.size for r in spark.read.parquet(path).where(F.col("object_path").endswith(a + ".txt")).collect()} == {3}


def test_url_index(spark):
    index = UrlIndex(spark, scratch_path(spark, "urls"), buckets=4)
    rows = [("u1", "s1"), ("u1", "s1"), ("u2", "s1"), ("u1", "s2"), (None, "s1"), ("u3", None)]
    for part in (rows[:3], rows[:3], rows[2:], [("u9", "s1")]):
        index.add(spark.createDataFrame(part, "url string, sha1 string"))
    asked = spark.createDataFrame([("u1",), ("u2",), ("u7",), (None,)], "url string")
    got = sorted(tuple(r) for r in index.lookup(asked).select("url", "sha1", "urls_per_sha1").collect())
    assert got == [("u1", "s1", 3), ("u1", "s2", 1), ("u2", "s1", 3)]
    again = UrlIndex(spark, index.path, buckets=4).lookup(asked)
    assert again.count() == 3


def test_the_map_is_not_exchanged(spark):
    index = UrlIndex(spark, scratch_path(spark, "urls"), buckets=4)
    index.add(spark.createDataFrame([("u1", "s1")], "url string, sha1 string"))
    own = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        plan = index.lookup(spark.range(3).select(F.col("id").cast("string").alias("url")))._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    scans = [line for line in plan.splitlines() if "FileScan" in line and "by_" in line]
    assert scans and "Bucketed: true" in " ".join(scans)
    lines = [x for x in plan.splitlines() if x.strip(" :")]
    depth = lambda line: len(re.match(r"[\s:|+\-]*", line)[0])
    for i, line in enumerate(lines):
        if line in scans:
            at, above = depth(line), []
            for x in reversed(lines[:i]):  # the nodes over the scan
                if depth(x) < at:
                    at = depth(x)
                    above.append(x)
            first = next(x for x in above if "Exchange" in x or "Join" in x)
            assert "Join" in first, plan


def test_read_ranges(spark):
    rows = [("a", 0, 10), ("a", 12, 8), ("a", 12, 8), ("a", 15, 2), ("a", 40, 5), ("a", 99, 10), ("a", 101, 4), ("a", 7, None), ("b", 0, 1), ("b", 3, 0)]
    index = spark.createDataFrame(rows, "filename string, compressed_offset long, compressed_record_size long")
    ranged = cdx.read_ranges(index, open_cost=5, block=100)
    got = sorted({(r.filename, r.range_start, r.range_stop) for r in ranged.collect()}, key=repr)
    assert got == sorted([("a", 0, 20), ("a", 40, 45), ("a", 99, 109), ("a", 101, 105), ("b", 0, 1), ("a", None, None), ("b", None, None)], key=repr)
    totals = {r.filename: (r.ranges, r.rows, r.bytes) for r in cdx.range_totals(ranged).collect()}
    assert totals == {"a": (4, 7, 20 + 5 + 10 + 4), "b": (1, 1, 1)} and os.sep
