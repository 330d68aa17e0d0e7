"""Stateful intake: equal to a sequential replay, across micro-batches, restarts and expiry."""

import datetime as dt
import os

from pyspark.sql import functions as F

from capstan.session import scratch_path
from capstan.streaming import state

SCHEMA = "path string, sha1hex string, size bigint, declared bigint, arrived timestamp"
T0 = dt.datetime(2024, 1, 1)


def land(spark, folder, rows, name):
    """One file, so one micro-batch with ``maxFilesPerTrigger`` 1."""
    spark.createDataFrame([(p, h, s, s if d is None else d, t) for p, h, s, d, t in rows], SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def replay(batches, stored=(), max_size=0):
    held, out = dict(stored), []
    for rows in batches:
        for p, h, s, d, _ in sorted(rows, key=lambda r: r[0]):
            bad = "too-large" if max_size and max(s, d if d is not None else s) > max_size else "empty" if s == 0 else "length-mismatch" if d not in (None, s) else None
            out.append((p, bad or ("insert" if h not in held else "skip" if held[h] == s else "overwrite")))
            if not bad:
                held[h] = s
    return sorted(out)


def test_state_is_a_replay_over_restarts(spark):
    own = state.state_session(spark)
    folder, out, ckpt = (scratch_path(spark, k) for k in ("st-in", "st-out", "st-ckpt"))
    batches = [
        [("a", "h1", 5, None, T0), ("b", "h1", 5, None, T0), ("c", "h2", 0, None, T0), ("d", "old", 7, None, T0), ("e", "cut", 9, None, T0), ("f", None, 3, None, T0)],
        [("g", "h1", 6, None, T0), ("h", "h2", 4, 5, T0), ("i", "h2", 4, None, T0), ("j", "big", 99, None, T0)] + [(f"k{i:03d}", "hot", 8, None, T0) for i in range(700)],
        [("m", "h1", 6, None, T0), ("n", "h2", 4, None, T0), ("o", "cut", 9, None, T0), ("p", "hot", 8, None, T0)],
    ]
    stored = spark.createDataFrame([("old", 7), ("cut", 3)], "sha1hex string, stored_size bigint")
    path = scratch_path(spark, "st-old")
    stored.write.parquet(path)
    for rows in batches:  # a restart from the checkpoint before each
        land(spark, folder, rows, "x")
        arrivals = own.readStream.schema(SCHEMA).option("maxFilesPerTrigger", "1").parquet(folder)
        state.run_intake(arrivals, out, ckpt, max_size=50, stored=own.read.parquet(path))
    got = sorted(tuple(r) for r in spark.read.parquet(out).select("path", "action").collect())
    assert got == replay(batches, [("old", 7), ("cut", 3)], 50)
    codes = {r.action: r.code for r in spark.read.parquet(out).collect()}
    assert codes == {"insert": 202, "skip": 202, "overwrite": 202, "empty": 400, "too-large": 413, "length-mismatch": 500}
    assert "RocksDB" not in (spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) or "")


def test_state_ends_after_its_ttl(spark):
    own = state.state_session(spark)
    folder, out, ckpt = (scratch_path(spark, k) for k in ("ttl-in", "ttl-out", "ttl-ckpt"))
    hours = lambda n: T0 + dt.timedelta(hours=n)
    steps = [("a", "h", 0, "insert"), ("b", "h", 5, "skip"), ("c", "h", 14, "skip"), ("x", "z", 25, "insert"), ("y", "z", 26, "skip"), ("d", "h", 27, "insert")]
    for p, h, at, _ in steps:
        land(spark, folder, [(p, h, 5, None, hours(at))], p)
        arrivals = own.readStream.schema(SCHEMA).option("maxFilesPerTrigger", "1").parquet(folder)
        state.run_intake(arrivals, out, ckpt, ttl="10 hours")
    got = dict(tuple(r) for r in spark.read.parquet(out).select("path", "action").collect())
    assert got == {p: a for p, _, _, a in steps}


def test_a_hot_hash_sends_few_rows(spark):
    rows = spark.range(4000).select(F.col("id").cast("string").alias("path"), F.lit("hot").alias("sha1hex"), F.lit(3).cast("bigint").alias("size"),
                                    F.lit(3).cast("bigint").alias("declared"), F.current_timestamp().alias("arrived"))
    keys = state.keyed(rows).groupBy("key").count().collect()
    assert max(r["count"] for r in keys) <= 64 and sum(r["count"] for r in keys) == 4000
    assert os.path.basename(state.__file__) == "state.py"


def test_many_hashes_are_few_groups(spark):
    """A group is a call of the operator; they do not grow with the hashes."""
    rows = spark.range(9000).select(F.col("id").cast("string").alias("path"), F.sha1(F.col("id").cast("string").cast("binary")).alias("sha1hex"),
                                    F.lit(3).cast("bigint").alias("size"), F.lit(3).cast("bigint").alias("declared"), F.current_timestamp().alias("arrived"))
    assert state.keyed(rows).select("key").distinct().count() <= state.BUCKETS
    assert state.keyed(rows, buckets=16).select("key").distinct().count() == 16
