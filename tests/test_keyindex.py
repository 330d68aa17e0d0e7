"""The spool index: lookups equal a dictionary, read little, survive retries."""

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from capstan.operators.keyindex import KeyIndex, admits, bloom
from capstan.session import scratch_path
from capstan.sources import fsio


def sha(x):
    return hashlib.sha1(str(x).encode()).hexdigest()


def rows(spark, entries):
    return spark.createDataFrame([(h, s) for h, s in entries], "sha1hex string, size bigint")


def asked(spark, hashes):
    return spark.createDataFrame([(h,) for h in hashes], "sha1hex string")


def found(index, spark, hashes, before=None):
    return {r.sha1hex: r.stored_size for r in index.lookup(asked(spark, hashes), before).collect()}


def test_filter_never_misses():
    keys = [hashlib.sha1(str(i).encode()).digest() for i in range(5000)]
    bits = bloom(keys, 12)
    assert admits(bits, keys, 12).all() and len(bits) == 7500
    other = [hashlib.sha1(b"x%d" % i).digest() for i in range(20000)]
    assert np.mean(admits(bits, other, 12)) < 0.01


def test_index_equals_a_dictionary(spark):
    index = KeyIndex(spark, scratch_path(spark, "ix"), fanout=3, bucket_rows=40)
    assert found(index, spark, [sha(1)]) == {}
    rng, held = random.Random(2), {}
    for batch in range(8):
        entries = {sha(rng.randrange(400)): rng.randrange(1, 99) for _ in range(60)} if batch != 4 else {}
        index.add(rows(spark, entries.items()), batch)
        held |= entries
    probe = [sha(i) for i in range(0, 500, 3)] + [None]
    assert found(index, spark, probe) == {h: held[h] for h in probe if h in held}
    runs = index.runs()
    assert max(r["level"] for r in runs) >= 1 and max(r["bits"] for r in runs) >= 2
    gone = index.vacuum()
    assert gone and found(index, spark, probe) == {h: held[h] for h in probe if h in held}


def test_a_retried_batch_never_meets_itself(spark):
    index = KeyIndex(spark, scratch_path(spark, "ix"), fanout=2)
    for batch in range(4):
        index.add(rows(spark, [(sha(batch), batch + 1), (sha("all"), batch + 10)]), batch)
    assert found(index, spark, [sha(3), sha("all"), sha(0)], before=3) == {sha("all"): 12, sha(0): 1}
    before = index.runs()
    index.add(rows(spark, [(sha(3), 44), (sha("all"), 13)]), 3)  # again
    assert found(index, spark, [sha(3), sha("all")]) == {sha(3): 44, sha("all"): 13}
    assert [r["name"] for r in index.runs()] == [r["name"] for r in before]


def test_a_lookup_reads_little(spark):
    path = scratch_path(spark, "ix")
    index = KeyIndex(spark, path, bucket_rows=1000)
    for batch in range(3):
        entries = spark.range(100_000).select(F.sha1(F.concat(F.lit(f"{batch}-"), F.col("id").cast("string"))).alias("sha1hex"), F.col("id").alias("size"))
        index.add(entries, batch)
    hashes = spark.createDataFrame([(sha(f"new {i}"),) for i in range(300)] + [(sha("1-7"),)], "sha1hex string")
    assert [tuple(r) for r in index.lookup(hashes).collect()] == [(sha("1-7"), 7)]
    touched = {(r.run, r.bucket) for r in index.candidates(hashes.select(F.unhex("sha1hex").alias("key")), index.runs()).collect()}
    sizes = {f: n for f, n, _ in fsio.walk_files(path) if f.endswith(".parquet")}
    data = sum(n for f, n in sizes.items() if "/runs/" in f)
    read = sum(n for f, n in sizes.items() if "/filters/" in f or any(f"run={r}/bucket={b}/" in f for r, b in touched))
    assert len(touched) < 20 and read < 0.1 * data


def test_a_lookup_sends_no_rows_to_the_driver(spark):
    """Neither the asked keys nor a filter of them pass the driver (a broadcast, a runtime Bloom filter)."""
    from capstan.operators.intake import actions

    index = KeyIndex(spark, scratch_path(spark, "ix"), bucket_rows=10)
    index.add(rows(spark, [(sha(i), i) for i in range(1, 60)]), 0)
    index.add(rows(spark, [(sha(7), 700)]), 1)
    arrivals = spark.createDataFrame([(f"p{i}", sha(i % 80), i % 80, i % 80) for i in range(1, 160)], "path string, sha1hex string, size bigint, declared bigint")
    arrivals = arrivals.where("size < 1000").persist()
    arrivals.count()
    stored = index.lookup(arrivals.select("sha1hex"), before=1)
    acts = actions(arrivals, stored, order="path", join="merge")
    for df in (stored, acts):
        rows_ = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert rows_ and "Broadcast" not in plan and "bloom" not in plan and "might_contain" not in plan
    assert {r.sha1hex: r.stored_size for r in stored.collect()} == {sha(i): i for i in range(1, 60)}
    got = sorted((r.path, r.action) for r in acts.collect() if r.size in (7, 70))
    assert got == [("p150", "insert"), ("p7", "skip"), ("p70", "skip"), ("p87", "skip")]
    arrivals.unpersist()


def test_a_bucket_without_files_is_an_error(spark):
    path = scratch_path(spark, "ix")
    index = KeyIndex(spark, path)
    index.add(rows(spark, [(sha(1), 1)]), 0)
    for f, _, _ in fsio.walk_files(f"{path}/runs"):
        fsio.remove(f)
    try:
        found(index, spark, [sha(1)])
        raise AssertionError("must fail")
    except Exception as exc:
        assert "must fail" not in str(exc) and "bucket=0" in str(exc)
