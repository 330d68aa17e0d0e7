"""The arrivals source: admissions, answers, restarts and removal."""

import os

from pyspark.sql import functions as F

from capstan import jobs
from capstan.session import scratch_path
from capstan.sources.spool import list_spool
from capstan.streaming import arrivals


def _put(root, files):
    for name, data in files.items():
        path = os.path.join(root, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as fh:
            fh.write(data)


def _collector(out):
    def write(batch, batch_id):
        batch.withColumn("b", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
    return write


def _names(rows):
    return sorted((r.path.rsplit("/", 1)[-1], r.code, r.b) for r in rows)


def test_listing_of_few_and_many_folders(spark):
    few, many = scratch_path(spark, "t-ls"), scratch_path(spark, "t-ls")
    _put(few, {"x": b"1", "a/y": b"", "a/b/z": b"22", "a/b/c/w": b"333", "_t/no": b"", "a/.h": b"", "d/e/.tmp": b""})
    _put(many, {f"{i:03d}/f{i}": b"x" * i for i in range(90)})
    got = {(os.path.relpath(r.path, few), r.length) for r in list_spool(spark, few).collect()}
    assert got == {("x", 1), ("a/y", 0), ("a/b/z", 2), ("a/b/c/w", 3)}
    assert sorted(r.length for r in list_spool(spark, many).collect()) == list(range(90))


def test_admissions_by_bytes_and_files_then_restart(spark):
    root, log, out, ckpt = (scratch_path(spark, f"t-arr-{k}") for k in ("in", "log", "out", "ckpt"))
    _put(root, {"a/1": b"x" * 10, "a/2": b"", "a/3": b"y" * 30, "b/4": b"z" * 5, "b/5": b"w" * 100})
    assert arrivals.announce(spark, root, log, max_bytes=40, max_files=4, slice_bytes=20) == 2
    s = arrivals.arrivals_stream(spark, log, max_size=50)
    arrivals.drain(s, _collector(out), ckpt)
    got = spark.read.parquet(out).collect()
    # weights 10, 10 (empty: a fourth of an admission), 30, 10, 100: 3 begins at 20, 4 at 50, 5 at 60
    assert _names(got) == [("1", 202, 0), ("2", 400, 0), ("3", 202, 0), ("4", 202, 1), ("5", 413, 1)]
    assert {r.path[-1]: r.content for r in got}["2"] == b"" and {r.path[-1]: r.content for r in got}["5"] is None
    # nothing new: no admission, no batch; then a new file, a changed one, and a stream that starts again
    assert arrivals.announce(spark, root, log, max_bytes=40, max_files=4) == 0
    arrivals.drain(arrivals.arrivals_stream(spark, log), _collector(out), ckpt)
    assert spark.read.parquet(out).count() == 5
    _put(root, {"a/1": b"changed", "c/6": b"new"})
    assert arrivals.announce(spark, root, log, max_bytes=40, max_files=4) == 1
    arrivals.drain(arrivals.arrivals_stream(spark, log), _collector(out), ckpt)
    assert _names(spark.read.parquet(out).where("b > 1").collect()) == [("1", 202, 2), ("6", 202, 2)]


def test_short_space_is_429_and_offered_again(spark):
    root, log, out, ckpt = (scratch_path(spark, f"t-slow-{k}") for k in ("in", "log", "out", "ckpt"))
    _put(root, {"a/1": b"one", "a/2": b""})
    arrivals.announce(spark, root, log)
    arrivals.drain(arrivals.arrivals_stream(spark, log, min_free_percent=101, space_of=root), _collector(out), ckpt)
    assert _names(spark.read.parquet(out).collect()) == [("1", 429, 0), ("2", 429, 0)]
    assert arrivals.remove_answered(spark, log, 0) == 0 and os.path.exists(f"{root}/a/1")
    assert arrivals.announce(spark, root, log) == 1
    arrivals.drain(arrivals.arrivals_stream(spark, log), _collector(out), ckpt)
    assert _names(spark.read.parquet(out).where("b = 1").collect()) == [("1", 202, 1), ("2", 400, 1)]
    assert arrivals.announce(spark, root, log) == 0
    assert arrivals.remove_answered(spark, log, 0) == 2 and not os.path.exists(f"{root}/a/1")


def test_failed_batch_is_taken_again_with_the_same_answer(spark):
    root, log, out, ckpt = (scratch_path(spark, f"t-fail-{k}") for k in ("in", "log", "out", "ckpt"))
    _put(root, {"1": b"one", "2": b"two", "3": b"three"})
    assert arrivals.announce(spark, root, log, max_bytes=4, max_files=1) == 3

    def broken(batch, batch_id):
        if batch_id == 1:
            raise RuntimeError("disk gone")
        _collector(out)(batch, batch_id)

    try:
        arrivals.drain(arrivals.arrivals_stream(spark, log), broken, ckpt)
        raise AssertionError("must fail")
    except Exception as exc:
        assert "disk gone" in str(exc)
    # space is short now, but the batch that failed had its answer already
    arrivals.drain(arrivals.arrivals_stream(spark, log, min_free_percent=101, space_of=root), _collector(out), ckpt)
    assert _names(spark.read.parquet(out).collect()) == [("1", 202, 0), ("2", 202, 1), ("3", 429, 2)]


def test_file_gone_or_changed_after_it_was_announced(spark):
    root, log, out, ckpt = (scratch_path(spark, f"t-gone-{k}") for k in ("in", "log", "out", "ckpt"))
    _put(root, {"1": b"one", "2": b"two", "3": b"three"})
    arrivals.announce(spark, root, log)
    os.remove(f"{root}/1")
    _put(root, {"2": b"longer now"})
    arrivals.drain(arrivals.arrivals_stream(spark, log), _collector(out), ckpt)
    assert _names(spark.read.parquet(out).collect()) == [("1", 500, 0), ("2", 500, 0), ("3", 202, 0)]
    assert arrivals.remove_answered(spark, log, 0) == 1 and os.listdir(root) == ["2"]


def test_empty_folder(spark):
    root, log = scratch_path(spark, "t-none"), scratch_path(spark, "t-none-log")
    os.makedirs(root)
    assert arrivals.announce(spark, root, log) == 0 and arrivals.planned(log) == 0


def test_intake_job_over_many_admissions(spark):
    root, spool, tables = (scratch_path(spark, f"t-many-{k}") for k in ("in", "spool", "tables"))
    _put(root, {f"{i % 3}/{i:02d}": b"same" if i % 2 else b"own %d" % i for i in range(12)} | {"0/zz": b""})
    acts = jobs.intake_arrivals(spark, root, spool, tables, max_files=4, remove_arrived=True)
    got = sorted((r.path.rsplit("/", 1)[-1], r.action) for r in acts.collect())
    inserted = sorted(n for n, a in got if a == "insert")
    assert inserted == ["00", "02", "03", "04", "06", "08", "10"]  # "same" by the first path, 0/03
    assert [n for n, a in got if a == "empty"] == ["zz"] and len(got) == 13
    assert acts.select("batch").distinct().count() == 4
    assert not any(names for _, _, names in os.walk(root))


def test_urls_are_joined_once_with_the_plan(spark):
    """The plan carries the URLs, so a micro-batch does not read the whole list of them."""
    root, log, out, ckpt, spool, tables = (scratch_path(spark, f"t-url-{k}") for k in ("in", "log", "out", "ckpt", "spool", "tables"))
    _put(root, {"a/1": b"one", "a/2": b"two", "b/3": b"three", "b/4": b""})
    urls = spark.createDataFrame([("1", "http://u/1"), ("3", "http://u/3"), ("3", "http://v/3"), ("4", "http://u/4")], "name string, url string")
    assert arrivals.announce(spark, root, log, max_bytes=4, max_files=2, urls=urls) > 1
    arrivals.drain(arrivals.arrivals_stream(spark, log, with_urls=True), _collector(out), ckpt)
    got = sorted((r.path.rsplit("/", 1)[-1], r.url or "", r.code) for r in spark.read.parquet(out).collect())
    assert got == [("1", "http://u/1", 202), ("2", "", 202), ("3", "http://u/3", 202), ("3", "http://v/3", 202), ("4", "http://u/4", 400)]
    assert arrivals.remove_answered(spark, log, 0) == 4
    _put(root, {"a/1": b"one", "b/3": b"three"})
    jobs.intake_arrivals(spark, root, spool, tables, max_files=1, urls=urls)
    assert sorted(r.url for r in spark.read.parquet(f"{tables}/url_map").collect()) == ["http://u/1", "http://u/3", "http://v/3"]


def test_contents_meet_their_decisions_without_a_broadcast(spark):
    from capstan.streaming.intake import written

    taken = spark.createDataFrame([(f"p{i}", b"c%d" % i) for i in range(20)] + [("p3", b"c3")], "path string, content binary").persist()
    ok = spark.createDataFrame([(f"p{i}",) for i in range(0, 20, 3)], "path string").persist()
    assert taken.count() == 21 and ok.count() == 7  # as in a micro-batch, sizes are known and small
    out = written(taken, ok)
    assert sorted(bytes(r.content) for r in out.collect()) == sorted([b"c%d" % i for i in range(0, 20, 3)] + [b"c3"])
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    taken.unpersist(), ok.unpersist()
