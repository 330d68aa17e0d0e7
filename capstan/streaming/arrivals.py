"""Arrivals as a stream source of their own.

Spark's file source leaves empty files out, lists on the driver and admits by
number of files.  Here a run begins with ``announce``: the folder is listed in
tasks, files announced before are left out through a ``KeyIndex`` (no history
is read), and the rest is cut, in order of path, into admissions of at most
``max_bytes`` bytes and ``max_files`` files (plus the file that crosses the
line), each cut again into slices that a task reads.  That plan is a table;
the driver sees one row per admission.

The source ``arrivals`` streams the plan: its offset is the number of the last
admission taken and the answer it was taken with, and every micro-batch takes
one admission.  Free space is looked at once per admission, and the answer (202,
or 429 when space is short) is part of the offset, so a batch that is run again
gives the same answers.  Every announced file is a row with its ``code``:

* 202 with the content; 400 for an empty file;
* 413 for a file above ``max_size`` (or too long for a cell), which is not read;
* 429 for all files of an admission taken while space was short; none is read,
  and the next ``announce`` offers those still there again;
* 500 for a file that was gone, or had another length than announced, when read.

One announcer and one stream (``reader``) work on a log at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from capstan.operators.intake import ACCEPTED, EMPTY, MISMATCH, TOO_LARGE
from capstan.operators.keyindex import KeyIndex
from capstan.session import range_partitions, ship_package
from capstan.sources import fsio
from capstan.sources.spool import list_spool

SLOW_DOWN = 429
SCHEMA = "path string, modificationTime timestamp, length bigint, content binary, code int"
URL_SCHEMA = SCHEMA + ", url string"  # with the URLs that the plan was made with
PLANNED = "path string, length bigint, modificationTime timestamp"
CELL_BYTES = (1 << 31) - (1 << 16)  # what one binary cell can hold
BATCH_BYTES, BATCH_ROWS = 64 << 20, 256


# ------------------------------------------------------------------ the log

def _json(path: str):
    with fsio.open_read(path) as f:
        return json.loads(f.read())


def _names(folder: str) -> list[str]:
    return fsio.list_files(folder) if fsio.exists(folder) else []


def _heads(log: str) -> list[str]:
    """One file per announcement, named by the admissions planned with it."""
    return _names(fsio.join(log, "heads"))


def _number(path: str) -> int:
    return int(path.rsplit("/", 1)[1].split(".")[0])


def planned(log: str) -> int:
    """Admissions planned so far; they are numbered from 1."""
    heads = _heads(log)
    return _number(heads[-1]) if heads else 0


def taken(log: str, reader: str = "main") -> dict:
    """The offset that ``reader`` took last."""
    path = fsio.join(log, f"readers/{reader}/taken.json")
    return _json(path) if fsio.exists(path) else {"n": 0, "code": ACCEPTED}


def admission(log: str, n: int) -> str | None:
    """The folder that holds the plan of admission ``n``."""
    for path in _heads(log):
        if _number(path) >= n:
            head = _json(path)
            return fsio.join(log, f"plans/{head['plan']}/admission={head['bins'][n - head['first']]}")
    return None


def _plan(spark: SparkSession, log: str, numbers) -> DataFrame:
    """The planned files of some admissions."""
    folders = [fsio.join(p, "*") for p in (admission(log, n) for n in numbers) if p]
    if not folders:
        return spark.createDataFrame([], PLANNED)
    return spark.read.schema(PLANNED).parquet(*folders)


# ----------------------------------------------------------------- announcing

def cut(files: DataFrame, weight: Column, size: int, slice_size: int, order: tuple[str, ...] = ("path",)) -> DataFrame:
    """``files`` with their ``admission`` (``size`` of weight each) and ``slice``,
    by a running sum of weights in ``order``.  Every task sums its own range."""
    parts = (files.withColumn("_w", weight).repartitionByRange(range_partitions(files.sparkSession), *order).sortWithinPartitions(*order)
             .withColumn("_part", F.spark_partition_id()).withColumn("_id", F.monotonically_increasing_id()).checkpoint(eager=True))
    sums = parts.groupBy("_part").agg(F.sum("_w").alias("_sum"))  # a row per task
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    within = Window.partitionBy("_part").orderBy("_id").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_base") + F.coalesce(F.sum("_w").over(within), F.lit(0))
    return parts.join(sums, "_part").withColumn("_start", start).select(
        *files.columns, F.expr(f"_start div {size}").alias("admission"), F.expr(f"(_start % {size}) div {slice_size}").alias("slice"))


def announce(spark: SparkSession, folder: str, log: str, max_bytes: int = 8 << 30, max_files: int = 100_000,
             slice_bytes: int = 64 << 20, reader: str = "main", urls: DataFrame | None = None) -> int:
    """Plan the files of ``folder`` that were not announced before (a file with
    another length or time is a new one), and those that ``reader`` answered
    429 since the last announcement.  Returns the number of admissions added.

    A file weighs its bytes, and at least a ``max_files``-th of an admission.
    ``urls`` (name, url) is joined here by file name, once for all admissions;
    a file with several entries is planned, and read, once for each.

    The plan counts once its head is written; an announcement that fails before
    is made again from its start, as the index leaves its entries out.
    """
    heads = _heads(log)
    batch, first = len(heads), planned(log) + 1
    seen_slow = _json(heads[-1])["slow"] if heads else 0
    slow = [n for n in map(_number, _names(fsio.join(log, f"readers/{reader}/slow"))) if n > seen_slow]
    index = KeyIndex(spark, fsio.join(log, "index"))
    key = F.sha1(F.concat_ws("|", "path", F.col("length").cast("string"), F.unix_micros("modificationTime").cast("string").alias("t")))
    listed = list_spool(spark, folder).select("path", "length", "modificationTime", key.alias("sha1hex")).checkpoint(eager=True)
    new = listed.join(index.lookup(listed.select("sha1hex"), before=batch).select("sha1hex"), "sha1hex", "left_anti")
    again = None
    if slow:
        keyed = _plan(spark, log, slow).select(key.alias("sha1hex"))
        again = listed.join(keyed, "sha1hex", "left_semi")
    files = (new if again is None else new.unionByName(again)).drop("sha1hex")
    plan = f"{batch:08d}-{uuid.uuid4().hex[:8]}"
    where = fsio.join(log, f"plans/{plan}")
    weight = F.greatest(F.col("length"), F.lit(-(-max_bytes // max_files)))
    rows = cut(files, weight, max_bytes, slice_bytes)
    if urls is not None:
        named = urls.select(F.col("name").alias("_name"), "url")
        rows = rows.withColumn("_name", F.substring_index("path", "/", -1)).join(named, "_name", "left").drop("_name")
    # a slice is one file, and the slices are dealt to a fixed number of tasks, as few bytes make many files
    rows = rows.repartition(range_partitions(spark), "admission", "slice")
    rows.write.partitionBy("admission", "slice").parquet(where)
    bins = sorted(int(p.rstrip("/").rsplit("=", 1)[1]) for p, is_dir, _, _ in fsio.list_dir(where) if is_dir and "admission=" in p)
    if not bins:
        return 0
    index.add(new.select("sha1hex", F.col("length").alias("size")), batch)
    head = {"plan": plan, "first": first, "bins": bins, "slow": max(slow, default=seen_slow)}
    fsio.write_atomic(fsio.join(log, f"heads/{first + len(bins) - 1:012d}.json"), [json.dumps(head).encode()])
    return len(bins)


# ------------------------------------------------------------------ the source

class Slice(InputPartition):
    def __init__(self, files: list[str], code: int):
        super().__init__(tuple(files))
        self.files, self.code = files, code


class ArrivalsReader(DataSourceStreamReader):
    def __init__(self, options):
        self.log, self.reader = options["path"], options.get("reader", "main")
        self.max_size = int(options.get("maxSize", "0"))
        self.min_free, self.space_of = int(options.get("minFreePercent", "0")), options.get("spaceOf", "")
        self.with_url = options.get("urls", "") == "true"
        self.last = None

    def initialOffset(self):
        return {"n": 0, "code": ACCEPTED}

    def latestOffset(self):
        """One admission beyond the last that was taken."""
        if self.last is None:
            self.last = taken(self.log, self.reader)
        if self.last["n"] >= planned(self.log):
            return self.last
        return {"n": self.last["n"] + 1, "code": ACCEPTED if self._has_space() else SLOW_DOWN}

    def _has_space(self) -> bool:
        from capstan.streaming.intake import free_space_probe

        return self.min_free <= 0 or free_space_probe(self.space_of, self.min_free)()

    def partitions(self, start, end):
        self.last = {"n": end["n"], "code": end["code"]}
        own = fsio.join(self.log, f"readers/{self.reader}")
        if end["code"] == SLOW_DOWN:
            fsio.write_atomic(fsio.join(own, f"slow/{end['n']:012d}.json"), [b"{}"])
        fsio.write_atomic(fsio.join(own, "taken.json"), [json.dumps(self.last).encode()])
        out = []
        for n in range(start["n"] + 1, end["n"] + 1):
            by_slice: dict[str, list[str]] = {}
            for f in fsio.list_files(admission(self.log, n)):
                by_slice.setdefault(f.rsplit("/", 2)[1], []).append(f)
            out += [Slice(files, end["code"]) for _, files in sorted(by_slice.items())]
        return out

    def _row(self, path: str, length: int, answer: int):
        """(content, code) of one announced file."""
        if answer != ACCEPTED:
            return None, answer
        if length > (min(self.max_size, CELL_BYTES) if self.max_size > 0 else CELL_BYTES):
            return None, TOO_LARGE
        try:
            with fsio.open_read(path) as f:
                content = f.read(length + 1)
        except FileNotFoundError:
            return None, MISMATCH
        if len(content) != length:
            return None, MISMATCH
        return content, EMPTY if length == 0 else ACCEPTED

    def read(self, partition):
        import pyarrow.parquet as pq

        schema = pa.schema([("path", pa.string()), ("modificationTime", pa.timestamp("us", "UTC")), ("length", pa.int64()),
                            ("content", pa.binary()), ("code", pa.int32())] + [("url", pa.string())] * self.with_url)
        rows, held = [], 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for name in partition.files:
            with fsio.open_read(name) as f:
                listed = pq.ParquetFile(f).read()
            urls = listed.column("url").to_pylist() if "url" in listed.column_names else [None] * listed.num_rows
            times = listed.column("modificationTime").cast(pa.timestamp("us", "UTC"))
            for path, when, length, url in zip(listed.column("path").to_pylist(), times.to_pylist(), listed.column("length").to_pylist(), urls):
                content, code = self._row(path, length, partition.code)
                size = len(content or b"")
                if rows and (len(rows) == BATCH_ROWS or held + size > BATCH_BYTES):
                    yield batch()
                    rows, held = [], 0
                rows.append((path, when, length, content, code, url)[:len(schema)])
                held += size
        if rows:
            yield batch()


class ArrivalsDataSource(DataSource):
    @classmethod
    def name(cls):
        return "arrivals"

    def schema(self):
        return URL_SCHEMA if self.options.get("urls", "") == "true" else SCHEMA

    def streamReader(self, schema):
        return ArrivalsReader(self.options)


def arrivals_stream(spark: SparkSession, log: str, max_size: int = 0, min_free_percent: int = 0,
                    space_of: str | None = None, reader: str = "main", with_urls: bool = False) -> DataFrame:
    """The announced files as a stream; see the module's text for its rows.
    ``with_urls`` adds the column ``url`` that ``announce`` planned (else null).
    ``space_of`` is the (locally mounted) folder whose free space counts."""
    if min_free_percent > 0 and not space_of:
        raise ValueError("min_free_percent needs space_of")
    ship_package(spark)
    spark.dataSource.register(ArrivalsDataSource)
    return (spark.readStream.format("arrivals").option("reader", reader).option("maxSize", str(max_size))
            .option("minFreePercent", str(min_free_percent)).option("spaceOf", space_of or "")
            .option("urls", str(with_urls).lower()).load(log))


def drain(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Take every admission planned now, one a micro-batch, then stop."""
    q = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()


def remove_answered(spark: SparkSession, log: str, since: int, reader: str = "main") -> int:
    """Delete the files of the admissions after ``since`` that ``reader`` has
    taken, in tasks; files answered 429 stay, and so does a file that is no
    longer the one announced.  Returns how many were deleted."""
    slow = set(map(_number, _names(fsio.join(log, f"readers/{reader}/slow"))))
    done = _plan(spark, log, [n for n in range(since + 1, taken(log, reader)["n"] + 1) if n not in slow])

    def delete(parts):
        for p in parts:
            n = 0
            for path, length, when in zip(p["path"], p["length"], p["us"]):
                size, mtime = fsio.stat(path) or (None, None)
                if size == length and abs(round(mtime * 1e6) - when) <= 1:
                    fsio.remove(path)
                    n += 1
            yield pd.DataFrame({"n": [n]})

    gone = done.select("path", "length", F.unix_micros("modificationTime").alias("us")).distinct().mapInPandas(delete, "n bigint")
    return gone.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
