"""A spool index (T4, J1): levelled runs of keys with Bloom filters.

Looking up a micro-batch of content hashes must not read the history.  Every
batch adds one run; a run is split into buckets by the leading bits of the key,
each bucket a sorted file of at most about ``bucket_rows`` entries with a Bloom
filter beside it.  When ``fanout`` runs of a level are there, they are merged
into one run of the next level (the latest batch wins), so a spool of n batches
is a few times log(n) runs.  A lookup reads the filters and then only the
buckets whose filter admits one of its keys.

A manifest file names the live runs; it is written last, under a new number, so
a failed ``add`` changes nothing and a repeated one replaces its own run.  A
batch's run is merged only by a later batch, so a batch that is tried again
never meets its own entries.  Data stay in Spark; the driver handles the
manifest.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from capstan.sources import fsio

ENTRY = "key binary, size bigint, batch bigint"
FILTER = "run string, bucket int, n bigint, bits binary"


def bucket_of(key: Column, bits: int) -> Column:
    """The leading ``bits`` (up to 24) of a binary key."""
    head = F.conv(F.hex(F.rpad(F.substring(key, 1, 3), 3, b"\x00")), 16, 10).cast("int")
    return F.shiftright(head, 24 - bits)


def _positions(keys: list[bytes], slots: int, probes: int) -> np.ndarray:
    """Places of each key in a filter of ``slots`` bits.  Keys are digests, so
    two words of the key itself are hash values enough."""
    raw = np.frombuffer(b"".join(k[:20].ljust(20, b"\0") for k in keys), np.uint8).reshape(-1, 20)
    a, b = (raw[:, i:i + 8].copy().view("<u8")[:, 0] for i in (3, 11))
    step = b | np.uint64(1)
    return ((a[:, None] + np.arange(probes, dtype=np.uint64) * step[:, None]) % np.uint64(slots)).astype(np.int64)


def bloom(keys: list[bytes], bits_per_key: int) -> bytes:
    slots = max(64, -(-len(keys) * bits_per_key // 8) * 8)
    table = np.zeros(slots, np.uint8)
    table[_positions(keys, slots, probes(bits_per_key)).ravel()] = 1
    return np.packbits(table).tobytes()


def probes(bits_per_key: int) -> int:
    return max(1, round(bits_per_key * 0.69))


def admits(bits: bytes, keys: list[bytes], bits_per_key: int) -> np.ndarray:
    """For each key whether the filter may hold it; never false for one it holds."""
    at = _positions(keys, 8 * len(bits), probes(bits_per_key))
    return ((np.frombuffer(bits, np.uint8)[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=1)


class KeyIndex:
    """Index of (sha1hex, size) by batch under ``path``.  The newest batch of a
    hash gives its size."""

    def __init__(self, spark: SparkSession, path: str, fanout: int = 8, bucket_rows: int = 1 << 18, bits_per_key: int = 12):
        self.spark, self.path, self.fanout, self.bucket_rows, self.bits_per_key = spark, path, fanout, bucket_rows, bits_per_key

    # -- manifest ------------------------------------------------------------

    def _manifests(self) -> list[str]:
        folder = fsio.join(self.path, "manifest")
        return fsio.list_files(folder) if fsio.exists(folder) else []

    def runs(self) -> list[dict]:
        """Live runs: name, level, bits, rows and the batches they cover."""
        files = self._manifests()
        if not files:
            return []
        with fsio.open_read(files[-1]) as f:
            return json.loads(f.read())

    def _commit(self, runs: list[dict]) -> None:
        files = self._manifests()
        number = int(files[-1].rsplit("/", 1)[1].split(".")[0]) + 1 if files else 0
        fsio.write_atomic(fsio.join(self.path, f"manifest/{number:012d}.json"), [json.dumps(runs).encode()])

    def vacuum(self) -> list[str]:
        """Removes the files of runs that the manifest no longer names (call it
        when no lookup is under way); returns their names."""
        live, gone = {r["name"] for r in self.runs()}, set()
        for kind in ("runs", "filters"):
            folder = fsio.join(self.path, kind)
            for f in fsio.list_files(folder) if fsio.exists(folder) else []:
                name = f[len(folder):].strip("/").split("/")[0].removeprefix("run=")
                if name not in live:
                    fsio.remove(f)
                    gone.add(name)
        return sorted(gone)

    # -- runs ----------------------------------------------------------------

    def _run_path(self, kind: str, name: str) -> str:
        return fsio.join(self.path, f"{kind}/run={name}")

    def _read(self, runs: list[dict]) -> DataFrame:
        return self.spark.read.schema(ENTRY).parquet(*(fsio.join(self._run_path("runs", r["name"]), "*") for r in runs))

    def _write(self, entries: DataFrame, rows: int, name: str, level: int, batches: list[int]) -> dict:
        bits = max(0, min(24, (max(1, rows) // self.bucket_rows).bit_length()))
        data, per_key = self._run_path("runs", name), self.bits_per_key
        (entries.withColumn("bucket", bucket_of(F.col("key"), bits)).repartition("bucket").sortWithinPartitions("bucket", "key")
         .write.mode("overwrite").partitionBy("bucket").parquet(data))

        def build(group: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"run": [name], "bucket": [int(group["bucket"].iloc[0])], "n": [len(group)],
                                 "bits": [bloom(list(group["key"]), per_key)]})

        stored = self.spark.read.schema(ENTRY + ", bucket int").parquet(data)
        filters = stored.select("bucket", "key").groupBy("bucket").applyInPandas(build, FILTER)
        filters.write.mode("overwrite").option("compression", "none").parquet(self._run_path("filters", name))
        return {"name": name, "level": level, "bits": bits, "rows": rows, "batches": batches}

    def add(self, entries: DataFrame, batch: int, rows: int | None = None) -> None:
        """Adds the entries (sha1hex, size; one per hash) of a batch, ``rows`` of
        them if the caller knows.  Before that, full levels of earlier batches
        are merged.  An empty batch adds nothing; adding a batch again replaces
        it."""
        runs = [r for r in self.runs() if r["batches"] != [batch, batch]]
        runs = self._compacted(runs, batch)
        rows = entries.count() if rows is None else rows
        if rows:
            keyed = entries.select(F.unhex("sha1hex").alias("key"), F.col("size").cast("bigint"), F.lit(batch).cast("bigint").alias("batch"))
            runs.append(self._write(keyed, rows, f"l0-{batch}", 0, [batch, batch]))
        self._commit(runs)

    def _compacted(self, runs: list[dict], batch: int) -> list[dict]:
        level = 0
        while any(r["level"] >= level for r in runs):
            own = [r for r in runs if r["level"] == level]
            if len(own) >= self.fanout:
                span = [min(r["batches"][0] for r in own), max(r["batches"][1] for r in own)]
                merged = self._read(own).groupBy("key").agg(F.max_by("size", "batch").alias("size"), F.max("batch").alias("batch"))
                new = self._write(merged, sum(r["rows"] for r in own), f"l{level + 1}-{span[0]}-{span[1]}", level + 1, span)
                runs = [r for r in runs if r not in own] + [new]
            level += 1
        return runs

    # -- lookup --------------------------------------------------------------

    def candidates(self, keys: DataFrame, runs: list[dict]) -> DataFrame:
        """(key, run, bucket) that the filters admit."""
        per_key = self.bits_per_key
        where = F.array(*(F.struct(F.lit(r["name"]).alias("run"), bucket_of(F.col("key"), r["bits"]).alias("bucket")) for r in runs))
        asked = keys.select("key", F.explode(where).alias("w")).select("key", "w.run", "w.bucket")
        filters = self.spark.read.schema(FILTER).parquet(*(self._run_path("filters", r["name"]) for r in runs))

        def check(own: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
            if not len(own) or not len(held):
                return own.iloc[:0]
            return own[admits(held["bits"].iloc[0], list(own["key"]), per_key)]

        return asked.groupBy("run", "bucket").cogroup(filters.select("run", "bucket", "bits").groupBy("run", "bucket")).applyInPandas(
            check, "key binary, run string, bucket int")

    def lookup(self, hashes: DataFrame, before: int | None = None) -> DataFrame:
        """(sha1hex, stored_size) of the ``hashes`` (sha1hex) in the index, or
        in its batches below ``before``.  Null hashes have no entry."""
        empty = self.spark.createDataFrame([], "sha1hex string, stored_size bigint")
        runs = [r for r in self.runs() if before is None or r["batches"][0] < before]
        if not runs:
            return empty
        keys = hashes.where("sha1hex IS NOT NULL").select(F.unhex("sha1hex").alias("key")).distinct()
        found = self.candidates(keys, runs).checkpoint(eager=True)
        root = fsio.join(self.path, "runs")

        def fetch(own: pa.Table) -> pa.Table:
            wanted = own["key"].combine_chunks().cast(pa.binary())
            folder = fsio.join(root, f"run={own['run'][0].as_py()}/bucket={own['bucket'][0].as_py()}")
            files = fsio.list_files(folder)
            if not files:  # a bucket with a filter has entries
                raise FileNotFoundError(folder)
            parts = []
            for name in files:
                with fsio.open_read(name) as f:
                    held = pq.ParquetFile(f).read(columns=["key", "size", "batch"])
                parts.append(held.filter(pc.is_in(held["key"], value_set=wanted)))
            return pa.concat_tables(parts)

        # a bucket is read by the task that holds its keys: neither these nor the names of buckets pass the driver
        hits = found.groupBy("run", "bucket").applyInArrow(fetch, ENTRY)
        if before is not None:
            hits = hits.where(F.col("batch") < before)
        return hits.groupBy("key").agg(F.max_by("size", "batch").alias("stored_size")).select(F.lower(F.hex("key")).alias("sha1hex"), "stored_size")
