"""Stateful intake (T3, J1): skip, overwrite or insert for every arrival,
decided across micro-batches from keyed state.

The state is the stored size of every content hash, kept by the
``transformWithState`` operator in RocksDB; it survives a restart through the
query's checkpoint, and with a ``ttl`` a hash is forgotten that long after its
last arrival, so the state of an endless intake stays bounded.  Entries of a
spool that was filled before come in as initial state.

A call of the operator costs far more than a row, so the hashes are dealt to a
fixed number of ``buckets`` by their CRC: one state value, read and written once
a micro-batch, holds the hashes of a bucket.  Give more buckets for an intake
that holds more than some hundred million hashes.

Only key columns reach the operator.  Arrivals that need no state go past it
under spread keys: rejected ones, and repeats of a hash within one Arrow batch,
whose first arrival settles them; so a hash that a third of all arrivals carry
sends a few rows per task, not all of them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from capstan.operators.intake import ACCEPTED, EMPTY, MISMATCH, TOO_LARGE, validate

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DECISIONS = "path string, sha1hex string, size bigint, action string, code int"
CODES = {"too-large": TOO_LARGE, "empty": EMPTY, "length-mismatch": MISMATCH}
PAST, SPREAD = "past-", 4096  # keys of rows that need no state
BUCKETS = 4096
HELD = "hashes array<string>, sizes array<bigint>, untils array<bigint>"


def state_session(spark: SparkSession) -> SparkSession:
    """A session of the same application that keeps state in RocksDB; the
    caller's own session settings stay as they are."""
    own = spark.newSession()
    for key, value in {**dict(_settings(spark)), "spark.sql.streaming.stateStore.providerClass": ROCKSDB}.items():
        own.conf.set(key, value)
    return own


def _settings(spark: SparkSession) -> Iterator[tuple[str, str]]:
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone", "spark.sql.ansi.enabled",
                "spark.sql.execution.arrow.maxRecordsPerBatch"):
        value = spark.conf.get(key, None)
        if value is not None:
            yield key, value


def keyed(arrivals: DataFrame, max_size: int = 0, buckets: int = BUCKETS) -> DataFrame:
    """Arrivals (path, sha1hex, size, declared, arrived) with the key (the
    bucket of the hash) they are decided under and, where that is settled already, their ``action``."""
    checked = validate(arrivals, max_size).select("path", "sha1hex", "size", "arrived", F.col("reject").alias("action"))

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b = b.sort_values("path", kind="stable").reset_index(drop=True)
            valid = b["action"].isna()
            again = valid & b[valid].duplicated(["sha1hex", "size"]).reindex(b.index, fill_value=False)
            b.loc[again, "action"] = "skip"
            spread = PAST + b["path"].map(lambda p: str(zlib.crc32((p or "").encode()) % SPREAD))
            own = b["sha1hex"].map(lambda h: str(zlib.crc32((h or "").encode()) % buckets), na_action=None)
            b["key"] = own.where(b["action"].isna(), spread)
            yield b

    return checked.mapInPandas(settle, "path string, sha1hex string, size bigint, arrived timestamp, action string, key string")


class Decide(StatefulProcessor):
    """J1 for the arrivals of the hashes of one bucket."""

    def __init__(self, ttl_ms: int | None):
        self.ttl_ms = ttl_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", HELD)

    def _entries(self) -> dict[str | None, tuple[int | None, int]]:
        """Hash -> (stored size, when it ends; 0: never)."""
        held = self.held.get()
        return {} if held is None else {h: (s, u) for h, s, u in zip(*held)}

    def _keep(self, entries: dict) -> None:
        if entries:
            self.held.update((list(entries), [s for s, _ in entries.values()], [u for _, u in entries.values()]))
        else:
            self.held.clear()

    def handleInitialState(self, key, initialState, timerValues) -> None:
        entries = self._entries()
        for hashes, sizes in zip(initialState["hashes"], initialState["sizes"]):
            entries.update((h, (_whole(s), 0)) for h, s in zip(hashes, sizes))
        self._keep(entries)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if key[0].startswith(PAST):
            for b in rows:
                yield self._out(b, list(b["action"]))
            return
        b = pd.concat(list(rows)).sort_values("path", kind="stable")  # of a hash, one row per Arrow batch at most
        entries, actions, ends = self._entries(), [], set()
        for h, size, arrived in zip(b["sha1hex"], map(_whole, b["size"]), b["arrived"]):
            h = h if isinstance(h, str) else None
            held = entries.get(h)
            actions.append("insert" if held is None else "skip" if held[0] == size else "overwrite")
            until = 0 if held is None else held[1]
            if self.ttl_ms is not None:
                until = max(until, int(arrived.timestamp() * 1000) + self.ttl_ms)
                ends.add(until)
            entries[h] = (size, until)
        for until in ends:  # one that an entry has moved on from finds nothing to end
            self.handle.registerTimer(until)
        self._keep(entries)
        yield self._out(b, actions)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at = expiredTimerInfo.getExpiryTimeInMs()
        self._keep({h: v for h, v in self._entries().items() if v[1] != at})
        return iter(())

    def close(self) -> None:
        pass

    @staticmethod
    def _out(b: pd.DataFrame, actions: list[str]) -> pd.DataFrame:
        return pd.DataFrame({"path": b["path"], "sha1hex": b["sha1hex"], "size": b["size"], "action": actions,
                             "code": [CODES.get(a, ACCEPTED) for a in actions]})


def _whole(size) -> int | None:
    return None if size is None or size != size else int(size)


def decisions(arrivals: DataFrame, max_size: int = 0, ttl: str | None = None, stored: DataFrame | None = None,
              buckets: int = BUCKETS) -> DataFrame:
    """One row per arrival of a stream: path, sha1hex, size, action, code.

    ``arrivals``: path, sha1hex, size, declared and ``arrived``, the time that
    the ``ttl`` (such as "30 days") counts from; without a ``ttl`` the state
    keeps every hash.  The first valid arrival of a hash inserts, one of another
    size overwrites, equal ones are skipped; within a micro-batch arrivals count
    in the order of their paths.  ``stored`` (sha1hex, stored_size, one row per
    hash) is what the spool holds at the first start; it does not expire unless
    it arrives again.  Give times of arrival that do not run back (the source's
    own clock): with a ``ttl``, rows behind the watermark count as late.
    ``buckets`` stays the same for the life of a checkpoint.
    """
    rows = keyed(arrivals, max_size, buckets)
    ttl_ms = None if ttl is None else int(pd.Timedelta(ttl).total_seconds() * 1000)
    if ttl is not None:
        rows = rows.withWatermark("arrived", "0 seconds")
    first = None
    if stored is not None:
        bucket = (F.crc32(F.coalesce("sha1hex", F.lit("")).cast("binary")) % buckets).cast("string").alias("key")
        first = stored.select(bucket, F.struct("sha1hex", F.col("stored_size").cast("bigint").alias("stored_size")).alias("e")).groupBy("key").agg(F.collect_list("e").alias("e"))
        first = first.select("key", F.col("e.sha1hex").alias("hashes"), F.col("e.stored_size").alias("sizes")).groupBy("key")
    return rows.groupBy("key").transformWithStateInPandas(
        Decide(ttl_ms), DECISIONS, "Append", "None" if ttl is None else "EventTime", initialState=first)


def run_intake(arrivals: DataFrame, out: str, checkpoint: str, **options) -> None:
    """Decide all arrivals available now and append them to the table ``out``,
    exactly once (file sink with its commit log)."""
    q = (decisions(arrivals, **options).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
