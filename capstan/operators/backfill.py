"""Work still to do: worklist minus finished (U3) and index rows without an
artifact (J9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pending(work: DataFrame, finished: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``work`` whose key is not in ``finished`` (left anti join)."""
    return work.join(finished.select(*keys).distinct(), keys, "left_anti")


def backfill_plan(index: DataFrame, url_map: DataFrame) -> DataFrame:
    """Index records whose URL has no entry in the URL map, per capture
    file: number of records and compressed bytes to fetch."""
    todo = index.join(url_map.select("url").distinct(), "url", "left_anti")
    return todo.groupBy("filename").agg(
        F.count(F.lit(1)).cast("bigint").alias("records"),
        F.sum("compressed_record_size").cast("bigint").alias("bytes"),
    )
