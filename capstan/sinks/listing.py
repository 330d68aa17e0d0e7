"""JSON-lines spool listing (K7) from a file listing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capstan.functions.paths import rfc3339, sharded_path_to_id, spool_url


def spool_entries(listing: DataFrame, listen_addr: str) -> DataFrame:
    """{name, size, t, url} per file, in path order (O2)."""
    name = sharded_path_to_id(F.col("path"))
    return listing.orderBy("path").select(
        name.alias("name"), F.col("length").alias("size"),
        rfc3339(F.col("modificationTime")).alias("t"), spool_url(F.lit(listen_addr), name).alias("url"),
    )


def write_listing(listing: DataFrame, path: str, listen_addr: str) -> None:
    spool_entries(listing, listen_addr).write.mode("overwrite").json(path)
