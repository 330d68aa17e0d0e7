"""URL map: append (url, sha1) pairs with arrival time (K9, F21) and look
them up (J5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capstan.functions.paths import first_nonempty


def url_map_rows(arrivals: DataFrame, url_cols: list[Column], sha1: Column) -> DataFrame:
    """One row per arrival that names a URL (first non-empty of the header
    columns); duplicates are kept, as in an append-only table."""
    url = first_nonempty(*url_cols)
    rows = arrivals.select(url.alias("url"), sha1.alias("sha1"))
    return rows.where(F.col("url").isNotNull()).withColumn("timestamp", F.current_timestamp())


def append_url_map(rows: DataFrame, path: str) -> None:
    """K9: append to the URL map table (parquet folder)."""
    rows.select("url", "sha1", "timestamp").write.mode("append").parquet(path)


def lookup(urls: DataFrame, url_map: DataFrame) -> DataFrame:
    """Url -> sha1 with the number of distinct URLs seen for that sha1.

    The per-sha1 count is a partial aggregate joined back on sha1 (a hot
    sha1 is split by AQE's skew join, where a window would sort all its rows
    in one task).
    """
    pairs = url_map.select("url", "sha1").distinct()
    per_sha1 = pairs.groupBy("sha1").agg(F.count(F.lit(1)).cast("bigint").alias("urls_per_sha1"))
    hit = urls.join(pairs, "url", "inner")
    return hit.join(per_sha1, "sha1", "inner")
