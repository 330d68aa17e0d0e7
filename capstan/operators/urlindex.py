"""URL map as an index (J5, K9): two bucketed copies of its distinct pairs.

``by_url`` is bucketed and sorted on the URL, ``by_sha1`` on the hash, so a
lookup joins each copy where it lies: only the asked URLs and their hits are
exchanged, never the map.  Adding is idempotent: pairs that a copy has already
are left out, copy by copy, so a batch that failed between the two is simply
added again.  The bucket number is fixed when the index is made; choose it for
the size the map will have (a bucket is the unit a task joins).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capstan.sources import fsio

KEYS = {"by_url": "url", "by_sha1": "sha1"}


class UrlIndex:
    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path, buckets
        # one table name per folder, so that several indexes live side by side in a catalog
        self.tag = "url_index_" + hashlib.sha1(path.encode()).hexdigest()[:12]

    def copy(self, name: str) -> DataFrame:
        """One copy as a bucketed table (its files, whoever wrote them)."""
        key, folder = KEYS[name], fsio.join(self.path, name)
        full = f"{self.tag}_{name}"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {full} (url STRING, sha1 STRING) USING parquet "
                       f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {self.buckets} BUCKETS LOCATION '{folder}'")
        self.spark.catalog.refreshTable(full)
        return self.spark.table(full)

    def add(self, rows: DataFrame) -> None:
        """Adds the pairs (url, sha1) that are not there yet; rows without a URL
        or a hash are no pairs."""
        pairs = rows.where("url IS NOT NULL AND sha1 IS NOT NULL").select("url", "sha1").distinct()
        for name, key in KEYS.items():
            held, other = self.copy(name), next(c for c in ("url", "sha1") if c != key)
            # the second column is compared, but kept out of the join's keys: the buckets are dealt by the first
            same = (F.col(f"n.{key}") == F.col(f"h.{key}")) & ~((F.col(f"n.{other}") < F.col(f"h.{other}")) | (F.col(f"n.{other}") > F.col(f"h.{other}")))
            new = pairs.alias("n").join(held.alias("h"), same, "left_anti").select("url", "sha1")
            (new.repartition(self.buckets, key).sortWithinPartitions(key)
             .write.format("parquet").mode("append").bucketBy(self.buckets, key).sortBy(key).saveAsTable(f"{self.tag}_{name}"))
            self.spark.catalog.refreshTable(f"{self.tag}_{name}")

    def lookup(self, urls: DataFrame) -> DataFrame:
        """``urls`` that are in the map: url -> sha1 with the number of distinct
        URLs seen for that sha1 (``urls_per_sha1``)."""
        hits = urls.join(self.copy("by_url"), "url")
        # dealt like the copy's buckets, so that Spark does not deal the copy anew
        asked = hits.select("sha1").distinct().repartition(self.buckets, "sha1")
        per = self.copy("by_sha1").join(asked, "sha1", "left_semi").groupBy("sha1").agg(F.count("*").cast("bigint").alias("urls_per_sha1"))
        return hits.join(per, "sha1")
