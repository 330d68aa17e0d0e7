"""Content-addressed storage (K1) and plain folders (K2).

``write_hashdir`` stores each distinct content once, named by its digest and
partitioned by a shard function of the digest.  Duplicates are removed by a
key-only aggregation first (digest -> first row), so the payload itself is
never shuffled for deduplication: the digests are shuffled, and the bytes are
written from the side that read them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capstan.functions.hashing import hash_hex
from capstan.functions.paths import shard_prefix2


def with_digest(df: DataFrame, content: str = "content", hash_name: str = "sha1",
                shard: Callable[[Column], Column] = shard_prefix2, ext: str = "") -> DataFrame:
    """Add ``digest``, ``shard`` and ``file_name``."""
    d = df.withColumn("digest", hash_hex(F.col(content), hash_name))
    return d.withColumn("shard", shard(F.col("digest"))).withColumn(
        "file_name", F.concat(F.col("digest"), F.lit(ext))
    )


def layout(df: DataFrame, content: str = "content", hash_name: str = "sha1",
           shard: Callable[[Column], Column] = shard_prefix2) -> DataFrame:
    """Per shard: number of distinct objects and their bytes."""
    d = with_digest(df.select(content), content, hash_name, shard)
    per_obj = d.groupBy("shard", "digest").agg(F.first(F.octet_length(content)).alias("size"))
    return per_obj.groupBy("shard").agg(
        F.count(F.lit(1)).cast("bigint").alias("files"), F.sum("size").cast("bigint").alias("bytes")
    )


def write_hashdir(df: DataFrame, path: str, content: str = "content", hash_name: str = "sha1",
                  shard: Callable[[Column], Column] = shard_prefix2, ext: str = "") -> DataFrame:
    """K1: one file per distinct content at ``path/{shard}/{digest}{ext}``.

    No shuffle: every task writes the rows it read.  Equal content has an
    equal name and equal bytes, so a second write of it (another copy, or a
    retried task) replaces the file with itself, as in the reference.
    Returns the (shard, digest, file_name) rows that were written.
    """
    from capstan.sinks.blobdir import write_blobs

    d = with_digest(df.select(content), content, hash_name, shard, ext)
    rel = F.when(F.col("shard") == "", F.col("file_name")).otherwise(
        F.concat(F.col("shard"), F.lit("/"), F.col("file_name")))
    write_blobs(d.select(rel.alias("path"), F.col(content).alias("content")), path)
    return d.drop(content)


def write_hashdir_table(df: DataFrame, path: str, order: str, content: str = "content",
                        hash_name: str = "sha1", shard: Callable[[Column], Column] = shard_prefix2) -> None:
    """K1 as a table: one row per digest (the first by ``order``), partitioned
    by shard.  Only (digest, order) pairs are aggregated; the chosen rows
    are selected with a semi join, so the bytes never pass through the
    de-duplicating aggregate."""
    d = with_digest(df, content, hash_name, shard)
    first = d.groupBy("digest").agg(F.min(order).alias(order))
    d.join(first, ["digest", order], "left_semi").write.mode("overwrite").partitionBy("shard").parquet(path)


def dir_export(df: DataFrame, content: str = "body", size: str = "size",
               prefix: str = "", extension: str = "", name_cols: tuple[str, ...] = ("warc_file", "record_idx")) -> DataFrame:
    """K2: a generated name per row and the body cut at the declared size
    when that is > 0 (O3); ``truncated`` says where bytes were left out.

    The name is derived from the row's identity (prefix, file, record,
    extension) rather than drawn at random, so a retried task writes the
    same names instead of leaving duplicates.
    """
    n = F.least(F.col(size), F.lit(2**31 - 1)).cast("int")
    cut = F.when(F.col(size) > 0, F.substring(F.col(content), F.lit(1), n)).otherwise(F.col(content))
    name = F.concat(F.lit(prefix), F.concat_ws("-", *[F.col(c).cast("string") for c in name_cols]), F.lit(extension))
    truncated = F.coalesce((F.col(size) > 0) & (F.octet_length(content) > F.col(size)), F.lit(False))
    return df.withColumn("file_name", name).withColumn("written", cut).withColumn("truncated", truncated)


def write_dir_export(df: DataFrame, root: str, **kw) -> DataFrame:
    """K2: write the exported bodies as files under ``root``."""
    from capstan.sinks.blobdir import write_blobs

    out = dir_export(df, **kw)
    write_blobs(out.select(F.col("file_name").alias("path"), F.col("written").alias("content")), root)
    return out.drop("written")
