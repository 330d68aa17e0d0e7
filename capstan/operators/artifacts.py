"""Content-addressed artifacts: fan-out per successful document (K5), put
with key defaults and last-write-wins (K3, F22, F23, P17, W2), get by key
(K4, J4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capstan.functions.mime import content_type_for
from capstan.functions.paths import (
    EXPECTED_SHA1_LENGTH,
    blob_path,
    default_bucket,
    default_sha1,
    shard_prefix2,
)
from capstan.operators.derive import has_thumbnail_to_store
from capstan.session import scratch_path
from capstan.sources import fsio

# The artifact kinds a successful document produces.
# (kind, bucket, folder, extension)
ARTIFACT_KINDS = [
    ("thumbnail", "thumbnail", "pdf", "180px.jpg"),
    ("text", "sandcrawler", "text", "txt"),
    ("xml", "sandcrawler", "grobid", "tei.xml"),
]


def _content_of_kind(result: DataFrame):
    by_kind = F.when(F.col("a.kind") == "thumbnail", F.col("page0thumbnail")).when(F.col("a.kind") == "text", F.col("_text"))
    return (by_kind.otherwise(F.col("xml")) if "xml" in result.columns else by_kind).alias("content")


def fan_out(result: DataFrame, order: str = "doc_id", with_content: bool = True) -> DataFrame:
    """One row per artifact to store (K5): thumbnail when > 50 bytes, text when
    non-empty, structured XML when present.  Key, kind, type and size are
    worked out first; the content is attached only where a writer stores it
    (``with_content``)."""
    # encoded once, in a projection of its own
    ok = result.where(F.col("status") == "success").withColumn("_text", F.encode(F.col("text"), "UTF-8"))
    has_xml = "xml" in result.columns
    items = []
    for kind, bucket, folder, ext in ARTIFACT_KINDS:
        if kind == "thumbnail":
            content, present = F.col("page0thumbnail"), has_thumbnail_to_store(result)
        elif kind == "text":
            content = F.col("_text")
            present = F.octet_length(content) > 0
        else:
            if not has_xml:
                continue
            content, present = F.col("xml"), F.col("xml").isNotNull()
        items.append(
            F.when(present, F.struct(
                F.lit(kind).alias("kind"), F.lit(bucket).alias("bucket"),
                F.lit(folder).alias("folder"), F.lit(ext).alias("ext"),
                content_type_for(content, F.lit(ext)).alias("content_type"),
                F.octet_length(content).cast("bigint").alias("size"),
            ))
        )
    exploded = ok.select(*[c for c in (order, "sha1hex", "page0thumbnail", "_text", "xml") if c in ok.columns],
                         F.explode(F.array_compact(F.array(*items))).alias("a"))
    rows = exploded.select(
        order, "sha1hex", "a.kind", "a.bucket",
        blob_path(F.col("a.folder"), F.col("sha1hex"), F.col("a.ext"), F.lit("")).alias("object_path"),
        F.col("a.content_type").alias("content_type"), F.col("a.size").alias("size"),
        *([_content_of_kind(ok)] if with_content else []),
    )
    return rows


def last_write_wins(df: DataFrame, keys: list[str], order: str, cols: list[str]) -> DataFrame:
    """Per key keep the row with the greatest ``order``.

    ``max_by`` is a partial (map-side) aggregate, so a hot key costs one
    small state per task, not a shuffle of all its rows.
    """
    packed = F.struct(*[F.col(c) for c in cols])
    return df.groupBy(*keys).agg(F.max_by(packed, F.col(order)).alias("_w")).select(*keys, "_w.*")


def plan(result: DataFrame, order: str = "doc_id") -> DataFrame:
    """artifact_plan: one stored object per (bucket, object_path), last write
    wins; content is not carried through the shuffle."""
    rows = fan_out(result, order, with_content=False)
    return last_write_wins(rows, ["bucket", "object_path"], order,
                           ["sha1hex", "kind", "content_type", "size"])


def put_requests(req: DataFrame) -> DataFrame:
    """K3: resolve key defaults; invalid keys are rejected, not raised.

    ``req`` has folder, sha1hex, ext, prefix, bucket, content (+ order col).
    """
    key = default_sha1(F.col("sha1hex"), F.col("content"))
    valid = F.length(key) == EXPECTED_SHA1_LENGTH
    return req.select(
        "*",
        key.alias("_key"),
        default_bucket(F.col("bucket")).alias("_bucket"),
        F.when(valid, F.lit("ok")).otherwise(F.lit("invalid-hash")).alias("put_status"),
    ).select(
        *[c for c in req.columns if c not in ("bucket",)],
        F.col("_bucket").alias("bucket_resolved"),
        F.when(F.col("put_status") == "ok",
               blob_path(F.col("folder"), F.col("_key"), F.col("ext"), F.col("prefix"))).alias("object_path"),
        F.col("_key").alias("key"),
        "put_status",
    )


def stored(puts: DataFrame, order: str) -> DataFrame:
    """The store after all puts: last write per (bucket, object_path)."""
    ok = puts.where(F.col("put_status") == "ok").select(
        F.col("bucket_resolved").alias("bucket"), "object_path", order,
        F.sha1("content").alias("content_sha1"),
        F.octet_length("content").cast("bigint").alias("size"),
        shard_prefix2(F.substring_index(F.col("object_path"), "/", -1)).alias("shard"),
    )
    return last_write_wins(ok, ["bucket", "object_path"], order, ["content_sha1", "size", "shard"])


def get(store: DataFrame, requests: DataFrame) -> DataFrame:
    """Requests (bucket, object_path) joined to the store.

    The shard column (first two key characters) is added to the join so a
    store partitioned by shard is pruned.
    """
    req = requests.withColumn(
        "shard", shard_prefix2(F.substring_index(F.col("object_path"), "/", -1))
    )
    return req.join(store, ["bucket", "object_path", "shard"], "left")


def write_store(store: DataFrame, path: str) -> None:
    """Persist the store partitioned by (bucket, shard): a lookup that joins
    on the shard reads only the requested shards (dynamic partition
    pruning)."""
    store.write.mode("overwrite").partitionBy("bucket", "shard").parquet(path)


def merge_into(path: str, puts: DataFrame, order: str, batch: int) -> None:
    """K3/W2 onto a stored table: the puts of a batch join the store under
    ``path`` (partitioned by bucket and shard), last write wins.

    Only the partitions that the batch touches are read and rewritten; the
    others' files stay as they are.  The new partitions are staged in full and
    then swapped in by Spark's commit (dynamic partition overwrite).  A write is
    later by its batch, then by ``order``; a batch that is put again, as after a
    failure, gives the same store.
    """
    spark = puts.sparkSession
    new = stored(puts, order).select("bucket", "object_path", "content_sha1", "size", F.lit(batch).cast("bigint").alias("batch"), "shard")
    staged = scratch_path(spark, "store-batch")
    new.write.parquet(staged)  # hashed once
    rows = new = spark.read.parquet(staged)
    if fsio.exists(path):
        touched = new.select("bucket", "shard").distinct()
        rows = spark.read.schema(new.schema).parquet(path).join(touched, ["bucket", "shard"], "left_semi").unionByName(new)
    merged = last_write_wins(rows, ["bucket", "object_path", "shard"], "batch", ["content_sha1", "size", "batch"])
    target = scratch_path(spark, "store-merged")
    merged.write.parquet(target)  # a store that is read cannot be written at once
    done = spark.read.schema(merged.schema).parquet(target)
    (done.select("object_path", "content_sha1", "size", "batch", "bucket", "shard").repartition("bucket", "shard")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "shard").parquet(path))
