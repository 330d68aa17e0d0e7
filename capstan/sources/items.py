"""Archive item metadata (S4, M6) and collection search pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from capstan.functions.paths import download_url

S = T.StringType()

# Field names of the item metadata documents (fixed values).
FILE_FIELDS = ["crc32", "format", "md5", "mtime", "name", "original", "private", "sha1", "size",
               "source", "summation"]
META_STRING_FIELDS = [
    "access-restricted-item", "addeddate", "contributor", "crawler", "crawljob", "creator", "date",
    "description", "firstfiledate", "firstfileserial", "identifier", "identifier-access", "imagecount",
    "lastdate", "lastfiledate", "lastfileserial", "mediatype", "operator", "publicdate", "scandate",
    "scanningcenter", "sizehint", "sponsor", "subject", "title", "uploader",
]

ITEM_SCHEMA = T.StructType([
    T.StructField("created", T.LongType()),
    T.StructField("d1", S), T.StructField("d2", S), T.StructField("dir", S),
    T.StructField("files", T.ArrayType(T.StructType([T.StructField(f, S) for f in FILE_FIELDS]))),
    T.StructField("files_count", T.LongType()),
    T.StructField("item_last_updated", T.LongType()),
    T.StructField("item_size", T.LongType()),
    T.StructField("metadata", T.StructType(
        [T.StructField(f, S) for f in META_STRING_FIELDS]
        + [T.StructField("collection", T.ArrayType(S)), T.StructField("collection_added", T.ArrayType(S))]
    )),
    T.StructField("server", S),
    T.StructField("uniq", T.LongType()),
    T.StructField("workable_servers", T.ArrayType(S)),
])

SEARCH_SCHEMA = T.StructType([
    T.StructField("items", T.ArrayType(T.StructType([T.StructField("identifier", S)]))),
    T.StructField("count", T.LongType()),
    T.StructField("total", T.LongType()),
    T.StructField("cursor", S),
])


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """Item metadata documents (one JSON object per line) with a fixed schema."""
    return spark.read.schema(ITEM_SCHEMA).json(path)


def item_files(items: DataFrame, suffix: str = ".warc.gz") -> DataFrame:
    """Capture files of each item with their download URL,
    position in the item's file list (W4) and the list length."""
    captures = F.size(F.filter("files", lambda f: F.endswith(f["name"], F.lit(suffix))))
    x = items.select(F.col("metadata.identifier").alias("identifier"), "files_count",
                     F.posexplode("files").alias("pos", "f"), F.size("files").alias("total"),
                     captures.alias("files"))
    x = x.where(F.endswith(F.col("f.name"), F.lit(suffix)))
    return x.select(
        "identifier", F.col("f.name").alias("name"),
        (F.col("pos") + 1).cast("bigint").alias("position"), F.col("total").cast("bigint").alias("total"),
        F.col("files").cast("bigint").alias("files"),
        F.col("f.size").try_cast("bigint").alias("size"),
        download_url(F.col("identifier"), F.col("f.name")).alias("file_url"),
    )


def items_per_collection(items: DataFrame) -> DataFrame:
    """A4: number of items in each collection an item names."""
    x = items.select(F.explode("metadata.collection").alias("collection"))
    return x.groupBy("collection").agg(F.count(F.lit(1)).cast("bigint").alias("items"))


def read_search_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed search result pages, one JSON object per line with its
    ``page_no`` (fetch order)."""
    schema = T.StructType([T.StructField("page_no", T.LongType()), *SEARCH_SCHEMA.fields])
    return spark.read.schema(schema).json(path)


def collection_items(pages: DataFrame) -> DataFrame:
    """Identifiers of pages up to and including the first page whose
    cursor is empty or which has no items (pages after it are not read)."""
    empty = F.col("items").isNull() | (F.size("items") == 0)
    stop = F.when((F.coalesce(F.col("cursor"), F.lit("")) == "") | empty, F.col("page_no"))
    # a scalar subquery: one value, no join
    last = pages.agg(F.coalesce(F.min(stop), F.lit(2**62)).alias("_last")).scalar()
    kept = pages.where(F.col("page_no") <= last)
    return kept.select("page_no", F.explode("items").alias("it")).select(
        "page_no", F.col("it.identifier").alias("identifier"))
