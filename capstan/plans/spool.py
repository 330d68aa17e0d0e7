"""Catalogue queries for intake, the spool, the URL map and artifact put/get."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capstan.functions.paths import blob_path, sharded_path
from capstan.operators import artifacts, intake, urlmap
from capstan.plans.registry import query
from capstan.session import scratch_path
from capstan.sinks.blobdir import write_blobs
from capstan.sinks.listing import spool_entries
from capstan.sources.spool import list_spool
from capstan.tables import table

MAX_SIZE = 20_000  # intake limit at fixture scale
LISTEN = "localhost:8000"
EPOCH_2024 = 1704067200


def _docs(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.withColumn("content", F.encode("text", "UTF-8")).withColumn("sha1hex", F.sha1("content")).withColumn(
        "size", F.octet_length("content").cast("bigint"))


def spool_table(spark: SparkSession, sf_dir: str, all_docs: bool = False) -> DataFrame:
    """Queued blobs (those already stored: doc_id even; or every document):
    one object per hash, last write wins; a file whose doc_id % 16 = 4 was cut
    short by one byte."""
    d = _docs(spark, sf_dir)
    d = d if all_docs else d.where(F.pmod("doc_id", F.lit(2)) == 0)
    stored = F.col("size") - F.when(F.pmod("doc_id", F.lit(16)) == 4, 1).otherwise(0)
    d = d.select("doc_id", "sha1hex", stored.alias("stored_size"),
                 F.timestamp_seconds(F.lit(EPOCH_2024) + F.col("doc_id") * 60).alias("mtime"))
    return artifacts.last_write_wins(d, ["sha1hex"], "doc_id", ["stored_size", "mtime", "doc_id"])


SPOOL_SQL = """
sp AS (
  SELECT sha1(text) AS h,
         arg_max(strlen(text) - CASE WHEN doc_id % 16 = 4 THEN 1 ELSE 0 END, doc_id) AS stored,
         max(doc_id) AS last_doc
  FROM documents WHERE doc_id % 2 = 0 GROUP BY 1
)"""


@query("intake_actions", sql="""
WITH """ + SPOOL_SQL + f""",
ar AS (SELECT doc_id, sha1(text) AS h, strlen(text) AS size,
              strlen(text) + CASE WHEN doc_id % 23 = 4 THEN 1 ELSE 0 END AS declared
       FROM documents WHERE doc_id % 2 = 1 OR doc_id % 8 IN (0, 4)),
v AS (SELECT ar.*, CASE WHEN declared > {MAX_SIZE} OR size > {MAX_SIZE} THEN 'too-large'
                        WHEN size = 0 THEN 'empty'
                        WHEN size <> declared THEN 'length-mismatch' END AS reject FROM ar),
r AS (SELECT v.*, sp.stored,
             min(CASE WHEN reject IS NULL THEN doc_id END) OVER (PARTITION BY v.h) AS first_valid
      FROM v LEFT JOIN sp ON v.h = sp.h)
SELECT doc_id,
  CASE WHEN reject IS NOT NULL THEN reject
       WHEN stored IS NOT NULL AND stored = size THEN 'skip'
       WHEN doc_id <> first_valid THEN 'skip'
       WHEN stored IS NOT NULL THEN 'overwrite' ELSE 'insert' END AS action,
  CASE reject WHEN 'too-large' THEN 413 WHEN 'empty' THEN 400 WHEN 'length-mismatch' THEN 500 ELSE 202 END AS code
FROM r
""")
def q_intake_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _docs(spark, sf_dir)
    arrivals = d.where((F.pmod("doc_id", F.lit(2)) == 1) | F.pmod("doc_id", F.lit(8)).isin(0, 4)).select(
        "doc_id", F.col("doc_id").alias("seq"), "sha1hex", "size",
        (F.col("size") + F.when(F.pmod("doc_id", F.lit(23)) == 4, 1).otherwise(0)).alias("declared"),
    )
    # the decision reads the arrivals twice; keep only their keys, once
    arrivals = arrivals.checkpoint(eager=True)
    out = intake.actions(arrivals, spool_table(spark, sf_dir), MAX_SIZE, order="seq")
    return out.select("doc_id", "action", "code")


@query("spool_listing", sql="""
WITH """ + SPOOL_SQL.replace(" WHERE doc_id % 2 = 0", "") + f"""
SELECT h AS name, CAST(stored AS BIGINT) AS size,
       strftime(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(last_doc AS BIGINT)), '%Y-%m-%dT%H:%M:%SZ') AS t,
       'http://{LISTEN}/spool/' || h AS url
FROM sp
""")
def q_spool_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sp = spool_table(spark, sf_dir, all_docs=True)
    listing = sp.select(sharded_path(F.lit("/spool"), F.col("sha1hex")).alias("path"), F.col("stored_size").alias("length"),
                        F.col("mtime").alias("modificationTime"))
    return spool_entries(listing, LISTEN)


@query("spool_status", sql="""
WITH """ + SPOOL_SQL + """,
ids AS (SELECT doc_id, CASE WHEN doc_id % 10 = 9 THEN substr(sha1(text), 1, 39) ELSE sha1(text) END AS id FROM documents)
SELECT doc_id, id, CASE WHEN strlen(id) <> 40 THEN 400 WHEN id IN (SELECT h FROM sp) THEN 200 ELSE 404 END AS code
FROM ids
""")
def q_spool_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _docs(spark, sf_dir)
    ids = d.select("doc_id", F.when(F.pmod("doc_id", F.lit(10)) == 9, F.substring("sha1hex", 1, 39))
                   .otherwise(F.col("sha1hex")).alias("id"))
    return intake.spool_status(ids, spool_table(spark, sf_dir)).select("doc_id", "id", "code")


URLMAP_SQL = """
arr AS (SELECT page_id, url, html FROM pages
        UNION ALL SELECT page_id, url, html FROM pages WHERE page_id % 8 = 1),
um AS (SELECT coalesce(nullif(CASE WHEN page_id % 3 = 0 THEN '' ELSE url END, ''),
                       nullif(CASE WHEN page_id % 6 = 0 THEN '' ELSE url || '#via-crawler' END, '')) AS url,
              sha1(html) AS sha1
       FROM arr)"""


def url_map_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    # pages with page_id % 8 = 1 arrive twice (one scan, rows repeated)
    times = F.when(F.pmod("page_id", F.lit(8)) == 1, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    arrivals = p.select("*", F.explode(times).alias("_arrival"))
    primary = F.when(F.pmod("page_id", F.lit(3)) == 0, F.lit("")).otherwise(F.col("url"))
    fallback = F.when(F.pmod("page_id", F.lit(6)) == 0, F.lit("")).otherwise(F.concat("url", F.lit("#via-crawler")))
    return urlmap.url_map_rows(arrivals, [primary, fallback], F.sha1(F.encode("html", "UTF-8")))


@query("url_map", sql="WITH " + URLMAP_SQL + " SELECT url, sha1 FROM um WHERE url IS NOT NULL")
def q_url_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_map_table(spark, sf_dir).select("url", "sha1")


@query("url_lookup", sql="WITH " + URLMAP_SQL + """,
pairs AS (SELECT DISTINCT url, sha1 FROM um WHERE url IS NOT NULL),
per AS (SELECT sha1, count(*) AS urls_per_sha1 FROM pairs GROUP BY sha1)
SELECT p.url, pairs.sha1, per.urls_per_sha1
FROM pages p JOIN pairs ON p.url = pairs.url JOIN per ON pairs.sha1 = per.sha1
""")
def q_url_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the map is a table: written once (one scan and one hash of the pages), then read by its two columns
    path = scratch_path(spark, "url-map")
    urlmap.append_url_map(url_map_table(spark, sf_dir), path)
    urls = table(spark, sf_dir, "pages").select("url")
    return urlmap.lookup(urls, spark.read.parquet(path)).select("url", "sha1", "urls_per_sha1")


@query("url_index_lookup", sql="WITH " + URLMAP_SQL + """,
pairs AS (SELECT DISTINCT url, sha1 FROM um WHERE url IS NOT NULL),
per AS (SELECT sha1, count(*) AS urls_per_sha1 FROM pairs GROUP BY sha1)
SELECT p.url, pairs.sha1, per.urls_per_sha1
FROM pages p JOIN pairs ON p.url = pairs.url JOIN per ON pairs.sha1 = per.sha1
""")
def q_url_index_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J5 and K9 on the bucketed copies of the map, filled by two batches, the
    first of them twice."""
    from capstan.operators.urlindex import UrlIndex

    rows = url_map_table(spark, sf_dir).select("url", "sha1").checkpoint(eager=True)
    index = UrlIndex(spark, scratch_path(spark, "url-index"), buckets=8)
    odd = F.pmod(F.xxhash64("sha1"), F.lit(2)) == 1
    for part in (rows.where(odd), rows.where(odd), rows.where(~odd)):
        index.add(part)
    return index.lookup(table(spark, sf_dir, "pages").select("url")).select("url", "sha1", "urls_per_sha1")


@query("batch_totals", sql="""
WITH f AS (SELECT sha1(text) AS h, arg_min(doc_id % 13 = 6, doc_id) AS empty FROM documents GROUP BY 1)
SELECT count(*) AS files,
       CAST(count(DISTINCT substr(h, 1, 2)) + count(DISTINCT substr(h, 1, 4)) + 1 AS BIGINT) AS dirs,
       CAST(sum(CASE WHEN empty THEN 0 ELSE 1 END) AS BIGINT) AS ok,
       CAST(sum(CASE WHEN empty THEN 1 ELSE 0 END) AS BIGINT) AS skipped
FROM f
""")
def q_batch_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1b and A2 on real files: one per distinct content, empty where its
    first document has doc_id % 13 = 6."""
    from capstan.operators.stats import batch_totals

    d = _docs(spark, sf_dir)
    firsts = d.groupBy("sha1hex").agg(F.min("doc_id").alias("doc_id"))
    files = d.select("doc_id", "content").join(firsts, "doc_id").select(
        sharded_path(F.lit("."), F.col("sha1hex")).alias("path"),
        F.when(F.pmod("doc_id", F.lit(13)) != 6, F.col("content")).alias("content"))
    root = scratch_path(spark, "totals")
    write_blobs(files, root)
    return batch_totals(list_spool(spark, root))


# ----------------------------------------------------------- artifact put/get

PUT_SQL = """
req AS (
  SELECT doc_id, text,
    CASE WHEN doc_id % 5 = 0 THEN 'custom' ELSE 'sandcrawler' END AS bucket,
    CASE WHEN doc_id % 4 = 0 THEN sha1(text) WHEN doc_id % 31 = 3 THEN 'deadbeef' ELSE sha1(text) END AS k,
    CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN '.txt' ELSE '.bin' END AS ext,
    CASE WHEN doc_id % 2 = 0 THEN '' ELSE 'dev-' END AS prefix
  FROM documents
),
ok AS (SELECT doc_id, bucket, prefix || 'blobs/' || substr(k, 1, 2) || '/' || substr(k, 3, 2) || '/' || k || ext AS object_path,
              sha1(text) AS content_sha1, CAST(strlen(text) AS BIGINT) AS size
       FROM req WHERE strlen(k) = 40),
store AS (SELECT bucket, object_path, arg_max(content_sha1, doc_id) AS content_sha1, arg_max(size, doc_id) AS size
          FROM ok GROUP BY bucket, object_path)"""


def put_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    m = lambda n: F.pmod("doc_id", F.lit(n))
    content = F.encode("text", "UTF-8")
    return d.select(
        "doc_id",
        F.lit("blobs").alias("folder"),
        F.when(m(4) == 0, F.lit("")).when(m(31) == 3, F.lit("deadbeef")).otherwise(F.sha1(content)).alias("sha1hex"),
        F.when(m(3) == 0, F.lit("")).when(m(3) == 1, F.lit("txt")).otherwise(F.lit(".bin")).alias("ext"),
        F.when(m(2) == 0, F.lit("")).otherwise(F.lit("dev-")).alias("prefix"),
        F.when(m(5) == 0, F.lit("custom")).otherwise(F.lit("")).alias("bucket"),
        content.alias("content"),
    )


@query("artifact_put", sql="WITH " + PUT_SQL + " SELECT bucket, object_path, content_sha1, size FROM store")
def q_artifact_put(spark: SparkSession, sf_dir: str) -> DataFrame:
    puts = artifacts.put_requests(put_requests(spark, sf_dir))
    return artifacts.stored(puts, "doc_id").select("bucket", "object_path", "content_sha1", "size")


@query("artifact_merge", sql="WITH " + PUT_SQL + " SELECT bucket, object_path, content_sha1, size FROM store")
def q_artifact_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 and W2 onto a stored table: three puts in a row, the second one
    twice, give the store of all puts."""
    puts = artifacts.put_requests(put_requests(spark, sf_dir))
    third = (table(spark, sf_dir, "documents").agg(F.max("doc_id")).collect()[0][0] or 0) // 3 + 1
    path = scratch_path(spark, "store")
    for batch in (0, 1, 1, 2):
        artifacts.merge_into(path, puts.where(F.floor(F.col("doc_id") / third) == batch), "doc_id", batch)
    return spark.read.parquet(path).select("bucket", "object_path", "content_sha1", "size")


@query("artifact_get", sql="WITH " + PUT_SQL + """,
g AS (SELECT doc_id,
        CASE WHEN doc_id % 5 = 0 THEN 'custom' ELSE 'sandcrawler' END AS bucket,
        CASE WHEN doc_id % 2 = 0 THEN '' ELSE 'dev-' END
          || CASE WHEN doc_id % 7 = 0 THEN 'other' ELSE 'blobs' END || '/'
          || substr(sha1(text), 1, 2) || '/' || substr(sha1(text), 3, 2) || '/' || sha1(text)
          || CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN '.txt' ELSE '.bin' END AS object_path
      FROM documents)
SELECT g.doc_id, g.bucket, g.object_path, store.content_sha1
FROM g LEFT JOIN store ON g.bucket = store.bucket AND g.object_path = store.object_path
""")
def q_artifact_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    puts = artifacts.put_requests(put_requests(spark, sf_dir))
    store = artifacts.stored(puts, "doc_id")
    d = table(spark, sf_dir, "documents").select("doc_id", F.sha1(F.encode("text", "UTF-8")).alias("h"))
    m = lambda n: F.pmod("doc_id", F.lit(n))
    req = d.select(
        "doc_id",
        F.when(m(5) == 0, F.lit("custom")).otherwise(F.lit("sandcrawler")).alias("bucket"),
        blob_path(F.when(m(7) == 0, F.lit("other")).otherwise(F.lit("blobs")), F.col("h"),
                  F.when(m(3) == 0, F.lit("")).when(m(3) == 1, F.lit("txt")).otherwise(F.lit(".bin")),
                  F.when(m(2) == 0, F.lit("")).otherwise(F.lit("dev-"))).alias("object_path"),
    )
    return artifacts.get(store, req).select("doc_id", "bucket", "object_path", "content_sha1")
