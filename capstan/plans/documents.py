"""Catalogue queries over ``documents`` as blobs: fingerprints, status,
artifacts and run statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from capstan.functions.hashing import file_info
from capstan.functions.mime import detect_mimetype
from capstan.operators import artifacts, derive, stats
from capstan.plans import inputs
from capstan.plans.registry import query
from capstan.plans.sql_common import EXTRACT_CTE
from capstan.tables import table


def extract_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result rows (M9) of the rule-made extractor over all blobs."""
    gated = derive.gate(inputs.outcomes(spark, sf_dir), inputs.blocklist(spark, sf_dir))
    return derive.extract(gated.drop("content"))


@query("file_info", sql="""
WITH """ + EXTRACT_CTE + """
SELECT doc_id, size, md5hex, sha1hex, sha256hex, mimetype FROM f
""")
def q_file_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = inputs.blobs(spark, sf_dir)
    return b.select("doc_id", file_info(F.col("content")).alias("fi")).select("doc_id", "fi.*")


@query("extract_status", sql="""
WITH """ + EXTRACT_CTE + """
SELECT doc_id, sha1hex, status,
  CASE status WHEN 'not-pdf' THEN 'mimetype is ' || mimetype
              WHEN 'bad-pdf' THEN 'PDF known to cause processing issues'
              WHEN 'parse-error' THEN 'text extraction failed: exit status 1'
              WHEN 'empty-pdf' THEN 'zero length text' END AS err,
  status NOT IN ('parse-error', 'empty-pdf') AS has_fileinfo
FROM s
""")
def q_extract_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = extract_result(spark, sf_dir)
    return r.select("doc_id", "sha1hex", "status", "err", F.col("fileinfo").isNotNull().alias("has_fileinfo"))


@query("status_counts", sql="""
WITH """ + EXTRACT_CTE + """
SELECT status, count(*) AS n FROM s GROUP BY status
""")
def q_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.status_counts(extract_result(spark, sf_dir))


ARTIFACT_SQL = """
WITH """ + EXTRACT_CTE + """,
succ AS (SELECT * FROM s WHERE status = 'success'),
arts AS (
  SELECT doc_id, sha1hex, 'text' AS kind, 'sandcrawler' AS bucket,
         'text/' || substr(sha1hex, 1, 2) || '/' || substr(sha1hex, 3, 2) || '/' || sha1hex || '.txt' AS object_path,
         'text/plain; charset=utf-8' AS content_type, CAST(strlen(text) AS BIGINT) AS size
  FROM succ WHERE strlen(text) > 0
  UNION ALL
  SELECT doc_id, sha1hex, 'thumbnail', 'thumbnail',
         'pdf/' || substr(sha1hex, 1, 2) || '/' || substr(sha1hex, 3, 2) || '/' || sha1hex || '.180px.jpg',
         'image/jpeg', CAST(doc_id % 120 AS BIGINT)
  FROM succ WHERE doc_id % 120 > 50
)
SELECT sha1hex, kind, bucket, object_path, content_type, size
FROM (SELECT *, row_number() OVER (PARTITION BY bucket, object_path ORDER BY doc_id DESC) AS rn FROM arts)
WHERE rn = 1
"""


@query("artifact_plan", sql=ARTIFACT_SQL)
def q_artifact_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = extract_result(spark, sf_dir)
    return artifacts.plan(r).select("sha1hex", "kind", "bucket", "object_path", "content_type", "size")


RUN_STATS_SQL = """
WITH """ + EXTRACT_CTE + """
SELECT count(*) AS processed,
       CAST(coalesce(sum(CASE WHEN status = 'success' THEN 1 ELSE 0 END), 0) AS BIGINT) AS ok,
       CASE WHEN count(*) = 0 THEN CAST(1.0 AS DOUBLE)
            ELSE sum(CASE WHEN status = 'success' THEN 1 ELSE 0 END) / count(*) END AS success_ratio
FROM s {where}
"""


@query("run_stats", sql=RUN_STATS_SQL.format(where=""))
def q_run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.run_stats(extract_result(spark, sf_dir))


@query("run_stats_observed", sql=RUN_STATS_SQL.format(where=""))
def q_run_stats_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 from the metrics of the job that writes the results."""
    from capstan.session import scratch_path

    result, seen = stats.observed(extract_result(spark, sf_dir))
    result.select("doc_id", "status").write.parquet(scratch_path(spark, "observed"))
    return stats.of_metrics(spark.createDataFrame([(seen.get["processed"], seen.get["ok"])], "processed bigint, ok bigint"))


@query("run_stats_empty", sql=RUN_STATS_SQL.format(where="WHERE doc_id < 0"))
def q_run_stats_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.run_stats(extract_result(spark, sf_dir).where(F.col("doc_id") < 0))


# Fixed values for the content-type fixture: leading bytes by doc_id % 10.
MAGIC_CASES = [
    ("255044462D312E340A", "application/pdf"),
    ("FFD8FFE0", "image/jpeg"),
    ("89504E470D0A1A0A", "image/png"),
    ("474946383961", "image/gif"),
    ("1F8B08", "application/gzip"),
    ("3C3F786D6C2076657273696F6E3D22312E30223F3E", "text/xml; charset=utf-8"),
    ("3C21444F43545950452068746D6C3E", "text/html; charset=utf-8"),
    ("C00001", "application/octet-stream"),
    ("", None),
    ("504B0304", "application/zip"),
]


def _content_type_sql() -> str:
    cases = " ".join(
        f"WHEN doc_id % 10 = {i} THEN '{t}'" for i, (_, t) in enumerate(MAGIC_CASES) if t
    )
    return f"""
SELECT doc_id,
  CASE {cases}
       WHEN strlen(text) = 0 THEN 'text/plain'
       ELSE 'text/plain; charset=utf-8' END AS content_type
FROM documents
"""


@query("content_type", sql=_content_type_sql())
def q_content_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    prefix = None
    for i, (hx, _) in enumerate(MAGIC_CASES):
        cond = F.pmod(F.col("doc_id"), F.lit(10)) == i
        val = F.unhex(F.lit(hx))
        prefix = F.when(cond, val) if prefix is None else prefix.when(cond, val)
    content = F.concat(prefix, F.encode(F.col("text"), "UTF-8"))
    return d.select("doc_id", detect_mimetype(content).alias("content_type"))


# ------------------------------------------------------------ keys and paths

BLOB_PATH_CASES = [("", "", ""), ("images", "", ""), ("images", "xml", ""), ("images", "xml", "dev-")]


@query("blob_path", sql="""
WITH """ + EXTRACT_CTE + """,
c(case_id, folder, ext, prefix) AS (VALUES (0, '', '', ''), (1, 'images', '', ''),
                                          (2, 'images', '.xml', ''), (3, 'images', '.xml', 'dev-'))
SELECT f.doc_id, c.case_id,
       c.prefix || c.folder || '/' || substr(sha1hex, 1, 2) || '/' || substr(sha1hex, 3, 2) || '/' || sha1hex || c.ext
         AS object_path
FROM f, c
""")
def q_blob_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    from capstan.functions.paths import blob_path

    b = inputs.blobs(spark, sf_dir).select("doc_id", F.sha1("content").alias("h"))
    cases = F.array(*[
        F.struct(F.lit(i).alias("case_id"), F.lit(fo).alias("folder"), F.lit(e).alias("ext"), F.lit(p).alias("prefix"))
        for i, (fo, e, p) in enumerate(BLOB_PATH_CASES)
    ])
    x = b.select("doc_id", "h", F.explode(cases).alias("c"))
    return x.select("doc_id", F.col("c.case_id").alias("case_id"),
                    blob_path(F.col("c.folder"), F.col("h"), F.col("c.ext"), F.col("c.prefix")).alias("object_path"))


@query("sharded_path", sql="""
WITH """ + EXTRACT_CTE + """,
n AS (SELECT doc_id, CASE WHEN doc_id % 7 = 3 THEN substr(sha1hex, 1, CAST(doc_id % 8 AS INTEGER)) ELSE sha1hex END AS name FROM f),
p AS (SELECT doc_id, name,
        CASE WHEN strlen(name) >= 8 THEN '/spool/' || substr(name, 1, 2) || '/' || substr(name, 3, 2) || '/' || substr(name, 5) END AS path
      FROM n)
SELECT doc_id, name, path,
       CASE WHEN path IS NULL THEN '' ELSE substr(name, 1, 2) || substr(name, 3, 2) || substr(name, 5) END AS identifier
FROM p
""")
def q_sharded_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    from capstan.functions.paths import sharded_path, sharded_path_to_id

    b = inputs.blobs(spark, sf_dir).select("doc_id", F.sha1("content").alias("h"))
    name = F.when(F.pmod("doc_id", F.lit(7)) == 3,
                  F.substring(F.col("h"), F.lit(1), F.pmod("doc_id", F.lit(8)).cast("int"))).otherwise(F.col("h"))
    x = b.select("doc_id", name.alias("name")).withColumn("path", sharded_path(F.lit("/spool"), F.col("name")))
    return x.withColumn("identifier", sharded_path_to_id(F.col("path")))


@query("hash_dir_layout", sql="""
WITH """ + EXTRACT_CTE + """,
u AS (SELECT sha1hex, any_value(size) AS size FROM f GROUP BY sha1hex)
SELECT substr(sha1hex, 1, 2) AS shard, count(*) AS files, CAST(sum(size) AS BIGINT) AS bytes FROM u GROUP BY 1
""")
def q_hash_dir_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    from capstan.sinks.hashdir import layout

    return layout(inputs.blobs(spark, sf_dir), hash_name="sha1")


@query("content_dedupe", sql="""
WITH """ + EXTRACT_CTE + """
SELECT sha1hex, min(doc_id) AS first_doc, count(*) AS copies FROM f GROUP BY sha1hex
""")
def q_content_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from capstan.operators.dedupe import distinct_content

    return distinct_content(inputs.blobs(spark, sf_dir), order="doc_id")


THUMB_FORMATS = ["jpg", "JPEG", "png", "tiff", "bmp"]


@query("thumbnail_keys", sql="""
WITH """ + EXTRACT_CTE + """,
t AS (SELECT doc_id, sha1hex,
        CASE doc_id % 5 WHEN 0 THEN 'jpg' WHEN 1 THEN 'JPEG' WHEN 2 THEN 'png' WHEN 3 THEN 'tiff' ELSE 'bmp' END AS format
      FROM s WHERE status = 'success' AND doc_id % 120 > 50),
e AS (SELECT *, CASE WHEN lower(format) IN ('jpg', 'jpeg') THEN '.jpg' WHEN lower(format) = 'png' THEN '.png'
                     WHEN lower(format) = 'tiff' THEN '.tiff' ELSE '.jpg' END AS ext FROM t)
SELECT doc_id, format, ext,
       'pdf/' || substr(sha1hex, 1, 2) || '/' || substr(sha1hex, 3, 2) || '/' || sha1hex || '.180px' || ext AS object_path
FROM e
""")
def q_thumbnail_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    from capstan.functions.paths import blob_path, thumb_format

    r = extract_result(spark, sf_dir)
    stored = r.where(derive.has_thumbnail_to_store(r))
    fmt = F.element_at(F.array(*[F.lit(x) for x in THUMB_FORMATS]), (F.pmod("doc_id", F.lit(5)) + 1).cast("int"))
    x = stored.select("doc_id", "sha1hex", fmt.alias("format"))
    x = x.withColumn("ext", thumb_format(F.col("format"))["ext"])
    return x.select("doc_id", "format", "ext",
                    blob_path(F.lit("pdf"), F.col("sha1hex"), F.concat(F.lit("180px"), F.col("ext")), F.lit("")).alias("object_path"))


@query("redact", sql="""
SELECT c_custkey,
       CASE WHEN strlen(c_name) <= 4 THEN '****' ELSE substr(c_name, 1, 2) || '****' || substr(c_name, -2, 2) END AS masked
FROM customer
""")
def q_redact(spark: SparkSession, sf_dir: str) -> DataFrame:
    from capstan.functions.paths import mask_sensitive

    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return c.select("c_custkey", mask_sensitive(F.col("c_name")).alias("masked"))


@query("origins_union", sql="""
SELECT source, count(*) AS n, CAST(sum(size) AS BIGINT) AS bytes FROM (
  SELECT 'manual' AS source, strlen(text) AS size FROM documents
  UNION ALL SELECT 'crawl', strlen(html) FROM pages
  UNION ALL SELECT 'archive', strlen(text) FROM benchmark
) GROUP BY source
""")
def q_origins_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    from capstan.sources.origins import union_origins

    d = table(spark, sf_dir, "documents").select(F.encode("text", "UTF-8").alias("content"))
    p = table(spark, sf_dir, "pages").select(F.encode("html", "UTF-8").alias("content"))
    k = table(spark, sf_dir, "benchmark").select(F.encode("text", "UTF-8").alias("content"))
    u = union_origins({"manual": d, "crawl": p, "archive": k})
    return u.groupBy("source").agg(F.count(F.lit(1)).alias("n"),
                                   F.sum(F.octet_length("content")).cast("bigint").alias("bytes"))


@query("pending_work", sql="""
SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE doc_id % 4 = 0)
""")
def q_pending_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    from capstan.operators.backfill import pending

    work = table(spark, sf_dir, "documents").select("doc_id")
    finished = table(spark, sf_dir, "documents").where(F.pmod("doc_id", F.lit(4)) == 0).select("doc_id")
    return pending(work, finished, ["doc_id"])


STRUCTURED_LIMIT = 20_000  # bytes; stands in for the 256 MiB default at fixture scale


@query("structured_gate", sql=f"""
WITH """ + EXTRACT_CTE + f"""
SELECT doc_id, status = 'success' AND size <= {STRUCTURED_LIMIT} AS eligible,
       CAST(CASE WHEN status = 'success' THEN 0 ELSE 1 END + CASE WHEN status = 'success' AND size > {STRUCTURED_LIMIT} THEN 1 ELSE 0 END
            + CASE WHEN status = 'success' AND doc_id % 120 < 50 THEN 1 ELSE 0 END AS BIGINT) AS errors
FROM s
""")
def q_structured_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    gated = derive.gate(inputs.outcomes(spark, sf_dir), inputs.blocklist(spark, sf_dir))
    sized = gated.withColumn("blob_size", F.octet_length("content").cast("bigint")).drop("content")
    r = derive.extract(sized)
    eligible = (F.col("status") == "success") & (F.col("blob_size") <= F.lit(STRUCTURED_LIMIT))
    too_large = F.when((F.col("status") == "success") & (F.col("blob_size") > F.lit(STRUCTURED_LIMIT)), F.lit(derive.TOO_LARGE))
    steps = stats.error_count(F.col("err"), too_large, F.col("thumb_note"))  # extraction, XML, thumbnail
    return r.select("doc_id", eligible.alias("eligible"), steps.alias("errors"))


@query("result_json", sql="""
WITH """ + EXTRACT_CTE + """
SELECT doc_id, sha1hex, status, size, mimetype,
       CAST(strlen(text) AS BIGINT) AS text_bytes,
       CAST(CASE WHEN doc_id % 120 >= 50 THEN doc_id % 120 END AS BIGINT) AS thumb_bytes,
       CAST(len(list_distinct(regexp_extract_all(text, '(?i)\\b(?:[a-z][a-z0-9.+-]*://|(?:bitcoin|cid|file|geo|magnet|mailto|mid|news|sms|tel|urn|xmpp):)(?:[^\\s<>"''()]|\\([^\\s<>"''()]*\\))*(?:[^\\s<>"''().,;:!?\\[\\]{}]|\\([^\\s<>"''()]*\\))'))) AS BIGINT) AS n_links,
       CAST(CASE WHEN doc_id % 5 = 0 THEN n_chars % 40 + 2 ELSE n_chars % 40 + 1 END AS BIGINT) AS page_count
FROM s WHERE status = 'success'
""")
def q_result_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    from capstan.sinks.results import read_results, result_schema, to_result_json

    r = extract_result(spark, sf_dir)
    back = read_results(to_result_json(r), result_schema(r))
    return back.select(
        "doc_id", "sha1hex", "status",
        F.col("fileinfo.size").alias("size"), F.col("fileinfo.mimetype").alias("mimetype"),
        F.octet_length("text").cast("bigint").alias("text_bytes"),
        F.octet_length("page0thumbnail").cast("bigint").alias("thumb_bytes"),
        F.when(F.col("weblinks").isNull(), F.lit(0)).otherwise(F.size("weblinks")).cast("bigint").alias("n_links"),
        F.col("pdfextra.page_count").alias("page_count"),
    )


def last_digit(digest: Column) -> Column:
    """A shard function of a user's own."""
    return F.concat(F.lit("x"), F.substring(digest, -1, 1))


@query("hash_dir_own_shards", sql="""
WITH d AS (SELECT DISTINCT CASE WHEN doc_id % 3 <> 2 THEN '%PDF-1.4' || chr(10) || text ELSE text END AS t FROM documents)
SELECT 'x' || right(sha256(t), 1) AS shard, sha256(t) || '.bin' AS file_name, CAST(strlen(t) AS BIGINT) AS size FROM d
""")
def q_hash_dir_own_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 with X3 and X4: files named by SHA-256 under a user's shards, written
    and listed again."""
    from capstan.session import scratch_path
    from capstan.sinks.hashdir import write_hashdir
    from capstan.sources.spool import list_spool

    root = scratch_path(spark, "own-shards")
    write_hashdir(inputs.blobs(spark, sf_dir).select("content"), root, hash_name="sha256", shard=last_digit, ext=".bin")
    parts = F.split("path", "/")
    return list_spool(spark, root).select(F.element_at(parts, -2).alias("shard"), F.element_at(parts, -1).alias("file_name"), F.col("length").alias("size"))


TIME_LIMIT_S, HANG_EVERY = 2.0, 499


def hanging_extractor(blob: bytes) -> dict:
    """Stands in for a text tool that hangs on sizes of 7 by ``HANG_EVERY``."""
    if len(blob) % HANG_EVERY == 7:
        import time

        time.sleep(4 * TIME_LIMIT_S)
    return {"text": blob[9:].decode("utf-8")}


@query("extract_time_limit", sql=f"""
WITH b AS (SELECT doc_id, doc_id % 3 <> 2 AS pdf, text, strlen(text) + CASE WHEN doc_id % 3 <> 2 THEN 9 ELSE 0 END AS n FROM documents)
SELECT doc_id, CASE WHEN NOT pdf THEN 'not-pdf' WHEN n % {HANG_EVERY} = 7 THEN 'parse-error' WHEN strlen(text) = 0 THEN 'empty-pdf' ELSE 'success' END AS status,
       CASE WHEN pdf AND n % {HANG_EVERY} = 7 THEN 'text extraction failed: timeout' END AS time_err
FROM b
""")
def q_extract_time_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose extractor overruns the time limit are error rows;
    the others of their task go on."""
    gated = derive.gate(inputs.blobs(spark, sf_dir).select("doc_id", "content"), None)
    done = derive.extract(derive.run_extractor(gated, hanging_extractor, timeout_s=TIME_LIMIT_S))
    return done.select("doc_id", "status", F.when(F.endswith("err", F.lit(": timeout")), F.col("err")).alias("time_err"))
