"""Catalogue queries for page text (D1), directory export (K2, O3) and the
streaming jobs (S2, T1-T7).

The streaming queries land the documents as files in a fresh folder under
the shared checkpoint folder (a Spark write), drain it with
``trigger(availableNow=True)`` and return the table the stream wrote.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capstan.functions.html import ENTITIES, STRIP_PATTERNS, html_text
from capstan.operators import filters as P
from capstan.operators import responses as R
from capstan.plans.archive import CAPTURES_SQL, records
from capstan.plans.registry import query
from capstan.plans.spool import SPOOL_SQL
from capstan.session import scratch_path
from capstan.sinks.blobdir import write_blobs
from capstan.sinks.hashdir import dir_export, write_hashdir
from capstan.streaming import drain, intake, state
from capstan.tables import table

MAX_SIZE = 20_000
BATCH_FILES = 20_000  # admission bound per micro-batch (T5)
INDEX_BATCHES = 6


def _page_text_sql() -> str:
    t = "html"
    for i, rx in enumerate(STRIP_PATTERNS):
        t = f"regexp_replace({t}, '{rx}', '{'' if i < 3 else ' '}', 'g')"
    for ent, ch in ENTITIES:
        t = f"replace({t}, '{ent}', '{ch.replace(chr(39), chr(39) * 2)}')"
    t = f"trim(regexp_replace({t}, '[ \\t\\r\\n\\f]+', ' ', 'g'), ' ')"
    return f"""
SELECT page_id, CAST(strlen(t) AS BIGINT) AS text_bytes, sha1(t) AS text_sha1
FROM (SELECT page_id, {t} AS t FROM pages)
"""


@query("page_text", sql=_page_text_sql())
def q_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").select("page_id", html_text(F.col("html")).alias("t"))
    return p.select("page_id", F.octet_length("t").cast("bigint").alias("text_bytes"),
                    F.sha1(F.encode("t", "UTF-8")).alias("text_sha1"))


@query("dir_export", sql="WITH " + CAPTURES_SQL + """
SELECT url AS uri, body_len AS bytes FROM msg WHERE is_response AND starts_with(ct, 'application/pdf')
""")
def q_dir_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    resp = P.apply(R.responses(records(spark, sf_dir)), [P.pdf_response])
    out = dir_export(resp, content="body", size="size", prefix="pdf-", extension=".pdf")
    return out.select("uri", F.octet_length("written").cast("bigint").alias("bytes"))


def _land(spark: SparkSession, sf_dir: str, content_addressed: bool) -> str:
    """Documents as files in a new spool folder: named by SHA-1 under a
    two-character shard folder (copies collapse into one file, K1 layout),
    or one file per document (copies kept).  A one-level layout keeps the
    stream source's listing to a few hundred folders."""
    root = scratch_path(spark, "spool")
    d = table(spark, sf_dir, "documents").select("doc_id", F.encode("text", "UTF-8").alias("content"))
    if content_addressed:
        # K1 layout; copies rewrite the same file with the same bytes, so no
        # shuffle is needed to de-duplicate them.
        write_hashdir(d, root)
        return root
    else:
        d = d.select(F.format_string("%02d/doc-%d.bin", F.pmod("doc_id", F.lit(100)), F.col("doc_id")).alias("path"),
                     "content")
    write_blobs(d, root)
    return root


@query("stream_spool_drain", sql="SELECT DISTINCT sha1(text) AS sha1hex, CAST(strlen(text) AS BIGINT) AS size FROM documents")
def q_stream_spool_drain(spark: SparkSession, sf_dir: str) -> DataFrame:
    spool = _land(spark, sf_dir, content_addressed=True)
    out, ckpt = scratch_path(spark, "drain-out"), scratch_path(spark, "drain-ckpt")
    s = drain.fingerprint(drain.spool_stream(spark, spool, max_files=BATCH_FILES))
    drain.run_available(s.select("sha1hex", "size"), out, ckpt)
    return spark.read.parquet(out).select("sha1hex", "size")


@query("stream_dedupe", sql="SELECT DISTINCT sha1(text) AS sha1hex FROM documents")
def q_stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    spool = _land(spark, sf_dir, content_addressed=False)
    out, ckpt = scratch_path(spark, "dedupe-out"), scratch_path(spark, "dedupe-ckpt")
    s = drain.fingerprint(drain.spool_stream(spark, spool, max_files=BATCH_FILES))
    drain.run_available(drain.dedupe_by_hash(s.select("sha1hex")), out, ckpt)
    return spark.read.parquet(out).select("sha1hex")


@query("stream_intake", sql=f"""
SELECT CASE WHEN strlen(text) > {MAX_SIZE} THEN 413 WHEN strlen(text) = 0 THEN 400 ELSE 202 END AS code,
       count(*) AS n
FROM documents GROUP BY 1
""")
def q_stream_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    spool = _land(spark, sf_dir, content_addressed=False)
    out, ckpt = scratch_path(spark, "intake-out"), scratch_path(spark, "intake-ckpt")
    s = drain.fingerprint(drain.spool_stream(spark, spool, max_files=BATCH_FILES))
    s = intake.codes(s, MAX_SIZE)
    q = (s.writeStream.foreachBatch(intake.intake_batch_writer(out))
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(os.path.join(out, "codes")).groupBy("code").agg(F.sum("n").cast("bigint").alias("n"))


@query("stream_running_counts", sql=f"""
SELECT CASE WHEN strlen(text) > {MAX_SIZE} THEN 413 WHEN strlen(text) = 0 THEN 400 ELSE 202 END AS code,
       count(*) AS n
FROM documents GROUP BY 1
""")
def q_stream_running_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running count per code in complete mode; each micro-batch
    replaces the table with the current totals (small: one row per code)."""
    spool = _land(spark, sf_dir, content_addressed=False)
    out, ckpt = scratch_path(spark, "counts-out"), scratch_path(spark, "counts-ckpt")
    s = intake.codes(drain.fingerprint(drain.spool_stream(spark, spool, max_files=BATCH_FILES)), MAX_SIZE)

    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    q = (intake.running_counts(s).writeStream.outputMode("complete").foreachBatch(replace)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out).select("code", F.col("n").cast("bigint").alias("n"))


STATE_SQL = """
WITH """ + SPOOL_SQL + f""",
ar AS (SELECT doc_id, sha1(text) AS h, strlen(text) AS size, strlen(text) + CASE WHEN doc_id % 23 = 4 THEN 1 ELSE 0 END AS declared FROM documents),
v AS (SELECT ar.*, CASE WHEN declared > {MAX_SIZE} OR size > {MAX_SIZE} THEN 'too-large' WHEN size = 0 THEN 'empty'
                        WHEN size <> declared THEN 'length-mismatch' END AS reject FROM ar),
k AS (SELECT v.*, sp.stored, row_number() OVER (PARTITION BY v.h, reject ORDER BY doc_id) AS nth FROM v LEFT JOIN sp ON v.h = sp.h),
a AS (SELECT h, reject, CASE WHEN reject IS NOT NULL THEN reject WHEN stored = size THEN 'skip' WHEN nth > 1 THEN 'skip'
                             WHEN stored IS NOT NULL THEN 'overwrite' ELSE 'insert' END AS action FROM k)
SELECT h AS sha1hex, action, CASE reject WHEN 'too-large' THEN 413 WHEN 'empty' THEN 400 WHEN 'length-mismatch' THEN 500 ELSE 202 END AS code,
       count(*) AS n
FROM a GROUP BY ALL
"""


@query("stream_intake_state", sql=STATE_SQL)
def q_stream_intake_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3 and J1 as keyed state over several micro-batches, on top of a spool
    that holds half of the documents."""
    from capstan.plans.spool import spool_table

    land, out, ckpt, old = (scratch_path(spark, k) for k in ("arrival-rows", "decisions", "decisions-ckpt", "spool-sizes"))
    d = table(spark, sf_dir, "documents")
    size = F.octet_length(F.encode("text", "UTF-8")).cast("bigint")
    d.select(F.col("doc_id").cast("string").alias("path"), F.sha1(F.encode("text", "UTF-8")).alias("sha1hex"), size.alias("size"),
             (size + F.when(F.pmod("doc_id", F.lit(23)) == 4, 1).otherwise(0)).alias("declared"),
             F.current_timestamp().alias("arrived")).repartition(12, "doc_id").write.parquet(land)
    spool_table(spark, sf_dir).select("sha1hex", "stored_size").write.parquet(old)
    own = state.state_session(spark)
    arrivals = own.readStream.schema(spark.read.parquet(land).schema).option("maxFilesPerTrigger", "4").parquet(land)
    state.run_intake(arrivals, out, ckpt, max_size=MAX_SIZE, stored=own.read.parquet(old))
    return spark.read.parquet(out).groupBy("sha1hex", "action", "code").agg(F.count("*").alias("n"))


@query("intake_index", sql=STATE_SQL)
def q_intake_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 batch by batch against the spool index: the half-filled spool is its
    first run, each batch is looked up, decided and added; full levels merge."""
    from capstan.operators.intake import actions
    from capstan.operators.keyindex import KeyIndex
    from capstan.plans.spool import spool_table

    out = scratch_path(spark, "index-decisions")
    index = KeyIndex(spark, scratch_path(spark, "spool-index"), fanout=3)
    index.add(spool_table(spark, sf_dir).select("sha1hex", F.col("stored_size").alias("size")), 0)
    d = table(spark, sf_dir, "documents")
    size = F.octet_length(F.encode("text", "UTF-8")).cast("bigint")
    rows = d.select("doc_id", F.sha1(F.encode("text", "UTF-8")).alias("sha1hex"), size.alias("size"),
                    (size + F.when(F.pmod("doc_id", F.lit(23)) == 4, 1).otherwise(0)).alias("declared"), F.pmod("doc_id", F.lit(INDEX_BATCHES)).alias("batch"))
    rows = rows.checkpoint(eager=True)  # keys only; every batch reads its own
    for n in range(INDEX_BATCHES):
        arrivals = rows.where(F.col("batch") == n).drop("batch")
        stored = index.lookup(arrivals.select("sha1hex"), before=n + 1)
        actions(arrivals, stored, MAX_SIZE, order="doc_id", join="merge").select("sha1hex", "size", "action", "code").write.parquet(f"{out}/batch={n + 1}")
        written = spark.read.parquet(f"{out}/batch={n + 1}").where(F.col("action").isin("insert", "overwrite"))
        index.add(written.select("sha1hex", "size"), n + 1)
    return spark.read.parquet(out).groupBy("sha1hex", "action", "code").agg(F.count("*").alias("n"))


# ------------------------------------------------------------------- whole jobs

def _land_arrivals(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Documents as arrivals named by id (empty when doc_id % 9 = 4), and the
    URL each came with (none when doc_id % 5 = 0)."""
    root = scratch_path(spark, "arrivals")
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    name = F.format_string("doc-%012d", F.col("doc_id"))
    write_blobs(d.select(F.concat(F.format_string("%02d/", F.pmod("doc_id", F.lit(100))), name).alias("path"),
                         F.when(F.pmod("doc_id", F.lit(9)) != 4, F.encode("text", "UTF-8")).alias("content")), root)
    urls = d.where(F.pmod("doc_id", F.lit(5)) != 0).select(name.alias("name"), F.concat(F.lit("http://x/"), F.col("doc_id").cast("string")).alias("url"))
    return root, urls


ARRIVALS_SQL = """
a AS (SELECT doc_id, sha1(text) AS h, text, doc_id % 9 = 4 OR strlen(text) = 0 AS empty, printf('doc-%012d', doc_id) AS name,
             lpad(CAST(doc_id % 100 AS VARCHAR), 2, '0') AS folder FROM documents),
b AS (SELECT *, row_number() OVER (PARTITION BY empty, h ORDER BY folder, name) AS k FROM a)"""


def _intake(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    from capstan.jobs import intake_arrivals

    root, urls = _land_arrivals(spark, sf_dir)
    spool, tables = scratch_path(spark, "spool"), scratch_path(spark, "intake-tables")
    return intake_arrivals(spark, root, spool, tables, max_files=BATCH_FILES, urls=urls), tables


@query("stream_intake_empty", sql="WITH " + ARRIVALS_SQL + """
SELECT CASE WHEN empty THEN 'empty' WHEN k = 1 THEN 'insert' ELSE 'skip' END AS action, CASE WHEN empty THEN 400 ELSE 202 END AS code, count(*) AS n
FROM b GROUP BY ALL
""")
def q_stream_intake_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T7 with empty arrivals, which come from the arrivals source with their answer."""
    return _intake(spark, sf_dir)[0].groupBy("action", "code").agg(F.count("*").alias("n"))


@query("intake_job", sql="WITH " + ARRIVALS_SQL + """
SELECT 'http://x/' || CAST(doc_id AS VARCHAR) AS url, h AS sha1 FROM b WHERE NOT empty AND k = 1 AND doc_id % 5 <> 0
""")
def q_intake_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4 and K9: the URL map that the intake job writes."""
    return spark.read.parquet(os.path.join(_intake(spark, sf_dir)[1], "url_map")).select("url", "sha1")


ADMISSIONS = 6


@query("stream_arrivals", sql="WITH " + ARRIVALS_SQL + f""",
f AS (SELECT folder || '/' || name AS path, CASE WHEN empty THEN 0 ELSE strlen(text) END AS n, CASE WHEN empty THEN sha1('') ELSE h END AS h FROM a),
t AS (SELECT CAST(sum(n) // {ADMISSIONS} + 1 AS BIGINT) AS max_bytes, count(*) // {ADMISSIONS} + 1 AS max_files FROM f),
w AS (SELECT f.*, t.max_bytes, coalesce(sum(greatest(n, (t.max_bytes + t.max_files - 1) // t.max_files))
               OVER (ORDER BY path ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM f, t)
SELECT path, CAST(n AS BIGINT) AS length, CASE WHEN n > {MAX_SIZE} THEN 413 WHEN n = 0 THEN 400 ELSE 202 END AS code,
       CASE WHEN n <= {MAX_SIZE} THEN h END AS sha1hex, dense_rank() OVER (ORDER BY start // max_bytes) AS admission
FROM w
""")
def q_stream_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2, T5, T7 through the arrivals source: every file with its answer, the
    digest of what was read, and the admission (micro-batch) it came with."""
    from capstan.sources.spool import list_spool
    from capstan.streaming import arrivals

    root, _ = _land_arrivals(spark, sf_dir)
    log, out, ckpt = (scratch_path(spark, f"arrivals-{k}") for k in ("log", "out", "ckpt"))
    total, files = list_spool(spark, root).agg(F.coalesce(F.sum("length"), F.lit(0)), F.count("*")).first()
    arrivals.announce(spark, root, log, max_bytes=total // ADMISSIONS + 1, max_files=files // ADMISSIONS + 1, slice_bytes=1 << 20)

    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.select("path", "length", "code", F.sha1("content").alias("sha1hex"), F.lit(batch_id + 1).cast("bigint").alias("admission"))
         .write.mode("overwrite").parquet(f"{out}/part={batch_id}"))

    arrivals.drain(arrivals.arrivals_stream(spark, log, max_size=MAX_SIZE), write, ckpt)
    return spark.read.parquet(out).select(F.substring_index("path", "/", -2).alias("path"), "length", "code", "sha1hex", "admission")


def stand_in_extractor(blob: bytes) -> dict:
    """Stands in for the PDF tools: text is what follows the magic line; an
    error for sizes of 5 by 17, no text for sizes of 7 by 19."""
    if len(blob) % 17 == 5:
        raise ValueError("exit status 1")
    text = "" if len(blob) % 19 == 7 else blob[9:].decode("utf-8")
    return {"text": text, "thumbnail": b"\xff\xd8\xff\xe0" + b"t" * (len(blob) % 90),
            "meta_report": f"Pages:  {len(blob) % 40 + 1}\nPDF version: 1.4",
            "pdfcpu_report": '{"header": {"version": "v1"}, "infos": [{"pageCount": %d}]}' % (len(blob) % 40 + 1)}


def stand_in_xml(blob: bytes) -> bytes:
    if len(blob) % 11 == 0:
        raise ValueError("no XML")
    return b"<tei/>"


@query("run_job", sql="""
WITH c AS (SELECT DISTINCT doc_id % 3 <> 2 AS pdf, text FROM documents),
b AS (SELECT pdf, text, strlen(text) + CASE WHEN pdf THEN 9 ELSE 0 END AS n,
             CASE WHEN pdf THEN sha1('%PDF-1.4' || chr(10) || text) ELSE sha1(text) END AS h FROM c),
s AS (SELECT h, n, CASE WHEN NOT pdf THEN 'not-pdf' WHEN n % 17 = 5 THEN 'parse-error'
                        WHEN n % 19 = 7 OR strlen(text) = 0 THEN 'empty-pdf' ELSE 'success' END AS status FROM b WHERE n > 0)
SELECT h AS sha1hex, status,
       CASE WHEN status <> 'success' THEN '' ELSE concat_ws(' ', CASE WHEN n % 11 <> 0 THEN 'grobid' END, CASE WHEN n % 90 + 4 > 50 THEN 'pdf' END, 'text') END AS artifacts,
       CASE WHEN status = 'success' THEN n % 40 + 1 END AS pages, CASE WHEN status = 'success' THEN n % 40 + 1 END AS pages_second
FROM s
""")
def q_run_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``run`` job on real files: status, the artifacts found in the
    folder it wrote, and the page count of both reports."""
    from capstan.jobs import process_spool
    from capstan.plans.inputs import blobs
    from capstan.sources.spool import list_spool

    root, out = scratch_path(spark, "run-spool"), scratch_path(spark, "run-out")
    write_hashdir(blobs(spark, sf_dir).select("content"), root)
    process_spool(spark, root, out, stand_in_extractor, xml_extractor=stand_in_xml, remove_processed=True)
    parts = F.split("path", "/")
    stored = list_spool(spark, os.path.join(out, "artifacts")).select(
        F.substring_index(F.element_at(parts, -1), ".", 1).alias("sha1hex"), F.element_at(parts, -4).alias("folder"))
    folders = stored.groupBy("sha1hex").agg(F.array_join(F.sort_array(F.collect_set("folder")), " ").alias("artifacts"))
    done = spark.read.parquet(os.path.join(out, "extracted", "batch=0"))
    return done.join(folders, "sha1hex", "left").select(
        "sha1hex", "status", F.coalesce("artifacts", F.lit("")).alias("artifacts"), F.col("metadata.pages").alias("pages"),
        F.get(F.col("metadata.pdfcpu.infos"), 0)["pageCount"].alias("pages_second"))
