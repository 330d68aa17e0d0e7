"""Catalogue queries for info reports (S7, F7-F10, S8) and links (F11, A6,
D8, P22) and page text (D1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capstan.functions.links import LINK_PATTERN, weblinks
from capstan.functions.report import legacy_extra, page_dim, parse_pdfcpu, with_info
from capstan.plans.inputs import report_text
from capstan.plans.registry import query
from capstan.tables import table


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "source")
    return with_info(d, report_text(F.col("doc_id"), F.col("n_chars"), F.col("source")), "info").select("doc_id", "info")


REPORT_SQL = """
r AS (
  SELECT doc_id,
    'Doc ' || CAST(doc_id AS VARCHAR) AS title, source AS producer,
    doc_id % 2 = 0 AS tagged,
    CAST(CASE WHEN doc_id % 5 = 0 THEN n_chars % 40 + 2 ELSE n_chars % 40 + 1 END AS BIGINT) AS pages,
    CASE doc_id % 4 WHEN 0 THEN '612 x 792 pts (letter)' WHEN 1 THEN '595.32 x 841.92 pts (A4)'
                    WHEN 2 THEN '100 100 ambiguous string' ELSE '' END AS page_size,
    CAST(CASE WHEN doc_id % 3 = 0 THEN 0 ELSE 90 END AS BIGINT) AS page_rot,
    CAST(n_chars AS BIGINT) AS filesize,
    '1.' || CAST(doc_id % 8 AS VARCHAR) AS pdf_version,
    CAST(CASE doc_id % 4 WHEN 0 THEN 612 WHEN 1 THEN 595.32 ELSE 0 END AS DOUBLE) AS width,
    CAST(CASE doc_id % 4 WHEN 0 THEN 792 WHEN 1 THEN 841.92 ELSE 0 END AS DOUBLE) AS height
  FROM documents
)"""


@query("pdf_report", sql="WITH " + REPORT_SQL + """
SELECT doc_id, title, '' AS subject, '' AS keywords, '' AS author, '' AS creator, producer,
       '' AS creation_date, '' AS mod_date, false AS custom_metadata, false AS metadata_stream,
       tagged, false AS user_properties, false AS suspects, '' AS form, false AS javascript,
       pages, false AS encrypted, page_size, page_rot, filesize, false AS optimized, pdf_version,
       '' AS pdf_subtype, '' AS abbreviation, '' AS subtitle, '' AS standard, '' AS conformance
FROM r
""")
def q_pdf_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports(spark, sf_dir).select("doc_id", "info.*")


@query("page_dim", sql="WITH " + REPORT_SQL + " SELECT doc_id, width, height FROM r")
def q_page_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reports(spark, sf_dir)
    return r.select("doc_id", page_dim(F.col("info.page_size")).alias("d")).select("doc_id", "d.*")


@query("pdf_extra", sql="WITH " + REPORT_SQL + """
SELECT doc_id, height AS page0height, width AS page0width, pages AS page_count,
       '' AS permanent_id, '' AS update_id, pdf_version FROM r
""")
def q_pdf_extra(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reports(spark, sf_dir)
    return r.select("doc_id", legacy_extra(F.col("info")).alias("x")).select("doc_id", "x.*")


def pdfcpu_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report JSON of the second info tool, built per document by rule."""
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "source")
    m = lambda n: F.pmod("doc_id", F.lit(n))
    sizes = F.when(m(4) == 0, F.array(F.struct(F.lit(792.0).alias("height"), F.lit(612.0).alias("width")))).when(
        m(4) == 1, F.array(F.struct(F.lit(841.92).alias("height"), F.lit(595.32).alias("width")),
                           F.struct(F.lit(595.32).alias("height"), F.lit(841.92).alias("width")))
    ).otherwise(F.array())
    info = F.struct(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("source"),
        F.concat(F.lit("1."), m(8).cast("string")).alias("version"),
        (F.pmod("n_chars", F.lit(40)) + 1).alias("pageCount"),
        sizes.alias("pageSizes"),
        (m(2) == 0).alias("tagged"),
        F.col("source").alias("producer"),
        F.struct(F.lit("tex").alias("PTEX.Fullbanner")).alias("properties"),
        F.lit("points").alias("unit"),
        F.lit("ignored").alias("unknownField"),
    )
    header = F.struct(F.lit("2024-01-01").alias("creation"), F.lit("pdfcpu v0.8.0").alias("version"))
    return d.select("doc_id", F.to_json(F.struct(header.alias("header"), F.array(info).alias("infos"))).alias("json"))


@query("pdfcpu_report", sql="""
SELECT doc_id, 'pdfcpu v0.8.0' AS tool_version, '1.' || CAST(doc_id % 8 AS VARCHAR) AS version,
       CAST(n_chars % 40 + 1 AS BIGINT) AS page_count,
       CAST(CASE doc_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END AS INTEGER) AS n_sizes,
       CAST(CASE doc_id % 4 WHEN 0 THEN 612 WHEN 1 THEN 595.32 END AS DOUBLE) AS first_width,
       doc_id % 2 = 0 AS tagged, 'tex' AS banner
FROM documents
""")
def q_pdfcpu_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pdfcpu_json(spark, sf_dir).select("doc_id", parse_pdfcpu(F.col("json")).alias("r"))
    i = F.col("r.infos")[0]
    return p.select(
        "doc_id", F.col("r.header.version").alias("tool_version"), i["version"].alias("version"),
        i["pageCount"].alias("page_count"), F.size(i["pageSizes"]).alias("n_sizes"),
        F.try_element_at(i["pageSizes"], F.lit(1))["width"].alias("first_width"),
        i["tagged"].alias("tagged"), i["properties"]["PTEX.Fullbanner"].alias("banner"),
    )


# ------------------------------------------------------------------- links

def link_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text with links per page: the page URL in prose, in brackets, a link
    with balanced brackets, a bare host, a trailing slash, a zero-width space
    inside a link, a mail link, an FTP link when page_id % 6 = 0, and the whole
    html of the page."""
    p = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    t = F.concat(
        F.lit("see "), F.col("url"), F.lit(". Also ("), F.col("url"), F.lit(") and "),
        F.lit("https://en.wikipedia.org/wiki/Sandbox_(software_development), "),
        F.lit("refs http://arXiv and https://www.crossref.org/; "),
        F.lit("odd https://example.com/a\u200bb/"), F.pmod("page_id", F.lit(7)).cast("string"), F.lit(" end"),
        F.when(F.pmod("page_id", F.lit(6)) == 0,
               F.concat(F.lit(" mirror ftp://ftp.example.org/pub/"), F.col("page_id").cast("string"), F.lit(".pdf")))
        .otherwise(F.lit("")),
        F.concat(F.lit(" mailto:p"), F.col("page_id").cast("string"), F.lit("@example.org ")), F.coalesce("html", F.lit("")),
    )
    return p.select("page_id", t.alias("text"))


LINK_TEXT_SQL = """
lt AS (
  SELECT page_id,
    'see ' || url || '. Also (' || url || ') and ' ||
    'https://en.wikipedia.org/wiki/Sandbox_(software_development), ' ||
    'refs http://arXiv and https://www.crossref.org/; ' ||
    'odd https://example.com/a' || chr(8203) || 'b/' || CAST(page_id % 7 AS VARCHAR) || ' end' ||
    CASE WHEN page_id % 6 = 0 THEN ' mirror ftp://ftp.example.org/pub/' || CAST(page_id AS VARCHAR) || '.pdf' ELSE '' END ||
    ' mailto:p' || CAST(page_id AS VARCHAR) || '@example.org ' || coalesce(html, '') AS text
  FROM pages
),
lk AS (
  SELECT page_id, list_sort(list_distinct(list_transform(
           regexp_extract_all(text, '""" + LINK_PATTERN.replace("'", "''") + """'),
           lambda u: replace(trim(u), chr(8203), '')))) AS links
  FROM lt
)"""


@query("weblinks", sql="WITH " + LINK_TEXT_SQL + " SELECT page_id, array_to_string(links, ' ') AS links, CAST(len(links) AS INTEGER) AS n FROM lk")
def q_weblinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = link_text(spark, sf_dir).select("page_id", weblinks(F.col("text")).alias("l"))
    return t.select("page_id", F.array_join("l", " ").alias("links"), F.size("l").alias("n"))


@query("link_frequency", sql="WITH " + LINK_TEXT_SQL + """
SELECT link, count(*) AS docs FROM (SELECT page_id, unnest(links) AS link FROM lk) GROUP BY link
""")
def q_link_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    from capstan.operators.outlinks import link_frequency

    t = link_text(spark, sf_dir).select("page_id", weblinks(F.col("text")).alias("weblinks"))
    return link_frequency(t)


@query("outlink_seeds", sql="WITH " + LINK_TEXT_SQL + """
SELECT DISTINCT link, CASE WHEN starts_with(link, 'ftp://') THEN 'spn2-no-ftp' ELSE 'queued' END AS status
FROM (SELECT unnest(links) AS link FROM lk)
""")
def q_outlink_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    from capstan.operators.outlinks import seeds

    t = link_text(spark, sf_dir).select("page_id", weblinks(F.col("text")).alias("weblinks"))
    return seeds(t)
