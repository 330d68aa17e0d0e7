"""From raw documents to packed training sequences, one operator a stage.

Every stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and
returns a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``.  All stages but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from capstan.llm.common import parked
from capstan.llm.decontamination import mark_leaks
from capstan.llm.line_dedup import drop_common_lines
from capstan.llm.packing import pack
from capstan.llm.quality import CUT, fit, score_quality
from capstan.llm.simhash import simhash_groups
from capstan.session import ship_package
from capstan.tables import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under ``CUT`` go; null and empty texts score the
    labelled documents' average."""
    ship_package(spark)
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model).where(F.col("score") >= CUT).select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in 10 documents or more are dropped from every document;
    ``n_chars`` follows the new text.  No document goes."""
    ship_package(spark)
    got = drop_common_lines(docs)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return got.select(*(new[c].alias(c) if c in new else F.col("row").getField(c).alias(c) for c in docs.columns))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (3-word shingles, 3 bits), the document
    with the smallest id stays; of rows that repeat it wholly, one."""
    ship_package(spark)
    first = simhash_groups(docs).where("first").select("id", "th").distinct()
    keyed = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("th"))
    key = lambda: [F.col("id").isNull().alias("none"), F.coalesce("id", F.lit(0)).alias("id"), F.col("th")]
    kept = keyed.select("row", *key()).join(first.select(*key()), ["none", "id", "th"], "left_semi")
    one = Window.partitionBy("none", "id", "th").orderBy(F.lit(0))
    return kept.withColumn("n", F.row_number().over(one)).where("n = 1").select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    ship_package(spark)
    clean = mark_leaks(docs, table(spark, sf_dir, "benchmark")).where("size(hits) = 0")
    return clean.select(*(F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left, packed into sequences of 2048 tokens: one row per piece."""
    ship_package(spark)
    return pack(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_dedup),
    ("benchmark_decontamination", decontamination),
    ("best_fit_packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents table on; each is written to the shared
    folder and read again by the next."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = parked(docs, name)
    return docs


#: The quality, SimHash, alignment and packing stages have no SQL form; tests
#: compare every stage with a brute-force version.
ORACLE_SQL = None
