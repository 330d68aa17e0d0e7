"""Outlinks of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capstan.functions.links import outlink_status


def link_frequency(df: DataFrame, links: str = "weblinks") -> DataFrame:
    """Documents per link (links are distinct within a document)."""
    x = df.select(F.explode(F.col(links)).alias("link"))
    return x.groupBy("link").agg(F.count(F.lit(1)).cast("bigint").alias("docs"))


def seeds(df: DataFrame, links: str = "weblinks", has_credentials: bool = True) -> DataFrame:
    """Distinct links as crawl seeds with a hand-off status."""
    x = df.select(F.explode(F.col(links)).alias("link")).distinct()
    return x.withColumn("status", outlink_status(F.col("link"), has_credentials))
