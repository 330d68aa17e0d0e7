"""Run statistics and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def run_stats(result: DataFrame, ok: Column | None = None) -> DataFrame:
    """A1: processed, ok and their ratio; 1.0 when nothing was processed."""
    ok = ok if ok is not None else (F.col("status") == F.lit("success"))
    agg = result.agg(
        F.count(F.lit(1)).cast("bigint").alias("processed"),
        F.coalesce(F.sum(F.when(ok, 1).otherwise(0)), F.lit(0)).cast("bigint").alias("ok"),
    )
    return agg.withColumn(
        "success_ratio",
        F.when(F.col("processed") == 0, F.lit(1.0)).otherwise(F.col("ok") / F.col("processed")),
    )


def observed(result: DataFrame, ok: Column | None = None) -> tuple[DataFrame, Observation]:
    """A1 without a pass of its own: ``result`` with its statistics observed by
    whatever job reads it next; ``Observation.get`` has them once that is done
    (``processed``, ``ok``)."""
    ok = ok if ok is not None else (F.col("status") == F.lit("success"))
    seen = Observation()
    return result.observe(seen, F.count(F.lit(1)).alias("processed"), F.count_if(ok).alias("ok")), seen


def of_metrics(metrics: DataFrame) -> DataFrame:
    """A1 of rows of observed metrics (processed, ok), one per batch."""
    total = metrics.agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("processed", "ok")))
    return total.withColumn("success_ratio", F.when(F.col("processed") == 0, F.lit(1.0)).otherwise(F.col("ok") / F.col("processed")))


def status_counts(result: DataFrame) -> DataFrame:
    """A5: rows per status."""
    return result.groupBy("status").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def error_count(*errs: Column) -> Column:
    """Number of failed steps of a document."""
    return F.size(F.array_compact(F.array(*errs))).cast("bigint")


def batch_totals(listing: DataFrame, path: str = "path", length: str = "length") -> DataFrame:
    """A2 over a spool listing (one row per file): files, directories implied
    by the two-level shard layout (+ the root), ok (non-empty, processed) and
    skipped (empty, P12)."""
    parts = F.split(F.col(path), "/")
    d1 = F.try_element_at(parts, F.lit(-3))
    d2 = F.concat(d1, F.try_element_at(parts, F.lit(-2)))
    return listing.agg(
        F.count(F.lit(1)).cast("bigint").alias("files"),
        (F.count_distinct(d1) + F.count_distinct(d2) + 1).cast("bigint").alias("dirs"),
        F.count_if(F.col(length) > 0).cast("bigint").alias("ok"),
        F.count_if(F.col(length) == 0).cast("bigint").alias("skipped"),
    )
