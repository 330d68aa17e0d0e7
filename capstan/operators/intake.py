"""Intake of arrivals into the spool: validation codes (P13, P16, T7), the
skip / overwrite / insert decision against the spool (J1) and the status of
an id (J2, P17)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capstan.functions.paths import EXPECTED_SHA1_LENGTH

# Response codes.
ACCEPTED, EMPTY, TOO_LARGE, MISMATCH = 202, 400, 413, 500


def validate(arrivals: DataFrame, max_size: int = 0) -> DataFrame:
    """Add ``reject`` (null when valid): declared or read size over the limit
    (0 = unlimited), empty body, or read size differing from declared."""
    size, declared = F.col("size"), F.col("declared")
    too_large = F.lit(False) if max_size <= 0 else (declared > max_size) | (size > max_size)
    reject = (
        F.when(too_large, F.lit("too-large"))
        .when(size == 0, F.lit("empty"))
        .when(size != declared, F.lit("length-mismatch"))
    )
    return arrivals.withColumn("reject", reject)


def actions(arrivals: DataFrame, spool: DataFrame, max_size: int = 0, order: str = "seq", join: str = "") -> DataFrame:
    """Per arrival an ``action`` and ``code``.

    ``arrivals``: sha1hex, size, declared, ``order`` (+ any key columns).
    ``spool``: sha1hex, stored_size (one row per stored object).
    Sequential semantics in one batch: the first valid arrival of a hash
    writes (insert, or overwrite when the stored size differs); later equal
    arrivals are skipped.  ``join``: a hint for both joins; with ``merge`` a
    micro-batch broadcasts nothing, which would pass the driver once a batch.
    """
    v = validate(arrivals, max_size)
    # first valid arrival per hash: a partial aggregate over key columns,
    # joined back once together with the spool entry of the hash
    firsts = v.where(F.col("reject").isNull()).groupBy("sha1hex").agg(F.min(order).alias("_first"))
    stored = spool.select("sha1hex", "stored_size")
    if join:
        firsts, stored = firsts.hint(join), stored.hint(join)
    v = v.join(firsts, "sha1hex", "left").join(stored, "sha1hex", "left")
    v = v.withColumn("is_first", F.coalesce(F.col(order) == F.col("_first"), F.lit(False))).drop("_first")
    action = (
        F.when(F.col("reject").isNotNull(), F.col("reject"))
        .when(F.col("stored_size").isNotNull() & (F.col("stored_size") == F.col("size")), F.lit("skip"))
        .when(~F.col("is_first"), F.lit("skip"))
        .when(F.col("stored_size").isNotNull(), F.lit("overwrite"))
        .otherwise(F.lit("insert"))
    )
    code = (
        F.when(F.col("reject") == "too-large", F.lit(TOO_LARGE))
        .when(F.col("reject") == "empty", F.lit(EMPTY))
        .when(F.col("reject") == "length-mismatch", F.lit(MISMATCH))
        .otherwise(F.lit(ACCEPTED))
    )
    return v.withColumn("action", action).withColumn("code", code)


def spool_status(ids: DataFrame, spool: DataFrame, id_col: str = "id") -> DataFrame:
    """400 for an id that is not 40 characters, 200 when present, else 404."""
    present = spool.select(F.col("sha1hex").alias(id_col)).distinct().withColumn("_hit", F.lit(True))
    j = ids.join(present, id_col, "left")
    code = (
        F.when(F.length(F.col(id_col)) != EXPECTED_SHA1_LENGTH, F.lit(400))
        .when(F.col("_hit"), F.lit(200))
        .otherwise(F.lit(404))
    )
    return j.withColumn("code", code).drop("_hit")
