"""Join helpers.  Whether a side is broadcast is Spark's decision, by its size
in bytes (``spark.sql.autoBroadcastJoinThreshold``) and again at run time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flag_membership(df: DataFrame, keys: DataFrame, on: str, flag: str) -> DataFrame:
    """Add boolean ``flag``: is ``df[on]`` among ``keys[on]`` (J3).  Only the
    key column of ``keys`` takes part."""
    marks = keys.select(on).where(F.col(on).isNotNull()).distinct().withColumn(flag, F.lit(True))
    return df.join(marks, on, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
