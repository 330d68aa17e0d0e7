"""Combination of origins into one queue."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_origins(origins: dict[str, DataFrame]) -> DataFrame:
    """``unionByName`` of origins with a ``source`` column (missing columns null)."""
    parts = [df.withColumn("source", F.lit(name)) for name, df in origins.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
