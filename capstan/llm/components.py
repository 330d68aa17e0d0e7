"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capstan.llm.common import parked, salt

SALTS = 8


def _with_min(pairs: DataFrame) -> DataFrame:
    """``pairs`` (u, v) with m, the smallest of u and its neighbours.  A hub's
    neighbours are spread over SALTS keys of the join."""
    mins = (pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
            .withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    return pairs.withColumn("s", salt("v", n=SALTS)).join(mins, ["u", "s"]).drop("s")


def components(edges: DataFrame) -> DataFrame:
    """``edges``: long columns u, v.  Returns node, root: the smallest node
    reachable, for every node of an edge.  Rounds repeat until none changes
    anything; each is written to the shared folder."""
    now = parked(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "stars")
    seen = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_min(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        mins = _with_min(down)
        small = (mins.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(mins.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        now = parked(small, "stars")
        state = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"),
                        F.sum(F.xxhash64("v", "u").cast("decimal(20,0)")).alias("y")).first()
        if state == seen:
            break
        seen = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
