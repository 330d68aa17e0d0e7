"""Order-dependent numbering without funnelling a hot group into one task.

``row_number().over(Window.partitionBy(g).orderBy(o))`` sorts every row of
a group in a single task.  ``running_number`` gives the same numbers when
one group holds a large share of the rows, the way ``zipWithIndex`` works:
rows are range-partitioned and sorted on (g, o), so every task holds
contiguous runs; each row gets an id that grows within its task; one row per
(task, group) is aggregated (first id, count), the counts of earlier tasks
of the same group are summed over that small table, and the result is
joined back.  The ids are fixed by a reliable checkpoint, so every branch
of the plan reads the same values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from capstan.session import range_partitions


def running_number(df: DataFrame, group: list[str], order: str, out: str = "rn",
                   num_partitions: int | None = None) -> DataFrame:
    """1-based position of each row within its group by ``order``
    (``order`` must be unique within a group).  Pass only the key columns
    needed downstream: they are checkpointed once."""
    n = range_partitions(df.sparkSession, num_partitions)
    keys = [F.col(g) for g in group] + [F.col(order)]
    ided = (
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_id", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    runs = ided.groupBy("_part", *group).agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_offset", F.coalesce(F.sum("_cnt").over(before), F.lit(0))).drop("_cnt")
    return ided.join(runs, ["_part", *group]).withColumn(
        out, (F.col("_offset") + F.col("_id") - F.col("_first") + 1).cast("bigint")
    ).drop("_part", "_id", "_first", "_offset")
