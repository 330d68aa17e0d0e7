"""What the operators of this subpackage share.

Intermediate tables go to the shared folder of ``spark.checkpoint.dir``
(``parked``): that cuts lineage, and a lost executor costs only the tasks it
was running.  Nothing here collects rows to the driver.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from capstan.session import scratch_path

#: White space of the contracts: space and the controls 9 to 13.
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parked(df: DataFrame, kind: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` below the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, kind)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """Tasks of a shuffle: the session's setting, which sizes partitions to
    executor memory, and at least the number of task slots."""
    conf = spark.conf.get("spark.sql.shuffle.partitions", "200")
    return max(int(conf) if conf.isdigit() else 200, spark.sparkContext.defaultParallelism)


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other character unchanged (``lower`` alone would
    change other letters too; it is used where the text is pure ASCII)."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def salt(*cols: Column | str, n: int) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(n)).cast("int")


def col(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame, without: tuple[str, ...] = ()) -> Column:
    """All columns of ``df`` (but ``without``) as one struct ``row``: whatever
    their names, they clash with no column of an operator."""
    names = [c for c in df.columns if c not in without]
    return (F.struct(*map(col, names)) if names else F.struct(F.lit(None).cast("int").alias("none"))).alias("row")


def schema_of(df: DataFrame, ddl: str, row: str = "row") -> StructType:
    """Column ``row`` as ``df`` has it, then the columns of ``ddl``."""
    return StructType([df.schema[row], *StructType.fromDDL(ddl).fields])


def byte_rows(col: pa.Array) -> list[bytes]:
    """The values of a binary or string column as bytes, null as empty."""
    return [v if v is not None else b"" for v in col.cast(pa.binary()).to_pylist()]


def lists(values, offsets, dtype: pa.DataType) -> pa.ListArray:
    """A list column from flat values and n + 1 offsets."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, dtype))
