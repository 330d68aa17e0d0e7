"""Access to the input tables (one parquet file or folder per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read ``name`` from ``sf_dir``.  Column pruning and filters reach the scan."""
    path = os.path.join(sf_dir, f"{name}.parquet")
    return spark.read.parquet(path)


def version(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Name, size and time of the table's files as one string, so that files
    derived from a table are made anew when it changes."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(os.path.join(sf_dir, f"{name}.parquet"))
    files = path.getFileSystem(conf).listStatus(path)
    return " ".join(sorted(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}" for f in files))
