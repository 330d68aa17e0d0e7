"""One file per blob (K1/K2 file variant, spool folders) as a Spark writer.

``df.write.format("blobdir").mode("append").save(root)`` writes each row's
``content`` to ``root/{path}``.  Names are given by the rows (content
addressed or generated), each file is written under a temporary name and
moved into place when complete, so a retried task rewrites the same names.
``root`` may be a local path or a file-system URI.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage


class BlobDirCommit(WriterCommitMessage):
    def __init__(self, n: int):
        self.n = n


class BlobDirWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.root = options.get("path", "")

    def write(self, batches):
        from capstan.sources import fsio

        n = 0
        for b in batches:
            # unique temporary name per writer: two tasks may write the same
            # content address at once; both move identical bytes into place
            for path, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                fsio.write_atomic(fsio.join(self.root, path), [content or b""])
            n += b.num_rows
        return BlobDirCommit(n)


class BlobDirDataSource(DataSource):
    @classmethod
    def name(cls):
        return "blobdir"

    def schema(self):
        return "path string, content binary"

    def writer(self, schema, overwrite):
        return BlobDirWriter(self.options)


def write_blobs(df: DataFrame, root: str) -> None:
    """Write ``path``/``content`` rows as files below ``root``."""
    spark: SparkSession = df.sparkSession
    spark.dataSource.register(BlobDirDataSource)
    df.select("path", "content").write.format("blobdir").mode("append").save(root)
