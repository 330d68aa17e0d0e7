"""Content fingerprints (F1) and the hash-function factory."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from capstan.functions.mime import detect_mimetype


def hash_hex(content: Column, name: str = "sha1") -> Column:
    """Lowercase hex digest of a binary column by algorithm name."""
    name = name.lower()
    if name == "sha1":
        return F.sha1(content)
    if name == "md5":
        return F.md5(content)
    if name == "sha256":
        return F.sha2(content, 256)
    raise ValueError(f"unsupported hash: {name}")


def file_info(content: Column) -> Column:
    """struct<size, md5hex, sha1hex, sha256hex, mimetype> of a byte string (F1)."""
    return F.struct(
        F.octet_length(content).cast("bigint").alias("size"),
        F.md5(content).alias("md5hex"),
        F.sha1(content).alias("sha1hex"),
        F.sha2(content, 256).alias("sha256hex"),
        detect_mimetype(content).alias("mimetype"),
    )
