"""JSON result rows (K8) and reading them back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _zero_to_null(df: DataFrame) -> DataFrame:
    """Null out empty strings and empty arrays so they are omitted, as the
    reference's ``omitempty`` does."""
    out = df
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            out = out.withColumn(f.name, F.nullif(F.col(f.name), F.lit("")))
        elif isinstance(f.dataType, T.ArrayType):
            out = out.withColumn(f.name, F.when(F.size(F.col(f.name)) > 0, F.col(f.name)))
    return out


def to_result_json(result: DataFrame, key: str = "doc_id") -> DataFrame:
    """K8: one JSON line per result with status success and no error."""
    ok = _zero_to_null(result.where((F.col("status") == "success") & F.col("err").isNull()))
    payload = [F.col(c) for c in ok.columns if c != key]
    return ok.select(F.col(key), F.to_json(F.struct(*payload), {"ignoreNullFields": "true"}).alias("json"))


def result_schema(result: DataFrame, key: str = "doc_id") -> T.StructType:
    return T.StructType([f for f in result.schema.fields if f.name != key])


def read_results(js: DataFrame, schema: T.StructType, key: str = "doc_id") -> DataFrame:
    """Parse JSON result lines with a fixed schema (no inference);
    binary fields are read from base64."""
    return js.select(F.col(key), F.from_json("json", schema).alias("r")).select(key, "r.*")
