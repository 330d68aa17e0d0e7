import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from capstan.session import get_spark

    s = get_spark("local[4]", **{"spark.sql.shuffle.partitions": "8"})
    yield s
    s.stop()


def one(spark, expr, schema="x string", rows=None):
    """Evaluate a Column expression over literal rows; returns a list."""
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr).collect()]
