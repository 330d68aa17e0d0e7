"""Archive item identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def item_id(value: Column) -> Column:
    """Segment after the first ``details`` in a URL, else its last segment;
    a plain identifier is returned unchanged."""
    is_url = F.startswith(value, F.lit("http://")) | F.startswith(value, F.lit("https://"))
    parts = F.split(value, "/")
    pos = F.array_position(parts, F.lit("details"))
    after = F.when((pos > 0) & (pos < F.size(parts)), F.element_at(parts, (pos + 1).cast("int")))
    return F.when(is_url, F.coalesce(after, F.element_at(parts, -1))).otherwise(value)
