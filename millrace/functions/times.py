"""Times as numbers, the same in any session."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def utc_micros(rows: DataFrame, name: str) -> Column:
    """Microseconds since 1970 of a time column; times without a zone are UTC, whatever the session's zone."""
    t = F.col(name)
    if not isinstance(rows.schema[name].dataType, T.TimestampNTZType):
        return F.unix_micros(t)
    second = (F.expr(f"extract(SECOND FROM `{name}`)") * 1_000_000).cast("long")
    return F.unix_date(t.cast("date")).cast("long") * 86_400_000_000 + F.hour(t).cast("long") * 3_600_000_000 + F.minute(t).cast("long") * 60_000_000 + second
