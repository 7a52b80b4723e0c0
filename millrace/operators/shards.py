"""Alignment of parallel shards by key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def align(index: DataFrame, streams: dict[str, DataFrame], keys: list[str], order: str, usable: str | None = None) -> DataFrame:
    """Keys of the index that every stream has, with each stream's payload; of repeated keys the first usable row counts.

    Streams are (keys, order, payload). Rows out of the index's order are kept too: the join does not depend on order.
    """
    out = index.select(*keys).distinct()
    for name, rows in streams.items():
        if usable:
            rows = rows.where(usable)
        first = rows.groupBy(*keys).agg(F.min(F.struct(order, "payload")).alias("_first"))
        out = out.join(first.select(*keys, F.col("_first.payload").alias(name)), keys)
    return out


def zip_streams(streams: dict[str, DataFrame], by: str, order: list[str]) -> DataFrame:
    """Rows of the same position in their shard, as far as the shortest stream goes."""
    w = Window.partitionBy(by).orderBy(*order)
    numbered = [rows.withColumn("position", F.row_number().over(w) - 1).select(by, "position", F.col("payload").alias(name)) for name, rows in streams.items()]
    return reduce(lambda a, b: a.join(b, [by, "position"]), numbered)


def data_key(column: str):
    """A key's name without its extension, with dots of the prefix as dashes."""
    return F.regexp_replace(F.regexp_replace(F.col(column), r"\.[^.]*$", ""), r"\.", "-")
