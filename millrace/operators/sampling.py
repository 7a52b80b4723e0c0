"""Sampling of frames and rows, shuffles that can be resumed, and gathered ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators import ordering
from millrace.operators.mixture import draw


def consecutive(n: Column, length: int, u: Column | None = None) -> Column:
    """First and end of `length` consecutive frames of n, the first ones or, with a uniform number u, any; null if n is too short."""
    first = F.lit(0) if u is None else F.floor(u * (n - length + 1)).cast("int")
    return F.when(n >= length, F.struct(first.alias("first"), (first + length).cast("int").alias("end")))


def shuffled(rows: DataFrame, key: str, seed: int, start: int = 0, workers: int = 1, name: str = "position") -> DataFrame:
    """Rows in an order that depends on seed and key alone, without what each of `workers` had read by the time of row `start`."""
    drawn = rows.withColumn("_u", draw(F.col(key), seed=seed))
    numbered = ordering.number_rows(drawn, ["_u", key], name).drop("_u")
    return numbered.where(F.floor(F.col(name) / workers) >= start // workers)


def replay(rows: DataFrame, position: str, cache: int, seed: int, name: str = "replayed_at") -> DataFrame:
    """Rows with the place at which a cache gives them out that holds `cache` rows and lets go of a drawn one when it is full.

    A slot of the cache is a lottery of its own: rows are dealt to slots by a draw, and the row that a slot holds goes when the
    next one comes. What is left at the end follows in slot order. Every row is given out once.
    """
    slot = F.floor(draw(F.col(position), seed=seed) * cache)
    held = rows.withColumn("_slot", slot)
    leaves = F.lead(position).over(Window.partitionBy("_slot").orderBy(position))
    held = held.withColumn("_late", leaves.isNull().cast("long")).withColumn("_at", F.coalesce(leaves, F.col("_slot")).cast("long"))
    return ordering.number_rows(held, ["_late", "_at"], name).drop("_slot", "_late", "_at")


def repeat_first(rows: DataFrame, position: str, items: int, size: int) -> DataFrame:
    """The first `items` numbered rows, over and over, to `size` rows."""
    times = F.floor((F.lit(size) - 1 - F.col(position)) / items)
    turn = F.explode(F.sequence(F.lit(0).cast("long"), times)).alias("_turn")
    out = rows.where((F.col(position) < items) & (F.col(position) < size)).select("*", turn)
    return out.withColumn("out_position", F.col("_turn") * items + F.col(position)).drop("_turn")


def gather_ranks(rows: DataFrame, rank: str, local: str, total: Column, ranks: int, name: str = "position") -> DataFrame:
    """Rows of all ranks in the order of the data they were dealt from, round by round; fillers past `total` are left out."""
    out = rows.withColumn(name, (F.col(local) * ranks + F.col(rank)).cast("long"))
    return out.where(F.col(name) < total)


def zip_tables(tables: dict[str, DataFrame], position: str) -> DataFrame:
    """Rows of the same position as structs by name, as far as the shortest table goes; positions count from 0 without gaps."""
    out = None
    for name, rows in tables.items():
        one = rows.select(F.col(position), F.struct(*[c for c in rows.columns if c != position]).alias(name))
        out = one if out is None else out.join(one, position)
    return out
