"""Positions in a global order, without gathering all rows in one task.

Rows are cut into ranges of the order at approximate quantiles, which are one row of the plan; rows are numbered within their
range, and the few range totals are summed up and broadcast. Nothing runs before the result is asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Ranges that the rows are cut into, a power of two, and the accuracy of their cuts.
RANGES, ACCURACY = 1024, 10_000


def _leading(rows: DataFrame, order: list[str]) -> tuple[DataFrame, Column]:
    """Rows with what the expression needs, and a number that never falls along the order.

    It is the first column or, if that is a whole number, the first column plus the place of the second between its ends, so
    that rows of one leading value are ranges of their own too.
    """
    kinds = [rows.schema["row"].dataType[c].dataType for c in order[:2]]
    first = F.col(f"row.`{order[0]}`").cast("double")
    if len(order) < 2 or not isinstance(kinds[0], T.IntegralType) or not isinstance(kinds[1], T.NumericType):
        return rows, first
    second = F.col(f"row.`{order[1]}`").cast("double")
    ends = rows.agg(F.min(second).alias("_lo"), F.max(second).alias("_hi"))
    place = (second - F.col("_lo")) / F.greatest(F.col("_hi") - F.col("_lo"), F.lit(1e-300))
    return rows.join(F.broadcast(ends)), first + F.coalesce(place, F.lit(0.0)) * 0.999


def running_total(rows: DataFrame, order: list[str], value: Column, name: str, exclusive: bool = True) -> DataFrame:
    """Rows with the sum of `value` over the rows before (or up to) them in `order`, whose first column is numeric; nulls come first.

    Other columns may have any names; a column of the result's name is replaced.
    """
    held, lead = _leading(rows.select(F.struct(*rows.columns).alias("row"), value.alias("_value")), order)
    held = held.select("row", "_value", lead.alias("_lead"))
    cuts = held.agg(F.percentile_approx("_lead", [i / RANGES for i in range(1, RANGES)], ACCURACY).alias("_cuts"))  # one row
    steps = F.array(*[F.lit(RANGES >> k) for k in range(1, RANGES.bit_length())])
    search = F.aggregate(steps, F.lit(0), lambda at, k: F.when(F.get("_cuts", at + k - 1) < F.col("_lead"), at + k).otherwise(at))
    held = held.join(F.broadcast(cuts)).select("row", "_value", F.coalesce(search, F.lit(0)).alias("_range"))
    keys = [F.col(f"row.`{c}`") for c in order]
    within = Window.partitionBy("_range").orderBy(*keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = held.groupBy("_range").agg(F.sum("_value").alias("_total"))  # a row per range
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_range", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))
    out = held.withColumn("_sum", F.sum("_value").over(within)).join(F.broadcast(offsets), "_range")
    total = F.col("_sum") + F.col("_before") - (F.col("_value") if exclusive else F.lit(0))
    return out.select(*[F.col(f"row.`{c}`") for c in rows.columns if c != name], total.alias(name))


def number_rows(rows: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """Rows with their place in `order`, from 0."""
    return running_total(rows, order, F.lit(1).cast("long"), name)


def rank_ranges(n: int, ranks: int) -> list[tuple[int, int, bool]]:
    """(start, end, overflow) of each rank's share of n rows; with fewer rows than ranks, later ranks get a repeated row."""
    if n < ranks:
        return [(r % max(n, 1), r % max(n, 1) + min(n, 1), r >= n) for r in range(ranks)]
    low, extra = divmod(n, ranks)
    starts = [r * low + min(r, extra) for r in range(ranks + 1)]
    return [(starts[r], starts[r + 1], False) for r in range(ranks)]
