"""Recurrences along sequences of any length: y[i] = a[i] * y[i - 1] + b[i].

A step is an affine map, and maps compose: so a long sequence is cut into ranges, each of which composes its own maps in a task,
the composed maps of the ranges are scanned in turn, and each range gets what the one before hands on. Moving averages, discounted
sums and products of signs are such recurrences.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

#: Positions of a range.
RANGE = 1 << 16


def _compose(rows: DataFrame, by: list[str], order: str) -> DataFrame:
    """Rows with _a and _b as the maps composed from the first row of each group on; a group is one task's."""
    w = Window.partitionBy(*by).orderBy(order)
    marked = rows.withColumn("_first", F.row_number().over(w) == 1)  # sorts, and what follows keeps the order

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y = 1.0, 0.0
        for batch in it:
            i, j, k = (batch.schema.get_field_index(c) for c in ("_a", "_b", "_first"))
            out_a, out_b = [], []
            for a, b, first in zip(batch.column(i).to_pylist(), batch.column(j).to_pylist(), batch.column(k).to_pylist(), strict=True):
                x, y = (a, b) if first else (a * x, a * y + b)
                out_a.append(x)
                out_b.append(y)
            columns = list(batch.columns)
            columns[i], columns[j] = pa.array(out_a, pa.float64()), pa.array(out_b, pa.float64())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return marked.mapInArrow(run, marked.schema).drop("_first")


def affine_scan(rows: DataFrame, by: list[str], position: str, a: Column, b: Column, name: str, size: int = RANGE) -> DataFrame:
    """Rows with y[i] = a[i] * y[i - 1] + b[i] in the order of `position`, a whole number, within `by`; y is 0 before the first row.

    `size` positions are one task's at a time, and the ranges of a sequence (a row each) another's. Null a or b count as 1 and 0. Positions
    must be distinct within `by`; they may have gaps. Null keys are keys of their own. An empty table gives no rows.
    """
    if size < 1:
        raise ValueError("a range needs a position")
    held = rows.select(F.struct(*rows.columns).alias("_row"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)], F.col(position).alias("_at"), F.coalesce(a.cast("double"), F.lit(1.0)).alias("_a"), F.coalesce(b.cast("double"), F.lit(0.0)).alias("_b"))
    held = held.withColumn("_range", F.floor(F.col("_at") / size))
    keys = [f"_k{i}" for i in range(len(by))]
    local = _compose(held, [*keys, "_range"], "_at")
    last = local.groupBy(*keys, "_range").agg(F.max_by(F.struct("_a", "_b"), "_at").alias("_m")).select(*keys, "_range", "_m.*")
    ranges = _compose(last, keys, "_range") if keys else _compose(last.withColumn("_k", F.lit(0)), ["_k"], "_range")
    before = Window.partitionBy(*(keys or ["_k"])).orderBy("_range")
    carried = ranges.select(*[F.col(k).alias(f"{k}_") for k in keys], F.col("_range").alias("_range_"), F.coalesce(F.lag("_b").over(before), F.lit(0.0)).alias("_carry"))
    same = F.col("_range") == F.col("_range_")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}_"))
    out = local.join(carried, same)
    return out.select(*[F.col(f"_row.`{c}`") for c in rows.columns if c != name], (F.col("_a") * F.col("_carry") + F.col("_b")).alias(name))


def moving_average(rows: DataFrame, by: list[str], position: str, value: str, beta: float, name: str = "ema", size: int = RANGE) -> DataFrame:
    """Rows with beta * (the average before) + (1 - beta) * value; the first average, at position 0, is its value."""
    first = F.col(position) == 0
    return affine_scan(rows, by, position, F.when(first, 0.0).otherwise(beta), F.when(first, F.col(value)).otherwise((1 - beta) * F.col(value)), name, size)


def discounted_sums(rows: DataFrame, by: list[str], position: str, reward: str, gamma: float, name: str = "value", size: int = RANGE) -> DataFrame:
    """Rows with the sum of the rewards from each position on, each discounted by gamma for every row between."""
    back = rows.withColumn("_back", -F.col(position))
    return affine_scan(back, by, "_back", F.lit(gamma), F.col(reward), name, size).drop("_back")


def running_sign(rows: DataFrame, by: list[str], position: str, dot: Column, name: str = "sign", size: int = RANGE) -> DataFrame:
    """Rows with 1 or -1, which changes where dot is negative; a dot of 0, or none, starts anew with 1."""
    reset = dot.isNull() | (dot == 0)
    out = affine_scan(rows, by, position, F.when(reset, 0.0).when(dot < 0, -1.0).otherwise(1.0), F.when(reset, 1.0).otherwise(0.0), name, size)
    return out.withColumn(name, F.col(name).cast("int"))
