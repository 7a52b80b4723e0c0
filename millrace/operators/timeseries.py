"""Alignment of streams by time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_nearest(targets: DataFrame, sources: DataFrame, by: str, ts: str, value: str, name: str, span: float | None = None) -> DataFrame:
    """Targets (by, ts) with the value of the nearest source (by, ts, value): the earlier of two as near, the end ones outside.

    Both sides are sorted by (by, ts) together, once forwards and once backwards, and the last source seen is carried along; no
    join of targets and sources. Source stamps must be distinct within `by`; null where there is no source. With `span`, a
    stream is cut into ranges of that length, each sorted by itself; a table of a row per range hands the nearest sources
    outside it on, so one long stream is not one task's.
    """
    empty = F.lit(None).cast(sources.schema[value].dataType)
    part = (lambda c: F.floor(c / F.lit(span))) if span else (lambda c: F.lit(0))
    t = targets.select(F.col(by).alias("by"), F.col(ts).alias("t"), F.lit(0).alias("k"), empty.alias("v"), F.struct(*targets.columns).alias("row"))
    s = sources.select(F.col(by).alias("by"), F.col(ts).alias("t"), F.lit(1).alias("k"), F.col(value).alias("v"), F.lit(None).cast(t.schema["row"].dataType).alias("row"))
    source = F.when(F.col("k") == 1, F.struct("t", "v"))
    both = s.unionByName(t).withColumn("part", part(F.col("t"))).withColumn("s", source)
    w = Window.partitionBy("by", "part")
    so_far = lambda *order: F.last("s", True).over(w.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    both = both.withColumns({"p": so_far("t", "k"), "q": so_far(F.col("t").desc(), F.col("k").desc())}).where("k = 0")
    if span:
        own = s.withColumn("part", part(F.col("t"))).groupBy("by", "part").agg(F.min(F.struct("t", "v")).alias("first"), F.max(F.struct("t", "v")).alias("last"))
        ranges = both.select("by", "part").distinct().join(own, ["by", "part"], "full")
        r = Window.partitionBy("by")
        ranges = ranges.select("by", "part", F.last("last", True).over(r.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("p0"), F.last("first", True).over(r.orderBy(F.col("part").desc()).rowsBetween(Window.unboundedPreceding, -1)).alias("q0"))
        both = both.join(ranges, ["by", "part"]).withColumns({"p": F.coalesce("p", "p0"), "q": F.coalesce("q", "q0")})
    near = F.col("q").isNull() | (F.abs(F.col("p.t") - F.col("t")) <= F.abs(F.col("q.t") - F.col("t")))
    picked = F.when(F.col("p").isNotNull() & near, F.col("p.v")).otherwise(F.col("q.v"))
    return both.select("row.*", picked.alias(name))


def sync_streams(grid: DataFrame, streams: dict[str, list[DataFrame]], by: str, ts: str, value: str, span: float | None = None) -> DataFrame:
    """A column per stream at each grid point, the value of the nearest row as asof_nearest() picks it; a stream's later DataFrames stand
    in where `by` has none of the earlier.

    All streams and the grid are dealt out together and sorted once in either direction, with the last row seen of every stream
    carried along: one exchange of the rows for any number of streams. With `span`, a sequence is cut into ranges of that length,
    and a table of a row per range hands on what is nearest outside. Stamps must be distinct within `by` and a stream.
    """
    options = [(name, rows) for name, all_ in streams.items() for rows in all_]
    part = (lambda c: F.floor(c / F.lit(span))) if span else (lambda c: F.lit(0))
    both = grid.select(F.col(by).alias("by"), F.col(ts).alias("t"), F.lit(-1).alias("s"), F.struct(*grid.columns).alias("row"))
    for i, (_, rows) in enumerate(options):
        own = rows.select(F.col(by).alias("by"), F.col(ts).alias("t"), F.lit(i).alias("s"), F.struct(F.col(ts).alias("t"), F.col(value).alias("v")).alias(f"x{i}"))
        both = both.unionByName(own, allowMissingColumns=True)
    both = both.withColumn("part", part(F.col("t")))
    w, source = Window.partitionBy("by", "part"), (F.col("s") >= 0).cast("int")
    ahead = w.orderBy("t", source).rowsBetween(Window.unboundedPreceding, -1)
    back = w.orderBy(F.col("t").desc(), source.desc()).rowsBetween(Window.unboundedPreceding, -1)
    n = range(len(options))
    out = both.select("*", *[F.last(f"x{i}", True).over(ahead).alias(f"p{i}") for i in n])
    out = out.select("by", "t", "s", "row", "part", *[f"p{i}" for i in n], *[F.last(f"x{i}", True).over(back).alias(f"q{i}") for i in n]).where("s = -1")
    if span:
        ends = [f(f"x{i}").alias(f"{c}{i}") for i in n for f, c in ((F.min, "first"), (F.max, "last"))]
        own = both.groupBy("by", "part").agg(*ends)  # a row per range
        r = Window.partitionBy("by")
        before, after = r.orderBy("part").rowsBetween(Window.unboundedPreceding, -1), r.orderBy(F.col("part").desc()).rowsBetween(Window.unboundedPreceding, -1)
        carried = own.select(F.col("by").alias("by_"), F.col("part").alias("part_"), *[x for i in n for x in (F.last(f"last{i}", True).over(before).alias(f"p{i}_"), F.last(f"first{i}", True).over(after).alias(f"q{i}_"))])
        out = out.join(carried, F.col("by").eqNullSafe(F.col("by_")) & F.col("part").eqNullSafe(F.col("part_")), "left")
        out = out.withColumns({f"{c}{i}": F.coalesce(f"{c}{i}", f"{c}{i}_") for i in n for c in "pq"})
    columns, at = [], 0
    for name, all_ in streams.items():
        picked = F.lit(None)
        for i in reversed(range(at, at + len(all_))):
            p, q = F.col(f"p{i}"), F.col(f"q{i}")
            near = F.when(p.isNotNull() & (q.isNull() | (F.abs(p["t"] - F.col("t")) <= F.abs(q["t"] - F.col("t")))), p["v"]).otherwise(q["v"])
            picked = F.when(p.isNotNull() | q.isNotNull(), near).otherwise(picked)
        columns.append(picked.alias(name))
        at += len(all_)
    return out.select("row.*", *columns)


def stream_quality(rows: DataFrame, by: list[str], ts: str, valid: Column, start: Column, end: Column) -> DataFrame:
    """Per stream: messages, valid and corrupt ones, the largest gap, and the time before the first and after the last."""
    gap = F.col(ts) - F.lag(ts).over(Window.partitionBy(*by).orderBy(ts))
    rows = rows.withColumn("_gap", gap).withColumn("_valid", valid.cast("int"))
    return rows.groupBy(*by).agg(
        F.count("*").alias("messages"),
        F.sum("_valid").alias("valid"),
        (F.count("*") - F.sum("_valid")).alias("corrupt"),
        F.max("_gap").alias("max_gap"),
        (F.min(ts) - F.min(start)).alias("leading"),
        (F.max(end) - F.max(ts)).alias("trailing"),
    )


def runs(rows: DataFrame, by: list[str], order: list[str], value: str, name: str = "run") -> DataFrame:
    """Number the runs of equal neighbours, from 0; nulls are equal to each other."""
    w = Window.partitionBy(*by).orderBy(*order)
    first = F.row_number().over(w) == 1
    changed = F.when(first, 0).otherwise((~F.col(value).eqNullSafe(F.lag(value).over(w))).cast("int"))
    return rows.withColumn("_changed", changed).withColumn(name, F.sum("_changed").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_changed")
