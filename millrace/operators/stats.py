"""Statistics of vectors and metrics; all exact."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def by_dimension(rows: DataFrame, vector: str, *keep: str) -> DataFrame:
    """A row (dim, x) per element."""
    return rows.select(*keep, F.posexplode(vector).alias("dim", "x"))


#: Approximate quantiles are off by one rank in so many at most; a bracket is twice as wide to either side.
ACCURACY = 1000


def exact_quantiles(rows: DataFrame, by: list[str], x: str, quantiles: dict[str, float]) -> DataFrame:
    """Linearly interpolated quantiles of x for each group of `by`, exact, by name; nulls of x are passed over.

    No task holds a group's values: approximate quantiles give each wanted rank a bracket, and one more pass counts what is below it
    and the distinct values inside, of which the wanted ranks are picked.
    """
    values = rows.select(*by, F.col(x).cast("double").alias("_x")).where("_x is not null")
    names, qs = list(quantiles), list(quantiles.values())
    ends = [min(1.0, max(0.0, q + e)) for q in qs for e in (-2 / ACCURACY, 2 / ACCURACY)]
    near = values.groupBy(*by).agg(F.count("*").alias("_n"), F.percentile_approx("_x", ends, ACCURACY).alias("_ends"), F.min("_x").alias("_min"), F.max("_x").alias("_max"))
    wanted = []
    for i, q in enumerate(qs):
        rank = (F.col("_n") - 1) * F.lit(q)
        few = F.col("_n") <= 4 * ACCURACY  # a bracket would be narrower than some ranks
        lo = F.when(few | (F.floor(rank) * ACCURACY <= 3 * F.col("_n")), F.col("_min")).otherwise(F.get("_ends", F.lit(2 * i)))
        hi = F.when(few | ((F.col("_n") - F.ceil(rank)) * ACCURACY <= 3 * F.col("_n")), F.col("_max")).otherwise(F.get("_ends", F.lit(2 * i + 1)))
        wanted.append(F.struct(F.lit(names[i]).alias("q"), rank.alias("rank"), lo.alias("lo"), hi.alias("hi")))
    brackets = near.select(*by, F.array(*wanted).alias("_w"))
    inside = values.join(F.broadcast(brackets), by) if by else values.join(F.broadcast(brackets))
    # a value below a bracket only counts; inside it, equal values are one row with their number
    spread = inside.select(*by, "_x", F.explode("_w").alias("w")).where("_x <= w.hi")
    place = F.when(F.col("_x") >= F.col("w.lo"), F.col("_x"))
    held = spread.groupBy(*by, F.col("w.q").alias("q"), F.col("w.rank").alias("rank"), place.alias("v")).agg(F.count("*").alias("m"))
    order = Window.partitionBy(*by, "q").orderBy(F.col("v").asc_nulls_first())
    upto = held.withColumn("upto", F.sum("m").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    at = lambda rank: F.min(F.when(F.col("upto") > rank, F.col("v")))
    low, high, part = at(F.floor("rank")), at(F.ceil("rank")), F.first("rank") - F.floor(F.first("rank"))
    picked = upto.groupBy(*by, "q").agg((low + (high - low) * part).alias("value"))
    return picked.groupBy(*by).agg(*[F.max(F.when(F.col("q") == k, F.col("value"))).alias(k) for k in names])


def vector_stats(rows: DataFrame, vector: str, quantiles: bool = False) -> DataFrame:
    """min, max, mean, population std and median of each dimension, and q01 and q99; all exact."""
    long = by_dimension(rows, vector)
    plain = long.groupBy("dim").agg(F.min("x").alias("min"), F.max("x").alias("max"), F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"))
    return plain.join(exact_quantiles(long, ["dim"], "x", {"median": 0.5} | ({"q01": 0.01, "q99": 0.99} if quantiles else {})), "dim")


def masked_defaults(stats: DataFrame, below: int) -> DataFrame:
    """Dimensions below a number get the statistics of an identity."""
    fixed = {"min": -1.0, "max": 1.0, "mean": 0.0, "std": 1.0, "median": 0.0}
    return stats.select("dim", *[F.when(F.col("dim") < below, v).otherwise(F.col(k)).alias(k) for k, v in fixed.items()])


def rate(hit: Column) -> Column:
    """Share of rows; 0 for none."""
    return F.coalesce(F.avg(hit.cast("double")), F.lit(0.0))


def mean_where(x: Column, ok: Column, empty: float = 0.0) -> Column:
    """Mean of x over some rows, and a value of its own for none."""
    return F.coalesce(F.avg(F.when(ok, x)), F.lit(empty))


def finite(x: Column) -> Column:
    return ~F.isnan(x) & (F.abs(x) < math.inf)


def gradient_norm_means(steps: DataFrame, iteration: str, kind: str, kinds: list[str], gradient: str, every: int) -> DataFrame:
    """(iteration, kind, mean) at each iteration that is a multiple of `every`: the mean norm of the gradients of a kind since the one before.

    Components that are not finite, or null, count as 0. A kind without a step since then has 0, and so has one that is not in any. Steps
    after the last such iteration are not in the result.
    """
    norm = F.sqrt(F.aggregate(gradient, F.lit(0.0), lambda a, x: a + F.when(finite(x), x * x).otherwise(0.0)))
    rows = steps.select((F.ceil(F.col(iteration) / every) * every).cast("long").alias("iteration"), F.col(kind).alias("kind"), norm.alias("_norm"), (F.col(iteration) % every == 0).alias("_log"))
    means = [F.coalesce(F.avg(F.when(F.col("kind") == k, F.col("_norm"))), F.lit(0.0)) for k in kinds]
    pairs = F.array(*[F.struct(F.lit(k).alias("kind"), m.alias("mean")) for k, m in zip(kinds, means, strict=True)])
    windows = rows.groupBy("iteration").agg(pairs.alias("_m"), F.max("_log").alias("_log")).where("_log")
    return windows.select("iteration", F.inline("_m"))


def ensemble(v: Column, scheme: str, threshold: float = 0.05) -> Column:
    """average, lcb, success_vote or majority_mean of the rows of a group, in [0, 1]; lcb of one row is NaN."""
    good = v > threshold
    if scheme == "average":
        out = F.avg(v)
    elif scheme == "lcb":
        spread = F.when(F.count(v) > 1, F.stddev_samp(v)).otherwise(F.lit(float("nan")))
        out = F.avg(v) - spread
        return F.when(F.isnan(out), out).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), out)))
    elif scheme == "success_vote":
        out = F.avg(good.cast("double"))
    elif scheme == "majority_mean":
        n = F.sum(good.cast("int"))
        out = F.when(2 * n >= F.count(v), F.sum(F.when(good, v).otherwise(0.0)) / F.greatest(n, F.lit(1))).otherwise(0.0)
    else:
        raise ValueError(f"no ensemble {scheme!r}")
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), out))


def first_by(rows: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("_n = 1").drop("_n")
