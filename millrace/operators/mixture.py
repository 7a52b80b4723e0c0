"""Mixtures, sampling and sharding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.ordering import number_rows


def draw(*key: Column, seed: int = 0) -> Column:
    """A uniform number in [0, 1) that depends on the key alone: the first 52 bits of the MD5 of seed and key, joined by bars."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in key]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def epoch_structures(demos: Column, success: Column, failure: Column, p: float, q: float) -> Column:
    """Samples of an epoch as a struct of demo, success and failure, for a share p of demonstrations and q of successes in the rest.

    The scarcer kind is repeated until the share holds, never cut; a kind that is missing has no share. A share of 0 leaves the
    kind out, one of 1 the other; rollouts are left out by p = 1 only where there are demonstrations.
    """
    if not (0 <= p <= 1 and 0 <= q <= 1):
        raise ValueError("shares must be between 0 and 1")
    whole, long = lambda c: F.floor(c).cast("long"), lambda c: c.cast("long")
    nothing = F.lit(0).cast("long")
    if q in (0, 1):
        only_f = (success == 0) | F.lit(q == 0)
        only_s = ~only_f & ((failure == 0) | F.lit(q == 1))
        s, f, share = F.when(only_f, nothing).otherwise(success), F.when(only_s, nothing).otherwise(failure), F.when(only_f, 0.0).otherwise(1.0)
    else:
        more_s, more_f = whole(failure * q / (1 - q)), whole(success * (1 - q) / q)
        both = (success > 0) & (failure > 0)
        s = F.when(both & (success < more_s), more_s).otherwise(success)
        f = F.when(both & (success >= more_s), more_f).otherwise(failure)
        share = F.when(both, F.lit(q)).otherwise((success > 0).cast("double"))
    none, no_demos = success + failure == 0, (demos == 0) | F.lit(p == 0)
    if p in (0, 1):  # without demonstrations, or with nothing else
        d, ds, df = (F.when(no_demos, x).otherwise(y) for x, y in ((nothing, demos), (s, nothing), (f, nothing)))
    else:
        more_d, more_r = whole((s + f) * p / (1 - p)), whole(demos * (1 - p) / p)
        few = no_demos | (demos < more_d)
        d = F.when(no_demos, nothing).when(few, more_d).otherwise(demos)
        ds, df = F.when(few, s).otherwise(whole(more_r * share)), F.when(few, f).otherwise(whole(more_r * (1 - share)))
    return F.struct(long(F.when(none, demos).otherwise(d)).alias("demo"), long(F.when(none, 0).otherwise(ds)).alias("success"), long(F.when(none, 0).otherwise(df)).alias("failure"))


def sample_type(idx: Column, demos: int, success: int) -> Column:
    return F.when(idx < demos, "demo").when(idx < demos + success, "success").otherwise("failure")


def weighted_choice(u: Column, weights: dict[str, float], available: Callable[[str], Column]) -> Column:
    """One of the available names, by weight, from a uniform number; null if none is available."""
    total = sum((F.when(available(k), w).otherwise(0.0) for k, w in weights.items()), F.lit(0.0))
    out, before = F.lit(None).cast("string"), F.lit(0.0)
    for k, w in weights.items():
        upper = before + F.when(available(k), w).otherwise(0.0)
        out = F.coalesce(out, F.when(available(k) & (u * total < upper), F.lit(k)))
        before = upper
    return out


def shard_owner(position: Column, n: int, ranks: int, workers: int) -> DataFrame | tuple[Column, Column]:
    """Rank and worker of a shard by its position; positions cover n shards repeated to a multiple of all workers."""
    return F.pmod(position, F.lit(ranks)).cast("int"), F.pmod(F.floor(position / ranks), F.lit(workers)).cast("int")


def repeat_to(rows: DataFrame, position: str, n: int, size: int) -> DataFrame:
    """Cycle `n` numbered rows to `size` rows (0 gives none); an empty input fails."""
    if n == 0 and size:
        raise ValueError("nothing to repeat")
    times = -(-size // n) if n else 0
    turn = F.explode(F.sequence(F.lit(0), F.lit(max(times - 1, 0)))).alias("_turn")
    out = rows.select("*", turn).withColumn("out_position", F.col("_turn") * n + F.col(position))
    return out.where(F.col("out_position") < size).drop("_turn")


def interleave_rows(tables: dict[str, DataFrame], ratios: dict[str, int], number: str, name: str = "position") -> DataFrame:
    """Rows of several tables in rounds of as many of each as its ratio, by their numbers from 0: source, the row's number and position.

    A row's position follows from its number, so nothing is dealt out or sorted. A table that ends early leaves its places empty.
    """
    out, before, every = None, 0, sum(ratios.values())
    for source, rows in tables.items():
        n, k = F.col(number), ratios[source]
        own = rows.select(F.lit(source).alias("source"), n.alias(number), (F.floor(n / k) * every + before + n % k).cast("long").alias(name))
        out, before = own if out is None else out.unionByName(own), before + k
    return out


def allocate_workers(groups: DataFrame, group: str, count: str, workers: int) -> DataFrame:
    """(group, workers): one for each group, then each of the rest to the group that lacks most of its share, the first of equals.

    What a group lacks is its share of the rows less its share of the workers given so far, which each worker changes for all; so
    the workers are a fold, over the array of the groups, which are at most as many.
    """
    held = groups.agg(F.array_sort(F.collect_list(F.struct(F.col(group).alias("g"), F.col(count).cast("double").alias("n")))).alias("x"))  # a row per group
    held = held.select("x", F.aggregate("x", F.lit(0.0), lambda a, x: a + x["n"]).alias("total"), F.size("x").alias("groups"))
    held = held.where(F.when(F.col("groups") > workers, F.raise_error(F.lit("fewer workers than groups")).cast("boolean")).otherwise(F.lit(True)))
    step = F.sequence(F.lit(0), F.lit(workers - 1))

    def give(have: Column, k: Column) -> Column:
        """Worker k (from 0) goes to the first group of the least share given less share wanted; the first ones are given already."""
        lack = F.transform(have, lambda w, i: w / k - F.get(F.col("x"), i)["n"] / F.col("total"))
        first = F.array_position(lack, F.array_min(lack)) - 1
        return F.when(k < F.col("groups"), have).otherwise(F.transform(have, lambda w, i: w + F.when(i == first, 1).otherwise(0)))

    fold = F.aggregate(step, F.transform("x", lambda x: F.lit(1)), give)
    return held.select(F.explode(F.arrays_zip(F.transform("x", lambda x: x["g"]).alias("g"), fold.alias("w"))).alias("r")).select(F.col("r.g").alias(group), F.col("r.w").cast("int").alias("workers"))


def equal_shares(groups: DataFrame, group: str, count: str, workers: int) -> DataFrame:
    """(group, workers, share): the workers in proportion to count, rounded up, where the largest group (the first of equals) takes the
    difference; and the rows with which each of its workers has as many as any other, ceil(all rows / workers)."""
    all_rows = Window.partitionBy()
    n = F.sum(count).over(all_rows)
    rows = groups.select(group, count, F.ceil(F.col(count) / n * workers).cast("long").alias("_share"), F.ceil(n / workers).cast("long").alias("_each"))
    largest = F.row_number().over(Window.orderBy(F.col(count).desc(), F.col(group))) == 1
    rows = rows.withColumn("_over", F.sum("_share").over(all_rows) - workers).withColumn("_largest", largest)
    own = F.col("_share") - F.when(F.col("_largest"), F.col("_over")).otherwise(0)
    return rows.select(group, own.alias("workers"), (own * F.col("_each")).alias("share"))


def equalize(rows: DataFrame, group: str, order: str, workers: int) -> DataFrame:
    """Each group's rows repeated in `order`, a number, to the group's equal_shares(); copy counts the repetitions from 0.

    Only the largest group may lose rows. Places within a group come from one numbering of all rows by group and order, cut into
    ranges, so a group that has most of the rows is many tasks.
    """
    counts = rows.groupBy(group).agg(F.count("*").alias("_n"))  # a row per group
    before = F.coalesce(F.sum("_n").over(Window.orderBy(group).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    table = equal_shares(counts, group, "_n", workers).select(group, "share").join(counts, group)
    table = table.select(group, "share", "_n", before.alias("_before"), F.row_number().over(Window.orderBy(group)).alias("_g"))
    numbered = number_rows(rows.join(table, group), ["_g", order], "_i").withColumn("_i", F.col("_i") - F.col("_before"))
    times = F.floor((F.col("share") - F.col("_i") - 1) / F.col("_n")) + 1  # places i, i + n, ... below the share
    out = numbered.withColumn("_times", times.cast("int")).where("_times > 0")
    return out.select(*rows.columns, F.explode(F.sequence(F.lit(0), F.col("_times") - 1)).alias("copy"))


def add_noise(rows: DataFrame, column: str, key: list[str], std: float, lo: Column, hi: Column, dropout: float = 0.0, seed: int = 0) -> DataFrame:
    """Gaussian noise, clamped to [lo, hi]; with a probability of `dropout` the value is 0. The same on every run."""
    u1, u2 = draw(*map(F.col, key), seed=seed), draw(*map(F.col, key), seed=seed + 1)
    z = F.sqrt(-2 * F.log(1 - u1)) * F.cos(6.283185307179586 * u2)
    noisy = F.least(hi, F.greatest(lo, F.col(column) + std * z))
    return rows.withColumn(column, F.when(draw(*map(F.col, key), seed=seed + 2) < dropout, 0.0).otherwise(noisy))


def suppress_overlaps(boxes: DataFrame, by: str, limit: float, top: int, keep: int) -> DataFrame:
    """Greedy non-maximum suppression of (by, score, x0, y0, x1, y1): of each group's `top` best boxes those that overlap no kept
    better one by more than `limit` of their union, `keep` at most. Equal scores go by coordinates.

    A group is an array of at most `top` boxes, folded from the best one on.
    """
    sides = ["x0", "y0", "x1", "y1"]
    order = [F.col("score").desc(), *sides]
    best = boxes.withColumn("_k", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("_k") <= top)
    groups = best.groupBy(by).agg(F.array_sort(F.collect_list(F.struct("_k", "score", *sides))).alias("_boxes"))

    def overlap(a: Column, b: Column) -> Column:
        area = lambda c: (c["x1"] - c["x0"]) * (c["y1"] - c["y0"])
        w = F.greatest(F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"]), F.lit(0.0))
        h = F.greatest(F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"]), F.lit(0.0))
        return w * h / F.greatest(area(a) + area(b) - w * h, F.lit(1e-12))

    none = F.slice("_boxes", 1, 0)
    step = lambda kept, x: F.when((F.size(kept) < keep) & ~F.exists(kept, lambda k: overlap(x, k) > limit), F.array_append(kept, x)).otherwise(kept)
    return groups.select(by, F.explode(F.aggregate("_boxes", none, step)).alias("_b")).select(by, "_b.score", *[f"_b.{c}" for c in sides])
