"""Recurrences by ranges against loops."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import scan


@pytest.mark.parametrize("size", [1, 3, 7, 1000])
def test_recurrences_are_the_loop(spark, size):
    """Several keys, a null one, gaps, negative positions, nulls, and clashing names."""
    rng = random.Random(size)
    rows = [(k, p, rng.choice([0.0, 1.0, -1.0, 0.5, None]), rng.choice([1.0, 2.0, None])) for k in ("a", "b", None) for p in sorted(rng.sample(range(-30, 60), 40))]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "k string, p int, a double, b double, _a string, _range int").repartition(3)
    want, y = {}, {}
    for k, p, a, b in rows:
        y[k] = (1.0 if a is None else a) * y.get(k, 0.0) + (b or 0.0)
        want[k, p] = y[k]
    got = {(r.k, r.p): r.y for r in scan.affine_scan(df, ["k"], "p", F.col("a"), F.col("b"), "y", size).collect()}
    assert got == pytest.approx(want)
    whole = scan.affine_scan(df.where("k = 'a'"), [], "p", F.col("a"), F.col("b"), "_a", size)
    assert {("a", r.p): r._a for r in whole.collect()} == pytest.approx({x: v for x, v in want.items() if x[0] == "a"})
    assert scan.affine_scan(df.limit(0), ["k"], "p", F.col("a"), F.col("b"), "y", size).collect() == []


def test_averages_sums_and_signs(spark):
    rng = random.Random(5)
    rows = [(k, i, rng.uniform(-1, 1), rng.choice([1.0, -1.0, 0.0, None])) for k in (1, 2) for i in range(50)]
    df = spark.createDataFrame(rows, "k int, i int, x double, d double")
    ema, sums, signs, s, e = {}, {}, {}, 1, 0.0
    for k, i, x, d in rows:
        e = x if i == 0 else 0.9 * e + (1 - 0.9) * x
        s = 1 if not d else s * (-1 if d < 0 else 1)
        ema[k, i], signs[k, i] = e, s
    for k, i, x, _ in reversed(rows):
        sums[k, i] = x + 0.8 * sums.get((k, i + 1), 0.0)
    of = lambda out, c: {(r.k, r.i): r[c] for r in out.collect()}
    assert of(scan.moving_average(df, ["k"], "i", "x", 0.9, size=8), "ema") == pytest.approx(ema)
    assert of(scan.discounted_sums(df, ["k"], "i", "x", 0.8, size=8), "value") == pytest.approx(sums)
    assert of(scan.running_sign(df, ["k"], "i", F.col("d"), size=8), "sign") == signs


def test_one_long_sequence_is_many_tasks(spark):
    """One key of a million steps, no task of which reads more than some ranges."""
    n = 1_000_000
    rows = spark.range(n).select(F.lit("k").alias("k"), F.col("id").alias("i"), (F.col("id") * 7919 % 1000).cast("double").alias("x"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = scan.moving_average(rows, ["k"], "i", "x", 0.99).withColumn("part", F.spark_partition_id())
        got = out.where("i % 9973 = 0").select("i", "ema").collect()
        assert out.groupBy("part").count().count() > 2
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    x = (np.arange(n) * 7919 % 1000).astype(float).tolist()
    y, want = x[0], {}
    for i, v in enumerate(x):
        y = 0.99 * y + (1 - 0.99) * v if i else v
        if i % 9973 == 0:
            want[i] = y
    assert {r.i: r.ema for r in got} == pytest.approx(want)
