"""Several streams on one grid against a search of every stream."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import timeseries


def plain(grid, options, key, t):
    for rows in options:
        own = sorted((abs(x - t), x, v) for k, x, v in rows if k == key)
        if own:
            return own[0][2]
    return None


@pytest.mark.parametrize("span", [None, 0.5, 7.0, 1000.0])
def test_nearest_of_each_stream(spark, span):
    """Keys without a stream, streams that stand in for another, equal stamps, null values, and points outside."""
    rng = random.Random(4)
    stream = lambda keys, n: [(k, float(t), rng.choice([rng.randint(0, 99), None])) for k in keys for t in rng.sample(range(-20, 60), n)]
    data = {"a": [stream("xyz", 9)], "b": [stream("x", 3), stream("xyw", 12)], "c": [stream("v", 4)]}
    grid = [(k, t / 2, i) for i, (k, t) in enumerate((k, t) for k in "xyzwu" for t in range(-60, 140, 3))]
    df = lambda rows, last: spark.createDataFrame(rows, f"k string, t double, {last} int").repartition(2)
    streams = {name: [df(rows, "v") for rows in all_] for name, all_ in data.items()}
    out = timeseries.sync_streams(df(grid, "i"), streams, "k", "t", "v", span).collect()
    assert {(r.i, r.k, r.t, r.a, r.b, r.c) for r in out} == {(i, k, t, *(plain(grid, data[n], k, t) for n in "abc")) for k, t, i in grid}
    assert len(out) == len(grid)


def test_one_exchange_for_any_number_of_streams(spark):
    rows = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").cast("double").alias("t"), F.col("id").alias("v"))
    streams = {f"s{i}": [rows.where(F.col("v") % 5 == i)] for i in range(5)}
    plan = timeseries.sync_streams(rows.select("k", "t"), streams, "k", "t", "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_one_long_sequence(spark):
    """A key of 300,000 stamps in ranges of 1,000."""
    n = 300_000
    rows = spark.range(n).select(F.lit("k").alias("k"), F.col("id").cast("double").alias("t"), F.col("id").alias("v"))
    out = timeseries.sync_streams(rows.select("k", (F.col("t") + 0.25).alias("t")), {"a": [rows.where("v % 7 = 0")], "b": [rows.where("v % 10000 = 5")]}, "k", "t", "v", span=1000.0)
    near = lambda x, step, of: min(max(of, (int((x - of) // step) + d) * step + of) for d in (0, 1))
    for r in out.where("int(t) % 7919 = 0").collect():
        want = [min((c for c in (near(r.t, s, o), near(r.t, s, o) + s) if c < n), key=lambda c: abs(c - r.t)) for s, o in ((7, 0), (10000, 5))]
        assert [r.a, r.b] == want
