"""Table functions in SQL and in DataFrames."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import table_functions


def sessions(rows, gap):
    out = []
    for key in {k for k, _ in rows}:
        times, number = sorted(t for k, t in rows if k == key and t is not None), 0
        for i, t in enumerate(times):
            if i and t - times[i - 1] <= gap:
                out[-1][3:] = [t, out[-1][4] + 1]
            else:
                out.append([key, number, t, t, 1])
                number += 1
    return sorted(map(tuple, out), key=str)


def test_sessions(spark):
    """Keys with one row and with many, a null key, null times, ties."""
    rng = random.Random(6)
    rows = [(rng.choice(["a", "b", "c", None]), rng.choice([None, float(rng.randint(0, 400))])) for _ in range(300)] + [("d", None), ("e", 5.0)]
    df = spark.createDataFrame(rows, "who string, at double").repartition(3)
    want = sessions(rows, 4)
    out = table_functions.session_rows(df, "who", "at", 4)
    assert out.columns == ["who", "session", "first", "last", "n"] and sorted(map(tuple, out.collect()), key=str) == want
    table_functions.register(spark)
    df.createOrReplaceTempView("visits")
    assert sorted(map(tuple, spark.sql("SELECT * FROM sessions(TABLE(visits) PARTITION BY who ORDER BY at, gap => 4D)").collect()), key=str) == want
    ids = df.where("who is not null").select(F.length("who").alias("id"), F.col("at").cast("int").alias("at"))
    assert dict(table_functions.session_rows(ids, "id", "at", 4).dtypes) == {"id": "int", "session": "int", "first": "int", "last": "int", "n": "bigint"}
    assert table_functions.session_rows(df.limit(0), "who", "at", 4).collect() == []
    with pytest.raises(Exception, match="gap must be"):
        table_functions.session_rows(df, "who", "at", -1)
    with pytest.raises(Exception, match="time must be"):
        table_functions.session_rows(df.select("at", "who"), "at", "who", 1)


def test_word_windows(spark):
    df = spark.createDataFrame([(1, "a b\tc d e", "x"), (2, None, "x"), (3, " \n", "x"), (4, "one", "x")], "i int, t string, place string").drop("place")
    out = [(r.i, r.place, r.n, r.words) for r in table_functions.window_rows(df, F.col("t"), 3, 2).collect()]
    assert sorted(out) == [(1, 0, 3, "a b c"), (1, 2, 3, "c d e"), (4, 0, 1, "one")]
    df.createOrReplaceTempView("texts")
    assert sorted(map(tuple, spark.sql("SELECT i, w.* FROM texts, LATERAL word_windows(t, 3, 2) AS w").collect())) == sorted(out)
    with pytest.raises(Exception, match="1 at least"):
        spark.sql("SELECT * FROM texts, LATERAL word_windows(t, 0, 2) AS w").collect()
