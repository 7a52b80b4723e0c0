"""State of a stream: windows, late rows, and a restart."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from millrace.functions.times import utc_micros
from millrace.streaming import state


def run(spark, path, rows):
    """Add rows, and let the stream take what is new from its checkpoint on."""
    at = lambda s: datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=s) if s is not None else None
    spark.createDataFrame([(at(s), k, x) for s, k, x in rows], "ts timestamp, kind string, x double").write.mode("append").parquet(f"{path}/in")
    stream = spark.readStream.schema("ts timestamp, kind string, x double").parquet(f"{path}/in")
    out = state.window_means(stream, "ts", "kind", "x", 60_000, "30 seconds")
    out.writeStream.outputMode("append").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start(f"{path}/out").awaitTermination()
    base = 1704067200
    return sorted((r.kind, r.start - base, r.n, r.mean) for r in spark.read.parquet(f"{path}/out").collect())


def test_windows_late_rows_and_restart(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    first = [(5, "a", 1.0), (10, "a", 3.0), (50, "b", 7.0), (70, "a", 5.0), (71, None, 2.0), (20, "a", nan), (21, "a", inf), (22, "a", None), (None, "a", 9.0)]
    assert run(spark, tmp_path, first) == []  # the watermark is 41 s
    second = [(40, "a", 50.0), (45, "a", 5.0), (95, "b", 1.0)]  # state of before the restart, one row that is late and one that is not
    assert run(spark, tmp_path, second) == [("a", 0, 3, 3.0), ("b", 0, 1, 7.0)]
    third = [(59, "a", 100.0), (119, "a", 7.0), (200, "c", 1.0)]  # the first is late, as its window is closed
    assert run(spark, tmp_path, third) == [("", 60, 1, 2.0), ("a", 0, 3, 3.0), ("a", 60, 2, 6.0), ("b", 0, 1, 7.0), ("b", 60, 1, 1.0)]


def test_times_without_a_zone(spark):
    t = datetime.datetime(1969, 12, 31, 23, 59, 58, 250_000)
    rows = spark.createDataFrame([(t,)], "t timestamp_ntz")
    assert rows.select(utc_micros(rows, "t")).first()[0] == -1_750_000
    with_zone = spark.sql("SELECT timestamp_micros(7) AS t")
    assert with_zone.select(utc_micros(with_zone, "t")).first()[0] == 7
    assert rows.where(F.lit(False)).select(utc_micros(rows, "t")).collect() == []
