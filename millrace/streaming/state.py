"""Statistics that a stream keeps by key, and hands out and forgets at the end of each window."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class WindowMeans(StatefulProcessor):
    """Count and mean of a key's values in each window of `width` ms; a timer at the window's end gives them out and drops them.

    Rows that are older than the watermark are late and left out, in open windows too, so no window is given out twice.
    """

    def __init__(self, width: int):
        self.width = width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getMapState("sums", StructType([StructField("end", LongType())]), StructType([StructField("n", LongType()), StructField("total", DoubleType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        closed = timerValues.getCurrentWatermarkInMs()
        for batch in rows:
            ends = (batch["ms"] // self.width + 1) * self.width
            for end, own in batch["x"].groupby(ends):
                end = int(end)
                if end <= closed:
                    continue
                n, total = self.sums.getValue((end,)) if self.sums.containsKey((end,)) else (0, 0.0)
                if not n:
                    self.handle.registerTimer(end)
                self.sums.updateValue((end,), (n + len(own), total + float(own.sum())))
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = expiredTimerInfo.getExpiryTimeInMs()
        if self.sums.containsKey((end,)):
            n, total = self.sums.getValue((end,))
            self.sums.removeKey((end,))
            yield pd.DataFrame({"kind": [key[0]], "start": [(end - self.width) // 1000], "n": [n], "mean": [total / n]})

    def close(self) -> None:
        return


def window_means(stream: DataFrame, ts: str, kind: str, value: str, width_ms: int, late: str) -> DataFrame:
    """kind, start (seconds since 1970), n and mean of each window, once the watermark (`late` behind the latest row) has passed its end.

    Null and infinite values and rows without a time are left out; null kinds are a kind of their own, called "". State is a row per
    kind and open window, kept in RocksDB and in the query's checkpoint.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    x = F.col(value).cast("double")
    rows = stream.where(F.col(ts).isNotNull() & x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.select(F.col(ts).cast("timestamp").alias("ts"), F.coalesce(F.col(kind).cast("string"), F.lit("")).alias("kind"), x.alias("x")).withWatermark("ts", late)
    rows = rows.withColumn("ms", F.floor(F.unix_micros("ts") / 1000).cast("long"))
    out = StructType([StructField("kind", StringType()), StructField("start", LongType()), StructField("n", LongType()), StructField("mean", DoubleType())])
    return rows.groupBy("kind").transformWithStateInPandas(WindowMeans(width_ms), out, "Append", "EventTime")
