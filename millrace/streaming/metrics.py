"""Running metrics as a stream. This goes beyond what a batch run needs: late rows are dropped after the watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling_rollup(stream: DataFrame, ts: str, value: str, by: list[str], width: str, late: str) -> DataFrame:
    """Count, mean, least and greatest of the finite values of each window and group."""
    ok = ~F.isnan(value) & (F.abs(value) < float("inf"))
    rows = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    x = F.when(ok, F.col(value))
    out = rows.groupBy(F.window(ts, width), *by).agg(F.count(x).alias("n"), F.coalesce(F.avg(x), F.lit(0.0)).alias("mean"), F.min(x).alias("min"), F.max(x).alias("max"))
    return out.select(F.col("window.start").alias("start"), *by, "n", "mean", "min", "max")


def every_n(rows: DataFrame, iteration: str, step: int, n: int, at_start: bool = False) -> DataFrame:
    """Rows of the iterations at which a callback of every n steps runs."""
    due = F.pmod(F.floor(F.col(iteration) / step), F.lit(n)) == 0
    return rows.where(due | (F.col(iteration) == 1) if at_start else due)
