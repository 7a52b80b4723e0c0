"""Table functions: generators over the rows of a partitioned table, and over a value of each row.

    register(spark)
    SELECT * FROM sessions(TABLE(events) PARTITION BY user_id ORDER BY ts, gap => 3600D)
    SELECT doc_id, run.* FROM documents, LATERAL word_windows(text, 50, 25) AS run

`sessions` fits its result to the table that it is given: the partition's key keeps its name and kind. In DataFrames use
session_rows() and window_rows().
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult


class Sessions:
    """Runs of rows of a key, in the order of time, that are at most `gap` apart: key, session, first, last, n.

    eval() is given the rows of one partition after another, and terminate() ends each. The table's columns are the key and then the
    time, a number; rows without a time are left out. State is a few numbers, however long a partition is.
    """

    @staticmethod
    def analyze(table: AnalyzeArgument, gap: AnalyzeArgument) -> AnalyzeResult:
        if not table.isTable or len(table.dataType.fields) != 2:
            raise ValueError("sessions() takes a table of a key and a time")
        key, time = table.dataType.fields
        if time.dataType not in (DoubleType(), LongType(), IntegerType()):
            raise ValueError("the time must be a number")
        if gap.value is None or gap.value < 0:
            raise ValueError("the gap must be a number of 0 at least")
        schema = StructType().add(key.name, key.dataType).add("session", IntegerType()).add("first", time.dataType).add("last", time.dataType).add("n", LongType())
        return AnalyzeResult(schema)

    def __init__(self) -> None:
        self.key, self.number, self.first, self.last, self.n = None, 0, None, None, 0

    def eval(self, row: Row, gap: float) -> Iterator[tuple]:
        key, time = row
        if time is None:
            return
        if self.n and time - self.last > gap:
            yield self.key, self.number, self.first, self.last, self.n
            self.number, self.n = self.number + 1, 0
        if not self.n:
            self.first = time
        self.key, self.last, self.n = key, time, self.n + 1

    def terminate(self) -> Iterator[tuple]:
        if self.n:
            yield self.key, self.number, self.first, self.last, self.n


class WordWindows:
    """Windows of `size` words of a text, one every `step` words, the last one as long as it gets: place, n, words.

    Words are what spaces and the characters from tab to carriage return separate. A null text has no windows, and neither has one without words.
    """

    @staticmethod
    def analyze(text: AnalyzeArgument, size: AnalyzeArgument, step: AnalyzeArgument) -> AnalyzeResult:
        if text.dataType != StringType():
            raise ValueError("word_windows() takes a text")
        if not size.value or not step.value or size.value < 1 or step.value < 1:
            raise ValueError("size and step must be 1 at least")
        return AnalyzeResult(StructType().add("place", IntegerType()).add("n", IntegerType()).add("words", StringType()))

    def eval(self, text: str | None, size: int, step: int) -> Iterator[tuple]:
        words = re.findall(r"[^ \t-\r]+", text or "")
        for at in range(0, len(words), step):
            part = words[at : at + size]
            yield at, len(part), " ".join(part)
            if at + size >= len(words):
                return


def register(spark: SparkSession) -> None:
    """Make the functions known to SQL. Their code travels with them."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.udtf.register("sessions", F.udtf(Sessions))
    spark.udtf.register("word_windows", F.udtf(WordWindows))


def session_rows(rows: DataFrame, key: str, time: str, gap: float) -> DataFrame:
    """Sessions of each key; null keys are one key."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    table = rows.select(key, time).asTable().partitionBy(key).orderBy(time)
    return F.udtf(Sessions)(table, F.lit(float(gap)))


def window_rows(rows: DataFrame, text: Column, size: int, step: int) -> DataFrame:
    """Rows with the windows of a text of theirs; rows without windows are left out."""
    register(rows.sparkSession)
    return rows.withColumn("_text", text).lateralJoin(F.udtf(WordWindows)(F.col("_text").outer(), F.lit(size), F.lit(step))).drop("_text")
