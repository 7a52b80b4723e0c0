"""The episodic data model and its carrier in the driver tables.

An episode is an order, its steps are the order's lines. A step's action vector is (quantity, price, discount, tax), the last
of which stands for a gripper. Episodes are short, so windows over an episode are small.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

STEPS_SCHEMA = T.StructType(
    [
        T.StructField("episode_id", T.LongType(), False),
        T.StructField("step_idx", T.IntegerType(), False),
        T.StructField("action", T.ArrayType(T.DoubleType()), False),
    ]
)
EPISODES_SCHEMA = T.StructType(
    [
        T.StructField("episode_id", T.LongType(), False),
        T.StructField("command", T.StringType()),
        T.StructField("num_steps", T.IntegerType(), False),
        T.StructField("success", T.BooleanType(), False),
    ]
)

#: Order of an episode's steps: the line number, then every other column, as line numbers repeat.
STEP_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


def index_steps(rows: DataFrame, episode: str, order: list[str], name: str = "step_idx") -> DataFrame:
    """Number the rows of each episode from 0."""
    return rows.withColumn(name, (F.row_number().over(Window.partitionBy(episode).orderBy(*order)) - 1).cast("int"))


class Tables:
    """The tables of a folder, read when they are named."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")

    @cached_property
    def steps(self) -> DataFrame:
        """episode_id, step_idx, a0 to a3 and action."""
        rows = index_steps(self.lineitem, "l_orderkey", list(STEP_ORDER))
        cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
        names = [F.col(c).alias(f"a{i}") for i, c in enumerate(cols)]
        return rows.select(F.col("l_orderkey").alias("episode_id"), "step_idx", *names, F.array(*cols).alias("action"), "l_returnflag", "l_linestatus")

    @cached_property
    def episodes(self) -> DataFrame:
        """episode_id, command, success, num_steps; orders without lines are left out."""
        n = self.lineitem.groupBy(F.col("l_orderkey").alias("episode_id")).agg(F.count("*").cast("int").alias("num_steps"))
        o = self.orders.select(F.col("o_orderkey").alias("episode_id"), F.col("o_orderpriority").alias("command"), (F.col("o_orderstatus") == "F").alias("success"), "o_totalprice", "o_custkey")
        return o.join(n, "episode_id")


#: The same in SQL, for WITH.
STEPS_SQL = f"""steps AS (SELECT l_orderkey AS episode_id,
  CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(STEP_ORDER)}) - 1 AS INTEGER) AS step_idx,
  l_quantity AS a0, l_extendedprice AS a1, l_discount AS a2, l_tax AS a3, l_returnflag, l_linestatus FROM lineitem)"""
EPISODES_SQL = """episodes AS (SELECT o_orderkey AS episode_id, o_orderpriority AS command, o_orderstatus = 'F' AS success, o_totalprice, o_custkey, n AS num_steps
  FROM orders JOIN (SELECT l_orderkey, CAST(count(*) AS INTEGER) AS n FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey)"""
