"""Written intermediate tables in the folder that all executors share.

Stages hand their rows on as Parquet in spark.checkpoint.dir, so a lost executor costs only the tasks that ran on
it, and no stage recomputes another. Where a local session names no folder (tests), one is made for it.
"""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = _own.setdefault(context.applicationId, "") or tempfile.mkdtemp(prefix="millrace-")
        _own[context.applicationId] = base
    return base.rstrip("/")


class Scratch:
    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.n = 0

    def save(self, df: DataFrame) -> DataFrame:
        """Write df and read it back; shuffle files of the finished job may then go."""
        self.n += 1
        path = f"{self.path}/{self.n}"
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        back._scratch_path = path
        del df
        release(self.spark)
        return back

    def drop(self, df: DataFrame) -> None:
        """Delete a table that no later stage reads."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(df._scratch_path)
        path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner find the shuffles that nothing refers to any more."""
    gc.collect()
    spark._jvm.System.gc()
