"""Writers of episodes, manifests and statistics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def dump(df: DataFrame, path: str, file_format: str | None = None, overwrite: bool = False, **options) -> None:
    """Write a path by its extension, or in the format named; an existing path fails unless overwrite is set."""
    kind = file_format or path.rstrip("/").rsplit(".", 1)[-1].lower()
    writer = df.write.format({"jsonl": "json", "txt": "text"}.get(kind, kind)).options(**options)
    if kind == "csv":
        writer = writer.option("header", True)
    writer.mode("overwrite" if overwrite else "errorifexists").save(path)


def write_episodes(steps: DataFrame, path: str, partition_by: tuple[str, ...] = ("split",), overwrite: bool = False) -> None:
    """Steps as Parquet in a folder per split, an episode's rows in order."""
    rows = steps.repartition(*partition_by, "episode_id").sortWithinPartitions("episode_id", "step_idx")
    rows.write.partitionBy(*partition_by).mode("overwrite" if overwrite else "errorifexists").parquet(path)


def with_relative_action(steps: DataFrame, action: str = "action") -> DataFrame:
    """Steps with relative_action: each action's difference to the next, the last step's as the one before, zeros in an episode of one."""
    w = Window.partitionBy("episode_id").orderBy("step_idx")
    minus = lambda a, b: F.zip_with(a, b, lambda x, y: x - y)
    ahead, back = minus(F.lead(action).over(w), F.col(action)), minus(F.col(action), F.lag(action).over(w))
    return steps.withColumn("relative_action", F.coalesce(ahead, back, F.transform(action, lambda x: x * 0)))


def write_rollouts(steps: DataFrame, attributes: DataFrame, path: str, overwrite: bool = False) -> None:
    """Rollouts as two tables: steps/ in folders by success, and episodes/ with a row of attributes per episode (success among them)."""
    rows = with_relative_action(steps).join(attributes.select("episode_id", "success"), "episode_id")
    write_episodes(rows, f"{path}/steps", ("success",), overwrite)
    attributes.write.mode("overwrite" if overwrite else "errorifexists").parquet(f"{path}/episodes")


def save_with_backup(df: DataFrame, path: str) -> None:
    """Replace a table; the one before stays as path.bak, and is there until the new one is whole."""
    jvm = df.sparkSession._jvm
    old, new, bak = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.new", f"{path}.bak"))
    store = old.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf())
    df.write.mode("overwrite").parquet(f"{path}.new")
    if store.exists(old):
        store.delete(bak, True)
        store.rename(old, bak)
    store.rename(new, old)


def load_or_compute(spark: SparkSession, path: str, compute: Callable[[], DataFrame]) -> DataFrame:
    """A table that is computed and written the first time."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        compute().write.mode("ignore").parquet(path)
        return spark.read.parquet(path)


def unfinished(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose output is not there yet."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def manifest(episodes: DataFrame, stem: str = "episode_") -> DataFrame:
    """source_episode, split, output_stem and num_steps of each episode."""
    name = F.concat(F.lit(stem), F.lpad(F.col("episode_id").cast("string"), 6, "0"))
    return episodes.select(F.col("episode_id").alias("source_episode"), "split", name.alias("output_stem"), "num_steps")
