"""A folder that all executors share, for files that one part of a job writes and another reads."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_own: dict[str, str] = {}


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own below spark.checkpoint.dir, or, in a local session that names none, below a temporary folder."""
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = _own.get(context.applicationId) or _own.setdefault(context.applicationId, tempfile.mkdtemp(prefix="millrace-"))
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
