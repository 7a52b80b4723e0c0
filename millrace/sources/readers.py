"""Readers of episode files, manifests, key indices and tar shards. No reader infers a schema."""

from __future__ import annotations

import gzip
import io
import json
import pickle
import tarfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from millrace.functions.text import repaired_json
from millrace.operators.chain import DATASETS, DECODERS, HANDLERS
from millrace.sources.store import open_url

EPISODES_JSONL = T.StructType().add("episode_index", "integer").add("length", "integer").add("tasks", T.ArrayType(T.StringType()))
TASKS_JSONL = T.StructType().add("task_index", "integer").add("task", "string")
TRAJECTORY = T.StructType().add("observation.state", T.ArrayType(T.FloatType())).add("action", T.ArrayType(T.FloatType())).add("timestamp", "double").add("episode_index", "integer")
MANIFEST = T.StructType().add("root", "string").add("data_list", T.ArrayType(T.StringType())).add("total_key_count", "long").add("chunk_size", "integer")
REVIEW = T.StructType().add("verdict", "string").add("trim_start", "double").add("trim_end", "double").add("notes", "string")
ANNOTATION_META = T.StructType().add("is_eval", "boolean").add("episode_id", "string").add("segment_id", "string")
FORMATS = {"csv": "csv", "json": "json", "jsonl": "json", "parquet": "parquet", "orc": "orc", "txt": "text", "gz": "text", "byte": "binaryFile", "bin": "binaryFile"}


def load(spark: SparkSession, path: str, schema: T.StructType | None = None, file_format: str | None = None, **options) -> DataFrame:
    """Read a path by its extension, or by the format named; registered handlers go first."""
    kind = file_format or path.rstrip("/").rsplit(".", 1)[-1].lower()
    if kind in HANDLERS:
        return HANDLERS[kind](spark, path, schema=schema, **options)
    if kind not in FORMATS:
        raise ValueError(f"no reader for {kind!r}")
    reader = spark.read.format(FORMATS[kind]).options(**options)
    if kind == "csv":
        reader = reader.option("header", True)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def find_files(spark: SparkSession, root: str, pattern: str, split: str | None = None) -> DataFrame:
    """path, length and modification time of the files below a folder; with a split, those that have it as a folder of their path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root).select("path", "length", "modificationTime")
    return files.where(F.array_contains(F.split("path", "/"), split)) if split else files


def episode_lengths(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EPISODES_JSONL).json(path)


def task_names(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TASKS_JSONL).json(path)


def trajectories(spark: SparkSession, path: str, episodes: list[int] | None = None) -> DataFrame:
    """Steps of trajectory files; the episode filter reaches the scan."""
    rows = spark.read.schema(TRAJECTORY).parquet(path)
    return rows.where(F.col("episode_index").isin(episodes)) if episodes else rows


def shard_list(spark: SparkSession, path: str) -> DataFrame:
    """A row per shard of the manifests at path: root without its bucket, shard, keys of the manifest, chunk size."""
    rows = spark.read.schema(MANIFEST).option("multiLine", True).json(path)
    root = F.regexp_replace("root", r"^[a-z0-9]+://[^/]+/", "")
    return rows.select(root.alias("root"), F.explode("data_list").alias("shard"), "total_key_count", "chunk_size")


def key_index(spark: SparkSession, path: str, column: str) -> DataFrame:
    """Sample keys, without extensions."""
    return spark.read.parquet(path).select(F.split(column, r"\.")[0].alias("key"))


def reviews(spark: SparkSession, path: str) -> DataFrame:
    """A row per episode of a review file, a JSON map from episode to verdict, trims and notes."""
    text = spark.read.text(path, wholetext=True)
    parsed = F.from_json("value", T.MapType(T.StringType(), REVIEW))
    return text.select(F.explode(parsed).alias("episode", "r")).select(F.col("episode").cast("int").alias("episode"), "r.*")


def annotations(spark: SparkSession, path: str, fields: T.StructType, is_eval: bool | None = None) -> DataFrame:
    """One annotation per JSON file; all of them, or those that are (not) for evaluation."""
    rows = spark.read.schema(T.StructType([*fields.fields, T.StructField("episode_metadata", ANNOTATION_META)])).option("multiLine", True).json(path).withColumn("file", F.input_file_name())
    return rows if is_eval is None else rows.where(F.col("episode_metadata.is_eval") == is_eval)


SHARD_ROWS = "shard string, data_key string, pos long, key string, suffix string, payload binary"


def _members(tar: tarfile.TarFile, name: str) -> Iterator[tuple]:
    folder, shard = ("/" + name).rsplit("/", 2)[-2:]
    i = 0
    for m in tar:
        if m.isfile():
            key, _, suffix = m.name.rsplit("/", 1)[-1].partition(".")
            yield shard, folder, i, key, suffix, tar.extractfile(m).read()
            i += 1


def tar_shards(spark: SparkSession, path: str, stream: bool = False, batch_bytes: int = 16 << 20) -> DataFrame:
    """Members of tar files: shard, data_key (the shard's folder), pos, key, suffix (after the first dot) and payload.

    A shard is read by one task, whatever store it is in, and handed on in batches of about batch_bytes. Spark reads the shards,
    each as one value of up to 2 GB; with `stream` it only lists them, and tasks open them by URL (see store.py) and read member by member.
    """
    names = ["shard", "data_key", "pos", "key", "suffix", "payload"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    def members(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for i in range(batch.num_rows):
                name = batch.column(0)[i].as_py()
                file = open_url(name) if stream else pa.BufferReader(batch.column(1)[i].as_buffer())
                rows, held = [], 0
                with tarfile.open(fileobj=file, mode="r|" if stream else "r") as tar:
                    for row in _members(tar, name):
                        rows.append(row)
                        held += len(row[-1])
                        if held >= batch_bytes:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tar").option("recursiveFileLookup", True).load(path)
    return files.select("path", *([] if stream else ["content"])).mapInArrow(members, SHARD_ROWS)


def captions(spark: SparkSession, root: str, kind: str = "auto", prompt: str | None = None) -> DataFrame:
    """(name, caption) of a folder of videos: JSON files in captions/ or text files in metas/; `auto` takes JSON where there is some.

    A JSON caption is that of the first model, of the prompt type asked for or else the first; braces may be missing. A caption that
    cannot be read is empty.
    """
    has = lambda part, ending: not find_or_none(spark, f"{root}/{part}", ending).isEmpty()
    if kind == "auto":
        kind = "json" if has("captions", "*.json") else "text" if has("metas", "*.txt") else ""
    if kind not in ("json", "text"):
        raise ValueError(f"no captions below {root}" if not kind else f"no caption format {kind!r}")
    folder, ending = ("captions", "*.json") if kind == "json" else ("metas", "*.txt")
    rows = spark.read.option("pathGlobFilter", ending).text(f"{root}/{folder}", wholetext=True)
    name = F.regexp_extract(F.input_file_name(), r"([^/]+)\.[a-z]+$", 1)
    if kind == "text":
        return rows.select(name.alias("name"), F.trim(F.regexp_replace("value", r"^\s+|\s+$", "")).alias("caption"))
    models = F.from_json(repaired_json(F.col("value")), T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType())))
    prompts = F.get(F.map_values(models), F.lit(0))
    asked = F.element_at(prompts, F.lit(prompt)) if prompt else F.lit(None).cast("string")
    return rows.select(name.alias("name"), F.coalesce(asked, F.get(F.map_values(prompts), F.lit(0)), F.lit("")).alias("caption"))


def find_or_none(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """find_files(), without rows where the folder is not there."""
    try:
        return find_files(spark, root, pattern)
    except AnalysisException:
        return spark.createDataFrame([], "path string, length long, modificationTime timestamp")


def items(spark: SparkSession, path: str, start: int, end: int) -> DataFrame:
    """(item, content) of the files of a folder that are numbered from start to below end; only those are opened, by tasks."""
    found = spark.read.format("binaryFile").load(path).select("path")  # lists the folder, and reads nothing
    number = F.expr("try_cast(regexp_extract(path, '([0-9]+)[.][A-Za-z0-9]+$', 1) AS int)").alias("item")

    def contents(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for name, item in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with open_url(name) as file:
                    yield pa.RecordBatch.from_arrays([pa.array([item], pa.int32()), pa.array([file.read()], pa.binary())], names=["item", "content"])

    return found.select("path", number).where(F.col("item").between(start, end - 1)).mapInArrow(contents, "item int, content binary")


class _Plain(pickle.Unpickler):
    """Numbers, strings, bytes and containers of them; any other class is refused, as loading it could run code."""

    def find_class(self, module: str, name: str):
        raise pickle.UnpicklingError(f"{module}.{name} is not plain data")


@DECODERS.register("json")
def decode_json(data: bytes) -> object:
    return json.loads(data)


@DECODERS.register("pickle")
def decode_pickle(data: bytes) -> object:
    return _Plain(io.BytesIO(data)).load()


@DECODERS.register("npy")
def decode_npy(data: bytes) -> np.ndarray:
    return np.load(io.BytesIO(data), allow_pickle=False)


@DECODERS.register("npz")
def decode_npz(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data), allow_pickle=False) as arrays:
        return dict(arrays)


@DECODERS.register("gz")
def decode_gz(data: bytes) -> bytes:
    return gzip.decompress(data)


def numbers(column: Column, decoder: str) -> Column:
    """Binary values as arrays of doubles, by a decoder's name; what it cannot read is null."""
    decode = DECODERS.find(decoder)

    @F.pandas_udf("array<double>")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(data: bytes | None) -> list[float] | None:
            try:
                return None if data is None else np.asarray(decode(data), float).ravel().tolist()
            except (ValueError, TypeError, EOFError, pickle.UnpicklingError):
                return None

        for s in batches:
            yield s.map(one, na_action="ignore")

    return udf(column)


def sniff_format(columns: list[str]) -> str:
    """How an episode table holds its images: jpeg, raw, video or none."""
    if any(c.endswith("_jpeg") for c in columns):
        return "jpeg"
    if any(c.startswith("video_paths") for c in columns):
        return "video"
    return "raw" if any("images" in c or c.endswith("_rgb") for c in columns) else "none"


def dataset(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A registered dataset by its name."""
    return DATASETS.find(name)(spark, path)
