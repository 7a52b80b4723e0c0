"""Members of tar shards as a Spark source, which skips what a filter does not want.

    register(spark)
    spark.read.format("tar_shards").load(path).where("suffix = 'json'")

Only the headers of other members are read: a seek passes over their content. With the option `payload` set to false no
content is read at all, and payload is null.
"""

from __future__ import annotations

import io
import sys
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In
from pyspark.sql.types import StructType

from millrace.sources import splits, store

COLUMNS = "shard string, data_key string, pos long, key string, suffix string, size long, payload binary"
ARROW = pa.schema([("shard", pa.string()), ("data_key", pa.string()), ("pos", pa.int64()), ("key", pa.string()), ("suffix", pa.string()), ("size", pa.int64()), ("payload", pa.binary())])
#: Filters on these equal what a member's name says.
NAMED = ("shard", "data_key", "key", "suffix")


def members(file, path: str, wanted: dict[str, set], content: bool) -> Iterator[tuple]:
    """Rows of the regular members of a seekable tar file, numbered from 0, whose names have one of the wanted values of each column."""
    folder, shard = ("/" + path).rsplit("/", 2)[-2:]
    named = {"shard": shard, "data_key": folder}
    if any(named[c] not in values for c, values in wanted.items() if c in named):
        return
    pos = 0
    with tarfile.open(fileobj=file, mode="r:") as tar:
        for m in tar:
            if not m.isfile():
                continue
            key, _, suffix = m.name.rsplit("/", 1)[-1].partition(".")
            if all(x in wanted[c] for c, x in (("key", key), ("suffix", suffix)) if c in wanted):
                yield shard, folder, pos, key, suffix, m.size, tar.extractfile(m).read() if content else None
            pos += 1
            tar.members = []  # tarfile keeps what it has seen


class Reader(DataSourceReader):
    def __init__(self, options):
        self.root, self.content = options["path"], str(options.get("payload", "true")).lower() != "false"
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 and f.attribute[0] in NAMED:
                found = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[f.attribute[0]] = self.wanted.get(f.attribute[0], found) & found
            else:
                yield f

    def partitions(self):
        """A task per shard; shards that a filter leaves out have none."""
        found = splits.split_files(self.root, ".tar", None)
        names = [("/" + s.path).rsplit("/", 2)[-2:] for s in found]
        keep = [s for s, (folder, shard) in zip(found, names, strict=True) if shard in self.wanted.get("shard", {shard}) and folder in self.wanted.get("data_key", {folder})]
        return keep or [splits.Split(self.root, "", 0, 0, 0)]

    def read(self, split):
        if not split.path:
            return
        with split.open() as file:
            held, size = [], 0
            for m in members(file, split.path, self.wanted, self.content):
                held.append(m)
                size += len(m[-1] or b"")
                if len(held) == 4096 or size > 16 << 20:
                    yield batch(held)
                    held, size = [], 0
            if held:
                yield batch(held)


def batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), ARROW, strict=True)], schema=ARROW)


class Writer(DataSourceArrowWriter):
    """A tar file for each shard, its members in the order of the rows."""

    def __init__(self, options, overwrite: bool):
        self.output = splits.Output(options["path"], overwrite)

    def write(self, iterator):
        files, name, file, tar, done = [], None, None, None, set()

        def close() -> None:
            if tar:
                tar.close()
                file.close()

        for b in iterator:
            columns = [b.column(b.schema.names.index(c)).to_pylist() for c in ("shard", "key", "suffix", "payload")]
            for shard, key, suffix, payload in zip(*columns, strict=True):
                if shard is None or key is None:
                    raise ValueError("a member needs shard and key")
                if shard != name:
                    if shard in done:
                        raise ValueError("a shard's rows must be together; use write_shards()")
                    close()
                    done.add(shard)
                    name, (file, place) = shard, self.output.create(f"{shard}.tar")
                    tar = tarfile.open(fileobj=file, mode="w|")
                    files.append(place)
                member = tarfile.TarInfo(f"{key}.{suffix}" if suffix else key)
                member.size = len(payload or b"")
                tar.addfile(member, io.BytesIO(payload or b""))
                tar.members = []
        close()
        return splits.Written(files)

    def commit(self, messages):
        self.output.commit(messages)

    def abort(self, messages):
        self.output.abort()


class TarSource(DataSource):
    """Options: path (of a shard or a folder, as a URL or a local path); payload."""

    @classmethod
    def name(cls):
        return "tar_shards"

    def schema(self):
        return COLUMNS

    def reader(self, schema: StructType):
        return Reader(self.options)

    def writer(self, schema: StructType, overwrite: bool):
        return Writer(self.options, overwrite)


def register(spark: SparkSession) -> None:
    splits.register(spark, TarSource, sys.modules[__name__], splits, store)


def write_shards(rows: DataFrame, path: str, overwrite: bool = False) -> None:
    """Write rows (shard, key, suffix, payload) as a tar file for each shard, its members by key and suffix.

    A shard is one task's; a null payload is an empty member, a null suffix none; rows without shard or key are an error.
    """
    register(rows.sparkSession)
    ordered = rows.select("shard", "key", "suffix", "payload").repartition("shard").sortWithinPartitions("shard", "key", "suffix")
    ordered.write.format("tar_shards").mode("overwrite" if overwrite else "append").save(path)
