"""What file formats read as Spark sources have in common: listing files, byte ranges of them, and committing written ones.

Folders are listed once, when a read is planned; files are opened in tasks, through pyarrow's file systems and with retries. A written
file has a name of its own until the job is committed, so a task that is run again, or lost, leaves nothing behind in the result.
"""

from __future__ import annotations

import io
import uuid
from dataclasses import dataclass
from types import ModuleType

from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, InputPartition, WriterCommitMessage

from millrace.sources import store

#: Name of the folder of files that are not committed yet.
PENDING = "_pending"


def register(spark: SparkSession, source: type[DataSource], *modules: ModuleType) -> None:
    """Make a source known to the session. Its code travels with it, so that no process needs to import this package."""
    for m in modules:
        cloudpickle.register_pickle_by_value(m)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(source)


def file_system(root: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URL, or of a local path, and the path in it."""
    return fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)


@dataclass
class Split(InputPartition):
    """Bytes `start` to `end` of a file; `root` is a URL of its file system."""

    root: str
    path: str
    start: int
    end: int
    size: int

    def open(self) -> io.BufferedReader:
        system, _ = file_system(self.root)
        return io.BufferedReader(store.RetryingStream(lambda: system.open_input_file(self.path)), 1 << 20)


def split_files(root: str, ending: str, most: int | None) -> list[Split]:
    """Every file below root, or root itself, whose name ends so; in ranges of `most` bytes, or whole."""
    system, path = file_system(root)
    info = system.get_file_info(path)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(f"there is no {root}")
    files = [info] if info.is_file else [f for f in system.get_file_info(fs.FileSelector(path, recursive=True)) if f.is_file and f.path.endswith(ending) and f"/{PENDING}/" not in f.path]
    out = []
    for f in sorted(files, key=lambda f: f.path):
        step = most or max(f.size, 1)
        out += [Split(root, f.path, a, min(a + step, f.size), f.size) for a in range(0, max(f.size, 1), step)]
    return out


@dataclass
class Written(WriterCommitMessage):
    """Files of a task: where they are, and where they go."""

    files: list[tuple[str, str]]


class Output:
    """Files of one job below root."""

    def __init__(self, root: str, overwrite: bool):
        self.root, self.overwrite, self.job = root, overwrite, uuid.uuid4().hex

    def create(self, name: str) -> tuple[fs.NativeFile, tuple[str, str]]:
        """A new file that is to be called so, and what to hand to commit()."""
        system, root = file_system(self.root)
        folder = f"{root}/{PENDING}/{self.job}"
        system.create_dir(folder, recursive=True)
        temporary = f"{folder}/{uuid.uuid4().hex}"
        return system.open_output_stream(temporary), (temporary, f"{root}/{name}")

    def commit(self, messages: list[Written | None]) -> None:
        system, root = file_system(self.root)
        files = [x for m in messages if m for x in m.files]
        targets = [to for _, to in files]
        if len(set(targets)) < len(targets):
            raise ValueError("two tasks wrote one file; deal rows out by file")
        if not self.overwrite and any(i.type != fs.FileType.NotFound for i in system.get_file_info(targets)):
            raise FileExistsError(f"{root} has some of these files")
        for at, to in files:
            system.create_dir(to.rsplit("/", 1)[0], recursive=True)
            system.move(at, to)
        self.abort()

    def abort(self) -> None:
        system, root = file_system(self.root)
        for folder in (f"{root}/{PENDING}/{self.job}",):
            if system.get_file_info(folder).type != fs.FileType.NotFound:
                system.delete_dir(folder)
