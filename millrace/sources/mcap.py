"""Recordings of timed messages by topic in MCAP files, as a Spark source.

A file ends with an index of its chunks: their times, their channels, and where each channel's messages are in them. A read of some
topics or of a range of times therefore opens only the chunks that have some, and of these only the messages that are wanted.

    register(spark)
    spark.read.format("mcap").load(path).where("topic = '/joint_states'")
    write_recordings(rows, path)         # file, topic, log_time, data
"""

from __future__ import annotations

import struct
import sys
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

from millrace.sources import splits, store

# Fixed values of the format: the first and last bytes, and the numbers of its records.
MAGIC = b"\x89MCAP0\r\n"
HEADER, FOOTER, SCHEMA, CHANNEL, MESSAGE, CHUNK, MESSAGE_INDEX, CHUNK_INDEX = range(1, 9)
STATISTICS, DATA_END = 11, 15

COLUMNS = "file string, topic string, schema string, encoding string, sequence long, log_time long, publish_time long, data binary"
ARROW = pa.schema([("file", pa.string()), ("topic", pa.string()), ("schema", pa.string()), ("encoding", pa.string()), ("sequence", pa.int64()), ("log_time", pa.int64()), ("publish_time", pa.int64()), ("data", pa.binary())])
FOREVER = 1 << 63


def text(data: bytes, at: int) -> tuple[str, int]:
    (n,) = struct.unpack_from("<I", data, at)
    return data[at + 4 : at + 4 + n].decode(), at + 4 + n


def records(data: bytes) -> Iterator[tuple[int, int, int]]:
    """(kind, start, end) of the contents of the records in data."""
    at = 0
    while at + 9 <= len(data):
        kind, n = struct.unpack_from("<BQ", data, at)
        if at + 9 + n > len(data):
            return  # the file was cut off here
        yield kind, at + 9, at + 9 + n
        at += 9 + n


@dataclass
class Chunk:
    start: int
    size: int
    first: int
    last: int
    indexes: dict[int, int]  # where each channel's messages are listed


@dataclass
class Recording:
    """An MCAP file of `size` bytes. read: the bytes of a range."""

    read: Callable[[int, int], bytes]
    size: int
    schemas: dict[int, str] = field(default_factory=dict)
    channels: dict[int, tuple[str, str, int]] = field(default_factory=dict)  # topic, encoding, schema
    chunks: list[Chunk] | None = None  # None: the file has no index
    opened: int = 0  # chunks that were read

    def __post_init__(self) -> None:
        if self.size < len(MAGIC) or self.read(0, len(MAGIC)) != MAGIC:
            raise ValueError("not an MCAP file")
        tail = self.read(max(0, self.size - 37), self.size)
        if len(tail) < 37 or tail[-8:] != MAGIC or tail[0] != FOOTER:
            return
        start = struct.unpack_from("<Q", tail, 9)[0]
        if not start:
            return
        summary, found, chunks = self.read(start, self.size - 37), False, []
        for kind, a, b in records(summary):
            self.learn(kind, summary[a:b])
            if kind == CHUNK_INDEX:
                first, last, at, size, n = struct.unpack_from("<QQQQI", summary, a)
                pairs = [struct.unpack_from("<HQ", summary, a + 36 + i) for i in range(0, n, 10)]
                chunks.append(Chunk(at, size, first, last, dict(pairs)))
            found = found or kind in (CHUNK_INDEX, STATISTICS)
        if found and (chunks or not self.has_messages(summary)):
            self.chunks = chunks

    def has_messages(self, summary: bytes) -> bool:
        """Whether statistics count messages; those of a file without chunks are found by reading it through."""
        return any(kind == STATISTICS and struct.unpack_from("<Q", summary, a)[0] for kind, a, _ in records(summary))

    def learn(self, kind: int, body: bytes) -> None:
        if kind == SCHEMA:
            self.schemas[struct.unpack_from("<H", body)[0]] = text(body, 2)[0]
        elif kind == CHANNEL:
            number, schema = struct.unpack_from("<HH", body)
            topic, at = text(body, 4)
            self.channels[number] = (topic, text(body, at)[0], schema)

    def inner(self, body: bytes) -> bytes:
        """The records of a chunk."""
        size, crc = struct.unpack_from("<QI", body, 16)
        how, at = text(body, 28)
        (n,) = struct.unpack_from("<Q", body, at)
        data = body[at + 8 : at + 8 + n]
        if how == "zstd":
            data = zstandard.ZstdDecompressor().decompress(data, max_output_size=size)
        elif how == "lz4":
            data = pa.Codec("lz4").decompress(data, size).to_pybytes() if size else b""
        elif how:
            raise ValueError(f"no decompression {how!r}")
        if crc and zlib.crc32(data) != crc:
            raise ValueError("a chunk's checksum is wrong")
        self.opened += 1
        return data

    def row(self, body: bytes) -> tuple:
        number, sequence, logged, published = struct.unpack_from("<HIQQ", body)
        topic, encoding, schema = self.channels[number]
        return topic, self.schemas.get(schema), encoding, sequence, logged, published, body[22:]

    def scan(self, data: bytes, wanted: Callable[[str, int], bool]) -> Iterator[tuple]:
        for kind, a, b in records(data):
            if kind == MESSAGE:
                number, _, logged = struct.unpack_from("<HIQ", data, a)
                if wanted(self.channels[number][0], logged):
                    yield self.row(data[a:b])
            elif kind == CHUNK:
                yield from self.scan(self.inner(data[a:b]), wanted)
            else:
                self.learn(kind, data[a:b])

    def messages(self, topics: set[str] | None = None, low: int = 0, high: int = FOREVER, start: int = 0, end: int | None = None) -> Iterator[tuple]:
        """(topic, schema, encoding, sequence, log time, publish time, data) of messages of some topics, logged from low to high.

        Of a file with an index those in chunks that start at bytes `start` to `end`; one without is read through by whoever has its start.
        """
        wanted = lambda topic, logged: (topics is None or topic in topics) and low <= logged <= high
        if self.chunks is None:
            if start == 0:
                yield from self.scan(self.read(len(MAGIC), self.size), wanted)
            return
        for c in sorted(self.chunks, key=lambda c: c.start):
            if not start <= c.start < (self.size if end is None else end) or c.last < low or c.first > high:
                continue
            listed = c.indexes and all(k in self.channels for k in c.indexes)
            own = {k: at for k, at in c.indexes.items() if topics is None or self.channels[k][0] in topics} if listed else {}
            if listed and not own:
                continue
            data = self.inner(self.read(c.start + 9, c.start + c.size))
            if not listed or len(own) == len(c.indexes):
                yield from self.scan(data, wanted)
                continue
            places = []
            for at in own.values():
                (n,) = struct.unpack("<Q", self.read(at + 1, at + 9))
                body = self.read(at + 9, at + 9 + n)
                places += [x[1] for x in struct.iter_unpack("<QQ", body[6 : 6 + struct.unpack_from("<I", body, 2)[0]])]
            for at in sorted(places):
                (n,) = struct.unpack_from("<Q", data, at + 1)
                yield from (r for r in (self.row(data[at + 9 : at + 9 + n]),) if wanted(r[0], r[4]))


class Reader(DataSourceReader):
    def __init__(self, options):
        self.root, self.split = options["path"], int(options.get("split_bytes", 64 << 20))
        self.topics: set[str] | None = None
        self.low, self.high = 0, FOREVER

    def pushFilters(self, filters: list[Filter]):
        """Topics are left to the reader; times only tell it which chunks to skip."""
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("topic",):
                found = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.topics = found if self.topics is None else self.topics & found
                continue
            if getattr(f, "attribute", None) == ("log_time",):
                if isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                    self.low = max(self.low, f.value)
                if isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
                    self.high = min(self.high, f.value)
            yield f

    def partitions(self):
        return splits.split_files(self.root, ".mcap", self.split)

    def read(self, split):
        with split.open() as file:

            def of(start: int, end: int) -> bytes:
                file.seek(start)
                return file.read(end - start)

            held, size = [], 0
            for m in Recording(of, split.size).messages(self.topics, self.low, self.high, split.start, split.end):
                held.append((split.path, *m))
                size += len(m[-1])
                if len(held) == 4096 or size > 4 << 20:
                    yield batch(held)
                    held, size = [], 0
            if held:
                yield batch(held)


def batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), ARROW, strict=True)], schema=ARROW)


class RecordingWriter:
    """Writes one file: put() messages, then close()."""

    def __init__(self, write: Callable[[bytes], object], chunk_bytes: int = 1 << 20):
        self.write, self.chunk_bytes, self.at = write, chunk_bytes, 0
        self.channels: dict[tuple[str, str, str], int] = {}
        self.schemas: dict[str, int] = {}
        self.defined: list[bytes] = []
        self.chunks: list[bytes] = []
        self.messages, self.span = 0, [FOREVER, 0]
        self.out(MAGIC)
        self.out(self.record(HEADER, self.text("") + self.text("millrace")))
        self.fresh()

    @staticmethod
    def text(x: str) -> bytes:
        return struct.pack("<I", len(x.encode())) + x.encode()

    @staticmethod
    def record(kind: int, body: bytes) -> bytes:
        return struct.pack("<BQ", kind, len(body)) + body

    def out(self, data: bytes) -> None:
        self.write(data)
        self.at += len(data)

    def fresh(self) -> None:
        self.buffer, self.index, self.first, self.last = bytearray(), {}, FOREVER, 0

    def put(self, topic: str, data: bytes, log_time: int, publish_time: int | None = None, sequence: int = 0, schema: str = "", encoding: str = "json") -> None:
        key = (topic, schema, encoding)
        if key not in self.channels:
            if schema and schema not in self.schemas:
                self.schemas[schema] = len(self.schemas) + 1
                self.define(self.record(SCHEMA, struct.pack("<H", self.schemas[schema]) + self.text(schema) + self.text("") + struct.pack("<I", 0)))
            self.channels[key] = len(self.channels) + 1
            self.define(self.record(CHANNEL, struct.pack("<HH", self.channels[key], self.schemas.get(schema, 0)) + self.text(topic) + self.text(encoding) + struct.pack("<I", 0)))
        number = self.channels[key]
        self.index.setdefault(number, []).append((log_time, len(self.buffer)))
        self.buffer += self.record(MESSAGE, struct.pack("<HIQQ", number, sequence, log_time, log_time if publish_time is None else publish_time) + data)
        self.first, self.last, self.messages = min(self.first, log_time), max(self.last, log_time), self.messages + 1
        if len(self.buffer) >= self.chunk_bytes:
            self.flush()

    def define(self, record: bytes) -> None:
        self.buffer += record
        self.defined.append(record)

    def flush(self) -> None:
        if not self.index:
            return
        packed = zstandard.ZstdCompressor(level=1).compress(bytes(self.buffer))
        body = struct.pack("<QQQI", self.first, self.last, len(self.buffer), zlib.crc32(self.buffer)) + self.text("zstd") + struct.pack("<Q", len(packed)) + packed
        start, chunk = self.at, self.record(CHUNK, body)
        self.out(chunk)
        offsets, index_start = b"", self.at
        for number, places in sorted(self.index.items()):
            offsets += struct.pack("<HQ", number, self.at)
            self.out(self.record(MESSAGE_INDEX, struct.pack("<HI", number, 16 * len(places)) + b"".join(struct.pack("<QQ", *p) for p in places)))
        sizes = self.text("zstd") + struct.pack("<QQ", len(packed), len(self.buffer))
        self.chunks.append(self.record(CHUNK_INDEX, struct.pack("<QQQQI", self.first, self.last, start, len(chunk), len(offsets)) + offsets + struct.pack("<Q", self.at - index_start) + sizes))
        self.span = [min(self.span[0], self.first), max(self.span[1], self.last)]
        self.fresh()

    def close(self) -> None:
        self.flush()
        self.out(self.record(DATA_END, struct.pack("<I", 0)))
        start = self.at
        counts = struct.pack("<QHIIIIQQI", self.messages, len(self.schemas), len(self.channels), 0, 0, len(self.chunks), self.span[0] if self.messages else 0, self.span[1], 0)
        self.out(b"".join(self.defined) + self.record(STATISTICS, counts) + b"".join(self.chunks))
        self.out(self.record(FOOTER, struct.pack("<QQI", start, 0, 0)) + MAGIC)


class Writer(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.output = splits.Output(options["path"], overwrite)
        self.chunk_bytes = int(options.get("chunk_bytes", 1 << 20))

    def write(self, iterator):
        files, name, file, out, done = [], None, None, None, set()

        def close() -> None:
            if out:
                out.close()
                file.close()

        for b in iterator:
            names = b.schema.names
            columns = [b.column(names.index(c)).to_pylist() if c in names else [None] * b.num_rows for c in ARROW.names]
            for f, topic, schema, encoding, sequence, logged, published, data in zip(*columns, strict=True):
                if f is None or topic is None or logged is None:
                    raise ValueError("a message needs file, topic and log_time")
                if f != name:
                    if f in done:
                        raise ValueError("a file's rows must be together; use write_recordings()")
                    close()
                    done.add(f)
                    name, (file, place) = f, self.output.create(f if f.endswith(".mcap") else f"{f}.mcap")
                    out = RecordingWriter(file.write, self.chunk_bytes)
                    files.append(place)
                out.put(topic, bytes(data or b""), logged, published, sequence or 0, schema or "", encoding or "json")
        close()
        return splits.Written(files)

    def commit(self, messages):
        self.output.commit(messages)

    def abort(self, messages):
        self.output.abort()


class McapSource(DataSource):
    """Options: path; split_bytes (of a task's range of a file); chunk_bytes (of a written chunk)."""

    @classmethod
    def name(cls):
        return "mcap"

    def schema(self):
        return COLUMNS

    def reader(self, schema: StructType):
        return Reader(self.options)

    def writer(self, schema: StructType, overwrite: bool):
        return Writer(self.options, overwrite)


def register(spark: SparkSession) -> None:
    splits.register(spark, McapSource, sys.modules[__name__], splits, store)


def write_recordings(rows: DataFrame, path: str, chunk_bytes: int = 1 << 20, overwrite: bool = False) -> None:
    """Write rows (file, topic, log_time in nanoseconds, data; schema, encoding, sequence and publish_time if there) as a file each.

    A file is one task's, in the order of log_time; rows without file, topic or log_time are an error.
    """
    register(rows.sparkSession)
    ordered = rows.repartition("file").sortWithinPartitions("file", "log_time", *[c for c in ("sequence", "topic") if c in rows.columns])
    ordered.write.format("mcap").option("chunk_bytes", chunk_bytes).mode("overwrite" if overwrite else "append").save(path)
