"""Episodes in HDF5 files: a reader of the arrays that recordings are made of, a writer, and both as a Spark source.

What is read: superblocks 0 and 1, groups by symbol tables, arrays of integers, floats, booleans and fixed strings that lie in one piece, in
the header or in chunks (deflate, shuffle, checksum), and attributes of those kinds or of strings. A range of an array's first
axis is read by itself: of an array in one piece its bytes, of one in chunks the chunks that it meets.

    register(spark)
    spark.read.format("hdf5").load(path)                                            # a row per array: group, shape, kind, attributes
    spark.read.format("hdf5").option("datasets", "actions,qpos=obs/qpos").load(path)   # a row per step of every group that has them
    write_episodes(rows, path)                                                      # file, group, step and arrays
"""

from __future__ import annotations

import json
import math
import re
import struct
import sys
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

from millrace.sources import splits, store

# Fixed values of the format: signatures, message numbers and filter numbers.
SIGNATURE, NOWHERE = b"\x89HDF\r\n\x1a\n", 0xFFFFFFFFFFFFFFFF
DATASPACE, DATATYPE, LAYOUT, FILTERS, ATTRIBUTE, CONTINUATION, SYMBOLS = 1, 3, 8, 11, 12, 16, 17
DEFLATE, SHUFFLE, FLETCHER = 1, 2, 3


@dataclass
class Array:
    """An array of a file, and the attributes of its header."""

    path: str
    shape: tuple[int, ...]
    kind: np.dtype
    layout: tuple
    filters: list[tuple[int, list[int]]]
    attributes: dict = field(default_factory=dict)


def padded(n: int) -> int:
    return -(-n // 8) * 8


class File:
    """An HDF5 file of `size` bytes. read: the bytes of a range."""

    def __init__(self, read: Callable[[int, int], bytes], size: int):
        self.read_range, self.size = read, size
        head = read(0, 128)
        if head[:8] != SIGNATURE:
            raise ValueError("not an HDF5 file")
        if head[8] > 1 or head[13:15] != b"\x08\x08":
            raise ValueError(f"a superblock of version {head[8]} is not supported")
        at = 24 + 4 * head[8]  # version 1 has one more size
        self.base = struct.unpack_from("<Q", head, at)[0]
        self.root = struct.unpack_from("<Q", head, at + 40)[0]

    def bytes(self, at: int, n: int) -> bytes:
        data = self.read_range(self.base + at, self.base + at + n)
        if len(data) < n:
            raise ValueError("the file is cut off")
        return data

    def messages(self, at: int) -> list[tuple[int, bytes]]:
        """(number, content) of the messages of an object's header."""
        version, _, _, _, size = struct.unpack("<BBHII", self.bytes(at, 12))
        if version != 1:
            raise ValueError("object headers of version 1 only")
        blocks, out = [(at + 16, size)], []
        while blocks:
            start, n = blocks.pop(0)
            data, p = self.bytes(start, n), 0
            while p + 8 <= n:
                number, length = struct.unpack_from("<HH", data, p)
                body = data[p + 8 : p + 8 + length]
                if number == CONTINUATION:
                    blocks.append(struct.unpack_from("<QQ", body))
                out.append((number, body))
                p += 8 + length
        return out

    def members(self, tree: int, heap: int) -> Iterator[tuple[str, int]]:
        """(name, header) of a group's members, in the order of names."""
        size, _, names_at = struct.unpack_from("<QQQ", self.bytes(heap, 32), 8)
        names = self.bytes(names_at, size)
        for node in self.leaves(tree, 8):
            count = struct.unpack_from("<H", self.bytes(node, 8), 6)[0]
            data = self.bytes(node + 8, 40 * count)
            for i in range(count):
                name, header = struct.unpack_from("<QQ", data, 40 * i)
                yield names[name : names.index(b"\0", name)].decode(), header

    def leaves(self, tree: int, key: int) -> Iterator[int]:
        """What the lowest nodes of a tree lead to."""
        for level, _, child in self.entries(tree, key):
            if level:
                yield from self.leaves(child, key)
            else:
                yield child

    def entries(self, tree: int, key: int) -> Iterator[tuple[int, bytes, int]]:
        if tree == NOWHERE:
            return
        head = self.bytes(tree, 24)
        if head[:4] != b"TREE":
            raise ValueError("a tree node is broken")
        level, count = head[5], struct.unpack_from("<H", head, 6)[0]
        data = self.bytes(tree + 24, count * (key + 8) + key)
        for i in range(count):
            at = i * (key + 8)
            yield level, data[at : at + key], struct.unpack_from("<Q", data, at + key)[0]

    def walk(self, wanted: Callable[[str], bool] = lambda group: True, at: int | None = None, path: str = "") -> Iterator[tuple[str, dict, list[Array]]]:
        """(path, attributes, arrays) of every group below the root that has arrays and that is wanted."""
        found = self.messages(self.root if at is None else at)
        tables = [struct.unpack_from("<QQ", b) for n, b in found if n == SYMBOLS]
        arrays, groups = [], []
        for name, header in (x for t in tables for x in self.members(*t)):
            inside = self.messages(header)
            below = f"{path}/{name}" if path else name
            if any(n == SYMBOLS for n, _ in inside):
                groups.append((below, header))
            elif any(n == LAYOUT for n, _ in inside):
                arrays.append((below, inside))
        if arrays and wanted(path):
            known = [a for a in (self.array(p, m) for p, m in arrays) if a]
            yield path, self.attributes(found), known
        for below, header in groups:
            yield from self.walk(wanted, header, below)

    def array(self, path: str, found: list[tuple[int, bytes]]) -> Array | None:
        """None if its kind is not supported."""
        by = dict(found)
        kind, shape = self.kind(by[DATATYPE]), self.shape(by[DATASPACE])
        if kind is None or shape is None:
            return None
        body = by[LAYOUT]
        if body[0] != 3:
            raise ValueError("array layouts of version 3 only")
        if body[1] == 0:
            layout = ("compact", body[4 : 4 + struct.unpack_from("<H", body, 2)[0]])
        elif body[1] == 1:
            layout = ("whole", struct.unpack_from("<Q", body, 2)[0])
        else:
            layout = ("chunks", struct.unpack_from("<Q", body, 3)[0], struct.unpack_from(f"<{body[2] - 1}I", body, 11))
        return Array(path, shape, kind, layout, self.filters(by.get(FILTERS)), self.attributes(found))

    @staticmethod
    def shape(body: bytes) -> tuple[int, ...] | None:
        if body[0] == 1:
            return struct.unpack_from(f"<{body[1]}Q", body, 8)
        return struct.unpack_from(f"<{body[1]}Q", body, 4) if body[3] != 2 else None

    @staticmethod
    def kind(body: bytes) -> np.dtype | None:
        """Also of booleans, which are an enumeration of FALSE and TRUE."""
        bits, size = body[1], struct.unpack_from("<I", body, 4)[0]
        order = ">" if bits & 1 else "<"
        if body[0] & 15 == 0:
            return np.dtype(f"{order}{'i' if bits & 8 else 'u'}{size}")
        if body[0] & 15 == 1 and size in (2, 4, 8):
            return np.dtype(f"{order}f{size}")
        if body[0] & 15 == 3:
            return np.dtype(f"S{size}")
        if body[0] & 15 == 8 and bits == 2 and b"FALSE" in body and b"TRUE" in body and size == 1:
            return np.dtype(bool)
        return None

    @staticmethod
    def filters(body: bytes | None) -> list[tuple[int, list[int]]]:
        out, at = [], 8 if body and body[0] == 1 else 2
        for _ in range(body[1] if body else 0):
            number = struct.unpack_from("<H", body, at)[0]
            named = body[0] == 1 or number >= 256
            name = struct.unpack_from("<H", body, at + 2)[0] if named else 0
            at += 4 if named else 2
            count = struct.unpack_from("<H", body, at + 2)[0]
            at += 4 + (padded(name) if body[0] == 1 else name)
            out.append((number, list(struct.unpack_from(f"<{count}I", body, at))))
            at += 4 * count + (4 * (count % 2) if body[0] == 1 else 0)
        return out

    def attributes(self, found: list[tuple[int, bytes]]) -> dict:
        out = {}
        for number, body in found:
            if number != ATTRIBUTE:
                continue
            version = body[0]
            name, kind, space = struct.unpack_from("<HHH", body, 2)
            at, step = (9 if version == 3 else 8), (padded if version == 1 else lambda n: n)
            parts = []
            for n in (name, kind, space):
                parts.append(body[at : at + n])
                at += step(n)
            key, shape, kind = parts[0].rstrip(b"\0").decode(), self.shape(parts[2]), self.kind(parts[1])
            if shape is None:
                continue
            if kind is not None:
                value = np.frombuffer(body, kind, math.prod(shape), at).reshape(shape).tolist()
                out[key] = plain(value)
            elif parts[1][0] & 15 == 9 and parts[1][1] & 15 == 1:  # strings of any length are in a heap of their own
                values = [self.heap_string(body, at + 16 * i) for i in range(math.prod(shape))]
                out[key] = values if shape else values[0]
        return out

    def heap_string(self, body: bytes, at: int) -> str:
        size, heap, index = struct.unpack_from("<IQI", body, at)
        if not size:
            return ""
        whole = struct.unpack_from("<Q", self.bytes(heap, 16), 8)[0]
        data, p = self.bytes(heap, whole), 16
        while p + 16 <= whole:
            number, _, _, n = struct.unpack_from("<HHIQ", data, p)
            if number == index:
                return data[p + 16 : p + 16 + size].decode()
            p += 16 + padded(n)
        raise ValueError("a string is missing")

    def rows(self, a: Array, low: int = 0, high: int | None = None) -> np.ndarray:
        """Elements low to high of the first axis; a single value has none and is returned whole."""
        if not a.shape:
            return self.whole(a, 0, a.kind.itemsize).reshape(())
        high = a.shape[0] if high is None else min(high, a.shape[0])
        low = min(low, high)
        each = math.prod(a.shape[1:])
        if a.layout[0] != "chunks":
            return self.whole(a, low * each * a.kind.itemsize, (high - low) * each * a.kind.itemsize).reshape(high - low, *a.shape[1:])
        out, rank, sides = np.zeros((high - low, *a.shape[1:]), a.kind), len(a.shape), a.layout[2]
        for start, stored, mask, at in self.chunks(a.layout[1], rank, low - sides[0], high):
            data = self.unfiltered(self.bytes(at, stored), a, mask)
            block = np.frombuffer(data, a.kind, math.prod(sides)).reshape(sides)
            lo, hi = max(start[0], low), min(start[0] + sides[0], high)
            if lo < hi:
                to = (slice(lo - low, hi - low), *(slice(s, min(s + n, m)) for s, n, m in zip(start[1:], sides[1:], a.shape[1:], strict=True)))
                cut = (slice(lo - start[0], hi - start[0]), *(slice(0, t.stop - t.start) for t in to[1:]))
                out[to] = block[cut]
        return out

    def whole(self, a: Array, at: int, n: int) -> np.ndarray:
        if a.layout[0] == "compact":
            return np.frombuffer(a.layout[1][at : at + n], a.kind)
        return np.frombuffer(self.bytes(a.layout[1] + at, n) if n and a.layout[1] != NOWHERE else bytes(n), a.kind)

    def chunks(self, tree: int, rank: int, after: int, before: int) -> Iterator[tuple[tuple[int, ...], int, int, int]]:
        """(start, stored bytes, skipped filters, place) of the chunks whose first axis starts between two numbers, by the tree's order."""
        found = list(self.entries(tree, 16 + 8 * rank))
        starts = [struct.unpack_from(f"<{rank}Q", key, 8) for _, key, _ in found]
        for i, (level, key, child) in enumerate(found):
            ahead = starts[i + 1][0] if i + 1 < len(found) else None
            if starts[i][0] >= before or (level and ahead is not None and ahead <= after) or (not level and starts[i][0] <= after):
                continue
            if level:
                yield from self.chunks(child, rank, after, before)
            else:
                yield (starts[i], *struct.unpack_from("<II", key), child)

    @staticmethod
    def unfiltered(data: bytes, a: Array, mask: int) -> bytes:
        for i, (number, values) in reversed([*enumerate(a.filters)]):
            if mask >> i & 1:
                continue
            if number == DEFLATE:
                data = zlib.decompress(data)
            elif number == SHUFFLE:
                width = values[0] if values else a.kind.itemsize
                n = len(data) // width * width
                data = np.frombuffer(data[:n], np.uint8).reshape(width, -1).T.tobytes() + data[n:]
            elif number == FLETCHER:
                data = data[:-4]
            else:
                raise ValueError(f"no filter {number}")
        return data


def plain(x):
    """Bytes as text, in lists too."""
    return [plain(y) for y in x] if isinstance(x, list) else x.rstrip(b"\0").decode("utf-8", "replace") if isinstance(x, bytes) else x


# ---- writing


class FileWriter:
    """Groups and arrays with put(), then close(). The file begins with where its root is, so its compressed bytes are held until then."""

    LEAF, INNER, CHUNK_TREE = 4, 16, 32  # half of the entries that a node has room for, as the format has it by default

    def __init__(self, write: Callable[[bytes], object], chunk_rows: int = 256):
        self.write, self.chunk_rows = write, chunk_rows
        self.tree: dict = {}
        self.held = bytearray(96)

    def out(self, data: bytes) -> int:
        """The place of some bytes; places are multiples of 8."""
        at = len(self.held)
        self.held += data + bytes(padded(len(data)) - len(data))
        return at

    def put(self, group: str, arrays: dict[str, np.ndarray], attributes: dict[str, object]) -> None:
        node = self.node(group)
        node.setdefault("", {}).update(attributes)
        for name, x in arrays.items():
            *above, last = name.split("/")
            self.node("/".join([group, *above]))[last] = self.array(np.asarray(x, order="C"))

    def node(self, path: str) -> dict:
        at = self.tree
        for part in filter(None, path.split("/")):
            at = at.setdefault(part, {})
            if not isinstance(at, dict):
                raise ValueError(f"{path}: {part} is an array")
        return at

    @staticmethod
    def kind(kind: np.dtype) -> bytes:
        size = kind.itemsize
        if kind.kind in "iu":
            return struct.pack("<BBBBIHH", 0x10, 8 if kind.kind == "i" else 0, 0, 0, size, 0, 8 * size)
        if kind.kind == "f":
            exponent, mantissa, bias = {4: (8, 23, 127), 8: (11, 52, 1023)}[size]
            return struct.pack("<BBBBIHHBBBBI", 0x11, 0x20, 8 * size - 1, 0, size, 0, 8 * size, mantissa, exponent, 0, mantissa, bias)
        if kind.kind == "S":
            return struct.pack("<BBBBI", 0x13, 0x10, 0, 0, size)
        raise ValueError(f"no kind {kind}")

    @staticmethod
    def space(shape: tuple[int, ...]) -> bytes:
        return struct.pack(f"<BBBBI{len(shape)}Q", 1, len(shape), 0, 0, 0, *shape)

    def header(self, messages: list[tuple[int, bytes]]) -> int:
        body = b"".join(struct.pack("<HHBBH", n, padded(len(b)), 0, 0, 0) + b + bytes(padded(len(b)) - len(b)) for n, b in messages)
        return self.out(struct.pack("<BBHIII", 1, 0, len(messages), 1, len(body), 0) + body)

    def array(self, x: np.ndarray) -> int:
        x = x.astype(np.int8) if x.dtype == bool else x.astype(x.dtype.newbyteorder("<"))
        messages = [(DATASPACE, self.space(x.shape)), (DATATYPE, self.kind(x.dtype))]
        if x.ndim and len(x) > self.chunk_rows and x[:1].nbytes:  # shorter ones lie in one piece
            rows = min(self.chunk_rows, len(x))
            entries, zeros = [], [0] * x.ndim
            for i in range(0, len(x), rows):
                raw = x[i : i + rows].tobytes()
                raw += bytes(rows * x[:1].nbytes - len(raw))
                data = zlib.compress(np.frombuffer(raw, np.uint8).reshape(-1, x.itemsize).T.tobytes(), 4)
                entries.append((struct.pack(f"<II{x.ndim + 1}Q", len(data), 0, i, *zeros), self.out(data)))
            end = struct.pack(f"<II{x.ndim + 1}Q", 0, 0, -(-len(x) // rows) * rows, *[0] * x.ndim)
            tree = self.nodes(1, entries, end, self.CHUNK_TREE)
            messages.append((LAYOUT, struct.pack(f"<BBBQ{x.ndim + 1}I", 3, 2, x.ndim + 1, tree, rows, *x.shape[1:], x.itemsize)))
            messages.append((FILTERS, struct.pack("<BBHI", 1, 2, 0, 0) + struct.pack("<HHHHII", SHUFFLE, 0, 1, 1, x.itemsize, 0) + struct.pack("<HHHHII", DEFLATE, 0, 1, 1, 4, 0)))
        else:
            messages.append((LAYOUT, struct.pack("<BBQQ", 3, 1, self.out(x.tobytes()) if x.nbytes else NOWHERE, x.nbytes)))
        return self.header(messages)

    def nodes(self, kind: int, entries: list[tuple[bytes, int]], end: bytes, half: int) -> int:
        """The root of a tree over (key, child) entries; each key is the least of its child."""
        level, empty = 0, bytes(len(end))
        while True:
            parts, places = [entries[i : i + 2 * half] for i in range(0, len(entries), 2 * half)] or [[]], []
            size = 24 + 2 * half * (len(end) + 8) + len(end)
            first = len(self.held)
            for i, part in enumerate(parts):
                left, right = (first + j * padded(size) if 0 <= j < len(parts) else NOWHERE for j in (i - 1, i + 1))
                after = parts[i + 1][0][0] if i + 1 < len(parts) else end
                body = struct.pack("<4sBBHQQ", b"TREE", kind, level, len(part), left, right) + b"".join(k + struct.pack("<Q", c) for k, c in part) + after
                places.append(self.out(body + bytes(size - len(body))))
            if len(parts) == 1:
                return places[0]
            entries, level = [(p[0][0] if p else empty, at) for p, at in zip(parts, places, strict=True)], level + 1

    def attribute(self, name: str, value: object) -> bytes:
        data = np.array(value.encode() or b"\0") if isinstance(value, str) else np.asarray(value)
        data = data.astype(np.int64) if data.dtype == bool else data
        key, kind, space = name.encode() + b"\0", self.kind(data.dtype), self.space(data.shape)
        fit = lambda b: b + bytes(padded(len(b)) - len(b))
        return struct.pack("<BBHHH", 1, 0, len(key), len(kind), len(space)) + fit(key) + fit(kind) + fit(space) + data.tobytes()

    def group(self, node: dict) -> tuple[int, int, int]:
        """Header, tree and heap of a group whose members are written before it."""
        own = dict(node)
        attributes = own.pop("", {})
        members = {name: self.group(x) if isinstance(x, dict) else (x, 0, 0) for name, x in own.items()}
        names, offsets = bytearray(8), {}
        for name in sorted(members, key=str.encode):
            offsets[name] = len(names)
            raw = name.encode() + b"\0"
            names += raw + bytes(padded(len(raw)) - len(raw))
        heap = self.out(struct.pack("<4sBBHQQQ", b"HEAP", 0, 0, 0, len(names), 1, len(self.held) + 32) + names)
        ordered, entries, last = sorted(members, key=str.encode), [], 0
        for i in range(0, len(ordered), 2 * self.LEAF):
            part = ordered[i : i + 2 * self.LEAF]
            rows = b""
            for name in part:
                header, tree, below = members[name]
                rows += struct.pack("<QQIIQQ", offsets[name], header, 1 if tree else 0, 0, tree, below)
            leaf = struct.pack("<4sBBH", b"SNOD", 1, 0, len(part)) + rows
            entries.append((struct.pack("<Q", last), self.out(leaf + bytes(8 + 80 * self.LEAF - len(leaf)))))
            last = offsets[part[-1]]
        tree = self.nodes(0, entries, struct.pack("<Q", last), self.INNER)
        messages = [(SYMBOLS, struct.pack("<QQ", tree, heap)), *((ATTRIBUTE, self.attribute(k, v)) for k, v in attributes.items())]
        return self.header(messages), tree, heap

    def close(self) -> None:
        header, tree, heap = self.group(self.tree)
        size = len(self.held)
        head = SIGNATURE + struct.pack("<BBBBBBBBHHIQQQQ", 0, 0, 0, 0, 0, 8, 8, 0, self.LEAF, self.INNER, 0, 0, NOWHERE, size, NOWHERE)
        self.held[:96] = head + struct.pack("<QQIIQQ", 0, header, 1, 0, tree, heap)
        self.write(bytes(self.held))


# ---- as a Spark source


LISTING = "file string, group string, dataset string, shape array<long>, kind string, attributes string, group_attributes string"
LISTED = pa.schema([("file", pa.string()), ("group", pa.string()), ("dataset", pa.string()), ("shape", pa.list_(pa.int64())), ("kind", pa.string()), ("attributes", pa.string()), ("group_attributes", pa.string())])
#: Steps that are read at once, and rows of a batch, about.
BLOCK = 4096
#: Files of fewer bytes are read at once; a task has several of them, of as many bytes in all.
SMALL = 4 << 20


def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of small batches in batches of BLOCK rows or a little more."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= BLOCK:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n = [], 0
    if n:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def numbers(x: pa.Array) -> np.ndarray:
    """Numbers, or lists of equally many of them, as an array of doubles; nulls are nan."""
    kind = x.type
    if (pa.types.is_list(kind) or pa.types.is_large_list(kind)) and not x.null_count:
        sizes = np.unique(np.diff(x.offsets.to_numpy()))
        if len(sizes) > 1:
            raise ValueError("the arrays of a group differ in shape from step to step")
        inner = numbers(x.flatten())
        return inner.reshape(len(x), int(sizes[0]), *inner.shape[1:])
    if pa.types.is_integer(kind) or pa.types.is_floating(kind):
        return x.cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False)
    return np.array(x.to_pylist(), np.float64)


@dataclass
class Bundle(InputPartition):
    """Files of one task."""

    splits: list[splits.Split]


def asked(options) -> list[tuple[str, str]]:
    """(column, path of the array in its group) of the option datasets."""
    out = []
    for part in filter(None, (x.strip() for x in options.get("datasets", "").split(","))):
        name, _, path = part.partition("=")
        out.append((name if path else re.sub(r"\W", "_", name), path or name))
    return out


class Reader(DataSourceReader):
    def __init__(self, options):
        self.root, self.datasets = options["path"], asked(options)
        self.groups: set[str] | None = None
        self.low, self.high = 0, None

    def pushFilters(self, filters: list[Filter]):
        """Groups are left to the reader; bounds of step tell it which part of the arrays to read."""
        for f in filters:
            name = getattr(f, "attribute", None)
            if name == ("group",) and isinstance(f, (EqualTo, In)):
                found = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.groups = found if self.groups is None else self.groups & found
                continue
            if name == ("step",) and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                self.low = max(self.low, f.value + isinstance(f, GreaterThan))
            if name == ("step",) and isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                end = f.value + (not isinstance(f, LessThan))
                self.high = end if self.high is None else min(self.high, end)
            yield f

    def partitions(self):
        """A task per file, or per several small ones."""
        out, size = [], SMALL
        for x in (x for ending in (".hdf5", ".h5") for x in splits.split_files(self.root, ending, None)):
            if size + x.size > SMALL:
                out.append(Bundle([]))
                size = 0
            out[-1].splits.append(x)
            size += x.size
        return out

    def read(self, bundle):
        return joined(b for split in bundle.splits for b in self.of_file(split))

    def of_file(self, split: splits.Split) -> Iterator[pa.RecordBatch]:
        with split.open() as handle:
            held = handle.read() if split.size <= SMALL else None

            def of(start: int, end: int) -> bytes:
                if held is not None:
                    return held[start:end]
                handle.seek(start)
                return handle.read(end - start)

            file = File(of, split.size)
            if self.datasets:
                yield from self.steps(file, split.path)
                return
            wanted = lambda group: self.groups is None or group in self.groups
            rows = []
            for group, attributes, arrays in file.walk(wanted):
                rows += [(split.path, group, a.path[len(group) :].strip("/"), list(a.shape), str(a.kind), json.dumps(a.attributes), json.dumps(attributes)) for a in arrays]
                if len(rows) >= BLOCK:
                    yield self.listed(rows)
                    rows = []
            if rows:
                yield self.listed(rows)

    @staticmethod
    def listed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), LISTED, strict=True)], schema=LISTED)

    def steps(self, file: File, path: str) -> Iterator[pa.RecordBatch]:
        by_group: dict[str, dict[str, Array]] = {}
        for _, _, arrays in file.walk():
            for a in arrays:
                for _, name in self.datasets:
                    if a.path.endswith("/" + name) or a.path == name:
                        by_group.setdefault(a.path[: -len(name)].strip("/"), {})[name] = a
        for group, found in by_group.items():
            if len(found) < len({p for _, p in self.datasets}) or (self.groups is not None and group not in self.groups):
                continue
            lengths = {a.shape[0] if a.shape else -1 for a in found.values()}
            if len(lengths) > 1 or -1 in lengths:
                raise ValueError(f"{path}: arrays of {group} differ in length")
            n = lengths.pop()
            for low in range(min(self.low, n), n if self.high is None else min(self.high, n), BLOCK):
                high = min(low + BLOCK, n if self.high is None else min(self.high, n))
                size, columns = high - low, []
                for _, name in self.datasets:
                    x = file.rows(found[name], low, high).astype(np.float64).reshape(size, -1)
                    columns.append(pa.ListArray.from_arrays(pa.array(np.arange(size + 1) * x.shape[1], pa.int32()), pa.array(x.reshape(-1))))
                head = [pa.array([path] * size), pa.array([group] * size), pa.array(np.arange(low, high))]
                yield pa.RecordBatch.from_arrays([*head, *columns], names=["file", "group", "step", *(c for c, _ in self.datasets)])


class Writer(DataSourceArrowWriter):
    """A file for each `file`, a group for each `group`, and in it each other column as an array with a row per step."""

    def __init__(self, options, overwrite: bool):
        self.output, self.chunk_rows = splits.Output(options["path"], overwrite), int(options.get("chunk_rows", 256))

    def write(self, iterator):
        files, name, file, out, group, held, done = [], None, None, None, None, [], set()

        def put() -> None:
            """The rows of a group, which are slices of batches."""
            if held:
                t = pa.Table.from_batches(held)
                columns = {c: pa.concat_arrays(t[c].chunks) for c in t.column_names if c not in ("file", "group", "step", "attributes")}
                extra = dict(t["attributes"][0].as_py() or []) if "attributes" in t.column_names else {}
                out.put(group, {c: numbers(x) for c, x in columns.items()}, {"num_samples": t.num_rows, **extra})

        def close() -> None:
            if out:
                put()
                out.close()
                file.close()

        for b in iterator:
            if not b.num_rows:
                continue
            keys = [b.column(b.schema.names.index(c)) for c in ("file", "group", "step")]
            if any(c.null_count for c in keys):
                raise ValueError("a step needs file, group and step")
            runs = [c.dictionary_encode().indices.to_numpy() for c in keys[:2]]
            first = np.flatnonzero(np.append(True, (runs[0][1:] != runs[0][:-1]) | (runs[1][1:] != runs[1][:-1])))
            for lo, hi in zip(first.tolist(), [*first[1:].tolist(), b.num_rows], strict=True):
                f, g = keys[0][lo].as_py(), keys[1][lo].as_py()
                if f != name:
                    if f in done:
                        raise ValueError("a file's rows must be together; use write_episodes()")
                    close()
                    done.add(f)
                    name, group, held = f, g, []
                    file, place = self.output.create(f"{f}.hdf5")
                    out = FileWriter(file.write, self.chunk_rows)
                    files.append(place)
                elif g != group:
                    put()
                    group, held = g, []
                held.append(b.slice(lo, hi - lo))
        close()
        return splits.Written(files)

    def commit(self, messages):
        self.output.commit(messages)

    def abort(self, messages):
        self.output.abort()


class Hdf5Source(DataSource):
    """Options: path; datasets (names, or column=path, of arrays in a group; without it the arrays are listed); chunk_rows (written)."""

    @classmethod
    def name(cls):
        return "hdf5"

    def schema(self):
        columns = asked(self.options)
        return ", ".join(["file string", "group string", "step long", *(f"`{c}` array<double>" for c, _ in columns)]) if columns else LISTING

    def reader(self, schema: StructType):
        return Reader(self.options)

    def writer(self, schema: StructType, overwrite: bool):
        return Writer(self.options, overwrite)


def register(spark: SparkSession) -> None:
    splits.register(spark, Hdf5Source, sys.modules[__name__], splits, store)


def write_episodes(rows: DataFrame, path: str, chunk_rows: int = 256, overwrite: bool = False, order: list[str] | None = None) -> None:
    """Write rows (file, group, step, columns of numbers or of arrays of them, all of a group's equally long) as HDF5.

    A column `attributes`, a map from text to text, gives its group's attributes, those of its first step; num_samples is added. A file
    is one task's, which holds an episode's rows and the file's compressed bytes. Rows without file, group or step are an error.
    order: columns that are not written, and by which a group's steps are numbered from 0; rows have no step then, and one exchange
    and sort are for both.
    """
    register(rows.sparkSession)
    dealt = rows.repartition("file").withColumn("_hash", F.xxhash64("file"))  # names begin alike, which a sort would compare for each two rows
    if order:
        step = F.row_number().over(Window.partitionBy("_hash", "file", "group").orderBy(*order)) - 1
        dealt = dealt.withColumn("step", step).sortWithinPartitions("_hash", "file", "group", *order).drop(*order)
    else:
        dealt = dealt.sortWithinPartitions("_hash", "file", "group", "step")
    dealt = dealt.drop("_hash")
    dealt.write.format("hdf5").option("chunk_rows", chunk_rows).mode("overwrite" if overwrite else "append").save(path)
