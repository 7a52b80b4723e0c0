"""HDF5 files written and read back, and one put together by hand."""

from __future__ import annotations

import io
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.sources import hdf5

NONE = 0xFFFFFFFFFFFFFFFF


def opened(data, seen=None):
    def read(a, b):
        if seen is not None:
            seen.append((a, b))
        return data[a:b]

    return hdf5.File(read, len(data))


def write(groups, **options):
    out = io.BytesIO()
    w = hdf5.FileWriter(out.write, **options)
    for g, (arrays, attributes) in groups.items():
        w.put(g, arrays, attributes)
    w.close()
    return out.getvalue()


def test_round_trip_of_kinds_and_shapes():
    rng = np.random.default_rng(1)
    arrays = {"f8": rng.normal(size=(37, 5)), "f4": rng.normal(size=(9,)).astype(np.float32), "u1": rng.integers(0, 255, (11, 3, 4, 2)).astype(np.uint8), "i8": np.arange(5) - 2, "i2": np.zeros((0, 3), np.int16), "one": np.float64(2.5), "flag": np.array([True, False]), "s": np.array([b"ab", b"cde"])}
    data = write({"data/demo_0": (arrays, {"task": "fold \u00e9", "n": 3, "x": 1.5, "v": [1, 2]}), "data/demo_1/obs": ({"deep/er": arrays["f8"]}, {}), "top": ({}, {})}, chunk_rows=4)
    found = {g: (a, {x.path: x for x in xs}) for g, a, xs in opened(data).walk()}
    assert set(found) == {"data/demo_0", "data/demo_1/obs/deep"}
    attributes, by = found["data/demo_0"]
    assert attributes == {"task": "fold \u00e9", "n": 3, "x": 1.5, "v": [1, 2]}
    for name, x in arrays.items():
        a = by[f"data/demo_0/{name}"]
        assert a.shape == np.shape(x) and np.array_equal(opened(data).rows(a), np.asarray(x).astype(a.kind))
    whole = by["data/demo_0/f8"]
    for low, high in ((0, 0), (0, 1), (3, 5), (4, 8), (7, 30), (36, 37), (30, 99), (40, 50)):
        assert np.array_equal(opened(data).rows(whole, low, high), arrays["f8"][low:high])


def test_a_part_reads_its_chunks_only():
    x = np.random.default_rng(2).normal(size=(4000, 8))
    data, seen = write({"g": ({"x": x}, {})}, chunk_rows=10), []
    file = opened(data, seen)
    (array,) = next(file.walk())[2]
    seen.clear()
    assert np.array_equal(file.rows(array, 2001, 2009), x[2001:2009])
    assert sum(min(b, len(data)) - a for a, b in seen) < len(data) / 20
    assert np.array_equal(file.rows(array), x)  # 400 chunks: a tree of two levels


def test_many_members():
    data = write({f"data/demo_{i}": ({"a": np.array([i])}, {"i": i}) for i in range(2500)})
    file = opened(data)
    got = {g: (a["i"], int(file.rows(xs[0])[0])) for g, a, xs in file.walk()}
    assert got == {f"data/demo_{i}": (i, i) for i in range(2500)}


def by_hand():
    """A file as other writers make them: small nodes, a continued header, arrays in one piece, in the header and in chunks with a checksum,
    big-endian numbers, booleans, and a string attribute in a heap."""
    blob = bytearray(96)

    def put(data):
        at = len(blob)
        blob.extend(data + bytes(-len(data) % 8))
        return at

    def message(n, body):
        return struct.pack("<HHBBH", n, len(body) + -len(body) % 8, 0, 0, 0) + body + bytes(-len(body) % 8)

    def header(*parts):
        return put(struct.pack("<BBHIII", 1, 0, len(parts), 1, sum(map(len, parts)), 0) + b"".join(parts))

    space = lambda *dims: message(1, struct.pack(f"<BBBBI{len(dims)}Q", 1, len(dims), 0, 0, 0, *dims))
    short = bytes([0x10, 0x09, 0, 0]) + struct.pack("<IHH", 2, 0, 16)  # signed, big-endian
    enum = bytes([0x18, 2, 0, 0]) + struct.pack("<I", 1) + bytes([0x10, 8, 0, 0]) + struct.pack("<IHH", 1, 0, 8) + b"FALSE\0\0\0TRUE\0\0\0\0\0\1"
    numbers = np.arange(12, dtype=">i2").reshape(6, 2)
    piece = header(space(6, 2), message(3, short), message(8, struct.pack("<BBQQ", 3, 1, put(numbers.tobytes()), 24)))
    inside = header(space(3), message(3, enum), message(8, struct.pack("<BBH", 3, 0, 3) + b"\1\0\1"))
    chunks = []
    for i, j in ((0, 0), (0, 1), (4, 0), (4, 1)):
        block = np.zeros((4, 1), ">i2")
        part = numbers[i : i + 4, j : j + 1]
        block[: len(part)] = part
        stored = zlib.compress(block.tobytes()) + b"sum!"
        chunks.append((struct.pack("<IIQQQ", len(stored), 0, i, j, 0), put(stored)))
    tree = put(b"TREE" + struct.pack("<BBHQQ", 1, 0, 4, NONE, NONE) + b"".join(k + struct.pack("<Q", a) for k, a in chunks) + struct.pack("<IIQQQ", 0, 0, 8, 0, 0))
    pipeline = struct.pack("<BBHI", 1, 2, 0, 0) + struct.pack("<HHHH8sII", 1, 8, 0, 1, b"deflate\0", 6, 0) + struct.pack("<HHHH", 3, 0, 0, 0)
    heap = put(b"GCOL" + struct.pack("<BBHQ", 1, 0, 0, 64) + struct.pack("<HHIQ", 7, 1, 0, 5) + b"hello\0\0\0" + bytes(24))
    string = bytes([0x19, 1, 0, 0]) + struct.pack("<I", 16) + bytes([0x13, 0, 0, 0]) + struct.pack("<I", 1)
    attribute = struct.pack("<BBHHHB", 3, 0, 5, len(string), 4, 1) + b"task\0" + string + struct.pack("<BBBB", 2, 0, 0, 0) + struct.pack("<IQI", 5, heap, 7)
    rest = message(11, pipeline) + message(12, attribute)
    more = put(rest)
    first = [space(6, 2), message(3, short), message(8, struct.pack("<BBBQIII", 3, 2, 3, tree, 4, 1, 2)), message(16, struct.pack("<QQ", more, len(rest)))]
    chunked = header(*first)

    def group(members):
        names, rows = bytearray(8), b""
        for name, at in members:
            rows += struct.pack("<QQIIQQ", len(names), at, 0, 0, 0, 0)
            names += name + bytes(8 - len(name))
        local = put(b"HEAP" + struct.pack("<IQQQ", 0, len(names), NONE, len(blob) + 32) + names)
        leaf = put(b"SNOD" + struct.pack("<BBH", 1, 0, len(members)) + rows)
        top = put(b"TREE" + struct.pack("<BBHQQ", 0, 0, 1, NONE, NONE) + struct.pack("<QQQ", 0, leaf, 8))
        return header(message(17, struct.pack("<QQ", top, local)))

    root = group([(b"demo", group([(b"chunked", chunked), (b"inside", inside), (b"piece", piece)]))])
    blob[:96] = b"\x89HDF\r\n\x1a\n" + struct.pack("<8BHHIQQQQ", 0, 0, 0, 0, 0, 8, 8, 0, 4, 16, 0, 0, NONE, len(blob), NONE) + struct.pack("<QQIIQQ", 0, root, 0, 0, 0, 0)
    return bytes(blob), numbers


def test_bytes_by_hand():
    data, numbers = by_hand()
    file = opened(data)
    ((group, attributes, arrays),) = file.walk()
    by = {a.path: a for a in arrays}
    assert group == "demo" and attributes == {} and by["demo/chunked"].attributes == {"task": "hello"}
    for low, high in ((0, 6), (3, 5), (4, 6), (5, 5)):
        for name in ("piece", "chunked"):
            assert np.array_equal(file.rows(by[f"demo/{name}"], low, high), numbers[low:high])
    assert file.rows(by["demo/inside"]).tolist() == [True, False, True]
    with pytest.raises(ValueError, match="cut off"):
        list(opened(data[:-40]).walk())
    with pytest.raises(ValueError, match="not an HDF5"):
        opened(b"something else" * 20)


def test_spark_source(spark, tmp_path):
    rows = [(f"d/f{e % 3}", f"data/demo_{e}", i, [e + i / 10, -1.0], float(i), {"task": f"t{e}"}) for e in range(12) for i in range(e + 1)]
    df = spark.createDataFrame(rows, "file string, group string, step int, actions array<double>, qpos double, attributes map<string,string>").withColumnRenamed("qpos", "obs/qpos")
    path = str(tmp_path / "episodes")
    hdf5.write_episodes(df, path, chunk_rows=3)
    read = spark.read.format("hdf5").option("datasets", "actions, q=obs/qpos").load(path)
    want = sorted((g, i, a, [q]) for _, g, i, a, q, _ in rows)
    assert sorted((r.group, r.step, r.actions, r.q) for r in read.collect()) == want
    some = read.where("step > 2 and step <= 7 and group in ('data/demo_5', 'data/demo_11', 'data/none')")
    assert sorted((r.group, r.step) for r in some.collect()) == sorted((g, i) for g, i, *_ in want if 2 < i <= 7 and g in ("data/demo_5", "data/demo_11"))
    listed = spark.read.format("hdf5").load(path).where(F.col("group") == "data/demo_7").collect()
    assert [(r.dataset, r.shape) for r in listed] == [("actions", [8, 2])] and '"task": "t7"' in listed[0].group_attributes and '"num_samples": 8' in listed[0].group_attributes
    assert spark.read.format("hdf5").option("datasets", "nothing").load(path).count() == 0
    with pytest.raises(Exception, match="needs file, group"):
        hdf5.write_episodes(df.withColumn("step", F.lit(None).cast("int")), str(tmp_path / "bad"))


def test_numbers_without_a_python_object_each():
    nested = pa.array([[[1, 2], [3, 4]], [[5, 6], [7, 8]]], pa.list_(pa.list_(pa.int32())))
    assert np.array_equal(hdf5.numbers(nested.slice(1)), [[[5, 6], [7, 8]]])
    assert np.array_equal(hdf5.numbers(pa.array([[1.5, None], [2.5, 3.5]])), [[1.5, np.nan], [2.5, 3.5]], equal_nan=True)
    assert hdf5.numbers(pa.array([[], []], pa.list_(pa.float64()))).shape == (2, 0)
    assert np.array_equal(hdf5.numbers(pa.array([True, False])), [1, 0])
    with pytest.raises(ValueError):
        hdf5.numbers(pa.array([[1.0], [1.0, 2.0]]))


def test_small_files_share_a_task_and_steps_are_numbered(spark, tmp_path):
    rows = spark.range(600).selectExpr("concat('f', id % 40) AS file", "concat('demo_', id % 80) AS `group`", "-id AS k", "array(double(id)) AS x")
    path = str(tmp_path / "ordered")
    hdf5.write_episodes(rows, path, chunk_rows=3, order=["k"])
    reader = hdf5.Reader({"path": path, "datasets": "x"})
    parts = reader.partitions()
    assert sum(len(p.splits) for p in parts) == 40 and len(parts) == 1
    assert sum(1 for p in parts for _ in reader.read(p)) == 1  # a batch of many groups
    got = {(r.group, r.step): r.x[0] for r in spark.read.format("hdf5").option("datasets", "x").load(path).collect()}
    want = {}
    for g in range(80):
        for i, x in enumerate(sorted((x for x in range(600) if x % 80 == g), reverse=True)):
            want[(f"demo_{g}", i)] = float(x)
    assert got == want
