"""MCAP files written and read back, and bytes put together by hand."""

from __future__ import annotations

import io
import struct
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.sources import mcap


def write(messages, chunk_bytes=200):
    file = io.BytesIO()
    out = mcap.RecordingWriter(file.write, chunk_bytes)
    for m in messages:
        out.put(**m)
    out.close()
    return file.getvalue()


def recording(data):
    return mcap.Recording(lambda a, b: data[a:b], len(data))


MESSAGES = [{"topic": f"/t{i // 50}", "data": bytes([i % 256]) * (i % 7), "log_time": 1000 + i, "sequence": i, "schema": "s" if i % 2 else "", "encoding": "cdr"} for i in range(200)]


def test_round_trip_and_skipped_chunks():
    """A topic's read opens the chunks that have it; a range of times those that meet it."""
    data = write(MESSAGES)
    full = recording(data)
    got = list(full.messages())
    assert [(m[0], m[6], m[4], m[3], m[1] or "") for m in got] == [(m["topic"], m["data"], m["log_time"], m["sequence"], m["schema"]) for m in MESSAGES]
    assert full.opened == len(full.chunks) > 20
    one = recording(data)
    assert [m[3] for m in one.messages({"/t2"})] == [*range(100, 150)] and one.opened <= len(one.chunks) / 4 + 2
    late = recording(data)
    assert [m[4] for m in late.messages(low=1190, high=1194)] == [1190, 1191, 1192, 1193, 1194] and late.opened <= 3
    none = recording(data)
    assert list(none.messages({"/other"})) == [] and none.opened == 0


def test_ranges_of_a_file_are_read_once():
    data = write(MESSAGES)
    cuts = [0, 1, 500, 2000, 2001, len(data)]
    got = [m[3] for a, b in zip(cuts, cuts[1:]) for m in recording(data).messages(start=a, end=b)]  # noqa: B905
    assert got == [*range(200)]


@pytest.mark.parametrize("how", ["", "lz4"])
def test_bytes_by_hand(how):
    """Magic, header, a chunk with schema, channel and two messages, one message outside, no index; and the file cut off."""
    text = lambda x: struct.pack("<I", len(x)) + x
    rec = lambda k, b: struct.pack("<BQ", k, len(b)) + b
    inner = rec(3, struct.pack("<H", 5) + text(b"Pose") + text(b"ros2msg") + text(b"def")) + rec(4, struct.pack("<HH", 9, 5) + text(b"/p") + text(b"cdr") + struct.pack("<I", 0))
    message = lambda s: rec(5, struct.pack("<HIQQ", 9, s, 70 + s, 71 + s) + b"xy")
    inner += message(1) + message(2)
    packed = pa.Codec("lz4").compress(inner).to_pybytes() if how else inner
    chunk = rec(6, struct.pack("<QQQI", 71, 72, len(inner), zlib.crc32(inner)) + text(how.encode()) + struct.pack("<Q", len(packed)) + packed)
    data = mcap.MAGIC + rec(1, text(b"") + text(b"x")) + chunk + message(3) + rec(15, struct.pack("<I", 0)) + rec(2, struct.pack("<QQI", 0, 0, 0)) + mcap.MAGIC
    rows = list(recording(data).messages())
    assert [r[:2] + r[3:] for r in rows] == [("/p", "Pose", i, 70 + i, 71 + i, b"xy") for i in (1, 2, 3)]
    assert list(recording(data).messages(start=10)) == []  # whoever has the start reads it
    cut = data[: len(data) - 60]
    assert [r[3] for r in recording(cut).messages()] == [1, 2]
    broken = bytearray(data)
    broken[data.index(b"xy", data.index(packed[-10:]) - 40 if how else 0)] ^= 1
    if not how:
        with pytest.raises(ValueError, match="checksum"):
            list(recording(bytes(broken)).messages())
    with pytest.raises(ValueError, match="not an MCAP"):
        recording(b"something else")


def test_spark_source(spark, tmp_path):
    rows = spark.createDataFrame([(f"r{i % 3}", f"/t{i % 4}", 10 * i, bytearray([i % 256] * 30), i) for i in range(900)], "file string, topic string, log_time long, data binary, sequence long")
    path = str(tmp_path / "recordings")
    mcap.write_recordings(rows, path, chunk_bytes=500)
    read = spark.read.format("mcap").option("split_bytes", 3000).load(path)
    back = read.select(F.regexp_extract("file", r"([^/]+)\.mcap$", 1), "topic", "log_time", "data", "sequence")
    assert read.rdd.getNumPartitions() > 3
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
    some = read.where("topic in ('/t1', '/t2') and log_time >= 4000 and log_time < 8000 and sequence % 3 = 0")
    assert sorted(r.sequence for r in some.collect()) == [i for i in range(400, 800) if i % 4 in (1, 2) and i % 3 == 0]
    assert read.where("topic = 'none'").count() == 0
    with pytest.raises(Exception, match="has some of these files"):
        mcap.write_recordings(rows, path)
    mcap.write_recordings(rows.where("file = 'r1'").limit(0), str(tmp_path / "empty"))
    with pytest.raises(Exception, match="needs file, topic"):
        mcap.write_recordings(rows.withColumn("topic", F.lit(None).cast("string")), str(tmp_path / "bad"))
    assert not list((tmp_path / "bad").glob("*.mcap")) if (tmp_path / "bad").exists() else True
