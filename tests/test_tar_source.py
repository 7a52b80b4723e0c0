"""Tar shards written and read as a Spark source."""

from __future__ import annotations

import io
import tarfile

import pytest
from pyspark.sql import functions as F

from millrace.sources import readers, tar_source


class Counting(io.BytesIO):
    """Counts the bytes that are read."""

    seen = 0

    def read(self, n=-1):
        data = super().read(n)
        self.seen += len(data)
        return data

    def readinto(self, b):
        n = super().readinto(b)
        self.seen += n
        return n


def shard():
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as tar:
        for i in range(20):
            for suffix, size in (("json", 10), ("bin", 50_000), ("", 3)):
                m = tarfile.TarInfo(f"a.b/c/{i:03d}" + (f".{suffix}" if suffix else ""))
                m.size = size
                tar.addfile(m, io.BytesIO(bytes([i]) * size))
        folder = tarfile.TarInfo("folder")
        folder.type = tarfile.DIRTYPE
        tar.addfile(folder)
    return out.getvalue()


def test_unwanted_members_are_passed_over():
    data = shard()
    every, some, none, other = (Counting(data) for _ in range(4))
    rows = list(tar_source.members(every, "x/y/z.tar", {}, True))
    assert len(rows) == 60 and rows[1] == ("z.tar", "y", 1, "000", "bin", 50_000, b"\0" * 50_000) and rows[2][3:5] == ("000", "")
    assert list(tar_source.members(some, "x/y/z.tar", {"suffix": {"json"}}, True)) == [r for r in rows if r[4] == "json"]
    assert [r[:6] for r in tar_source.members(none, "x/y/z.tar", {}, False)] == [r[:6] for r in rows]
    assert list(tar_source.members(other, "x/y/z.tar", {"shard": {"other.tar"}}, True)) == [] and other.seen == 0
    assert every.seen > 1_000_000 and some.seen < 100_000 and none.seen < 100_000


def test_source_and_reader_agree(spark, tmp_path):
    """Filters in the scan and after it, null payloads and suffixes, an empty folder, and files that are there already."""
    rows = [(f"d{i % 2}/s{i % 5}", f"{i:04d}", s, bytearray(f"{i}{s}".encode() * 50) if s != "none" else None) for i in range(200) for s in ("txt", "json", "none")] + [("d0/s0", "last", None, bytearray(b"x"))]
    df = spark.createDataFrame(rows, "shard string, key string, suffix string, payload binary")
    path = str(tmp_path / "shards")
    tar_source.write_shards(df, path)
    read = spark.read.format("tar_shards").load(path)
    want = {(f.split("/")[0], f.split("/")[1] + ".tar", k, s or "", bytes(p or b"")) for f, k, s, p in rows}
    assert {(r.data_key, r.shard, r.key, r.suffix, bytes(r.payload)) for r in read.collect()} == want
    same = ["shard", "data_key", "pos", "key", "suffix", "payload"]
    assert sorted(map(tuple, read.select(same).collect())) == sorted(map(tuple, readers.tar_shards(spark, path).select(same).collect()))
    some = read.where("suffix in ('json', 'none') and shard = 's1.tar' and pos > 5")
    assert {(r.key, r.suffix) for r in some.collect()} == {(r.key, r.suffix) for r in read.collect() if r.suffix in ("json", "none") and r.shard == "s1.tar" and r.pos > 5}
    assert read.where("shard = 'none.tar'").collect() == []
    assert spark.read.format("tar_shards").option("payload", "false").load(path).where(F.col("payload").isNotNull()).count() == 0
    with pytest.raises(Exception, match="has some of these files"):
        tar_source.write_shards(df, path)
    with pytest.raises(Exception, match="there is no"):
        spark.read.format("tar_shards").load(str(tmp_path / "nothing")).count()
    with pytest.raises(Exception, match="needs shard and key"):
        tar_source.write_shards(df.withColumn("key", F.lit(None).cast("string")), str(tmp_path / "bad"))
