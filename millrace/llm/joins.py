"""Joins that a hot key does not hold up."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import textops as T

#: Keys that more than one in so many rows have are hot; there are fewer of them than this number.
HOT = 1000
#: Tasks that the rows of a hot key are dealt to.
SALTS = 64


def lookup(rows: DataFrame, table: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """Rows with the columns of table, whose `key` is unique and whose `count` says how many of `total` rows have it.

    Hot keys, of which under HOT numbers are broadcast, are joined by key and salt, with a copy of the table's row for each salt;
    the others by an equi-join in which no key has over total / HOT rows. Rows whose key is not in table are dropped.
    """
    own = [c for c in table.columns if c not in (key, count)]
    is_hot = F.col(count) > total // HOT
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    hot = table.where(is_hot).select(key, *own, salts)
    cold = table.where(~is_hot).select(key, *own)
    marked = rows.join(F.broadcast(table.where(is_hot).select(key, F.lit(True).alias("_hot"))), key, "left")
    salted = marked.where("_hot").select(*rows.columns, F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int").alias("_salt"))
    done = salted.join(hot, [key, "_salt"]).select(*rows.columns, *own)
    rest = marked.where("_hot is null").select(*rows.columns).join(cold, key)
    return done.unionByName(rest.select(*rows.columns, *own))


def bitmap(hashes: DataFrame, bits: int) -> np.ndarray:
    """Packed bits, 2 ** bits of them, in which the leading bits of each hash are set; most significant first. hashes: a column of
    longs, or of packed arrays of them.

    Tasks send the segments in which they have a bit, executors put those together, and the driver gets each segment once.
    """
    shift, segments = 64 - bits, 16
    size = (1 << bits) // segments  # bits of a segment

    def segment_rows(found: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for k in sorted(found):
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([T.pack(found[k])], pa.binary())], names=["segment", "data"])

    def marks(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in it:
            if pa.types.is_binary(batch.schema.types[0]):
                own = [T.unpack(x)[0] for x in batch.column(0).to_pylist()]
                value = np.concatenate(own) if own else np.zeros(0, np.uint64)
            else:
                value = T.longs(batch.column(0)).view(np.uint64)
            at = np.unique((value >> np.uint64(shift)).astype(np.int64))
            cuts = np.searchsorted(at, np.arange(segments + 1) * size)
            for k in np.flatnonzero(np.diff(cuts)).tolist():
                own = found.setdefault(k, np.zeros(size // 8, np.uint8))
                b = at[cuts[k] : cuts[k + 1]] - k * size
                np.bitwise_or.at(own, b >> 3, (128 >> (b & 7)).astype(np.uint8))
        yield from segment_rows(found)

    def union(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in it:
            for k, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = T.unpack(data)[0]
                found[k] = own | found[k] if k in found else own
        yield from segment_rows(found)

    rows = hashes.mapInArrow(T.lean(marks), "segment int, data binary").repartitionById(segments, F.col("segment"))
    out = np.zeros((1 << bits) // 8, np.uint8)
    for k, data in rows.mapInArrow(T.lean(union), "segment int, data binary").collect():  # a row per segment
        out[k * size // 8 : (k + 1) * size // 8] = T.unpack(data)[0]
    return out


def in_bitmap(packed: np.ndarray, bits: int, hashes: np.ndarray) -> np.ndarray:
    at = hashes.view(np.uint64) >> np.uint64(64 - bits)
    return (packed[(at >> np.uint64(3)).astype(np.int64)] << (at & np.uint64(7)).astype(np.uint8)) & 128 > 0
