"""Importance resampling towards a target distribution of hashed word n-grams.

Within a slice of texts the distinct words are numbered, an n-gram is a tuple of such numbers, and every distinct tuple's text is
put together and hashed once; its bucket and its counts are then joined back to the texts that have it. What tasks send on are a
text's buckets with their counts, and sums over buckets, whose number is fixed.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import textops as T
from millrace.llm.bpe import distinct
from millrace.llm.scratch import Scratch
from millrace.operators.ordering import number_rows

#: Longer words are hashed one by one, shorter ones in columns: all first bytes, all second bytes, and so on.
LONG = 64


def crc_table() -> np.ndarray:
    """CRC-32 of every byte, by the rule of its polynomial."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, c >> 1 ^ np.uint32(0xEDB88320), c >> 1)
    return c


CRC = crc_table()


def crc_append(state: np.ndarray, buf: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """CRC-32 of texts, each with buf[start : start + len] put after what `state` is the CRC-32 of."""
    out = ~state.astype(np.uint32)
    long = np.flatnonzero(lens > LONG)
    at = np.flatnonzero(lens <= LONG)
    at = at[np.argsort(-lens[at], kind="stable")]  # those with a byte left are the first ones
    c, s, n = out[at], starts[at], lens[at]
    for j in range(int(n[0]) if len(n) else 0):
        k = int(np.searchsorted(-n, -j, "left"))  # lens above j
        c[:k] = CRC[(c[:k] ^ buf[s[:k] + j]) & 0xFF] ^ c[:k] >> 8
    out[at] = c
    out = ~out
    for i in long.tolist():
        out[i] = zlib.crc32(buf[starts[i] : starts[i] + lens[i]], int(state[i]))
    return out


def numbered(*ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of one of each distinct tuple, and the number of every row's tuple. Ids are below 2 ** 31."""
    key = ids[0].astype(np.int64)
    for more in ids[1:]:
        key = key << 32 | more
    _, one, number = np.unique(key, return_index=True, return_inverse=True)
    return one, number


def feature_buckets(buf: np.ndarray, offs: np.ndarray, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and bucket of every n-gram of 1 to `longest` words of a slice of lower-cased texts; the number of words of each text."""
    starts, ends, first = T.word_bounds(buf, offs, T.IS_ALNUM)
    lens, rows = ends - starts, np.repeat(np.arange(len(offs) - 1), np.diff(first))
    one, word = distinct(buf, starts, lens)  # the dictionary: a number for each distinct word
    a, n = starts[one], lens[one]
    space = np.array([0x20], np.uint8)
    tuple_, crc = word, crc_append(np.zeros(len(one), np.uint32), buf, a, n)  # of each place its tuple, of each tuple its hash
    out_rows, out_buckets = [rows], [(crc % np.uint32(buckets))[tuple_]]
    for k in range(1, longest):
        inside = np.flatnonzero(rows[k:] == rows[:-k])  # places where k + 1 words begin
        if not len(inside):
            break
        # the tuple of k words at a place, and the word after it
        head, last = tuple_[inside], word[inside + k]
        one_of, number = numbered(head, last)
        spaced = crc_append(crc, space, np.zeros(len(crc), np.int64), np.ones(len(crc), np.int64))
        w = last[one_of]
        crc = crc_append(spaced[head[one_of]], buf, a[w], n[w])
        tuple_ = np.full(len(word), -1, np.int64)
        tuple_[inside] = number
        out_rows.append(rows[inside])
        out_buckets.append((crc % np.uint32(buckets))[number])
    return np.concatenate(out_rows), np.concatenate(out_buckets).astype(np.int64), np.diff(first)


def featurize(docs: DataFrame, longest: int, buckets: int) -> DataFrame:
    """doc_id, n_words, n_features and data: the buckets of each text, with their counts."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for lo, hi, buf, offs in T.text_slices(batch.column(1), 1 << 20):
                rows, bucket, words = feature_buckets(T.LOWER[buf], offs, longest, buckets)
                key, count = np.unique(rows * buckets + bucket, return_counts=True)
                cut = np.searchsorted(key, np.arange(hi - lo + 1) * buckets)
                small = np.uint16 if buckets <= 1 << 16 else np.uint32
                b, c = (key % buckets).astype(small), count.astype(np.uint32)
                data = [pack_counts(b[i:j], c[i:j]) for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
                total = np.bincount(rows, minlength=hi - lo)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(words, pa.int64()), pa.array(total, pa.int64()), pa.array(data, pa.binary())], names=["doc_id", "n_words", "n_features", "data"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(T.lean(run), "doc_id long, n_words long, n_features long, data binary")


def pack_counts(bucket: np.ndarray, count: np.ndarray) -> bytes:
    """Buckets, ascending, and counts: the buckets that occur once, then the others with their counts."""
    once = count == 1
    head = np.array([once.sum(), len(count) - once.sum()], "<u4")
    return head.tobytes() + bucket[once].tobytes() + bucket[~once].tobytes() + count[~once].tobytes()


def unpack_counts(data: bytes, kind: type) -> tuple[np.ndarray, np.ndarray]:
    once, more = np.frombuffer(data, "<u4", 2).tolist()
    bucket = np.frombuffer(data, kind, once + more, 8)
    return bucket.astype(np.int64), np.append(np.ones(once, np.int64), np.frombuffer(data, "<u4", more, 8 + (once + more) * bucket.itemsize).astype(np.int64))


def bucket_counts(features: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs: `buckets` sums come to the driver, however many texts there are."""
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for batch in it:
            for data in batch.column(0).to_pylist():
                bucket, count = unpack_counts(data, kind)
                n[bucket] += count  # a text's buckets are distinct
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(n[some], pa.int64())], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for bucket, n in features.select("data").mapInArrow(T.lean(run), "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's shares in the target and in the source, smoothed by one, rounded down."""
    s, t, m = int(source.sum()), int(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((y + 1.0) * (s + m) / ((x + 1.0) * (t + m)))) for x, y in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weigh(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """Features with weight, the sum of the gains of each text's features, in place of data."""
    kind = np.uint16 if len(gain) <= 1 << 16 else np.uint32

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            weight = [int((gain[x[0]] * x[1]).sum()) for x in (unpack_counts(d, kind) for d in batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(weight, pa.int64())], names=["doc_id", "n_words", "n_features", "weight"])

    return features.select("doc_id", "n_words", "n_features", "data").mapInArrow(T.lean(run), "doc_id long, n_words long, n_features long, weight long")


def importance_resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, longest: int = 3, buckets: int = 10_000, seed: int = 42) -> DataFrame:
    """Draw the rows of docs (doc_id, text) whose words are most like those of target (text), with noise of the seed (Gumbel's top k).

    Features are runs of 1 to `longest` words, in buckets by the CRC-32 of their bytes. Returns doc_id, n_words, n_features, weight
    (the sum of the features' gains), score (weight plus the noise of doc_id) and rank: 1, 2, 3 ... for floor(percent / 100 * N) highest
    scores of the N rows with at least `least_words` words, null for the others. Ties go to the smaller doc_id.

    A null text has no words, weight 0. Rows that share a doc_id share its noise, and are ranked by themselves; repeated rows are
    adjacent ranks. A null doc_id has the noise of an empty one and loses ties. Other columns are ignored. An empty table gives no rows;
    an empty target gives every bucket a share of its own.
    """
    if not 0 <= percent <= 100 or longest < 1 or not 1 <= buckets <= 1 << 24:
        raise ValueError("percent must be 0 to 100, longest at least 1, buckets 1 to 2 ** 24")
    scratch = Scratch(docs.sparkSession, "importance")
    features = scratch.save(featurize(docs, longest, buckets))
    own = bucket_counts(features, buckets)
    wanted = bucket_counts(featurize(target.select(F.lit(0).alias("doc_id"), "text"), longest, buckets), buckets)
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    scored = scratch.save(weigh(features, gains(own, wanted)).withColumn("score", F.col("weight") + noise))
    scratch.drop(features)
    enough = scored.where(F.col("n_words") >= least_words)
    drawn = percent * enough.count() // 100
    order = enough.withColumn("_score", -F.col("score")).withColumn("_id", F.coalesce("doc_id", F.lit((1 << 63) - 1)))
    place = F.col("position") + 1
    ranked = number_rows(order, ["_score", "_id", "n_features", "weight"]).withColumn("rank", F.when(place <= drawn, place))
    names = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    return ranked.select(names).unionByName(scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long")).select(names))


def op12(spark, sf_dir: str) -> DataFrame:
    docs, target = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return importance_resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")
