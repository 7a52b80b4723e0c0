"""Best-fit packing of documents into training sequences, with conflicts.

Documents are cut into pieces of at most `capacity` tokens and dealt to packing groups by a hash; each group is packed
by itself, largest piece first. Open bins are ordered by what is left in them and carry bitmaps of their sources and
duplicate clusters. A piece goes to the fullest bin that it fits and does not conflict with: the search starts at the
smallest sufficient residual and goes on to the next residual until it finds a compatible bin, or opens a new one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import textops as T


class Bins:
    """Open bins, findable by residual."""

    def __init__(self, capacity: int, sources: int, source_limit: int):
        self.capacity, self.sources, self.limit = capacity, sources, source_limit
        self.nonempty = 0  # bit r is set if a bin has r tokens left
        #: residual -> (sources at their limit, clusters) -> bins
        self.at: dict[int, dict[tuple[int, int], list[int]]] = {}
        self.left: list[int] = []
        self.source_bits: list[int] = []  # one bitmap of sources after another: of those with one piece or more, with two, ...
        self.cluster_bits: list[int] = []

    def _key(self, b: int) -> tuple[int, int]:
        return self.source_bits[b] >> (self.sources * (self.limit - 1)), self.cluster_bits[b]

    def _put(self, b: int) -> None:
        left = self.left[b]
        if left:
            self.at.setdefault(left, {}).setdefault(self._key(b), []).append(b)
            self.nonempty |= 1 << left

    def find(self, size: int, source: int, cluster: int) -> int:
        """Take out the tightest compatible bin; -1 if there is none."""
        rest = self.nonempty >> size
        left = size
        while rest:
            skip = (rest & -rest).bit_length() - 1
            left += skip
            kinds = self.at[left]
            for key, bins in kinds.items():
                if not key[0] & source and not key[1] & cluster:
                    b = bins.pop()
                    if not bins:
                        del kinds[key]
                        if not kinds:
                            del self.at[left]
                            self.nonempty ^= 1 << left
                    return b
            rest >>= skip + 1
            left += 1
        return -1

    def add(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """Bin and offset of a piece. source and cluster are single bits; cluster may be 0."""
        b = self.find(size, source, cluster)
        if b < 0:
            b = len(self.left)
            self.left.append(self.capacity)
            self.source_bits.append(0)
            self.cluster_bits.append(0)
        offset = self.capacity - self.left[b]
        self.left[b] -= size
        plane = source
        while self.source_bits[b] & plane:
            plane <<= self.sources
        self.source_bits[b] |= plane
        self.cluster_bits[b] |= cluster
        self._put(b)
        return b, offset


def pack(size: np.ndarray, source: list, cluster: np.ndarray, order: np.ndarray, capacity: int, source_limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin, offset and tokens in the bin of each piece; pieces are placed in the given order.

    Pieces of one source share a bin up to source_limit of them; pieces of one cluster never do.
    """
    names = {s: i for i, s in enumerate(dict.fromkeys(source))}
    bins = Bins(capacity, len(names), source_limit)
    kinds, where, counts = np.unique(cluster, return_inverse=True, return_counts=True)
    index = np.cumsum(counts > 1) - 1  # only clusters of several pieces here need a bit
    bits = [1 << int(index[k]) if counts[k] > 1 else 0 for k in range(len(kinds))]
    bin_of, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
    sizes, of = size.tolist(), where.tolist()
    for i in order.tolist():
        bin_of[i], offset[i] = bins.add(sizes[i], 1 << names[source[i]], bits[of[i]])
    fill = capacity - np.array(bins.left, np.int64)
    return bin_of, offset, fill[bin_of] if len(size) else fill


def measure(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to their number of tokens: words, and one end."""
    for batch in it:
        offs, data = T.strings(batch.column(1))
        n = [len(data[a:b].tobytes().split()) + 1 for a, b in zip(offs[:-1], offs[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array(n, pa.int64())], names=["doc_id", "source", "cluster", "n"])


def packer(capacity: int, source_limit: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in it if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held)
        size, cluster, piece = (t[k].to_numpy() for k in ("n_tokens", "cluster", "piece"))
        doc = np.asarray(t["doc_id"].fill_null(np.iinfo(np.int64).max))
        group = t["part"].to_numpy()
        bin_of, offset, fill = (np.zeros(len(size), np.int64) for _ in range(3))
        source = t["source"].to_pylist()
        for g in np.unique(group):
            own = np.flatnonzero(group == g)
            order = np.lexsort((piece[own], cluster[own], doc[own], -size[own]))
            b, offset[own], fill[own] = pack(size[own], [source[i] for i in own.tolist()], cluster[own], order, capacity, source_limit)
            bin_of[own] = (int(g) << 32) + b
        out = [t["doc_id"], t["piece"], t["n_tokens"], pa.array(bin_of), pa.array(offset), pa.array(fill)]
        yield from pa.Table.from_arrays(out, names=["doc_id", "piece", "n_tokens", "bin_id", "bin_offset", "bin_tokens"]).combine_chunks().to_batches(10_000)

    return run


def best_fit_packing(docs: DataFrame, capacity: int = 2048, source_limit: int = 4, group_rows: int = 20_000) -> DataFrame:
    """Pack the texts of docs (doc_id, text, source) into bins of `capacity` tokens.

    Tokens are words (runs of anything but space and \\t to \\r) and one end for each document. Returns a row per piece:
    doc_id, piece (from 0; all but a document's last have `capacity` tokens), n_tokens, bin_id, bin_offset (tokens before it
    in the bin) and bin_tokens (of all its pieces). No bin has over source_limit pieces of one source, or two whole
    documents with equal texts, or the same piece of two longer ones.

    Null and empty texts are one token, the end. A null source is a source of its own; null texts equal each other. Equal
    sizes go by doc_id (null last), then by text hash. Repeated rows are packed each, in different bins. Other columns are
    ignored. An empty table gives no rows. group_rows: documents that one task packs, about.
    """
    groups = max(1, -(-docs.count() // group_rows))
    cluster = F.xxhash64(F.coalesce("text", F.lit("")), F.col("text").isNull())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("source").cast("string").alias("source"), cluster.alias("cluster"))
    rows = rows.mapInArrow(T.lean(measure), "doc_id long, source string, cluster long, n long")
    last = ((F.col("n") - 1) / capacity).cast("long")
    rows = rows.select("doc_id", "source", "cluster", "n", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
    rows = rows.select(
        F.pmod(F.xxhash64("doc_id", "cluster"), F.lit(groups)).cast("int").alias("part"),
        "doc_id",
        "source",
        # equal pieces of copies conflict, as whole copies do; the pieces of one text do not
        F.when(F.col("n") > capacity, F.xxhash64("cluster", "piece")).otherwise(F.col("cluster")).alias("cluster"),
        "piece",
        F.least(F.lit(capacity).cast("long"), F.col("n") - F.col("piece") * capacity).alias("n_tokens"),
    )
    rows = rows.repartitionById(groups, F.col("part"))
    return rows.mapInArrow(T.lean(packer(capacity, source_limit)), "doc_id long, piece long, n_tokens long, bin_id long, bin_offset long, bin_tokens long")


def op6(spark, sf_dir: str) -> DataFrame:
    return best_fit_packing(spark.read.parquet(f"{sf_dir}/documents.parquet"))
