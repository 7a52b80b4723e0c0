"""SimHash fingerprints, and their near-duplicate classes by a self-join of binary tries.

Fingerprints are dealt out so that any two within the error budget meet: the bits are cut into blocks, one more than
the budget at least, and two fingerprints with at most `budget` differing bits agree on all but `budget` blocks. For
each choice of agreeing blocks, the fingerprints that share them are the leaves of one binary trie over the other bits.
The trie is joined with itself: node pairs are walked down together, bit by bit, adding up differing bits, and a pair is
left as soon as the sum exceeds the budget. Links are reduced to a spanning forest in each task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import textops as T
from millrace.llm.graph import components
from millrace.llm.joins import lookup
from millrace.llm.scratch import Scratch
from millrace.llm.xxh64 import xxh64

U = np.uint64
LANES = U(0x0101010101010101)


def shingles(buf: np.ndarray, offs: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, starts, ends, first shingle of each document): lower-cased words joined by one space, `size` at a time.

    A document of fewer words, but not none, has its whole sequence as one shingle.
    """
    starts, ends, first = T.word_bounds(buf, offs, T.IS_WORD)
    lens = ends - starts
    text = T.LOWER[buf[np.minimum(T.ragged(starts, lens + 1), max(len(buf) - 1, 0))]]
    place = np.cumsum(lens + 1) - (lens + 1)
    text[place + lens] = 0x20
    words = np.diff(first)
    count = np.where(words >= size, words - size + 1, np.minimum(words, 1))
    head = T.ragged(first[:-1], count)
    last = np.minimum(head + size, np.repeat(first[1:], count)) - 1
    return text, place[head], place[last] + lens[last], np.append(0, np.cumsum(count))


def majority_bits(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit value per document: the bits that are set in over half of its hashes."""
    rows = len(first) - 1
    count = np.diff(first)
    some = np.flatnonzero(count)
    out = np.zeros(rows, np.uint64)
    if not len(some):
        return out
    pieces = -(-count[some] // 255)  # eight sums of a byte each hold 255 bits
    heads = T.ragged(np.zeros(len(some), np.int64), pieces) * 255 + np.repeat(first[some], pieces)
    row_heads = np.cumsum(pieces) - pieces
    bits = np.zeros((len(some), 8, 8), bool)  # byte, bit within it
    for j in range(8):
        sums = np.add.reduceat((hashes >> U(j)) & LANES, heads)
        sums = np.add.reduceat(sums.view(np.uint8).reshape(-1, 8).astype(np.int64), row_heads, axis=0)
        bits[:, :, j] = 2 * sums > count[some][:, None]
    out[some] = np.packbits(bits.reshape(-1, 64), axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprinter(size: int, seed: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            out = np.zeros(batch.num_rows, np.uint64)
            for lo, hi, buf, offs in T.text_slices(batch.column(1), 1 << 19):
                text, start, end, first = shingles(buf, offs, size)
                out[lo:hi] = majority_bits(xxh64(text, start, end, seed), first)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.view(np.int64))], names=["doc_id", "fingerprint"])

    return run


def fingerprints(docs: DataFrame, size: int = 3, seed: int = 42) -> DataFrame:
    """doc_id and the 64-bit SimHash (as a signed long) of each row's shingles; 0 where there are no words."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(T.lean(fingerprinter(size, seed)), "doc_id long, fingerprint long")


def block_plan(nodes: int, bits: int, budget: int) -> list[tuple[int, ...]]:
    """For each choice of agreeing blocks the order of bits (0 is the highest) that puts them first.

    There are just enough blocks for about 16 fingerprints a trie.
    """
    blocks = budget + 1
    while blocks < bits and (1 << (bits * (blocks - budget) // blocks)) * 16 < nodes and len(list(combinations(range(blocks + 1), budget))) <= 56:
        blocks += 1
    cuts = [bits * i // blocks for i in range(blocks + 1)]
    plan = []
    for free in combinations(range(blocks), budget):
        same = [b for i in range(blocks) if i not in free for b in range(cuts[i], cuts[i + 1])]
        rest = [b for i in free for b in range(cuts[i], cuts[i + 1])]
        plan.append((len(same), *same, *rest))
    return plan


def reorder(x: np.ndarray, order: tuple[int, ...], bits: int) -> np.ndarray:
    """The `bits` bits of x in another order, highest first; runs of neighbours move together."""
    out = np.zeros(len(x), np.uint64)
    i = 0
    while i < len(order):
        j = i + 1
        while j < len(order) and order[j] == order[j - 1] + 1:
            j += 1
        run = (x >> U(bits - order[j - 1] - 1)) & U((1 << (j - i)) - 1)
        out |= run << U(bits - j)
        i = j
    return out


class Links:
    """Components of places 0 to n - 1 of a sorted array, as links are found."""

    def __init__(self, n: int, settled: int):
        self.label = np.arange(n)
        self.settled = settled  # within a component of more places no further links are sought
        self._refresh()

    def _refresh(self) -> None:
        self.changes = np.append(0, np.cumsum(self.label[1:] != self.label[:-1])) if len(self.label) else self.label
        self.size = np.bincount(self.label, minlength=len(self.label))

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        self.label = forest(self.label, i, j)
        self._refresh()

    def done(self, alo: np.ndarray, ahi: np.ndarray, blo: np.ndarray, bhi: np.ndarray) -> np.ndarray:
        """Node pairs whose places are all in one settled component."""
        one = (self.changes[ahi - 1] == self.changes[alo]) & (self.changes[bhi - 1] == self.changes[blo])
        return one & (self.label[alo] == self.label[blo]) & (self.size[self.label[alo]] > self.settled)


def trie_pairs(x: np.ndarray, top: int, bits: int, budget: int, links: Links | None = None, leaf: int = 48, most: int = 1 << 17) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places in x (sorted, distinct) that agree on the `top` highest bits and differ in at most `budget` bits.

    A node is a range of x; a frontier holds node pairs of one depth and the bits in which they differ so far. Pairs of
    small nodes are compared leaf by leaf. With `links`, to which the caller adds what it gets, pairs within settled
    components are passed over, so a dense cluster of m places does not cost m * m / 2 comparisons.
    """
    n = len(x)
    key = x >> U(bits - top) if top else np.zeros(n, np.uint64)
    head = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if n else np.zeros(0, np.int64)
    tail = np.append(head[1:], n)
    some = tail - head > 1
    lo, hi = head[some], tail[some]
    if links is not None and n > 1:  # neighbours first: they connect most of a cluster
        near = np.flatnonzero((key[1:] == key[:-1]) & (np.bitwise_count(x[1:] ^ x[:-1]) <= budget))
        yield near, near + 1
    ones: dict[int, np.ndarray] = {}
    work = [(top, lo, hi, lo, hi, np.zeros(len(lo), np.int8))]
    while work:
        depth, *nodes = work.pop()
        if len(nodes[0]) > most // 8:
            half = len(nodes[0]) // 2
            work += [(depth, *(v[i] for v in nodes)) for i in (slice(half, None), slice(None, half))]
            continue
        if links is not None:
            open_ = ~links.done(*nodes[:4])
            nodes = [v[open_] for v in nodes]
        alo, ahi, blo, bhi, diff = nodes
        small = ((ahi - alo) * (bhi - blo) <= leaf) | (depth == bits)
        if small.any():
            yield from _leaves(x, alo[small], ahi[small], blo[small], bhi[small], budget, links, most)
            alo, ahi, blo, bhi, diff = (v[~small] for v in nodes)
        if not len(alo):
            continue
        if depth not in ones:
            ones[depth] = np.append(0, np.cumsum((x >> U(bits - 1 - depth)) & U(1), dtype=np.int64))
        c = ones[depth]
        amid, bmid = ahi - (c[ahi] - c[alo]), bhi - (c[bhi] - c[blo])
        same = alo == blo  # a node with itself: its halves meet once
        children = [
            (alo, amid, bmid, bhi, diff + 1, None),
            (amid, ahi, blo, bmid, diff + 1, ~same),
            (amid, ahi, bmid, bhi, diff, None),
            (alo, amid, blo, bmid, diff, None),
        ]
        out = []
        for p, q, r, s, d, which in children:
            ok = (p < q) & (r < s) & (d <= budget) & ~((p == r) & (q - p == 1) & (s - r == 1))
            if which is not None:
                ok &= which
            out.append((p[ok], q[ok], r[ok], s[ok], d[ok].astype(np.int8)))
        work.append((depth + 1, *(np.concatenate(v) for v in zip(*out, strict=True))))


def _leaves(x, alo, ahi, blo, bhi, budget, links, most):
    at = 0
    while at < len(alo):  # whole node pairs, about `most` comparisons at a time
        size = (ahi[at:] - alo[at:]) * (bhi[at:] - blo[at:])
        to = at + max(1, int(np.searchsorted(np.cumsum(size[: most + 1]), most, "right")))
        pick = np.arange(at, min(to, len(alo)))
        at = to
        if links is not None:
            pick = pick[~links.done(alo[pick], ahi[pick], blo[pick], bhi[pick])]
        if not len(pick):
            continue
        s = (ahi[pick] - alo[pick]) * (bhi[pick] - blo[pick])
        k = np.arange(int(s.sum())) - np.repeat(np.cumsum(s) - s, s)
        width = np.repeat(bhi[pick] - blo[pick], s)
        i, j = np.repeat(alo[pick], s) + k // width, np.repeat(blo[pick], s) + k % width
        ok = i < j
        i, j = i[ok], j[ok]
        ok = np.bitwise_count(x[i] ^ x[j]) <= budget
        yield i[ok], j[ok]


def forest(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least-label components after the links (i, j); label maps each place to its component's least place."""
    while True:
        a, b = label[i], label[j]
        open_ = a != b
        if not open_.any():
            return label
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def link_parts(plan: list[tuple[int, ...]], bits: int, budget: int):
    """Rows (part, choice, fingerprint) to the edges (u, v) of a spanning forest of the links within each choice."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.stack([T.longs(b.column(1)), T.longs(b.column(2))]) for b in it if b.num_rows]
        if not held:
            return
        choice, value = np.concatenate(held, axis=1)
        for c in np.unique(choice).tolist():
            top, *order = plan[c]
            own = value[choice == c].view(np.uint64)
            x = reorder(own, tuple(order), bits)
            o = np.argsort(x)
            x, own = x[o], own[o]
            links = Links(len(x), settled=1)
            for i, j in trie_pairs(x, top, bits, budget, links):
                links.add(i, j)
            label = links.label
            k = np.flatnonzero(label != np.arange(len(x)))
            if len(k):
                yield pa.RecordBatch.from_arrays([pa.array(own[k].view(np.int64)), pa.array(own[label[k]].view(np.int64))], names=["u", "v"])

    return run


def hamming_links(values: DataFrame, nodes: int, bits: int, budget: int, per_part: int = 500_000) -> DataFrame:
    """Edges (u, v) that connect the distinct longs of `values` (column fingerprint) at `budget` or fewer differing bits."""
    plan = block_plan(nodes, bits, budget)
    masks = []
    for top, *order in plan:
        mask = sum(1 << (bits - 1 - b) for b in order[:top])
        masks.append(mask - (1 << 64) if mask >= 1 << 63 else mask)
    parts = max(1, -(-nodes * len(plan) // per_part))
    choices = F.array(*[F.struct(F.lit(i).alias("choice"), F.lit(m).cast("long").alias("mask")) for i, m in enumerate(masks)])
    rows = values.select("fingerprint", F.explode(choices).alias("c"))
    part = F.pmod(F.xxhash64("c.choice", F.col("fingerprint").bitwiseAND(F.col("c.mask"))), F.lit(parts)).cast("int")
    rows = rows.select(part.alias("part"), "c.choice", "fingerprint").repartitionById(parts, F.col("part"))
    return rows.mapInArrow(T.lean(link_parts(plan, bits, budget)), "u long, v long")


def simhash_classes(docs: DataFrame, size: int = 3, budget: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, fingerprint (long) and component_id (the smallest doc_id reachable over links) of each row.

    Words are runs of anything but space and \\t to \\r, A-Z lower-cased; shingles are `size` words joined by a space,
    repeats included, or the whole sequence where it is shorter. A bit of the fingerprint is 1 if it is set in over half
    of the shingles' XXH64 hashes. Fingerprints link at `budget` or fewer differing bits.

    Null and empty texts have fingerprint 0, which links like any other. Rows are judged one by one: repeated rows have
    equal fingerprints and so one component. A null doc_id never names a component that has another. Other columns are
    ignored. An empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "simhash")
    rows = scratch.save(fingerprints(docs, size, seed))
    classes = scratch.save(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    nodes, total = classes.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    roots = components(hamming_links(classes.select("fingerprint"), nodes, 64, budget), scratch)
    named = classes.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    named = scratch.save(named.select("fingerprint", F.coalesce("root", "fingerprint").alias("root"), "least", "n"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = scratch.save(named.join(least, "root").select("fingerprint", "component_id", "n"))
    return lookup(rows, named, "fingerprint", "n", total).select("doc_id", "fingerprint", "component_id")


def op10(spark, sf_dir: str) -> DataFrame:
    out = simhash_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
