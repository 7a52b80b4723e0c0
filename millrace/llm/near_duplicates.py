"""Near-duplicate groups by SimHash tries, completed by an exact join of shingle sets.

Texts of equal SimHash fingerprints, and of fingerprints that the self-join of binary tries (simhash.py) links, are compared
by their shingle sets and linked if those are similar. A fingerprint of 64 bits cannot reach every pair: at a Jaccard similarity
of 0.8 two texts differ in ten bits on average. So the rest is found by a prefix filter. Every text's distinct shingles are put in one
order, rare ones first. Two texts of a similarity of `similarity` or more share one of the first n - ceil(similarity * n) + 1 of
either, so texts meet by those, in a list for each such shingle; sizes and places rule out most chance meetings, and every other
pair is decided by its two shingle sets. In a list of many texts all are first compared with one, then with those that
parities of shingle sets make likely, as few as join them; then every pair of texts that are not in one group yet, and that parities do
not rule out, is compared too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import textops as T
from millrace.llm.graph import components
from millrace.llm.joins import bitmap, in_bitmap, lookup
from millrace.llm.scratch import Scratch
from millrace.llm.simhash import hamming_links, majority_bits

U = np.uint64
#: log2 of the bits that mark the texts whose shingles are compared; more texts only mean more chance hits.
MARK_BITS = 24
#: Differing bits up to which the tries link fingerprints.
BUDGET = 3
#: Lists of more texts are first compared with one of them.
STAR = 16
#: Rows of a list that one task holds; longer lists are cut into blocks that meet two by two.
BLOCK = 50_000
#: Counters of shingles. They only order the shingles: with fewer, more pairs are compared, and the same are found.
MANY, SEGMENTS = 1 << 23, 16
#: Bits of a text's parities, and rounds in which long lists are joined by likely pairs before all pairs that can be similar are made.
PARITIES, ROUNDS = 1024, 2
#: Against rounding: 0.8 * 15 may be a little over 12.
TINY = 1e-9


def counter(h: np.ndarray, many: int) -> np.ndarray:
    return ((h >> U(32)) * U(many) >> U(32)).astype(np.int64)


def fresh(key: np.ndarray, seen: set[int]) -> np.ndarray:
    """Places of the keys that are not in `seen`, each once; they are added to it."""
    some, at = np.unique(key, return_index=True)
    new = np.array([k not in seen for k in some.tolist()], bool)
    seen.update(some[new].tolist())
    return np.sort(at[new])


def counted(size: int, many: int):
    """Rows (doc, key, text) to (doc, key, number of shingles, fingerprint), and rows of the task's counters."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times, seen = np.zeros(many, np.uint16), set()
        for batch in it:
            key, n, prints = T.longs(batch.column(1)), np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.uint64)
            new = np.zeros(batch.num_rows, bool)
            new[fresh(key, seen)] = True
            for lo, hi, buf, offs in T.text_slices(batch.column(2)):
                h, first = shingle_hashes(buf, offs, size)
                n[lo:hi] = np.diff(first)
                prints[lo:hi] = majority_bits(h, first)
                at, more = np.unique(counter(h, many)[np.repeat(new[lo:hi], n[lo:hi])], return_counts=True)
                times[at] = np.minimum(times[at] + more, 65535)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n), pa.array(prints.view(np.int64)), pa.nulls(len(n), pa.binary())], names=["doc", "key", "n", "fingerprint", "data"])
        some = np.flatnonzero(times)
        cuts = np.searchsorted(some, np.arange(SEGMENTS + 1) * -(-many // SEGMENTS))
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            at = some[cuts[k] : cuts[k + 1]]
            yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([0]), pa.array([k]), pa.array([0]), pa.array([T.pack(at.astype(np.uint32), times[at])], pa.binary())], names=["doc", "key", "n", "fingerprint", "data"])

    return run


def summed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tasks' counters by segment to one packed row for each segment."""
    held: dict[int, dict[str, np.ndarray]] = {}
    for batch in it:
        for k, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            at, more = T.unpack(data)
            if k in held:
                at, place = np.unique(np.concatenate((held[k]["at"], at)), return_inverse=True)
                more = np.bincount(place, weights=np.concatenate((held[k]["n"], more.astype(np.int64)))).astype(np.int64)
            held[k] = {"at": at, "n": np.minimum(more.astype(np.int64), 65535)}
    for x in held.values():
        yield pa.RecordBatch.from_arrays([pa.array([T.pack(x["at"], x["n"].astype(np.uint16))], pa.binary())], names=["data"])


def shingle_hashes(buf: np.ndarray, offs: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each document of a slice, and each document's first."""
    starts, ends, first = T.word_bounds(buf, offs, T.IS_WORD)
    sums = T.prefix(T.word_hashes(T.LOWER[buf], starts, ends))
    n = np.diff(first)
    some = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    head = T.ragged(first[:-1], some)
    h = T.span_hash(sums, head, np.minimum(head + size, np.repeat(first[1:], some)))
    doc = np.repeat(np.arange(len(offs) - 1), some)
    o = np.lexsort((h, doc))
    h, doc = h[o], doc[o]
    new = np.append(True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])) if len(h) else np.zeros(0, bool)
    return h[new], np.append(0, np.cumsum(np.bincount(doc[new], minlength=len(offs) - 1)))


def shingle_sets(size: int, marks):
    """Rows (key, text) of marked keys to their shingle sets."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in it:
            key = T.longs(batch.column(0))
            pick = np.flatnonzero(in_bitmap(marks.value, MARK_BITS, key))
            pick = pick[fresh(key[pick], seen)]
            texts = batch.column(1).take(pa.array(pick))
            for lo, hi, buf, offs in T.text_slices(texts):
                h, first = shingle_hashes(buf, offs, size)
                sets = [T.pack(h[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(key[pick[lo:hi]]), pa.array(sets, pa.binary())], names=["key", "shingles"])

    return run


def alike(similarity: float):
    """Pairs (u, v, sets of both) to those of a similarity."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            ok = []
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                (x,), (y,) = T.unpack(a.as_py()), T.unpack(b.as_py())
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(both >= similarity * (len(x) + len(y) - both) - TINY)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(ok, pa.bool_())), batch.column(1).filter(pa.array(ok, pa.bool_()))], names=["u", "v"])

    return run


def deal(size: int, similarity: float, times, parts: int):
    """Rows (key, text) to packed (shingle, key, size of the set, place in its order) of the first shingles, by shingle."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in it:
            key = T.longs(batch.column(0))
            pick = fresh(key, seen)
            out: list[tuple[np.ndarray, ...]] = []
            for lo, hi, buf, offs in T.text_slices(batch.column(1).take(pa.array(pick))):
                h, first = shingle_hashes(buf, offs, size)
                n = np.diff(first)
                doc = np.repeat(np.arange(hi - lo), n)
                count = times.value[counter(h, len(times.value))]
                o = np.lexsort((h, count, doc))
                place = np.arange(len(h)) - first[doc]
                most = n - np.ceil(similarity * n - TINY).astype(np.int64) + 1
                some = np.flatnonzero((place < most[doc]) & (count[o] > 1))  # a shingle of one text meets none
                out.append((h[o[some]], key[pick[lo:hi]][doc[some]], n[doc[some]].astype(np.int32), place[some].astype(np.int32)))
            if not out:
                continue
            columns = [np.concatenate(x) for x in zip(*out, strict=True)]
            part = (T.mix(columns[0]) >> U(32)) * U(parts) >> U(32)
            o = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[o], np.arange(parts + 1, dtype=np.uint64))
            for p in np.flatnonzero(np.diff(cuts)).tolist():
                i = o[cuts[p] : cuts[p + 1]]
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([T.pack(*(c[i] for c in columns))], pa.binary())], names=["part", "data"])

    return run


def may_be_alike(i: np.ndarray, j: np.ndarray, n: np.ndarray, place: np.ndarray, similarity: float) -> np.ndarray:
    """Whether the sets at places i and j can be similar if the list's shingle is the first that they share."""
    both = np.minimum(n[i] - place[i], n[j] - place[j])
    return both >= similarity / (1 + similarity) * (n[i].astype(np.int64) + n[j]) - TINY


def pair_batch(us: list[np.ndarray], vs: list[np.ndarray]) -> pa.RecordBatch:
    """Pairs, each once, the smaller key first."""
    u, v = np.concatenate(us), np.concatenate(vs)
    u, v = np.minimum(u, v), np.maximum(u, v)
    o = np.lexsort((v, u))
    u, v = u[o], v[o]
    some = (u != v) & np.append(True, (u[1:] != u[:-1]) | (v[1:] != v[:-1]))[: len(u)]
    return pa.RecordBatch.from_arrays([pa.array(u[some]), pa.array(v[some]), pa.nulls(int(some.sum()), pa.binary())], names=["u", "v", "data"])


def candidates(similarity: float, star: int):
    """Packed lists to pairs (u, v) of short lists, and of long ones with their smallest key; packed rows of the long lists."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = [x for batch in it for x in batch.column(1).to_pylist()]
        if not blobs:
            return
        h, key, n, place = T.unpack_all(blobs)
        blobs.clear()
        o = np.lexsort((key, h))
        o = o[np.append(True, (h[o[1:]] != h[o[:-1]]) | (key[o[1:]] != key[o[:-1]]))] if len(o) else o
        h, key, n, place = h[o], key[o], n[o], place[o]
        head = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
        long = np.diff(np.append(head, len(h)))
        first, long = np.repeat(head, long), np.repeat(long, long)
        us, vs = [], []
        for gap in range(1, star):
            i = np.flatnonzero((h[gap:] == h[:-gap]) & (long[gap:] <= star)) if gap < len(h) else np.zeros(0, np.int64)
            i = i[may_be_alike(i, i + gap, n, place, similarity)]
            us.append(key[i])
            vs.append(key[i + gap])
        big = np.flatnonzero(long > star)
        some = big[may_be_alike(first[big], big, n, place, similarity)]
        us.append(key[first[some]])
        vs.append(key[some])
        yield pair_batch(us, vs)
        for at in range(0, len(big), 1 << 20):
            i = big[at : at + (1 << 20)]
            yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([0]), pa.array([T.pack(h[i], key[i], n[i], place[i])], pa.binary())], names=["u", "v", "data"])

    return run


def long_lists(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        for data in batch.column(0).to_pylist():
            h, key, n, place = T.unpack(data)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(key), pa.array(n), pa.array(place)], names=["h", "key", "n", "place"])


def parities(size: int, marks):
    """Rows (key, text) of marked keys to the parities of their shingles: bit b is that of the number of shingles whose hash ends in b."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in it:
            key = T.longs(batch.column(0))
            pick = np.flatnonzero(in_bitmap(marks.value, MARK_BITS, key))
            pick = pick[fresh(key[pick], seen)]
            for lo, hi, buf, offs in T.text_slices(batch.column(1).take(pa.array(pick))):
                h, first = shingle_hashes(buf, offs, size)
                at = np.repeat(np.arange(hi - lo), np.diff(first)) * PARITIES + (T.mix(h) % U(PARITIES)).astype(np.int64)
                bits = np.bincount(at, minlength=(hi - lo) * PARITIES) & 1
                own = np.packbits(bits.astype(bool).reshape(hi - lo, PARITIES), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(key[pick[lo:hi]]), pa.array([x.tobytes() for x in own], pa.binary())], names=["key", "bits"])

    return run


def differing(bits: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Bits in which the parities of i and j differ: no more than the shingles that one of the two sets has alone."""
    out = np.zeros(len(i), np.int64)
    for lo in range(0, len(i), 1 << 16):
        out[lo : lo + (1 << 16)] = np.bitwise_count(bits[i[lo : lo + (1 << 16)]] ^ bits[j[lo : lo + (1 << 16)]]).sum(1)
    return out


def forest(t: dict[str, np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of pairs of one list that are likely to be similar, and that would make its roots as few as such pairs can: at most as many as rows.

    Texts of the most lists come first, and each is met with one text of every other root, so that lists of the same texts make the
    same pairs: of near copies, the original has the least of its own.
    """
    rows, us, vs = np.lexsort((t["key"], -t["degree"])), [], []
    _, label = np.unique(t["root"], return_inverse=True)
    for i in rows.tolist():
        j = rows[label[rows] != label[i]]
        if not len(j):
            break
        at = np.full(len(j), i)
        j = j[may_be_alike(at, j, t["n"], t["place"], similarity) & ((t["side"][i] == 0) | (t["side"][i] != t["side"][j]))]
        apart = differing(t["bits"], np.full(len(j), i), j)
        likely = -PARITIES / 2 * np.log1p(-2 * np.minimum(apart, PARITIES // 2 - 1) / PARITIES)  # shingles apart, of which even numbers of one bit cancel
        j = j[likely <= (t["n"][i] + t["n"][j].astype(np.int64)) * (1 - similarity) / (1 + similarity) + TINY]
        labels, first = np.unique(label[j], return_index=True)
        if len(labels):
            us.append(np.full(len(first), i))
            vs.append(j[first])
            label[np.isin(label, labels)] = label[i]
    return (np.concatenate(us), np.concatenate(vs)) if us else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def forests(similarity: float):
    """Rows (h, key, n, place, root, side, degree, bits), whole lists, to the pairs of forest()."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in it if b.num_rows]
        if not held:
            return
        t = meeting_rows(held)
        o = np.argsort(t["h"], kind="stable")
        t = {c: x[o] for c, x in t.items()}
        cuts = np.append(np.flatnonzero(np.append(True, t["h"][1:] != t["h"][:-1])), len(o))
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            i, j = forest({c: x[lo:hi] for c, x in t.items()}, similarity)
            yield pair_batch([t["key"][lo:hi][i]], [t["key"][lo:hi][j]])

    return run


def meeting_rows(batches: list[pa.RecordBatch]) -> dict[str, np.ndarray]:
    t = pa.Table.from_batches(batches)
    out = {c: t[c].to_numpy() for c in ("h", "key", "n", "place", "root", "side", "degree")}
    raw = b"".join(x for c in t["bits"].chunks for x in c.to_pylist())
    return out | {"bits": np.frombuffer(raw, U).reshape(-1, PARITIES // 64)}


def pairs_between(similarity: float, step: int = 1 << 20):
    """Rows (h, key, n, place, root, side, degree, bits), whole lists, to every pair of a list whose roots differ and that can be similar.

    A list in which both sides occur is a meeting of two blocks of a longer one, and only pairs of either are made. Parities rule a pair out
    if they differ in more bits than similar sets have shingles apart, and no other.
    """

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in it if b.num_rows]
        if not held:
            return
        t = meeting_rows(held)
        h, key, n, place, root, side, bits = (t[c] for c in ("h", "key", "n", "place", "root", "side", "bits"))
        o = np.lexsort((key, root, h))
        bits = bits[o]
        h, key, n, place, root, side = h[o], key[o], n[o], place[o], root[o], side[o]
        new = np.append(True, h[1:] != h[:-1])
        end = np.append(np.flatnonzero(new)[1:], len(h))[np.cumsum(new) - 1]  # of each row's list
        new |= np.append(True, root[1:] != root[:-1])
        after = np.append(np.flatnonzero(new)[1:], len(h))[np.cumsum(new) - 1]  # of its rows of one root
        many = end - after
        sums = np.append(0, np.cumsum(many))
        lo = 0
        while lo < len(h):
            hi = max(lo + 1, int(np.searchsorted(sums, sums[lo] + step, "right")) - 1)
            i = np.repeat(np.arange(lo, hi), many[lo:hi])
            j = T.ragged(after[lo:hi], many[lo:hi])
            ok = may_be_alike(i, j, n, place, similarity) & ((side[i] == 0) | (side[i] != side[j]))
            i, j = i[ok], j[ok]
            ok = differing(bits, i, j) <= (n[i].astype(np.int64) + n[j]) * (1 - similarity) / (1 + similarity) + TINY
            yield pair_batch([key[i[ok]]], [key[j[ok]]])
            lo = hi

    return run


def in_blocks(lists: DataFrame) -> DataFrame:
    """Lists (h, key, n, place, root, degree, bits, m rows) as they are, or those of over BLOCK rows as meetings of each two of their blocks.

    A meeting has a name of its own in h, and its blocks are told apart by side: 1 and 2, or 0 for a block that meets itself.
    """
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    rows = lists.withColumn("block", F.pmod(F.xxhash64("key", "h"), F.greatest(blocks, F.lit(1))).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.greatest(blocks, F.lit(1)) - 1)).alias("other")
    rows = rows.select("h", "key", "n", "place", "root", "degree", "bits", "m", "block", other)
    name = F.when(F.col("m") > BLOCK, F.xxhash64("h", F.least("block", "other"), F.greatest("block", "other"))).otherwise(F.col("h"))
    side = F.when(F.col("block") < F.col("other"), 1).when(F.col("block") > F.col("other"), 2).otherwise(0)
    return rows.select(name.alias("h"), "key", "n", "place", "root", side.alias("side"), "degree", "bits")


def near_duplicate_groups(docs: DataFrame, size: int = 5, similarity: float = 0.8, per_part: int = 400_000) -> DataFrame:
    """Groups of texts whose sets of `size`-word shingles are similar, with their classes of equal texts.

    Returns doc_id, key (xxhash64 of the text), group_id (the smallest doc_id of the group) and first (whether the row is the
    one that stays: that doc_id, and the smallest key of it). Words are runs of anything but space and \\t to \\r, A-Z
    lower-cased; a shorter text's whole sequence is its shingle. Two texts are linked at a Jaccard similarity of
    `similarity` or more; groups are connected by links. Shingles are told apart by 64-bit hashes; nothing else is approximate.

    Null, empty and wordless texts have no shingles and form one group. A null doc_id counts as the largest. Repeated rows
    (equal doc_id and text) are all `first` or none; dedup_near() keeps one of them. Other columns are ignored. An empty table gives no rows.
    per_part: shingles that one task joins, about.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near_duplicates")
    docs = docs.select("doc_id", "text")
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(np.iinfo(np.int64).max))
    texts = docs.select(F.xxhash64("text").alias("key"), "text")
    both = scratch.save(docs.select(doc.alias("doc"), F.xxhash64("text").alias("key"), "text").mapInArrow(T.lean(counted(size, MANY)), "doc long, key long, n long, fingerprint long, data binary"))
    rows = both.where("data is null").select("doc", "key", "n", "fingerprint")
    classes = scratch.save(rows.groupBy("key").agg(F.min("doc").alias("doc"), F.count("*").alias("times"), F.min("n").alias("n"), F.min("fingerprint").alias("fingerprint")))
    times = np.zeros(MANY, np.uint16)
    counts = both.where("data is not null").select(F.col("n").cast("int").alias("segment"), "data").repartitionById(SEGMENTS, F.col("segment"))
    for r in counts.mapInArrow(T.lean(summed), "data binary").collect():  # a row per segment, 16 MB in all
        at, more = T.unpack(r.data)
        times[at] = more
    total = classes.agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-int(total * (1 - similarity)) // per_part))
    shared = spark.sparkContext.broadcast(times)
    dealt = texts.mapInArrow(T.lean(deal(size, similarity, shared, parts)), "part int, data binary").repartitionById(parts, F.col("part"))
    met = scratch.save(dealt.mapInArrow(T.lean(candidates(similarity, STAR)), "u long, v long, data binary"))

    def judged(pairs: DataFrame) -> DataFrame:
        """The pairs that are similar, by their shingle sets."""
        pairs = scratch.save(pairs.select("u", "v").distinct())
        marks = bitmap(pairs.select(F.explode(F.array("u", "v")).alias("k")).distinct(), MARK_BITS)
        if not marks.any():
            return pairs
        shared = spark.sparkContext.broadcast(marks)
        sets = scratch.save(texts.mapInArrow(T.lean(shingle_sets(size, shared)), "key long, shingles binary").dropDuplicates(["key"]))
        ends = pairs.join(sets.select(F.col("key").alias("u"), F.col("shingles").alias("x")), "u")  # a hub's pairs are split as a skewed join
        ends = ends.join(sets.select(F.col("key").alias("v"), F.col("shingles").alias("y")), "v").select("u", "v", "x", "y")
        out = scratch.save(ends.mapInArrow(T.lean(alike(similarity)), "u long, v long"))
        shared.destroy()
        scratch.drop(sets)
        scratch.drop(pairs)
        return out

    prints = scratch.save(classes.where("n > 0").groupBy("fingerprint").agg(F.min("key").alias("hub"), F.count("*").alias("times")))
    same = lookup(classes.where("n > 0").select("fingerprint", "key"), prints, "fingerprint", "times", classes.count())
    tied = hamming_links(prints.select("fingerprint"), prints.count(), 64, BUDGET)
    for end in ("u", "v"):
        tied = tied.join(prints.select(F.col("fingerprint").alias(end), F.col("hub").alias(f"{end}_hub")), end)
    near = same.where("key <> hub").select(F.col("hub").alias("u"), F.col("key").alias("v"))
    near = near.unionByName(tied.select(F.col("u_hub").alias("u"), F.col("v_hub").alias("v")))
    links = judged(near.unionByName(met.where("data is null").select("u", "v")))
    shared.destroy()
    blank = classes.where("n = 0").select("key")
    hub = blank.agg(F.min("key").alias("u"))
    links = links.unionByName(blank.join(F.broadcast(hub)).select("u", F.col("key").alias("v")))
    roots = scratch.save(components(links, scratch).withColumnRenamed("node", "key"))
    lists = met.where("data is not null").select("data").mapInArrow(T.lean(long_lists), "h long, key long, n int, place int")
    lists = scratch.save(lists)

    def rooted() -> DataFrame:
        """Rows of the lists whose texts are of different roots, with these."""
        rows = scratch.save(lists.join(roots, "key", "left").select("h", "key", "n", "place", F.coalesce("root", "key").alias("root")))
        mixed = rows.groupBy("h").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count("*").alias("m")).where("a <> b").select("h", "m")
        out = scratch.save(rows.join(mixed, "h"))
        scratch.drop(rows)
        return out

    mixed = rooted()
    if not mixed.isEmpty():
        marks = spark.sparkContext.broadcast(bitmap(mixed.select("key").distinct(), MARK_BITS))
        bits = texts.mapInArrow(T.lean(parities(size, marks)), "key long, bits binary").dropDuplicates(["key"])
        known = scratch.save(bits.join(lists.groupBy("key").agg(F.count("*").alias("degree")), "key"))
        for turn in range(ROUNDS + 1):
            meetings = scratch.save(in_blocks(mixed.join(known, "key")))
            step = forests if turn < ROUNDS else pairs_between
            more = judged(meetings.repartition(F.col("h")).mapInArrow(T.lean(step(similarity)), "u long, v long, data binary"))
            tied = roots.select(F.col("key").alias("u"), F.col("root").alias("v"))
            roots = scratch.save(components(tied.unionByName(more), scratch).withColumnRenamed("node", "key"))
            scratch.drop(meetings)
            scratch.drop(mixed)
            mixed = rooted()
            if mixed.isEmpty():
                break
        marks.destroy()
        scratch.drop(known)
    named = classes.join(roots, "key", "left").select("key", "doc", "times", F.coalesce("root", "key").alias("root"))
    held = scratch.save(named)
    best = held.groupBy("root").agg(F.min(F.struct("doc", "key")).alias("best"))
    named = scratch.save(held.join(best, "root").select("key", "times", F.col("best.doc").alias("group"), F.col("best.key").alias("best_key")))
    for done in (met, prints, lists, mixed, held):  # what the result does not read
        scratch.drop(done)
    out = lookup(rows.select("doc", "key"), named, "key", "times", rows.count())
    some = lambda c: F.when(F.col(c) != np.iinfo(np.int64).max, F.col(c))
    return out.select(some("doc").alias("doc_id"), "key", some("group").alias("group_id"), ((F.col("doc") == F.col("group")) & (F.col("key") == F.col("best_key"))).alias("first"))


def dedup_near(docs: DataFrame, size: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of docs, with all their columns, of which near_duplicate_groups() says that they stay; of repeated rows one.

    Columns of docs may have any names.
    """
    scratch = Scratch(docs.sparkSession, "dedup_near")
    last = F.lit(np.iinfo(np.int64).max)
    stay = near_duplicate_groups(docs.select("doc_id", "text"), size, similarity).where("first")
    stay = scratch.save(stay.select(F.coalesce("doc_id", last).alias("doc"), "key", F.lit(1).alias("one")))
    kept = stay.distinct()
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), last).alias("doc"), F.xxhash64("text").alias("key"), F.struct(*docs.columns).alias("row"))
    out = rows.join(kept.select("doc", "key").hint("shuffle_hash"), ["doc", "key"])
    if stay.count() != kept.count():
        out = out.dropDuplicates(["doc", "key"])
    return out.select("row.*")
