"""Finding sequences that repeat across a corpus, in stages that each hold one part of the candidates.

A *window* is `window` consecutive elements (bytes or word hashes) of one document. Every window has one anchor,
the position of its least-hashed gram, which depends on the window's content alone, so equal windows have equal
anchors at equal places. The consecutive windows of one anchor form a *unit*. Then

1. anchors: each task emits the anchors of its units; those that occur twice or more go into a bitmap;
2. windows: an anchor of very many different units is *hot*: its windows are dealt out by their own hashes, those that occur
   twice or more, which go into a second bitmap. This stage runs only if there are hot anchors;
3. contents: units of repeated anchors (and chance hits of the bitmap) are sent with their content, and so are repeated
   windows of hot anchors, as units of one window. Equal units of a task are sent once;
4. resolve: a part's units are compared, by their content, by the operator's own method;
5. cover: the repeated ranges of each document are merged and joined with its text.

Hashes only say which contents meet; what is equal is decided by content, in step 3 within a task and in step 4 otherwise.
Documents are keyed by (doc_id, xxhash64 of text): rows that repeat a doc_id and its text are one document with
several rows, rows that repeat only the doc_id are documents of equal rank, neither earlier. A null doc_id counts as the largest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import textops as T
from millrace.llm.joins import bitmap, in_bitmap
from millrace.llm.scratch import Scratch

U = np.uint64
NULL_ID = np.iinfo(np.int64).max
#: log2 of the bits of the bitmaps, as a bound; for small corpora they are smaller. With more repeats than a tenth of the bits the
#: bitmap lets others pass too, which are sent in vain and resolved to nothing.
MOST_BITS = 28
#: Anchors that a task holds before it sends them on, and bytes of contents.
FLUSH_UNITS, FLUSH_BYTES = 300_000, 16 << 20
#: Anchors of more units, a task's equal ones counted once, are hot; so are at most HOT_ANCHORS of them.
HOT_UNITS, HOT_ANCHORS = 20_000, 1_000_000
COLUMNS = ("anchor", "unit", "doc", "tag", "lo", "span", "aoff")


@dataclass(frozen=True)
class Rules:
    """What repeats: `words` or bytes; windows and grams in elements; whether a document can repeat itself."""

    words: bool
    window: int
    gram: int
    within_document: bool


def keyed(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc"),
        F.coalesce(F.xxhash64("text"), F.lit(0)).alias("tag"),
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.struct(*(carry or ["doc_id"])).alias("row"),
    )


def elements(buf: np.ndarray, offs: np.ndarray, words: bool) -> tuple[np.ndarray, np.ndarray]:
    """Element values of a slice and the first element of each document."""
    if not words:
        return T.BYTE_VALUES[buf], offs
    starts, ends, first = T.word_bounds(buf, offs, T.IS_WORD)
    return T.word_hashes(buf, starts, ends), first


def find_units(values: np.ndarray, offs: np.ndarray, rules: Rules) -> dict[str, np.ndarray]:
    """The units of a slice; `at` is the unit's place in the slice, `lo` its place in document `row`."""
    n, k = len(values), rules.gram
    width = rules.window - k + 1
    d = np.diff(offs) >= rules.window
    if not d.any():
        none = np.zeros(0, np.int64)
        return {"anchor": none.astype(np.uint64), "unit": none.astype(np.uint64), "row": none, "at": none, "lo": none, "span": none, "aoff": none}
    sums = T.prefix(values)
    inverse = T.powers(n + 1)[1]
    m = n - k + 1
    h = T.mix((sums[k:] - sums[:m]) * inverse[:m])
    x = (h & U(0xFFFFFFFF00000000)) | np.arange(m, dtype=np.uint64)
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    if size < width:
        x = np.minimum(x[: len(x) - (width - size)], x[width - size :])
    anchor = (x & U(0xFFFFFFFF)).astype(np.int64)
    first, last = offs[:-1][d], offs[1:][d] - rules.window  # first and last window of each document
    ok = np.zeros(len(anchor) + 1, np.int8)
    ok[first] += 1
    ok[last + 1] -= 1
    ok = np.cumsum(ok[:-1], dtype=np.int8) > 0
    head = ok.copy()
    head[1:] &= (anchor[1:] != anchor[:-1]) | ~ok[:-1]
    head[first] = True
    tail = ok.copy()
    tail[:-1] &= head[1:] | ~ok[1:]
    lo, hi = np.flatnonzero(head), np.flatnonzero(tail)
    a = anchor[lo]
    span, aoff = hi - lo, a - lo
    unit = T.mix((sums[hi + rules.window] - sums[lo]) * inverse[lo]) + T.mix((span * 65536 + aoff).astype(np.uint64))
    row = np.searchsorted(offs, lo, "right") - 1
    # the hashes of anchors are small, being minima; mixed again they are spread evenly
    return {"anchor": T.mix(h[a]), "unit": unit, "row": row, "at": lo, "lo": lo - offs[row], "span": span, "aoff": aoff}


def settle(c: dict[str, np.ndarray], content: np.ndarray, at: np.ndarray, lens: np.ndarray, within_document: bool) -> tuple[np.ndarray, np.ndarray]:
    """Of units of equal content, `dup` are those that start again: in a document after the first, or again in their own.

    `keep` are the other places, each once. Without within_document only other documents count, and all places in the first are kept.
    Units of equal hashes whose contents differ from that of the first of them are all kept.
    """
    n = len(c["unit"])
    keep, dup = np.ones(n, bool), np.zeros(n, bool)
    if not n:
        return keep, dup
    key = T.mix(c["anchor"] + c["unit"] * U(3))
    o = np.lexsort((c["lo"], c["tag"], c["doc"], key))
    new = np.append(True, key[o[1:]] != key[o[:-1]])
    group = np.cumsum(new) - 1
    o = o[np.bincount(group)[group] > 1]
    if not len(o):
        return keep, dup
    new = np.append(True, key[o[1:]] != key[o[:-1]])
    first = o[np.maximum.accumulate(np.where(new, np.arange(len(o)), 0))]
    same = (lens[o] == lens[first]) & (c["aoff"][o] == c["aoff"][first])
    size = np.minimum(lens[o], lens[first])
    equal = content[T.ragged(at[o], size)] == content[T.ragged(at[first], size)]
    same &= np.logical_and.reduceat(equal, np.cumsum(size) - size)
    o, first = o[same], first[same]
    doc, tag, lo = (c[k][o] for k in ("doc", "tag", "lo"))
    before = np.append(False, (first[1:] == first[:-1]) & (doc[1:] == doc[:-1]) & (tag[1:] == tag[:-1]))  # in the same document
    place = before & np.append(False, lo[1:] == lo[:-1])  # the same place of a repeated row
    later = doc != c["doc"][first]
    if within_document:
        later |= before & ~place & (lo != c["lo"][_heads(o, before)])
    dup[o] = later
    keep[o] = ~later & ~place
    return keep, dup


def _heads(o: np.ndarray, before: np.ndarray) -> np.ndarray:
    """The first of each run of units in one document."""
    return o[np.maximum.accumulate(np.where(before, 0, np.arange(len(o))))]


def part_of(x: np.ndarray, parts: int) -> np.ndarray:
    """Range partition of 64-bit hashes."""
    return ((x >> U(32)) * U(parts) >> U(32)).astype(np.int64)


def by_part(part: np.ndarray, columns: list[np.ndarray], parts: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    o = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[o], np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(cuts)):
        yield int(p), [x[o[cuts[p] : cuts[p + 1]]] for x in columns]


def cover_rows(doc: np.ndarray, tag: np.ndarray, start: np.ndarray, end: np.ndarray, parts: int) -> list[tuple[int, str, bytes]]:
    (doc, tag), start, end = T.merge_runs([doc, tag], start, end)
    part = part_of(T.mix(doc.astype(np.uint64)), parts)
    return [(p, "cover", T.pack(*x)) for p, x in by_part(part, [doc, tag, start, end], parts)]


ROWS = pa.schema([("part", pa.int32()), ("kind", pa.string()), ("data", pa.binary())])
ROWS_DDL = "part int, kind string, data binary"


def batches(rows: list[tuple[int, str, bytes]]) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(rows), 64):
        part = rows[i : i + 64]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in part], ROWS.types[j]) for j in range(3)], schema=ROWS)


def window_units(u: dict[str, np.ndarray], values: np.ndarray, window: int) -> dict[str, np.ndarray]:
    """Each window of some units as a unit of its own, whose anchor is its start and its hash."""
    count = u["span"] + 1
    at = T.ragged(u["at"], count)
    hashes = T.span_hash(T.prefix(values), at, at + window)
    none = np.zeros(len(at), np.int64)
    return {"anchor": hashes, "unit": hashes, "row": np.repeat(u["row"], count), "at": at, "lo": np.repeat(u["lo"] - u["at"], count) + at, "span": none, "aoff": none}


def slices_of(it: Iterator[pa.RecordBatch], rules: Rules):
    """(documents, tags, first row, bytes, element values, units) of each slice of the batches."""
    for batch in it:
        doc, tag = T.longs(batch.column(0)), T.longs(batch.column(1))
        for lo, _hi, buf, offs in T.text_slices(batch.column(2)):
            values, first = elements(buf, offs, rules.words)
            yield doc, tag, lo, buf, values, find_units(values, first, rules)


def hash_counts(rules: Rules, parts: int, hot=None):
    """Documents to packed rows by part: anchors with their numbers of units and of different ones; with `hot`, the same of hot anchors' windows."""

    def flush(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        a, u = (np.concatenate(x) for x in zip(*held, strict=True))
        o = np.lexsort((u, a))
        a, u = a[o], u[o]
        new = np.append(True, a[1:] != a[:-1])
        head = np.flatnonzero(new)
        distinct = np.add.reduceat((new | np.append(True, u[1:] != u[:-1])).astype(np.int64), head)
        many = np.diff(np.append(head, len(a)))
        columns = [a[head], np.minimum(many, 255).astype(np.uint8), distinct.astype(np.uint32)]
        yield from batches([(p, "hash", T.pack(*x)) for p, x in by_part(part_of(a[head], parts), columns, parts)])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for _, _, _, _, values, u in slices_of(it, rules):
            if hot is not None:
                some = np.isin(u["anchor"], hot.value)
                u = window_units({k: v[some] for k, v in u.items()}, values, rules.window)
            held.append((u["anchor"], u["unit"]))
            n += len(u["unit"])
            if n >= FLUSH_UNITS:
                yield from flush(held)
                held, n = [], 0
        if n:
            yield from flush(held)

    return run


def repeated_hashes(most: int):
    """Packed counts by part to the hashes that occur twice or more and, of those, the ones with over `most` different units."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, kinds in gathered(it).items():
            a, many, distinct = T.unpack_all(kinds.pop("hash"))
            o = np.argsort(a, kind="stable")
            head = np.flatnonzero(np.append(True, a[o[1:]] != a[o[:-1]]))
            many, distinct = np.add.reduceat(many[o].astype(np.int64), head), np.add.reduceat(distinct[o].astype(np.int64), head)
            a = a[o[head]]
            rows = [(part, "repeated", T.pack(a[many > 1]))] if (many > 1).any() else []
            if (distinct > most).any():
                rows.append((part, "hot", T.pack(a[distinct > most])))
            yield from batches(rows)

    return run


def contents(rules: Rules, parts: int, bits: int, marks, hot=None, window_marks=None):
    """Documents to packed units of repeated anchors with their content, by anchor, and covers of what repeats within the task."""

    def flush(found: list[dict[str, np.ndarray]], raw: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        c = {k: np.concatenate([f[k] for f in found]) for k in COLUMNS}
        content = np.concatenate(raw)
        lens = c["span"].astype(np.int64) + rules.window
        at = np.cumsum(lens) - lens
        keep, dup = settle(c, content, at, lens, rules.within_document)
        rows = cover_rows(c["doc"][dup], c["tag"][dup], c["lo"][dup], c["lo"][dup] + lens[dup], parts) if dup.any() else []
        for p, (i,) in by_part(part_of(c["anchor"][keep], parts), [np.flatnonzero(keep)], parts):
            rows.append((p, "text", T.pack(*[c[k][i] for k in COLUMNS], content[T.ragged(at[i], lens[i])])))
        yield from batches(rows)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, raw, held = [], [], 0
        for doc, tag, base, buf, values, u in slices_of(it, rules):
            hit = in_bitmap(marks.value, bits, u["anchor"])
            some = [hit]
            if hot is not None:
                is_hot = hit & np.isin(u["anchor"], hot.value)
                windows = window_units({k: v[is_hot] for k, v in u.items()}, values, rules.window)
                again = in_bitmap(window_marks.value, bits, windows["unit"])
                some = [hit & ~is_hot, again]
            for units, pick in zip((u, windows) if hot is not None else (u,), some, strict=True):
                own = {k: v[pick] for k, v in units.items()}
                row = own["row"] + base
                found.append({"anchor": own["anchor"], "unit": own["unit"], "doc": doc[row], "tag": tag[row], "lo": own["lo"].astype(np.int64), "span": own["span"].astype(np.uint16), "aoff": own["aoff"].astype(np.uint16)})
                raw.append((values if rules.words else buf)[T.ragged(own["at"], own["span"] + rules.window)])
                held += raw[-1].nbytes + 40 * len(row)
                if held >= FLUSH_BYTES:
                    yield from flush(found, raw)
                    found, raw, held = [], [], 0
        if held:
            yield from flush(found, raw)

    return run


def gathered(it: Iterator[pa.RecordBatch]) -> dict[int, dict[str, list[bytes]]]:
    """The packed rows of a Spark partition: by part, then by kind."""
    out: dict[int, dict[str, list[bytes]]] = {}
    for batch in it:
        for part, kind, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            out.setdefault(part, {}).setdefault(kind, []).append(data)
    return out


def resolve_parts(rules: Rules, parts: int, resolve: Callable):
    """Contents by anchor to covers; resolve(columns, contents, starts of contents) gives (doc, tag, start, end)."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, kinds in gathered(it).items():
            yield from batches([(part, "cover", x) for x in kinds.pop("cover", [])])
            if "text" not in kinds:
                continue
            *cols, content = T.unpack_all(kinds.pop("text"))
            c = dict(zip(COLUMNS, cols, strict=True))
            lens = c["span"].astype(np.int64) + rules.window
            at = np.cumsum(lens) - lens
            order = np.lexsort((c["span"], c["lo"], c["tag"], c["doc"], c["anchor"]))
            same = np.ones(len(order), bool)  # the same place, of a row that is there again
            for k in ("anchor", "doc", "tag", "lo"):
                same[1:] &= c[k][order[1:]] == c[k][order[:-1]]
            same[:1] = False
            order = order[~same]
            heads = np.flatnonzero(np.append(True, np.diff(c["anchor"][order]) != 0))
            sizes = np.diff(np.append(heads, len(order)))
            heads, sizes = heads[sizes > 1], sizes[sizes > 1]  # an anchor with one place has come by a chance hit
            cuts, done = [0], 0
            for i, total in enumerate(np.cumsum(sizes).tolist()):  # whole anchors, some thousand units at a time
                if total - done >= 8192:
                    cuts.append(i + 1)
                    done = total
            for lo, hi in zip(cuts, [*cuts[1:], len(heads)], strict=True):
                if lo == hi:
                    continue
                i = order[T.ragged(heads[lo:hi], sizes[lo:hi])]
                doc, tag, start, end = resolve({k: v[i] for k, v in c.items()}, content, at[i])
                if len(doc):
                    yield from batches(cover_rows(doc, tag, start, end, parts))

    return run


def join_covers(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Covers by document part to one row (doc, tag, spans) per document; spans holds starts and ends in turn."""
    schema = pa.schema([("doc", pa.int64()), ("tag", pa.int64()), ("spans", pa.binary())])
    for kinds in gathered(it).values():
        doc, tag, start, end = T.unpack_all(kinds["cover"])
        (doc, tag), start, end = T.merge_runs([doc, tag], start, end)
        head = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])))
        pairs = np.column_stack((start, end))
        for i in range(0, len(head), 4096):
            h = head[i : i + 4096]
            cuts = [pairs[a:b].tobytes() for a, b in zip(h, np.append(head, len(doc))[i + 1 : i + 1 + len(h)], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(doc[h]), pa.array(tag[h]), pa.array(cuts, pa.binary())], schema=schema)


def repeated_spans(docs: DataFrame, rules: Rules, resolve: Callable, part_bytes: int, name: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """Documents with their repeated ranges: doc_id, text, spans (int64 starts and ends in turn; null if none), row."""
    spark = docs.sparkSession
    scratch = Scratch(spark, name)
    docs = keyed(docs, carry)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // part_bytes))
    bits = min(MOST_BITS, max(20, int(total // 8).bit_length()))
    source = docs.select("doc", "tag", "text")

    def stage(run, then) -> DataFrame:
        """Documents through `run`, dealt by part, through `then`."""
        return scratch.save(source.mapInArrow(T.lean(run), ROWS_DDL).repartitionById(parts, F.col("part")).mapInArrow(T.lean(then), ROWS_DDL))

    def marked(rows: DataFrame):
        """A broadcast bitmap of the repeated hashes."""
        return spark.sparkContext.broadcast(bitmap(rows.where("kind = 'repeated'").select("data"), bits))

    most = max(HOT_UNITS, total // HOT_ANCHORS)  # there are fewer units than bytes, so fewer than HOT_ANCHORS of such anchors
    counted = stage(hash_counts(rules, parts), repeated_hashes(most))
    marks, hot, window_marks = marked(counted), None, None
    held = [marks]
    found = [T.unpack(r[0])[0] for r in counted.where("kind = 'hot'").select("data").toLocalIterator()]
    if found:
        hot = spark.sparkContext.broadcast(np.concatenate(found))
        windows = stage(hash_counts(rules, parts, hot), repeated_hashes(total + 1))
        window_marks = marked(windows)
        held += [hot, window_marks]
        scratch.drop(windows)
    covers = stage(contents(rules, parts, bits, marks, hot, window_marks), resolve_parts(rules, parts, resolve))
    spans = scratch.save(covers.repartitionById(parts, F.col("part")).mapInArrow(T.lean(join_covers), "doc long, tag long, spans binary"))
    for x in held:
        x.destroy()
    scratch.drop(counted)
    scratch.drop(covers)
    return docs.join(spans.hint("shuffle_hash"), ["doc", "tag"], "left").select("doc_id", "text", "spans", "row")
