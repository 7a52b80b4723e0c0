"""Removing byte strings that start earlier in the corpus, by an enhanced suffix array.

The suffixes are those that start at anchors (see repeats.py). A part's suffixes are sorted, their common-prefix
lengths scanned with a stack into the interval tree, and each interval's left extensions are compared the same way:
an interval whose left extensions differ is a maximal repeat, which is reported with all its occurrences. All but
the first occurrence are removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import repeats
from millrace.llm import textops as T


def lcp_intervals(lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """(depth, first, last) of each interval of a common-prefix array; lcp[i] is that of suffixes i - 1 and i, lcp[0] is 0.

    Intervals come out children first. Depth 0 is left out.
    """
    stack = [(0, 0)]  # depth, first
    for i in range(1, len(lcp) + 1):
        here = lcp[i] if i < len(lcp) else 0
        first = i - 1
        while stack[-1][0] > here:
            depth, first = stack.pop()
            yield depth, first, i - 1
        if here > stack[-1][0]:
            stack.append((here, first))


def common(a: int, b: int, bits: int) -> int:
    """Equal leading bytes of two numbers of `bits` bits."""
    return (bits - (a ^ b).bit_length()) >> 3


def maximal_repeats(anchor: np.ndarray, rank: np.ndarray, left: list[bytes], right: list[bytes], least: int) -> Iterator[tuple[int, int, list[int]]]:
    """(bytes to the left of the anchor, bytes from it on, occurrences) of each maximal repeat of `least` bytes or more.

    left holds the bytes before each anchor, nearest first; right those from the anchor on. Occurrences are sorted by
    rank. A repeat that is longer than what left or right hold is reported with the part they hold.
    """
    n = len(anchor)
    width = max(map(len, right), default=0)
    order = sorted(range(n), key=lambda i: (int(anchor[i]), right[i]))
    bits_r, bits_l = 8 * width, 8 * max(map(len, left), default=0)
    nums_r = [int.from_bytes(x.ljust(width, b"\0"), "big") for x in right]
    nums_l = [int.from_bytes(x.ljust(bits_l // 8, b"\0"), "big") for x in left]
    size_l = [len(x) for x in left]
    lcp = [0] * n
    for i in range(1, n):
        a, b = order[i - 1], order[i]
        if anchor[a] == anchor[b]:
            lcp[i] = min(common(nums_r[a], nums_r[b], bits_r), len(right[a]), len(right[b]))
    by_rank = rank.tolist()
    for depth, lo, hi in lcp_intervals(lcp):
        need = least - depth
        if hi - lo == 1:
            a, b = order[lo], order[hi]
            both = min(common(nums_l[a], nums_l[b], bits_l), size_l[a], size_l[b])
            if both >= need:
                yield both, depth, [a, b] if by_rank[a] < by_rank[b] else [b, a]
            continue
        members = [m for m in order[lo : hi + 1] if size_l[m] >= need]
        if len(members) < 2:
            continue
        members.sort(key=left.__getitem__)
        ext = [0] + [min(common(nums_l[a], nums_l[b], bits_l), size_l[a], size_l[b]) for a, b in zip(members, members[1:])]
        if need <= 0 and min(ext[1:]) == 0:  # the left extensions differ at once
            yield 0, depth, sorted(members, key=by_rank.__getitem__)
        for both, i, j in lcp_intervals(ext):
            if both >= need:
                yield both, depth, sorted(members[i : j + 1], key=by_rank.__getitem__)


def resolver(window: int):
    def resolve(c: dict[str, np.ndarray], content: np.ndarray, at: np.ndarray):
        raw = content.tobytes()
        a = c["aoff"].astype(np.int64)
        first, last = a - c["span"].astype(np.int64), a  # distances from a window's start to the anchor
        ends = at + c["span"].astype(np.int64) + window
        left = [raw[s : s + x][::-1] for s, x in zip(at.tolist(), a.tolist(), strict=True)]
        right = [raw[s + x : e] for s, x, e in zip(at.tolist(), a.tolist(), ends.tolist(), strict=True)]
        rank = np.empty(len(at), np.int64)
        rank[np.lexsort((c["lo"], c["tag"], c["doc"]))] = np.arange(len(at))
        lows, highs = first.tolist(), last.tolist()
        marks = [0] * len(at)  # bit x: the window that starts x bytes before the anchor has occurred earlier
        docs, tags = c["doc"].tolist(), c["tag"].tolist()
        for before, after, members in maximal_repeats(c["anchor"], rank, left, right, window):
            near = max(window - after, 0)
            bits = (1 << (before + 1)) - (1 << near)
            earliest, own = docs[members[0]], set()
            for m in members:
                if docs[m] == earliest and tags[m] not in own:  # the first in its document, and no document is earlier
                    own.add(tags[m])
                else:
                    marks[m] |= bits
        who, start, end = [], [], []
        place = (c["lo"] + a).tolist()
        for m in np.flatnonzero([x > 0 for x in marks]).tolist():
            bits = marks[m] >> lows[m] << lows[m] & ((1 << (highs[m] + 1)) - 1)
            while bits:
                near = (bits & -bits).bit_length() - 1
                run = bits >> near
                far = near + (~run & (run + 1)).bit_length() - 2
                who.append(m)
                start.append(place[m] - far)
                end.append(place[m] - near + window)
                bits = bits >> (far + 1) << (far + 1)
        who = np.array(who, np.int64)
        return c["doc"][who], c["tag"][who], np.array(start, np.int64), np.array(end, np.int64)

    return resolve


def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("kept", pa.binary()), ("n_bytes", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
    for batch in it:
        offs, data = T.strings(batch.column(1))
        held = batch.column(2).to_pylist()
        for lo, hi in T.slices(offs, 8 << 20):
            kept, spans = [], []
            for i in range(lo, hi):
                text = data[offs[i] : offs[i + 1]].tobytes()
                runs = np.frombuffer(held[i] or b"", np.int64).reshape(-1, 2).tolist()
                spans.append([{"start": s, "end": e} for s, e in runs])
                edges = [0, *(x for run in runs for x in run), len(text)]
                kept.append(b"".join(text[s:e] for s, e in zip(edges[::2], edges[1::2], strict=True)) if runs else text)
            sizes = pa.array(np.diff(offs)[lo:hi])
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(kept, pa.binary()), sizes, pa.array(spans, schema.types[3])], schema=schema)


def suffix_array_dedup(docs: DataFrame, min_bytes: int = 100, gram: int = 24, part_bytes: int = 16 << 20) -> DataFrame:
    """Remove every byte that a string of `min_bytes` bytes covers which also starts earlier in the corpus.

    Earlier is a smaller doc_id, or the same document and an earlier start; matches never cross documents; strings are
    judged on the input. Returns per row of docs: doc_id, kept (binary, the remaining bytes), n_bytes (of the input) and
    spans (maximal removed runs, as byte offsets).

    Null and empty texts have no bytes and keep none. Texts shorter than min_bytes stay whole. A null doc_id comes last.
    Rows that repeat doc_id and text are one document and get equal results; rows with one doc_id and different texts are of
    equal rank, so neither removes bytes of the other. Other columns are ignored, whatever their names. An empty table gives no rows.
    part_bytes: text whose candidates one task resolves; raise it with executor memory.
    """
    rules = repeats.Rules(words=False, window=min_bytes, gram=min(gram, min_bytes), within_document=True)
    spans = repeats.repeated_spans(docs, rules, resolver(min_bytes), part_bytes, "suffix_array_dedup")
    return spans.mapInArrow(T.lean(cut), "doc_id long, kept binary, n_bytes long, spans array<struct<start:long,end:long>>")


def op1(spark, sf_dir: str) -> DataFrame:
    out = suffix_array_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
