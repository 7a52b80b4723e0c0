"""Removing word passages that start in an earlier document, by relative Lempel-Ziv parsing.

A part's candidate passages (see repeats.py) are a reference block, indexed by a suffix array over their words. Each
passage is factored greedily against the passages of smaller documents in the block: every factor is the longest such
match at its place. Factors of a window or more are duplicate spans; windows that straddle a factor boundary are checked
against the index too, since a match may begin inside one factor and end inside the next.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from millrace.llm import repeats
from millrace.llm import textops as T


def suffix_ranks(ids: np.ndarray, depth: int) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... elements, to `depth` or until no two are equal.

    ids must end in a unique value, and no equal runs may reach the end.
    """
    n = len(ids)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    levels, h = [rank], 1
    while h < depth:
        after = np.zeros(n, np.int64)
        after[: n - h] = rank[h:] + 1
        key = rank * (n + 1) + after
        o = np.argsort(key)
        step = np.zeros(n, np.int64)
        step[1:] = key[o[1:]] != key[o[:-1]]
        rank = np.empty(n, np.int64)
        rank[o] = np.cumsum(step)
        levels.append(rank)
        h *= 2
        if rank[o[-1]] == n - 1:
            break
    return levels


def neighbour_prefixes(levels: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    """Common-prefix length of each suffix and the one before it in the order; 0 for the first."""
    n = len(order)
    a, b = order[:-1].copy(), order[1:].copy()
    out = np.zeros(n - 1, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        padded = np.append(levels[k], -1)
        same = padded[np.minimum(a, n)] == padded[np.minimum(b, n)]
        step = np.where(same, 1 << k, 0)
        a, b, out = a + step, b + step, out + step
    return np.append(0, out)


def longest_earlier(order: np.ndarray, lcp: np.ndarray, doc: np.ndarray, least: int) -> np.ndarray:
    """For each suffix the longest match with a suffix of a smaller document; matches below `least` count as 0."""
    out = np.zeros(len(order), np.int64)
    linked = lcp >= least
    inside = linked | np.append(linked[1:], False)  # suffixes with a neighbour that is near enough
    pos = np.flatnonzero(inside)
    if not len(pos):
        return out
    docs = doc[order[pos]].tolist()
    near = np.where(linked[pos], lcp[pos], 0).tolist()
    best = [0] * len(pos)
    for forward in (True, False):
        stack: list[tuple[int, int]] = []  # (document, least prefix from here to the entry below), documents rising
        steps = range(len(pos)) if forward else range(len(pos) - 1, -1, -1)
        link = 0
        for i in steps:
            if forward:
                link = near[i]
            if link == 0:
                stack.clear()
            d, low = docs[i], link
            while stack and stack[-1][0] >= d:
                low = min(low, stack.pop()[1])
            if stack and low > best[i]:
                best[i] = low
            stack.append((d, low))
            if not forward:
                link = near[i]
    out[order[pos]] = best
    return out


def factors(start: int, end: int, match: np.ndarray) -> list[tuple[int, int]]:
    """Greedy parse of [start, end): (place, length) of each factor; a literal has length 1."""
    out, p = [], start
    while p < end:
        n = max(1, int(match[p]))
        out.append((p, n))
        p += n
    return out


def resolver(window: int, gram: int):
    def parsed(doc: np.ndarray, lens: np.ndarray, content: np.ndarray, at: np.ndarray) -> dict[int, list[tuple[int, int]]]:
        """Duplicate spans of passages of different contents, sorted by document, against those of smaller documents."""
        ends = np.cumsum(lens + 1) - 1  # where each passage's own separator stands
        starts = ends - lens
        block = np.empty(int(ends[-1]) + 1, np.int64)
        _, words = np.unique(content[T.ragged(at, lens)], return_inverse=True)
        inside = np.ones(len(block), bool)
        inside[ends] = False
        block[inside] = words
        block[ends] = len(words) + np.arange(len(ends))
        of = np.repeat(np.arange(len(ends)), lens + 1)
        levels = suffix_ranks(block, 2 * int(lens.max()))
        order = np.argsort(levels[-1], kind="stable")
        match = longest_earlier(order, neighbour_prefixes(levels, order), doc[of], gram)
        long = match >= window
        out = {}
        for r in np.unique(of[long]).tolist():
            parse = factors(int(starts[r]), int(ends[r]), match)
            spans = [(p, p + n) for p, n in parse if n >= window]
            covered = np.zeros(int(lens[r]), bool)  # starts whose window lies within a long factor
            for p, e in spans:
                covered[p - starts[r] : e - window + 1 - starts[r]] = True
            straddling = np.flatnonzero(long[starts[r] : ends[r]] & ~covered) + starts[r]
            spans += [(int(p), int(p + match[p])) for p in straddling]
            out[r] = [(p - int(starts[r]), e - int(starts[r])) for p, e in spans]
        return out

    def resolve(c: dict[str, np.ndarray], content: np.ndarray, at: np.ndarray):
        o = np.lexsort((c["lo"], c["tag"], c["doc"]))
        anchor, doc, tag, lo, at = c["anchor"][o], c["doc"][o], c["tag"][o], c["lo"][o], at[o]
        lens = c["span"][o].astype(np.int64) + window
        # a passage equal to an earlier one is a single factor of the block; only passages of new content have to be parsed
        seen: dict[tuple[int, bytes], int] = {}
        first = np.array([seen.setdefault((x, content[s : s + n].tobytes()), i) for i, (x, s, n) in enumerate(zip(anchor.tolist(), at.tolist(), lens.tolist(), strict=True))])
        whole = np.flatnonzero(doc > doc[first])
        who, start, end = [whole], [np.zeros(len(whole), np.int64)], [lens[whole]]
        new = np.flatnonzero(first == np.arange(len(first)))
        _, place, many = np.unique(anchor[new], return_inverse=True, return_counts=True)
        new = new[many[place] > 1]  # an anchor of one content has nothing else to be parsed against
        if len(new):
            spans = parsed(doc[new], lens[new], content, at[new])
            same = {int(new[r]): x for r, x in spans.items()}
            for i in np.flatnonzero((doc == doc[first]) & np.isin(first, list(same))).tolist():  # also copies within the document
                own = same[int(first[i])]
                who.append(np.full(len(own), i))
                start.append(np.array([p for p, _ in own], np.int64))
                end.append(np.array([e for _, e in own], np.int64))
        who = np.concatenate(who)
        return doc[who], tag[who], lo[who] + np.concatenate(start), lo[who] + np.concatenate(end)

    return resolve


def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pair = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in it:
        offs, data = T.strings(batch.column(1))
        held = batch.column(2).to_pylist()
        for lo, hi in T.slices(offs, 4 << 20):
            kept, sizes, spans = [], [], []
            for i in range(lo, hi):
                words = data[offs[i] : offs[i + 1]].tobytes().split()
                runs = np.frombuffer(held[i] or b"", np.int64).reshape(-1, 2).tolist()
                sizes.append(len(words))
                spans.append([{"start": s, "end": e} for s, e in runs])
                for s, e in reversed(runs):
                    del words[s:e]
                kept.append(b" ".join(words))
            text = pa.array(kept, pa.binary()).cast(pa.string())
            columns = [batch.column(0).slice(lo, hi - lo), text, pa.array(sizes, pa.int64()), pa.array(spans, pair), batch.column(3).slice(lo, hi - lo)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "kept", "n_words", "spans", "row"])


def substring_dedup(docs: DataFrame, min_words: int = 50, gram: int = 8, part_bytes: int = 16 << 20, carry: tuple[str, ...] = ()) -> DataFrame:
    """Remove every word that a run of `min_words` words covers which also starts in a document with a smaller doc_id.

    Words are runs of anything but space and \\t to \\r, unchanged; runs are judged on the input. Returns per row of docs:
    doc_id, kept (the remaining words, joined by one space), n_words (of the input) and spans (removed runs, in words).

    Null and empty texts have no words. Texts of fewer words stay whole. A null doc_id counts as the largest. Rows that
    repeat doc_id and text are one document and get equal results; rows with one doc_id and different texts are of equal
    rank, so neither removes words of the other. Other columns are ignored. An empty table gives no rows.
    part_bytes: text whose candidates one task resolves; raise it with executor memory. carry: columns of docs to hand on, as
    the struct `row`.
    """
    gram = min(gram, min_words)
    rules = repeats.Rules(words=True, window=min_words, gram=gram, within_document=False)
    spans = repeats.repeated_spans(docs, rules, resolver(min_words, gram), part_bytes, "substring_dedup", carry)
    pair = StructType().add("start", "long").add("end", "long")
    schema = StructType().add("doc_id", "long").add("kept", "string").add("n_words", "long").add("spans", ArrayType(pair)).add("row", spans.schema["row"].dataType)
    out = spans.mapInArrow(T.lean(cut), schema)
    return out if carry else out.drop("row")


def op8(spark, sf_dir: str) -> DataFrame:
    out = substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))
