"""Finding benchmark passages in training text with a generalised suffix automaton.

The automaton holds every run of words of the items of one block. Document words are streamed through it; the length of
the longest match that ends at each word shows which windows occur there. A document's words reach the automaton only in
runs whose every word, and every pair of neighbours, occurs in some item: anywhere else the match is shorter than two.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from millrace.llm import textops as T
from millrace.llm.scratch import Scratch

U = np.uint64


class SuffixAutomaton:
    """Of several sequences; link, length and the sequences that hold each state's words."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.last = 0

    def _new(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, p: int, symbol: int, q: int) -> int:
        clone = self._new(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = clone
            p = self.link[p]
        return clone

    def extend(self, symbol: int) -> int:
        p = self.last
        q = self.next[p].get(symbol)
        if q is not None:  # an earlier sequence went on in the same way
            self.last = q if self.length[q] == self.length[p] + 1 else self._split(p, symbol, q)
            return self.last
        new = self._new(self.length[p] + 1, 0, {})
        while p >= 0 and symbol not in self.next[p]:
            self.next[p][symbol] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][symbol]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, symbol, q)
        self.last = new
        return new

    def add(self, sequence: list[int]) -> None:
        self.last = 0
        for symbol in sequence:
            self.extend(symbol)

    def step(self, state: int, length: int, symbol: int) -> tuple[int, int]:
        """State and length of the longest match after one more symbol."""
        while state and symbol not in self.next[state]:
            state = self.link[state]
            length = self.length[state]
        to = self.next[state].get(symbol)
        return (to, length + 1) if to is not None else (0, 0)


class ItemMatcher:
    """Windows of `window` words of the items; an item of fewer words, but not none, is one window."""

    def __init__(self, items: list[tuple[str | None, list[int]]], window: int):
        self.window = window
        items = [(name, words) for name, words in items if words]
        self.auto = auto = SuffixAutomaton()
        for _, words in items:
            auto.add(words)
        n = len(auto.link)
        self.names: list[set[str]] = [set() for _ in range(n)]  # items that hold a state's words, from `window` words on
        short: list[list[tuple[int, str | None]]] = [[] for _ in range(n)]
        for name, words in items:
            state, length = 0, 0
            seen: set[int] = set()
            for w in words:
                state, length = auto.step(state, length, w)
                v = state
                while auto.length[v] >= window and v not in seen:
                    seen.add(v)
                    if name is not None:
                        self.names[v].add(name)
                    v = auto.link[v]
            if len(words) < window:
                short[state].append((len(words), name))
        self.short, self.short_link = short, [0] * n  # whole items at a state; the next state along the links that has some
        for v in sorted(range(1, n), key=auto.length.__getitem__):
            up = auto.link[v]
            self.short_link[v] = up if short[up] else self.short_link[up]
        self.least = min((min(len(words), window) for _, words in items), default=0)
        flat = np.array([w for _, words in items for w in words], np.uint64)
        pairs = [pair_hash(np.array(words, np.uint64)) for _, words in items]
        self.vocabulary = np.unique(flat)
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.uint64)

    def flat(self) -> FlatMatcher:
        """The same in arrays, some tens of bytes for each word of the items."""
        auto, words = self.auto, len(self.vocabulary)
        source = np.repeat(np.arange(len(auto.next)), [len(e) for e in auto.next])
        symbol = np.searchsorted(self.vocabulary, np.fromiter((w for e in auto.next for w in e), np.uint64, len(source)))
        key, to = source * max(words, 1) + symbol, np.fromiter((q for e in auto.next for q in e.values()), np.int64, len(source))
        order = np.argsort(key)
        listed = sorted(set().union(*self.names, *({n for _, n in x} for x in self.short)) - {None})
        number = {name: i for i, name in enumerate(listed)}

        def lists(rows: list, value: Callable) -> tuple[np.ndarray, np.ndarray]:
            ends = np.cumsum([0, *(len(x) for x in rows)])
            return ends.astype(np.int32), np.array([value(y) for x in rows for y in x], np.int32)

        return FlatMatcher(
            window=self.window, least=self.least, vocabulary=self.vocabulary, pairs=self.pairs, listed=listed, key=key[order], to=to[order].astype(np.int32),
            link=np.array(auto.link, np.int32), short_link=np.array(self.short_link, np.int32), length=np.array(auto.length, np.int32), names=lists([sorted(x) for x in self.names], number.__getitem__),
            short_size=lists(self.short, lambda x: x[0]), short_name=lists(self.short, lambda x: number.get(x[1], -1)),
        )


class FlatMatcher:
    """An ItemMatcher as arrays, for broadcasts."""

    def __init__(self, **parts):
        self.__dict__.update(parts)

    def runs(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Runs [start, end) of a slice's words, each in one document, that may hold a window."""
        known = member(words, self.vocabulary)
        linked = np.zeros(len(words), bool)  # with the word before
        if len(words) > 1:
            linked[1:] = known[1:] & known[:-1]
            at = np.flatnonzero(linked[1:])
            linked[1:][at] = member(pair_hash(words)[at], self.pairs)
        linked[first[:-1][first[:-1] < len(words)]] = False
        head = np.flatnonzero(known & ~linked)
        tail = np.flatnonzero(known & ~np.append(linked[1:], False)) + 1
        enough = tail - head >= max(1, self.least)
        return head[enough], tail[enough]

    def match(self, words: list[int]) -> tuple[list[tuple[int, int]], set[str]]:
        """Window occurrences [start, end) in a run of words of the vocabulary, and the items they are of."""
        window, spans, found = self.window, [], set()
        state = length = 0
        ends, items = self.names
        short, sizes, names = *self.short_size, self.short_name[1]
        base = max(len(self.vocabulary), 1)
        for i, symbol in enumerate(np.searchsorted(self.vocabulary, words).tolist()):
            while True:  # the longest match that ends with this word
                key = state * base + symbol
                at = int(np.searchsorted(self.key, key))
                if at < len(self.key) and self.key[at] == key:
                    state, length = int(self.to[at]), length + 1
                    break
                if not state:
                    length = 0
                    break
                state = int(self.link[state])
                length = int(self.length[state])
            if length >= window:
                spans.append((i + 1 - window, i + 1))
                v = state
                while self.length[self.link[v]] >= window:
                    v = self.link[v]
                found.update(items[ends[v] : ends[v + 1]].tolist())
            v = state
            while v > 0:  # whole items of fewer words, here and at the suffixes
                for k in range(short[v], short[v + 1]):
                    if sizes[k] <= length:
                        spans.append((i + 1 - int(sizes[k]), i + 1))
                        if names[k] >= 0:
                            found.add(int(names[k]))
                v = self.short_link[v]
        return spans, {self.listed[x] for x in found}


def pair_hash(words: np.ndarray) -> np.ndarray:
    return T.mix(words[:-1] * U(3) + T.mix(words[1:]))


def member(x: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set) or not len(x):
        return np.zeros(len(x), bool)
    bits = 20  # a small table first
    table = np.zeros(1 << bits, bool)
    table[(sorted_set >> U(64 - bits)).astype(np.int64)] = True
    maybe = np.flatnonzero(table[(x >> U(64 - bits)).astype(np.int64)])
    out = np.zeros(len(x), bool)
    out[maybe] = sorted_set[np.minimum(np.searchsorted(sorted_set, x[maybe]), len(sorted_set) - 1)] == x[maybe]
    return out


def tokens(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the lower-cased alphanumeric words of a slice, and each document's first."""
    starts, ends, first = T.word_bounds(buf, offs, T.IS_ALNUM)
    return T.word_hashes(T.LOWER[buf], starts, ends), starts, ends, first


def item_words(texts: list[str | None]) -> list[list[int]]:
    offs, data = T.strings(pa.array(texts, pa.string()))
    words, _, _, first = tokens(data[offs[0] : offs[-1]], offs - offs[0])
    return [words[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]


def matching(blocks: list, last: bool):
    """Documents (doc_id, text, hits, items, row) with the hits and items of some blocks of items added.

    The last such pass gives the texts without the words that were hit, the number of words, and the hits as spans and as a count.
    """
    pair = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            counts = np.zeros(batch.num_rows, np.int64)
            hits = [np.frombuffer(x or b"", np.int64).reshape(-1, 2).tolist() for x in batch.column(2).to_pylist()]
            items = [set(x or ()) for x in batch.column(3).to_pylist()]
            for lo, hi, buf, offs in T.text_slices(batch.column(1)):
                words, _, _, first = tokens(buf, offs)
                counts[lo:hi] = np.diff(first)
                for block in blocks:
                    matcher = block.value
                    head, tail = matcher.runs(words, first)
                    rows = np.searchsorted(first, head, "right") - 1
                    for h, t, row in zip(head.tolist(), tail.tolist(), rows.tolist(), strict=True):
                        spans, names = matcher.match(words[h:t])
                        hits[lo + row] += [[h + s - int(first[row]), h + e - int(first[row])] for s, e in spans]
                        items[lo + row] |= names
            merged = []
            for x in hits:
                a = np.array(x, np.int64).reshape(-1, 2)
                _, s, e = T.merge_runs([np.zeros(len(a), np.int64)], a[:, 0], a[:, 1])
                merged.append(np.column_stack((s, e)))
            named = pa.array([sorted(x) for x in items], pa.list_(pa.string()))
            if not last:
                columns = [batch.column(0), batch.column(1), pa.array([x.tobytes() for x in merged], pa.binary()), named, batch.column(4)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text", "hits", "items", "row"])
                continue
            n_hit = pa.array([int((x[:, 1] - x[:, 0]).sum()) for x in merged], pa.int64())
            runs = pa.array([[{"start": s, "end": e} for s, e in x.tolist()] for x in merged], pair)
            columns = [batch.column(0), without(batch.column(1), merged), pa.array(counts), n_hit, runs, named, batch.column(4)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "kept", "n_words", "n_hit", "spans", "items", "row"])

    return run


def without(texts: pa.Array, spans: list[np.ndarray]) -> pa.Array:
    """Texts without the words of some spans."""
    hit = [i for i, x in enumerate(spans) if len(x)]
    if hit:
        out = texts.to_pylist()
        for i in hit:
            raw = np.frombuffer(out[i].encode(), np.uint8)
            starts, ends, _ = T.word_bounds(raw, np.array([0, len(raw)]), T.IS_ALNUM)
            edges = [0, *np.column_stack((starts[spans[i][:, 0]], ends[spans[i][:, 1] - 1])).ravel().tolist(), len(raw)]
            out[i] = b"".join(raw[s:e].tobytes() for s, e in zip(edges[::2], edges[1::2], strict=True)).decode()
        texts = pa.array(out, pa.string())
    return texts.cast(pa.string())


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20, block_bytes: int = 1 << 20, blocks_each: int = 16, carry: tuple[str, ...] = ()) -> DataFrame:
    """Find and cut out what the texts of docs share with the items of benchmark (item_id, text).

    Words are runs of ASCII letters and digits and non-ASCII characters, A-Z lower-cased. A window is `window` consecutive
    words of an item, or a shorter item's whole words; a document word inside an occurrence of one is hit. Returns per row
    of docs: doc_id, kept (the text without hit words), n_words, n_hit, spans (hit runs, in words), items (ids of the items
    whose windows occur, as strings, sorted) and contaminated (n_hit > 0 and share * n_hit >= n_words).

    Null texts have no words, in documents and items; a null item_id hits but is not listed; items that repeat an id count
    once. Rows are judged one by one, so repeated rows get equal results. Other columns are ignored. An empty benchmark
    hits nothing; empty docs give no rows. Items are collected in blocks of about block_bytes of text (or one longer item); each
    block's automaton is built once, on the driver, and broadcast as arrays of some tens of bytes a word. A pass over docs takes
    blocks_each blocks, between passes the documents are written, so a larger benchmark means more passes, not more memory.
    carry: columns of docs to hand on, as the struct `row`.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    out = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.lit(None).cast("binary").alias("hits"),
        F.array().cast("array<string>").alias("items"),
        F.struct(*(carry or ["doc_id"])).alias("row"),
    )
    row = out.schema["row"].dataType
    pair = StructType().add("start", "long").add("end", "long")
    found = StructType().add("doc_id", "long").add("text", "string").add("hits", "binary").add("items", ArrayType(StringType())).add("row", row)
    final = StructType().add("doc_id", "long").add("kept", "string").add("n_words", "long").add("n_hit", "long").add("spans", ArrayType(pair)).add("items", ArrayType(StringType())).add("row", row)
    scratch, before = Scratch(spark, "decontamination"), None
    for start in range(0, blocks, blocks_each):
        held, last = [], start + blocks_each >= blocks
        for b in range(start, min(start + blocks_each, blocks)):  # one block after another on the driver
            rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
            words = item_words([r[1] for r in rows])
            held.append(spark.sparkContext.broadcast(ItemMatcher(list(zip([r[0] for r in rows], words, strict=True)), window).flat()))
        out = out.mapInArrow(T.lean(matching(held, last)), final if last else found)
        if not last:
            out = scratch.save(out)
            for x in held:
                x.destroy()
            if before is not None:
                scratch.drop(before)
            before = out
    if not carry:
        out = out.drop("row")
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))


def op2(spark, sf_dir: str) -> DataFrame:
    out = decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )
