"""Byte-level BPE encoding and decoding with a minimal acyclic transducer of frequent words.

The corpus's most frequent pieces (words as the tokenizer cuts texts) are compiled into an automaton whose states are shared by equal
suffixes. Its arcs carry numbers that add up to a word's place in the lexicon, and that place has the word's token ids. The
arrays are one file in the folder that all executors share; every executor fetches it and its workers map it into memory. Pieces that
the automaton does not accept are merged pair by pair, lowest rank first, so the ids do not depend on the lexicon.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import textops as T
from millrace.llm.scratch import Scratch, shared_dir

U = np.uint64
LETTER, NUMBER, OTHER, SPACE, SPECIAL = range(5)
#: Pieces of at most so many symbols are merged by scanning, longer ones with a heap.
SHORT = 48
#: Entries of the tables that a worker keeps of pieces it has met (of those it has merged, and of its counts).
KEPT = 1 << 19
NONE = 1 << 62


# ---- the tokenizer's file


def byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if printable, else the next from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def character_classes(cut) -> tuple[list[int], list[int]]:
    """(first code points, classes) of runs of code points that the tokenizer's own cutting of texts treats alike."""
    starts, kinds = [], []
    for low, high in ((0, 0xD800), (0xE000, 0x110000)):
        text = "".join(map(chr, range(low, high)))
        for _, (a, b) in cut(text):
            for at in range(a, b if b - a < 40 else a + 1):  # short pieces may hold two classes
                c = chr(low + at)
                kind = LETTER if len(cut("a" + c)) == 1 else NUMBER if len(cut("1" + c)) == 1 else OTHER if len(cut("!" + c)) == 1 else SPACE
                if not kinds or kinds[-1] != kind:
                    starts.append(low + at)
                    kinds.append(kind)
    return starts, kinds


class Vocabulary:
    """What encoding and decoding need of a tokenizer's JSON file."""

    def __init__(self, path: str):
        from tokenizers import pre_tokenizers

        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        model, cut = data["model"], data["pre_tokenizer"] or {}
        plain = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space") and not data["normalizer"] and (data["decoder"] or {}).get("type") == "ByteLevel"
        odd = [k for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        added = data["added_tokens"]
        if model["type"] != "BPE" or not plain or odd or any(a["single_word"] or a["lstrip"] or a["rstrip"] or a["normalized"] for a in added):
            raise ValueError(f"{path}: only byte-level BPE without options is supported")
        table = {c: b for b, c in enumerate(byte_characters())}
        ids = model["vocab"]
        self.added = {a["content"]: a["id"] for a in added}
        names = {i: t for t, i in [*ids.items(), *self.added.items()]}
        self.size = max(names) + 1
        self.token_bytes = [bytes(table[c] for c in names[i]) if i in names and all(c in table for c in names[i]) else names.get(i, "").encode() for i in range(self.size)]
        self.first = [ids[c] for c in byte_characters()]
        split = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = [(ids[a], ids[b], ids[a + b]) for a, b in split]
        self.class_starts, self.class_kinds = character_classes(pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str)


# ---- exact merging


def merge(word: bytes, first: list[int], pairs: dict[int, int], size: int) -> list[int]:
    """Token ids of a piece: of all pairs the lowest rank is merged first, of equal ones the leftmost.

    pairs: a * size + b to rank << 32 | merged id.
    """
    s, get = [first[b] for b in word], pairs.get
    if len(s) > SHORT:
        return merge_long(s, pairs, size)
    ranks = [get(a * size + b, NONE) for a, b in zip(s, s[1:])]  # noqa: B905
    while ranks and (best := min(ranks)) != NONE:
        i = ranks.index(best)
        s[i : i + 2] = [best & 0xFFFFFFFF]
        del ranks[i]
        if i:
            ranks[i - 1] = get(s[i - 1] * size + s[i], NONE)
        if i < len(ranks):
            ranks[i] = get(s[i] * size + s[i + 1], NONE)
    return s


def merge_long(s: list[int], pairs: dict[int, int], size: int) -> list[int]:
    """The same in n log n steps."""
    get, n = pairs.get, len(s)
    after, before = [*range(1, n), -1], [*range(-1, n - 1)]
    heap = [(v, i) for i in range(n - 1) if (v := get(s[i] * size + s[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        v, i = heapq.heappop(heap)
        j = after[i]
        if s[i] < 0 or j < 0 or get(s[i] * size + s[j]) != v:
            continue  # one of the two has been merged meanwhile
        s[i], s[j], after[i] = v & 0xFFFFFFFF, -1, after[j]
        if after[i] >= 0:
            before[after[i]] = i
            if (v := get(s[i] * size + s[after[i]])) is not None:
                heapq.heappush(heap, (v, i))
        if before[i] >= 0 and (v := get(s[before[i]] * size + s[i])) is not None:
            heapq.heappush(heap, (v, before[i]))
    return [x for x in s if x >= 0]


# ---- the automaton


def minimal_automaton(words: list[bytes]) -> dict[str, np.ndarray]:
    """The minimal acyclic automaton of distinct sorted words, its arcs numbered so that a path adds up to its word's place.

    Returns arcs (state * 256 + byte, ascending), targets, outputs, and final (by state; state 0 is the start).
    """
    arcs: list[dict[int, int]] = [{}]  # of the states of the word before, by byte
    ends = [False]
    known: dict[tuple, int] = {}
    done: list[tuple[bool, tuple]] = []  # the shared states

    def share(depth: int, word: bytes) -> None:
        """Replace the states below `depth` on the path of `word` by shared ones, the last first."""
        while len(arcs) > depth + 1:
            state = (ends.pop(), tuple(sorted(arcs.pop().items())))
            if state not in known:
                known[state] = len(done)
                done.append(state)
            arcs[-1][word[len(arcs) - 1]] = known[state]

    last = b""
    for word in words:
        if word < last or word == last != b"":
            raise ValueError("words must be sorted and distinct")
        depth = next((i for i, (a, b) in enumerate(zip(word, last)) if a != b), min(len(word), len(last)))  # noqa: B905
        share(depth, last)
        for _ in word[depth:]:
            arcs.append({})
            ends.append(False)
        ends[len(word)], last = True, word
    share(0, last)
    done.append((ends[0], tuple(sorted(arcs[0].items()))))
    start = len(done) - 1
    place = [start - i for i in range(len(done))]  # the start gets 0, and arcs lead to larger numbers
    counts = [0] * len(done)
    rows = []
    for i, (end, out) in enumerate(done):  # arcs lead to earlier states of `done`
        n = int(end)
        for label, to in out:
            rows.append((place[i] * 256 + label, place[to], n))
            n += counts[to]
        counts[i] = n
    table = np.array(sorted(rows), np.int64).reshape(-1, 3)
    final = np.array([end for end, _ in reversed(done)], bool)
    return {"arcs": table[:, 0], "targets": table[:, 1], "outputs": table[:, 2], "final": final}


def find_words(auto: dict[str, np.ndarray], buf: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The place in the lexicon of each word buf[start : start + len]; -1 if it is not there."""
    out = np.full(len(starts), -1, np.int64)
    arcs, at = auto["arcs"], np.arange(len(starts))
    state, place = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    j = 0
    while len(at):
        over = lens[at] == j
        if over.any():
            out[at[over]] = np.where(auto["final"][state[over]] > 0, place[over], -1)
            at, state, place = at[~over], state[~over], place[~over]
        key = state * 256 + buf[starts[at] + j]
        i = np.minimum(np.searchsorted(arcs, key), max(len(arcs) - 1, 0))
        ok = arcs[i] == key if len(arcs) else np.zeros(len(at), bool)
        at, i = at[ok], i[ok]
        state, place = auto["targets"][i].astype(np.int64), place[ok] + auto["outputs"][i]
        j += 1
    return out


# ---- the file that workers map


SECTIONS = ("arcs", "targets", "outputs", "final", "id_starts", "ids", "first", "merges", "token_starts", "token_bytes", "class_starts", "class_kinds", "added_ids", "added_starts", "added_bytes")


def flat(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Starts (one more than parts) and all bytes of some byte strings."""
    return np.append(0, np.cumsum([len(p) for p in parts], dtype=np.int64)), np.frombuffer(b"".join(parts), np.uint8)


def compile_lexicon(vocabulary: Vocabulary, words: list[bytes]) -> bytes:
    """The lexicon and what else workers need, as numbers of 32 bits: the sections' lengths, then the sections."""
    words, v = sorted(set(words)), vocabulary
    pairs = pair_table(v.merges, v.size)
    ids = [merge(w, v.first, pairs, v.size) for w in words]
    x = minimal_automaton(words)
    x["id_starts"] = np.append(0, np.cumsum([len(i) for i in ids], dtype=np.int64))
    x["ids"], x["first"], x["merges"] = np.array([i for own in ids for i in own], np.int64), np.array(v.first), np.array(v.merges, np.int64).reshape(-1)
    x["token_starts"], x["token_bytes"] = flat(v.token_bytes)
    x["class_starts"], x["class_kinds"] = np.array(v.class_starts), np.array(v.class_kinds)
    x["added_ids"] = np.array([*v.added.values()], np.int64)
    x["added_starts"], x["added_bytes"] = flat([t.encode() for t in v.added])
    if any(len(s) and s.max() >= 1 << 31 for s in x.values()):
        raise ValueError("the lexicon is too large for numbers of 32 bits")
    return b"".join([np.array([len(x[k]) for k in SECTIONS], "<i4").tobytes(), *(x[k].astype("<i4").tobytes() for k in SECTIONS)])


def pair_table(merges, size: int) -> dict[int, int]:
    out: dict[int, int] = {}
    for rank, (a, b, c) in enumerate(merges):
        out[a * size + b] = rank << 32 | c  # the later of two equal merges counts
    return out


class Lexicon:
    """The mapped file, and a worker's tables of it."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            data = np.frombuffer(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ), "<i4")
        ends = np.cumsum(data[: len(SECTIONS)]) + len(SECTIONS)
        self.x = {k: data[e - n : e] for k, e, n in zip(SECTIONS, ends.tolist(), data[: len(SECTIONS)].tolist(), strict=True)}
        self.size = len(self.x["token_starts"]) - 1
        self.token_bytes = self.x["token_bytes"].astype(np.uint8)
        self.first = self.x["first"].tolist()
        self.pairs = pair_table(self.x["merges"].reshape(-1, 3).tolist(), self.size)
        self.classes = np.repeat(self.x["class_kinds"].astype(np.uint8), np.diff(np.append(self.x["class_starts"], 0x110000)))
        starts, raw = self.x["added_starts"].tolist(), self.x["added_bytes"].astype(np.uint8).tobytes()
        self.added = {raw[a:b]: i for a, b, i in zip(starts, starts[1:], self.x["added_ids"].tolist())}  # noqa: B905
        self.added_pattern = re.compile(b"|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True))) if self.added else None
        self.merged: dict[bytes, list[int]] = {}

    def merge(self, word: bytes) -> list[int]:
        ids = self.merged.get(word)
        if ids is None:
            if len(self.merged) >= KEPT:
                self.merged.clear()
            ids = merge(word, self.first, self.pairs, self.size)
            if len(word) <= SHORT:
                self.merged[word] = ids
        return ids


# ---- cutting texts


def code_points(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place and the value of every character of UTF-8 bytes."""
    if not len(buf) or buf.max() < 0x80:
        return np.arange(len(buf)), buf.astype(np.int32)
    at = np.flatnonzero((buf & 0xC0) != 0x80)
    b = np.append(buf, np.zeros(3, np.uint8)).astype(np.int32)
    value = b[at]
    for low, bits, more in ((0xC0, 0x1F, 1), (0xE0, 0x0F, 2), (0xF0, 0x07, 3)):
        i = np.flatnonzero(b[at] >= low)
        x = b[at[i]] & bits
        for k in range(1, more + 1):
            x = x << 6 | b[at[i] + k] & 0x3F
        value[i] = x
    return at, np.minimum(value, 0x10FFFF)


def special_segments(lexicon: Lexicon, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bounds of texts and of the added tokens within them; starts and ids of the latter."""
    starts, ends, ids = [], [], []
    if lexicon.added_pattern is not None and lexicon.added_pattern.search(raw := buf.tobytes()):
        for lo, hi in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True):
            for m in lexicon.added_pattern.finditer(raw, lo, hi):
                starts.append(m.start())
                ends.append(m.end())
                ids.append(lexicon.added[m[0]])
    return np.unique(np.concatenate((offs, np.array(starts + ends, np.int64)))), np.array(starts, np.int64), np.array(ids, np.int64)


def pieces(lexicon: Lexicon, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the pieces of a slice of texts, and one more end; starts and ids of those that are added tokens.

    A piece is a run of letters, of numbers, of other characters, or of white space. A space before one of the first three belongs to it;
    another white space there is a piece of its own. An apostrophe with s, t, re, ve, m, ll or d is a piece where it starts one.
    """
    bounds, special, ids = special_segments(lexicon, buf, offs)
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(1, np.int64), special, ids
    at, value = code_points(buf)
    kind = lexicon.classes[value]
    head = np.zeros(len(at) + 4, bool)  # a text or an added token starts; and what follows the slice does
    head[np.searchsorted(at, bounds[bounds < len(buf)])] = True
    head[len(at) :] = True
    if len(special):
        first = np.searchsorted(at, special)
        last = np.searchsorted(at, bounds[np.searchsorted(bounds, special) + 1])
        kind[T.ragged(first, last - first)] = SPECIAL
    n = len(at)
    new = head[: n + 4].copy()
    new[1:n] |= kind[1:] != kind[:-1]
    i = np.flatnonzero((kind[1:] != SPACE) & (kind[:-1] == SPACE) & ~head[1:n]) + 1  # what follows white space
    new[i - 1] = True
    new[i[value[i - 1] == 0x20]] = False
    c = np.append(value, np.zeros(4, value.dtype))
    i = np.flatnonzero((c[:n] == 0x27) & new[:n] & ~head[1 : n + 1])
    one = i[np.isin(c[i + 1], [ord(x) for x in "stmd"])]
    two = i[~head[i + 2] & (((c[i + 1] == ord("r")) | (c[i + 1] == ord("v"))) & (c[i + 2] == ord("e")) | (c[i + 1] == ord("l")) & (c[i + 2] == ord("l")))]
    new[one + 1] = new[two + 1] = False
    new[one + 2] = new[two + 3] = True
    starts = at[np.flatnonzero(new[:n])]
    return starts, np.append(starts, len(buf)), special, ids


_masks = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def distinct(buf: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One of each group of equal byte strings, and the group of every string. Equality is of content, not of hashes."""
    if not len(starts):
        return starts, starts
    padded = np.append(buf, np.zeros(24, np.uint8))
    eight = np.ndarray(shape=(len(buf) + 9,), dtype="<u8", buffer=padded, strides=(1,))
    low = eight[starts] & _masks[np.minimum(lens, 8)]
    high = eight[np.minimum(starts + 8, len(buf))] & _masks[np.clip(lens - 8, 0, 8)]
    numbers: dict[bytes, int] = {}
    for i in np.flatnonzero(lens > 16).tolist():  # a high part that no text has, and a number for each
        low[i], high[i] = numbers.setdefault(buf[starts[i] : starts[i] + lens[i]].tobytes(), len(numbers)), U(0xFFFFFFFFFFFFFFFF)
    key = T.mix(low * U(0x9E3779B97F4A7C15) + T.mix(high + lens.astype(np.uint64)))
    order = np.argsort(key)
    for _ in range(2):
        k, a, b, c = key[order], low[order], high[order], lens[order]
        differ = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1])
        if (differ == (k[1:] != k[:-1])).all():
            break
        order = np.lexsort((low, high, lens))  # two strings of one hash
        key = np.zeros(len(order), np.uint64)
        key[order] = np.cumsum(np.append(False, (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1]) | (lens[order][1:] != lens[order][:-1])))
    head = np.append(True, differ)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(head) - 1
    return order[head], group


# ---- Spark


def word_counts(docs: DataFrame, lexicon: str) -> DataFrame:
    """How often each piece occurs: word (binary), n."""

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, found = Lexicon(SparkFiles.get(lexicon)), {}
        rows = lambda: pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())], names=["word", "n"])
        for batch in it:
            for _, _, buf, offs in T.text_slices(batch.column(0), 1 << 20):
                starts, bounds, special, _ = pieces(own, buf, offs)
                lens = np.diff(bounds)
                plain = ~np.isin(starts, special)
                starts, lens = starts[plain], lens[plain]
                one, group = distinct(buf, starts, lens)
                raw = buf.tobytes()
                for a, n, k in zip(starts[one].tolist(), lens[one].tolist(), np.bincount(group, minlength=len(one)).tolist(), strict=True):
                    w = raw[a : a + n]
                    found[w] = found.get(w, 0) + k
                if len(found) > KEPT:
                    yield rows()
                    found = {}
        yield rows()

    return docs.select("text").mapInArrow(T.lean(count), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def share_file(spark: SparkSession, data: bytes) -> str:
    """Write a file to the shared folder and have every executor fetch it; the name that SparkFiles knows it by."""
    name = f"lexicon-{hashlib.sha256(data).hexdigest()[:32]}.bin"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not files.exists(path):
        out = files.create(path)
        try:
            out.write(bytearray(data))
        finally:
            out.close()
    spark.sparkContext.addFile(str(files.makeQualified(path)))
    return name


def build_lexicon(docs: DataFrame, tokenizer: str, words: int = 65_536) -> str:
    """Compile the most frequent pieces of docs, `words` at most; the name of the shared file.

    Those are all pieces whose count reaches a threshold: counts are put into 16 classes for each doubling, and the classes are taken
    from the top as long as their pieces are at most `words`. So the driver gets a row per class, and `words` rows.
    """
    spark, vocabulary = docs.sparkSession, Vocabulary(tokenizer)
    scratch = Scratch(spark, "lexicon")
    grade = F.floor(16 * F.log2("n")).cast("int")
    counted = scratch.save(word_counts(docs, share_file(spark, compile_lexicon(vocabulary, []))).select("word", grade.alias("grade")))
    least, room = None, words
    for r in counted.groupBy("grade").count().orderBy(F.col("grade").desc()).collect():
        room -= r["count"]
        if room < 0:
            break
        least = r.grade
    top = counted.where(F.col("grade") >= least).select("word").collect() if least is not None else []
    scratch.drop(counted)
    return share_file(spark, compile_lexicon(vocabulary, [bytes(r.word) for r in top]))


def encode_slice(own: Lexicon, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of a slice of texts, and where each text's begin (one more than texts)."""
    starts, bounds, special, special_ids = pieces(own, buf, offs)
    lens = np.diff(bounds)
    one, group = distinct(buf, starts, lens)
    a, n = starts[one], lens[one]
    place = find_words(own.x, buf, a, n)
    known, id_starts = place >= 0, own.x["id_starts"].astype(np.int64)
    new = np.flatnonzero(~known)
    raw = buf.tobytes()
    merged = [own.merge(raw[i : i + k]) for i, k in zip(a[new].tolist(), n[new].tolist(), strict=True)]
    pool = np.concatenate((own.x["ids"], np.array([i for ids in merged for i in ids], np.int32), special_ids.astype(np.int32)))
    at, size = np.zeros(len(one), np.int64), np.zeros(len(one), np.int64)
    at[known], size[known] = id_starts[place[known]], np.diff(id_starts)[place[known]]
    size[new] = [len(ids) for ids in merged]
    at[new] = len(own.x["ids"]) + np.cumsum(size[new]) - size[new]
    at, size = at[group], size[group]
    if len(special):
        i = np.searchsorted(starts, special)
        at[i], size[i] = len(pool) - len(special) + np.arange(len(special)), 1
    ids = pool[T.ragged(at, size)]
    return ids, np.append(0, np.cumsum(size))[np.searchsorted(starts, offs)]


def encode(docs: DataFrame, tokenizer: str, words: int = 65_536) -> DataFrame:
    """Token ids of each row of docs (doc_id, text) by the byte-level BPE of `tokenizer`, a tokenizer's JSON file.

    Returns doc_id, n_tokens and ids: unsigned 32-bit numbers, little-endian, one after another. They are those of the tokenizers
    library without a post-processor; an added token's text is that token. `words` is the size of the lexicon, on which
    no id depends.

    A null or empty text has no ids. Rows are encoded one by one, so repeated rows get equal results; a null doc_id stays null. A worker
    needs about 100 bytes for each byte of the longest text. Other columns are ignored. An empty table gives no rows.
    """
    lexicon = build_lexicon(docs, tokenizer, words)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Lexicon(SparkFiles.get(lexicon))
        for batch in it:
            for lo, hi, buf, offs in T.text_slices(batch.column(1), 1 << 20):
                ids, at = encode_slice(own, buf, offs)
                data = ids.astype("<u4").tobytes()
                packed = [data[4 * a : 4 * b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(np.diff(at), pa.int64()), pa.array(packed, pa.binary())], names=["doc_id", "n_tokens", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(T.lean(run), "doc_id long, n_tokens long, ids binary")


def decode(rows: DataFrame, tokenizer: str, name: str = "decoded") -> DataFrame:
    """Rows with the text of their `ids` (as encode() packs them) as a column `name`, which replaces one of that name.

    Ids that the vocabulary has not are left out, and bytes that are no UTF-8 become U+FFFD. Null ids have the empty text.
    An empty table gives no rows.
    """
    lexicon = share_file(rows.sparkSession, compile_lexicon(Vocabulary(tokenizer), []))
    kept = rows.select(*[F.col(f"`{c}`") for c in rows.columns if c != name])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Lexicon(SparkFiles.get(lexicon))
        starts = own.x["token_starts"].astype(np.int64)
        for batch in it:
            offs, data = T.strings(batch.column(batch.schema.get_field_index("ids")))
            texts = []
            for lo, hi in T.slices(offs, 1 << 20):
                ids = np.frombuffer(data[offs[lo] : offs[hi]].tobytes(), "<u4").astype(np.int64)
                known = ids < own.size
                size = np.where(known, np.diff(starts)[np.where(known, ids, 0)], 0)
                raw = own.token_bytes[T.ragged(starts[np.where(known, ids, 0)], size)].tobytes()
                at = np.append(0, np.cumsum(size))[(offs[lo : hi + 1] - offs[lo]) // 4].tolist()
                texts += [raw[a:b].decode("utf-8", "replace") for a, b in zip(at, at[1:])]  # noqa: B905
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, name])

    from pyspark.sql.types import StructField, StructType, StringType

    return kept.mapInArrow(T.lean(run), StructType([*kept.schema.fields, StructField(name, StringType())]))


def op13(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    rows = decode(encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer), tokenizer)
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))
