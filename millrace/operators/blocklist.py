"""Blocklists of thousands of words and phrases, in one pass over the texts.

Exact matches are found by an automaton of all keywords (Aho-Corasick): its tables are built once, broadcast, and run over an Arrow
batch of texts in lanes, all of which take a step at once. Near matches of phrases are looked up in an inverted index of the phrases' grams
by number of words, length and place, and only what its count of common characters leaves is compared with difflib.
"""

from __future__ import annotations

import difflib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of an automaton's step table at most; it is broadcast.
MOST_BYTES = 256 << 20
#: Bytes of text that a lane reads, at least.
LANE = 512
WORD = np.zeros(257, bool)
WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), 0x5F, *range(0x61, 0x7B)]] = True


@dataclass(frozen=True)
class Automaton:
    """Tables of Aho-Corasick with the failure steps filled in. State 0 is the start.

    classes: of each byte, and of what separates texts (the last); step: the next state by state and class; ends: the keyword that
    ends in a state, or -1; here and link: the nearest state with a keyword along the failure links, itself included or not, or 0.
    """

    keywords: list[str]
    lengths: np.ndarray
    classes: np.ndarray
    step: np.ndarray
    ends: np.ndarray
    here: np.ndarray
    link: np.ndarray


def build_automaton(keywords: list[str]) -> Automaton:
    """Of the distinct keywords that are not empty, sorted."""
    words = sorted({k for k in keywords if k})
    data = [w.encode() for w in words]
    used = sorted({b for d in data for b in d})
    classes = np.zeros(257, np.int32)
    classes[used] = np.arange(1, len(used) + 1)
    kids: list[dict[int, int]] = [{}]
    ends = [-1]
    for i, d in enumerate(data):
        at = 0
        for c in classes[list(d)].tolist():
            if c not in kids[at]:
                kids[at][c] = len(kids)
                kids.append({})
                ends.append(-1)
            at = kids[at][c]
        ends[at] = i
    width = len(used) + 1
    if len(kids) * width * 4 > MOST_BYTES:
        raise ValueError(f"an automaton of {len(words)} keywords is over {MOST_BYTES} bytes; divide the list")
    step = np.zeros((len(kids), width), np.int32)
    fail, here, link = np.zeros(len(kids), np.int32), np.zeros(len(kids), np.int32), np.zeros(len(kids), np.int32)
    level = [0]
    while level:  # by depth, so that what a state falls back to is ready
        below = []
        for s in level:
            row = step[fail[s]].copy() if s else step[0]
            link[s] = here[fail[s]] if s else 0
            here[s] = s if ends[s] >= 0 else link[s]
            for c, t in kids[s].items():
                fail[t] = row[c] if s else 0
                row[c] = t
                below.append(t)
            step[s] = row
        level = below
    return Automaton(words, np.array([len(d) for d in data], np.int64), classes, step, np.array(ends, np.int32), here, link)


def scan(auto: Automaton, data: np.ndarray, offs: np.ndarray, whole_words: bool) -> tuple[np.ndarray, np.ndarray]:
    """(text, keyword) of every occurrence in texts data[offs[i] : offs[i + 1]]; offs starts at 0."""
    if not len(auto.lengths) or len(offs) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # the texts one after another, with a separator behind each
    size = len(data) + len(offs) - 1
    text = np.full(size, 256, np.int16)
    starts = offs[:-1] + np.arange(len(offs) - 1)
    text[np.arange(len(data)) + np.repeat(np.arange(len(offs) - 1), np.diff(offs))] = data
    warm = int(auto.lengths.max()) - 1  # what a lane reads before its own bytes, to be in the state of one that began earlier
    wide = max(LANE, 4 * warm)
    lanes = -(-size // wide)
    padded = np.full(warm + lanes * wide, 256, np.int16)
    padded[warm : warm + size] = text
    kind = auto.classes[padded]
    view = np.lib.stride_tricks.as_strided(kind, (lanes, warm + wide), (wide * kind.itemsize, kind.itemsize))
    width, flat = auto.step.shape[1], auto.step.reshape(-1)
    state, first = np.zeros(lanes, np.int64), np.arange(lanes) * wide - warm
    found_at, found_state = [], []
    for j in range(warm + wide):
        state = flat[state * width + view[:, j]].astype(np.int64)
        if j >= warm and len(hit := np.flatnonzero(auto.here[state])):
            found_at.append(first[hit] + j)
            found_state.append(auto.here[state[hit]].astype(np.int64))
    if not found_at:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, state = np.concatenate(found_at), np.concatenate(found_state)
    rows, words = [], []
    while len(at):  # and the shorter keywords that end at the same place
        word = auto.ends[state].astype(np.int64)
        begin, own = at - auto.lengths[word] + 1, np.ones(len(at), bool)
        if whole_words:
            before = np.where(begin > 0, text[np.maximum(begin - 1, 0)], 256)
            after = text[np.minimum(at + 1, size - 1)]
            own = (WORD[before] != WORD[text[begin]]) & (WORD[text[at]] != WORD[after])
        rows.append(np.searchsorted(starts, at[own], "right") - 1)
        words.append(word[own])
        state = auto.link[state].astype(np.int64)
        at, state = at[state > 0], state[state > 0]
    return np.concatenate(rows), np.concatenate(words)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 and bytes of a string column; nulls have no bytes."""
    column = column.cast(pa.large_string()).fill_null("")
    offs = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offs - offs[0], raw[offs[0] : offs[-1]]


def keyword_finder(spark: SparkSession, keywords: list[str], whole_words: bool) -> Callable[[Column], Column]:
    """A function from a text column to the sorted distinct keywords that occur in it; none in null or empty text.

    With whole_words an occurrence starts and ends where ASCII letters, digits and underscores meet anything else. Keywords and
    texts are compared as they are: lower-case both for matches in any case. Duplicate and empty keywords are ignored.
    """
    shared = spark.sparkContext.broadcast(build_automaton(list(keywords)))

    @F.arrow_udf("array<string>")
    def find(texts: pa.Array) -> pa.Array:
        auto = shared.value
        offs, data = _bytes_of(texts)
        rows, words, lo = [], [], 0
        while lo < len(offs) - 1:  # slices of a MB, or of one longer text
            hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + (1 << 20), "right")) - 1)
            r, w = scan(auto, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo], whole_words)
            key = np.unique((r + lo) * len(auto.keywords) + w) if len(r) else np.zeros(0, np.int64)
            rows.append(key // max(len(auto.keywords), 1))
            words.append(key % max(len(auto.keywords), 1))
            lo = hi
        row, word = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, words))
        ends = np.append(0, np.cumsum(np.bincount(row, minlength=len(texts))))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(auto.keywords, pa.string()).take(pa.array(word)))

    return find


# ---- near matches

#: Classes that characters are counted in, bits of the filter before the index, characters of a slice, and verdicts that are kept.
KINDS, BITS, SLICE, KEPT = 32, 20, 1 << 20, 1 << 17
NONE = np.uint32(0xFFFFFFFF)  # no character
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")


def _grams(codes: np.ndarray, most: int):
    """(size, hash of the `size` characters from each place on) for sizes 0 to `most`; past the end characters are 0."""
    value, out, power = _mix(codes.astype(np.uint64) + np.uint64(1)), np.zeros(len(codes) + 1, np.uint64), np.uint64(1)
    for size in range(most + 1):
        yield size, out
        out = out.copy()
        out[: max(len(codes) - size, 0)] += value[size:] * power
        power = np.uint64(int(power) * int(_BASE) & 0xFFFFFFFFFFFFFFFF)


def _key(gram: np.ndarray, n: int, length: np.ndarray, place: int, size: int) -> np.ndarray:
    return _mix(gram + _mix(((length.astype(np.uint64) * np.uint64(1 << 12) + np.uint64(place)) * np.uint64(1 << 12) + np.uint64(size)) * np.uint64(1 << 8) + np.uint64(n)))


def least_matches(run: int, phrase: int, need: float) -> int | None:
    """The least number of matched characters with which a run of one length is near a phrase of another; None if no number is enough."""
    most = min(run, phrase)
    if 2.0 * most / (run + phrase) < need:
        return None
    m = max(0, int(need * (run + phrase) / 2) - 2)
    while 2.0 * m / (run + phrase) < need:
        m += 1
    return m


@dataclass(frozen=True)
class PhraseIndex:
    """An inverted index of phrases by the grams that a near run has.

    A run of some length that is near a phrase has m of its characters, in order: `lost` others of the phrase are not in the run, and
    `added` of the run not in the phrase. Cut the phrase into lost + added + 1 pieces: for the first number i (from 0) such that pieces 0
    to i have at most i of these faults in or before them, piece i is whole, and i faults are before it, which move it by those added less
    those lost. Each piece is indexed at each place where it may be then; where a phrase is too short for pieces, the gram is empty,
    and every run of that number of words and length meets it.

    keys: hashes of (words, length, place, gram), sorted; ids: their phrases; bits: a filter of the keys; probes: by number of words, of
    (size, length) the places to look up; least: m by phrase and length, or -1; counts: characters of each phrase by class; letters:
    characters of each phrase, and then none.
    """

    phrases: list[str]
    need: np.ndarray
    keys: np.ndarray
    ids: np.ndarray
    bits: np.ndarray
    probes: dict[int, dict[tuple[int, int], list[int]]]
    least: np.ndarray
    counts: np.ndarray
    letters: np.ndarray


def index_phrases(phrases: list[str], slack: float) -> PhraseIndex:
    """Of phrases of more than `slack` characters."""
    longest = max(int(len(w) * (len(w) + slack) / (len(w) - slack)) for w in phrases) + 1
    least = np.full((len(phrases), longest + 2), -1, np.int64)
    keys, ids, probes = [], [], {}
    for k, w in enumerate(phrases):
        need, n, codes = (len(w) - slack) / len(w), w.count(" ") + 1, _codes(w)
        hashes = dict(_grams(codes, len(w)))
        for length in range(1, longest + 1):
            m = least_matches(length, len(w), need)
            if m is None:
                continue
            least[k, length] = m
            lost, added = len(w) - m, length - m
            pieces = lost + added + 1
            cuts = [len(w) * i // pieces for i in range(pieces + 1)] if pieces <= len(w) else [0, 0]
            for i, (a, b) in enumerate(zip(cuts, cuts[1:])):  # noqa: B905
                moved = {i - 2 * k for k in range(i + 1) if k <= lost and i - k <= added}  # added less lost before it, i in all
                for j in sorted(a + x for x in moved if 0 <= a + x <= length - (b - a)):
                    keys.append(_key(hashes[b - a][a : a + 1], n, np.array([length]), j, b - a)[0])
                    ids.append(k)
                    probes.setdefault(n, {}).setdefault((b - a, length), set()).add(j)
    key, order = np.array(keys, np.uint64), np.argsort(np.array(keys, np.uint64), kind="stable")
    bits = np.zeros(1 << BITS, bool)
    bits[key >> np.uint64(64 - BITS)] = True

    by_size = {n: {x: sorted(places) for x, places in own.items()} for n, own in probes.items()}
    counts = np.stack([np.bincount(_codes(w) % KINDS, minlength=KINDS) for w in phrases])
    letters = np.full((len(phrases), max(map(len, phrases))), NONE, np.uint32)
    for k, w in enumerate(phrases):
        letters[k, : len(w)] = _codes(w)
    return PhraseIndex(phrases, np.array([(len(w) - slack) / len(w) for w in phrases]), key[order], np.array(ids, np.int64)[order], bits, by_size, least, counts, letters)


def in_order(index: PhraseIndex, codes: np.ndarray, start: np.ndarray, length: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Whether each run has as many characters in common with its phrase, in order, as it needs: difflib never finds more.

    A table of longest common subsequences, row by row for all pairs at once, in the band that the characters left over allow.
    """
    need, out = index.least[phrase, length], np.zeros(len(start), bool)
    sizes = (index.letters != NONE).sum(1)[phrase]
    for lo in range(0, len(start), 1 << 12):
        i = slice(lo, lo + (1 << 12))
        wide, high = int((np.maximum(length[i], sizes[i]) - need[i]).max()), int(length[i].max())
        row = np.zeros((2 * wide + 2, len(start[i])), np.int32)  # by place in the phrase less place in the run, and one more
        for a in range(high):
            own = np.where(a < length[i], codes[np.minimum(start[i] + a, len(codes) - 1)], NONE - 1)
            for d in range(2 * wide + 1):
                if 0 <= (b := a + d - wide) < index.letters.shape[1]:
                    row[d] += own == index.letters[phrase[i], b]
                np.maximum(row[d], row[d + 1], out=row[d])
                if d:
                    np.maximum(row[d], row[d - 1], out=row[d])
        out[i] = row.max(axis=0) >= need[i]
    return out


def candidates(index: PhraseIndex, codes: np.ndarray, offs: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """(text, start, length, phrase) of all runs of words that may be near a phrase of as many words, of texts codes[offs[i] : offs[i + 1]].

    None that is near is left out: a candidate has a gram of the phrase at its place, and as many characters in common as it needs, in order too.
    """
    blank = np.flatnonzero(codes == 0x20)
    starts, ends = np.sort(np.concatenate((offs[:-1], blank + 1))), np.sort(np.concatenate((blank, offs[1:])))
    rows = np.repeat(np.arange(len(offs) - 1), np.searchsorted(blank, offs[1:]) - np.searchsorted(blank, offs[:-1]) + 1)
    longest = index.least.shape[1] - 1
    spans, groups = {}, {}
    for n in index.probes:
        at = np.flatnonzero(rows[n - 1 :] == rows[: len(rows) - n + 1])
        length = ends[at + n - 1] - starts[at]
        at, length = at[length < longest], length[length < longest]
        order = np.argsort(length, kind="stable")
        spans[n] = (rows[at][order], starts[at][order], length[order])
        groups[n] = np.searchsorted(length[order], np.arange(longest + 1)).tolist()
    found = {n: [] for n in index.probes}
    for size, gram in _grams(codes, max(z for own in index.probes.values() for z, _ in own)):
        for n, own in index.probes.items():
            for (z, length), places in own.items():
                lo, hi = groups[n][length : length + 2] if length < longest else (0, 0)
                if z != size or lo == hi:
                    continue
                start, of = spans[n][1][lo:hi], np.array([length])
                for place in places:
                    key = _key(gram[start + place], n, of, place, z)
                    i = np.flatnonzero(index.bits[key >> np.uint64(64 - BITS)])
                    key = key[i]
                    first, last = np.searchsorted(index.keys, key, "left"), np.searchsorted(index.keys, key, "right")
                    times = last - first
                    ids = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times - first, times)
                    found[n].append(np.repeat(i + lo, times) * len(index.phrases) + index.ids[ids])
    out = []
    for n, parts in found.items():
        pair = np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.int64)
        pair = pair[np.append(True, pair[1:] != pair[:-1])] if len(pair) else pair
        row, start, length = (x[pair // len(index.phrases)] for x in spans[n])
        phrase = pair % len(index.phrases)
        for lo in range(0, len(pair), 1 << 16):
            s, m, w = start[lo : lo + (1 << 16)], length[lo : lo + (1 << 16)], phrase[lo : lo + (1 << 16)]
            at = np.repeat(s - (np.cumsum(m) - m), m) + np.arange(m.sum())
            own = np.bincount(np.repeat(np.arange(len(s)), m) * KINDS + codes[at] % KINDS, minlength=len(s) * KINDS).reshape(-1, KINDS)
            ok = np.flatnonzero((np.minimum(own, index.counts[w]).sum(1) >= index.least[w, m]) & (index.least[w, m] >= 0))
            ok = ok[in_order(index, codes, s[ok], m[ok], w[ok])]
            out.append((row[lo : lo + (1 << 16)][ok], s[ok], m[ok], w[ok]))
    return out


def near_phrases(index: PhraseIndex, texts: list[str], known: dict[tuple[str, int], bool]) -> list[set[int]]:
    """The phrases that a run of each text is near. known: verdicts of pairs, which it adds to."""
    out: list[set[int]] = [set() for _ in texts]
    codes, offs = _codes("".join(texts)), np.append(0, np.cumsum([len(t) for t in texts], dtype=np.int64))
    raw = "".join(texts)
    matcher = difflib.SequenceMatcher(None)
    for rows, starts, lengths, phrases in candidates(index, codes, offs):
        for k in np.argsort(phrases, kind="stable").tolist():  # difflib prepares a phrase once
            row, a, n, w = int(rows[k]), int(starts[k]), int(lengths[k]), int(phrases[k])
            pair = (raw[a : a + n], w)
            if w in out[row]:
                continue
            if pair not in known:
                matcher.set_seq1(pair[0])
                if matcher.b != index.phrases[w]:
                    matcher.set_seq2(index.phrases[w])
                known[pair] = matcher.ratio() >= index.need[w]
            if known[pair]:
                out[row].add(w)
    return out


def near_finder(spark: SparkSession, phrases: list[str], slack: float, least: int = 6) -> Callable[[Column], Column]:
    """A function from a text column to the sorted phrases that a run of as many of its words nearly equals; none in null or empty text.

    The similarity is difflib's ratio with the phrase, and must reach (n - slack) / n for one of n characters. Phrases of under `least`
    characters, or of `slack` and less, are left out. Words are what single blanks separate.
    """
    words = sorted({" ".join(w.split()) for w in phrases})
    words = [w for w in words if len(w) >= least and len(w) > slack]
    shared = spark.sparkContext.broadcast(index_phrases(words, slack) if words else None)  # a few entries for each phrase

    @F.arrow_udf("array<string>")
    def find(texts: pa.Array) -> pa.Array:
        rows, index, out, lo, known = [t or "" for t in texts.to_pylist()], shared.value, [], 0, {}
        while lo < len(rows):
            hi, size = lo + 1, len(rows[lo])
            while hi < len(rows) and size + len(rows[hi]) <= SLICE:
                size, hi = size + len(rows[hi]), hi + 1
            out += near_phrases(index, rows[lo:hi], known) if index else [set()] * (hi - lo)
            if len(known) > KEPT:
                known.clear()
            lo = hi
        return pa.array([sorted(index.phrases[w] for w in own) if own else [] for own in out], pa.list_(pa.string()))

    return find


def runs_of(words: Column, n: int) -> Column:
    """All runs of n words, joined by blanks."""
    width = F.greatest(F.size(words) - n + 1, F.lit(0))
    out = F.slice(words, 1, width)
    for k in range(1, n):
        out = F.zip_with(out, F.slice(words, k + 1, width), lambda a, b: F.concat_ws(" ", a, b))
    return out


def near_hits(rows: DataFrame, key: str, column: str, phrases: list[str], slack: float = 0.4, least: int = 6) -> DataFrame:
    """Distinct keys of rows of which a run of words nearly equals a phrase of the same number of words.

    The similarity is difflib's ratio, and must reach (n - slack) / n for a phrase of n characters. Phrases of under `least`
    characters are left to exact matching. Words are what single blanks separate. Null text does not match.

    One character more or less costs at least 1 / (2 n + 1), so with slack * (2 n + 1) < n, as with the default, only an equal
    run reaches the similarity: such phrases are looked up by the automaton, the others by the index, all in one pass over the rows.
    """
    words = sorted({" ".join(w.split()) for w in phrases})
    words = [w for w in words if len(w) >= least]
    exact = [w for w in words if slack * (2 * len(w) + 1) < len(w)]
    loose = [w for w in words if len(w) > slack and slack * (2 * len(w) + 1) >= len(w)]
    any_run = [w.count(" ") + 1 for w in words if slack >= len(w)]  # nothing is too far from such a phrase
    text, hit = F.col(column), F.lit(False)
    if any_run:
        hit = hit | (F.size(F.split(text, " ")) >= min(any_run))
    if exact:
        find = keyword_finder(rows.sparkSession, [f" {w} " for w in exact], whole_words=False)
        hit = hit | (F.size(find(F.concat(F.lit(" "), text, F.lit(" ")))) > 0)
    if loose:
        hit = hit | (F.size(near_finder(rows.sparkSession, loose, slack, least)(text)) > 0)
    return rows.where(text.isNotNull() & hit).select(key).distinct()
