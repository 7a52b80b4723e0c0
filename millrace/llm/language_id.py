"""Language identification by cross-parsing entropy.

For each language a suffix automaton holds sample text. A text is parsed into phrases, each the longest match at its
place in that sample; a language's phrases cost log2(sample size) bits each, and the language of the fewest bits wins.
Phrases start at the automaton's root, so a parse is a walk over a table of states and symbols. The walks of some thousand
pieces of texts advance together, one symbol at a time, as array operations; each piece is parsed from its start, and then the
parse of the piece before is carried on into it until both begin a phrase at one place, after which they are the same. So
every text has one parse from its first symbol to its last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import textops as T
from millrace.llm.decontamination import SuffixAutomaton

#: Symbols that are parsed as one piece.
PIECE = 512


class Alphabet:
    """Symbols: 0 between words, 1 to 26 a letter a-z of either case, 27 a non-ASCII byte that no sample has, then those that some have."""

    def __init__(self, used: np.ndarray):
        self.of = np.zeros(256, np.uint8)
        self.of[0x41:0x5B] = self.of[0x61:0x7B] = np.arange(1, 27)
        self.of[0x80:] = 27
        high = np.flatnonzero(used[0x80:]) + 0x80
        self.of[high] = 28 + np.arange(len(high))
        self.size = 28 + len(high)


def symbols(buf: np.ndarray, offs: np.ndarray, alphabet: Alphabet) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of a slice, runs of other characters as one 0, and the first of each document."""
    sym = alphabet.of[buf]
    keep = sym > 0
    keep[1:] |= keep[:-1]
    heads = offs[:-1][np.diff(offs) > 0]
    keep[heads] = sym[heads] > 0
    return sym[keep], np.append(0, np.cumsum(keep))[offs]


def parse_table(sample: list[np.ndarray], size: int) -> np.ndarray:
    """(state, symbol) to 2 * next state + 1 if a new phrase starts with the symbol."""
    auto = SuffixAutomaton()
    for x in sample:
        auto.add(x.tolist())
    n = len(auto.link)
    table = np.full((n, size), -1, np.int32)
    for state, edges in enumerate(auto.next):
        table[state, list(edges)] = list(edges.values())
    root = np.where(table[0] < 0, 0, table[0])
    out = np.where(table < 0, root * 2 + 1, table * 2).astype(np.int32)
    out[0] = root * 2 + 1  # at the start, and after a symbol that the sample has not, which is a phrase by itself
    return out


def phrase_counts(sym: np.ndarray, first: np.ndarray, tables: np.ndarray, roots: np.ndarray) -> np.ndarray:
    """Phrases of each document in each language; tables are stacked, each language from its root on."""
    sizes = np.diff(first)
    pieces = -(-sizes // PIECE)
    row = np.repeat(np.arange(len(sizes)), pieces)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = first[:-1][row] + nth * PIECE
    size = np.minimum(sizes[row] - nth * PIECE, PIECE)
    flat, wide, many = tables.ravel(), tables.shape[1], len(size)
    out = np.zeros((len(roots), len(sizes)), np.int64)
    for i, root in enumerate(roots.tolist()):
        # marks of the places where a phrase starts, of each piece from its own start on
        marks = np.zeros((many, PIECE), bool)
        state = np.full(many, root)
        order = np.argsort(-size, kind="stable")
        active = many - np.searchsorted(size[order][::-1], np.arange(int(size.max(initial=0))), "right")
        for t, n in enumerate(active.tolist()):
            own = order[:n]
            s = flat[state[own] * wide + sym[start[own] + t]]
            marks[own, t] = s & 1
            state[own] = s >> 1
        todo = np.flatnonzero(nth > 0)
        while len(todo):  # carry the parse of the piece before on, until it is at the start of a phrase with that of the piece
            here, at = state[todo - 1], np.zeros(len(todo), np.int64)
            ended = []
            while len(todo):
                s = flat[here * wide + sym[start[todo] + at]]
                new = (s & 1).astype(bool)
                joined = new & marks[todo, at]
                marks[todo[~joined], at[~joined]] = new[~joined]
                here, at = s >> 1, at + 1
                over = ~joined & (at == size[todo])
                other = over & (here != state[todo])
                state[todo[over]] = here[over]
                ended.append(todo[other])
                go = ~joined & ~over
                todo, here, at = todo[go], here[go], at[go]
            after = np.concatenate(ended) + 1  # pieces after those whose end is another now
            after = after[after < many]
            todo = after[nth[after] > 0]
        out[i] = np.bincount(row, weights=marks.sum(axis=1), minlength=len(sizes))
    return out


def predictor(model):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, tables, roots, bits, alphabet = model.value
        names = np.array([*langs, "und"], object)
        for batch in it:
            best = np.full(batch.num_rows, len(langs))
            score = np.zeros(batch.num_rows)
            for lo, hi, buf, offs in T.text_slices(batch.column(1), 1 << 20):
                sym, first = symbols(buf, offs, alphabet)
                ascii_letters = np.append(0, np.cumsum((alphabet.of[buf] > 0) & (buf < 0x80)))[offs]
                letters = np.diff(ascii_letters) > 0
                for i in np.flatnonzero(~letters & (np.diff(first) > 0)).tolist():
                    letters[i] = any(c.isalpha() for c in buf[offs[i] : offs[i + 1]].tobytes().decode("utf-8", "replace"))
                if not langs or not letters.any():
                    continue
                cost = phrase_counts(sym, first, tables, roots) * bits[:, None]
                win = cost.argmin(axis=0)
                share = 1 / np.exp2(np.maximum(cost.min(axis=0) - cost, -1000) / 8).sum(axis=0)
                best[lo:hi][letters] = win[letters]
                score[lo:hi][letters] = share[letters]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(names[best], pa.string()), pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def sample_texts(labelled: DataFrame, rows: int, symbols_each: int) -> dict[str, list[bytes]]:
    """Some texts of each language in the order of a hash of doc_id, `symbols_each` bytes or the first text's worth.

    At most about `rows` texts of a language are brought to the driver, each of at most symbols_each bytes: of a longer text
    an excerpt, of a fourth as many characters at a place by the hash.
    """
    some = labelled.where(F.octet_length("text") > 0)
    long = F.octet_length("text") > symbols_each
    most = symbols_each // 4  # characters, of up to four bytes
    at = F.pmod(F.xxhash64("doc_id", "text"), F.greatest(F.char_length("text") - most, F.lit(0)) + 1).cast("int") + 1
    counts = {r[0]: r[1] for r in some.groupBy("lang").count().toLocalIterator()}
    if not counts:
        return {}
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in sorted(counts.items()) for x in (k, min(1.0, rows / n))]), F.col("lang"))
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    texts: dict[str, list[bytes]] = {}
    held: dict[str, int] = {}
    drawn = some.withColumn("draw", draw).where(F.col("draw") < share * (1 << 30))
    drawn = drawn.select("lang", F.when(long, F.substring(F.col("text"), at, F.lit(most))).otherwise(F.col("text")).alias("text"), "draw")
    for r in sorted(drawn.collect(), key=lambda r: (r.lang, r.draw, r.text)):
        raw = r.text.encode()
        if held.get(r.lang, 0) == 0 or held[r.lang] + len(raw) <= symbols_each:
            texts.setdefault(r.lang, []).append(raw)
            held[r.lang] = held.get(r.lang, 0) + len(raw)
    return texts


def identify_languages(docs: DataFrame, held_out, rows: int = 60, symbols_each: int = 24_000) -> DataFrame:
    """Predict the language of each row of docs; learn from the rows with a language for which `held_out` is not true.

    held_out is a Column over docs. Returns doc_id, held_out, lang_pred (a learned language, or `und` where the text is
    null or has no letter, or nothing was learned) and score (the winner's share of the languages' likelihoods under their
    code lengths, tempered; 0 for `und`). Ties go to the language that sorts first.

    The sample is bounded: about `rows` texts or excerpts of texts over symbols_each bytes, together symbols_each symbols, for each language, drawn by a hash, so it is the
    same whatever the partitions. The whole of every text is parsed. Rows with a null language are not learned from. Rows
    are judged one by one, so repeated rows get equal results. Other columns are ignored. An empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", "lang", held_out.alias("_held"))
    texts = sample_texts(docs.where(~F.coalesce("_held", F.lit(False)) & F.col("lang").isNotNull()).select("doc_id", "text", "lang"), rows, symbols_each)
    langs = sorted(texts)
    alphabet = Alphabet(np.bincount(np.frombuffer(b"".join(x for k in langs for x in texts[k]), np.uint8), minlength=256) > 0)
    samples = {k: [symbols(raw := np.frombuffer(x, np.uint8), np.array([0, len(raw)]), alphabet)[0] for x in texts[k]] for k in langs}
    tables = [parse_table(samples[k], alphabet.size) for k in langs]
    roots = np.cumsum([0, *(len(t) for t in tables)])[:-1].astype(np.int64)
    stacked = np.concatenate([t + 2 * r for t, r in zip(tables, roots, strict=True)]).astype(np.int32) if langs else np.zeros((0, alphabet.size), np.int32)
    bits = np.array([np.log2(max(2, sum(map(len, samples[k])))) for k in langs])
    model = spark.sparkContext.broadcast((langs, stacked, roots, bits, alphabet))
    rows_in = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("_held").alias("held_out"))
    return rows_in.mapInArrow(T.lean(predictor(model)), "doc_id long, held_out boolean, lang_pred string, score double")


def op3(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    return identify_languages(docs, held)
