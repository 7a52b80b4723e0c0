"""Quality rules by compression bands, with counts of words, symbols and repetitions.

The zstandard ratio (compressed bytes over bytes) of a whole text, and of each of its fixed chunks, must lie in a band
that depends on its length: text below the band repeats itself, text above it is incompressible.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import textops as T

U = np.uint64
IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[list(b"#*$%&|<>")] = True
#: (bytes from, lowest ratio, highest ratio) of whole texts. Short texts compress little, so their bands are wide.
#: From 1 KiB on, base64 of random bytes (0.755 and more) is above, prose (0.6 at most) well below the highest.
BANDS = ((0, 0.0, 9.0), (256, 0.15, 0.95), (1024, 0.15, 0.74), (4096, 0.15, 0.72), (32768, 0.12, 0.70))
#: The same of chunks, any of which rejects its text.
CHUNK_BAND = (0.10, 0.72)
CHUNK_BYTES = 4096


def repeated(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which elements are equal to an earlier one, and which to any other."""
    n = len(key)
    later, any_ = np.zeros(n, bool), np.zeros(n, bool)
    if n:
        o = np.argsort(key, kind="stable")
        same = np.append(False, key[o[1:]] == key[o[:-1]])
        later[o] = same
        any_[o] = same | np.append(same[1:], False)
    return later, any_


def sums_by(first: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sum of values in each range [first[i], first[i + 1])."""
    c = np.append(0, np.cumsum(values, dtype=np.int64))
    return c[first[1:]] - c[first[:-1]]


def counts(buf: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    rows = len(offs) - 1
    starts, ends, first = T.word_bounds(buf, offs, T.IS_WORD)
    words = T.word_hashes(buf, starts, ends)
    chars = np.append(0, np.cumsum((buf & 0xC0) != 0x80, dtype=np.int64))  # code points before each byte
    row_of_word = np.repeat(np.arange(rows), np.diff(first))
    # words in three-word windows that occur twice
    hit = np.zeros(len(words), bool)
    if len(words) > 2:
        inside = row_of_word[2:] == row_of_word[:-2]
        salt = T.mix(row_of_word[:-2].astype(np.uint64) + U(0x5851F42D))
        key = T.mix(words[:-2] * U(5) + T.mix(words[1:-1] * U(3) + T.mix(words[2:] ^ salt)))
        at = np.flatnonzero(inside)
        at = at[repeated(key[at])[1]]
        for k in range(3):
            hit[at + k] = True
    # lines
    cut = np.flatnonzero(buf == 0x0A)
    line_start = np.sort(np.concatenate((offs[:-1], cut + 1)))
    line_row = np.sort(np.concatenate((np.arange(rows), np.searchsorted(offs, cut, "right") - 1)))
    line_end = np.append(line_start[1:] - 1, len(buf))
    last = np.append(line_row[1:] != line_row[:-1], True)
    line_end[last] = offs[line_row[last] + 1]
    line_words = np.searchsorted(starts, line_end) - np.searchsorted(starts, line_start)
    some = line_words > 0
    key = T.word_hashes(buf, line_start[some], line_end[some]) ^ T.mix(line_row[some].astype(np.uint64) * U(0x9E3779B1) + (line_end - line_start)[some].astype(np.uint64))
    dup = np.bincount(line_row[some][repeated(key)[0]], minlength=rows)
    return {
        "n_words": np.diff(first),
        "word_chars": sums_by(first, chars[ends] - chars[starts]),
        "n_symbols": sums_by(offs, IS_SYMBOL[buf]),
        "n_dup_lines": dup.astype(np.int64),
        "n_repeat_words": sums_by(first, hit),
    }


def ratios(text: bytes, packer: zstandard.ZstdCompressor, chunk: int) -> tuple[float | None, list[float]]:
    """Of the whole text and of its chunks; the last chunk ends with the text and may overlap the one before."""
    if not text:
        return None, []
    whole = len(packer.compress(text)) / len(text)
    starts = [*range(0, len(text) - chunk, chunk), len(text) - chunk] if len(text) > chunk else []
    return whole, [len(packer.compress(text[i : i + chunk])) / chunk for i in starts]


def verdict(size: int, whole: float | None, chunks: list[float]) -> str:
    """Empty if the ratios lie in their bands, else what is wrong."""
    if whole is None:
        return "empty"
    _, low, high = next(b for b in reversed(BANDS) if size >= b[0])
    if not low <= whole <= high:
        return "repetitive" if whole < low else "incompressible"
    if chunks and min(chunks) < CHUNK_BAND[0]:
        return "repetitive chunks"
    return "incompressible chunks" if chunks and max(chunks) > CHUNK_BAND[1] else ""


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer = zstandard.ZstdCompressor(level=3)
    for batch in it:
        offs, data = T.strings(batch.column(1))
        for lo, hi in T.slices(offs, 1 << 18):
            own = offs[lo : hi + 1] - offs[lo]
            c = counts(data[offs[lo] : offs[hi]], own)
            whole, chunks, words = [], [], []
            for i in range(lo, hi):
                a, b = ratios(data[offs[i] : offs[i + 1]].tobytes(), packer, CHUNK_BYTES)
                whole.append(a)
                chunks.append(b)
                words.append(verdict(int(offs[i + 1] - offs[i]), a, b))
            columns = [batch.column(0).slice(lo, hi - lo), *(pa.array(c[k]) for k in NAMES), pa.array(whole, pa.float64()), pa.array(chunks, pa.list_(pa.float64())), pa.array(words, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *NAMES, "ratio", "chunk_ratios", "reason"])


def quality_rules(docs: DataFrame, min_words: int = 50, repeat_percent: int = 50) -> DataFrame:
    """Counts, compression ratios and a verdict for each row of docs.

    Returns doc_id, n_words (runs of anything but space and \\t to \\r), word_chars (their code points), n_symbols
    (characters of #*$%&|<>), n_dup_lines (\\n-split lines with a word that equal an earlier line), n_repeat_words (words in
    three-word windows that the text has twice or more), ratio and chunk_ratios (zstandard), reason (why the bands reject the
    text, or empty), base_failed (n_words < min_words, or over repeat_percent of the words repeat) and kept.

    A null text counts as empty: no words, null ratio, reason "empty". Texts of a chunk or less have no chunk ratios. Rows are
    judged one by one, so repeated rows get equal results; a null doc_id stays null. Other columns are ignored. An empty table
    gives no rows.
    """
    ddl = f"doc_id long, {', '.join(f'{k} long' for k in NAMES)}, ratio double, chunk_ratios array<double>, reason string"
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(T.lean(judge), ddl)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("reason") == ""))


def op9(spark, sf_dir: str) -> DataFrame:
    out = quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", *NAMES, "base_failed", "kept", "ratio", "reason")
