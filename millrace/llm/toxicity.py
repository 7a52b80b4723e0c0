"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence has a score, a logistic function of its words and their beginnings; a
document's score is the noisy-or of its sentences', 1 - prod(1 - s). The weights are trained from document labels alone, and
the sentence scores then show where the offence is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from millrace.llm import textops as T
from millrace.llm.decontamination import member
from millrace.llm.scratch import Scratch

U = np.uint64
#: Bytes of the beginnings that are features of a longer word, besides the word itself.
PREFIXES = (4, 5, 6, 7, 8, 10)
IS_END = np.zeros(256, bool)
IS_END[list(b".!?\n")] = True


def sentences(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Features and the sentence of each, in no order; the first sentence of each document; sentences' bytes; sentence heads.

    Words are lower-cased alphanumeric runs; a sentence ends after . ! ? or a line break, and has a word. A feature is a hash of a
    word or of a beginning, which are told apart.
    """
    starts, ends, first = T.word_bounds(buf, offs, T.IS_ALNUM)
    sums = T.prefix(T.BYTE_VALUES[T.LOWER[buf]])
    stops = np.append(0, np.cumsum(IS_END[buf]))
    new = np.ones(len(starts), bool)
    new[1:] = stops[starts[1:]] != stops[ends[:-1]]
    new[first[:-1][first[:-1] < len(starts)]] = True
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(starts)) - 1
    of_doc = np.searchsorted(heads, first)
    sent = np.cumsum(new) - 1
    features, where = [T.span_hash(sums, starts, ends)], [sent]
    for k in PREFIXES:
        long = np.flatnonzero(ends - starts > k)
        features.append(T.mix(T.span_hash(sums, starts[long], starts[long] + k) + U(k)))
        where.append(sent[long])
    return np.concatenate(features), np.concatenate(where), of_doc, starts[heads], ends[tails] if len(heads) else heads, heads


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def association(a: np.ndarray, b: np.ndarray, pos: int, neg: int) -> np.ndarray:
    """Log-likelihood ratio of a feature that a of pos and b of neg documents have; negative if it speaks for neg."""

    def term(k, n, p):
        return k * np.log(np.maximum(k / n / p, 1e-12)) + (n - k) * np.log(np.maximum((n - k) / n / (1 - p), 1e-12))

    p = np.clip((a + b) / (pos + neg), 1e-9, 1 - 1e-9)
    return np.sign(a / pos - b / neg) * 2 * (term(a, pos, p) + term(b, neg, p))


def train(bags: list[tuple[int, np.ndarray, np.ndarray]], labels: np.ndarray, features: int, steps: int, decay: float) -> tuple[np.ndarray, float]:
    """Weights and bias; a bag is (sentences, sentence and feature of each entry). Full-batch Adam, the same on every run."""
    some = [i for i, (n, _, _) in enumerate(bags) if n]
    bags, y = [bags[i] for i in some], labels[some].astype(float)
    if not bags or not 0 < y.sum() < len(y):
        return np.zeros(features), -8.0 if not bags or not y.any() else 8.0
    n_sent = np.array([n for n, _, _ in bags])
    base = np.cumsum(n_sent) - n_sent
    sent = np.concatenate([s + b for (_, s, _), b in zip(bags, base, strict=True)])
    col = np.concatenate([f for _, _, f in bags])
    total, doc = int(n_sent.sum()), np.repeat(np.arange(len(bags)), n_sent)
    w, bias = np.zeros(features), -float(np.log(20 * n_sent.mean()))
    m, v = np.zeros(features + 1), np.zeros(features + 1)
    for t in range(1, steps + 1):
        s = sigmoid(bias + np.bincount(sent, weights=w[col], minlength=total))
        none = np.exp(np.bincount(doc, weights=np.log1p(-np.minimum(s, 1 - 1e-12)), minlength=len(bags)))
        pull = (1 - y) - y * none / np.maximum(1 - none, 1e-9)
        dz = s * pull[doc]
        grad = np.append(np.bincount(col, weights=dz[sent], minlength=features) + decay * w, dz.sum()) / len(bags)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        w, bias = w - step[:-1], bias - step[-1]
    return w, float(bias)


def features_of(chosen=None):
    """Rows (text, label, draw) to one packed value per document: its distinct features, or its bag of the chosen ones."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            out = []
            for lo, hi, buf, offs in T.text_slices(batch.column(0)):
                feature, sent, of_doc, _, _, _ = sentences(buf, offs)
                if chosen is not None:
                    hit = member(feature, chosen.value)
                    feature, sent = np.searchsorted(chosen.value, feature[hit]), sent[hit]
                o = np.lexsort((feature, sent))
                feature, sent = feature[o], sent[o]
                cuts = np.searchsorted(sent, of_doc)
                for i in range(hi - lo):
                    f, s = feature[cuts[i] : cuts[i + 1]], sent[cuts[i] : cuts[i + 1]] - of_doc[i]
                    if chosen is None:
                        out.append(T.pack(np.unique(f)))
                    else:
                        new = np.append(True, (f[1:] != f[:-1]) | (s[1:] != s[:-1])) if len(f) else np.zeros(0, bool)
                        out.append(T.pack(of_doc[i + 1 : i + 2] - of_doc[i], s[new], f[new]))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), batch.column(1), batch.column(2)], names=["data", "label", "draw"])

    return run


def counts_of(candidates):
    """Rows (text, ...) to the number of documents that have each candidate feature, a row per batch."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            total = np.zeros(len(candidates.value), np.int32)
            for _, _, buf, offs in T.text_slices(batch.column(0)):
                feature, sent, of_doc, _, _, _ = sentences(buf, offs)
                hit = member(feature, candidates.value)
                doc = np.searchsorted(of_doc, sent[hit], "right") - 1
                key = np.unique(doc * len(total) + np.searchsorted(candidates.value, feature[hit]))
                total += np.bincount(key % len(total), minlength=len(total)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array([T.pack(total)], pa.binary())], names=["data"])

    return run


def scorer(model, threshold: float):
    item = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, weights, bias = model.value
        for batch in it:
            score, where = np.zeros(batch.num_rows), [[] for _ in range(batch.num_rows)]
            for lo, hi, buf, offs in T.text_slices(batch.column(1)):
                feature, sent, of_doc, start, end, heads = sentences(buf, offs)
                if not len(heads):
                    continue
                hit = member(feature, chosen)
                f, of = np.searchsorted(chosen, feature[hit]), sent[hit]
                key = np.unique(of * max(len(chosen), 1) + f)
                z = bias + np.bincount(key // max(len(chosen), 1), weights=weights[key % max(len(chosen), 1)] if len(key) else None, minlength=len(heads))
                s = sigmoid(z)
                logs = np.append(0, np.cumsum(np.log1p(-np.minimum(s, 1 - 1e-12))))
                score[lo:hi] = 1 - np.exp(np.minimum(logs[of_doc[1:]] - logs[of_doc[:-1]], 0))
                for j in np.flatnonzero(s >= threshold).tolist():
                    row = int(np.searchsorted(of_doc, j, "right")) - 1
                    where[lo + row].append({"start": int(start[j] - offs[row]), "end": int(end[j] - offs[row]), "score": float(s[j])})
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(score), pa.array(where, item), batch.column(3)], names=["doc_id", "held_out", "score", "sentences", "row"])

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, held_out, sample_rows: int = 8000, sample_bytes: int = 24 << 20, threshold: float = 0.7, least: float = 16.0, features: int = 4096, steps: int = 400, decay: float = 0.02, carry: tuple[str, ...] = ()) -> DataFrame:
    """Score each row of docs from 0 to 1 for toxicity, as labels (doc_id, toxic 0 or 1) mark it.

    held_out is a Column over docs; labels of rows for which it is true are not learned from, and labels, lang, source and
    doc_id are no inputs. Returns doc_id, held_out, score, predicted (1 if score >= threshold) and sentences (start, end in
    bytes, and score, of those at the threshold or above).

    Null and empty texts have no sentences and score 0. Labels that are null, and rows without one, are not learned from; a
    document with several labels is learned from with each. If there is no label, or only one kind, the score says that
    kind for any text with a word. Rows are judged one by one, so repeated rows get equal results. Other columns are
    ignored. An empty table gives no rows. The training sample is bounded: about sample_rows labelled rows or sample_bytes
    of text, whichever is less, drawn by a hash of doc_id and text. The model has at most `features` features, those that speak
    most for the label, with a log-likelihood ratio of `least` or more. Every text is scored whole. carry: columns of docs to hand
    on, as the struct `row`.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out.alias("held_out"), F.struct(*(carry or ["doc_id"])).alias("row"))
    known = labels.where("toxic is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
    learn = docs.where("not coalesce(held_out, false) and text is not null")
    rows, size = learn.select("doc_id", F.octet_length("text").alias("n")).join(known, "doc_id").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    share = min(1.0, sample_rows / max(rows, 1), sample_bytes / max(size, 1))
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40))
    sample = learn.select("doc_id", "text", draw.alias("draw")).where(F.col("draw") <= share * (1 << 40))  # before the join, which so moves little text
    sample = sample.join(known, "doc_id").select("text", "label", "draw")
    sample = Scratch(spark, "toxicity").save(sample)
    pos, neg = (sample.where(F.col("label") == k).count() for k in (1, 0))
    found = sample.where("label = 1").mapInArrow(T.lean(features_of()), "data binary, label int, draw long").toLocalIterator()
    seen = [T.unpack(r.data)[0] for r in found]
    feature, a = np.unique(np.concatenate(seen), return_counts=True) if seen else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    feature, a = feature[a > 1], a[a > 1]
    b = np.zeros(len(feature), np.int64)
    if len(feature):
        shared = spark.sparkContext.broadcast(feature)
        for r in sample.where("label = 0").mapInArrow(T.lean(counts_of(shared)), "data binary").toLocalIterator():
            b += T.unpack(r.data)[0]
    strength = association(a, b, max(pos, 1), max(neg, 1)) if pos and neg else np.zeros(len(feature))
    chosen = np.sort(feature[[i for i in np.lexsort((feature, -strength))[:features] if strength[i] >= least]])
    bags = sample.mapInArrow(T.lean(features_of(spark.sparkContext.broadcast(chosen))), "data binary, label int, draw long").collect()
    bags = [(r.label, T.unpack(r.data)) for r in sorted(bags, key=lambda r: (r.draw, r.label, r.data))]
    weights, bias = train([(int(n[0]), s, f) for _, (n, s, f) in bags], np.array([k for k, _ in bags]), len(chosen), steps, decay)
    model = spark.sparkContext.broadcast((chosen, weights, bias))
    sentence = StructType().add("start", "long").add("end", "long").add("score", "double")
    schema = StructType().add("doc_id", "long").add("held_out", "boolean").add("score", "double").add("sentences", ArrayType(sentence)).add("row", docs.schema["row"].dataType)
    out = docs.mapInArrow(T.lean(scorer(model, threshold)), schema)
    if not carry:
        out = out.drop("row")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op5(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return score_toxicity(docs, labels, held).select("doc_id", "held_out", "score", "predicted")
