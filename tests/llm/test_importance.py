"""Importance resampling against a plain version."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from millrace.llm import importance
from millrace.llm.importance import crc_append, importance_resample, pack_counts, unpack_counts
from tests.llm import brute


def features(text, buckets, longest=3):
    w = brute.WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def plain(rows, target, percent=5, least=20, buckets=10_000, longest=3, seed=42):
    """[(doc_id, n_features, weight, score, rank)]; ranks are of distinct (score, doc_id) or of equal rows."""
    own = [(d, *features(t, buckets, longest)) for d, t in rows]
    s, t = collections.Counter(b for *_, f in own for b in f), collections.Counter(b for x in target for b in features(x, buckets, longest)[1])
    total, wanted = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (total + buckets) / ((s[b] + 1) * (wanted + buckets)))) for b in range(buckets)]
    out = []
    for d, n, f in own:
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([d, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    good = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], 1 << 63 if r[0] is None else r[0]))
    for i, r in enumerate(good[: percent * len(good) // 100]):
        r[5] = i + 1
    return sorted([(r[0], *r[2:]) for r in out], key=str)


def found(df):
    return sorted([tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()], key=str)


@pytest.mark.parametrize("percent,buckets,longest", [(5, 10_000, 3), (60, 7, 2), (100, 70_000, 1), (0, 1, 4)])
def test_draws(spark, docs, pairs, rows, percent, buckets, longest):
    target = [rows[0][1][:200], None, "", rows[3][1], "Some OTHER words; é ß"]
    table = spark.createDataFrame([(t, "x") for t in target], "text string, doc_id string").withColumnRenamed("doc_id", "bucket")
    got = importance_resample(docs, table, percent=percent, buckets=buckets, longest=longest)
    assert found(got) == plain(pairs, target, percent, 20, buckets, longest)


def test_query(spark):
    from millrace.llm import queries

    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert found(queries.queries()["op12_importance_resampling"](spark, sf)) == plain(rows, target)


def test_ties_go_to_the_smaller_id(spark, empty, monkeypatch):
    """Equal scores, since all hashes are; no target; no rows."""
    monkeypatch.setattr(importance.F, "conv", lambda *a: importance.F.lit("7"))
    docs = spark.createDataFrame([(i, "same words " * 15) for i in (9, 2, None, 5, 7, 5)], "doc_id long, text string")
    ranks = {(r.doc_id, r.rank) for r in importance_resample(docs, empty, percent=50).collect()}
    assert {x for x in ranks if x[1]} == {(2, 1), (5, 2), (5, 3)}
    assert importance_resample(empty, docs).collect() == []
    with pytest.raises(ValueError):
        importance_resample(docs, docs, percent=101)


def test_crc_in_columns():
    rng = random.Random(6)
    parts = [bytes(rng.randrange(256) for _ in range(n)) for n in (0, 1, 2, 5, 63, 64, 65, 300, 7)]
    buf, lens = np.frombuffer(b"".join(parts), np.uint8), np.array([len(p) for p in parts])
    starts = np.cumsum(lens) - lens
    state = np.array([zlib.crc32(b"before"[:i]) for i in range(len(parts))], np.uint32)
    assert crc_append(state, buf, starts, lens).tolist() == [zlib.crc32(p, s) for p, s in zip(parts, state.tolist(), strict=True)]
    assert crc_append(state[:0], buf, starts[:0], lens[:0]).tolist() == []


def test_counts_are_packed_and_unpacked():
    for kind in (np.uint16, np.uint32):
        for b, c in (([], []), ([3], [1]), ([1, 4, 9], [5, 1, 70_000])):
            bucket, count = unpack_counts(pack_counts(np.array(b, kind), np.array(c, np.uint32)), kind)
            assert dict(zip(bucket.tolist(), count.tolist(), strict=True)) == dict(zip(b, c, strict=True))
