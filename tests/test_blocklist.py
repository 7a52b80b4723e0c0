"""The keyword automaton and the index of phrases against plain searches."""

from __future__ import annotations

import difflib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import blocklist


def plain(text, keywords, whole):
    text = text or ""
    hit = (lambda k: re.search((r"(?a)\b" if re.match(r"(?a)\w", k) else r"(?a)\b") + re.escape(k) + r"\b", text)) if whole else (lambda k: k in text)
    return sorted({k for k in keywords if k and hit(k)})


def texts(rng, n):
    words = ["a", "aa", "ab", "b", "ba", "é", "_", "x1", "ba ab", "-", "??", "\n", "", "\0"]
    return ["".join(rng.choice(words) + rng.choice(["", " ", ""]) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("whole", [True, False])
@pytest.mark.parametrize("lane", [512, 8])
def test_keywords(spark, whole, lane, monkeypatch):
    """Keywords within each other, across lanes, at the ends of texts, with white space and punctuation; nulls and empty texts."""
    monkeypatch.setattr(blocklist, "LANE", lane)
    rng = random.Random(8)
    keywords = ["a", "ab", "aab", "ba ab", "é", "b?", "?", "_", "x1", "x", "", "ab", "aa a", "b" * 40]
    rows = [*texts(rng, 200), None, "", "a", "ab", "b" * 100, ("b" * 40 + " ") * 30, " " * 600 + "ab", "z" * 5000 + "x1"]
    find = blocklist.keyword_finder(spark, keywords, whole)
    got = spark.createDataFrame(list(enumerate(rows)), "i int, x string").repartition(2).select("i", find(F.col("x")).alias("k")).collect()
    assert {r.i: r.k for r in got} == {i: plain(x, keywords, whole) for i, x in enumerate(rows)}
    assert spark.createDataFrame([], "x string").select(find(F.col("x"))).collect() == []
    none = blocklist.keyword_finder(spark, ["", ""], whole)
    assert spark.createDataFrame([("a",)], "x string").select(none(F.col("x")).alias("k")).first().k == []


def test_tables_of_ten_thousand_keywords():
    """The tables' size, and a pass over a text that is every keyword."""
    rng = random.Random(9)
    keywords = sorted({"".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 9))) for _ in range(12_000)})[:10_000]
    auto = blocklist.build_automaton(keywords)
    assert auto.step.nbytes < 5 << 20 and auto.keywords == keywords
    data = np.frombuffer(" ".join(keywords).encode(), np.uint8)
    assert sorted(set(blocklist.scan(auto, data, np.array([0, len(data)]), True)[1].tolist())) == list(range(10_000))


def test_list_that_is_too_large(monkeypatch):
    monkeypatch.setattr(blocklist, "MOST_BYTES", 1000)
    with pytest.raises(ValueError, match="divide the list"):
        blocklist.build_automaton([f"keyword {i}" for i in range(100)])


@pytest.mark.parametrize("slack", [0.4, 1.0, 2.5, 9.0])
def test_near_hits_are_those_of_every_window(spark, slack):
    rng = random.Random(int(slack * 10))
    alphabet = "aaabcdeé"
    word = lambda: "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 9)))
    phrases = [" ".join(word() for _ in range(rng.randint(1, 3))) for _ in range(60)] + ["aaaaaa", "aaaaaaa", "ababab"]

    def bent(w):
        i = rng.randrange(len(w) + 1)
        return w[:i] + rng.choice(["", "z", "a"]) + w[i + rng.choice([0, 1]) :]

    rows = [" ".join([word(), bent(rng.choice(phrases)), word()]) for _ in range(150)] + [" ".join(word() for _ in range(20)) for _ in range(50)] + ["", None, "aaaaaa aaaaa", "a  b"]
    want = set()
    for i, x in enumerate(rows):
        for w in phrases:
            parts, n = (x.split(" ") if x is not None else []), len(w.split())
            if len(w) >= 6 and any(difflib.SequenceMatcher(None, " ".join(parts[k : k + n]), w).ratio() >= (len(w) - slack) / len(w) for k in range(len(parts) - n + 1)):
                want.add(i)
    df = spark.createDataFrame([(i, x, "c", "c") for i, x in enumerate(rows)], "i int, x string, _n string, phrase string")
    assert {r.i for r in blocklist.near_hits(df, "i", "x", phrases, slack).collect()} == want and want
    assert blocklist.near_hits(df, "i", "x", [], slack).collect() == [] and blocklist.near_hits(df.limit(0), "i", "x", phrases, slack).collect() == []


def test_few_pairs_are_judged():
    """1,000 phrases and 2,000 texts of 30 words: difflib sees under 1 % of the 60 million pairs."""
    rng = random.Random(11)
    syllables = ["ta", "ri", "mo", "ne", "ko", "lu", "xa", "en", "or", "si"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(2, 4)))
    phrases = sorted({w for w in (word() for _ in range(4000)) if len(w) >= 6})[:1000]
    index = blocklist.index_phrases(phrases, 1.0)
    known = {}
    found = blocklist.near_phrases(index, [" ".join(word() for _ in range(30)) for i in range(2000)], known)
    assert len(known) < 600_000 and any(found)


def test_long_texts_and_slices(spark, monkeypatch):
    """Slices of few characters, texts longer than one, and phrases at their ends."""
    monkeypatch.setattr(blocklist, "SLICE", 50)
    monkeypatch.setattr(blocklist, "KEPT", 1)
    rows = ["word " * 40 + "badwird", "badwrd" + " word" * 40, "x", None, "", "badword", "a badword"] * 3
    find = blocklist.near_finder(spark, ["badword", "a  badword", "tiny"], 1.0)
    got = [r.k for r in spark.createDataFrame([(x,) for x in rows], "x string").coalesce(1).select(find(F.col("x")).alias("k")).collect()]
    assert got == [["badword"], ["badword"], [], [], [], ["badword"], ["a badword", "badword"]] * 3
    assert spark.createDataFrame([("x",)], "x string").select(blocklist.near_finder(spark, [], 1.0)(F.col("x")).alias("k")).first().k == []


def test_pairs_are_ruled_out_by_characters_in_order():
    """As a plain table of longest common subsequences does; what is ruled out is not near."""
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcd"), rng.integers(6, 14)))
    phrases = sorted({word() for _ in range(60)})
    index = blocklist.index_phrases(phrases, 1.0)
    runs = [word() for _ in range(200)]
    text, starts = "".join(runs), np.cumsum([0, *map(len, runs)])[:-1]
    pairs = [(i, k) for i, r in enumerate(runs) for k in range(len(phrases)) if len(r) < index.least.shape[1] and index.least[k, len(r)] >= 0]
    run, phrase = np.array(pairs).T
    got = blocklist.in_order(index, blocklist._codes(text), starts[run], np.array([len(runs[i]) for i in run]), phrase)
    seen = set()
    for (i, k), ok in zip(pairs, got.tolist(), strict=True):
        a, b = runs[i], phrases[k]
        row = [0] * (len(b) + 1)
        for x in a:
            old, row = row, [0]
            for j, y in enumerate(b):
                row.append(old[j] + 1 if x == y else max(old[j + 1], row[-1]))
        assert ok == (row[-1] >= index.least[k, len(a)])
        assert ok or difflib.SequenceMatcher(None, a, b).ratio() < index.need[k]
        seen.add(ok)
    assert seen == {True, False}
