"""Each operator against its plain version on one small corpus of odd rows, and on no rows."""

from __future__ import annotations

import base64
import collections
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

from millrace.llm import near_duplicates as near_module
from millrace.llm import repeats, textops
from millrace.llm.decontamination import decontaminate
from millrace.llm.graph import components
from millrace.llm.language_id import identify_languages, parse_table, phrase_counts
from millrace.llm.near_duplicates import dedup_near, near_duplicate_groups
from millrace.llm.packing import best_fit_packing, pack
from millrace.llm.pitman_yor import DISCOUNT, STRENGTH, Level, backoff, pack, sample, score_texts, unpack
from millrace.llm.quality_rules import NAMES, quality_rules
from millrace.llm.scratch import Scratch
from millrace.llm.sharding import balanced_shards
from millrace.llm.simhash import Links, block_plan, forest, reorder, simhash_classes, trie_pairs
from millrace.llm.substring_dedup import substring_dedup
from millrace.llm.suffix_array_dedup import lcp_intervals, maximal_repeats, suffix_array_dedup
from millrace.llm.toxicity import score_toxicity, scorer, sentences
from millrace.llm.xxh64 import xxh64
from tests.llm import brute


def held():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def by_id(pairs, result):
    """Expected results as a multiset of (doc_id, *result)."""
    return collections.Counter((d, *result[d, t]) for d, t in pairs)


def found(df, *columns):
    return collections.Counter(tuple(r) for r in df.select("doc_id", *columns).collect())


@pytest.mark.parametrize("hot", [20_000, 2])
def test_suffix_array_dedup(docs, pairs, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT_UNITS", hot)
    out = suffix_array_dedup(docs, part_bytes=4096).select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("r"), F.size("spans").alias("s"), F.sha2("kept", 256).alias("h"))
    assert found(out, "n_bytes", "r", "s", "h") == by_id(pairs, brute.repeated_bytes(pairs))


@pytest.mark.parametrize("hot", [20_000, 2])
def test_substring_dedup(docs, pairs, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT_UNITS", hot)
    out = substring_dedup(docs, part_bytes=4096)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    out = out.select("doc_id", "n_words", removed.alias("r"), F.sha2(F.encode("kept", "UTF-8"), 256).alias("h"))
    assert found(out, "n_words", "r", "h") == by_id(pairs, brute.repeated_words(pairs))


def test_decontamination(spark, docs, pairs, rows):
    words = [r[1].split() for r in rows[:4]]
    items = [(1, " ".join(words[0][:20])), (20, " ".join(words[1][2:6]).upper()), (3, None), (None, " ".join(words[2][:15])), (3, ""), (3, words[3][0]), (1, " ".join(words[0][1:16]))]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("row", F.lit(1))
    want = by_id(pairs, brute.contamination(pairs, items))
    for block, each in ((1 << 20, 16), (40, 64), (40, 3)):
        out = decontaminate(docs, bench, block_bytes=block, blocks_each=each)
        out = out.select("doc_id", "n_words", "n_hit", F.size("items").alias("n"), F.sha2(F.array_join("items", ","), 256).alias("h"), "contaminated")
        assert found(out, "n_words", "n_hit", "n", "h", "contaminated") == want


def test_quality_counts(docs, pairs):
    out = quality_rules(docs)
    assert found(out, *NAMES, "base_failed") == by_id(pairs, {(d, t): brute.counts(t) for d, t in pairs})
    bad = {r.doc_id for r in out.where("reason like 'repetitive%'").collect()}
    assert {d for d, t in pairs if t and (t.startswith("na na") or t.startswith("abab"))} <= bad


def test_quality_of_any_chunk(spark):
    """Base64 of random bytes, and one bad chunk or tail in a text of good ones, are rejected; prose is not."""
    rng = np.random.default_rng(6)
    vocabulary = ["".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 10))) for _ in range(900)]
    prose = lambda n: " ".join(vocabulary[i] for i in rng.zipf(1.3, n) % 900)
    code = lambda n: "\n".join(base64.b64encode(rng.bytes(57)).decode() for _ in range(n // 77 + 1))[:n]
    phrase = ("the same old words " * 300)[:4096]
    bad = [code(6_000), code(20_000), prose(3000)[:8192] + phrase + prose(3000)[:8192], prose(3000)[:8192] + code(4_000)]
    rows = list(enumerate([*bad, prose(3000), prose(800)]))
    got = {r.doc_id: r.reason for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] for i in range(4)) and got[4] == got[5] == ""


def test_simhash(docs, pairs):
    print_of = {(d, t): brute.fingerprint(t) for d, t in pairs}
    ids = [p for p in dict.fromkeys(pairs)]
    n = {p: i for i, p in enumerate(ids)}
    label = brute.components(range(len(ids)), lambda i, j: bin(print_of[ids[i]] ^ print_of[ids[j]]).count("1") <= 3)
    least = collections.defaultdict(list)
    for p in ids:
        least[label[n[p]]].append(brute.key(p[0]))
    want = {p: (f"{print_of[p]:016x}", min(least[label[n[p]]])) for p in ids}
    out = simhash_classes(docs).withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))
    assert found(out, "fingerprint", "component_id") == by_id(pairs, want)


def test_trie_join_is_every_pair():
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 1 << 62, 6, dtype=np.uint64)
    x = np.unique(np.concatenate([c ^ (np.uint64(1) << rng.integers(0, 64, 40, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 40, dtype=np.uint64)) for c in centre]))
    want = {(min(a, b), max(a, b)) for a in x.tolist() for b in x.tolist() if a != b and (a ^ b).bit_count() <= 3}
    for nodes in (10, 10**7):
        got = set()
        for top, *order in block_plan(nodes, 64, 3):
            y = reorder(x, tuple(order), 64)
            o = np.argsort(y)
            for i, j in trie_pairs(y[o], top, 64, 3, leaf=4, most=64):
                got |= {(min(a, b), max(a, b)) for a, b in zip(x[o][i].tolist(), x[o][j].tolist())}
        assert got == want
        x = np.sort(x)
        links = Links(len(x), settled=1)
        for i, j in trie_pairs(x, 0, 64, 3, links):
            links.add(i, j)
        assert len(set(links.label)) == len(set(brute.components(x.tolist(), lambda a, b: (a ^ b).bit_count() <= 3).values()))
    assert forest(np.arange(5), np.array([4, 3]), np.array([3, 1])).tolist() == [0, 1, 2, 1, 1]


def test_xxh64():
    rng = np.random.default_rng(2)
    buf = rng.integers(0, 256, 3000, dtype=np.uint8)
    start = rng.integers(0, 1500, 300)
    end = start + rng.integers(0, 400, 300)
    assert xxh64(buf, start, end).tolist() == [xxhash.xxh64_intdigest(buf[a:b].tobytes(), 42) for a, b in zip(start, end)]


def test_maximal_repeats():
    assert sorted(lcp_intervals([0, 2, 1, 0, 3])) == [(1, 0, 2), (2, 0, 1), (3, 3, 4)]
    left, right = [b"ab", b"ab", b"xb", b""], [b"cdef", b"cdzz", b"cdef", b"q"]
    got = sorted(maximal_repeats(np.zeros(4, np.uint64), np.arange(4), left, right, 3))
    assert got == [(0, 4, [0, 2]), (2, 2, [0, 1])]


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (7, 7)], "u long, v long")
    roots = {r.node: r.root for r in components(edges, Scratch(spark, "t")).collect()}
    assert len({roots[i] for i in range(41)}) == 1 and roots[100] == roots[102] != roots[0]


def test_language(spark):
    words = {"a": ["uvu", "vuvv", "uu"], "b": ["xyx", "yyx", "xx"]}
    texts = [(i, " ".join(words["ab"[i % 2]][(i * k) % 3] for k in range(30)), "ab"[i % 2]) for i in range(40)]
    texts += [(50, None, "a"), (51, "12 -- 3", "b"), (52, "", None), (53, "uvu", None), (2, texts[2][1], "a")]
    out = identify_languages(spark.createDataFrame(texts, "doc_id long, text string, lang string").withColumn("row", F.lit(0)), held())
    got = {r.doc_id: r for r in out.collect()}
    assert all(got[i].lang_pred == "ab"[i % 2] and 0.5 < got[i].score <= 1 for i in range(40)) and got[53].lang_pred == "a"
    assert [got[i].lang_pred for i in (50, 51, 52)] == ["und"] * 3 and out.count() == len(texts)
    assert all(got[i].held_out == (brute.crc(i) % 4 == 2) for i in got)


def test_phrases_are_one_parse():
    """Texts of many pieces have the phrases of a plain greedy parse from the first symbol to the last."""
    rng = np.random.default_rng(2)
    for letters in (2, 5):
        samples = [rng.integers(0, letters, 400).astype(np.uint8) for _ in range(2)]
        samples[1] = np.tile(samples[1][:60], 6)
        texts = [rng.integers(0, letters + 1, n) for n in (0, 1, 511, 512, 513, 3000)] + [np.tile(samples[1], 9), np.zeros(4000, int)]
        tables = [parse_table([x], 28) for x in samples]
        roots = np.cumsum([0, *(len(t) for t in tables)])[:-1]
        stacked = np.concatenate([t + 2 * r for t, r in zip(tables, roots)]).astype(np.int32)
        got = phrase_counts(np.concatenate(texts).astype(np.uint8), np.cumsum([0, *map(len, texts)]), stacked, roots)
        for k, sample_ in enumerate(samples):
            held = bytes(sample_)
            for j, text in enumerate(texts):
                raw, at, n = bytes(text.astype(np.uint8)), 0, 0
                while at < len(raw):
                    long = 1
                    while at + long < len(raw) and raw[at : at + long + 1] in held:
                        long += 1
                    at, n = at + long, n + 1
                assert got[k, j] == n


def test_language_of_other_scripts(spark):
    """Scripts whose bytes differ in few places, ties, repeated rows and a long text."""
    words = {"ru": ["мир", "река", "дом", "лес"], "uk": ["ліс", "ріка", "їжа", "єнот"], "ja": ["かな", "やま", "かわ"]}
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice(words[k], 30)), k) for i, k in enumerate(["ru", "uk", "ja"] * 30)]
    rows += [(900, " ".join(["їжа"] * 150_000), "uk"), rows[0], (901, "xyz", None)]
    out = identify_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"), held()).collect()
    assert len(out) == len(rows) and all(r.lang_pred == {d: k for d, _, k in rows}[r.doc_id] for r in out if r.doc_id != 901)


def test_language_of_long_texts(spark):
    """A language whose labelled texts are all longer than the sample is learned."""
    words = {"a": "uvu vuvv uu ", "b": "xyx yyx xx "}
    rows = [(i, words["ab"[i % 2]] * (20 if i % 2 else 4000), "ab"[i % 2]) for i in range(24)]
    out = identify_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"), held()).collect()
    assert all(r.lang_pred == "ab"[r.doc_id % 2] for r in out) and len(out) == 24


@pytest.mark.parametrize("part_bytes", [4096, 1 << 20])
def test_language_model(docs, pairs, part_bytes):
    is_held = lambda d: d is not None and brute.crc(d) % 4 == 2
    want = brute.base_scores(pairs, is_held)
    out = score_texts(docs, held(), part_bytes=part_bytes).collect()
    assert collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in out) == collections.Counter((d, *want[d, t][:4]) for d, t in pairs)
    base = collections.defaultdict(list)
    for d, t in pairs:
        base[d].append(want[d, t][4])
    assert all(any(abs(r.base_score - b) < 1e-6 * abs(b) + 1e-9 for b in base[r.doc_id]) and r.score < 0 for r in out)
    own = [r for r in out if not r.held_out]
    assert sum(r.score for r in own) > sum(r.base_score for r in own)


@pytest.mark.parametrize("part_bytes", [1 << 14, 12 << 20])
def test_scores_do_not_depend_on_how_texts_lie(docs, part_bytes):
    """The same rows in 1, 4 and 7 tasks, in another order."""
    of = lambda df: sorted((r.doc_id or 0, r.n_tokens, r.n_known, r.base_score, r.score) for r in score_texts(df, held(), part_bytes=part_bytes).collect())
    first = of(docs.coalesce(1))
    for n in (4, 7):
        other = of(docs.repartition(n, F.xxhash64("doc_id", F.lit(n))))
        assert [x[:3] for x in other] == [x[:3] for x in first] and np.allclose([x[3:] for x in other], [x[3:] for x in first], rtol=0, atol=1e-9)


def test_tokens_are_sent_once(docs):
    """Both rounds of sweeps read the same exchange of requests."""
    out = score_texts(docs, held(), part_bytes=1 << 14)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange [part" in plan


def test_packed_numbers():
    """Of any width, and none."""
    arrays = [np.array([3, 1 << 60, 5], np.uint64), np.zeros(0, np.int64), np.array([-2, 7]), np.arange(300, dtype=np.uint32), np.array([0.5, -1.25], np.float32), np.array([9], np.uint8)]
    back = unpack(pack(*arrays))
    assert [x.dtype for x in back] == [x.dtype for x in arrays] and all((x == y).all() for x, y in zip(arrays, back, strict=True))


@pytest.mark.parametrize("customers", [100, 1000, 3000])
@pytest.mark.parametrize("p", [0.02, 0.5])
def test_tables_of_many_customers(customers, p):
    """Restaurants of one dish: the mean number of tables after some sweeps is that of the exact law."""
    d, theta, most = DISCOUNT[2], STRENGTH[2], 100
    log_s = np.append(0.0, np.full(most, -np.inf))
    for c in range(customers):
        stay = log_s + np.log(np.maximum(c - d * np.arange(most + 1), 1e-300))
        log_s = np.logaddexp(stay, np.append(-np.inf, log_s[:-1]))
    weight = log_s[1:] + np.cumsum(np.log((theta + d * np.arange(most)) * p))
    weight = np.exp(weight - weight.max())
    want = (weight * np.arange(1, most + 1)).sum() / weight.sum()
    level = Level(d, theta, np.arange(4000), np.zeros(4000, np.int64), np.full(4000, customers))
    rng = np.random.default_rng(1)
    for _ in range(8):
        level.move(np.full(4000, p), rng)
    assert abs(level.t.mean() - want) < 0.05 * want


def levels_of(counts, d, theta):
    """Levels of (near, far, word): count."""
    rows = sorted(counts)
    far = np.unique([n * 100 + f for n, f, _ in rows], return_inverse=True)[1]
    leaf = Level(d, theta, far, np.array([w for _, _, w in rows]), np.array([counts[r] for r in rows]))
    pairs, leaf.up = np.unique([n * 100 + w for n, _, w in rows], return_inverse=True)
    mid = Level(d, theta, pairs // 100, pairs % 100, np.bincount(leaf.up, weights=leaf.t))
    return mid, leaf


def test_sampler_keeps_its_seating():
    """After every sweep a level's customers are the tables below, and P sums to 1 with what goes to the root."""
    rng = np.random.default_rng(8)
    counts = collections.Counter(tuple(rng.integers(0, (3, 4, 12)).tolist()) for _ in range(900))
    mid, leaf = levels_of(counts, 0.4, 1.0)
    root = rng.dirichlet(np.ones(12))
    for _, (p, q) in sample([mid, leaf], root, 24, 0, 1):
        assert (np.bincount(leaf.up, weights=leaf.t, minlength=len(mid.c)) == mid.c).all()
        for level in (mid, leaf):
            assert (level.t >= 1).all() and (level.t <= level.c).all()
        whole = np.bincount(mid.rest, weights=p) + backoff(mid) * (1 - np.bincount(mid.rest, weights=root[mid.symbol]))
        assert whole == pytest.approx(np.ones(mid.n_rest))
        table = np.outer(backoff(mid), root)
        table[mid.rest, mid.symbol] = p
        near = np.zeros(leaf.n_rest, np.int64)
        near[leaf.rest] = mid.rest[leaf.up]
        whole = np.bincount(leaf.rest, weights=q) + backoff(leaf) * (1 - np.bincount(leaf.rest, weights=table[near[leaf.rest], leaf.symbol]))
        assert whole == pytest.approx(np.ones(leaf.n_rest))


def test_sampler_against_customers_one_by_one():
    """Mean predictive probabilities of a tiny corpus equal those of a plain Chinese restaurant franchise."""
    rng = np.random.default_rng(9)
    counts = collections.Counter(tuple(rng.integers(0, (2, 2, 5)).tolist()) for _ in range(60))
    root = np.array([0.4, 0.3, 0.1, 0.1, 0.1])
    d, theta = 0.4, 1.0
    want = brute.franchise(counts, root, d, theta, sweeps=1500, burn_in=100, seed=3)
    got, n = collections.Counter(), 0
    mid, leaf = levels_of(counts, d, theta)
    for level in (mid, leaf):
        level.draw_strength = lambda rng: None
    for _, (_, q) in sample([mid, leaf], root, 1500, 100, 2):
        n += 1
        for key, x in zip(sorted(counts), q.tolist(), strict=True):
            got[key] += x
    for key in counts:
        assert got[key] / n == pytest.approx(want[key], abs=0.012)


class CountingRng:
    """A generator that counts the variables it is asked for."""

    def __init__(self, seed):
        self.rng, self.drawn = np.random.default_rng(seed), 0

    def __getattr__(self, name):
        def draw(*args):
            out = getattr(self.rng, name)(*args)
            self.drawn += np.size(out)
            return out

        return draw


def test_sweep_draws_for_dishes_that_choose():
    """Restaurants whose dishes have one customer each, as most have, ask for no variable of their own in a sweep."""
    n = 100_000
    customers = np.ones(2 * n, np.int64)
    customers[:20] = 5
    level, rng = Level(0.5, 1.0, np.repeat(np.arange(n), 2), np.tile(np.arange(2), n), customers), CountingRng(1)
    level.move(np.full(20, 0.1), rng)
    level.draw_strength(rng)
    assert rng.drawn < 1000
    assert (level.t[20:] == 1).all() and (level.t[:20] >= 1).all() and (level.c == customers).all()


def test_strength_is_drawn_from_its_law():
    """Mean and spread of a strength equal those by a beta variable for each restaurant and a Bernoulli one for each table."""
    rng = np.random.default_rng(5)
    sizes = [1, 1, 1, 2, 3, 5, 40, 128, 129, 130, 300]  # dishes of a restaurant
    context = np.repeat(np.arange(len(sizes)), sizes)
    customers = np.where(rng.random(len(context)) < 0.7, 1, rng.integers(2, 60, len(context)))
    customers[context == 9] = 1  # a large restaurant without a choice
    level = Level(0.4, 1.0, context, np.arange(len(context)), customers)
    c, t = (np.bincount(context, weights=x).astype(int) for x in (level.c, level.t))
    assert [x.tolist() for x in level.totals()] == [c.tolist(), t.tolist()]
    place = np.concatenate([np.arange(1, x) for x in t])
    got, want = [], []
    for _ in range(4000):
        level.theta = 3.0
        level.draw_strength(rng)
        got.append(level.theta)
        ones = (rng.random(len(place)) < 3.0 / (3.0 + 0.4 * place)).sum()
        want.append(rng.gamma(1.0 + ones, 1 / (1 - np.log(rng.beta(4.0, c[c > 1] - 1)).sum())))
    assert np.mean(got) == pytest.approx(np.mean(want), rel=0.02) and np.std(got) == pytest.approx(np.std(want), rel=0.08)


def test_probabilities_of_dishes_that_choose():
    """As by the formula, for every dish and for those that choose alone; a dish without customers has what the parent gives."""
    rng = np.random.default_rng(6)
    context = np.sort(rng.integers(0, 60, 500))
    context = np.unique(context, return_inverse=True)[1]
    customers = rng.integers(0, 4, 500)
    level, parent = Level(0.3, 1.7, context, np.arange(500), customers), rng.random(500)
    level.move(parent[level.many], rng)
    c, t = (np.bincount(context, weights=x)[context] for x in (level.c, level.t))
    want = (level.theta + level.d * t) / (level.theta + c) * parent + (level.c - level.d * level.t) / (level.theta + c)
    assert level.predictive(parent) == pytest.approx(want, rel=1e-12)
    assert level.predictive_of_many(parent[level.many]) == pytest.approx(want[level.many], rel=1e-12)


def test_language_model_learns(spark):
    """Words after words are learned beyond their frequency, also with words that are divided over parts."""
    rng = np.random.default_rng(4)
    follow = rng.integers(0, 40, (40, 3))
    texts = []
    for i in range(300):
        w = [int(rng.integers(0, 40))]
        for _ in range(60):
            w.append(int(follow[w[-1], rng.integers(0, 3)]))
        texts.append((i, " ".join(f"w{x}" for x in w)))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    for part_bytes in (1 << 20, 2000):
        out = [r for r in score_texts(df, held(), part_bytes=part_bytes).collect() if r.held_out]
        assert len(out) > 50 and sum(r.score for r in out) > 0.6 * sum(r.base_score for r in out)


def test_toxicity(spark):
    rows, labels = [], []
    for i in range(120):
        bad = i % 4 == 0
        rows.append((i, f"Plain words here {i % 7}. " + ("You are a vilething now. " if bad else "You are a friend now. ") + "The end.", "z"))
        labels.append((i, int(bad)))
    rows += [(500, None, "z"), (501, "", "z"), (502, "\n..", "z"), (503, "Quiet day. Such a VILETHING! Quiet night.", "z"), (0, rows[0][1], "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string").withColumn("row", F.lit(1))
    out = score_toxicity(docs, spark.createDataFrame([*labels, (3, None), (None, 1)], "doc_id long, toxic int"), held())
    got = {r.doc_id: r for r in out.collect()}
    assert all(got[i].predicted == (i % 4 == 0) and 0 <= got[i].score <= 1 for i in range(120)) and out.count() == len(rows)
    assert [got[i].score for i in (500, 501, 502)] == [0, 0, 0]
    (s,) = got[503].sentences
    assert rows[123][1].encode()[s.start : s.end] == b"Such a VILETHING"


def test_packing(docs, pairs):
    size = collections.Counter()
    for d, t in pairs:
        size[d] += len(brute.data(t).split()) + 1
    out = best_fit_packing(docs, capacity=200, source_limit=2, group_rows=30).collect()
    got = collections.Counter()
    bins = collections.defaultdict(list)
    for r in out:
        got[r.doc_id] += r.n_tokens
        bins[r.bin_id].append(r)
    assert got == size
    text = dict(pairs)
    for rows in bins.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.bin_offset):
            assert r.bin_offset == at
            at += r.n_tokens
        assert at == rows[0].bin_tokens <= 200
        whole = [text[r.doc_id] for r in rows if len(brute.data(text[r.doc_id]).split()) < 200]
        assert len(whole) == len(set(whole))


def test_packing_takes_the_tightest_bin():
    """Each piece is in the fullest bin that it fits, that has room for its source and none of its cluster; a new one only if there is none."""
    rng = np.random.default_rng(6)
    n, capacity, limit = 400, 60, 3
    size, source = rng.integers(1, 30, n), [f"s{x}" for x in rng.integers(0, 5, n)]
    cluster = rng.integers(0, 150, n)
    order = np.lexsort((np.arange(n), -size))
    bins, offset, fill = pack(size, source, cluster, order, capacity, limit)
    held = collections.defaultdict(list)
    for i in order.tolist():
        used = {b: sum(size[j] for j in x) for b, x in held.items()}
        good = [b for b, x in held.items() if used[b] + size[i] <= capacity and cluster[i] not in {cluster[j] for j in x} and sum(source[j] == source[i] for j in x) < limit]
        if good:
            assert used[bins[i]] == max(used[b] for b in good) and bins[i] in good
        else:
            assert bins[i] not in held
        assert offset[i] == used.get(bins[i], 0)
        held[bins[i]].append(i)
    assert all(fill[i] == sum(size[j] for j in held[bins[i]]) for i in range(n))


def test_packing_copies_over_capacity(spark):
    """Equal pieces of equal long texts never share a bin."""
    texts = [(i, " ".join(f"w{k % 977}" for k in range(3000)), f"s{i}") for i in range(3)]
    out = best_fit_packing(spark.createDataFrame(texts, "doc_id long, text string, source string")).collect()
    assert len(out) == 6 and len({(r.bin_id, r.piece) for r in out}) == 6


def test_sharding(docs, pairs):
    out = balanced_shards(docs, shards=5).collect()
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in out) == collections.Counter((d, len(brute.data(t)) + 1, zlib.crc32(brute.data(t))) for d, t in pairs)
    slots = collections.defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert sorted(len(v) for v in slots.values())[-1] - min(len(slots.get(s, [])) for s in range(5)) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    home = collections.defaultdict(set)
    for r in out:
        if r.size > 1:  # null and empty texts are two groups of one size
            home[r.text_crc32, r.size].add(r.shard)
    assert all(len(v) == 1 for v in home.values())


def shingle_set(text):
    w = brute.data(text).translate(brute.LOWER).split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def near_components(texts):
    """Component of each text, by every pair's Jaccard similarity."""
    sets = [shingle_set(t) for t in texts]
    label = brute.components(range(len(texts)), lambda i, j: len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9)
    return [label[i] for i in range(len(texts))]


@pytest.mark.parametrize("many", [1_000_000, 5])
def test_near_duplicates(spark, docs, pairs, monkeypatch, many):
    monkeypatch.setattr(near_module, "MANY", many)
    group = {r.key: r.group_id for r in near_duplicate_groups(docs).collect()}
    keys = {r.text: r.k for r in docs.select("text", F.xxhash64("text").alias("k")).collect()}
    texts = list(keys)
    want = near_components(texts)
    assert len({(w, group[keys[t]]) for w, t in zip(want, texts, strict=True)}) == len(set(want)) == len(set(group.values()))
    clashing = docs.withColumnsRenamed({"row": "_doc", "tag": "_key", "kind": "one"})
    kept = dedup_near(clashing)
    assert kept.columns == clashing.columns
    got = kept.collect()
    assert len(got) == len({r.doc_id for r in got}) == len(set(want)) and {(r._doc, r._key, r.one) for r in got} == {("clash",) * 3}


def test_near_duplicates_of_all_similarities(spark, monkeypatch):
    """Families of revisions from 0.6 up to 1: the groups are those of every pair, also where long lists are met in blocks."""
    rng = np.random.default_rng(11)
    texts = []
    for size in (30, 80, 160):
        original = [f"w{i}" for i in rng.integers(0, 10**6, size)]
        for _ in range(25):
            words = list(original)
            for at in rng.integers(0, size, rng.integers(0, 6)):
                words[at] = f"v{rng.integers(0, 10**6)}"
            texts.append(" ".join(words[: size - rng.integers(0, 5)]))
    want = near_components(texts)
    monkeypatch.setattr(near_module, "BLOCK", 7)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    group = {r.doc_id: r.group_id for r in near_duplicate_groups(df).collect()}
    assert 3 < len(set(want)) < 70 and [group[i] for i in range(len(texts))] == [min(j for j, w in enumerate(want) if w == x) for x in want]


def test_long_lists_of_near_copies_make_few_pairs():
    """300 copies near an original and not each other in one list: likely pairs join it with one each, and the parities keep every similar pair."""
    rng = np.random.default_rng(5)
    original = set(rng.integers(0, 1 << 62, 500).tolist())
    sets = [original, *({*sorted(original)[:-40], *rng.integers(0, 1 << 62, 40).tolist()} if k < 30 else original - set(rng.choice(sorted(original), 40, False).tolist()) | set(rng.integers(0, 1 << 62, 40).tolist()) for k in range(300))]
    h = [np.array(sorted(x), np.uint64) for x in sets]
    bits = np.zeros((len(sets), near_module.PARITIES), np.int64)
    for row, x in zip(bits, h, strict=True):
        np.add.at(row, (textops.mix(x) % np.uint64(near_module.PARITIES)).astype(np.int64), 1)
    packed = np.packbits((bits & 1).astype(bool), axis=1)
    m = len(sets)
    columns = {"h": np.ones(m, np.int64), "key": np.arange(m)[::-1], "n": np.array([len(x) for x in sets], np.int32), "place": np.zeros(m, np.int32), "root": np.arange(m), "side": np.zeros(m, np.int32), "degree": np.array([9] + [3] * (m - 1))}
    batch = pa.RecordBatch.from_arrays([*(pa.array(x) for x in columns.values()), pa.array([x.tobytes() for x in packed])], names=[*columns, "bits"])
    pairs = {tuple(sorted((m - 1 - u, m - 1 - v))) for b in near_module.forests(0.8)(iter([batch])) for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)}
    assert pairs <= {(0, k) for k in range(1, m)} and len(pairs) > 280
    similar = lambda a, b: len(a & b) >= 0.8 * len(a | b)
    every = {tuple(sorted((m - 1 - u, m - 1 - v))) for b in near_module.pairs_between(0.8)(iter([batch])) for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)}
    want = {(i, j) for i in range(m) for j in range(i + 1, m) if similar(sets[i], sets[j])}
    assert want <= every and len(every) < m * (m - 1) // 4


def near_groups(spark, texts):
    """Number of groups that near_duplicate_groups() makes of texts."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return len({r.group_id for r in near_duplicate_groups(df).collect()})


def test_near_duplicates_far_from_the_first(spark):
    """Variants at 0.87 to the original and 0.76 to each other: two words of 150 are changed, at other places in each."""
    rng = np.random.default_rng(3)
    original = [f"w{i}" for i in rng.integers(0, 10**6, 150)]
    texts = []
    for v in range(150):
        words = list(original)
        for at in (5 + rng.integers(0, 60), 75 + rng.integers(0, 60)):
            words[at] = f"v{v}"
        texts.append(" ".join(words))
    assert near_groups(spark, [*texts, " ".join(original)]) == 1


@pytest.mark.parametrize("many", [1 << 24, 5])
def test_near_duplicates_at_the_limit(spark, monkeypatch, many):
    """Pairs of a similarity of exactly 0.8, and just below it: 80 and 79 shingles shared of 100."""
    monkeypatch.setattr(near_module, "MANY", many)
    rng = np.random.default_rng(4)
    texts, below = [], []
    for _ in range(150):
        w = [f"w{i}" for i in rng.integers(0, 10**6, 104)]
        texts += [" ".join(w), " ".join(w[:84])]
        below += [" ".join(w), " ".join(w[:83])]
    assert near_groups(spark, texts) == 150
    assert near_groups(spark, below) == 300


def test_near_duplicates_of_few_shingles(spark):
    """A text of eight words and the same with one word more: four of five shingles."""
    rng = np.random.default_rng(5)
    texts = []
    for _ in range(100):
        w = [f"w{i}" for i in rng.integers(0, 10**6, 9)]
        texts += [" ".join(w[:8]), " ".join(w)]
    assert near_groups(spark, texts) == 100


class Value:
    def __init__(self, value):
        self.value = value


def test_noisy_or(rows):
    """Scores are 1 - prod(1 - s) over the sentences, s a logistic function of the features, also in a text of many slices."""
    texts = [r[1] for r in rows] + ["Some bad words. Fine ones!\nBad again " * 30_000]
    features, sent, _, _, _, _ = sentences(*flat_text(texts[0]))
    chosen = np.unique(features)[::3]
    weights = np.linspace(-2, 2, len(chosen))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts), pa.array([False] * len(texts)), pa.array(range(len(texts)))], names=["d", "t", "h", "r"])
    (out,) = scorer(Value((chosen, weights, -3.0)), 0.7)(iter([batch]))
    for text, score in zip(texts, out.column(2).to_pylist(), strict=True):
        want = 1.0
        for part in re.split(r"[.!?\n]", text or ""):
            found = np.unique(sentences(*flat_text(part))[0])
            if re.search(r"[A-Za-z0-9\x80-\U0010ffff]", part):
                want *= 1 - 1 / (1 + np.exp(3.0 - sum(weights[np.searchsorted(chosen, f)] for f in found if f in set(chosen.tolist()))))
            if want < 1e-12:
                break
        assert score == pytest.approx(1 - want, abs=1e-6)


def flat_text(text):
    raw = np.frombuffer((text or "").encode(), np.uint8)
    return raw, np.array([0, len(raw)])


def test_quality_verdict(docs, rows):
    """Bands of whole texts and of chunks, by a plain version."""
    got = {r.doc_id: r for r in quality_rules(docs).collect()}
    packer = zstandard.ZstdCompressor(level=3)
    ratio = lambda b: len(packer.compress(b)) / len(b)
    for d, text, *_ in rows:
        b = brute.data(text)
        ok = len(b) > 0
        if b:
            low, high = {0: (0, 9), 1: (0.15, 0.95), 2: (0.15, 0.74), 3: (0.15, 0.72), 4: (0.12, 0.70)}[sum(len(b) >= x for x in (256, 1024, 4096, 32768))]
            parts = [b[i : i + 4096] for i in [*range(0, len(b) - 4096, 4096), len(b) - 4096]] if len(b) > 4096 else []
            ok = low <= ratio(b) <= high and all(0.10 <= ratio(x) <= 0.72 for x in parts)
        assert got[d].kept == (ok and not got[d].base_failed)


@pytest.fixture(scope="module")
def long_docs(spark):
    """A text of over 1 MB, a copy of it with a few words changed, and pieces of it."""
    rng = np.random.default_rng(12)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 9))) for _ in range(5000)]
    long = [words[i] for i in rng.integers(0, 5000, 190_000)]
    other = list(long)
    for at in rng.integers(0, len(other), 40):
        other[at] = "Changed"
    rows = [(5, " ".join(long), "en"), (9, "  ".join(other), "en"), (2, " ".join(long[70_000:70_200]), "en"), (11, " ".join(long[100_000:100_040]), None), (12, None, "en")]
    assert len(rows[0][1]) > 1 << 20
    return rows, spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.mark.parametrize("name", ["op1", "op2", "op4", "op6", "op8", "op9", "op10", "near"])
def test_very_long_texts(spark, long_docs, name):
    rows, df = long_docs
    pairs = [(d, t) for d, t, _ in rows]
    if name == "op1":
        out = suffix_array_dedup(df).select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("r"), F.size("spans").alias("s"), F.sha2("kept", 256).alias("h"))
        assert found(out, "n_bytes", "r", "s", "h") == by_id(pairs, brute.repeated_bytes(pairs))
    elif name == "op2":
        items = [(1, " ".join(rows[0][1].split()[1000:1040])), (2, "zzz yyy")]
        out = decontaminate(df, spark.createDataFrame(items, "item_id long, text string"))
        assert found(out, "n_words", "n_hit") == collections.Counter((d, *x[:2]) for (d, _), x in brute.contamination(pairs, items).items())
    elif name == "op4":
        want = brute.base_scores(pairs, lambda d: brute.crc(d) % 4 == 2)
        for r in score_texts(df, held()).collect():
            (w,) = [x for (d, _), x in want.items() if d == r.doc_id]
            assert (r.n_tokens, r.n_known, r.train_tokens) == w[1:4] and r.base_score == pytest.approx(w[4]) and r.score < 0
    elif name == "op6":
        size = collections.Counter()
        for r in best_fit_packing(df).collect():
            size[r.doc_id] += r.n_tokens
        assert size == {d: len((t or "").split()) + 1 for d, t in pairs}
    elif name == "op8":
        removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
        out = substring_dedup(df).select("doc_id", "n_words", removed.alias("r"), F.sha2(F.encode("kept", "UTF-8"), 256).alias("h"))
        assert found(out, "n_words", "r", "h") == by_id(pairs, brute.repeated_words(pairs))
    elif name == "op9":
        assert found(quality_rules(df), *NAMES, "base_failed") == by_id(pairs, {(d, t): brute.counts(t) for d, t in pairs})
    elif name == "op10":
        out = simhash_classes(df).withColumn("f", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))
        assert found(out, "f") == collections.Counter((d, f"{brute.fingerprint(t):016x}") for d, t in pairs)
    else:
        assert sorted(r.doc_id for r in dedup_near(df).collect()) == [2, 5, 11, 12]


def test_words_that_break_polynomial_hashes(spark):
    """The Thue-Morse word of 1,024 letters and its complement have equal sums modulo 2**64 for every base."""
    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    twin = word.translate(str.maketrans("ab", "ba"))
    texts = [(1, f"{word} x {word}\n{twin}\n{word}"), (2, f"{twin} y {twin}"), (3, " ".join([word, twin] * 30)), (4, " ".join([twin, word] * 30))]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    items = [(1, f"{word} q")]
    out = decontaminate(df, spark.createDataFrame(items, "item_id long, text string"))
    assert found(out, "n_words", "n_hit") == collections.Counter((d, *x[:2]) for (d, _), x in brute.contamination(texts, items).items())
    assert found(quality_rules(df), *NAMES, "base_failed") == by_id(texts, {(d, t): brute.counts(t) for d, t in texts})
    want = brute.base_scores(texts, lambda d: brute.crc(d) % 4 == 2)
    assert found(score_texts(df, held()), "n_known") == collections.Counter((d, x[2]) for (d, _), x in want.items())
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    out = substring_dedup(df).select("doc_id", "n_words", removed.alias("r"), F.sha2(F.encode("kept", "UTF-8"), 256).alias("h"))
    assert found(out, "n_words", "r", "h") == by_id(texts, brute.repeated_words(texts))
    out = suffix_array_dedup(df).select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("r"), F.size("spans").alias("s"), F.sha2("kept", 256).alias("h"))
    assert found(out, "n_bytes", "r", "s", "h") == by_id(texts, brute.repeated_bytes(texts))


def test_components_of_a_chain(spark, monkeypatch):
    """A chain in the order of its numbers takes a logarithmic number of rounds."""
    scratch = Scratch(spark, "t")
    saves, save = [], scratch.save
    monkeypatch.setattr(scratch, "save", lambda df: saves.append(1) or save(df))
    edges = spark.range(2000).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    assert len({r.root for r in components(edges, scratch).collect()}) == 1 and len(saves) < 3 * 24


OPERATORS = {
    "suffix_array_dedup": suffix_array_dedup,
    "substring_dedup": substring_dedup,
    "decontaminate": lambda d: decontaminate(d, d.select(F.col("doc_id").alias("item_id"), "text")),
    "quality_rules": quality_rules,
    "simhash_classes": simhash_classes,
    "identify_languages": lambda d: identify_languages(d, held()),
    "score_texts": lambda d: score_texts(d, held()),
    "score_toxicity": lambda d: score_toxicity(d, d.select("doc_id", F.lit(1).alias("toxic")), held()),
    "best_fit_packing": best_fit_packing,
    "balanced_shards": balanced_shards,
    "dedup_near": dedup_near,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_no_rows(empty, name):
    assert OPERATORS[name](empty).count() == 0
