"""Hand-sized cases of the operators."""

from __future__ import annotations

import difflib
import io
import json
import math
import pickle
import random
import re
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import frames, geometry, text, vectors
from millrace.operators import blocklist, chain, episodic, mixture, ordering, shards, stats, timeseries, validate
from millrace.sources import readers, store, writers
from millrace.streaming import metrics as streaming


def steps(spark, *episodes):
    rows = [(e, i, float(v)) for e, values in enumerate(episodes) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "episode_id long, step_idx int, a double")


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_chunk_padding(spark):
    out = episodic.action_chunk(steps(spark, range(5)), "a", 3, "c").orderBy("step_idx").collect()
    assert [r.c for r in out[3:]] == [[3, 4, 4], [4, 4, 4]]


def test_returns(spark):
    rows = steps(spark, range(3), range(3)).withColumn("r", (F.col("episode_id") == 0).cast("double"))
    out = episodic.returns(rows, F.col("r"), 0.5).orderBy("episode_id", "step_idx").collect()
    assert [r.value for r in out] == [-0.5, 0, 1, -1, -1, -1]


def test_history(spark):
    assert one(spark, frames.history(F.lit(5), 3, 2).alias("h")).h == [0, 1, 3]


def test_differences(spark):
    rows = steps(spark, [1, 4, 6], [7]).withColumn("d", episodic.forward_difference("a"))
    assert [r.d for r in rows.orderBy("episode_id", "step_idx").collect()] == [3, 2, 2, 0]
    g = steps(spark, [1, 4, 9]).withColumn("g", episodic.gradient("a", 1.0)).orderBy("step_idx").collect()
    assert [r.g for r in g] == [3, 4, 5]


def test_nearest(spark):
    source = spark.createDataFrame([("a", 0.0, 10), ("a", 2.0, 12), ("b", 5.0, 5), ("b", 6.0, 6)], "k string, t double, v int")
    target = spark.createDataFrame([("a", 1.0), ("b", 0.0), ("b", 9.0), ("c", 1.0)], "k string, t double")
    out = timeseries.asof_nearest(target, source, "k", "t", "v", "v")
    assert sorted(map(tuple, out.collect()), key=str) == [("a", 1.0, 10), ("b", 0.0, 5), ("b", 9.0, 6), ("c", 1.0, None)]


def test_grids(spark):
    grid = one(spark, frames.time_grid(F.lit(0.0), F.lit(1.05), 10).alias("g"), frames.time_range(F.lit(0.0), F.lit(1.05), 10).alias("h"))
    assert len(grid.g) == 10 and grid.g[-1] == 0.9 and len(grid.h) == 11


def test_zero_spans(spark):
    x = F.lit(3.0)
    s = {k: x for k in ("min", "max", "mean", "q01", "q99")} | {"std": F.lit(0.0)}
    out = one(spark, vectors.rescale(x, x, x).alias("a"), *[vectors.normalize(x, m, s).alias(m) for m in ("min_max", "mean_std", "q99")])
    assert tuple(out) == (-1, 0, 3, 1)


@pytest.mark.parametrize(("values", "scheme", "want"), [([0.2, 0.4], "lcb", 0.158579), ([0.01, 0.01, 0.9], "majority_mean", 0), ([0.01, 0.5, 0.9], "majority_mean", 0.7), ([0.01, 0.5], "success_vote", 0.5)])
def test_ensembles(spark, values, scheme, want):
    v = spark.createDataFrame([(x,) for x in values], "v double").agg(stats.ensemble(F.col("v"), scheme)).first()[0]
    assert v == pytest.approx(want, abs=1e-6)
    assert math.isnan(spark.createDataFrame([(0.5,)], "v double").agg(stats.ensemble(F.col("v"), "lcb")).first()[0])


def test_rank_ranges_and_shares():
    assert [r[:2] for r in ordering.rank_ranges(10, 3)] == [(0, 4), (4, 7), (7, 10)]


def test_shares(spark):
    groups = spark.createDataFrame([("a", 90), ("b", 10)], "g string, n long")
    assert sorted(map(tuple, mixture.allocate_workers(groups, "g", "n", 4).collect())) == [("a", 3), ("b", 1)]
    equal = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "g string, n long")
    assert sum(r.workers for r in mixture.equal_shares(equal, "g", "n", 100).collect()) == 100
    epoch = lambda *n: tuple(one(spark, mixture.epoch_structures(*map(F.lit, n), 0.5, 0.5).alias("e")).e)
    assert epoch(100, 30, 10) == (100, 50, 50) and epoch(7, 0, 0) == (7, 0, 0)


def test_workers_are_those_of_the_loop(spark):
    """Each worker to the group whose share of the workers given so far lacks most."""
    rng = random.Random(7)
    cases = [([29, 6, 125, 9], 28), ([10, 20, 30, 40, 50], 16), ([1, 1, 1, 1, 1000], 7), ([5], 3), ([3, 3, 3], 3)]
    cases += [([rng.randint(1, 200) for _ in range(rng.randint(1, 7))], rng.randint(7, 40)) for _ in range(40)]
    for counts, workers in cases:
        have = np.ones(len(counts), int)
        target = np.array(counts) / sum(counts)
        while have.sum() < workers:
            have[np.argmin(have / have.sum() - target)] += 1
        groups = spark.createDataFrame([(f"g{i}", n) for i, n in enumerate(counts)], "g string, n long")
        assert [r.workers for r in mixture.allocate_workers(groups, "g", "n", workers).orderBy("g").collect()] == have.tolist()
    with pytest.raises(Exception, match="fewer workers"):
        mixture.allocate_workers(groups, "g", "n", 0).collect()


@pytest.mark.parametrize("workers", [4, 7, 16])
def test_equalized_lists_are_those_of_the_loop(spark, workers):
    sizes = {"a": 9, "b": 40, "c": 1, "d": 40}
    shares = {g: math.ceil(n / 90 * workers) for g, n in sizes.items()}
    shares["b"] += workers - sum(shares.values())
    each = math.ceil(90 / workers)
    want = sorted((g, i % sizes[g], i // sizes[g]) for g in sizes for i in range(shares[g] * each))
    rows = spark.createDataFrame([(g, i) for g, n in sizes.items() for i in range(n)], "g string, i int").repartition(3)
    out = mixture.equalize(rows, "g", "i", workers).collect()
    assert sorted((r.g, r.i, r.copy) for r in out) == want


def test_controlled_fps_is_drawn_by_weight(spark):
    rows = spark.range(20_000).select(((F.col("id") + 0.5) / 20_000).alias("u"))
    drawn = dict(rows.groupBy(frames.controlled_fps(F.lit(30), F.lit(60), 20, 4, 40, 2, F.col("u")).alias("f")).count().collect())
    weights = {f: 1 / f**2 for f in range(10, 31)}
    assert drawn.keys() == weights.keys() and all(abs(drawn[f] / 20_000 - w / sum(weights.values())) < 1e-3 for f, w in weights.items())
    assert one(spark, frames.controlled_fps(F.lit(8), F.lit(10), 9, 4, 40, 2, F.lit(0.5)).alias("f")).f == 8


@pytest.mark.parametrize(("p", "q"), [(0.0, 0.0), (0.0, 1.0), (0.0, 0.3), (1.0, 0.3), (1.0, 0.0), (0.3, 0.0), (0.3, 1.0), (0.3, 0.7)])
def test_epoch_structure_with_shares_of_none_and_all(spark, p, q):
    """The rules in their order, for every combination of missing kinds."""

    def plain(d, s, f):
        if s + f == 0:
            return d, 0, 0
        if q == 0 or s == 0:
            share, s2, f2 = 0.0, 0, f
        elif q == 1 or f == 0:
            share, s2, f2 = 1.0, s, 0
        else:
            share, more = q, int(f * q / (1 - q))
            s2, f2 = (more, f) if s < more else (s, int(s * (1 - q) / q))
        if p == 0 or d == 0:
            return 0, s2, f2
        if p == 1:
            return d, 0, 0
        more_d, more_r = int((s2 + f2) * p / (1 - p)), int(d * (1 - p) / p)
        return (more_d, s2, f2) if d < more_d else (d, int(more_r * share), int(more_r * (1 - share)))

    cases = [(d, s, f) for d in (0, 5, 100) for s in (0, 7, 60) for f in (0, 11)]
    rows = spark.createDataFrame(cases, "d long, s long, f long")
    got = rows.select("*", mixture.epoch_structures(F.col("d"), F.col("s"), F.col("f"), p, q).alias("e")).collect()
    assert {(r.d, r.s, r.f): tuple(r.e) for r in got} == {c: plain(*c) for c in cases}


def test_gradient_norms_start_anew(spark):
    """Windows of three steps, of which the last is not complete; infinite and missing components count as 0."""
    nan, inf = float("nan"), float("inf")
    rows = [(1, "image", [3.0, 4.0]), (2, "video", [1.0, nan]), (3, "image", [inf, 1.0]), (4, "video", [2.0, None]), (6, "video", [4.0, 0.0]), (7, "image", [9.0, 9.0])]
    df = spark.createDataFrame(rows, "i int, k string, g array<double>")
    got = {tuple(r) for r in stats.gradient_norm_means(df, "i", "k", ["image", "video"], "g", 3).collect()}
    assert got == {(3, "image", 3.0), (3, "video", 1.0), (6, "image", 0.0), (6, "video", 3.0)}


def test_rows_in_rounds(spark):
    tables = {k: spark.range(n).select(F.col("id").alias("n")) for k, n in (("a", 5), ("b", 2))}
    out = mixture.interleave_rows(tables, {"a": 2, "b": 1}, "n").orderBy("position").collect()
    assert [(r.source, r.n, r.position) for r in out] == [("a", 0, 0), ("a", 1, 1), ("b", 0, 2), ("a", 2, 3), ("a", 3, 4), ("b", 1, 5), ("a", 4, 6)]


def test_chunks_and_strides(spark):
    n = lambda k: one(spark, frames.chunk_count(F.lit(k), 256, 4).alias("n")).n
    assert (n(641), n(383), n(100)) == (3, 1, 1)
    assert one(spark, frames.strides(F.lit(10), F.lit(30.0), 9, 25, 29).alias("s")).s == []
    assert one(spark, frames.strides(F.lit(100), F.lit(30.0), 2, 1, 1.4).alias("s")).s == [*range(22, 31)]


def test_global_numbers(spark, monkeypatch):
    monkeypatch.setattr(ordering, "RANGES", 8)
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    out = ordering.number_rows(rows, ["k"]).collect()
    assert all(r.k == r.position for r in out) and len(out) == 1000


def test_noop_filter_is_the_loop(spark):
    rng = random.Random(0)
    episodes = [[(rng.choice([0.0, 1.0]), rng.choice([0.0, 1.0])) for _ in range(rng.randint(1, 9))] for _ in range(50)]
    want = []
    for e, actions in enumerate(episodes):
        last = None
        for i, (move, grip) in enumerate(actions):
            if move < 1e-4 and (last is None or grip == last):
                continue
            last = grip
            want.append((e, i))
    rows = spark.createDataFrame([(e, i, *a) for e, x in enumerate(episodes) for i, a in enumerate(x)], "episode_id long, step_idx int, move double, grip double")
    out = episodic.drop_noops(rows, F.col("move"), "grip").select("episode_id", "step_idx").collect()
    assert sorted(map(tuple, out)) == want


def test_unwrap(spark):
    rows = spark.createDataFrame([(0, 0, 3.0, 0.0, 0.0), (0, 1, -3.0, 0.0, 0.0), (1, 0, -3.0, 0.0, 0.0)], "episode_id long, step_idx int, x double, y double, z double")
    out = episodic.unwrap_rotations(rows, ["x", "y", "z"]).orderBy("episode_id", "step_idx").collect()
    assert [round(r.x, 4) for r in out] == [3.0, round(2 * math.pi - 3, 4), -3.0]


def test_rotations_go_back(spark):
    angles = [F.lit(x) for x in (0.3, -0.4, 1.2)]
    m = geometry.euler_to_matrix(*angles)
    r, t = geometry.pose_invert(m, [F.lit(1.0), F.lit(2.0), F.lit(3.0)])
    i, z = geometry.pose_compose(m, [F.lit(1.0), F.lit(2.0), F.lit(3.0)], r, t)
    out = one(spark, *[x.alias(f"e{k}") for k, x in enumerate(geometry.matrix_to_euler(m))], *[x.alias(f"i{k}") for k, x in enumerate(i)], *[x.alias(f"z{k}") for k, x in enumerate(z)])
    assert list(out) == pytest.approx([0.3, -0.4, 1.2, 1, 0, 0, 0, 1, 0, 0, 0, 1, 0, 0, 0], abs=1e-9)
    assert one(spark, geometry.parse_camera(F.lit("1 2 3")).alias("c")).c is None


def test_fuzzy_thresholds(spark):
    rows = spark.createDataFrame([(1, "a badw0rd here"), (2, "fine"), (3, None), (4, "some badword")], "k int, x string")
    hits = lambda slack: sorted(r.k for r in blocklist.near_hits(rows, "k", "x", ["badword"], slack).collect())
    assert hits(1.0) == [1, 4] and hits(0.5) == hits(0.4) == [4]


@pytest.mark.parametrize("slack", [0.4, 0.9, 1.0, 2.5])
def test_fuzzy_hits_are_every_window(spark, slack):
    """All runs of as many words as a phrase, compared with difflib one by one."""
    rng = random.Random(3)
    words = ["badword", "word phrase", "a far longer phrase", "short"]
    twist = lambda w: "".join(rng.choice("abdorw ") if rng.random() < 0.12 else c for c in w)
    texts = [" ".join(twist(rng.choice(words)) if rng.random() < 0.5 else rng.choice(["fine", "badly", "phrase"]) for _ in range(4)) for _ in range(120)]
    rows = spark.createDataFrame([*enumerate(texts), (500, None), (501, "")], "k int, x string")
    want = set()
    for k, t in enumerate(texts):
        parts = t.split(" ")
        for w in (w for w in words if len(w) >= 6):
            n = len(w.split())
            if any(difflib.SequenceMatcher(None, " ".join(parts[i : i + n]), w).ratio() >= (len(w) - slack) / len(w) for i in range(len(parts) - n + 1)):
                want.add(k)
    assert {r.k for r in blocklist.near_hits(rows, "k", "x", words, slack).collect()} == want and want


def test_captions(spark):
    rows = spark.createDataFrame([("A panel",), (" ",), (None,), ("dog",)], "c string")
    keep = lambda inc: [r[0] for r in rows.select(text.caption_passes(F.col("c"), ["pan"], inc)).collect()]
    assert keep(False) == [False, True, True, True] and keep(True) == [True, True, True, False]


def test_alignment(spark):
    index = spark.createDataFrame([("s", "a"), ("s", "b")], "shard string, key string")
    x = spark.createDataFrame([("s", "a", 0, "first"), ("s", "a", 1, "second"), ("s", "z", 2, "odd")], "shard string, key string, pos int, payload string")
    y = spark.createDataFrame([("s", "a", 0, "y"), ("s", "b", 1, "y")], "shard string, key string, pos int, payload string")
    assert [tuple(r) for r in shards.align(index, {"x": x, "y": y}, ["shard", "key"], "pos").collect()] == [("s", "a", "first", "y")]


def test_checks(spark):
    rows = spark.createDataFrame([(1, 5), (2, None)], "k int, n int")
    assert [tuple(r) for r in validate.violations(rows, "k", {"n": F.col("n") > 1}).collect()] == [(2, "n")]
    with pytest.raises(ValueError):
        validate.check_mode("q99", {"min"})


def test_chain_round_trip(spark):
    up = chain.Invertible(lambda d: d.withColumn("id", F.col("id") * 2), lambda d: d.withColumn("id", F.col("id") / 2))
    add = chain.Invertible(lambda d: d.withColumn("id", F.col("id") + 3), lambda d: d.withColumn("id", F.col("id") - 3))
    c = chain.Chain([up, add])
    assert [r.id for r in c.unapply(c.apply(spark.range(3))).collect()] == [0, 1, 2]


def test_suppression(spark):
    boxes = spark.createDataFrame([("g", 0.9, 0.0, 0.0, 10.0, 10.0), ("g", 0.8, 1.0, 1.0, 10.0, 10.0), ("g", 0.7, 50.0, 50.0, 60.0, 60.0)], "g string, score double, x0 double, y0 double, x1 double, y1 double")
    assert sorted(r.score for r in mixture.suppress_overlaps(boxes, "g", 0.5, 50, 10).collect()) == [0.7, 0.9]


def test_tar_and_json(spark, tmp_path):
    (tmp_path / "video").mkdir()
    with tarfile.open(tmp_path / "video" / "0.tar", "w") as tar:
        for name in ("k1.json", "k1.jpg", "k2.json"):
            info = tarfile.TarInfo(name)
            info.size = 2
            tar.addfile(info, io.BytesIO(b"{}"))
    out = readers.tar_shards(spark, str(tmp_path / "video")).orderBy("pos").collect()
    assert [(r.data_key, r.key, r.suffix) for r in out] == [("video", "k1", "json"), ("video", "k1", "jpg"), ("video", "k2", "json")]
    for batch_bytes in (1, 1 << 20):
        assert readers.tar_shards(spark, str(tmp_path / "video"), stream=True, batch_bytes=batch_bytes).orderBy("pos").collect() == out
    (tmp_path / "m.json").write_text(json.dumps({"root": "s3://b/x/y", "data_list": ["1.tar", "2.tar"], "total_key_count": 3, "chunk_size": 2}))
    assert [(r.root, r.shard) for r in readers.shard_list(spark, str(tmp_path / "m.json")).collect()] == [("x/y", "1.tar"), ("x/y", "2.tar")]
    (tmp_path / "r.json").write_text(json.dumps({"3": {"verdict": "keep", "trim_start": 0.0, "trim_end": 1.5, "notes": ""}}))
    assert tuple(readers.reviews(spark, str(tmp_path / "r.json")).first())[:2] == (3, "keep")


def test_written_once(spark, tmp_path):
    path = str(tmp_path / "s.parquet")
    assert writers.load_or_compute(spark, path, lambda: spark.range(2)).count() == 2
    assert writers.load_or_compute(spark, path, lambda: spark.range(5)).count() == 2
    assert writers.unfinished(spark.range(5), spark.range(2), "id").count() == 3


def test_stream_equals_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    q = streaming.tumbling_rollup(stream, "ts", "value", ["event_type"], "1 day", "1 hour").writeStream.outputMode("complete").format("memory").queryName("rollup").start()
    q.processAllAvailable()
    q.stop()
    want = events.groupBy("event_type").count()
    assert sorted(map(tuple, spark.sql("SELECT event_type, sum(n) FROM rollup GROUP BY event_type").collect())) == sorted(map(tuple, want.collect()))


def test_epoch_shares_hold(spark):
    """Nothing is cut, and of each pair of kinds that are there the shares hold up to rounding."""
    cases = [(d, s, f) for d in (0, 3, 10, 100) for s in (0, 1, 7, 30) for f in (0, 2, 10, 60)]
    rows = spark.createDataFrame(cases, "d long, s long, f long")
    for x in rows.select("*", mixture.epoch_structures(F.col("d"), F.col("s"), F.col("f"), 0.5, 0.25).alias("e")).select("*", "e.*").collect():
        if not x.d or not x.s + x.f:
            assert x.demo == (x.d if not x.s + x.f else 0)
            continue
        assert x.demo >= x.d and x.success + x.failure >= x.s + x.f - 1 and abs(x.demo - x.success - x.failure) <= 2
        assert not (x.s and x.f) or abs(x.success - 0.25 * (x.success + x.failure)) <= 2


def test_nearest_of_long_streams(spark):
    """Every span gives what one sort gives, and one key of many stamps does not take the square of them."""
    rng = random.Random(7)
    sources = [(k, round(rng.uniform(0, 50), 3), i) for i, k in enumerate("aab" * 40)] + [("c", 25.0, -1)]
    sources = list({(k, t): (k, t, v) for k, t, v in sources}.values())
    targets = [(k, round(rng.uniform(-5, 55), 3)) for k in "abcd" * 50] + [(k, t) for k, t, _ in sources[:20]]
    s = spark.createDataFrame(sources, "k string, t double, v int")
    g = spark.createDataFrame(targets, "k string, t double")

    def best(k, t):
        near = [(abs(x - t), x, v) for j, x, v in sources if j == k]
        return min(near)[2] if near else None

    want = sorted(((k, t, best(k, t)) for k, t in targets), key=str)
    for span in (None, 7.0, 1000.0):
        assert sorted(map(tuple, timeseries.asof_nearest(g, s, "k", "t", "v", "v", span).collect()), key=str) == want
    many = spark.range(200_000).select(F.lit("x").alias("k"), F.col("id").cast("double").alias("t"), F.col("id").alias("v"))
    shifted = many.select("k", (F.col("t") + 0.25).alias("t"))
    assert timeseries.asof_nearest(shifted, many, "k", "t", "v", "v").where("v <> floor(t)").count() == 0


def test_exact_quantiles(spark, monkeypatch):
    monkeypatch.setattr(stats, "ACCURACY", 20)
    rng = random.Random(1)
    values = {"a": [rng.choice([1.0, 2.0, rng.random()]) for _ in range(999)], "b": [5.0] * 300, "c": [1.0, 2.0], "d": [float(i * i) for i in range(400)]}
    rows = spark.createDataFrame([(k, v) for k, x in values.items() for v in x] + [("a", None)], "k string, v double")
    out = {r.k: r for r in stats.exact_quantiles(rows, ["k"], "v", {"lo": 0.01, "mid": 0.5, "hi": 0.99, "max": 1.0}).collect()}
    for k, x in values.items():
        assert [out[k].lo, out[k].mid, out[k].hi, out[k].max] == pytest.approx(np.quantile(x, [0.01, 0.5, 0.99, 1.0]).tolist())


def test_equal_leading_keys_and_any_names(spark, monkeypatch):
    monkeypatch.setattr(ordering, "RANGES", 16)
    rows = spark.range(500).select((F.col("id") % 2).alias("_range"), F.col("id").alias("_value"), F.lit("x").alias("_sum"))
    out = ordering.number_rows(rows, ["_range", "_value"]).collect()
    assert sorted(r.position for r in out) == list(range(500)) and all(r.position == r._range * 250 + r._value // 2 and r._sum == "x" for r in out)


def test_store_retries(tmp_path):
    pauses, tries = [], []

    def flaky():
        tries.append(1)
        if len(tries) < 4:
            raise OSError("again")
        return 7

    assert store.retried(flaky, sleep=pauses.append) == 7 and len(pauses) == 3 and pauses[1] >= 0.2
    with pytest.raises(OSError):
        store.retried(lambda: (_ for _ in ()).throw(OSError("no")), attempts=2, sleep=pauses.append)

    class Breaking(io.BytesIO):
        left = 2

        def read(self, n=-1):
            Breaking.left -= 1
            if Breaking.left == 0:
                raise OSError("cut off")
            return super().read(n)

    data = bytes(range(256)) * 40
    assert store.RetryingStream(lambda: Breaking(data), pause=0.0).readall() == data
    (tmp_path / "f.bin").write_bytes(data)
    for url in (str(tmp_path / "f.bin"), f"file://{tmp_path}/f.bin"):
        assert store.open_url(url).read() == data


def test_captions_items_and_decoders(spark, tmp_path):
    (tmp_path / "captions").mkdir()
    (tmp_path / "captions" / "v1.json").write_text('"model": {"long": "a b", "short": "a"}')
    (tmp_path / "captions" / "v2.json").write_text('{"model": {"long": "c"}}')
    got = lambda **k: {r.name: r.caption for r in readers.captions(spark, str(tmp_path), **k).collect()}
    assert got() == {"v1": "a b", "v2": "c"} and got(prompt="short") == {"v1": "a", "v2": "c"}
    with pytest.raises(ValueError):
        readers.captions(spark, str(tmp_path / "none"))
    (tmp_path / "items").mkdir()
    for i in range(4):
        (tmp_path / "items" / f"{i:06d}.pkl").write_bytes(pickle.dumps([i, 2.5]))
    rows = readers.items(spark, str(tmp_path / "items"), 1, 3).select("item", readers.numbers(F.col("content"), "pickle").alias("x"))
    assert sorted(map(tuple, rows.collect())) == [(1, [1.0, 2.5]), (2, [2.0, 2.5])]
    with pytest.raises(pickle.UnpicklingError):
        readers.DECODERS["pickle"](pickle.dumps(random.Random()))
    npy = io.BytesIO()
    np.save(npy, np.arange(3.0))
    assert readers.DECODERS["npy"](npy.getvalue()).tolist() == [0, 1, 2] and readers.DECODERS["json"](b"[1]") == [1]


def test_rollouts_and_backups(spark, tmp_path):
    steps_ = spark.createDataFrame([(0, 0, [1.0, 2.0]), (0, 1, [4.0, 2.0]), (1, 0, [5.0, 5.0])], "episode_id long, step_idx int, action array<double>")
    writers.write_rollouts(steps_, spark.createDataFrame([(0, True), (1, False)], "episode_id long, success boolean"), str(tmp_path / "r"))
    out = spark.read.parquet(str(tmp_path / "r" / "steps")).orderBy("episode_id", "step_idx").collect()
    assert [(r.relative_action, r.success) for r in out] == [([3.0, 0.0], "true"), ([3.0, 0.0], "true"), ([0.0, 0.0], "false")]
    for n in (1, 2, 3):
        writers.save_with_backup(spark.range(n), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3 and spark.read.parquet(str(tmp_path / "t.bak")).count() == 2


def test_config_rules():
    rules = {"n": validate.checked_number(int, 1, 8, multiple_of=2), "x": validate.checked_number(float, 0.0), "s": validate.checked_string(1, 3), "b": validate.checked_bool, "o": validate.one_of(1, 2, cast=int), "j": validate.checked_json}
    good = {"n": "4", "x": 1, "s": "ab", "b": "True", "o": "2", "j": '{"a": 1}'}
    assert validate.check_config(good, rules) == {"n": 4, "x": 1.0, "s": "ab", "b": True, "o": 2, "j": {"a": 1}}
    for bad in ({"n": 3}, {"n": 2.5}, {"x": -1}, {"s": "abcd"}, {"b": "maybe"}, {"o": 3}, {"j": "[1]"}):
        with pytest.raises(ValueError):
            validate.check_config(good | bad, rules)


def test_registries(spark):
    found = chain.Registry()
    found.register("twice")(lambda s, path: s.range(2))
    assert found.find("twice")(spark, "").count() == 2
    for bad in (lambda: found.find("other"), lambda: found.register("twice")(1)):
        with pytest.raises(ValueError):
            bad()
    readers.HANDLERS.register("seq")(lambda s, path, schema=None: s.range(5))
    assert readers.load(spark, "x.seq").count() == 5
    readers.DATASETS.register("five")(lambda s, path: s.range(5))
    assert readers.dataset(spark, "five", "").count() == 5
    chain.register("half")(lambda d: d.where("id % 2 = 0"))
    chain.PRESETS["twice_half"] = ["half", "half"]
    assert chain.preset(spark.range(4), "twice_half").count() == 2


def test_gather_takes_one_exchange(spark):
    rows = spark.createDataFrame([(e, i, float(10 * e + i)) for e in (1, 2, 3) for i in range(e)], "episode_id long, step_idx int, x double")
    out = episodic.gather_ends(rows, "x", [-2, 0, 1])
    got = {tuple(r) for r in out.collect()}
    want = set()
    for e in (1, 2, 3):
        for i in range(e):
            for d in (-2, 0, 1):
                inside = 0 <= i + d < e
                want.add((e, i, d, 10.0 * e + max(0, min(i + d, e - 1)), 10.0 * e + i + d if inside else 0.0))
    assert got == want
    assert {tuple(r) for r in episodic.gather(rows, "x", [-2, 0, 1], absolute=False).collect()} == {(e, i, d, b) for e, i, d, _, b in want}
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_turns_are_multiplied_without_zeros(spark):
    angles = (0.3, -0.4, 1.2)
    for order in ("XYZ", "XZY", "YXZ", "YZX", "ZXY", "ZYX"):
        m = geometry.angles_to_matrix([F.lit(x) for x in angles], order)
        turns = []
        for axis, x in zip(order, angles, strict=True):
            row = spark.range(1).select(*[c.alias(str(i)) for i, c in enumerate(geometry.axis_turn(axis, F.lit(x)))]).first()
            turns.append(np.array(row, float).reshape(3, 3))
        got = spark.range(1).select(*[c.alias(str(i)) for i, c in enumerate(m)], *[c.alias(n) for n, c in zip("abc", geometry.matrix_to_angles(m, order), strict=True)]).first()
        assert np.allclose(np.array(got[:9], float).reshape(3, 3), turns[0] @ turns[1] @ turns[2])
        assert np.allclose(got[9:], angles)
        assert all(len(re.findall(r"(?i)\b(sin|cos)\(", str(c))) <= 5 for c in m)
