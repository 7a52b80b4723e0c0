"""Queries for unions, mixtures, sampling and frame choice."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import frames
from millrace.functions.draws import draw_sql
from millrace.operators import mixture, ordering
from millrace.plans.registry import query, r


@query("SELECT 'customer' AS dataset, c_custkey AS id, row_number() OVER (ORDER BY c_custkey) - 1 AS global_id FROM customer UNION ALL SELECT 'supplier', s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 + (SELECT count(*) FROM customer) FROM supplier")
def concat_datasets(t):
    a = t.customer.select(F.lit(0).alias("part"), F.lit("customer").alias("dataset"), F.col("c_custkey").alias("id"))
    b = t.supplier.select(F.lit(1).alias("part"), F.lit("supplier").alias("dataset"), F.col("s_suppkey").alias("id"))
    first = ordering.number_rows(a, ["id"], "global_id")
    second = ordering.number_rows(b, ["id"], "global_id").withColumn("global_id", F.col("global_id") + a.count())
    return first.unionByName(second).select("dataset", "id", "global_id")


@query("SELECT 'demo' AS source, o_orderkey AS episode_id FROM orders WHERE o_orderstatus = 'O' UNION ALL SELECT 'rollout', o_orderkey FROM orders WHERE o_orderstatus = 'F'")
def union_success(t):
    demo = t.orders.where("o_orderstatus = 'O'").select(F.lit("demo").alias("source"), F.col("o_orderkey").alias("episode_id"))
    rollout = t.orders.where("o_orderstatus = 'F'").select(F.lit("rollout").alias("source"), F.col("o_orderkey").alias("episode_id"))
    return demo.unionByName(rollout)


@query("SELECT n_nationkey, i AS out_position FROM (SELECT unnest(range(0, 60)) AS i) JOIN nation ON n_nationkey = i % 25")
def repeat_to_length(t):
    rows = ordering.number_rows(t.nation, ["n_nationkey"])
    return mixture.repeat_to(rows, "position", 25, 60).select("n_nationkey", F.col("out_position").cast("long").alias("out_position"))


@query("SELECT s_suppkey, i AS copy FROM supplier CROSS JOIN (SELECT unnest([0, 1, 2]) AS i)")
def duplicate_rows(t):
    return t.supplier.select("s_suppkey", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("copy"))


@query("SELECT CAST(n % 5 AS BIGINT) AS batch, count(*) AS rows, min(n) AS first FROM (SELECT row_number() OVER (ORDER BY s_suppkey) - 1 AS n FROM supplier) GROUP BY n % 5")
def strided_concat(t):
    rows = ordering.number_rows(t.supplier, ["s_suppkey"], "n")
    return rows.groupBy((F.col("n") % 5).alias("batch")).agg(F.count("*").alias("rows"), F.min("n").alias("first"))


EPOCH_SQL = """n AS (SELECT n_nationkey AS grp, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS d, (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey AND s_acctbal > 5000) AS s,
  (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey AND s_acctbal <= 5000) AS f FROM nation),
  r AS (SELECT *, CASE WHEN s = 0 THEN 0 WHEN f = 0 THEN s WHEN s < floor(f * 0.25 / 0.75) THEN floor(f * 0.25 / 0.75) ELSE s END AS s2,
  CASE WHEN s = 0 THEN f WHEN f = 0 THEN 0 WHEN s < floor(f * 0.25 / 0.75) THEN f ELSE floor(s * 0.75 / 0.25) END AS f2, CASE WHEN s = 0 THEN 0 WHEN f = 0 THEN 1 ELSE 0.25 END AS q FROM n),
  e AS (SELECT grp, CAST(CASE WHEN s + f = 0 THEN d WHEN d = 0 THEN 0 WHEN d < s2 + f2 THEN s2 + f2 ELSE d END AS BIGINT) AS demo, CAST(CASE WHEN s + f = 0 THEN 0 WHEN d = 0 OR d < s2 + f2 THEN s2 ELSE floor(d * q) END AS BIGINT) AS success,
  CAST(CASE WHEN s + f = 0 THEN 0 WHEN d = 0 OR d < s2 + f2 THEN f2 ELSE floor(d * (1 - q)) END AS BIGINT) AS failure FROM r)"""


def _epochs(t):
    d = t.customer.groupBy(F.col("c_nationkey").alias("grp")).agg(F.count("*").alias("d"))
    good = F.col("s_acctbal") > 5000
    s = t.supplier.groupBy(F.col("s_nationkey").alias("grp")).agg(F.sum(good.cast("long")).alias("s"), F.sum((~good).cast("long")).alias("f"))
    rows = t.nation.select(F.col("n_nationkey").alias("grp")).join(d, "grp", "left").join(s, "grp", "left").na.fill(0)
    return rows.select("grp", mixture.epoch_structures(F.col("d"), F.col("s"), F.col("f"), 0.5, 0.25).alias("e")).select("grp", "e.*")


@query(f"WITH {EPOCH_SQL} SELECT * FROM e")
def epoch_structure(t):
    return _epochs(t)


@query("""WITH n AS (SELECT n_nationkey AS grp, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey AND c_acctbal > 9000) AS d, (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey AND s_acctbal > 5000) AS s,
  (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey AND s_acctbal <= 5000) AS f, p, q FROM nation, (VALUES (0.0, 0.0), (0.0, 1.0), (1.0, 0.5), (0.5, 0.0), (0.5, 1.0), (0.0, 0.5)) AS v(p, q)),
  a AS (SELECT *, CASE WHEN s + f = 0 THEN 'none' WHEN q = 0 OR s = 0 THEN 'f' WHEN q = 1 OR f = 0 THEN 's' ELSE 'both' END AS kind FROM n),
  r AS (SELECT *, CASE kind WHEN 'f' THEN 0 WHEN 'both' THEN greatest(s, f) ELSE s END AS s2, CASE kind WHEN 's' THEN 0 WHEN 'both' THEN greatest(s, f) ELSE f END AS f2, CASE kind WHEN 'f' THEN 0.0 WHEN 's' THEN 1.0 ELSE q END AS q2 FROM a)
  SELECT grp, CAST(p AS DOUBLE) AS p, CAST(q AS DOUBLE) AS q, CAST(CASE WHEN kind = 'none' THEN d WHEN p = 0 OR d = 0 THEN 0 WHEN p = 1 THEN d ELSE greatest(d, s2 + f2) END AS BIGINT) AS demo,
  CAST(CASE WHEN kind = 'none' THEN 0 WHEN p = 0 OR d = 0 THEN s2 WHEN p = 1 THEN 0 WHEN d < s2 + f2 THEN s2 ELSE floor(d * q2) END AS BIGINT) AS success,
  CAST(CASE WHEN kind = 'none' THEN 0 WHEN p = 0 OR d = 0 THEN f2 WHEN p = 1 THEN 0 WHEN d < s2 + f2 THEN f2 ELSE floor(d * (1 - q2)) END AS BIGINT) AS failure FROM r""")
def epoch_structure_limits(t):
    good = F.col("s_acctbal") > 5000
    d = t.customer.where("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("grp")).agg(F.count("*").alias("d"))
    s = t.supplier.groupBy(F.col("s_nationkey").alias("grp")).agg(F.sum(good.cast("long")).alias("s"), F.sum((~good).cast("long")).alias("f"))
    rows = t.nation.select(F.col("n_nationkey").alias("grp")).join(d, "grp", "left").join(s, "grp", "left").na.fill(0)
    shares = [(0.0, 0.0), (0.0, 1.0), (1.0, 0.5), (0.5, 0.0), (0.5, 1.0), (0.0, 0.5)]
    each = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(q).alias("q"), mixture.epoch_structures(F.col("d"), F.col("s"), F.col("f"), p, q).alias("e")) for p, q in shares])
    return rows.select("grp", F.inline(each)).select("grp", "p", "q", "e.*")


@query(f"""WITH {EPOCH_SQL} SELECT grp, idx, CASE WHEN idx < demo THEN 'demo' WHEN idx < demo + success THEN 'success' ELSE 'failure' END AS kind
  FROM (SELECT *, unnest(range(0, demo + success + failure)) AS idx FROM e)""")
def sample_type(t):
    all_ = F.col("demo") + F.col("success") + F.col("failure")
    rows = _epochs(t).where(all_ > 0).select("*", F.explode(F.sequence(F.lit(0).cast("long"), all_ - 1)).alias("idx"))
    return rows.select("grp", "idx", mixture.sample_type(F.col("idx"), F.col("demo"), F.col("success")).alias("kind"))


@query("SELECT i AS idx, n_name FROM (SELECT unnest(range(0, 70)) AS i) JOIN (SELECT n_name, row_number() OVER (ORDER BY n_nationkey) - 1 AS n FROM nation) ON n = i % 25")
def epoch_expand(t):
    rows = ordering.number_rows(t.nation, ["n_nationkey"], "n").select("n", "n_name")
    return t.spark.range(70).select(F.col("id").alias("idx"), (F.col("id") % 25).alias("n")).join(rows, "n").select("idx", "n_name")


@query(f"SELECT o_orderkey AS episode_id, CASE WHEN {draw_sql(3, 'o_orderkey')} < 0.5 THEN 'world_model' ELSE 'value' END AS kind FROM orders WHERE o_orderstatus <> 'O'")
def world_value_flip(t):
    kind = F.when(mixture.draw(F.col("o_orderkey"), seed=3) < 0.5, "world_model").otherwise("value")
    return t.orders.where("o_orderstatus <> 'O'").select(F.col("o_orderkey").alias("episode_id"), kind.alias("kind"))


@query(f"""WITH u AS (SELECT o_orderkey, row_number() OVER (ORDER BY {draw_sql(1, 'o_orderkey')}, o_orderkey) - 1 AS position, count(*) OVER () AS n FROM orders)
  SELECT o_orderkey, position >= n - CAST(floor(n * 0.1) AS BIGINT) AS held FROM u""")
def shuffled_holdout(t):
    order = t.orders.select(mixture.draw(F.col("o_orderkey"), seed=1).alias("u"), "o_orderkey")
    n = t.orders.agg(F.count("*").alias("n"))  # one row
    ranked = ordering.number_rows(order, ["u", "o_orderkey"]).join(F.broadcast(n))
    return ranked.select("o_orderkey", (F.col("position") >= F.col("n") - F.floor(F.col("n") * 0.1)).alias("held"))


@query("SELECT p_partkey, s AS stride FROM part CROSS JOIN (SELECT unnest(range(1, 200)) AS s) WHERE 2 * s < p_size * 4 AND 120.0 / s >= 2 AND 120.0 / s <= 40")
def valid_strides(t):
    s = frames.strides(F.col("p_size") * 4, F.lit(120.0), 3, 2, 40)
    return t.part.select("p_partkey", F.explode(s).alias("stride"))


@query(f"""WITH s AS (SELECT p_partkey, p_size, list_filter(range(1, 17), lambda s: 8 * s < p_size * 4 AND 30.0 / s >= 4 AND 30.0 / s <= 12) AS v FROM part),
  c AS (SELECT p_partkey, p_size, CASE WHEN {draw_sql(5, 'p_partkey')} < 0.99 OR len(v) = 1 THEN v[-1] ELSE v[-2] END AS stride FROM s WHERE len(v) > 0)
  SELECT p_partkey, CAST(stride AS INTEGER) AS stride, CAST(floor({draw_sql(6, 'p_partkey')} * (p_size * 4 - 8 * stride)) AS BIGINT) AS start FROM c""")
def stride_choice(t):
    s = F.array_sort(frames.strides(F.col("p_size") * 4, F.lit(30.0), 9, 4, 12))
    top = F.when(mixture.draw(F.col("p_partkey"), seed=5) < 0.99, F.element_at(s, -1)).otherwise(F.coalesce(F.get(s, F.size(s) - 2), F.element_at(s, -1)))
    rows = t.part.withColumn("s", s).where(F.size("s") > 0).select("p_partkey", "p_size", top.alias("stride"))
    room = F.col("p_size") * 4 - 8 * F.col("stride")
    return rows.select("p_partkey", "stride", F.floor(mixture.draw(F.col("p_partkey"), seed=6) * room).alias("start"))


@query("""SELECT p_partkey, CASE WHEN p_size // 16 = 0 THEN 1 ELSE p_size // 16 + CASE WHEN p_size % 16 >= 8 AND p_size % 16 > 4 THEN 1 ELSE 0 END END AS chunks FROM part""")
def chunk_counts(t):
    return t.part.select("p_partkey", frames.chunk_count(F.col("p_size"), 16, 4).alias("chunks"))


@query("""SELECT p_partkey, i AS pos, CAST(3 + floor((p_size - 7 * m) / 2.0) + i * m AS INTEGER) AS frame FROM (SELECT p_partkey, p_size, p_size // 7 AS m FROM part) CROSS JOIN (SELECT unnest(range(0, 7)) AS i) WHERE m > 0""")
def centered_window(t):
    f = frames.centered(F.lit(3), F.col("p_size") + 3, 7)
    return t.part.select("p_partkey", F.posexplode(f).alias("pos", "frame"))


@query("""SELECT p_partkey, k - 2 AS pos, f AS frame FROM (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY f) AS k, count(*) OVER (PARTITION BY p_partkey) AS n FROM (
  SELECT p_partkey, i * 4 AS f FROM part CROSS JOIN (SELECT unnest(range(0, 20)) AS i) WHERE i * 4 < p_size UNION ALL SELECT p_partkey, i * 5 FROM part CROSS JOIN (SELECT unnest(range(0, 20)) AS i) WHERE i * 5 < p_size)) WHERE k > 1 AND k < n""")
def interleaved_frames(t):
    return t.part.select("p_partkey", F.posexplode(frames.interleaved(F.col("p_size"))).alias("pos", "frame"))


@query("""SELECT o_orderkey, first, last FROM (SELECT o_orderkey, x AS first, x + o_orderkey % 90 AS last, row_number() OVER (PARTITION BY o_orderkey ORDER BY x) AS k FROM orders CROSS JOIN (SELECT unnest([0, 100, 200]) AS x)) WHERE k < 3 AND last - first >= 30 AND last - first >= 25""")
def window_eligibility(t):
    windows = F.array(*[F.struct(F.lit(x).alias("first"), (F.lit(x) + F.col("o_orderkey") % 90).alias("last")) for x in (0, 100, 200)])
    kept = F.when(F.size(windows) > 1, F.slice(windows, 1, F.size(windows) - 1)).otherwise(windows)
    ok = F.filter(kept, lambda w: (w["last"] - w["first"] >= 1.0 * 30) & (w["last"] - w["first"] >= 25))
    return t.orders.select("o_orderkey", F.inline(ok))


@query(f"""WITH u AS (SELECT o_orderkey, o_orderstatus AS s, {draw_sql(0, 'o_orderkey')} AS u FROM orders)
  SELECT o_orderkey, CASE s WHEN 'F' THEN CASE WHEN u * 0.8 < 0.5 THEN 'long' ELSE 'short' END WHEN 'O' THEN 'long' ELSE CASE WHEN u < 0.5 THEN 'long' WHEN u < 0.8 THEN 'short' ELSE 'user' END END AS style FROM u""")
def available_styles(t):
    have = F.when(F.col("o_orderstatus") == "F", F.array(F.lit("long"), F.lit("short"))).when(F.col("o_orderstatus") == "O", F.array(F.lit("long"))).otherwise(F.array(F.lit("long"), F.lit("short"), F.lit("user")))
    pick = mixture.weighted_choice(mixture.draw(F.col("o_orderkey")), {"long": 0.5, "short": 0.3, "user": 0.2}, lambda k: F.array_contains("have", k))
    return t.orders.withColumn("have", have).select("o_orderkey", pick.alias("style"))


@query(f"SELECT o_orderkey, CASE WHEN {draw_sql(9, 'o_orderkey')} < 0.7 THEN 'customer' ELSE 'supplier' END AS source FROM orders")
def source_mixture(t):
    pick = mixture.weighted_choice(mixture.draw(F.col("o_orderkey"), seed=9), {"customer": 0.7, "supplier": 0.3}, lambda k: F.lit(True))
    return t.orders.select("o_orderkey", pick.alias("source"))


@query(f"""WITH b AS (SELECT p_partkey, p_size + 10 AS fps, p_size * 7 + 30 AS n, {draw_sql(11, 'p_partkey')} AS u FROM part),
  l AS (SELECT *, greatest(4, CAST(ceil(fps * 25.0 / n) AS INTEGER)) AS least, least(50, fps) AS most FROM b),
  w AS (SELECT l.*, f, sum(1.0 / pow(f, 2.0)) OVER (PARTITION BY p_partkey ORDER BY f) AS up, sum(1.0 / pow(f, 2.0)) OVER (PARTITION BY p_partkey) AS total FROM l, (SELECT unnest(range(1, 100)) AS f) WHERE f BETWEEN least AND most),
  d AS (SELECT p_partkey, min(f) AS f FROM w WHERE up > u * total GROUP BY p_partkey), c AS (SELECT p_partkey, fps, n, CASE WHEN most > least THEN f ELSE most END AS f FROM l LEFT JOIN d USING (p_partkey))
  SELECT p_partkey, CAST(f AS INTEGER) AS target, CAST(fps // f AS INTEGER) AS stride, n > 25 * (fps // f) AS fits FROM c""")
def fps_stride_weights(t):
    fps, n = F.col("p_size") + 10, F.col("p_size") * 7 + 30
    rows = t.part.select("p_partkey", fps.alias("fps"), n.alias("n"), frames.controlled_fps(fps, n, 25, 4, 50, 2, mixture.draw(F.col("p_partkey"), seed=11)).alias("target"))
    stride = F.floor(F.col("fps") / F.col("target")).cast("int")
    return rows.select("p_partkey", "target", stride.alias("stride"), (F.col("n") > 25 * stride).alias("fits"))


@query("SELECT s_suppkey, CAST(p % 2 AS INTEGER) AS rank, CAST((p // 2) % 3 AS INTEGER) AS worker FROM (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS p FROM supplier)")
def shard_assign(t):
    n = t.supplier.count()
    rows = mixture.repeat_to(ordering.number_rows(t.supplier, ["s_suppkey"]), "position", n, n)
    rank, worker = mixture.shard_owner(F.col("out_position"), n, 2, 3)
    return rows.select("s_suppkey", rank.alias("rank"), worker.alias("worker"))


@query("""WITH RECURSIVE c AS (SELECT p_brand AS grp, count(*) AS n FROM part GROUP BY 1), s AS (SELECT row_number() OVER (ORDER BY grp) AS i, grp, CAST(n AS DOUBLE) / (SELECT sum(n) FROM c) AS share FROM c),
  w AS (SELECT list(1 ORDER BY i) AS have, list(share ORDER BY i) AS share, 61 - count(*) AS rest FROM s UNION ALL
  SELECT list_transform(have, lambda x, i: x + CASE WHEN i = list_position(lack, list_min(lack)) THEN 1 ELSE 0 END), share, rest - 1 FROM w, LATERAL (SELECT list_transform(have, lambda y, j: CAST(y AS DOUBLE) / list_sum(have) - share[j]) AS lack) WHERE rest > 0)
  SELECT grp, CAST(have[i] AS INTEGER) AS workers FROM s CROSS JOIN (SELECT have FROM w WHERE rest = 0)""")
def worker_allocation(t):
    counts = t.part.groupBy(F.col("p_brand").alias("grp")).agg(F.count("*").alias("n"))  # a row per group
    return mixture.allocate_workers(counts, "grp", "n", 61)


SHARES_SQL = """c AS (SELECT c_mktsegment AS grp, count(*) AS n FROM customer GROUP BY 1), a AS (SELECT CAST(sum(n) AS BIGINT) AS total FROM c),
  s AS (SELECT grp, n, CAST(ceil(CAST(n AS DOUBLE) / total * 16) AS BIGINT) AS w, CAST(ceil(total / 16.0) AS BIGINT) AS each FROM c, a),
  e AS (SELECT grp, n, each, w + CASE WHEN row_number() OVER (ORDER BY n DESC, grp) = 1 THEN 16 - (SELECT CAST(sum(w) AS BIGINT) FROM s) ELSE 0 END AS workers FROM s)"""


@query(f"WITH {SHARES_SQL} SELECT grp, workers, workers * each AS share FROM e")
def equalize_counts(t):
    counts = t.customer.groupBy(F.col("c_mktsegment").alias("grp")).agg(F.count("*").alias("n"))
    return mixture.equal_shares(counts, "grp", "n", 16)


@query(f"""WITH {SHARES_SQL}, r AS (SELECT c_custkey, c_mktsegment AS grp, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) - 1 AS i FROM customer)
  SELECT c_custkey, grp, CAST(k AS INTEGER) AS copy FROM r JOIN e USING (grp), unnest(range(0, CAST(ceil(workers * each * 1.0 / n) AS BIGINT))) AS u(k) WHERE i + k * n < workers * each""")
def equalize_shards(t):
    rows = t.customer.select("c_custkey", F.col("c_mktsegment").alias("grp"))
    return mixture.equalize(rows, "grp", "c_custkey", 16)


@query("SELECT p_partkey, CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER) AS number FROM part")
def regex_extract(t):
    return t.part.select("p_partkey", F.regexp_extract("p_brand", "([0-9]+)", 1).cast("int").alias("number"))


@query(f"""WITH p AS (SELECT p_partkey, p_retailprice AS x, min(p_retailprice) OVER () AS lo, max(p_retailprice) OVER () AS hi FROM part)
  SELECT p_partkey, round(CASE WHEN {draw_sql(2, 'p_partkey')} < 0.05 THEN 0.0 ELSE least(hi, greatest(lo, x + 10.0 * sqrt(-2 * ln(1 - {draw_sql(0, 'p_partkey')})) * cos(6.283185307179586 * {draw_sql(1, 'p_partkey')}))) END, 6) AS x FROM p""")
def state_noise(t):
    rows = t.part.select("p_partkey", F.col("p_retailprice").alias("x"))
    bounds = rows.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    return mixture.add_noise(rows.join(F.broadcast(bounds)), "x", ["p_partkey"], 10.0, F.col("lo"), F.col("hi"), 0.05).select("p_partkey", r(F.col("x")).alias("x"))


@query("""SELECT 'customer' AS source, n, n // 3 * 6 + n % 3 AS position FROM (SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS n FROM customer)
  UNION ALL SELECT 'part', n, n // 2 * 6 + 3 + n % 2 FROM (SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS n FROM part)
  UNION ALL SELECT 'supplier', n, n * 6 + 5 FROM (SELECT row_number() OVER (ORDER BY s_suppkey) - 1 AS n FROM supplier)""")
def ratio_interleave(t):
    keys = {"customer": "c_custkey", "part": "p_partkey", "supplier": "s_suppkey"}
    rows = {k: ordering.number_rows(getattr(t, k).select(c), [c], "n") for k, c in keys.items()}
    return mixture.interleave_rows(rows, {"customer": 3, "part": 2, "supplier": 1}, "n")


@query("""WITH RECURSIVE b AS (SELECT p_brand, p_retailprice AS score, CAST(p_size AS DOUBLE) AS x0, CAST(p_partkey % 40 AS DOUBLE) AS y0 FROM part WHERE p_retailprice > 100),
  t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY score DESC, x0, y0) AS k FROM b) WHERE k <= 50),
  f AS (SELECT p_brand, 1 AS k, [k] AS kept, [x0] AS xs, [y0] AS ys FROM t WHERE k = 1 UNION ALL
  SELECT f.p_brand, t.k, CASE WHEN ok THEN list_append(kept, t.k) ELSE kept END, CASE WHEN ok THEN list_append(xs, x0) ELSE xs END, CASE WHEN ok THEN list_append(ys, y0) ELSE ys END FROM f JOIN t ON t.p_brand = f.p_brand AND t.k = f.k + 1,
  LATERAL (SELECT len(kept) < 10 AND len(list_filter(range(1, len(xs) + 1), lambda i: greatest(10 - abs(xs[i] - x0), 0) * greatest(10 - abs(ys[i] - y0), 0) / (200 - greatest(10 - abs(xs[i] - x0), 0) * greatest(10 - abs(ys[i] - y0), 0)) > 0.4)) = 0 AS ok))
  SELECT p_brand, score, x0, y0 FROM t JOIN (SELECT p_brand, arg_max(kept, k) AS kept FROM f GROUP BY p_brand) USING (p_brand) WHERE list_contains(kept, k)""")
def box_suppression(t):
    x, y = F.col("p_size").cast("double"), (F.col("p_partkey") % 40).cast("double")
    boxes = t.part.select("p_brand", F.col("p_retailprice").alias("score"), x.alias("x0"), y.alias("y0"), (x + 10).alias("x1"), (y + 10).alias("y1"))
    return mixture.suppress_overlaps(boxes.where("score > 100"), "p_brand", 0.4, 50, 10).select("p_brand", "score", "x0", "y0")


@query("SELECT CASE WHEN success THEN 'train' ELSE 'val' END AS split, count(*) AS episodes, CAST(sum(num_steps) AS BIGINT) AS num_steps FROM (WITH {EPISODES} SELECT * FROM episodes) GROUP BY 1")
def conversion_manifest(t):
    split = F.when(F.col("success"), "train").otherwise("val")
    return t.episodes.groupBy(split.alias("split")).agg(F.count("*").alias("episodes"), F.sum("num_steps").alias("num_steps"))


@query("""SELECT o_orderkey, round(CASE WHEN n <= 50 THEN CASE WHEN n < 10 THEN 0.1 + 0.9 * n / 10 ELSE 0.05 + 0.95 * 0.5 * (1 + cos(least((n - 10) / 40.0, 1.0) * pi())) END
  ELSE CASE WHEN n - 50 < 5 THEN 0.1 + 0.9 * (n - 50) / 5 ELSE 0.05 + 0.95 * 0.5 * (1 + cos(least((n - 55) / 45.0, 1.0) * pi())) END END, 9) AS factor FROM (SELECT o_orderkey, o_orderkey % 101 AS n FROM orders)""")
def lr_schedule(t):
    f = frames.learning_rate(F.col("o_orderkey") % 101, [10, 5], [50, 50], 0.1, 1.0, 0.05, "cosine")
    return t.orders.select("o_orderkey", r(f, 9).alias("factor"))


@query("SELECT p_partkey, CAST(floor(k * (p_size + 20) + 0.5) AS INTEGER) AS w, CAST(floor(k * (p_size + 10) + 0.5) AS INTEGER) AS h FROM (SELECT *, greatest(256.0 / (p_size + 20), 144.0 / (p_size + 10)) AS k FROM part)")
def resize_dims(t):
    w, h = frames.resize(F.col("p_size") + 20, F.col("p_size") + 10, 256, 144)
    return t.part.select("p_partkey", w.alias("w"), h.alias("h"))
