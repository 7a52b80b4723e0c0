"""Queries over steps and episodes."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import frames, geometry, vectors
from millrace.operators import episodic as ep
from millrace.operators import ordering, scan
from millrace.operators.timeseries import runs
from millrace.plans.registry import query, r

K = 3  # steps of a chunk
GAMMA = 0.99


@query("""WITH {STEPS} SELECT episode_id, step_idx, i AS pos, round(CASE i WHEN 0 THEN c0 WHEN 1 THEN c1 ELSE c2 END, 6) AS value FROM (
  SELECT episode_id, step_idx, a1 AS c0, coalesce(lead(a1, 1) OVER w, last_value(a1) OVER f) AS c1, coalesce(lead(a1, 2) OVER w, last_value(a1) OVER f) AS c2
  FROM steps WINDOW w AS (PARTITION BY episode_id ORDER BY step_idx), f AS (PARTITION BY episode_id ORDER BY step_idx ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
  ) CROSS JOIN (SELECT unnest([0, 1, 2]) AS i)""")
def action_chunk(t):
    c = ep.action_chunk(t.steps, "a1", K, "chunk")
    return c.select("episode_id", "step_idx", F.posexplode("chunk").alias("pos", "value")).withColumn("value", r(F.col("value")))


@query("""WITH {STEPS}, n AS (SELECT episode_id, max(step_idx) AS last FROM steps GROUP BY episode_id)
  SELECT s.episode_id, s.step_idx, i AS pos, round(x.a1, 6) AS value FROM steps s JOIN n USING (episode_id) CROSS JOIN (SELECT unnest([0, 1, 2]) AS i)
  JOIN steps x ON x.episode_id = s.episode_id AND x.step_idx = least(least(s.step_idx + 3, last) + i, last)""")
def next_action_chunk(t):
    c = ep.at_offset(ep.action_chunk(t.steps, "a1", K, "chunk"), "chunk", K, "next")
    return c.select("episode_id", "step_idx", F.posexplode("next").alias("pos", "value")).withColumn("value", r(F.col("value")))


@query("""WITH {STEPS}, n AS (SELECT episode_id, max(step_idx) AS last FROM steps GROUP BY episode_id)
  SELECT s.episode_id, s.step_idx, least(s.step_idx + 3, last) AS future_idx, round(x.a1, 6) AS future_a1 FROM steps s JOIN n USING (episode_id)
  JOIN steps x ON x.episode_id = s.episode_id AND x.step_idx = least(s.step_idx + 3, last)""")
def future_state(t):
    s = ep.at_offset(t.steps, "a1", K, "future_a1").withColumn("future_idx", ep.future_index(K))
    return s.select("episode_id", "step_idx", "future_idx", r(F.col("future_a1")).alias("future_a1"))


RETURNS_SQL = """WITH {STEPS}, {EPISODES}, v AS (SELECT s.episode_id, step_idx, num_steps - 1 AS last,
  CASE WHEN success THEN 2 * pow(0.99, num_steps - 1 - step_idx) - 1 ELSE -1.0 END AS value FROM steps s JOIN episodes e ON s.episode_id = e.episode_id)"""


def _returns(t):
    s = t.steps.join(t.episodes.select("episode_id", "success"), "episode_id")
    return ep.returns(s, F.col("success").cast("double"), GAMMA)


@query(RETURNS_SQL + " SELECT episode_id, step_idx, round(value, 6) AS value FROM v")
def mc_returns(t):
    return _returns(t).select("episode_id", "step_idx", r(F.col("value")).alias("value"))


@query(RETURNS_SQL + """ SELECT v.episode_id, v.step_idx, round(x.value, 6) AS future_value, round(y.value, 6) AS next_future_value FROM v
  JOIN v x ON x.episode_id = v.episode_id AND x.step_idx = least(v.step_idx + 3, v.last) JOIN v y ON y.episode_id = v.episode_id AND y.step_idx = least(v.step_idx + 6, v.last)""")
def future_return(t):
    s = ep.at_offset(ep.at_offset(_returns(t), "value", K, "future_value"), "value", 2 * K, "next_future_value")
    return s.select("episode_id", "step_idx", r(F.col("future_value")).alias("future_value"), r(F.col("next_future_value")).alias("next_future_value"))


@query("""WITH {STEPS} SELECT episode_id, step_idx, 3 - k AS pos, greatest(step_idx - k * 2, 0) AS idx FROM steps CROSS JOIN (SELECT unnest([3, 2, 1]) AS k)""")
def history_indices(t):
    return t.steps.select("episode_id", "step_idx", F.posexplode(frames.history(F.col("step_idx"), 3, 2)).alias("pos", "idx"))


@query("""WITH {STEPS} SELECT episode_id, step_idx, round(coalesce(lead(a1) OVER w - a1, a1 - lag(a1) OVER w, 0), 6) AS rel FROM steps
  WINDOW w AS (PARTITION BY episode_id ORDER BY step_idx)""")
def relative_action(t):
    return t.steps.select("episode_id", "step_idx", r(ep.forward_difference("a1")).alias("rel"))


@query("""WITH {STEPS} SELECT episode_id, step_idx, round(CASE WHEN lag(a0) OVER w IS NOT NULL AND lead(a0) OVER w IS NOT NULL THEN (lead(a0) OVER w - lag(a0) OVER w) / 2
  WHEN lead(a0) OVER w IS NOT NULL THEN lead(a0) OVER w - a0 ELSE a0 - lag(a0) OVER w END / 0.04, 4) AS grad FROM steps WINDOW w AS (PARTITION BY episode_id ORDER BY step_idx)""")
def gradient(t):
    return t.steps.select("episode_id", "step_idx", r(ep.gradient("a0", 0.04), 4).alias("grad"))


@query("""WITH {STEPS} SELECT x.episode_id, x.step_idx, round(x.a1 - b.a1, 6) AS delta FROM steps x
  JOIN steps b ON b.episode_id = x.episode_id AND b.step_idx = CAST(floor((x.step_idx - 1) / 2.0) AS INTEGER) * 2 WHERE x.step_idx > 0""")
def chunk_baseline_delta(t):
    return ep.chunk_baseline_delta(t.steps, "a1", 2, "delta").select("episode_id", "step_idx", r(F.col("delta")).alias("delta"))


@query("""WITH {STEPS}, n AS (SELECT episode_id, max(step_idx) + 1 AS n FROM steps GROUP BY episode_id)
  SELECT episode_id, k * 2 AS first, k * 2 + 4 AS last FROM n CROSS JOIN (SELECT unnest(range(0, 50)) AS k) WHERE k * 2 + 4 < n""")
def sliding_sequences(t):
    starts = frames.sequences(F.col("num_steps"), 3, 2, 2)
    return t.episodes.select("episode_id", F.explode(starts).alias("first")).withColumn("last", F.col("first") + 4)


@query("""WITH {EPISODES} SELECT episode_id, s AS stride, k * 2 AS first FROM episodes CROSS JOIN (SELECT unnest([1, 2, 3]) AS s) CROSS JOIN (SELECT unnest(range(0, 50)) AS k)
  WHERE k * 2 + 2 * s < num_steps""")
def multi_stride_sequences(t):
    each = F.array(*[F.struct(F.lit(s).alias("stride"), frames.sequences(F.col("num_steps"), 3, 2, s).alias("starts")) for s in (1, 2, 3)])
    return t.episodes.select("episode_id", F.inline(each)).select("episode_id", "stride", F.explode("starts").alias("first"))


@query("""WITH {STEPS}, m AS (SELECT *, CASE WHEN abs(a2 - 0.05) >= 0.03 THEN 1 ELSE 0 END AS moves, lag(a3) OVER w AS grip FROM steps WINDOW w AS (PARTITION BY episode_id ORDER BY step_idx)),
  o AS (SELECT *, coalesce(max(moves) OVER (PARTITION BY episode_id ORDER BY step_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS opened FROM m)
  SELECT episode_id, step_idx FROM o WHERE moves = 1 OR (opened = 1 AND a3 <> grip)""")
def noop_filter(t):
    return ep.drop_noops(t.steps, F.abs(F.col("a2") - 0.05), "a3", 0.03).select("episode_id", "step_idx")


@query("""WITH {STEPS}, b AS (SELECT *, max(CASE WHEN a0 > 40 THEN 1 ELSE 0 END) OVER (PARTITION BY episode_id ORDER BY step_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS done FROM steps)
  SELECT episode_id, step_idx FROM b WHERE coalesce(done, 0) = 0""")
def trim_after_success(t):
    return ep.until_success(t.steps, F.col("a0") > 40).select("episode_id", "step_idx")


@query("""WITH {STEPS} SELECT episode_id, step_idx FROM (SELECT *, count(*) OVER (PARTITION BY episode_id) AS n FROM steps) WHERE n >= 5""")
def min_length_filter(t):
    return ep.long_enough(t.steps, 5).select("episode_id", "step_idx")


@query("""WITH {EPISODES} SELECT episode_id, num_steps FROM episodes WHERE success""")
def success_filter(t):
    return t.episodes.where("success").select("episode_id", "num_steps")


@query("""SELECT l_orderkey AS episode_id, count(*) AS frames, count(DISTINCT l_linenumber) AS actions FROM lineitem GROUP BY l_orderkey HAVING count(*) <> count(DISTINCT l_linenumber)""")
def length_mismatch_filter(t):
    n = t.lineitem.groupBy(F.col("l_orderkey").alias("episode_id")).agg(F.count("*").alias("frames"), F.count_distinct("l_linenumber").alias("actions"))
    return n.where("frames <> actions")


@query("""WITH {STEPS}, n AS (SELECT episode_id, max(step_idx) AS last FROM steps GROUP BY episode_id)
  SELECT s.episode_id, s.step_idx, d AS delta, round(x.a1, 6) AS absolute, round(CASE WHEN s.step_idx + d BETWEEN 0 AND last THEN x.a1 ELSE 0 END, 6) AS relative
  FROM steps s JOIN n USING (episode_id) CROSS JOIN (SELECT unnest([-1, 0, 2]) AS d) JOIN steps x ON x.episode_id = s.episode_id AND x.step_idx = greatest(0, least(s.step_idx + d, last))""")
def delta_gather(t):
    return ep.gather_ends(t.steps, "a1", [-1, 0, 2]).withColumns({c: r(F.col(c)) for c in ("absolute", "relative")})


@query("""WITH {STEPS} SELECT episode_id, step_idx, CASE WHEN step_idx = max(step_idx) OVER (PARTITION BY episode_id) THEN 1 ELSE 0 END AS done FROM steps""")
def terminal_flags(t):
    return t.steps.select("episode_id", "step_idx", ep.terminal_flag().alias("done"))


@query("""WITH {STEPS} SELECT episode_id, round(max(d), 4) AS max_step FROM (SELECT episode_id, sqrt(pow(a0 - lag(a0) OVER w, 2) + pow(a2 - lag(a2) OVER w, 2)) AS d FROM steps
  WINDOW w AS (PARTITION BY episode_id ORDER BY step_idx)) GROUP BY episode_id""")
def max_step_norm(t):
    w = ep.episode()
    d = F.sqrt(F.pow(F.col("a0") - F.lag("a0").over(w), 2.0) + F.pow(F.col("a2") - F.lag("a2").over(w), 2.0))
    return t.steps.withColumn("d", d).groupBy("episode_id").agg(r(F.max("d"), 4).alias("max_step"))


@query("""WITH {STEPS}, d AS (SELECT *, CASE WHEN lag(a0) OVER w IS NULL THEN NULL ELSE (lag(a0) OVER w - 25) * (a0 - 25) END AS dot FROM steps WINDOW w AS (PARTITION BY episode_id ORDER BY step_idx)),
  b AS (SELECT *, sum(CASE WHEN dot = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY episode_id ORDER BY step_idx) AS block FROM d)
  SELECT episode_id, step_idx, CASE WHEN sum(CASE WHEN dot < 0 THEN 1 ELSE 0 END) OVER (PARTITION BY episode_id, block ORDER BY step_idx) % 2 = 1 THEN -1 ELSE 1 END AS sign FROM b""")
def quat_continuity(t):
    dot = (F.lag("a0").over(ep.episode()) - 25) * (F.col("a0") - 25)
    return ep.sign_continuity(t.steps, dot).select("episode_id", "step_idx", "sign")


@query("""WITH RECURSIVE {STEPS}, s AS (SELECT episode_id, step_idx, a0 / 10 AS x, a2 * 10 AS y, a3 * 10 AS z, sqrt(a0 * a0 / 100 + 100 * a2 * a2 + 100 * a3 * a3) AS n FROM steps),
  u AS (SELECT episode_id, step_idx, 1.0::DOUBLE AS f, x, y, z FROM s WHERE step_idx = 0 UNION ALL SELECT episode_id, step_idx, f, x0 * f, y0 * f, z0 * f FROM (SELECT s.episode_id, s.step_idx, s.x AS x0, s.y AS y0, s.z AS z0,
  CASE WHEN s.n < 1e-8 THEN 1.0 ELSE 1 + 2 * pi() / s.n * list_min(list_transform(range(-2, 3), lambda k: {'d': pow(s.x * (1 + 2 * pi() * k / s.n) - u.x, 2) + pow(s.y * (1 + 2 * pi() * k / s.n) - u.y, 2) + pow(s.z * (1 + 2 * pi() * k / s.n) - u.z, 2), 'k': k})).k END AS f
  FROM u JOIN s ON s.episode_id = u.episode_id AND s.step_idx = u.step_idx + 1))
  SELECT episode_id, step_idx, round(x, 6) + 0.0 AS x, round(y, 6) + 0.0 AS y, round(z, 6) + 0.0 AS z FROM u""")
def rotvec_unwrap(t):
    s = t.steps.select("episode_id", "step_idx", (F.col("a0") / 10).alias("x"), (F.col("a2") * 10).alias("y"), (F.col("a3") * 10).alias("z"))
    return ep.unwrap_rotations(s, ["x", "y", "z"]).withColumns({c: r(F.col(c)) for c in "xyz"})


@query("""WITH {STEPS}, p AS (SELECT episode_id, step_idx, a0 AS x, a1 / 1000 AS y, a2 AS z, a3 AS yaw, lag(a0) OVER w AS px, lag(a1 / 1000) OVER w AS py, lag(a2) OVER w AS pz, lag(a3) OVER w AS pyaw
  FROM steps WINDOW w AS (PARTITION BY episode_id ORDER BY step_idx))
  SELECT episode_id, step_idx, round(cos(pyaw) * (x - px) + sin(pyaw) * (y - py), 7) + 0.0 AS dx, round(-sin(pyaw) * (x - px) + cos(pyaw) * (y - py), 7) + 0.0 AS dy, round(z - pz, 7) + 0.0 AS dz
  FROM p WHERE step_idx > 0""")
def relative_pose(t):
    s = t.steps.select("episode_id", "step_idx", F.col("a0").alias("x"), (F.col("a1") / 1000).alias("y"), F.col("a2").alias("z"), F.lit(0.0).alias("roll"), F.lit(0.0).alias("pitch"), F.col("a3").alias("yaw"))
    out = ep.relative_poses(s, ["x", "y", "z"], ["roll", "pitch", "yaw"])
    return out.select("episode_id", "step_idx", *[r(F.col(c), 7).alias(c) for c in ("dx", "dy", "dz")])


@query("""WITH {STEPS} SELECT s.episode_id, s.step_idx, round(cos(b.a3) * (s.a0 - b.a0) + sin(b.a3) * (s.a1 - b.a1) / 1000, 7) + 0.0 AS dx, round(-sin(b.a3) * (s.a0 - b.a0) + cos(b.a3) * (s.a1 - b.a1) / 1000, 7) + 0.0 AS dy, round(s.a2 - b.a2, 7) + 0.0 AS dz
  FROM steps s JOIN steps b ON b.episode_id = s.episode_id AND b.step_idx = (s.step_idx - 1) // 4 * 4 WHERE s.step_idx > 0""")
def anchored_pose(t):
    s = t.steps.select("episode_id", "step_idx", F.col("a0").alias("x"), (F.col("a1") / 1000).alias("y"), F.col("a2").alias("z"), F.lit(0.0).alias("roll"), F.lit(0.0).alias("pitch"), F.col("a3").alias("yaw"))
    out = ep.relative_poses(s, ["x", "y", "z"], ["roll", "pitch", "yaw"], anchor_every=4)
    return out.select("episode_id", "step_idx", *[r(F.col(c), 7).alias(c) for c in ("dx", "dy", "dz")])


@query("""WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings), a AS (SELECT vec_id, arm, v[arm * 8 + 1:arm * 8 + 3] AS p, v[arm * 8 + 4:arm * 8 + 7] AS q FROM e CROSS JOIN (SELECT unnest([0, 1]) AS arm)),
  n AS (SELECT vec_id, arm, p, q[1] / l AS x, q[2] / l AS y, q[3] / l AS z, q[4] / l AS w FROM (SELECT *, sqrt(q[1] * q[1] + q[2] * q[2] + q[3] * q[3] + q[4] * q[4]) AS l FROM a)),
  k AS (SELECT *, 2 * atan2(sqrt(x * x + y * y + z * z), abs(w)) / sqrt(x * x + y * y + z * z) * CASE WHEN w < 0 THEN -1 ELSE 1 END AS k FROM n)
  SELECT vec_id, CAST(arm * 6 + i - 1 AS INTEGER) AS pos, round(list_concat(p, [x * k, y * k, z * k])[i], 5) + 0.0 AS value FROM k CROSS JOIN (SELECT unnest(range(1, 7)) AS i)""")
def pose_vectors(t):
    v = F.slice("embedding", 1, 16).cast("array<double>")
    out = ep.pose_vectors(t.embeddings.select("vec_id", v.alias("pose")), "pose", "pose12")
    return out.select("vec_id", F.posexplode("pose12").alias("pos", "value")).withColumn("value", r(F.col("value"), 5))


@query("""WITH {EPISODES} SELECT episode_id, num_steps, sum(num_steps) OVER (ORDER BY episode_id) - num_steps AS start FROM episodes""")
def global_step_index(t):
    return ordering.running_total(t.episodes, ["episode_id"], F.col("num_steps").cast("long"), "start").select("episode_id", "num_steps", "start")


@query("""WITH {EPISODES} SELECT episode_id, success, row_number() OVER (PARTITION BY success ORDER BY episode_id) - 1 AS idx FROM episodes""")
def split_index(t):
    parts = [ordering.number_rows(t.episodes.where(F.col("success") == ok), ["episode_id"], "idx") for ok in (True, False)]
    return parts[0].unionByName(parts[1]).select("episode_id", "success", "idx")


@query("""WITH {EPISODES} SELECT command, count(*) AS episodes, CAST(sum(num_steps) AS BIGINT) AS steps, max(num_steps) AS longest FROM episodes GROUP BY command""")
def group_step_counts(t):
    return t.episodes.groupBy("command").agg(F.count("*").alias("episodes"), F.sum("num_steps").alias("steps"), F.max("num_steps").alias("longest"))


@query("SELECT DISTINCT o_orderpriority AS command FROM orders")
def distinct_commands(t):
    return t.orders.select(F.col("o_orderpriority").alias("command")).distinct()


@query("""WITH {STEPS} SELECT episode_id, step_idx, a0, a1 FROM steps WHERE episode_id IN (1, 33, 101) AND step_idx BETWEEN 0 AND 2""")
def partial_episode_read(t):
    return t.steps.where(F.col("episode_id").isin(1, 33, 101) & F.col("step_idx").between(0, 2)).select("episode_id", "step_idx", "a0", "a1")


@query("SELECT o_orderkey AS episode_id, o_orderstatus AS status FROM orders")
def lazy_metadata_scan(t):
    return t.orders.select(F.col("o_orderkey").alias("episode_id"), F.col("o_orderstatus").alias("status"))


@query("SELECT l_orderkey, l_quantity FROM lineitem")
def column_pruned_scan(t):
    return t.lineitem.select("l_orderkey", "l_quantity")


@query("""SELECT p_partkey, round(cos(y) * cos(p), 6) + 0.0 AS m0, round(2 * atan2(sin(y / 2), cos(y / 2)), 6) + 0.0 AS yaw, round(p, 6) + 0.0 AS pitch FROM (
  SELECT p_partkey, (p_size - 25) / 10.0 AS y, (p_size - 25) / 40.0 AS p FROM part)""")
def euler_roundtrip(t):
    y, p, roll = (F.col("p_size") - 25) / 10.0, (F.col("p_size") - 25) / 40.0, (F.col("p_size") - 25) / 30.0
    m = geometry.euler_to_matrix(roll, p, y)
    back = geometry.matrix_to_euler(m)
    return t.part.select("p_partkey", r(m[0]).alias("m0"), r(back[2]).alias("yaw"), r(back[1]).alias("pitch"))


@query("""WITH q AS (SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z, embedding[4]::DOUBLE AS w FROM embeddings),
  n AS (SELECT vec_id, x / s AS x, y / s AS y, z / s AS z, w / s AS w FROM (SELECT *, sqrt(x*x + y*y + z*z + w*w) AS s FROM q))
  SELECT vec_id, round(1 - 2 * (y*y + z*z), 4) + 0.0 AS m00, round(2 * (x*y - z*w), 4) + 0.0 AS m01, round(w*w - x*x - y*y - z*z, 4) + 0.0 AS square_w, 1.0 AS identity_w FROM n""")
def quaternion_ops(t):
    q = geometry.quaternion_normalize([F.get("embedding", F.lit(i)).cast("double") for i in range(4)])
    rows = t.embeddings.select("vec_id", *[x.alias(f"q{i}") for i, x in enumerate(q)])
    q = [F.col(f"q{i}") for i in range(4)]
    m, sq, one = geometry.quaternion_to_matrix(q), geometry.quaternion_multiply(q, q), geometry.quaternion_multiply(q, geometry.quaternion_invert(q))
    return rows.select("vec_id", r(m[0], 4).alias("m00"), r(m[1], 4).alias("m01"), r(sq[3], 4).alias("square_w"), r(one[3], 4).alias("identity_w"))


@query("""SELECT vec_id, round(500 * x / (z + 10) + 320, 4) AS u, round(500 * y / (z + 10) + 240, 4) AS v FROM (
  SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings)""")
def project_points(t):
    x, y, z = (F.get("embedding", F.lit(i)).cast("double") for i in range(3))
    u = geometry.project([x, y, z + 10], *[F.lit(float(k)) for k in (500, 500, 320, 240)])
    return t.embeddings.select("vec_id", r(u[0], 4).alias("u"), r(u[1], 4).alias("v"))


@query("""SELECT p_partkey, round((p_size - 320.0) / 500 * p_retailprice, 4) AS x, round((p_size * 2 - 240.0) / 500 * p_retailprice, 4) AS y, p_retailprice AS z FROM part""")
def backproject(t):
    p = geometry.backproject(F.col("p_size"), F.col("p_size") * 2, F.col("p_retailprice"), *[F.lit(float(k)) for k in (500, 500, 320, 240)])
    return t.part.select("p_partkey", r(p[0], 4).alias("x"), r(p[1], 4).alias("y"), p[2].alias("z"))


@query("""SELECT s_suppkey, CAST(s_nationkey + 500 AS DOUBLE) AS fx, CAST(s_suppkey % 7 AS DOUBLE) AS tx FROM supplier""")
def camera_params(t):
    text = F.concat_ws(" ", F.lit(" "), F.col("s_nationkey") + 500, F.lit("500  320 240 0 0 0 1"), F.col("s_suppkey") % 7, F.lit("2 3"))
    p = geometry.parse_camera(text)
    return t.supplier.select("s_suppkey", F.get(p, F.lit(0)).alias("fx"), F.get(p, F.lit(8)).alias("tx"))


@query("""WITH v AS (SELECT vec_id, label, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings),
  s AS (SELECT label, 1 / avg(sqrt(x*x + y*y + z*z)) AS k FROM v GROUP BY label) SELECT vec_id, round(x * k, 5) AS x, round(y * k, 5) AS y, round(z * k, 5) AS z FROM v JOIN s USING (label)""")
def pointcloud_rescale(t):
    rows = t.embeddings.select("vec_id", "label", *[F.get("embedding", F.lit(i)).cast("double").alias(c) for i, c in enumerate("xyz")])
    scale = rows.groupBy("label").agg((1 / F.avg(F.sqrt(F.expr("x*x + y*y + z*z")))).alias("k"))
    return rows.join(F.broadcast(scale), "label").select("vec_id", *[r(F.col(c) * F.col("k"), 5).alias(c) for c in "xyz"])


@query("""WITH v AS (SELECT l_orderkey, l_extendedprice AS d FROM lineitem), ok AS (SELECT l_orderkey, quantile_disc(d, 0.5) AS m FROM v WHERE d > 1000 AND d < 90000 GROUP BY l_orderkey)
  SELECT l_orderkey, round(d, 2) AS d, round(CASE WHEN d > 1000 AND d < 90000 AND d <= 1.5 * m THEN d ELSE 90000 END, 2) AS masked FROM v LEFT JOIN ok USING (l_orderkey)""")
def depth_mask(t):
    d = F.col("l_extendedprice")
    valid = (d > 1000) & (d < 90000)
    middle = t.lineitem.where(valid).groupBy("l_orderkey").agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY l_extendedprice)").alias("m"))
    rows = t.lineitem.join(middle, "l_orderkey", "left")
    return rows.select("l_orderkey", r(d, 2).alias("d"), r(F.when(valid & (d <= 1.5 * F.col("m")), d).otherwise(90000.0), 2).alias("masked"))


@query("""SELECT vec_id, i AS pos, round(embedding[i + 9]::DOUBLE, 5) AS value FROM embeddings CROSS JOIN (SELECT unnest([0, 1, 2, 3]) AS i)""")
def modality_slice(t):
    return t.embeddings.select("vec_id", F.posexplode(vectors.take(F.col("embedding").cast("array<double>"), 8, 12)).alias("pos", "value")).withColumn("value", r(F.col("value"), 5))


@query("""SELECT vec_id, 64 AS width, true AS same FROM embeddings""")
def concat_roundtrip(t):
    v = F.col("embedding")
    parts = [vectors.take(v, 0, 10), vectors.take(v, 10, 40), vectors.take(v, 40, 64)]
    return t.embeddings.select("vec_id", F.size(F.concat(*parts)).alias("width"), (F.concat(*parts) == v).alias("same"))


@query("""WITH {STEPS} SELECT episode_id, step_idx, 29 AS width, round(a1, 6) AS at_18, 0.0 AS at_3 FROM steps""")
def embed_vector(t):
    v = vectors.embed(F.col("action"), 17, 8)
    return t.steps.select("episode_id", "step_idx", F.size(v).alias("width"), r(F.get(v, F.lit(18))).alias("at_18"), F.get(v, F.lit(3)).alias("at_3"))


@query("""WITH {STEPS} SELECT episode_id, step_idx, i AS pos, round(CASE i // 2 WHEN 0 THEN a0 WHEN 1 THEN a1 WHEN 2 THEN a2 ELSE a3 END, 6) AS value FROM steps CROSS JOIN (SELECT unnest(range(0, 8)) AS i)""")
def repeat_interleave(t):
    v = vectors.repeat_interleave(F.col("action"), 2)
    return t.steps.select("episode_id", "step_idx", F.posexplode(v).alias("pos", "value")).withColumn("value", r(F.col("value")))


@query("""WITH {STEPS}, n AS (SELECT episode_id, max(step_idx) + 1 AS n FROM steps GROUP BY episode_id)
  SELECT episode_id, i AS pos, coalesce(round(a0, 6), -1.0) AS value, CASE WHEN a0 IS NULL THEN 0 ELSE 1 END AS mask FROM n CROSS JOIN (SELECT unnest(range(0, 6)) AS i)
  LEFT JOIN (SELECT episode_id, step_idx AS i, a0 FROM steps) USING (episode_id, i)""")
def pad_tokens(t):
    v = t.steps.groupBy("episode_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("step_idx", "a0"))), lambda s: s["a0"]).alias("v"))
    both = F.arrays_zip(vectors.pad_to(F.col("v"), 6, F.lit(-1.0)).alias("value"), vectors.pad_mask(F.col("v"), 6).alias("mask"))
    return v.select("episode_id", F.posexplode(both).alias("pos", "p")).select("episode_id", "pos", r(F.col("p.value")).alias("value"), "p.mask")


@query("""SELECT l_orderkey, l_linenumber, count(*) AS n, round(sum(l_linenumber / 255.0 * (l_quantity - 1) + 1), 4) AS total FROM lineitem GROUP BY ALL""")
def debin(t):
    x = vectors.debin(F.col("l_linenumber"), 256, F.lit(1.0), F.col("l_quantity"))
    return t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n"), r(F.sum(x), 4).alias("total"))


@query("""WITH {STEPS} SELECT episode_id, step_idx, round(sin(a2), 6) AS s2, round(cos(a2), 6) AS c2 FROM steps""")
def sincos(t):
    v = vectors.sincos(F.col("action"))
    return t.steps.select("episode_id", "step_idx", r(F.get(v, F.lit(2))).alias("s2"), r(F.get(v, F.lit(6))).alias("c2"))


@query("""SELECT p_partkey, i AS pos, round(CASE WHEN i < 4 THEN sin(p_size / pow(10000.0, i / 4.0)) ELSE cos(p_size / pow(10000.0, (i - 4) / 4.0)) END, 5) AS value
  FROM part CROSS JOIN (SELECT unnest(range(0, 8)) AS i)""")
def sincos_embedding(t):
    v = vectors.position_embedding(F.col("p_size"), 8)
    return t.part.select("p_partkey", F.posexplode(v).alias("pos", "value")).withColumn("value", r(F.col("value"), 5))


@query("""SELECT p_partkey, CAST(round_even(greatest(0, least(1, (p_size - 5) / 40.0)) * 255, 0) AS INTEGER) AS byte FROM part""")
def to_uint8(t):
    return t.part.select("p_partkey", vectors.to_uint8((F.col("p_size") - 5) / 40.0).alias("byte"))


@query("""SELECT vec_id, label <> 3 AS ok FROM embeddings""")
def finite_check(t):
    bad = F.when(F.col("label") == 3, F.array(F.lit(float("nan")), F.lit(1.0))).otherwise(F.col("embedding").cast("array<double>"))
    return t.embeddings.select("vec_id", vectors.all_finite(bad).alias("ok"))


@query("""SELECT vec_id, label % 4 <> 0 AS ok FROM embeddings""")
def mask_check(t):
    m = F.when(F.col("label") % 4 == 0, F.array(F.lit(0.0), F.lit(0.0))).otherwise(F.array(F.lit(0.0), F.lit(1.0)))
    return t.embeddings.select("vec_id", vectors.is_mask(m).alias("ok"))


@query("""WITH {STEPS}, m AS (SELECT episode_id, count(*) AS n, sum(CASE WHEN a0 > 10 THEN 1 ELSE 0 END) AS active FROM steps GROUP BY episode_id)
  SELECT episode_id, round(n / active, 6) AS weight FROM m WHERE active > 0""")
def availability_weight(t):
    m = t.steps.groupBy("episode_id").agg(F.collect_list((F.col("a0") > 10).cast("double")).alias("mask")).where(F.exists("mask", lambda x: x > 0))
    return m.select("episode_id", r(F.array_max(vectors.availability_weights(F.col("mask")))).alias("weight"))


@query("""WITH RECURSIVE {STEPS}, e AS (SELECT episode_id, step_idx, a0 AS ema FROM steps WHERE step_idx = 0 UNION ALL
  SELECT s.episode_id, s.step_idx, 0.9 * e.ema + 0.1 * s.a0 FROM e JOIN steps s ON s.episode_id = e.episode_id AND s.step_idx = e.step_idx + 1)
  SELECT episode_id, round(arg_max(ema, step_idx), 9) AS ema FROM e GROUP BY episode_id""")
def ema_fold(t):
    v = t.steps.groupBy("episode_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("step_idx", "a0"))), lambda s: s["a0"]).alias("v"))
    return v.select("episode_id", r(vectors.fold_ema(F.col("v"), 0.9), 9).alias("ema"))


@query("""WITH e AS (SELECT event_id, value, row_number() OVER (ORDER BY event_id) - 1 AS i FROM events), k AS (SELECT unnest(range(0, 400)) AS k)
  SELECT e.event_id, round(sum(x.value * pow(0.9, k) * CASE WHEN x.i = 0 THEN 1 ELSE 0.1 END), 5) AS ema FROM e CROSS JOIN k JOIN e x ON x.i = e.i - k GROUP BY e.event_id""")
def ema_stream(t):
    """A moving average along the whole table, one sequence: weights of more than 400 steps are below 1e-18."""
    rows = ordering.number_rows(t.events.select("event_id", "value"), ["event_id"], "i")
    return scan.moving_average(rows, [], "i", "value", 0.9).select("event_id", r(F.col("ema"), 5).alias("ema"))


@query("""WITH {STEPS} SELECT s.episode_id, s.step_idx, round(sum(x.a0 * pow(0.951229424500714, x.step_idx - s.step_idx)), 6) AS value FROM steps s JOIN steps x ON x.episode_id = s.episode_id AND x.step_idx >= s.step_idx GROUP BY 1, 2""")
def discounted_sums(t):
    return scan.discounted_sums(t.steps.select("episode_id", "step_idx", "a0"), ["episode_id"], "step_idx", "a0", 0.951229424500714).select("episode_id", "step_idx", r(F.col("value")).alias("value"))


@query("""WITH d AS (SELECT conv_id, turn, role, CASE WHEN lag(role) OVER w IS NULL OR role = lag(role) OVER w THEN 0 ELSE 1 END AS changed FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
  SELECT conv_id, turn, sum(changed) OVER (PARTITION BY conv_id ORDER BY turn) AS run FROM d""")
def consecutive_runs(t):
    return runs(t.conversations, ["conv_id"], ["turn"], "role").select("conv_id", "turn", "run")
