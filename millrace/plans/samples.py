"""Queries for rules on single samples: frames, captions, names, rotations, ranks, chains and checks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from millrace.functions import geometry, text, vectors
from millrace.functions.draws import draw_sql
from millrace.operators import chain, episodic, mixture, ordering, sampling, stats, table_functions, timeseries, validate
from millrace.plans.align import EVENTS_SQL, _events, _nearest_sql
from millrace.plans.metrics import DIMS_SQL, RANKS_SQL, STATS_SQL, _ranks, _round, _vectors
from millrace.plans.registry import query, r
from millrace.streaming import metrics as streaming


@query("SELECT p_partkey, p_size FROM part WHERE p_size >= 10 AND p_size <= 30")
def fps_range_filter(t):
    return t.part.where(F.col("p_size").between(10, 30)).select("p_partkey", "p_size")


@query("SELECT doc_id FROM documents WHERE doc_id % 17 <> 0 AND doc_id % 19 <> 0")
def empty_caption_filter(t):
    c = F.when(F.col("doc_id") % 17 == 0, F.lit("  ")).when(F.col("doc_id") % 19 == 0, F.lit(None)).otherwise(F.lit("a caption"))
    rows = t.documents.select("doc_id", c.alias("caption"))
    return rows.where(F.coalesce(F.trim("caption") != "", F.lit(False))).select("doc_id")


@query("SELECT p_partkey, CASE WHEN contains(p_type, 'STEEL') THEN 'fold the shirt' WHEN contains(p_type, 'BRASS') THEN 'put the candy in the bowl' ELSE 'stack the plates' END AS command FROM part")
def command_from_keywords(t):
    name = F.concat(F.lit("/data/"), F.col("p_type"), F.lit("_any"))
    return t.part.select("p_partkey", text.command_from_keywords(name, {"STEEL": "fold the shirt", "BRASS": "put the candy in the bowl", "_any": "stack the plates"}).alias("command"))


@query("SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'goal' WHEN 1 THEN 'spatial' END AS suite FROM part")
def suite_from_path(t):
    path = F.when(F.col("p_size") % 3 == 0, F.lit("goal/spatial/a.hdf5")).when(F.col("p_size") % 3 == 1, F.lit("x/my_spatial_set/a.hdf5")).otherwise(F.lit("x/y.hdf5"))
    return t.part.select("p_partkey", text.suite_from_path(path, ["spatial", "goal"]).alias("suite"))


@query(f"""SELECT p_partkey, CAST(floor({draw_sql(4, 'p_partkey')} * (p_size - 8)) AS INTEGER) AS first, CAST(floor({draw_sql(4, 'p_partkey')} * (p_size - 8)) AS INTEGER) + 9 AS "end" FROM part WHERE p_size >= 9""")
def consecutive_frames(t):
    f = sampling.consecutive(F.col("p_size"), 9, mixture.draw(F.col("p_partkey"), seed=4))
    return t.part.withColumn("f", f).where("f is not null").select("p_partkey", "f.first", "f.end")


@query(f"SELECT c_custkey, position FROM (SELECT c_custkey, row_number() OVER (ORDER BY {draw_sql(8, 'c_custkey')}, c_custkey) - 1 AS position FROM customer) WHERE position // 4 >= 100 // 4")
def shuffle_resume(t):
    return sampling.shuffled(t.customer.select("c_custkey"), "c_custkey", 8, start=100, workers=4)


@query(f"""WITH s AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS p FROM customer), k AS (SELECT *, floor({draw_sql(2, 'p')} * 32) AS slot FROM s),
  l AS (SELECT *, lead(p) OVER (PARTITION BY slot ORDER BY p) AS goes FROM k)
  SELECT c_custkey, row_number() OVER (ORDER BY CASE WHEN goes IS NULL THEN 1 ELSE 0 END, coalesce(goes, slot)) - 1 AS replayed_at FROM l""")
def cached_replay(t):
    rows = ordering.number_rows(t.customer.select("c_custkey"), ["c_custkey"], "p")
    return sampling.replay(rows, "p", 32, 2).select("c_custkey", "replayed_at")


@query("SELECT n_nationkey, i AS out_position FROM (SELECT unnest(range(0, 33)) AS i) JOIN nation ON n_nationkey = i % 7")
def repeat_first_items(t):
    rows = ordering.number_rows(t.nation, ["n_nationkey"])
    return sampling.repeat_first(rows, "position", 7, 33).select("n_nationkey", "out_position")


@query("SELECT 'rollout' AS source, o_orderkey AS episode_id FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'demo', o_orderkey FROM orders WHERE o_orderstatus = 'O'")
def union_demos(t):
    rollout = t.orders.where("o_orderstatus = 'F'").select(F.lit("rollout").alias("source"), F.col("o_orderkey").alias("episode_id"))
    demo = t.orders.where("o_orderstatus = 'O'").select(F.lit("demo").alias("source"), F.col("o_orderkey").alias("episode_id"))
    return rollout.unionByName(demo)


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_type ELSE 'none' END AS kind, CAST(user_id AS VARCHAR) AS who, CASE WHEN event_id % 2 = 0 THEN 2 ELSE 1 END + 0 AS n FROM events")
def merge_maps(t):
    left = F.create_map(F.lit("kind"), F.lit("none"), F.lit("who"), F.col("user_id").cast("string"))
    right = F.when(F.col("event_id") % 2 == 0, F.create_map(F.lit("kind"), F.col("event_type")))
    n = F.when(F.col("event_id") % 2 == 0, 2).otherwise(1)
    both = t.events.select("event_id", text.merge_maps(left, right).alias("m"), n.alias("n"))
    return both.select("event_id", F.element_at("m", F.lit("kind")).alias("kind"), F.element_at("m", F.lit("who")).alias("who"), "n")


@query("SELECT position, c_custkey, s_suppkey FROM (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS position FROM customer) JOIN (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS position FROM supplier) USING (position)")
def dataset_zip(t):
    a, b = ordering.number_rows(t.customer.select("c_custkey"), ["c_custkey"]), ordering.number_rows(t.supplier.select("s_suppkey"), ["s_suppkey"])
    return sampling.zip_tables({"a": a, "b": b}, "position").select("position", "a.c_custkey", "b.s_suppkey")


@query("""WITH g AS (SELECT CAST(ceil(o_orderkey / 100.0) AS BIGINT) * 100 AS iteration, o_orderkey % 100 = 0 AS log, CASE WHEN o_orderstatus = 'F' THEN 'image' ELSE 'video' END AS kind,
  sqrt(o_custkey * o_custkey + CASE WHEN o_orderpriority LIKE '1%' THEN 0 ELSE o_totalprice * o_totalprice END) AS norm FROM orders), w AS (SELECT iteration FROM g GROUP BY 1 HAVING bool_or(log))
  SELECT iteration, kind, round(coalesce(avg(norm), 0), 6) AS mean FROM w CROSS JOIN (SELECT unnest(['image', 'video']) AS kind) LEFT JOIN g USING (iteration, kind) GROUP BY 1, 2""")
def gradient_norm_mean(t):
    gradient = F.array(F.col("o_custkey").cast("double"), F.when(F.col("o_orderpriority").startswith("1"), F.lit(float("inf"))).otherwise(F.col("o_totalprice").cast("double")))
    kind = F.when(F.col("o_orderstatus") == "F", "image").otherwise("video")
    steps = t.orders.select("o_orderkey", kind.alias("kind"), gradient.alias("gradient"))
    return stats.gradient_norm_means(steps, "o_orderkey", "kind", ["image", "video"], "gradient", 100).withColumn("mean", r(F.col("mean")))


@query("SELECT position AS s, CAST(position % 4 AS INTEGER) AS rank, s_suppkey FROM (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS position FROM supplier)")
def interleaved_gather(t):
    rows = ordering.number_rows(t.supplier.select("s_suppkey"), ["s_suppkey"], "n")
    dealt = rows.select("s_suppkey", (F.col("n") % 4).cast("int").alias("rank"), F.floor(F.col("n") / 4).alias("local"))
    filler = t.spark.range(4).select(F.lit(None).cast("long").alias("s_suppkey"), F.col("id").cast("int").alias("rank"), F.lit(1 << 40).alias("local"))
    total = t.supplier.agg(F.count("*").alias("total"))  # one row
    both = dealt.unionByName(filler.withColumn("s_suppkey", F.col("s_suppkey").cast(rows.schema["s_suppkey"].dataType))).join(F.broadcast(total))
    return sampling.gather_ranks(both, "rank", "local", F.col("total"), 4, "s").select("s", "rank", "s_suppkey")


@query("SELECT l_orderkey, l_linenumber, l_linenumber - 3 BETWEEN 0 AND 2 AS ok FROM lineitem")
def latent_index_check(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", validate.in_range(F.col("l_linenumber") - 3, F.lit(3)).alias("ok"))


@query("SELECT vec_id, CASE label WHEN 3 THEN 'nan' WHEN 4 THEN 'infinite' ELSE '' END AS fault FROM embeddings")
def pixel_faults(t):
    bad = F.when(F.col("label") == 3, F.array(F.lit(float("nan")), F.lit(1.0))).when(F.col("label") == 4, F.array(F.lit(float("-inf")))).otherwise(F.col("embedding").cast("array<double>"))
    return t.embeddings.select("vec_id", validate.pixel_faults(bad).alias("fault"))


@query("SELECT doc_id FROM documents WHERE doc_id % 3 <> 1")
def eval_filter(t):
    is_eval = F.col("doc_id") % 3 == 1
    return t.documents.where(~is_eval).select("doc_id")


@query("SELECT event_id FROM events WHERE event_id % 5 <> 1")
def skip_flagged(t):
    flag = F.when(F.col("event_id") % 5 == 1, "1").when(F.col("event_id") % 5 == 2, "no number").when(F.col("event_id") % 5 == 3, "0")
    return chain.skip_flagged(t.events.withColumn("flag", flag), "flag").select("event_id")


@query("SELECT event_id FROM events WHERE event_id % 4 <> 0")
def drop_none(t):
    rows = t.events.withColumn("kept", F.when(F.col("event_id") % 4 != 0, F.col("event_type")))
    return chain.drop_null(rows, "kept").select("event_id")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'train' ELSE 'val' END AS split FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 2 = 0")
def split_by_path(t):
    path = F.when(F.col("o_orderkey") % 2 == 0, "data/train/train_a.hdf5").when(F.col("o_orderkey") % 3 == 0, "data/trainer/a.hdf5").otherwise("data/val/train.hdf5")
    parts = F.split(path, "/")
    split = F.when(F.array_contains(parts, "train"), "train").when(F.array_contains(parts, "val"), "val")
    return t.orders.select("o_orderkey", split.alias("split")).where("split is not null")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey % 6 <> 0")
def struct_flatten(t):
    s = F.when(F.col("c_custkey") % 6 != 0, F.struct("c_name", "c_acctbal", "c_mktsegment"))
    return chain.flatten(t.customer.select("c_custkey", s.alias("s")), "s", ["c_name", "c_acctbal"])


@query("SELECT vec_id, i AS pos, round(embedding[i + 1]::DOUBLE * 2, 6) AS value FROM embeddings CROSS JOIN (SELECT unnest(range(0, 7)) AS i)")
def clip_scale_dims(t):
    v = F.transform(vectors.take(F.col("embedding").cast("array<double>"), 0, 7), lambda x: x * 2)
    return t.embeddings.select("vec_id", F.posexplode(v).alias("pos", "value")).withColumn("value", r(F.col("value")))


@query(f"WITH {DIMS_SQL}, {STATS_SQL} SELECT dim - 10 AS pos, round(mn, 9) AS min, round(mx, 9) AS max FROM s WHERE dim >= 10 AND dim < 20")
def stats_slice(t):
    s = stats.vector_stats(_vectors(t), "v").where(F.col("dim").between(10, 19))
    return _round(s.select((F.col("dim") - 10).alias("pos"), "min", "max"), "min", "max", digits=9)


@query("SELECT event_type AS section, round(avg(value), 9) AS mean FROM events GROUP BY event_type")
def timer_averages(t):
    return t.events.groupBy(F.col("event_type").alias("section")).agg(r(F.avg("value"), 9).alias("mean"))


@query(_nearest_sql({"view": "view"}) + " SELECT g.event_id, round(n_view.value, 6) AS nearest FROM g LEFT JOIN n_view USING (event_id)")
def nearest_by_scan(t):
    e = _events(t)
    return timeseries.asof_nearest(e.where("event_type = 'click'").select("event_id", "user_id", "t"), e.where("event_type = 'view'"), "user_id", "t", "value", "nearest").select("event_id", r(F.col("nearest")).alias("nearest"))


@query("SELECT conv_id, list_sort(list(DISTINCT role)) = ['assistant', 'user'] AS same, NOT list_contains(list(role), 'system') AS subset FROM conversations GROUP BY conv_id")
def key_sets(t):
    have = t.conversations.groupBy("conv_id").agg(F.collect_set("role").alias("have"))
    want = F.array(F.lit("assistant"), F.lit("user"))
    missing, more = F.size(F.array_except(want, "have")) == 0, F.size(F.array_except("have", F.array(F.lit("assistant"), F.lit("user"), F.lit("tool")))) == 0
    return have.select("conv_id", (missing & (F.size("have") == 2)).alias("same"), more.alias("subset"))


@query("""WITH {STEPS} SELECT episode_id, step_idx, op, round(CASE op WHEN 'add' THEN a0 + a1 WHEN 'sub' THEN a0 - a1 WHEN 'mul' THEN a0 * a1 ELSE a0 / a1 END, 6) AS value FROM steps CROSS JOIN (SELECT unnest(['add', 'sub', 'mul', 'div']) AS op)""")
def broadcast_ops(t):
    a, b = F.array("a0"), F.array("a1")
    each = F.array(*[F.struct(F.lit(op).alias("op"), F.get(vectors.combine(a, b, op), F.lit(0)).alias("value")) for op in ("add", "sub", "mul", "div")])
    return t.steps.select("episode_id", "step_idx", F.inline(each)).withColumn("value", r(F.col("value")))


@query(f"WITH {DIMS_SQL}, {STATS_SQL} SELECT vec_id, dim, round(x, 9) AS x, round(2 * (2 * (x - mn) / (mx - mn) - 1) + 1, 9) AS applied FROM d JOIN s USING (dim)")
def transform_chain(t):
    s = stats.vector_stats(_vectors(t), "v")
    rows = stats.by_dimension(_vectors(t), "v", "vec_id").join(F.broadcast(s.select("dim", "min", "max")), "dim")
    unit = lambda df, f: df.withColumn("x", f(F.col("x")))
    scaled = chain.Invertible(lambda df: unit(df, lambda x: vectors.rescale(x, F.col("min"), F.col("max"))), lambda df: unit(df, lambda x: vectors.unscale(x, F.col("min"), F.col("max"))))
    affine = chain.Invertible(lambda df: unit(df, lambda x: 2 * x + 1), lambda df: unit(df, lambda x: (x - 1) / 2))
    both = chain.Chain([scaled, affine])
    out = both.unapply(both.apply(rows).withColumn("applied", F.col("x")))
    return out.select("vec_id", "dim", r(F.col("x"), 9).alias("x"), r(F.col("applied"), 9).alias("applied"))


@query("SELECT event_id, event_id // 10 AS iteration FROM events WHERE (event_id // 10 // 2) % 5 = 0 OR event_id // 10 = 1")
def every_n_callback(t):
    rows = t.events.select("event_id", F.floor(F.col("event_id") / 10).alias("iteration"))
    return streaming.every_n(rows, "iteration", 2, 5, at_start=True)


@query("SELECT event_id, CASE WHEN value > 90 THEN 'value' WHEN event_type = 'click' THEN 'kind' WHEN user_id % 7 = 0 THEN 'user' END AS unsafe FROM events")
def guardrail_chain(t):
    checks = {"value": F.col("value") > 90, "kind": F.col("event_type") == "click", "user": F.col("user_id") % 7 == 0}
    return t.events.select("event_id", chain.first_unsafe(checks).alias("unsafe"))


@query("SELECT p_partkey, i AS copy FROM part, unnest(range(0, p_size % 4)) AS u(i)")
def replicate_rows(t):
    rows = t.part.select("p_partkey", (F.col("p_size") % 4).alias("times"))
    return chain.expand(rows, "times").select("p_partkey", "copy")


@query("SELECT p_partkey, p_size * 10 AS size10 FROM part WHERE p_size % 2 = 0")
def iterable_augmentor(t):
    def even(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b = b[b["p_size"] % 2 == 0]
            yield pd.DataFrame({"p_partkey": b["p_partkey"], "size10": b["p_size"] * 10})

    kind = t.part.schema["p_partkey"].dataType.simpleString()
    return chain.iterable_step(t.part.select("p_partkey", "p_size"), even, f"p_partkey {kind}, size10 long")


def _angles():
    y, p, x = (F.col("p_size") - 25) / 10.0, (F.col("p_size") - 25) / 40.0, (F.col("p_size") - 25) / 30.0
    return [x, p, y]


@query("""SELECT p_partkey, o AS "order", round((p_size - 25) / 30.0, 6) AS a, round((p_size - 25) / 40.0, 6) AS b, round(2 * atan2(sin((p_size - 25) / 20.0), cos((p_size - 25) / 20.0)), 6) + 0.0 AS c FROM part CROSS JOIN (SELECT unnest(['XYZ', 'XZY', 'YXZ', 'YZX', 'ZXY', 'ZYX']) AS o)""")
def euler_orders(t):
    """Matrices first, as columns of one projection, in which Spark computes each sine and product once; then the angles of each order."""
    orders = ("XYZ", "XZY", "YXZ", "YZX", "ZXY", "ZYX")
    matrices = [x.alias(f"{order}{i}") for order in orders for i, x in enumerate(geometry.angles_to_matrix(_angles(), order))]
    each = []
    for order in orders:
        back = geometry.matrix_to_angles([F.col(f"{order}{i}") for i in range(9)], order)
        each.append(F.struct(F.lit(order).alias("order"), *[x.alias(n) for x, n in zip(back, "abc", strict=True)]))
    rows = t.part.select("p_partkey", *matrices).select("p_partkey", F.inline(F.array(*each)))
    return rows.withColumns({n: r(F.col(n)) for n in "abc"})


@query("""WITH a AS (SELECT p_partkey, (p_size - 25) / 30.0 AS x, (p_size - 25) / 40.0 AS p, (p_size - 25) / 10.0 AS y FROM part)
  SELECT p_partkey, round(cos(y) * cos(p), 6) + 0.0 AS m0, round(sin(y) * cos(p), 6) + 0.0 AS m3, round(-sin(p), 6) + 0.0 AS m6, round(abs(cos(x / 2) * cos(p / 2) * cos(y / 2) + sin(x / 2) * sin(p / 2) * sin(y / 2)), 6) AS qw FROM a""")
def rotation_forms(t):
    m = geometry.euler_to_matrix(*_angles())
    rows = t.part.select("p_partkey", *[x.alias(f"m{i}") for i, x in enumerate(m)])
    m = [F.col(f"m{i}") for i in range(9)]
    rows = rows.select("p_partkey", *[x.alias(f"s{i}") for i, x in enumerate(geometry.matrix_from_6d(geometry.rotation_6d(m)))])
    q = geometry.matrix_to_quaternion([F.col(f"s{i}") for i in range(9)])
    rows = rows.select("p_partkey", *[x.alias(f"q{i}") for i, x in enumerate(q)])
    v = geometry.quaternion_to_axis_angle([F.col(f"q{i}") for i in range(4)])
    rows = rows.select("p_partkey", *[x.alias(f"v{i}") for i, x in enumerate(v)])
    q = geometry.axis_angle_to_quaternion([F.col(f"v{i}") for i in range(3)])
    rows = rows.select("p_partkey", *[x.alias(f"q{i}") for i, x in enumerate(q)])
    q = [F.col(f"q{i}") for i in range(4)]
    out = geometry.quaternion_to_matrix(q)
    return rows.select("p_partkey", r(out[0]).alias("m0"), r(out[3]).alias("m3"), r(out[6]).alias("m6"), r(q[3]).alias("qw"))


@query("""WITH c AS (SELECT p_partkey, p_size / 10.0 AS y, p_size * 1.0 AS tx, 2.0 AS ty, 3.0 AS tz, (p_size - 320.0) / 500 AS u, (p_size * 2 - 240.0) / 500 AS v FROM part),
  w AS (SELECT *, -(cos(y) * tx + sin(y) * ty) AS cx, -(-sin(y) * tx + cos(y) * ty) AS cy, -tz AS cz, cos(y) * u + sin(y) * v AS dx, -sin(y) * u + cos(y) * v AS dy, 1.0 AS dz, sqrt(u * u + v * v + 1) AS n FROM c)
  SELECT p_partkey, round(cx, 5) + 0.0 AS cx, round(cy, 5) + 0.0 AS cy, round(dx / n, 6) + 0.0 AS dx, round(dy / n, 6) + 0.0 AS dy, round((cy * dz - cz * dy) / n, 5) + 0.0 AS mx, round((cz * dx - cx * dz) / n, 5) + 0.0 AS my FROM w""")
def camera_rays(t):
    m = geometry.euler_to_matrix(F.lit(0.0), F.lit(0.0), F.col("p_size") / 10.0)
    shift = [F.col("p_size").cast("double"), F.lit(2.0), F.lit(3.0)]
    centre, direction = geometry.ray(m, shift, F.col("p_size"), F.col("p_size") * 2, *[F.lit(float(k)) for k in (500, 500, 320, 240)])
    line = geometry.pluecker(centre, direction)
    return t.part.select("p_partkey", r(centre[0], 5).alias("cx"), r(centre[1], 5).alias("cy"), r(line[0]).alias("dx"), r(line[1]).alias("dy"), r(line[3], 5).alias("mx"), r(line[4], 5).alias("my"))


@query("""WITH {STEPS}, f AS (SELECT *, first_value(a3) OVER w AS y0, first_value(a0) OVER w AS x0, first_value(a2) OVER w AS z0 FROM steps WINDOW w AS (PARTITION BY episode_id ORDER BY step_idx))
  SELECT episode_id, step_idx, round(cos(a3 - y0), 7) AS m0, round(a0 - (cos(a3 - y0) * x0), 6) + 0.0 AS tx, round(a2 - z0, 6) + 0.0 AS tz FROM f""")
def first_frame_pose(t):
    zero = F.lit(0.0)
    s = t.steps.withColumns({f"{c}_0": F.first(c).over(episodic.episode()) for c in ("a0", "a2", "a3")})
    m, m0 = (geometry.euler_to_matrix(zero, zero, F.col(c)) for c in ("a3", "a3_0"))
    turn, shift = geometry.pose_compose(m, [F.col("a0"), zero, F.col("a2")], *geometry.pose_invert(m0, [F.col("a0_0"), zero, F.col("a2_0")]))
    return s.select("episode_id", "step_idx", r(turn[0], 7).alias("m0"), r(shift[0]).alias("tx"), r(shift[2]).alias("tz"))


@query(r"""SELECT doc_id, CASE WHEN lang = 'en' THEN lang ELSE source END AS caption FROM documents""")
def repaired_caption(t):
    pairs = F.concat(F.lit('"model": {"first": "'), F.when(F.col("lang") == "en", F.col("lang")).otherwise(F.col("source")), F.lit('", "other": "x"}'))
    doc = F.when(F.col("doc_id") % 2 == 0, pairs).otherwise(F.concat(F.lit(" {"), pairs, F.lit("}")))
    m = F.from_json(text.repaired_json(doc), "map<string,map<string,string>>")
    first = lambda x: F.get(F.map_values(x), F.lit(0))
    return t.documents.select("doc_id", first(first(m)).alias("caption"))


@query(f"WITH {EVENTS_SQL} SELECT event_id, i AS item FROM ev JOIN (SELECT unnest(range(3, 9)) AS i) ON event_id = i")
def item_range(t):
    return t.events.where(F.col("event_id").between(3, 8)).select("event_id", F.col("event_id").alias("item"))


SESSIONS_SQL = """WITH e AS (SELECT user_id, epoch_us(ts) // 1000000 AS t FROM events), g AS (SELECT *, CASE WHEN t - lag(t) OVER w > 21600 THEN 1 ELSE 0 END AS fresh FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t)),
  s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS session FROM g)
  SELECT user_id, CAST(session AS INTEGER) AS session, min(t) AS first, max(t) AS last, count(*) AS n FROM s GROUP BY user_id, session"""


def _seconds(t):
    micros = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast(ts AS timestamp_ntz))")
    return t.events.select("user_id", F.floor(micros / 1_000_000).cast("long").alias("t"))


@query(SESSIONS_SQL)
def session_table(t):
    """A table function over a partitioned table, in SQL."""
    table_functions.register(t.spark)
    name = f"seconds_{uuid.uuid4().hex}"
    _seconds(t).createOrReplaceTempView(name)
    out = t.spark.sql(f"SELECT * FROM sessions(TABLE({name}) PARTITION BY user_id ORDER BY t, gap => 21600D)")
    t.spark.catalog.dropTempView(name)
    return out


@query(SESSIONS_SQL)
def session_frames(t):
    """The same in DataFrames."""
    return table_functions.session_rows(_seconds(t), "user_id", "t", 21_600)


@query(r"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS a FROM documents),
  p AS (SELECT doc_id, a, unnest(range(0, len(a), 40)) AS place FROM w)
  SELECT doc_id, CAST(place AS INTEGER) AS place, CAST(len(a[place + 1:place + 60]) AS INTEGER) AS n, md5(array_to_string(a[place + 1:place + 60], ' ')) AS digest FROM p WHERE place = 0 OR place + 20 < len(a)""")
def window_table(t):
    """Windows of 60 words, 20 of which overlap, by a table function joined with each row."""
    table_functions.register(t.spark)
    name = f"texts_{uuid.uuid4().hex}"
    t.documents.createOrReplaceTempView(name)
    out = t.spark.sql(f"SELECT doc_id, w.place, w.n, md5(w.words) AS digest FROM {name}, LATERAL word_windows(text, 60, 40) AS w")
    t.spark.catalog.dropTempView(name)
    return out
