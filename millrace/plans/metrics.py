"""Queries for statistics, normalization, metrics and selection."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions import vectors
from millrace.operators import ordering, stats
from millrace.plans.registry import query, r

DIMS_SQL = "d AS (SELECT vec_id, label, i - 1 AS dim, embedding[i]::DOUBLE AS x FROM embeddings CROSS JOIN (SELECT unnest(range(1, 65)) AS i))"
STATS_SQL = "s AS (SELECT dim, min(x) AS mn, max(x) AS mx, avg(x) AS mean, stddev_pop(x) AS std, median(x) AS med, quantile_cont(x, 0.01) AS q01, quantile_cont(x, 0.99) AS q99 FROM d GROUP BY dim)"


def _vectors(t):
    return t.embeddings.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))


def _round(df, *names, digits=6):
    return df.withColumns({c: r(F.col(c), digits) for c in names})


@query("""WITH {STEPS}, d AS (SELECT 0 AS dim, a0 AS x FROM steps UNION ALL SELECT 1, a1 FROM steps UNION ALL SELECT 2, a2 FROM steps UNION ALL SELECT 3, a3 FROM steps)
  SELECT dim, round(min(x), 4) AS min, round(max(x), 4) AS max, round(avg(x), 4) AS mean, round(stddev_pop(x), 4) AS std, round(median(x), 4) AS median FROM d GROUP BY dim""")
def vector_stats(t):
    return _round(stats.vector_stats(t.steps, "action"), "min", "max", "mean", "std", "median", digits=4)


@query(f"WITH {DIMS_SQL}, {STATS_SQL} SELECT dim, round(mn, 9) AS min, round(mx, 9) AS max, round(mean, 9) AS mean, round(std, 9) AS std, round(med, 9) AS median, round(q01, 9) AS q01, round(q99, 9) AS q99 FROM s")
def column_quantiles(t):
    return _round(stats.vector_stats(_vectors(t), "v", quantiles=True), "min", "max", "mean", "std", "median", "q01", "q99", digits=9)


@query(f"""WITH {DIMS_SQL}, {STATS_SQL} SELECT dim, CASE WHEN dim < 17 THEN -1.0 ELSE round(mn, 9) END AS min, CASE WHEN dim < 17 THEN 1.0 ELSE round(mx, 9) END AS max,
  CASE WHEN dim < 17 THEN 0.0 ELSE round(mean, 9) END AS mean, CASE WHEN dim < 17 THEN 1.0 ELSE round(std, 9) END AS std, CASE WHEN dim < 17 THEN 0.0 ELSE round(med, 9) END AS median FROM s""")
def masked_stats(t):
    return _round(stats.masked_defaults(stats.vector_stats(_vectors(t), "v"), 17), "min", "max", "mean", "std", "median", digits=9)


def _with_stats(t):
    rows = stats.by_dimension(_vectors(t), "v", "vec_id")
    s = stats.vector_stats(_vectors(t), "v", quantiles=True)  # a row per dimension
    return rows.join(F.broadcast(s), "dim")


def _cols():
    return {k: F.col(k) for k in ("min", "max", "mean", "std", "q01", "q99")}


@query(f"WITH {DIMS_SQL}, {STATS_SQL} SELECT dim, round(min(y), 9) AS min, round(max(y), 9) AS max, round(avg(y), 9) AS mean FROM (SELECT dim, 2 * (x - mn) / greatest(mx - mn, 1e-8) - 1 AS y FROM d JOIN s USING (dim)) GROUP BY dim")
def post_norm_stats(t):
    y = 2 * (F.col("x") - F.col("min")) / F.greatest(F.col("max") - F.col("min"), F.lit(1e-8)) - 1
    out = _with_stats(t).select("dim", y.alias("y")).groupBy("dim").agg(F.min("y").alias("min"), F.max("y").alias("max"), F.avg("y").alias("mean"))
    return _round(out, "min", "max", "mean", digits=9)


@query(f"WITH {DIMS_SQL}, {STATS_SQL} SELECT vec_id, dim, round(2 * (x - mn) / (CASE WHEN mx - mn < 1e-8 THEN 1 ELSE mx - mn END) - 1, 9) AS y FROM d JOIN s USING (dim)")
def rescale(t):
    c = _cols()
    return _with_stats(t).select("vec_id", "dim", r(vectors.rescale(F.col("x"), c["min"], c["max"]), 9).alias("y"))


MODES_SQL = """round(greatest(-1.0, least(1.0, 2 * (x - q01) / (q99 - q01) - 1)), 9) AS q99, round((x - mean) / std, 9) AS mean_std, round(2 * (x - mn) / (mx - mn) - 1, 9) AS min_max,
  round(x / greatest(abs(mn), abs(mx)), 9) AS scale, CASE WHEN x > 0.5 THEN 1.0 ELSE 0.0 END AS binary"""


@query(f"WITH {DIMS_SQL}, {STATS_SQL} SELECT vec_id, dim, {MODES_SQL} FROM d JOIN s USING (dim)")
def normalize_modes(t):
    modes = ("q99", "mean_std", "min_max", "scale", "binary")
    return _with_stats(t).select("vec_id", "dim", *[r(vectors.normalize(F.col("x"), m, _cols()), 9).alias(m) for m in modes])


@query(f"""WITH {DIMS_SQL}, {STATS_SQL} SELECT vec_id, dim, round(x * std + mean, 9) AS mean_std, round((x + 1) / 2 * (mx - mn) + mn, 9) AS min_max, round((x + 1) / 2 * (q99 - q01) + q01, 9) AS q99,
  CASE WHEN x > 0.5 THEN 1.0 ELSE 0.0 END AS binary, abs(round(x, 6)) AS back FROM d JOIN s USING (dim)""")
def denormalize_modes(t):
    out = {m: r(vectors.denormalize(F.col("x"), m, _cols()), 9) for m in ("mean_std", "min_max", "q99", "binary")}
    back = vectors.denormalize(vectors.normalize(F.col("x"), "mean_std", _cols()), "mean_std", _cols())
    return _with_stats(t).select("vec_id", "dim", *[c.alias(m) for m, c in out.items()], F.abs(r(back)).alias("back"))


@query(f"WITH {DIMS_SQL}, {STATS_SQL} SELECT vec_id, dim, round(0.5 * (x + 1) * (mx - mn) + mn, 9) AS y FROM d JOIN s USING (dim)")
def unnormalize(t):
    return _with_stats(t).select("vec_id", "dim", r(vectors.unscale(F.col("x"), F.col("min"), F.col("max")), 9).alias("y"))


@query(f"WITH {DIMS_SQL} SELECT dim, round(quantile_cont(abs(x), 0.99), 9) AS p99 FROM d GROUP BY dim")
def abs_p99(t):
    rows = stats.by_dimension(_vectors(t), "v").select("dim", F.abs("x").alias("x"))
    return _round(stats.exact_quantiles(rows, ["dim"], "x", {"p99": 0.99}), "p99", digits=9)


@query("SELECT label, round(median(x), 6) AS median, round(quantile_cont(x, 0.95), 6) AS p95, median(x) <= 0.1 AND quantile_cont(x, 0.95) <= 0.2 AS ok FROM (SELECT label, abs(embedding[1]::DOUBLE) AS x FROM embeddings) GROUP BY label")
def residual_gate(t):
    x = F.abs(F.get("embedding", F.lit(0)).cast("double"))
    g = stats.exact_quantiles(t.embeddings.select("label", x.alias("x")), ["label"], "x", {"median": 0.5, "p95": 0.95})
    return g.select("label", r(F.col("median")).alias("median"), r(F.col("p95")).alias("p95"), ((F.col("median") <= 0.1) & (F.col("p95") <= 0.2)).alias("ok"))


@query("WITH {EPISODES} SELECT coalesce(command, 'all') AS task, count(*) AS episodes, round(avg(CASE WHEN success THEN 1.0 ELSE 0.0 END), 6) AS rate FROM episodes GROUP BY GROUPING SETS ((command), ())")
def success_rate(t):
    e = t.episodes
    each = e.groupBy(F.col("command").alias("task")).agg(F.count("*").alias("episodes"), r(stats.rate(F.col("success"))).alias("rate"))
    return each.unionByName(e.agg(F.lit("all").alias("task"), F.count("*").alias("episodes"), r(stats.rate(F.col("success"))).alias("rate")))


@query("WITH {EPISODES} SELECT command, round(avg(num_steps), 6) AS mean_length, round(avg(CASE WHEN success THEN num_steps END), 6) AS mean_success_length FROM episodes GROUP BY command")
def mean_length(t):
    return t.episodes.groupBy("command").agg(r(F.avg("num_steps")).alias("mean_length"), r(F.avg(F.when(F.col("success"), F.col("num_steps")))).alias("mean_success_length"))


@query("""WITH {EPISODES} SELECT count(*) AS total, CAST(sum(CASE WHEN success THEN 1 ELSE 0 END) AS BIGINT) AS kept, round(100.0 * sum(CASE WHEN success THEN 1 ELSE 0 END) / count(*), 6) AS kept_percent,
  CAST(sum(CASE WHEN num_steps < 5 THEN 1 ELSE 0 END) AS BIGINT) AS short, round(coalesce(avg(CASE WHEN success THEN num_steps END), 0), 6) AS mean_kept FROM episodes""")
def regen_summary(t):
    ok = F.col("success").cast("int")
    percent = F.when(F.count("*") > 0, 100.0 * F.sum(ok) / F.count("*")).otherwise(0.0)
    short = F.sum((F.col("num_steps") < 5).cast("int"))
    return t.episodes.agg(F.count("*").alias("total"), F.sum(ok).alias("kept"), r(percent).alias("kept_percent"), short.alias("short"), r(stats.mean_where(F.col("num_steps"), F.col("success"))).alias("mean_kept"))


RANKS_SQL = "m AS (SELECT event_id // 100 AS iteration, user_id % 8 AS rank, event_type AS metric, value AS x FROM events)"


def _ranks(t):
    return t.events.select(F.floor(F.col("event_id") / 100).alias("iteration"), (F.col("user_id") % 8).alias("rank"), F.col("event_type").alias("metric"), F.col("value").alias("x"))


@query(f"WITH {RANKS_SQL} SELECT iteration, metric, round(avg(x), 9) AS avg, max(x) AS max, min(x) AS min FROM m GROUP BY ALL")
def metric_rollup(t):
    return _ranks(t).groupBy("iteration", "metric").agg(r(F.avg("x"), 9).alias("avg"), F.max("x").alias("max"), F.min("x").alias("min"))


@query(f"WITH {RANKS_SQL}, a AS (SELECT iteration, rank, avg(x) AS mean FROM m GROUP BY ALL) SELECT iteration, rank, round(mean, 9) AS mean FROM (SELECT *, row_number() OVER (PARTITION BY iteration ORDER BY mean DESC, rank) AS k FROM a) WHERE k = 1")
def slowest_rank(t):
    a = _ranks(t).groupBy("iteration", "rank").agg(F.avg("x").alias("mean"))
    return stats.first_by(a, ["iteration"], [F.col("mean").desc(), F.col("rank")]).select("iteration", "rank", r(F.col("mean"), 9).alias("mean"))


@query(f"WITH {RANKS_SQL} SELECT metric, rank, round(coalesce(avg(CASE WHEN x >= 20 THEN x END), 0), 9) AS mean FROM m GROUP BY ALL")
def nan_skipping_mean(t):
    x = F.when(F.col("x") < 20, F.lit(float("nan"))).otherwise(F.col("x"))
    rows = _ranks(t).select("metric", "rank", x.alias("x"))
    return rows.groupBy("metric", "rank").agg(r(stats.mean_where(F.col("x"), ~F.isnan("x")), 9).alias("mean"))


@query(f"WITH {RANKS_SQL} SELECT metric, CAST(sum(CASE WHEN x < 5 OR x > 95 THEN 1 ELSE 0 END) AS BIGINT) AS unstable, round(coalesce(avg(CASE WHEN NOT (x < 5 OR x > 95) THEN x END), 0), 9) AS mean FROM m GROUP BY metric")
def unstable_count(t):
    x = F.when(F.col("x") < 5, F.lit(float("nan"))).when(F.col("x") > 95, F.lit(float("inf"))).otherwise(F.col("x"))
    rows = _ranks(t).select("metric", x.alias("x"))
    ok = stats.finite(F.col("x"))
    return rows.groupBy("metric").agg(F.sum((~ok).cast("int")).alias("unstable"), r(stats.mean_where(F.col("x"), ok), 9).alias("mean"))


@query(f"WITH {RANKS_SQL} SELECT metric, round(avg(mean), 9) AS mean FROM (SELECT metric, rank, avg(x) AS mean FROM m GROUP BY ALL) GROUP BY metric")
def mean_of_means(t):
    return _ranks(t).groupBy("metric", "rank").agg(F.avg("x").alias("mean")).groupBy("metric").agg(r(F.avg("mean"), 9).alias("mean"))


@query("SELECT l_returnflag, round(sum(l_extendedprice * l_quantity) / sum(l_quantity), 4) AS loss FROM lineitem GROUP BY l_returnflag")
def weighted_mean(t):
    return t.lineitem.groupBy("l_returnflag").agg(r(F.sum(F.col("l_extendedprice") * F.col("l_quantity")) / F.sum("l_quantity"), 4).alias("loss"))


@query("""WITH x AS (SELECT d.doc_id % 7 AS grp, n_chars / 1000.0 - 1 AS e, toxic, quality FROM documents d JOIN labels l USING (doc_id))
  SELECT grp, round(avg(e * e), 4) AS mse, round(avg(CASE WHEN toxic = 1 THEN abs(e) END), 4) AS l1_toxic, round(avg(CASE WHEN quality = 1 THEN abs(e) END), 4) AS l1_quality FROM x GROUP BY grp""")
def masked_error(t):
    e = F.col("n_chars") / 1000.0 - 1
    rows = t.documents.join(t.labels, "doc_id").select((F.col("doc_id") % 7).alias("grp"), e.alias("e"), "toxic", "quality")
    l1 = lambda c: r(F.avg(F.when(F.col(c) == 1, F.abs("e"))), 4)
    return rows.groupBy("grp").agg(r(F.avg(F.col("e") * F.col("e")), 4).alias("mse"), l1("toxic").alias("l1_toxic"), l1("quality").alias("l1_quality"))


ENSEMBLE_SQL = "m AS (SELECT l_orderkey AS query_id, l_discount AS v FROM lineitem), g AS (SELECT query_id, count(*) AS n, sum(CASE WHEN v > 0.05 THEN 1 ELSE 0 END) AS good, avg(v) AS mean, stddev_samp(v) AS sd, sum(CASE WHEN v > 0.05 THEN v ELSE 0 END) AS total FROM m GROUP BY query_id)"


def _ensemble(t, scheme):
    rows = t.lineitem.select(F.col("l_orderkey").alias("query_id"), F.col("l_discount").alias("v"))
    return rows.groupBy("query_id").agg(r(stats.ensemble(F.col("v"), scheme), 9).alias("value"))


@query(f"WITH {ENSEMBLE_SQL} SELECT query_id, round(least(1, greatest(0, mean)), 9) AS value FROM g")
def ensemble_average(t):
    return _ensemble(t, "average")


@query(f"WITH {ENSEMBLE_SQL} SELECT query_id, round(least(1, greatest(0, mean - sd)), 9) + 0.0 AS value FROM g WHERE n > 1")
def ensemble_lcb(t):
    return _ensemble(t, "lcb").where(~F.isnan("value"))


@query(f"WITH {ENSEMBLE_SQL} SELECT query_id, round(good / n, 9) AS value FROM g")
def ensemble_success_vote(t):
    return _ensemble(t, "success_vote")


@query(f"WITH {ENSEMBLE_SQL} SELECT query_id, round(CASE WHEN 2 * good >= n THEN total / greatest(good, 1) ELSE 0 END, 9) AS value FROM g")
def ensemble_majority_mean(t):
    return _ensemble(t, "majority_mean")


@query("""WITH {STEPS} SELECT episode_id AS query_id, round(avg(a2), 6) AS average, arg_max(a2, step_idx) AS use_last_value FROM steps GROUP BY episode_id""")
def depth_aggregate(t):
    s = t.steps.select(F.col("episode_id").alias("query_id"), F.col("step_idx").alias("depth"), F.col("a2").alias("v"))
    return s.groupBy("query_id").agg(r(F.avg("v")).alias("average"), F.max_by("v", "depth").alias("use_last_value"))


@query(f"WITH {DIMS_SQL} SELECT label, dim, CAST(least(255, greatest(0, round_even(avg(x) * 1000, 0))) AS INTEGER) AS value FROM d GROUP BY label, dim")
def elementwise_mean(t):
    m = stats.by_dimension(_vectors(t), "v", "label").groupBy("label", "dim").agg(F.avg("x").alias("m"))
    return m.select("label", "dim", F.least(F.lit(255), F.greatest(F.lit(0), F.rint(F.col("m") * 1000).cast("int"))).alias("value"))


@query(f"WITH {DIMS_SQL} SELECT vec_id, dim % 20 AS pos, round(avg(x), 9) AS value FROM d WHERE dim < 60 GROUP BY vec_id, dim % 20")
def repeat_chunk_mean(t):
    n = 20
    rows = stats.by_dimension(_vectors(t), "v", "vec_id").where(F.col("dim") < 64 // n * n)
    return rows.groupBy("vec_id", (F.col("dim") % n).alias("pos")).agg(r(F.avg("x"), 9).alias("value"))


@query("SELECT event_type AS op, count(*) AS n, round(sum(value), 4) AS total, max(value) AS max, arg_max(value, event_id) AS last, round(avg(value), 9) AS avg FROM events GROUP BY event_type")
def timing_stats(t):
    return t.events.groupBy(F.col("event_type").alias("op")).agg(F.count("*").alias("n"), r(F.sum("value"), 4).alias("total"), F.max("value").alias("max"), F.max_by("value", "event_id").alias("last"), r(F.avg("value"), 9).alias("avg"))


@query("SELECT user_id, round(100 * avg(CASE WHEN value > 80 THEN 1.0 ELSE 0.0 END), 9) AS percent, avg(CASE WHEN value > 80 THEN 1.0 ELSE 0.0 END) > 0.2 AS unsafe FROM events GROUP BY user_id")
def unsafe_fraction(t):
    p = stats.rate(F.col("value") > 80)
    return t.events.groupBy("user_id").agg(r(100 * p, 9).alias("percent"), (p > 0.2).alias("unsafe"))


@query("""WITH {STEPS} SELECT episode_id AS query_id, step_idx AS seed, a1 AS value FROM (SELECT *, row_number() OVER (PARTITION BY episode_id ORDER BY a1 DESC, step_idx) AS k FROM steps) WHERE k = 1""")
def best_of_n(t):
    s = t.steps.select(F.col("episode_id").alias("query_id"), F.col("step_idx").alias("seed"), F.col("a1").alias("value"))
    return stats.first_by(s, ["query_id"], [F.col("value").desc(), (F.col("seed") != 0).cast("int"), F.col("seed")])


@query("""SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS k FROM events WHERE value > 50) WHERE k <= 5""")
def threshold_topk(t):
    w = Window.partitionBy("user_id").orderBy(F.col("value").desc(), "event_id")
    return t.events.where("value > 50").withColumn("k", F.row_number().over(w)).where("k <= 5").select("user_id", "event_id")


@query("SELECT episode_id, position >= n - CAST(ceil(n / 20.0) AS BIGINT) AS test FROM (SELECT o_orderkey AS episode_id, row_number() OVER (ORDER BY o_orderkey) - 1 AS position, count(*) OVER () AS n FROM orders)")
def tail_holdout(t):
    rows = t.orders.select(F.col("o_orderkey").alias("episode_id"))
    n = rows.agg(F.count("*").alias("n"))  # one row
    numbered = ordering.number_rows(rows, ["episode_id"]).join(F.broadcast(n))
    return numbered.select("episode_id", (F.col("position") >= F.col("n") - F.ceil(F.col("n") / 20)).alias("test"))


@query("SELECT r AS rank, r * (n // 7) + least(r, n % 7) AS first, (r + 1) * (n // 7) + least(r + 1, n % 7) AS last, false AS overflow FROM (SELECT count(*) AS n FROM customer) CROSS JOIN (SELECT unnest(range(0, 7)) AS r)")
def rank_ranges(t):
    parts = ordering.rank_ranges(t.customer.count(), 7)
    return t.spark.createDataFrame([(i, a, b, o) for i, (a, b, o) in enumerate(parts)], "rank long, first long, last long, overflow boolean")
