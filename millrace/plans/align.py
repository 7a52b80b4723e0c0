"""Queries over streams in time, and over parallel streams of keyed rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import frames
from millrace.operators import ordering, shards, timeseries
from millrace.plans.registry import query, r

EVENTS_SQL = "ev AS (SELECT event_id, user_id, event_type, epoch_us(ts) / 1000000.0 AS t, value FROM events)"


def _events(t):
    return t.events.select("event_id", "user_id", "event_type", (F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast(ts AS timestamp_ntz))") / 1000000.0).alias("t"), "value")


def _nearest_sql(kinds: dict[str, str]) -> str:
    """Nearest source by comparing each target with each source of its user."""
    return f"WITH {EVENTS_SQL}, g AS (SELECT event_id, user_id, t FROM ev WHERE event_type = 'click')" + "".join(
        f", n_{k} AS (SELECT event_id, value FROM (SELECT g.event_id, s.value, row_number() OVER (PARTITION BY g.event_id ORDER BY abs(s.t - g.t), s.t) AS k FROM g JOIN ev s ON s.user_id = g.user_id AND s.event_type = '{v}') WHERE k = 1)"
        for k, v in kinds.items()
    )


@query(_nearest_sql({"view": "view"}) + " SELECT g.event_id, round(value, 6) AS nearest FROM g LEFT JOIN n_view USING (event_id)")
def asof_nearest(t):
    e = _events(t)
    targets = e.where("event_type = 'click'").select("event_id", "user_id", "t")
    out = timeseries.asof_nearest(targets, e.where("event_type = 'view'"), "user_id", "t", "value", "nearest", span=7 * 86400.0)
    return out.select("event_id", r(F.col("nearest")).alias("nearest"))


@query(_nearest_sql({"view": "view", "purchase": "purchase"}) + " SELECT g.event_id, round(a.value, 6) AS view, round(b.value, 6) AS purchase FROM g LEFT JOIN n_view a USING (event_id) LEFT JOIN n_purchase b USING (event_id)")
def multistream_sync(t):
    e = _events(t)
    grid = e.where("event_type = 'click'").select("event_id", "user_id", "t")
    streams = {k: [e.where(F.col("event_type") == k)] for k in ("view", "purchase")}
    out = timeseries.sync_streams(grid, streams, "user_id", "t", "value", span=7 * 86400.0)
    return out.select("event_id", r(F.col("view")).alias("view"), r(F.col("purchase")).alias("purchase"))


@query(f"""WITH {EVENTS_SQL}, g AS (SELECT *, t - lag(t) OVER (PARTITION BY user_id, event_type ORDER BY t) AS gap, min(t) OVER (PARTITION BY user_id) AS a, max(t) OVER (PARTITION BY user_id) AS b FROM ev)
  SELECT user_id, event_type, count(*) AS messages, CAST(sum(CASE WHEN value > 10 THEN 1 ELSE 0 END) AS BIGINT) AS valid, CAST(count(*) - sum(CASE WHEN value > 10 THEN 1 ELSE 0 END) AS BIGINT) AS corrupt,
  round(max(gap), 3) AS max_gap, round(min(t) - min(a), 3) AS leading, round(max(b) - max(t), 3) AS trailing FROM g GROUP BY user_id, event_type""")
def stream_quality(t):
    e = _events(t)
    whole = e.groupBy("user_id").agg(F.min("t").alias("a"), F.max("t").alias("b"))
    out = timeseries.stream_quality(e.join(whole, "user_id"), ["user_id", "event_type"], "t", F.col("value") > 10, F.col("a"), F.col("b"))
    return out.withColumns({c: r(F.col(c), 3) for c in ("max_gap", "leading", "trailing")})


@query("SELECT event_id, user_id FROM events WHERE event_type IN ('view', 'purchase')")
def topic_filter(t):
    return t.events.where(F.col("event_type").isin("view", "purchase")).select("event_id", "user_id")


@query(f"WITH {EVENTS_SQL} SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) - 1 AS position FROM ev")
def time_sort(t):
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("t", "event_id")
    return _events(t).select("user_id", "event_id", (F.row_number().over(w) - 1).alias("position"))


def _grid_sql(count: str) -> str:
    return f"""WITH s AS (SELECT user_id, (min(epoch_us(ts)) // 1000000) AS a, (max(epoch_us(ts)) // 1000000) / 100 AS b0, count(*) AS n FROM events GROUP BY user_id)
  SELECT user_id, i AS pos, round(user_id + i / 8.0, 6) AS t FROM (SELECT user_id, CAST({count}((n % 7 + 0.3) * 8) AS INTEGER) AS k FROM s) CROSS JOIN (SELECT unnest(range(0, 100)) AS i) WHERE i < k"""


def _grid(t, f):
    n = t.events.groupBy("user_id").agg(F.count("*").alias("n"))
    start = F.col("user_id").cast("double")
    grid = f(start, start + F.col("n") % 7 + 0.3, 8.0)
    return n.select("user_id", F.posexplode(grid).alias("pos", "t")).withColumn("t", r(F.col("t")))


@query(_grid_sql("floor"))
def time_grid(t):
    return _grid(t, frames.time_grid)


@query(_grid_sql("ceil"))
def time_grid_arange(t):
    return _grid(t, frames.time_range)


@query("""WITH u AS (SELECT * FROM conversations WHERE length(text) % 3 <> 0), f AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn, text) AS k FROM u)
  SELECT a.conv_id, a.turn AS user_turn, a.text AS user, b.turn AS assistant_turn, b.text AS assistant FROM f a JOIN f b USING (conv_id) WHERE a.role = 'user' AND b.role = 'assistant' AND a.k = 1 AND b.k = 1 AND a.conv_id % 5 <> 0""")
def shard_align_join(t):
    """Streams of turns by conversation: the index lacks some keys, a stream repeats keys, and its first row may be unusable."""
    c = t.conversations.select("conv_id", "role", F.struct("turn", "text").alias("place"), F.struct("turn", "text").alias("payload"))
    index = c.where("conv_id % 5 <> 0")
    out = shards.align(index, {r: c.where(F.col("role") == r) for r in ("user", "assistant")}, ["conv_id"], "place", usable="length(payload.text) % 3 <> 0")
    return out.select("conv_id", F.col("user.turn").alias("user_turn"), F.col("user.text").alias("user"), F.col("assistant.turn").alias("assistant_turn"), F.col("assistant.text").alias("assistant"))


@query("""WITH a AS (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS position FROM conversations WHERE role = 'user'),
  b AS (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS position FROM conversations WHERE role = 'assistant')
  SELECT conv_id, position, length(a.text) AS n_user, length(b.text) AS n_assistant FROM a JOIN b USING (conv_id, position)""")
def zip_join(t):
    c = t.conversations.withColumn("payload", F.col("text"))
    out = shards.zip_streams({"user": c.where("role = 'user'"), "assistant": c.where("role = 'assistant'")}, "conv_id", ["turn"])
    return out.select("conv_id", "position", F.length("user").alias("n_user"), F.length("assistant").alias("n_assistant"))


@query("""SELECT e.event_id, round(s.m, 5) AS m FROM events e JOIN (SELECT CAST(label AS VARCHAR) AS k, avg(embedding[1]::DOUBLE) AS m FROM embeddings GROUP BY label) s ON s.k = CAST(e.user_id % 10 AS VARCHAR)""")
def embedding_lookup(t):
    words = t.embeddings.groupBy(F.col("label").cast("string").alias("command")).agg(F.avg(F.get("embedding", F.lit(0)).cast("double")).alias("m"))  # a row per command
    return t.events.withColumn("command", (F.col("user_id") % 10).cast("string")).join(words, "command").select("event_id", r(F.col("m"), 5).alias("m"))


@query("SELECT c_custkey, n_name FROM customer JOIN nation ON n_nationkey = c_nationkey")
def dimension_lookup(t):
    names = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return t.customer.join(names, "c_nationkey").select("c_custkey", "n_name")


@query("SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def success_semijoin(t):
    good = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return t.orders.join(good, "o_custkey", "left_semi").select("o_orderkey")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_antijoin(t):
    return t.documents.select("doc_id").join(t.labels.select("doc_id"), "doc_id", "left_anti")


@query("""SELECT conv_id, max(CASE WHEN role = 'user' THEN n END) AS user, max(CASE WHEN role = 'assistant' THEN n END) AS assistant FROM (SELECT conv_id, role, CAST(sum(length(text)) AS BIGINT) AS n FROM conversations GROUP BY ALL) GROUP BY conv_id""")
def camera_pivot(t):
    n = t.conversations.groupBy("conv_id").pivot("role", ["user", "assistant"]).agg(F.sum(F.length("text")))
    return n.select("conv_id", "user", "assistant")


@query("""SELECT o_orderkey, list_extract([10, 20, 30], least(o_orderkey % 4, 2) + 1) AS window_start FROM orders""")
def window_lookup(t):
    w = F.array(*[F.struct(F.lit(k).alias("start")) for k in (10, 20, 30)])
    at = F.least(F.col("o_orderkey") % 4, F.size(w) - 1)
    return t.orders.select("o_orderkey", F.element_at(w, (at + 1).cast("int"))["start"].alias("window_start"))


@query("SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1 AS position FROM orders")
def multi_key_sort(t):
    return ordering.number_rows(t.orders, ["o_custkey", "o_orderkey"]).select("o_orderkey", "o_custkey", "position")


@query("SELECT p_partkey, row_number() OVER (ORDER BY CAST(regexp_extract(p_brand, '[0-9]+') AS INTEGER), p_partkey) - 1 AS position FROM part")
def numeric_key_sort(t):
    rows = t.part.withColumn("number", F.regexp_extract("p_brand", "[0-9]+", 0).cast("int"))
    return ordering.number_rows(rows, ["number", "p_partkey"]).select("p_partkey", "position")


@query("SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 10")
def ordered_limit(t):
    return t.orders.select("o_orderkey").orderBy("o_orderkey").limit(10)


@query("SELECT o_orderkey AS id, o_orderkey * o_orderkey % 97 AS value FROM orders")
def generated_source(t):
    return t.orders.select(F.col("o_orderkey").alias("id"), (F.col("o_orderkey") * F.col("o_orderkey") % 97).alias("value"))


@query("SELECT DISTINCT regexp_replace(regexp_replace(url, '\\.[^.]*$', ''), '\\.', '-', 'g') AS key FROM pages")
def key_rename(t):
    return t.pages.select(shards.data_key("url").alias("key")).distinct()
