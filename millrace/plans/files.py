"""Queries that write given tables in a file format, and read them back by its source."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.times import utc_micros
from millrace.model import STEP_ORDER
from millrace.plans.registry import query, r
from millrace.sources import hdf5, mcap, readers, tar_source, workspace, writers
from millrace.streaming import state


@query("""SELECT event_id, user_id, round(value, 6) AS value, event_type AS topic, epoch_us(ts) * 1000 AS log_time FROM events
  WHERE event_type IN ('error', 'purchase') AND epoch_us(ts) BETWEEN 1704412800000000 AND 1705276800000000""")
def mcap_topics(t):
    """Events as recordings of a day and a quarter of its events each, of which two topics and ten days are read."""
    micros, path = utc_micros(t.events, "ts"), workspace.new_folder(t.spark, "mcap")
    name = F.concat_ws("-", F.floor(micros / 86_400_000_000), F.pmod(F.xxhash64("event_id"), F.lit(4)))
    data = F.to_json(F.struct("event_id", "user_id", "value")).cast("binary")
    mcap.write_recordings(t.events.where("ts is not null and event_type is not null").select(name.alias("file"), F.col("event_type").alias("topic"), (micros * 1000).alias("log_time"), data.alias("data")), path)
    rows = t.spark.read.format("mcap").load(path).where("topic in ('error', 'purchase') and log_time between 1704412800000000000 and 1705276800000000000")
    body = F.from_json(F.col("data").cast("string"), "event_id long, user_id long, value double")
    return rows.select(body.alias("b"), "topic", "log_time").select("b.event_id", "b.user_id", F.round("b.value", 6).alias("value"), "topic", "log_time")


def _shards(t) -> str:
    """Documents as shards of 500 numbers, each a text and a JSON member."""
    path = workspace.new_folder(t.spark, "shards")
    meta = F.to_json(F.struct("lang", "source", "n_chars")).cast("binary")
    each = F.array(F.struct(F.lit("txt").alias("suffix"), F.encode("text", "UTF-8").alias("payload")), F.struct(F.lit("meta.json").alias("suffix"), meta.alias("payload")))
    rows = t.documents.where("doc_id is not null").select(F.format_string("part/documents-%08d", F.floor(F.col("doc_id") / 500)).alias("shard"), F.format_string("%012d", "doc_id").alias("key"), F.inline(each))
    tar_source.write_shards(rows, path)
    return path


@query("SELECT doc_id, lang, source, n_chars FROM documents WHERE doc_id IS NOT NULL")
def tar_metadata(t):
    """The JSON members of all shards; the texts are passed over."""
    rows = t.spark.read.format("tar_shards").load(_shards(t)).where("suffix = 'meta.json'")
    body = F.from_json(F.col("payload").cast("string"), "lang string, source string, n_chars long")
    return rows.select(F.col("key").cast("long").alias("doc_id"), body.alias("b")).select("doc_id", "b.*")


@query("""SELECT doc_id, 'documents-' || lpad(CAST(doc_id // 500 AS VARCHAR), 8, '0') || '.tar' AS shard, CAST(coalesce(octet_length(encode(text)), 0) AS BIGINT) AS size, row_number() OVER (PARTITION BY doc_id // 500 ORDER BY doc_id) * 2 - 1 AS pos
  FROM documents WHERE doc_id IS NOT NULL""")
def tar_sizes(t):
    """Places and sizes of the text members, by the shards' headers alone."""
    rows = t.spark.read.format("tar_shards").option("payload", "false").load(_shards(t)).where("suffix = 'txt'")
    return rows.select(F.col("key").cast("long").alias("doc_id"), "shard", "size", "pos")


def _episode_files(t) -> str:
    """Lines as HDF5: a group per supplier, whose lines are the steps, and 20 numbers of suppliers a file."""
    path = workspace.new_folder(t.spark, "hdf5")
    name = lambda head, x: F.concat(F.lit(head), F.coalesce(x.cast("string"), F.lit("null")))
    file, group = name("part/episodes-", F.floor(F.col("l_suppkey") / 20)), name("data/demo_", F.col("l_suppkey"))
    actions = F.array("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    order = ["l_orderkey", *STEP_ORDER]
    rows = t.lineitem.select(file.alias("file"), group.alias("group"), *order, actions.alias("actions"), F.array("l_quantity").alias("obs/qpos"), F.create_map(F.lit("task"), F.concat(F.lit("task "), F.col("l_suppkey") % 7)).alias("attributes"))
    hdf5.write_episodes(rows, path, chunk_rows=16, order=order)
    return path


LINES_SQL = f"s AS (SELECT l_suppkey AS episode_id, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, {', '.join(STEP_ORDER)}) - 1 AS step, l_quantity AS a0, l_extendedprice AS a1, l_discount AS a2, l_tax AS a3 FROM lineitem)"


@query(f"WITH {LINES_SQL} SELECT episode_id, step, a0, a1, a2, a3, a0 AS qpos FROM s WHERE step BETWEEN 20 AND 40")
def hdf5_steps(t):
    """A part of every episode's arrays: the chunks with steps 20 to 40."""
    rows = t.spark.read.format("hdf5").option("datasets", "actions, qpos=obs/qpos").load(_episode_files(t)).where("step between 20 and 40")
    return rows.select(F.regexp_extract("group", "([0-9]+)$", 1).cast("long").alias("episode_id"), "step", *[F.get("actions", F.lit(i)).alias(f"a{i}") for i in range(4)], F.get("qpos", F.lit(0)).alias("qpos"))


@query("SELECT l_suppkey AS episode_id, count(*) AS num_steps, count(*) AS num_samples, 'task ' || CAST(l_suppkey % 7 AS VARCHAR) AS task FROM lineitem GROUP BY l_suppkey")
def hdf5_metadata(t):
    """Lengths and attributes of all episodes, without their arrays."""
    rows = t.spark.read.format("hdf5").load(_episode_files(t)).where("dataset = 'actions'")
    a = F.from_json("group_attributes", "task string, num_samples long")
    return rows.select(F.regexp_extract("group", "([0-9]+)$", 1).cast("long").alias("episode_id"), F.get("shape", F.lit(0)).alias("num_steps"), a["num_samples"].alias("num_samples"), a["task"].alias("task"))


@query("""WITH e AS (SELECT event_type AS kind, epoch_us(ts) // 86400000000 * 86400 AS start, value FROM events), m AS (SELECT max(epoch_us(ts)) AS last FROM events)
  SELECT kind, start, count(*) AS n, round(avg(value), 6) AS mean FROM e, m WHERE (start + 86400) * 1000000 <= last - 3600000000 GROUP BY kind, start""")
def window_means_stream(t):
    """Means of each day as a stream that is stopped and started again on its checkpoint, once for each third of the events' time."""
    path = workspace.new_folder(t.spark, "stream")
    ends = t.events.agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    low, high = ends.select(utc_micros(ends, "a"), utc_micros(ends, "b")).first()
    at = utc_micros(t.events, "ts")
    for i in range(3 if high is not None else 0):
        lo, hi = (low + (high + 1 - low) * k // 3 for k in (i, i + 1))
        t.events.where((at >= lo) & (at < hi)).select(F.timestamp_micros(at).alias("ts"), "event_type", "value").write.mode("append").parquet(f"{path}/in")
        rows = t.spark.readStream.schema("ts timestamp, event_type string, value double").parquet(f"{path}/in")
        means = state.window_means(rows, "ts", "event_type", "value", 86_400_000, "1 hour")
        means.writeStream.outputMode("append").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start(f"{path}/out").awaitTermination()
    out = t.spark.read.schema("kind string, start long, n long, mean double").parquet(f"{path}/out") if high is not None else t.spark.createDataFrame([], "kind string, start long, n long, mean double")
    return out.select("kind", "start", "n", r(F.col("mean")).alias("mean"))


# ---- the readers and writers of folders


@query("""WITH {STEPS} SELECT episode_id, CAST(step_idx AS INTEGER) AS step, CAST(CAST(a0 AS FLOAT) AS DOUBLE) AS state, CAST(CAST(a1 AS FLOAT) AS DOUBLE) AS action FROM steps""")
def trajectory_scan(t):
    path = workspace.new_folder(t.spark, "trajectories")
    state, action = F.array(F.col("a0").cast("float")), F.array(F.col("a1").cast("float"))
    t.steps.select(state.alias("observation.state"), action.alias("action"), (F.col("step_idx") / 25.0).alias("timestamp"), F.col("episode_id").cast("int").alias("episode_index")).write.parquet(path)
    rows = readers.trajectories(t.spark, path)
    return rows.select(F.col("episode_index").cast("long").alias("episode_id"), F.round(F.col("timestamp") * 25).cast("int").alias("step"), F.get("`observation.state`", F.lit(0)).cast("double").alias("state"), F.get("action", F.lit(0)).cast("double").alias("action"))


@query("WITH {EPISODES} SELECT episode_id, num_steps, command AS task FROM episodes")
def jsonl_scan(t):
    """Episodes with the numbers of their tasks, and the tasks, as lines of JSON."""
    path = workspace.new_folder(t.spark, "jsonl")
    tasks = t.orders.groupBy(F.col("o_orderpriority").alias("task")).agg(F.min("o_orderkey").alias("k"))  # a row per task
    tasks = tasks.select("task", F.row_number().over(Window.orderBy("task")).alias("task_index"))
    writers.dump(tasks, f"{path}/tasks.jsonl")
    numbered = t.episodes.join(tasks, F.col("command") == F.col("task"))
    writers.dump(numbered.select(F.col("episode_id").alias("episode_index"), F.col("num_steps").alias("length"), F.array(F.col("task_index").cast("string")).alias("tasks")), f"{path}/episodes.jsonl")
    rows = readers.episode_lengths(t.spark, f"{path}/episodes.jsonl").select("episode_index", "length", F.explode(F.transform("tasks", lambda x: x.cast("int"))).alias("task_index"))
    return rows.join(readers.task_names(t.spark, f"{path}/tasks.jsonl"), "task_index").select(F.col("episode_index").cast("long").alias("episode_id"), F.col("length").alias("num_steps"), "task")


def _one_file_each(rows, by: str, path: str) -> None:
    """Texts as a file each, in folders by a column."""
    rows.repartition(by).write.partitionBy(by).text(path)


@query("SELECT c_custkey, c_mktsegment AS segment FROM customer WHERE c_acctbal > 0")
def annotation_scan(t):
    """Annotations of a hundred customers a file, of which those are read that are for evaluation."""
    path = workspace.new_folder(t.spark, "annotations")
    meta = F.struct((F.col("c_acctbal") > 0).alias("is_eval"), F.col("c_custkey").cast("string").alias("episode_id"), F.col("c_mktsegment").alias("segment_id"))
    one = F.struct(F.col("c_custkey").alias("label"), meta.alias("episode_metadata"))
    texts = t.customer.groupBy(F.floor(F.col("c_custkey") / 100).alias("part")).agg(F.to_json(F.collect_list(one)).alias("value"))
    _one_file_each(texts, "part", path)
    rows = readers.annotations(t.spark, path, T.StructType().add("label", "long"), is_eval=True)
    return rows.select(F.col("label").alias("c_custkey"), F.col("episode_metadata.segment_id").alias("segment"))


@query("SELECT 'parts/' || p_brand AS root, CAST(p_partkey AS VARCHAR) || '.tar' AS shard, count(*) OVER (PARTITION BY p_brand) AS total_key_count FROM part")
def manifest_scan(t):
    path = workspace.new_folder(t.spark, "manifests")
    shard = F.concat(F.col("p_partkey").cast("string"), F.lit(".tar"))
    lists = t.part.groupBy(F.col("p_brand").alias("brand")).agg(F.collect_list(shard).alias("data_list"), F.count("*").alias("total_key_count"))
    value = F.to_json(F.struct(F.concat(F.lit("s3://bucket/parts/"), "brand").alias("root"), "data_list", "total_key_count", F.lit(1).alias("chunk_size")))
    _one_file_each(lists.select("brand", value.alias("value")), "brand", path)
    return readers.shard_list(t.spark, path).select("root", "shard", "total_key_count")


@query("SELECT page_id, string_split(url, '.')[1] AS key FROM pages")
def key_scan(t):
    path = workspace.new_folder(t.spark, "keys")
    t.pages.select("url", "page_id").write.parquet(path)
    keys = readers.key_index(t.spark, path, "url").distinct()
    return t.spark.read.parquet(path).withColumn("key", F.split("url", r"\.")[0]).join(keys, "key").select("page_id", "key")


@query("""WITH {STEPS}, d AS (SELECT *, lead(a0) OVER w - a0 AS ahead, a0 - lag(a0) OVER w AS back FROM steps WINDOW w AS (PARTITION BY episode_id ORDER BY step_idx))
  SELECT episode_id, step_idx, o_orderstatus = 'F' AS success, round(coalesce(ahead, back, 0), 4) + 0.0 AS relative FROM d JOIN orders ON o_orderkey = episode_id""")
def rollout_files(t):
    """Steps in folders by success, with each action's difference to the next."""
    path = workspace.new_folder(t.spark, "rollouts")
    writers.write_rollouts(t.steps.select("episode_id", "step_idx", "action"), t.episodes.select("episode_id", "success", "command"), path)
    rows = t.spark.read.parquet(f"{path}/steps")
    return rows.select("episode_id", "step_idx", F.col("success").cast("boolean").alias("success"), r(F.get("relative_action", F.lit(0)), 4).alias("relative"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'new' END AS new, 'old' AS old FROM orders")
def replaced_table(t):
    """A table that is replaced, and the one before."""
    path = workspace.new_folder(t.spark, "replaced")
    writers.save_with_backup(t.orders.select("o_orderkey", F.lit("old").alias("old")), path)
    writers.save_with_backup(t.orders.where("o_orderstatus = 'F'").select("o_orderkey", F.lit("new").alias("new")), path)
    return t.spark.read.parquet(f"{path}.bak").join(t.spark.read.parquet(path), "o_orderkey", "left").select("o_orderkey", "new", "old")


@query("SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def computed_once(t):
    """Statistics that are there are not computed again."""
    path = f"{workspace.new_folder(t.spark, 'once')}/stats.parquet"
    writers.load_or_compute(t.spark, path, lambda: t.orders.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n")))
    return writers.load_or_compute(t.spark, path, lambda: t.orders.select(F.lit("again").alias("status"), F.lit(0).cast("long").alias("n")))


@query("SELECT l_orderkey, l_linenumber, l_quantity AS quantity, round(l_extendedprice, 2) AS price FROM lineitem")
def decoded_numbers(t):
    """Binary JSON lists as arrays of numbers, by the decoder's name."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.to_json(F.array("l_quantity", "l_extendedprice")).cast("binary").alias("data")).withColumn("x", readers.numbers(F.col("data"), "json"))
    return rows.select("l_orderkey", "l_linenumber", F.get("x", F.lit(0)).alias("quantity"), F.round(F.get("x", F.lit(1)), 2).alias("price"))


@query("SELECT l_returnflag AS flag, l_linestatus AS status, count(*) AS n, round(avg(l_discount), 6) AS mean FROM lineitem GROUP BY 1, 2")
def csv_metrics(t):
    """Metrics written and read by the extension of their path."""
    path = f"{workspace.new_folder(t.spark, 'metrics')}/metrics.csv"
    writers.dump(t.lineitem.groupBy(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status")).agg(F.count("*").alias("n"), F.round(F.avg("l_discount"), 6).alias("mean")), path)
    return readers.load(t.spark, path, T.StructType().add("flag", "string").add("status", "string").add("n", "long").add("mean", "double"))
