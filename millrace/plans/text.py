"""Queries over captions, labels and JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import text
from millrace.operators import blocklist, stats
from millrace.plans.registry import query, r

KEYWORDS = ["pathetic", "keit"]


def _captions(t):
    """Documents as captions, some blank or missing."""
    c = F.when(F.col("doc_id") % 17 == 0, F.lit("  ")).when(F.col("doc_id") % 19 == 0, F.lit(None)).otherwise(F.col("text"))
    return t.documents.select("doc_id", c.alias("caption"), "source", "lang")


CAPTIONS_SQL = "c AS (SELECT doc_id, CASE WHEN doc_id % 17 = 0 THEN '  ' WHEN doc_id % 19 = 0 THEN NULL ELSE text END AS caption, source, lang FROM documents)"
HIT_SQL = "(contains(lower(caption), 'pathetic') OR contains(lower(caption), 'keit'))"
PASS_SQL = f"(caption IS NULL OR trim(caption) = '' OR NOT {HIT_SQL})"


@query(f"WITH {CAPTIONS_SQL} SELECT doc_id FROM c WHERE source = 'src1' OR {PASS_SQL}")
def caption_filter(t):
    return _captions(t).where((F.col("source") == "src1") | text.caption_passes(F.col("caption"), KEYWORDS, include=False)).select("doc_id")


@query(f"""WITH {CAPTIONS_SQL} SELECT count(*) AS total, CAST(sum(CASE WHEN {PASS_SQL} THEN 0 ELSE 1 END) AS BIGINT) AS filtered, CAST(sum(CASE WHEN {PASS_SQL} THEN 1 ELSE 0 END) AS BIGINT) AS passed,
  round(100.0 * sum(CASE WHEN {PASS_SQL} THEN 0 ELSE 1 END) / count(*), 9) AS rate FROM c WHERE source <> 'src1'""")
def caption_filter_stats(t):
    rows = _captions(t).where("source <> 'src1'").select(text.caption_passes(F.col("caption"), KEYWORDS, include=False).alias("ok"))
    n = F.coalesce(F.sum((~F.col("ok")).cast("int")), F.lit(0))
    return rows.agg(F.count("*").alias("total"), n.alias("filtered"), (F.count("*") - n).alias("passed"), r(100 * stats.rate(~F.col("ok")), 9).alias("rate"))


CLEAN_SQL = r"trim(regexp_replace(regexp_replace(lower(text), '[^\x00-\x7F]+', ' ', 'g'), '\s+', ' ', 'g'))"


@query(f"SELECT doc_id, {CLEAN_SQL} AS clean FROM documents")
def normalize_text(t):
    return t.documents.select("doc_id", text.normalize(F.col("text")).alias("clean"))


@query(f"SELECT DISTINCT word FROM (SELECT unnest(string_split({CLEAN_SQL}, ' ')) AS word FROM documents)")
def dedupe_normalized(t):
    return t.documents.select(F.explode(F.split(text.normalize(F.col("text")), " ")).alias("word")).distinct()


BLOCKED = ["idiot", "clown", "moron"]


@query("SELECT doc_id FROM documents WHERE regexp_matches(lower(text), '\\b(idiot|clown|moron)\\b')")
def blocklist_exact(t):
    return t.documents.where(text.has_word(F.lower("text"), BLOCKED)).select("doc_id")


FUZZY = ["pathetic", "worthless", "disgusting", "you are a clown"]


@query(f"""WITH w AS (SELECT doc_id, string_split({CLEAN_SQL}, ' ') AS a FROM documents) SELECT doc_id FROM w WHERE list_has_any(a, ['pathetic', 'worthless', 'disgusting'])
  OR list_contains(list_transform(range(1, greatest(len(a) - 2, 1)), lambda i: array_to_string(a[i:i + 3], ' ')), 'you are a clown')""")
def blocklist_fuzzy(t):
    rows = t.documents.select("doc_id", text.normalize(F.col("text")).alias("clean"))
    return blocklist.near_hits(rows, "doc_id", "clean", FUZZY)


def _phrases(t) -> list[str]:
    """1,000 runs of one to three words of the benchmark, in the order of their MD5: a blocklist."""
    words = F.filter(F.split(text.normalize(F.col("text")), " "), lambda w: w != "")
    runs = t.benchmark.select(F.explode(F.concat(*[blocklist.runs_of(words, n) for n in (1, 2, 3)])).alias("x")).where("length(x) >= 6").distinct()
    return [r.x for r in runs.orderBy(F.md5("x"), "x").limit(1000).collect()]  # the blocklist's size


@query()
def blocklist_fuzzy_loose(t):
    rows = t.documents.select("doc_id", text.normalize(F.col("text")).alias("clean"))
    return blocklist.near_hits(rows, "doc_id", "clean", [*FUZZY, *_phrases(t)], slack=1.0)


def _keywords(t, most: int, least: int = 1) -> list[str]:
    """Words of the conversations, in the order of their MD5: a blocklist of `most` words."""
    words = F.explode(F.regexp_extract_all(F.lower("text"), F.lit("([a-z0-9_]+)"), 1)).alias("k")
    return [r.k for r in t.conversations.select(words).where(F.length("k") >= least).distinct().orderBy(F.md5("k"), "k").limit(most).collect()]


KEYWORDS_SQL = "k AS (SELECT k FROM (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z0-9_]+')) AS k FROM conversations) WHERE length(k) >= {least} ORDER BY md5(k), k LIMIT {most})"


@query(f"""WITH {KEYWORDS_SQL.format(least=1, most=10_000)}, w AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9_]+')) AS k FROM documents),
  h AS (SELECT doc_id, count(*) AS n, md5(string_agg(k, ',' ORDER BY k)) AS digest FROM w JOIN k USING (k) GROUP BY doc_id)
  SELECT doc_id, CAST(coalesce(n, 0) AS INTEGER) AS n, coalesce(digest, md5('')) AS digest FROM documents LEFT JOIN h USING (doc_id)""")
def blocklist_words(t):
    find = blocklist.keyword_finder(t.spark, _keywords(t, 10_000), whole_words=True)
    rows = t.documents.select("doc_id", find(F.lower("text")).alias("found"))
    return rows.select("doc_id", F.size("found").alias("n"), F.md5(F.concat_ws(",", "found")).alias("digest"))


@query(f"""WITH {KEYWORDS_SQL.format(least=5, most=500)}, h AS (SELECT doc_id, count(*) AS n, md5(string_agg(k, ',' ORDER BY k)) AS digest FROM documents JOIN k ON contains(lower(text), k) GROUP BY doc_id)
  SELECT doc_id, CAST(coalesce(n, 0) AS INTEGER) AS n, coalesce(digest, md5('')) AS digest FROM documents LEFT JOIN h USING (doc_id)""")
def blocklist_substrings(t):
    find = blocklist.keyword_finder(t.spark, _keywords(t, 500, 5), whole_words=False)
    rows = t.documents.select("doc_id", find(F.lower("text")).alias("found"))
    return rows.select("doc_id", F.size("found").alias("n"), F.md5(F.concat_ws(",", "found")).alias("digest"))


@query(r"""SELECT doc_id, array_to_string(list_transform(string_split(regexp_replace(text, '\s+', ' ', 'g'), ' '),
  lambda w: CASE WHEN lower(regexp_replace(w, '[^A-Za-z0-9 ]', '', 'g')) IN ('the', 'of') THEN w ELSE '***' END), ' ') AS restored FROM documents""")
def whitelist_restore(t):
    rows = t.documents.select("doc_id", F.regexp_replace("text", r"\s+", " ").alias("x"))
    censored = F.array_join(F.transform(F.split("x", " "), lambda _: F.lit("***")), " ")
    return rows.select("doc_id", text.restore_allowed(censored, F.col("x"), ["the", "of"]).alias("restored"))


@query("SELECT doc_id, CASE WHEN toxic = 1 THEN 'Unsafe' ELSE 'Safe' END AS label, CASE WHEN toxic = 1 THEN 'Insult' ELSE 'None' END AS category FROM labels")
def label_extract(t):
    answer = F.concat(F.lit("Safety: "), F.when(F.col("toxic") == 1, "Unsafe").otherwise("Safe"), F.lit("\nCategories: "), F.when(F.col("toxic") == 1, "Insult").otherwise("None"))
    rows = t.labels.select("doc_id", answer.alias("a"))
    return rows.select("doc_id", F.regexp_extract("a", r"Safety: (Safe|Unsafe|Controversial)", 1).alias("label"), F.regexp_extract("a", r"Categories: (\w+)", 1).alias("category"))


@query("SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'long' WHEN 1 THEN 'short' ELSE 'medium' END AS style FROM orders")
def caption_style(t):
    key = F.element_at(F.array(F.lit("model_caption"), F.lit("model_caption_short"), F.lit("model_caption_medium")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    return t.orders.select("o_orderkey", text.caption_style(key, "model_caption").alias("style"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false ELSE NULL END AS flag FROM orders")
def parse_bool(t):
    word = F.when(F.col("o_orderstatus") == "F", "Yes").when(F.col("o_orderstatus") == "O", "n").otherwise("maybe")
    return t.orders.select("o_orderkey", text.parse_bool(word).alias("flag"))


@query("SELECT event_id, CAST(props ->> '$.k' AS BIGINT) AS k FROM events")
def json_alternates(t):
    return t.events.select("event_id", text.json_first(F.col("props"), ["$.position", "$.xyz", "$.k"]).cast("long").alias("k"))


@query("SELECT event_id, props ->> '$.k' AS first FROM events")
def json_first_value(t):
    m = F.from_json("props", "map<string,string>")
    return t.events.select("event_id", F.get(F.map_values(m), F.lit(0)).alias("first"))


@query("SELECT doc_id, CASE WHEN lang = 'en' THEN 'en' WHEN source = 'src1' THEN 'src1' ELSE 'none' END AS caption FROM documents")
def caption_fallback(t):
    m = F.create_map(F.lit("en"), F.when(F.col("lang") == "en", F.col("lang")), F.lit("alt"), F.when(F.col("source") == "src1", F.col("source")))
    return t.documents.select("doc_id", F.coalesce(F.element_at(m, F.lit("en")), F.element_at(m, F.lit("alt")), F.lit("none")).alias("caption"))


@query("SELECT p_partkey, replace(lower(p_type), '_', ' ') AS command FROM part")
def command_from_name(t):
    name = F.concat(F.lit("a/b/ROOM_SCENE"), F.col("p_size"), F.lit("_"), F.replace(F.lower("p_type"), F.lit(" "), F.lit("_")), F.lit(".hdf5"))
    return t.part.select("p_partkey", text.command_from_name(name).alias("command"))


@query("SELECT doc_id FROM labels WHERE quality = 1")
def verdict_filter(t):
    verdict = F.when(F.col("quality") == 1, "keep").otherwise("drop")
    return t.labels.withColumn("verdict", verdict).where("verdict = 'keep'").select("doc_id")
