"""Queries that list violations."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import vectors
from millrace.operators import stats, validate
from millrace.plans.registry import query


@query("""WITH {EPISODES} SELECT episode_id, 'length' AS "check" FROM episodes WHERE NOT num_steps >= 2 UNION ALL SELECT episode_id, 'price' FROM episodes WHERE NOT o_totalprice > 2000
  UNION ALL SELECT episode_id, 'command' FROM episodes WHERE NOT length(command) < 15""")
def dataset_violations(t):
    return validate.violations(t.episodes, "episode_id", {"length": F.col("num_steps") >= 2, "price": F.col("o_totalprice") > 2000, "command": F.length("command") < 15})


@query("""WITH {STEPS}, d AS (SELECT 0 AS dim, a0 AS x FROM steps UNION ALL SELECT 1, a1 FROM steps UNION ALL SELECT 2, a2 FROM steps UNION ALL SELECT 3, a3 FROM steps)
  SELECT dim, max(x) > min(x) AS spans, max(x) - min(x) < 1000 AS narrow FROM d GROUP BY dim""")
def range_check(t):
    s = stats.vector_stats(t.steps.where(vectors.all_finite(F.col("action"))), "action")
    return s.select("dim", (F.col("max") > F.col("min")).alias("spans"), (F.col("max") - F.col("min") < 1000).alias("narrow"))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def key_integrity(t):
    return validate.missing_keys(t.documents, t.labels, "doc_id")


@query("SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 'no frames asked for' WHEN p_size < p_size % 5 * 6 THEN 'too few frames' ELSE '' END AS problem FROM part")
def input_check(t):
    why = validate.frame_request(F.col("p_size"), F.lit(30.0), F.lit(4.0), F.lit(12.0), F.col("p_size") % 5 * 6)
    return t.part.select("p_partkey", why.alias("problem"))
