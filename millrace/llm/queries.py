"""Queries over the driver's tables for the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.bpe import op13
from millrace.llm.concurrency import op11
from millrace.llm.decontamination import op2
from millrace.llm.importance import op12
from millrace.llm.language_id import op3
from millrace.llm.packing import op6
from millrace.llm.pitman_yor import op4
from millrace.llm.quality_rules import op9
from millrace.llm.sharding import op7
from millrace.llm.simhash import op10
from millrace.llm.substring_dedup import op8
from millrace.llm.suffix_array_dedup import op1
from millrace.llm.toxicity import op5


def quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op9 that SQL can say too."""
    return op9(spark, sf_dir).drop("kept", "ratio", "reason")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_suffix_array_dedup": op1,
        "op2_decontamination": op2,
        "op3_language_id": op3,
        "op4_lm_scoring": op4,
        "op5_toxicity": op5,
        "op6_packing": op6,
        "op7_sharding": op7,
        "op8_substring_dedup": op8,
        "op9_quality_rules": op9,
        "op10_simhash": op10,
        "op11_peak_concurrency": op11,
        "op12_importance_resampling": op12,
        "op13_bpe": op13,
        "quality_counts": quality_counts,
    }


LETTERS = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: All windows of the items, joined with all runs of as many words in the documents.
DECONTAMINATION = r"""WITH d AS (SELECT doc_id, regexp_extract_all({LETTERS}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS a FROM documents),
  b AS (SELECT item_id, regexp_extract_all({LETTERS}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS a FROM benchmark),
  bw AS (SELECT DISTINCT item_id, n, unnest(list_transform(range(1, len(a) - n + 2), lambda i: array_to_string(a[i:i + n - 1], ' '))) AS k FROM (SELECT item_id, a, least(13, len(a)) AS n FROM b WHERE len(a) > 0)),
  dw AS (SELECT doc_id, n, unnest(list_transform(range(1, len(a) - n + 2), lambda i: array_to_string(a[i:i + n - 1], ' '))) AS k, unnest(range(1, len(a) - n + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT n FROM bw) WHERE len(a) >= n),
  m AS (SELECT doc_id, n, i, item_id FROM dw JOIN bw USING (n, k)),
  h AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM m) GROUP BY doc_id),
  s AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m WHERE item_id IS NOT NULL) GROUP BY doc_id)
  SELECT d.doc_id, CAST(len(a) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(a) AS contaminated FROM d LEFT JOIN h USING (doc_id) LEFT JOIN s USING (doc_id)""".replace("{LETTERS}", LETTERS)
#: All windows of 50 words by hash, and the first document of each.
SUBSTRING_DEDUP = r"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS a FROM documents),
  k AS (SELECT doc_id, unnest(list_transform(range(1, len(a) - 48), lambda i: md5(array_to_string(a[i:i + 49], ' ')))) AS h, unnest(range(1, len(a) - 48)) AS i FROM w),
  f AS (SELECT h, min(doc_id) AS first FROM k GROUP BY h HAVING count(*) > 1),
  hit AS (SELECT DISTINCT doc_id, i + j AS pos FROM k JOIN f USING (h) CROSS JOIN (SELECT unnest(range(0, 50)) AS j) WHERE first < doc_id),
  t AS (SELECT doc_id, unnest(a) AS word, unnest(range(1, len(a) + 1)) AS pos FROM w),
  kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS x, count(*) AS n FROM t ANTI JOIN hit USING (doc_id, pos) GROUP BY doc_id)
  SELECT w.doc_id, CAST(len(a) AS BIGINT) AS n_words, CAST(len(a) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(x, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)"""


#: All windows of 100 bytes by hash, but the first of each; runs of their bytes, and what is between the runs.
SUFFIX_ARRAY_DEDUP = """WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents), n AS (SELECT *, length(h) // 2 AS n FROM d),
  w AS (SELECT doc_id, unnest(range(0, n - 99)) AS i, unnest(list_transform(range(0, n - 99), lambda i: md5(substr(h, 2 * i + 1, 200)))) AS k FROM n WHERE n >= 100),
  f AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS nth FROM w) WHERE nth > 1),
  g AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS fresh FROM f)),
  r AS (SELECT doc_id, min(i) AS s, max(i) + 100 AS e FROM g GROUP BY doc_id, run),
  l AS (SELECT doc_id, list(s ORDER BY s) AS ss, list(e ORDER BY s) AS es, sum(e - s) AS removed, count(*) AS spans FROM r GROUP BY doc_id)
  SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(CASE WHEN ss IS NULL THEN h
  ELSE array_to_string(list_transform(range(1, len(ss) + 2), lambda j: substr(h, 2 * coalesce(es[j - 1], 0) + 1, 2 * (coalesce(ss[j], n) - coalesce(es[j - 1], 0)))), '') END)) AS kept_sha256 FROM n LEFT JOIN l USING (doc_id)"""
QUALITY_COUNTS = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS x, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS a, list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l FROM documents),
  g AS (SELECT doc_id, unnest(range(1, len(a) - 1)) AS i, unnest(list_transform(range(1, len(a) - 1), lambda i: a[i] || ' ' || a[i + 1] || ' ' || a[i + 2])) AS k FROM d WHERE len(a) > 2),
  t AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS m FROM g) WHERE m > 1), p AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM t CROSS JOIN (SELECT unnest([0, 1, 2]) AS j) GROUP BY doc_id)
  SELECT doc_id, CAST(len(a) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(a, lambda w: length(w))), 0) AS BIGINT) AS word_chars, CAST(length(regexp_replace(x, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, len(a) < 50 OR 100 * coalesce(n, 0) > 50 * len(a) AS base_failed FROM d LEFT JOIN p USING (doc_id)"""

#: Starts and ends as changes, summed up by nation and moment, and running sums of those.
PEAK_CONCURRENCY = """WITH e AS (SELECT sale_id, 60 * CAST(floor(epoch_us(min(shipped_at)) / 60000000) AS BIGINT) + 604800 AS e FROM sale_lines GROUP BY sale_id),
  c AS (SELECT client_id, min(nation_id) AS nation_id FROM clients GROUP BY client_id),
  s AS (SELECT coalesce(nation_id, -1) AS nation_id, 60 * CAST(floor(epoch_us(sold_at) / 60000000) AS BIGINT) AS s, e, CAST(floor(100 * coalesce(total, 0) + 0.5) AS BIGINT) AS cents
    FROM sales LEFT JOIN e USING (sale_id) LEFT JOIN c USING (client_id) WHERE sold_at IS NOT NULL),
  o AS (SELECT * FROM s WHERE e IS NULL OR e > s), b AS (SELECT * FROM o UNION ALL SELECT -2, s, e, cents FROM o),
  d AS (SELECT nation_id, s AS t, 1 AS n, cents AS c FROM b UNION ALL SELECT nation_id, e, -1, -cents FROM b WHERE e IS NOT NULL),
  m AS (SELECT nation_id, t, sum(n) AS n, sum(c) AS c FROM d GROUP BY nation_id, t HAVING sum(n) <> 0 OR sum(c) <> 0),
  r AS (SELECT nation_id, t, sum(n) OVER w AS n, sum(c) OVER w AS c, lead(t) OVER w AS u FROM m WINDOW w AS (PARTITION BY nation_id ORDER BY t))
  SELECT CAST(nation_id AS INTEGER) AS nation_id, t AS from_s, u AS to_s, CAST(n AS BIGINT) AS n_open, CAST(c AS BIGINT) AS open_cents, CAST(max(n) OVER (PARTITION BY nation_id ORDER BY t) AS BIGINT) AS high_open,
  c = max(c) OVER (PARTITION BY nation_id) AS is_peak FROM r"""

#: CRC-32 of every distinct feature byte by byte, with a table by the rule of its polynomial.
IMPORTANCE = r"""WITH RECURSIVE tab AS (SELECT list(c ORDER BY i) AS tab FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM (SELECT unnest(range(256)) AS i))),
  w AS (SELECT 0 AS side, doc_id, regexp_extract_all({LETTERS}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS a FROM documents UNION ALL SELECT 1, NULL, regexp_extract_all({LETTERS}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
  f AS (SELECT side, doc_id, unnest(list_transform(range(1, len(a) - n + 2), lambda i: array_to_string(a[i:i + n - 1], ' '))) AS x FROM w CROSS JOIN (SELECT unnest([1, 2, 3]) AS n) WHERE len(a) >= n),
  g AS (SELECT side, doc_id, x, count(*) AS n FROM f GROUP BY ALL),
  u AS (SELECT DISTINCT x, hex(encode(x)) AS h FROM g),
  k AS (SELECT x, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(h), 2), lambda i: CAST(('0x' || h[i:i + 1]) AS BIGINT))), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS b FROM u, tab),
  c AS (SELECT side, doc_id, b, sum(n) AS n FROM g JOIN k USING (x) GROUP BY ALL),
  t AS (SELECT b, sum(n) FILTER (side = 0) AS s, sum(n) FILTER (side = 1) AS t FROM c GROUP BY b),
  z AS (SELECT coalesce(sum(s), 0) AS s, coalesce(sum(t), 0) AS t FROM t),
  gain AS (SELECT b, CAST(floor(1000 * ln((coalesce(t.t, 0) + 1)::DOUBLE * (z.s + 10000)::DOUBLE / ((coalesce(t.s, 0) + 1)::DOUBLE * (z.t + 10000)::DOUBLE))) AS BIGINT) AS gain FROM t, z),
  v AS (SELECT doc_id, sum(n * gain) AS weight, sum(n) AS n_features FROM c JOIN gain USING (b) WHERE side = 0 GROUP BY doc_id),
  r AS (SELECT doc_id, len(a) AS n, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || sha256('42:' || doc_id)[1:8] AS BIGINT) + 0.5) / 4294967296))) AS BIGINT) AS score FROM w LEFT JOIN v USING (doc_id) WHERE side = 0),
  o AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM r WHERE n >= 20)
  SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 5 * (SELECT count(*) FROM o) // 100 THEN rank END AS rank FROM r LEFT JOIN o USING (doc_id)""".replace("{LETTERS}", LETTERS)


def oracle_sql() -> dict[str, str]:
    """SQL has no XXH64, zstandard, BPE or training: those operators are tested against plain versions."""
    return {"op1_suffix_array_dedup": SUFFIX_ARRAY_DEDUP, "op2_decontamination": DECONTAMINATION, "op8_substring_dedup": SUBSTRING_DEDUP, "op11_peak_concurrency": PEAK_CONCURRENCY, "op12_importance_resampling": IMPORTANCE, "quality_counts": QUALITY_COUNTS}
