"""The registered queries and the pipeline over the driver's smallest tables."""

from __future__ import annotations

import collections

import duckdb
import pytest

import corpus_pipeline
from millrace.llm import queries
from tests.llm import brute

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_rows_as_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "benchmark", "sales", "sale_lines", "clients"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = db.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, SF).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.fetchall()))


def test_pipeline(spark, tmp_path):
    """Every stage keeps what it should of its own input."""
    docs, kept = spark.read.parquet(f"{SF}/documents.parquet"), []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        assert i == 4 or tuple(out.columns) == corpus_pipeline.COLUMNS
        out.write.parquet(f"{tmp_path}/{name}")
        kept.append([tuple(r) for r in docs.collect()])
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    raw, calm, single, cut, clean = ({r[0]: r[1] for r in rows} for rows in kept)
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 0").collect()}
    assert len(toxic & raw.keys() - calm.keys()) <= 2 and all(raw[i] == calm[i] for i in calm)
    assert len(set(single.values())) == len(single) and set(calm.values()) >= set(single.values())
    words = brute.repeated_words(list(single.items()))
    for i, text in single.items():
        n, removed, digest = words[i, text]
        assert (i in cut) == (removed < n or not n)
        if i in cut:
            assert cut[i] == text if not removed else brute.sha(cut[i].encode()) == digest
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hits = brute.contamination(list(cut.items()), items)
    assert clean == {i: t for i, t in cut.items() if not hits[i, t][4]}
    size = collections.Counter()
    for r in docs.collect():
        size[r.doc_id] += r.n_tokens
    assert size == {i: len(t.encode().split()) + 1 for i, t in clean.items()}
    assert corpus_pipeline.run(spark, SF).count() == docs.count()


@pytest.mark.parametrize("rows", ["odd", "none"])
def test_pipeline_of_odd_rows(spark, tmp_path, rows):
    """Nulls in any column, empty texts, ties, repeated rows and no rows at all."""
    some = rows == "odd"
    prose = " ".join(f"word{i * i % 97} is {i}" for i in range(60))
    docs = [(1, prose, "en", "s", 5), (1, prose, "en", "s", 5), (2, None, None, None, None), (3, "", "en", None, 0), (None, "of no number " + prose[:200], "en", "s", 1), (4, prose + " more", "en", "s", 6), (5, " \n", None, "s", 2)]
    tables = {
        "documents": (docs, "doc_id long, text string, lang string, source string, n_chars long"),
        "labels": ([(1, 1, 0), (2, None, None), (None, 0, 1)], "doc_id long, quality int, toxic int"),
        "benchmark": ([(1, "some words that nobody has"), (None, None)], "item_id long, text string"),
    }
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data if some else [], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = {r.doc_id for r in out}
    assert ids <= {1, 2, 3, 4, 5, None} and (1 in ids and None in ids if some else not ids)
