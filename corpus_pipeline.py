"""From raw documents to packed training sequences: toxicity, near duplicates, repeated passages, benchmark passages, packing.

Every stage takes documents (doc_id, text, lang, source, n_chars; more columns are left behind) and works on all of them. Nulls may be
in any column: a null doc_id is a document like any other that counts as the last, a null text has no words, a null source is a
source of its own. Stages but the last return whole rows with the columns of documents. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.decontamination import decontaminate
from millrace.llm.near_duplicates import dedup_near
from millrace.llm.packing import best_fit_packing
from millrace.llm.scratch import Scratch
from millrace.llm.substring_dedup import substring_dedup
from millrace.llm.toxicity import score_toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go (score of 0.7 or more).

    Null and empty texts have no sentence and stay; repeated rows get equal scores; labels without a document, or null, are
    not learned from; without labels of both kinds no document with a word is told from another, and with none all stay.
    """
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    scored = score_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), held, carry=COLUMNS)
    return scored.where("predicted = 0").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five-word shingles, similarity of 0.8 or more.

    It is the one of the smallest doc_id; of rows that repeat doc_id and text one stays, of those that repeat only the doc_id the one
    of the smallest text hash. Texts without a word, null ones among them, are one group.
    """
    return dedup_near(docs.select(*COLUMNS), size=5, similarity=0.8)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that a document of a smaller doc_id has are cut out; documents of nothing else go.

    Cut texts have their words joined by one blank, and n_chars of what is left; others stay as they are, so do null and empty
    ones. Rows of one doc_id cut nothing out of each other.
    """
    cut = substring_dedup(docs, carry=COLUMNS)
    hit = F.size("spans") > 0
    text = F.when(hit, F.col("kept")).otherwise(F.col("row.text"))
    out = cut.where(~hit | (F.col("kept") != "")).select("row.doc_id", text.alias("text"), "row.lang", "row.source", F.when(hit, F.length("kept")).otherwise(F.col("row.n_chars")).alias("n_chars"))
    return out


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more are benchmark passages (13 words, or a shorter item) go.

    Texts and items without a word, null ones among them, match nothing; an empty benchmark lets all documents stay.
    """
    found = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), carry=COLUMNS)
    return found.where("not contaminated").select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in bins of 2048 tokens: doc_id, piece, n_tokens, bin_id, bin_offset, bin_tokens.

    Every row is packed, repeated ones each for itself; a text without a word is one token, its end. Ties go by doc_id, null last.
    """
    return best_fit_packing(docs, capacity=2048)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_passages", benchmark_passages),
    ("packing", packing),
]

#: Training cannot be said in SQL; tests/llm holds each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each one's rows are written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = scratch.save(docs)
    return docs
