from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus() -> list[tuple]:
    """Prose, copies, near copies, shared passages, junk, and every odd row."""
    rng = random.Random(5)
    syllables = ["ta", "ri", "mo", "né", "ß", "ko", "lu", "Xa", "en", "or"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    prose = lambda n: " ".join(word() + ("." if rng.random() < 0.1 else "") for _ in range(n))
    passage, line = prose(70), prose(12)
    texts = [prose(rng.randint(5, 160)) for _ in range(24)]
    texts += [prose(30) + "\n" + passage + " \t" + prose(20) for _ in range(5)]
    texts += [f"{prose(9)}\n{line}\n{prose(9)}\n{line}" for _ in range(8)]
    texts += [texts[0], texts[0], texts[3].replace(" ", "  ", 1), texts[1] + " extra", "x " + texts[2]]
    texts += ["na " * 400, "ab" * 600, line + "\n" + line + "\n\n" + line, "", "   \n", None, None, "é", "#|$ % <b>", prose(6000), "\0zero\0" * 30]
    rows = [(3 * i + 1, t, ["en", "fr", None][i % 3], f"s{i % 4}" if i % 5 else None, 7) for i, t in enumerate(texts)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The corpus, one row of it twice, one without doc_id, and columns whose names the operators use themselves."""
    extra = [rows[4], (None, rows[0][1], "en", None, None)]
    df = spark.createDataFrame(rows + extra, SCHEMA).repartition(3)
    for name in ("row", "tag", "doc", "key", "spans", "part", "kind", "data", "score", "n", "shard", "cluster"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def pairs(rows):
    return [(r[0], r[1]) for r in rows] + [(rows[4][0], rows[4][1]), (None, rows[0][1])]


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
