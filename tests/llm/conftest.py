from __future__ import annotations

import pytest

from tallyproof.llm.stored import long_texts

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """Builds a documents table from (doc_id, text) or (doc_id, text, source)."""
    long_texts(spark)

    def build(rows):
        filled = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(filled, COLUMNS)

    return build


@pytest.fixture(scope="session")
def odd(documents):
    """Nulls in any column, empty and very long texts, ties and repeated rows."""
    long = "lorem ipsum dolor sit amet " * 20_000
    rows = [
        (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, long), (6, long), (7, "a" * 200_000),
        (8, "same text here for you and me " * 4), (8, "same text here for you and me " * 4),
        (8, "another text of the same id, it is no copy of the first"), (None, "no id but a text of some words"),
        (None, None), (9, "Größe £5 — 日本語 😀 \u0000 end"), (10, "same text here for you and me " * 4),
    ]
    return documents(rows)


@pytest.fixture(scope="session")
def extra(odd):
    """The same rows with columns whose names operators use themselves."""
    from pyspark.sql import functions as F

    names = ["id", "row", "key", "n", "ids", "found", "label", "score", "fold", "size", "text_a", "k", "part", "a.b"]
    return odd.select("*", *[F.lit(f"own {name}").alias(name) for name in names])


@pytest.fixture
def shuffled(spark):
    """Joins with both sides shuffled, however short they are."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)
