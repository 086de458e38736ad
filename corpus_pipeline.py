"""The training-data pipeline: documents through filters and edits, stage by stage.

1. quality: documents the classifier rejects go. It learns from the labels of documents
   that are not held out and judges all it is given.
2. near_duplicates: of each component of similar documents (80 percent or more of their
   shingles of five words in common) the one with the lowest id stays. Rows are linked each
   by its own text, whatever rows share an id; of a component's rows with equal ids the one
   whose text hashes lowest stays, a row without an id only if no other has one, and of rows
   equal in id and text the least. Documents without words are similar to nothing and stay.
3. decontamination: documents with an occurrence of a benchmark window go, by each row's own
   text, with or without an id.
4. secrets: live secrets are masked; strings that many owners have stay. No row goes.
5. sentencepiece: the documents' ids, with begin and end, and the text decoded from them.

All but the last return the columns of `documents`; n_chars follows an edited text. In
quality and secrets repeated rows are judged alike, each for itself. `run` removes what its
stages store on the way, and all of its folders but that of the rows it returns; within a
block of `intermediates` that goes with the block.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyproof.llm import decontaminate, ngram_join, quality, secrets, sentence_pieces
from tallyproof.llm.bits import without
from tallyproof.llm.queries import PIECES
from tallyproof.llm.stored import long_texts, release, settled

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# What near_duplicates takes for similar; op5's query has a likeness of its own.
LIKE = ngram_join.Likeness(size=5, percent=80)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = long_texts(spark).read.parquet(f"{sf_dir}/labels.parquet")
    # Columns the classifier would replace step aside.
    aside = {name: f"_own_{name}" for name in ("held_out", "score", "predicted") if name in docs.columns}
    judged = quality.classify(docs.withColumnsRenamed(aside), labels)
    kept = judged.filter("predicted = 1").drop("held_out", "score", "predicted")
    return kept.withColumnsRenamed({new: old for old, new in aside.items()}).select(*map(_named, docs.columns))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    long_texts(spark)
    row = "_row"
    while row in docs.columns:
        row += "_"
    names = [_named(name) for name in docs.columns]
    shared = docs.groupBy("doc_id").count().filter("doc_id IS NULL OR count > 1")
    unique = shared.isEmpty()
    # Where ids do not tell rows apart, their texts do as well.
    text = F.sha2(F.coalesce("text", F.lit("")), 256)
    own = F.col("doc_id") if unique else F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), text.alias("text"))
    rows = docs.withColumn(row, own)
    found = settled(spark, lambda: ngram_join.jaccard_components(rows.select(row, "text"), key=row, like=LIKE))
    gone = found.filter(F.col("component_id") != F.col(row)).select(row).distinct()
    kept = without(rows, gone, row)
    if unique:
        return kept.select(*names)
    again = found.filter("n_shingles > 0").groupBy(row).count().filter("count > 1").select(row)
    least = F.min(F.struct(*names)).alias("least")
    once = kept.join(again, row, "left_semi").groupBy(row).agg(least).select("least.*")
    return kept.join(again, row, "left_anti").select(*names).unionByName(once)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = long_texts(spark).read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontaminate.clean_rows(docs, items)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    long_texts(spark)
    masked = secrets.mask_live(docs)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    long_texts(spark)
    found = sentence_pieces.encode(docs, public_tokenizers.path(PIECES))
    return found.withColumn("n_tokens", F.size("ids").cast("bigint")).drop("text")


def _named(name: str):
    return F.col(f"`{name}`")


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("sentencepiece", sentencepiece_stage),
]

# Neither the classifier nor the tokenizer can be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages one after another; each one's rows are written and read again."""
    docs = long_texts(spark).read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for _, stage in STAGES:
        docs = settled(spark, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir))
        if before is not None:
            release(before)
        before = docs
    return docs
