"""Tables an operator writes between its steps, in the folder all executors share.

Within a block of `intermediates` they go at its end. Steps that are done with a table
release it at once; what a result still reads is never released."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyproof.sources.shared import intermediates, remove, run_folder


def store(frame: DataFrame) -> DataFrame:
    """Writes `frame` and reads it back: computed once, whatever executors are lost."""
    spark = frame.sparkSession
    path = f"{run_folder(spark)}/{uuid.uuid4().hex}"
    frame.write.parquet(path)
    found = spark.read.schema(frame.schema).parquet(path)
    found.stored_at = path
    return found


def release(*frames: DataFrame) -> None:
    """Removes the files of stored frames that nothing will read any more."""
    for frame in frames:
        remove(frame.sparkSession, frame.stored_at)


def settled(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """Stores what `make` returns and removes all that it stored on the way."""
    path = f"{run_folder(spark)}/{uuid.uuid4().hex}"
    with intermediates(spark):
        frame = make()
        frame.write.parquet(path)
    found = spark.read.schema(frame.schema).parquet(path)
    found.stored_at = path
    return found


def long_texts(spark: SparkSession) -> SparkSession:
    """Has Arrow batches hold fewer rows: of long texts the usual number fills gigabytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark
