"""Stored form of the head tables that lets the daily checks read one day.

A function over a text date cannot prune files. Parsing it once at ingest and
storing by day turns every day window into a partition filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyproof.functions.dates import with_entry_ts

# Rows a file holds at most.
ROWS_PER_FILE = 5_000_000


def write_heads(heads: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Writes heads with ``entry_ts`` by ``entry_day``; undated ones keep a NULL day.

    Days are dealt by AQE in tasks of its advisory size: small ones share a task, a busy
    one (or all undated rows) is split over many. Files are sorted by branch and number,
    so that looking for numbers in the whole history can skip most of them.
    """
    dated = with_entry_ts(heads).withColumn("entry_day", F.col("entry_ts").cast("date"))
    (
        dated.hint("rebalance", "entry_day")
        .sortWithinPartitions("entry_day", "branch_id", "entry_number")
        .write.mode("overwrite")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy("entry_day")
        .parquet(path)
    )
