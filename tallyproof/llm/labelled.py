"""What the two classifiers share: labelled rows to learn from, and calibration.

Learning uses a bounded sample of the labelled rows: all of them up to `FIT_ROWS`, beyond
that those whose id hashes lowest. Scoring and everything else cover every row.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Documented bound of the sample. Its ids and labels are broadcast (16 bytes a row).
FIT_ROWS = 200_000
FOLDS = 10
CALIBRATION_FOLDS = 3
_BINS = 1024


def id_crc(key: str) -> Column:
    return F.crc32(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")))


def held_out(key: str = "doc_id") -> Column:
    """Rows that are never learnt from. A null id counts as the empty text."""
    return id_crc(key) % 3 == 1


def labelled_rows(
    rows: DataFrame, labels: DataFrame, label: str, key: str = "doc_id", fit_rows: int = FIT_ROWS
) -> DataFrame:
    """(text, label, fold) of the sample. Of several labels of an id the highest counts."""
    known = (
        labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").cast("int").alias("label"))
        .filter("key IS NOT NULL AND label IS NOT NULL")
        .filter(~held_out("key"))
        .groupBy("key").agg(F.max("label").alias("label"))
    )
    count = known.count()
    if count > fit_rows:
        # Hashes are even, so this keeps about fit_rows rows.
        known = known.filter(F.pmod(F.xxhash64("key"), F.lit(1 << 32)) < int((1 << 32) * fit_rows / count))
    known = known.withColumn("fold", F.pmod(F.xxhash64("key", F.lit("fold")), F.lit(FOLDS)).cast("int"))
    texts = rows.select(
        F.col(f"`{key}`").alias("key"), F.coalesce(F.col("`text`"), F.lit("")).alias("text")
    )
    return texts.join(F.broadcast(known), "key").select("text", "label", "fold")


class Isotonic:
    """A non-decreasing map from raw scores to the share of label 1, from counts in bins."""

    def __init__(self, raw: DataFrame, low: float, high: float):
        """`raw` has (raw, label); at most `_BINS` rows of it reach the driver."""
        width = (high - low) / _BINS
        inside = F.greatest(F.lit(low), F.least(F.lit(high - width / 2), F.col("raw")))
        at = F.floor((inside - low) / width)
        counts = raw.groupBy(at.alias("at")).agg(
            F.count("*").alias("n"), F.sum("label").alias("ones"), F.avg(inside).alias("middle")
        )
        found = sorted(tuple(x) for x in counts.collect())
        blocks: list[list[float]] = []
        for _, n, ones, middle in found:
            blocks.append([n, ones, middle * n])
            while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
                last = blocks.pop()
                blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
        # One more row of either kind keeps shares away from 0 and 1.
        self.shares = np.array([(b[1] + 0.1) / (b[0] + 0.2) for b in blocks] or [0.5])
        self.shares = np.maximum.accumulate(self.shares)
        self.middles = np.array([b[2] / b[0] for b in blocks] or [0.0])
        self.low, self.high = low, high

    def __call__(self, raw: np.ndarray) -> np.ndarray:
        """Scores from 0 to 1; within a flat part they still rise a little."""
        steep = np.interp(raw, self.middles, self.shares)
        spread = np.clip((raw - self.low) / (self.high - self.low), 0, 1)
        return np.clip(0.999 * steep + 0.001 * spread, 0.0, 1.0)


def sums(rows: DataFrame, make: Callable, size: int) -> np.ndarray:
    """Element-wise sum over all partitions of the array `make` returns for one partition's
    batches. Partial sums are added up in a few tasks before the driver adds those."""

    def run(batches):
        import pyarrow as pa

        total = make(batches)
        yield pa.RecordBatch.from_arrays(
            [pa.array([0]), pa.array([total.astype("<f8").tobytes()], pa.binary())], names=["g", "part"]
        )

    def add(batches):
        import pyarrow as pa

        total = np.zeros(size)
        for batch in batches:
            for x in batch.column(0).to_pylist():
                total += np.frombuffer(x, "<f8")
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    parts = rows.mapInArrow(run, "g bigint, part binary").select("part")
    few = parts.repartition(8).mapInArrow(add, "part binary")
    return np.sum([np.frombuffer(x.part, "<f8") for x in few.collect()], axis=0)
