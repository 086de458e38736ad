"""Quality classifier: random Fourier features of document statistics, ridge, isotonic.

Each document becomes a short vector of statistics (shares of kinds of bytes, repetition
of words, pairs and lines, lengths, entropy). Random Fourier features of the standardised
vector approximate a Gaussian kernel; a ridge regression on them is fitted from normal
equations that every partition sums up for itself. Scores of rows the regression has not
seen are then calibrated by isotonic regression over a fixed number of bins.

The model's size does not depend on the data. It is learnt from a bounded sample of the
labelled rows (`labelled.FIT_ROWS`), and every text is scored whole. A null text counts
as empty; without any label to learn from, every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyproof.llm.columns import add_columns, buffers, mix, pieces, span_hash, windows, words
from tallyproof.llm.labelled import CALIBRATION_FOLDS, Isotonic, held_out, labelled_rows, sums
from tallyproof.llm.stored import store

FOURIER = 320
BANDWIDTH = 1.0  # in units of the square root of the number of statistics
RIDGE = 1e-4
SEED = 2024
THRESHOLD = 0.5

_KINDS = {
    "upper": [*range(0x41, 0x5B)],
    "lower": [*range(0x61, 0x7B)],
    "digit": [*range(0x30, 0x3A)],
    "stop": [0x2E, 0x2C, 0x3B, 0x3A, 0x3F],
    "shout": [0x21],
    "sign": [0x23, 0x24, 0x25, 0x26, 0x2A, 0x40, 0x5E, 0x7E, 0x7C, 0x3C, 0x3E, 0x7B, 0x7D, 0x5C, 0x3D, 0x2B, 0x5F],
    "line": [0x0A],
    "blank": [0x20, 0x09, 0x0D],
    "wide": [*range(0x80, 0x100)],
}
_KIND_OF = np.full(256, len(_KINDS), np.uint8)
for _i, _members in enumerate(_KINDS.values()):
    _KIND_OF[_members] = _i
_STATISTICS = 26


def _distinct(row: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    """Number of distinct values of each row."""
    keys = np.unique(mix(values ^ mix(row.astype(np.uint64) + np.uint64(1))), return_index=True)[1]
    return np.bincount(row[keys], minlength=rows)


def statistics(column: pa.Array) -> np.ndarray:
    """One vector for each text."""
    rows = len(column)
    data, offsets = buffers(column)
    sizes = np.diff(offsets)
    row_of = np.repeat(np.arange(rows), sizes)
    kinds = np.bincount(row_of * 16 + _KIND_OF[data], minlength=rows * 16).reshape(rows, 16)
    bytes_ = np.bincount(row_of * 256 + data, minlength=rows * 256).reshape(rows, 256)
    share = bytes_ / np.maximum(sizes, 1)[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        entropy = -np.where(share > 0, share * np.log(share), 0).sum(axis=1)
    w = words(column)
    n = np.diff(w.first)
    some = np.maximum(n, 1)
    row, hashes, lengths = w.row(), w.hashes(), w.ends - w.starts
    per = lambda hit: np.bincount(row[hit], minlength=rows) / some
    again = np.zeros(len(hashes), bool)
    if len(hashes):
        again[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    tails, fronts = w.data[w.ends - 1], w.data[w.starts]
    inner = np.cumsum(np.concatenate(([0], _KIND_OF[w.data] == 0)))
    upper = inner[w.ends] - inner[w.starts]
    total = np.bincount(row, lengths, minlength=rows)
    squares = np.bincount(row, lengths.astype(float) ** 2, minlength=rows)
    mean = total / some

    def repeated(size: int) -> np.ndarray:
        """Share of runs of `size` words that occurred before in the text."""
        if len(hashes) < size:
            return np.zeros(rows)
        own = np.flatnonzero(row[: len(row) - size + 1] == row[size - 1 :])
        made = hashes[own] if size == 1 else windows(hashes, size)[own]
        counts = np.bincount(row[own], minlength=rows)
        return 1 - _distinct(row[own], made, rows) / np.maximum(counts, 1) * (counts > 0) - (counts == 0)

    ends = np.unique(np.concatenate((np.flatnonzero(data == 0x0A) + 1, offsets[1:]))) if len(data) else np.zeros(0, int)
    ends = ends[ends > 0]
    starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    line_row = np.searchsorted(offsets, starts, "right") - 1 if len(ends) else ends
    lines = np.bincount(line_row, minlength=rows)
    unlike = _distinct(line_row, span_hash(data, starts, ends), rows) if len(ends) else np.zeros(rows)
    columns = [
        np.log1p(sizes), np.log1p(n), mean, np.sqrt(np.maximum(squares / some - mean**2, 0)), entropy,
        *(kinds[:, i] / np.maximum(sizes, 1) for i in range(len(_KINDS))),
        per(again), per(upper == lengths), per((upper > 1) & (upper >= lengths - 3)),
        per(_KIND_OF[tails] == 5), per(tails == 0x21), per(tails == 0x2E), per(_KIND_OF[fronts] == 0),
        repeated(1) * np.minimum(1, 200 / some), repeated(2), repeated(4),
        n / np.maximum(lines, 1), 1 - unlike / np.maximum(lines, 1) * (lines > 0) - (lines == 0),
    ]
    return np.stack(columns, axis=1)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    calibrated: Isotonic | None = None

    def features(self, found: np.ndarray) -> np.ndarray:
        return _features((found - self.mean) / self.scale)

    def raw(self, found: np.ndarray) -> np.ndarray:
        return self.features(found) @ self.weights


def _features(x: np.ndarray) -> np.ndarray:
    """Fourier features, the vector itself and a constant."""
    x = np.clip(x, -6, 6)
    made = np.random.default_rng(SEED)
    directions = made.standard_normal((x.shape[1], FOURIER)) / (BANDWIDTH * np.sqrt(x.shape[1]))
    phases = made.uniform(0, 2 * np.pi, FOURIER)
    waves = np.sqrt(2 / FOURIER) * np.cos(x @ directions + phases)
    return np.concatenate((waves, x / 10, np.ones((len(x), 1))), axis=1)


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index("found"))
    return np.asarray(column.flatten().to_numpy()).reshape(len(column), -1)


def fit(rows: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id") -> Model | None:
    """Learns from labelled rows that are not held out; None without any."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            found = statistics(piece.column(0))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), found.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([lists, *piece.columns[1:]], names=["found", "label", "fold"])

    sample = labelled_rows(rows, labels, label, key)
    vectors = store(sample.mapInArrow(measured, "found array<double>, label int, fold int"))
    size = _STATISTICS

    def moments(batches):
        total = np.zeros(1 + 2 * size)
        for batch in batches:
            if len(batch):
                x = _vectors(batch)
                total += np.concatenate(([len(x)], x.sum(axis=0), (x * x).sum(axis=0)))
        return total

    total = sums(vectors, moments, 1 + 2 * size)
    if not total[0]:
        return None
    mean = total[1 : 1 + size] / total[0]
    scale = np.sqrt(np.maximum(total[1 + size :] / total[0] - mean**2, 0))
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0), np.zeros(0))
    width = FOURIER + size + 1

    def equations(batches):
        left, right = np.zeros((width, width)), np.zeros(width)
        for batch in batches:
            for start in range(0, len(batch), 2048):
                part = batch.slice(start, 2048)
                x = model.features(_vectors(part))
                left += x.T @ x
                right += x.T @ part.column(1).to_numpy().astype(float)
        return np.concatenate((left.ravel(), right))

    learnt = vectors.filter(F.col("fold") >= CALIBRATION_FOLDS)
    # Few partitions: each sends a whole matrix.
    total = sums(learnt.coalesce(16), equations, width * width + width)
    left = total[: width * width].reshape(width, width)
    count = max(left[-1, -1], 1.0)
    model.weights = np.linalg.solve(left + RIDGE * count * np.eye(width), total[width * width :])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(model.raw(_vectors(batch))), batch.column(1)], names=["raw", "label"]
                )

    unseen = vectors.filter(F.col("fold") < CALIBRATION_FOLDS)
    model.calibrated = Isotonic(unseen.mapInArrow(scored, "raw double, label int"), -0.5, 1.5)
    return model


def score(rows: DataFrame, model: Model | None, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Adds score and predicted to each row (replacing columns of these names)."""
    if model is None:
        plain = rows.withColumn("score", F.lit(0.5))
        return plain.withColumn("predicted", F.lit(int(threshold <= 0.5)))

    def make(column: pa.Array) -> list:
        found = model.calibrated(model.raw(statistics(column)))
        return [pa.array(found, pa.float64()), (found >= threshold).astype(np.int32)]

    return add_columns(rows, text, ["score double", "predicted int"], lambda: make)


def classify(rows: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id") -> DataFrame:
    """Learns from the rows that are not held out and scores all. Adds held_out as well."""
    model = fit(rows, labels, label, key)
    kept = rows.drop("held_out")
    return score(kept.withColumn("held_out", held_out(key)), model)
