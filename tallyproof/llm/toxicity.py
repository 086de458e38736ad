"""Toxicity by maximum-scoring segments of token log-odds.

A token is a lower-cased word; it is looked up whole and by its first 4, 5 and 6 code
points, as many languages inflect. Each of these falls into a fixed number of buckets by
hash. A bucket's weight is the log-odds ratio of toxic against other texts that have it,
with the whole sample's counts as a Dirichlet prior; weights that are not significantly
positive are 0, and of a word's weights the highest counts. Less a constant, token scores are negative on average,
and the linear-time scan of Ruzzo and Tompa finds all maximal segments of positive score:
the toxic passages.

A segment's score S in a text of n tokens is judged by the extreme-value law of such
scores, E = K n exp(-lambda S): lambda solves sum p exp(lambda s) = 1 over the token
scores of other texts, and K follows from the segments found in other texts that the
weights were not learnt from. A text's statistic adds up -log E of its segments where E is
below 1, and isotonic regression over that statistic gives the score.

Model and statistics sent to the driver are bounded by the number of buckets and bins. The
model is learnt from a bounded sample (`labelled.FIT_ROWS`); every text is scored whole.
A null or empty text has no segment and gets the lowest score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyproof.llm.columns import ALPHANUMERIC, Words, add_columns, pieces, span_hash, words
from tallyproof.llm.labelled import CALIBRATION_FOLDS, Isotonic, held_out, labelled_rows
from tallyproof.llm.ngram_join import jaccard_components
from tallyproof.llm.stored import store

STEMS = (4, 5, 6)  # code points; fewer than that are the whole word
BUCKETS = 1 << 20  # for words, and again for each length of stem
PRIOR = 500.0  # occurrences the prior is worth, spread as in the sample
FLAT_PRIOR = 1.0  # and occurrences it adds to every bucket
SIGNIFICANT = 4.0  # standard errors
DRIFT = 0.25
THRESHOLD = 0.7
_MOST = 200.0
_BINS = 2000


def tokens(column: pa.Array) -> tuple[Words, np.ndarray]:
    """Words, and for each of them a bucket by the whole word and by each stem."""
    w = words(column, ALPHANUMERIC, lower=True)
    heads = np.flatnonzero((w.data & 0xC0) != 0x80)
    at = np.searchsorted(heads, w.starts)
    heads = np.concatenate((heads, np.full(max(STEMS) + 1, len(w.data))))
    ends = [w.ends, *(np.minimum(heads[at + size], w.ends) for size in STEMS)]
    found = [
        (span_hash(w.data, w.starts, end) % np.uint64(BUCKETS)).astype(np.int64) + i * BUCKETS
        for i, end in enumerate(ends)
    ]
    return w, np.stack(found)


def log_odds(counts: DataFrame) -> DataFrame:
    """(bucket, weight) of the significant buckets of (bucket, toxic, other) counts.

    Words and each length of stem are distributions of their own."""
    kinds = counts.withColumn("kind", F.floor(F.col("bucket") / BUCKETS))
    total = kinds.groupBy("kind").agg(F.sum("toxic").alias("all_toxic"), F.sum("other").alias("all_other"))
    found = (
        kinds.join(F.broadcast(total), "kind")  # a row for each kind
        .withColumn("prior", PRIOR * F.expr("(toxic + other) / (all_toxic + all_other)") + FLAT_PRIOR)
        .withColumn("a", F.expr("toxic + prior"))
        .withColumn("b", F.expr("other + prior"))
        .withColumn("weight", F.expr(f"ln(a / (all_toxic + {PRIOR} - a)) - ln(b / (all_other + {PRIOR} - b))"))
    )
    return found.filter(F.expr(f"weight >= {SIGNIFICANT} * sqrt(1 / a + 1 / b)")).select("bucket", "weight")


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal segments (start, end, score) of positive score, in one scan.

    Runs of positive and of other scores are taken as one step each, which cannot change
    where maximal segments begin or end."""
    positive = scores > 0
    if not positive.any():
        return []
    edges = np.flatnonzero(np.diff(np.concatenate(([False], positive, [False])).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    sums = np.concatenate(([0.0], np.cumsum(scores)))
    return _merged(starts.tolist(), ends.tolist(), sums[starts].tolist(), sums[ends].tolist())


def _merged(starts: list, ends: list, lefts: list, rights: list) -> list[tuple[int, int, float]]:
    """The scan over candidates with the sums before (left) and after (right) each."""
    kept: list[list] = []  # start, end, left, right, the last candidate with a lesser left
    for start, end, left, right in zip(starts, ends, lefts, rights, strict=True):
        now = [start, end, left, right, -1]
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= now[2]:
                j = kept[j][4]
            now[4] = j
            if j < 0 or kept[j][3] >= now[3]:
                kept.append(now)
                break
            now = [kept[j][0], now[1], kept[j][2], now[3], -1]
            del kept[j:]
    return [(s, e, r - l) for s, e, l, r, _ in kept]


@dataclass
class Model:
    buckets: np.ndarray  # sorted, with the weight of each
    weights: np.ndarray
    rate: float = 1.0  # lambda
    factor: float = 1.0  # K
    calibrated: Isotonic | None = None

    def scored(self, buckets: np.ndarray) -> np.ndarray:
        if not len(self.buckets):
            return np.full(buckets.shape[1], -DRIFT)
        at = np.minimum(np.searchsorted(self.buckets, buckets), len(self.buckets) - 1)
        return np.where(self.buckets[at] == buckets, self.weights[at], 0.0).max(axis=0) - DRIFT

    def passages(self, column: pa.Array) -> Iterator[tuple[int, list[tuple[int, int, float]]]]:
        """Number of tokens and maximal segments of each text."""
        w, buckets = tokens(column)
        yield from _segments(self.scored(buckets), w.first)

    def statistic(self, size: int, segments: list[tuple[int, int, float]]) -> float:
        base = np.log(max(self.factor * size, 1e-300))
        return float(sum(max(0.0, self.rate * s - base) for _, _, s in segments))

    def raw(self, column: pa.Array) -> np.ndarray:
        return np.array([min(_MOST, self.statistic(n, x)) for n, x in self.passages(column)])


def _segments(scores: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, list]]:
    """Like maximal_segments for each text of a slice, with the runs of all found at once."""
    positive = scores > 0
    begins, stops = positive.copy(), positive.copy()
    begins[1:] &= ~positive[:-1]
    stops[:-1] &= ~positive[1:]
    filled = first[:-1] < first[1:]
    at = first[:-1][filled]
    begins[at] = positive[at]
    at = first[1:][filled] - 1
    stops[at] = positive[at]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    sums = np.concatenate(([0.0], np.cumsum(scores)))
    lefts, rights = sums[starts], sums[ends]
    bounds = np.searchsorted(starts, first)
    for i in range(len(first) - 1):
        a, b = bounds[i], bounds[i + 1]
        size = int(first[i + 1] - first[i])
        if a == b:
            yield size, []
            continue
        found = _merged(starts[a:b].tolist(), ends[a:b].tolist(), lefts[a:b].tolist(), rights[a:b].tolist())
        yield size, [(s - int(first[i]), e - int(first[i]), x) for s, e, x in found]


def _rate(scores: np.ndarray, shares: np.ndarray) -> float:
    """The positive solution of sum(shares * exp(rate * scores)) = 1."""
    low, high = 1e-6, 1.0
    value = lambda r: float(np.sum(shares * np.exp(np.minimum(r * scores, 500)))) - 1
    if not (scores[shares > 0] > 0).any():
        return 1.0
    while value(high) < 0 and high < 1e3:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if value(middle) < 0 else (low, middle)
    return high


def fit(rows: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id") -> Model | None:
    """Learns from labelled rows that are not held out; None without any."""
    sample = store(labelled_rows(rows, labels, label, key).withColumn("row", F.monotonically_increasing_id()))
    learnt = sample.filter(F.col("fold") >= CALIBRATION_FOLDS)
    # Near copies would make all their words look significant: what the texts of a label
    # in a component of op5's links have, counts once for all of them.
    found = store(jaccard_components(learnt, "row").select("row", F.col("component_id").alias("component")))
    several = found.groupBy("component").agg(F.count("*").alias("n")).filter("n > 1").select("component")
    copies = store(found.join(several, "component"))  # row numbers of the bounded sample

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            w, buckets = tokens(piece.column(0))
            # Each text counts once for a bucket, however often it repeats a word.
            keys = np.unique((w.row()[None, :] << 40 | buckets).ravel())
            buckets, toxic = keys & ((1 << 40) - 1), piece.column(1).to_numpy()[keys >> 40] > 0
            some, place = np.unique(buckets, return_inverse=True)
            hits = np.bincount(place[toxic], minlength=len(some))
            rest = np.bincount(place[~toxic], minlength=len(some))
            yield pa.RecordBatch.from_arrays(
                [pa.array(some), pa.array(hits), pa.array(rest)], names=["bucket", "toxic", "other"]
            )

    def had(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            w, buckets = tokens(piece.column(0))
            keys = np.unique((w.row()[None, :] << 40 | buckets).ravel())
            row = keys >> 40
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys & ((1 << 40) - 1)), *(piece.column(i).take(pa.array(row)) for i in (1, 2))],
                names=["bucket", "label", "component"],
            )

    alone = learnt.join(F.broadcast(copies.select("row")), "row", "left_anti").select("text", "label")
    alike = learnt.join(F.broadcast(copies), "row").select("text", "label", "component")
    alike = alike.mapInArrow(had, "bucket bigint, label int, component bigint").distinct().select(
        "bucket", F.expr("if(label > 0, 1L, 0L)").alias("toxic"), F.expr("if(label > 0, 0L, 1L)").alias("other")
    )
    counts = alone.mapInArrow(counted, "bucket bigint, toxic bigint, other bigint").unionByName(alike)
    counts = store(counts.groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")))
    if counts.isEmpty():
        return None
    weights = log_odds(counts).orderBy("bucket").toPandas()
    model = Model(weights["bucket"].to_numpy(np.int64), weights["weight"].to_numpy(float))
    unseen = sample.filter(F.col("fold") < CALIBRATION_FOLDS)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_BINS, np.int64)
        for piece in pieces(batches):
            scores = model.scored(tokens(piece.column(0))[1])
            total += np.bincount(np.clip((scores + 10) / 20 * _BINS, 0, _BINS - 1).astype(np.int64), minlength=_BINS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bin", "n"])

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            sizes, tails = [], []
            for size, segments in model.passages(piece.column(0)):
                sizes.append(size)
                tails.append(sum(np.exp(-min(500.0, model.rate * 0.5 * s)) for _, _, s in segments))
            yield pa.RecordBatch.from_arrays(
                [pa.array(sizes, pa.int64()), pa.array(tails, pa.float64())], names=["size", "tail"]
            )

    others = unseen.filter("label = 0")
    bins = others.mapInArrow(spread, "bin bigint, n bigint").groupBy("bin").agg(F.sum("n").alias("n")).toPandas()
    if len(bins):
        middles = (bins["bin"].to_numpy() + 0.5) / _BINS * 20 - 10
        model.rate = _rate(middles, (bins["n"] / bins["n"].sum()).to_numpy())
    # By the law, exp(-lambda S / 2) summed over the segments of n tokens is K n / 1.5 on
    # average. Solved for K this uses all segments, not just the best one of a text.
    row = (
        others.mapInArrow(measured, "size bigint, tail double")
        .agg(F.sum("size").alias("size"), F.sum("tail").alias("tail"))
        .first()
    )
    if row.size and row.tail:
        model.factor = max(1e-9, 1.5 * row.tail / row.size)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(model.raw(piece.column(0)), pa.float64()), piece.column(1)], names=["raw", "label"]
            )

    model.calibrated = Isotonic(unseen.mapInArrow(scored, "raw double, label int"), 0.0, _MOST)
    return model


def score(rows: DataFrame, model: Model | None, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Adds score and predicted to each row (replacing columns of these names)."""
    if model is None:
        plain = rows.withColumn("score", F.lit(0.5))
        return plain.withColumn("predicted", F.lit(int(threshold <= 0.5)))

    def make(column: pa.Array) -> list:
        found = model.calibrated(model.raw(column))
        return [pa.array(found, pa.float64()), (found >= threshold).astype(np.int32)]

    return add_columns(rows, text, ["score double", "predicted int"], lambda: make)


def classify(rows: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id") -> DataFrame:
    """Learns from the rows that are not held out and scores all. Adds held_out as well."""
    model = fit(rows, labels, label, key)
    return score(rows.drop("held_out").withColumn("held_out", held_out(key)), model)
