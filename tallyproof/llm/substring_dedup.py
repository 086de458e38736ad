"""Substring dedup by seed and extend.

A word goes if a window of `WINDOW` consecutive words that covers it also starts in a
document with a smaller id. Windows are judged on the input.

Seeds are winnowed: of the `SEED`-word anchors in a window the one with the lowest hash is
its seed, so equal windows have equal seeds wherever they are, and one window in five needs
a seed of its own. Windows in a row with the same seed travel together: the seed's hash,
the document, the place, and the hash of each window, which extend the seed to the left
and right as far as this seed is theirs. Where equal seeds meet, each window's lowest
document is known, its partner, and the lowest place there. Spans of one document, one
partner and one diagonal (place minus place) that follow each other are joined across seeds,
which extends them both ways to maximal repeats (`maximal_repeats`); those of `least` words
or more are kept. A text that repeats itself may change its diagonal where the lowest place
of a window in the partner does.

* Most seeds occur once. They are counted first (64-bit hashes only, summed in the map
  tasks); a bit set of fixed size then keeps windows of other seeds out of the shuffle.
* Seeds are grouped in sorted partitions that are read as a stream. The seeds that occur
  most often (`HOT_ROWS` times, at most `HOT_SEEDS` of them) are not grouped at all: their
  windows' lowest documents are aggregated, partly in the map tasks, and joined back, which
  Spark can split.
* Seed and window hashes are independent, 64 bits each, so what is compared are 128 bits.

A null text has no words. A document with a null id neither loses words nor makes others
lose any. Rows with the same id are the same document number: none is smaller.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyproof.llm.bits import contains, hash_bits
from tallyproof.llm.columns import pieces, ragged, tally, window_starts, windows, words
from tallyproof.llm.stored import store

WINDOW = 13
SEED = 5
HOT_ROWS = 50_000
HOT_SEEDS = 100_000
_TOGETHER = 50_000  # rows compared at once

_KEYS = ["id", "twin"]
_SPAN = "id {kind}, twin bigint, begin int, stop int, partner {kind}, partner_twin bigint, partner_begin int"
_SPAN_NAMES = [x.split()[0] for x in _SPAN.split(", ")]


def _seeds(column: pa.Array):
    """For each run of windows with one seed in a text: the text's row, the first window's
    place in it, the number of windows, the seed's hash, and all window hashes."""
    w = words(column)
    own = window_starts(w.first, WINDOW)
    if not len(own):
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    anchors = windows(w.hashes(0), SEED)
    lowest, at = anchors[own], own.copy()
    for step in range(1, WINDOW - SEED + 1):
        value = anchors[own + step]
        less = value <= lowest
        lowest, at = np.where(less, value, lowest), np.where(less, own + step, at)
    # A seed between two texts' windows cannot be shared, but equal places can.
    row = np.searchsorted(w.first, own, "right") - 1
    fresh = np.ones(len(own), bool)
    fresh[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(fresh)
    counts = np.diff(first, append=len(own))
    place = own[first] - w.first[row[first]]
    return row[first], place, counts, lowest[first], windows(w.hashes(1), WINDOW, 1)[own]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return tally((_seeds(piece.column(0))[3] for piece in pieces(batches)), "seed")


def _runs(texts: DataFrame, bits, hot, want_hot: bool) -> DataFrame:
    """(seed, id, twin, place, windows) of the runs whose seed is in `bits`; either those
    of hot seeds or the others. `windows` are hashes of eight bytes each."""
    kinds = dict(texts.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = np.sort(np.array(hot.value, np.int64)).view(np.uint64)
        for piece in pieces(batches):
            row, place, counts, seeds, hashes = _seeds(piece.column(2))
            kept = np.isin(seeds, often)
            if not want_hot:
                kept = ~kept & contains(bits.value, seeds)
            ends = np.cumsum(counts)
            flat = hashes[ragged((ends - counts)[kept], counts[kept])]
            offsets = 8 * np.concatenate(([0], np.cumsum(counts[kept])))
            packed = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), int(kept.sum()), [None, pa.py_buffer(offsets), pa.py_buffer(flat)]
            ).cast(pa.binary())
            which = pa.array(row[kept])
            yield pa.RecordBatch.from_arrays(
                [pa.array(seeds[kept].view(np.int64)), piece.column(0).take(which), piece.column(1).take(which),
                 pa.array(place[kept].astype(np.int32)), packed],
                names=["seed", "id", "twin", "place", "windows"],
            )

    schema = f"seed bigint, id {kinds['id']}, twin bigint, place int, windows binary"
    return texts.select("id", "twin", "text").mapInArrow(run, schema)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by seed. Yields the windows that also start in a smaller document,
    as spans (`_SPAN`)."""
    waiting: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not len(batch):
            continue
        waiting.append(batch)
        rows += len(batch)
        seeds = batch.column(0)
        if rows < _TOGETHER or waiting[0].column(0)[0] == seeds[len(batch) - 1]:
            continue
        whole = pa.Table.from_batches(waiting).combine_chunks()
        ordered = whole.column(0).to_numpy()
        split = int(np.searchsorted(ordered, ordered[-1]))
        yield from _repeats(whole.slice(0, split))
        waiting = whole.slice(split).to_batches()
        rows = len(whole) - split
    if waiting:
        yield from _repeats(pa.Table.from_batches(waiting).combine_chunks())


def _repeats(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    seeds = rows.column("seed").to_numpy()
    # A seed that a single document has is not a repeat; the rows of one are dropped first.
    packed = rows.column("windows").combine_chunks()
    sizes = np.diff(np.frombuffer(packed.buffers()[1], np.int32)[packed.offset : packed.offset + len(packed) + 1]) // 8
    hashes = np.frombuffer(b"".join(packed.to_pylist()), np.uint64)
    row = np.repeat(np.arange(len(rows)), sizes)
    ids, twins, places = (rows.column(x).to_numpy() for x in ("id", "twin", "place"))
    ends = np.cumsum(sizes)
    place = places[row] + np.arange(len(row)) - (ends - sizes)[row]
    rank = np.empty(len(rows), np.int64)
    rank[np.lexsort((places, twins, ids))] = np.arange(len(rows))
    group = np.cumsum(np.concatenate(([0], seeds[1:] != seeds[:-1])))
    # Of equal windows the first has the lowest document, twin and place.
    order = np.lexsort((rank[row], hashes, group[row]))
    ordered, at = hashes[order], group[row[order]]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (ordered[1:] != ordered[:-1]) | (at[1:] != at[:-1])
    lead = np.empty(len(row), np.int64)
    lead[order] = order[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
    hit = np.flatnonzero(ids[row] > ids[row[lead]])
    if not len(hit):
        return
    lead, row, own = lead[hit], row[hit], place[hit]
    partner, there = np.searchsorted(ends, lead, "right"), place[lead]
    fresh = np.ones(len(hit), bool)
    fresh[1:] = (
        (own[1:] != own[:-1] + 1) | (row[1:] != row[:-1]) | (there[1:] != there[:-1] + 1)
        | (ids[partner[1:]] != ids[partner[:-1]]) | (twins[partner[1:]] != twins[partner[:-1]])
    )
    first = np.flatnonzero(fresh)
    stop = own[first] + np.diff(first, append=len(hit)) + WINDOW - 1
    which, with_which = pa.array(row[first]), pa.array(partner[first])
    columns = [rows.column(x).combine_chunks() for x in ("id", "twin")]
    yield pa.RecordBatch.from_arrays(
        [*(x.take(which) for x in columns), pa.array(own[first].astype(np.int32)), pa.array(stop.astype(np.int32)),
         *(x.take(with_which) for x in columns), pa.array(there[first].astype(np.int32))],
        names=_SPAN_NAMES,
    )


def _often(runs: DataFrame) -> DataFrame:
    """The same for hot seeds, window by window."""
    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = batch.column(4).to_pylist()
            sizes = np.array([len(x) // 8 for x in packed], np.int64)
            which = pa.array(np.repeat(np.arange(len(batch)), sizes))
            steps = ragged(np.zeros(len(batch), np.int64), sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(which), pa.array(np.frombuffer(b"".join(packed), np.int64)),
                 batch.column(1).take(which), batch.column(2).take(which),
                 pa.array((batch.column(3).take(which).to_numpy() + steps).astype(np.int32))],
                names=["seed", "hash", "id", "twin", "place"],
            )

    kind = dict(runs.dtypes)["id"]
    each = store(runs.mapInArrow(unfold, f"seed bigint, hash bigint, id {kind}, twin bigint, place int"))
    lowest = (
        each.groupBy("seed", "hash").agg(F.min(F.struct("id", "twin", "place")).alias("l"), F.max("id").alias("most"))
        .filter("l.id < most").drop("most")
    )
    return each.join(lowest, ["seed", "hash"]).filter("id > l.id").selectExpr(
        "id", "twin", "place AS begin", f"place + {WINDOW} AS stop",
        "l.id AS partner", "l.twin AS partner_twin", "l.place AS partner_begin",
    )


def repeats(rows: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, twin, begin, stop, partner, partner_twin, partner_begin): spans of words covered
    by windows that also start in a smaller document, the lowest of these, and the lowest
    place there. A span ends where its seed does, if not before. `twin` tells apart rows with
    the same id; it is 0 if ids are unique."""
    texts = _texts(rows, key, text).filter("id IS NOT NULL")
    spark = rows.sparkSession
    counts = (
        texts.select("text").mapInArrow(_counted, "seed bigint, n bigint")
        .groupBy("seed").agg(F.sum("n").alias("n")).filter("n > 1")
    )
    counts = store(counts)
    bits = hash_bits(counts, "seed")
    # At most HOT_SEEDS rows reach the driver; a seed below them occurs less often than any
    # of them, hence in less than one HOT_SEEDS-th of all rows.
    hot = [x.seed for x in counts.filter(F.col("n") >= HOT_ROWS).orderBy(F.desc("n"), "seed").limit(HOT_SEEDS).collect()]
    often = spark.sparkContext.broadcast(hot)
    kind = dict(texts.dtypes)["id"]
    found = (
        _runs(texts, bits, often, False)
        .repartition("seed").sortWithinPartitions("seed")
        .mapInArrow(_compared, _SPAN.format(kind=kind))
    )
    return found.unionByName(_often(_runs(texts, bits, often, True))) if hot else found


def maximal_repeats(
    rows: DataFrame, key: str = "doc_id", text: str = "text", least: int = WINDOW
) -> DataFrame:
    """Repeats of `least` words or more, with the columns of `repeats`: spans of a document
    and its partner that are next to each other in both are one.

    Rows are dealt by the document alone, so what groups its spans afterwards shuffles
    nothing; there are at most as many as it has words."""
    found = repeats(rows, key, text).repartition(*_KEYS)
    own = Window.partitionBy(*_KEYS, "partner", "partner_twin", F.col("partner_begin") - F.col("begin")).orderBy("begin")
    # Windows that follow each other overlap in all words but one.
    apart = F.coalesce(F.col("begin") > F.lag("stop").over(own) - (WINDOW - 1), F.lit(True))
    number = F.sum(F.col("apart").cast("int")).over(own)
    joined = found.withColumn("apart", apart).withColumn("number", number)
    shift = (F.col("partner_begin") - F.col("begin")).alias("shift")
    return (
        joined.groupBy(*_KEYS, "partner", "partner_twin", shift, "number")
        .agg(F.min("begin").alias("begin"), F.max("stop").alias("stop"), F.min("partner_begin").alias("partner_begin"))
        .filter(F.col("stop") - F.col("begin") >= least)
        .select(*_KEYS, "begin", "stop", "partner", "partner_twin", "partner_begin")
    )


def _texts(rows: DataFrame, key: str, text: str) -> DataFrame:
    texts = rows.select(F.col(f"`{key}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    ids = rows.select(F.col(f"`{key}`").alias("id")).filter("id IS NOT NULL")
    unique = ids.groupBy("id").count().filter("count > 1").isEmpty()
    twin = F.lit(0).cast("bigint") if unique else F.xxhash64("text")
    return texts.withColumn("twin", twin)


def _kept(batches: Iterator[pa.RecordBatch], sums: bool) -> Iterator[pa.RecordBatch]:
    """Rows of (id, text, begins, stops) to what is left of them."""
    for piece in pieces(batches):
        w = words(piece.column(1))
        change = np.zeros(len(w.starts) + 1, np.int64)
        for name, step in ((2, 1), (3, -1)):
            lists = piece.column(name)
            counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
            values = lists.flatten().to_numpy() + np.repeat(w.first[:-1], counts)
            np.add.at(change, values, step)
        kept = np.cumsum(change[:-1]) <= 0
        starts, sizes = w.starts[kept], (w.ends - w.starts)[kept] + 1
        joined = np.append(w.data, np.uint8(0x20))[ragged(starts, sizes)]
        ends = np.cumsum(sizes)
        joined[ends - 1] = 0x20
        view = joined.tobytes()
        left = np.concatenate(([0], np.cumsum(kept)))[w.first]
        at = np.concatenate(([0], ends))[left]
        texts = [view[a : max(a, b - 1)] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        n = np.diff(w.first)
        last = (
            pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string()) if sums
            else pa.array([x.decode() for x in texts], pa.string())
        )
        yield pa.RecordBatch.from_arrays(
            [piece.column(0), pa.array(n), pa.array(n - np.diff(left)), last],
            names=["id", "n_words", "n_removed", "kept"],
        )


def dedup_substrings(
    rows: DataFrame, key: str = "doc_id", text: str = "text", digests: bool = False, least: int = WINDOW
) -> DataFrame:
    """key, n_words, n_removed and kept: the kept words joined by one space, or its SHA-256.

    Words of maximal repeats of `least` words or more go."""
    spans = maximal_repeats(rows, key, text, least).groupBy(*_KEYS).agg(
        F.collect_list("begin").alias("begins"), F.collect_list("stop").alias("stops")
    )
    texts = _texts(rows, key, text)
    joined = texts.join(spans, _KEYS, "left").select("id", "text", "begins", "stops")
    kind = dict(texts.dtypes)["id"]
    schema = f"id {kind}, n_words bigint, n_removed bigint, kept string"
    return joined.mapInArrow(lambda batches: _kept(batches, digests), schema).withColumnRenamed("id", key)
