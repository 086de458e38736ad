"""Benchmark decontamination by a positional inverted index.

A window is `WINDOW` consecutive words of an item, or all words of an item with fewer. A
document word inside an occurrence of a window is hit.

1. The documents' counts of the benchmark's terms are summed up.
2. For each distinct window (a phrase) its two rarest terms are chosen, at their offsets.
3. An index of these terms is built from the documents: (term, document, positions).
4. The lists of a phrase's rarest term, less its offset, give the starts it could have;
   they are intersected with the lists of the second rarest, less that offset.
5. The starts left are verified on the text by 128-bit hashes of the words there.

Terms are told from other words in the tasks by a bit set of fixed size, so the benchmark
may grow; what it lets through wrongly is dropped by the join with the terms. `near` finds
proximity matches in the same index. A word repeated very often makes long lists only if
it is among the rarest of a window; lists are joined by Spark and never collected, but for
one document's positions of one term.

Null texts have no words. Documents are indexed by a hash of their id and text, so rows
without an id, or with one that others have, are searched like the rest, each in its own
text; rows equal in both share their lists. Repeated items are one item of that id. Windows
of items without an id are searched as well, but have no id to be listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyproof.llm.bits import contains, hash_bits
from tallyproof.llm.columns import ALPHANUMERIC, Words, pieces, ragged, tally, windows, words
from tallyproof.llm.stored import store

WINDOW = 10
_BITS = 22


def _words(column: pa.Array) -> Words:
    return words(column, ALPHANUMERIC, lower=True)


def phrases(items: DataFrame, key: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(size, first, second, terms, items): distinct windows by two hashes, the hashes of
    their words, and the ids of the items that have them, as strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            w = _words(piece.column(1))
            one, two = w.hashes(0), w.hashes(1)
            n = np.diff(w.first)
            sizes = np.minimum(n, window)
            counts = np.where(n > 0, n - sizes + 1, 0)
            row = np.repeat(np.arange(len(n)), counts)
            starts = ragged(w.first[:-1], counts)
            first, second = _phrase_hashes(one, two, starts, sizes[row])
            spans = ragged(starts, sizes[row])
            ends = np.concatenate(([0], np.cumsum(sizes[row])))
            terms = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(one[spans].view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(sizes[row].astype(np.int32)), pa.array(first.view(np.int64)),
                 pa.array(second.view(np.int64)), terms, piece.column(0).take(pa.array(row))],
                names=["size", "first", "second", "terms", "item"],
            )

    rows = items.select(
        F.col(f"`{key}`").cast("string").alias("item"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    )
    found = rows.mapInArrow(run, "size int, first bigint, second bigint, terms array<bigint>, item string")
    return found.groupBy("size", "first", "second").agg(
        F.first("terms").alias("terms"), F.collect_set("item").alias("items")
    )


def _phrase_hashes(one, two, starts, sizes) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the phrase of `sizes` words at each of `starts`."""
    first, second = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.uint64)
    for size in np.unique(sizes).tolist():
        own = sizes == size
        first[own] = windows(one, size, 0)[starts[own]]
        second[own] = windows(two, size, 1)[starts[own]]
    return first, second


def term_counts(rows: DataFrame, bits: Broadcast) -> DataFrame:
    """(term, n) for all words of `rows` (text) that may be terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (_words(piece.column(0)).hashes(0) for piece in pieces(batches))
        return tally((hashes[contains(bits.value, hashes)] for hashes in found), "term")

    return rows.select("text").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))


def positional_index(rows: DataFrame, bits: Broadcast) -> DataFrame:
    """(term, id, positions) of the words of `rows` (id, text) that may be terms."""
    kind = dict(rows.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            w = _words(piece.column(1))
            hashes = w.hashes(0)
            at = np.flatnonzero(contains(bits.value, hashes))
            row = np.searchsorted(w.first, at, "right") - 1
            place, hashes = at - w.first[row], hashes[at]
            order = np.lexsort((place, hashes, row))
            row, place, hashes = row[order], place[order], hashes[order]
            fresh = np.ones(len(row), bool)
            fresh[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
            first = np.flatnonzero(fresh)
            lists = pa.ListArray.from_arrays(
                pa.array(np.append(first, len(row)), pa.int32()), pa.array(place.astype(np.int32))
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes[first].view(np.int64)), piece.column(0).take(pa.array(row[first])), lists],
                names=["term", "id", "positions"],
            )

    return rows.select("id", "text").mapInArrow(run, f"term bigint, id {kind}, positions array<int>")


def rarest(found: DataFrame, counts: DataFrame) -> DataFrame:
    """Phrases whose terms all occur, with their rarest term and offset (term, at) and the
    second rarest (term_2, at_2; NULL for a phrase of one word)."""
    places = found.select("size", "first", "second", F.posexplode("terms").alias("at", "term"))
    ranked = places.join(counts, "term").groupBy("size", "first", "second").agg(
        F.array_sort(F.collect_list(F.struct("n", "term", "at"))).alias("ranked")
    )
    ranked = ranked.filter(F.size("ranked") == F.col("size"))
    return ranked.select(
        "size", "first", "second",
        F.col("ranked")[0]["term"].alias("term"), F.col("ranked")[0]["at"].alias("at"),
        F.get("ranked", F.lit(1))["term"].alias("term_2"), F.get("ranked", F.lit(1))["at"].alias("at_2"),
    )


def candidates(chosen: DataFrame, index: DataFrame) -> DataFrame:
    """(id, size, first, second, starts): where a phrase's two rarest terms fit."""
    start = F.filter(F.transform("positions", lambda p: p - F.col("at")), lambda p: p >= 0)
    lists = chosen.join(index, "term").select("id", "size", "first", "second", "term_2", "at_2", start.alias("starts"))
    lists = lists.filter(F.size("starts") > 0)
    others = index.select(F.col("term").alias("term_2"), F.col("id").alias("id"), F.col("positions").alias("others"))
    both = lists.filter("term_2 IS NOT NULL").join(others, ["term_2", "id"]).withColumn(
        "starts", F.array_intersect("starts", F.transform("others", lambda p: p - F.col("at_2")))
    )
    columns = ["id", "size", "first", "second", "starts"]
    one = lists.filter("term_2 IS NULL").select(*columns)
    return both.filter(F.size("starts") > 0).select(*columns).unionByName(one)


def near(index: DataFrame, term: int, other: int, distance: int) -> DataFrame:
    """(id, position, other_position) of two terms (hashes) at most `distance` words apart."""
    a = index.filter(F.col("term") == term).select("id", F.explode("positions").alias("position"))
    b = index.filter(F.col("term") == other).select("id", "positions")
    close = F.filter("positions", lambda p: F.abs(p - F.col("position")) <= distance)
    return a.join(b, "id").select("id", "position", F.explode(close).alias("other_position"))


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text, found, more columns) to (id, n_words, n_hit, items, more columns)."""
    for piece in pieces(batches):
        w = _words(piece.column(1))
        n = np.diff(w.first)
        found = piece.column(2)
        change = np.zeros(len(w.starts) + 1, np.int64)
        items = [[] for _ in range(len(piece))]
        if found.null_count < len(found):
            one, two = w.hashes(0), w.hashes(1)
            per_row = pc.fill_null(pc.list_value_length(found), 0).to_numpy()
            row = np.repeat(np.arange(len(piece)), per_row)
            flat = found.flatten()
            size = flat.field("size").to_numpy()
            starts = flat.field("starts")
            per = pc.list_value_length(starts).to_numpy()
            which = np.repeat(np.arange(len(flat)), per)
            at = starts.flatten().to_numpy().astype(np.int64)
            inside = at + size[which] <= n[row[which]]
            which, at = which[inside], at[inside]
            begin = w.first[:-1][row[which]] + at
            first, second = _phrase_hashes(one, two, begin, size[which])
            same = (first.view(np.int64) == flat.field("first").to_numpy()[which]) & (
                second.view(np.int64) == flat.field("second").to_numpy()[which]
            )
            which, begin = which[same], begin[same]
            np.add.at(change, begin, 1)
            np.add.at(change, begin + size[which], -1)
            names = flat.field("items")
            for i in np.unique(which).tolist():
                items[row[i]] += names[i].as_py()
        hit = np.concatenate(([0], np.cumsum(np.cumsum(change[:-1]) > 0)))[w.first]
        yield pa.RecordBatch.from_arrays(
            [piece.column(0), pa.array(n), pa.array(np.diff(hit)),
             pa.array([sorted(set(x)) for x in items], pa.list_(pa.string())), *piece.columns[3:]],
            names=["id", "n_words", "n_hit", "items", *piece.schema.names[3:]],
        )


def decontaminate(
    rows: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """key, n_words, n_hit (words inside occurrences) and items (sorted ids as strings of
    those that occur) for each row."""
    found = _found(rows, items, [], key, text, item_key, item_text)
    return found.withColumnRenamed("id", key)


def clean_rows(
    rows: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The rows without any occurrence, as they are."""
    found = _found(rows, items, rows.columns, key, text, item_key, item_text).filter("n_hit = 0")
    return found.select(*[F.col(f"_{i}").alias(name) for i, name in enumerate(rows.columns)])


def _found(rows, items, more: list[str], key, text, item_key, item_text) -> DataFrame:
    """What decontaminate returns, and the columns `more` as _0, _1, .."""
    texts = rows.select(
        F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"),
        *[F.col(f"`{name}`").alias(f"_{i}") for i, name in enumerate(more)],
    )
    texts = texts.withColumn("who", F.xxhash64("id", "text"))
    wanted = store(phrases(items, item_key, item_text))
    terms = wanted.select(F.explode("terms").alias("term")).distinct()
    bits = hash_bits(terms, "term", _BITS)
    chosen = store(rarest(wanted, term_counts(texts, bits)))
    bits.destroy()
    needed = chosen.select(F.explode(F.array("term", "term_2")).alias("term")).filter("term IS NOT NULL").distinct()
    bits = hash_bits(needed, "term", _BITS)
    index = store(positional_index(texts.select(F.col("who").alias("id"), "text"), bits).join(needed, "term", "left_semi"))
    bits.destroy()
    found = candidates(chosen, index).join(wanted.select("size", "first", "second", "items"), ["size", "first", "second"])
    listed = found.groupBy(F.col("id").alias("who")).agg(
        F.collect_list(F.struct("size", "first", "second", "starts", "items")).alias("found")
    )
    more = [f"_{i}" for i in range(len(more))]
    joined = texts.join(listed, "who", "left").select("id", "text", "found", *more)
    kind, *others = [f"{x} {texts.schema[x].dataType.simpleString()}" for x in ("id", *more)]
    schema = ", ".join([kind, "n_words bigint, n_hit bigint, items array<string>", *others])
    return joined.mapInArrow(_verified, schema)
