"""Spelling variants grouped: words that are one edit apart, by a reduced alphabet.

1. Words are counted over all texts, partly in the map tasks.
2. Letters are reduced to `SYMBOLS` symbols. If two words differ in one inserted, deleted or
   replaced code point, their reduced words are equal or differ in one such edit of symbols.
   So for each word the whole one-edit neighbourhood of its reduced word is generated: itself,
   every deletion, every insertion and every replacement of a symbol. The neighbours are made
   as hashes, from prefix sums of one polynomial, so a word of n letters costs n times the
   number of symbols and not n times that; of a long word no neighbour is ever spelt out.
3. Neighbours are joined with the reduced words of the vocabulary. A bit set of fixed size
   keeps most that meet none out of the shuffle. What meets is verified on the words.
4. A word's form is its near word that is most frequent (of equals the first by code points),
   if it is at least `RATIO` times as frequent. Forms grow by that factor at each step, so the
   chains to their roots are short; they are followed by joining them with themselves.

A null text has no words. A word that occurs once is not in the vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyproof.llm.bits import contains, hash_bits
from tallyproof.llm.columns import buffers, code_points, mix, pieces, ragged
from tallyproof.llm.manifest import lowered
from tallyproof.llm.stored import store

SYMBOLS = 8
LETTERS = 7
RATIO = 10
TYPO = 31
_BITS, _PROBES = 27, 2
_PIECE = 1 << 15  # bytes of words whose neighbours are made together
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse
_RUN = r"[A-Za-zÀ-ÿ]{%d,}"


def typed(run: Column, key: Column) -> Column:
    """`run` in lower case, without one of its letters if its hash with the key says so."""
    word = lowered(run)
    hashed = F.crc32(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), word))
    at = F.pmod(hashed, F.length(word)).cast("int")
    shorter = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
    return F.when(hashed % TYPO == 0, shorter).otherwise(word)


def vocabulary(rows: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of the words of `LETTERS` or more that occur twice or more.

    A shorter run can't become such a word, so only runs of that length are looked at."""
    runs = F.explode(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(_RUN % LETTERS), F.lit(0)))
    each = rows.select(F.col(f"`{key}`").alias("key"), runs.alias("run"))
    each = each.select(typed(F.col("run"), F.col("key")).alias("word")).filter(F.length("word") >= LETTERS)
    return each.groupBy("word").agg(F.count("*").alias("n")).filter("n > 1")


def letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all words one after another (all are below U+0800, so of one byte
    or two), and where each word's start (and the end)."""
    data, offsets = buffers(column)
    heads = np.flatnonzero((data & 0xC0) != 0x80)
    follow = np.append(data, np.uint8(0))[heads + 1]
    wide = ((data[heads] & 0x1F).astype(np.int64) << 6) + (follow & 0x3F)
    points = np.where(data[heads] < 0x80, data[heads].astype(np.int64), wide)
    return points, np.concatenate(([0], np.cumsum(code_points(data, offsets))))


def one_edit(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Which words of `a` and `b` differ in exactly one inserted, deleted or replaced code point."""
    points, first, sizes = [], [], []
    for column in (a, b):
        point, start = letters(column)
        points.append(np.append(point, -1))
        first.append(start[:-1])
        sizes.append(np.diff(start))
    longer = (sizes[0] > sizes[1])[:, None]
    first, sizes = np.stack(first, axis=1), np.stack(sizes, axis=1)
    # The longer word of each pair first; of equal lengths the first.
    first[:, 1] += len(points[0])
    points = np.concatenate(points)
    first, sizes = np.where(longer, first, first[:, ::-1]), np.where(longer, sizes, sizes[:, ::-1])
    count = sizes[:, 1]
    row = np.repeat(np.arange(len(count)), count)
    place = ragged(np.zeros(len(count), np.int64), count)
    long, short = (points[first[row, i] + place] for i in (0, 1))
    unlike = np.flatnonzero(long != short)
    # Without its letter at the first difference the longer word must go on as the other does.
    moved = np.flatnonzero(points[first[row, 0] + place + 1] != short)
    differ, last = count.copy(), np.full(len(count), -1)
    np.minimum.at(differ, row[unlike], place[unlike])
    np.maximum.at(last, row[moved], place[moved])
    replaced = (sizes[:, 0] == count) & (np.bincount(row[unlike], minlength=len(count)) == 1)
    return replaced | ((sizes[:, 0] == count + 1) & (differ > last))


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Those of the rows (word, near, n) that are one edit apart."""
    for piece in pieces(batches, "word"):
        yield piece.filter(pa.array(one_edit(piece.column(0), piece.column(1))))


class Reduced:
    """Words over the reduced alphabet, as prefix sums of their symbols."""

    def __init__(self, column: pa.Array):
        points, self.first = letters(column)
        self.symbol = (points % SYMBOLS).astype(np.uint64)
        self.sizes = np.diff(self.first)
        longest = int(self.sizes.max(initial=0)) + 1
        powers = np.full(longest + 1, _BASE, np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers, dtype=np.uint64)
        self.row = np.repeat(np.arange(len(self.sizes)), self.sizes)
        place = np.arange(len(self.row)) - self.first[self.row]
        self.power = powers[place]
        self.end_power = powers[self.sizes]
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((self.symbol + np.uint64(1)) * self.power, dtype=np.uint64)))
        self.total = sums[self.first[1:]] - sums[self.first[:-1]]
        self.before = sums[:-1] - sums[self.first[self.row]]
        self.after = sums[1:] - sums[self.first[self.row]]

    def own(self) -> np.ndarray:
        return mix(self.total + self.sizes.astype(np.uint64))

    def neighbours(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row, hash): the reduced words and all that are one edit of symbols from them,
        each once."""
        size = self.sizes.astype(np.uint64)
        yield np.arange(len(size)), mix(self.total + size)
        total, row = self.total[self.row], self.row
        # Of equal symbols in a row one is deleted, the last.
        last = np.ones(len(row), bool)
        last[:-1] = (self.symbol[:-1] != self.symbol[1:]) | (row[:-1] != row[1:])
        inverse = np.uint64(pow(_BASE, -1, 1 << 64))
        shorter = (self.before + (total - self.after) * inverse)[last]
        yield row[last], mix(shorter + size[row[last]] - np.uint64(1))
        for symbol in range(SYMBOLS):
            symbol = np.uint64(symbol)
            other = self.symbol != symbol
            replaced = (total + (symbol - self.symbol) * self.power)[other]
            yield row[other], mix(replaced + size[row[other]])
            # Before an equal symbol is the same as behind it, so only before others, and at the end.
            longer = (self.before + (symbol + np.uint64(1)) * self.power + (total - self.before) * np.uint64(_BASE))[other]
            yield row[other], mix(longer + size[row[other]] + np.uint64(1))
            ending = self.total + (symbol + np.uint64(1)) * self.end_power
            yield np.arange(len(size)), mix(ending + size + np.uint64(1))


def _reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) with the hash of the reduced word before them."""
    for piece in pieces(batches, "word"):
        own = Reduced(piece.column(0)).own().view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(own), *piece.columns], names=["hash", "word", "n"])


def near_pairs(known: DataFrame) -> DataFrame:
    """(word, near, n): all pairs of words in `known` (word, n) that are one edit apart, in
    both orders, with the frequency of `near`."""
    reduced = store(known.select("word", "n").mapInArrow(_reduced, "hash bigint, word string, n bigint"))
    bits = hash_bits(reduced, "hash", _BITS, _PROBES)

    def generate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "word", _PIECE):
            for row, hashes in Reduced(piece.column(0)).neighbours():
                kept = contains(bits.value, hashes, _PROBES)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[kept].view(np.int64)), piece.column(0).take(pa.array(row[kept]))],
                    names=["hash", "word"],
                )

    around = reduced.select("word").mapInArrow(generate, "hash bigint, word string")
    vocabulary = reduced.withColumnRenamed("word", "near")
    met = around.join(vocabulary, "hash").select("word", "near", "n")
    found = store(met.mapInArrow(_near, "word string, near string, n bigint"))
    bits.destroy()
    return found


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last form reached from each word of `forms` (word, form)."""
    found = store(forms.select("word", F.col("form").alias("root")))
    while True:
        step = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = store(found.join(step, "root", "left"))
        if joined.filter("next IS NOT NULL").isEmpty():
            return found
        found = joined.select("word", F.coalesce("next", "root").alias("root"))


def spelling_variants(rows: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """word, n, n_near, form, form_n and root for each word of the vocabulary."""
    known = store(vocabulary(rows, key, text))
    best = near_pairs(known).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), "near")).alias("best")
    )
    placed = known.join(best, "word", "left").withColumn("most", -F.col("best.less"))
    better = F.col("most") >= RATIO * F.col("n")
    placed = store(placed.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(better, F.col("best.near")).alias("form"), F.when(better, F.col("most")).alias("form_n"),
    ))
    last = roots(placed.filter("form IS NOT NULL").select("word", "form"))
    return placed.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
