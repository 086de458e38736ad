"""N-gram Jaccard join by partitioning the universe of shingles.

Two sets of sizes r and s can have a similarity of `LIKE` percent only if they differ in at
most d = (100 - LIKE) (r + s) / (100 + LIKE) shingles and neither is much larger. So:

1. Sizes are cut into overlapping bands, so that any such pair shares one. For a band
   shingles are hashed into segments. A segment can be indexed as it is, which tolerates no
   difference, or with its one-deletion neighbourhood, which tolerates one. If segments
   tolerate d in total, then by the pigeonhole principle two linked sets agree in one. How
   many segments of which kind a band gets is decided by cost: index entries against
   expected agreements of sets that are much alike but not linked (`plan`).
2. Index entries are sent to ranges of their hashes, packed into blocks: the sorted hashes of
   many sets as differences of four bytes, and beside each which of the block's sets it is of,
   both compressed byte by byte: the first bytes of either are mostly few.
   Hashes are cut to as many bits as keep wrong agreements rare for their number. A range
   finds the entries that unequal sets have in common. Their sets, and those with too many
   empty segments to be sure, are suspects; the others are alone.
3. Among suspects segments are refined to single shingles, those no other suspect has first,
   then by how many have them, rare ones first. Two linked sets have a first common shingle,
   and the numbers of shingles before it in both add up to d at most. So copies with edits of
   their own meet only if their edits leave room, and a shingle that very many texts have is
   the first in common only where they share nothing rarer. Besides, each set has a parity
   map: every shingle turns one of its bits over, so two sets differ in at least as many
   shingles as their maps differ in bits. That is part of the join, and drops most pairs that
   are not linked.
4. Per shingle the set with the fewest shingles before it leads; all others that may be
   linked with it are verified on the whole sets. Components of these links leave few pairs
   that share a shingle and room but no component: those are verified as well. Pairs within
   a component need no check, so a group of copies costs about a check for each copy.

Equal sets are one from the start. What cut hashes or a bit set of fixed size let through
wrongly is verified like the rest, and the order in 3 is the same for all sets, whatever the
bits say; no step drops a link.

A row without words, or with a null text, has no set and is linked with nothing. Rows with
equal ids are one document with several sets. A row with a null id has no component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyproof.llm.bits import contains, hash_bits, may_be_in, wrongly
from tallyproof.llm.columns import mix, pieces, ragged, tally, window_starts, windows, words
from tallyproof.llm.components import components
from tallyproof.llm.stored import release, store

_GROWTH = 1.35
_ALIKE = 0.75  # share of shingles that sets have in common which are alike but not linked
_TOGETHER = 1 << 19  # index entries packed together
_RANGES = 64  # ranges of index entries at least; each is read by one task,
_RANGE = 1 << 26  # has about so many entries at most,
_SLICE = 1 << 22  # and is held in slices of about so many
_SPARE_BITS = 15  # a hash agrees wrongly once in 2 ** 15
_ID_BITS, _TOKEN_BITS, _PROBES = 26, 26, 2
_IN_VAIN = 1 / 16  # texts that may be taken for suspects wrongly
FREQUENT = 1 << 18  # shingles whose frequencies are broadcast, 16 bytes each
_MAP = [f"m{i}" for i in range(8)]  # 64 bits each


@dataclass(frozen=True)
class Likeness:
    """Words per shingle, and percent of the union that linked sets have in common."""

    size: int = 4
    percent: int = 85

    def difference(self, total):
        """Most shingles by which two linked sets of `total` shingles together differ."""
        return (100 - self.percent) * total // (100 + self.percent)

    def prefix(self, size):
        """Most shingles of a set of `size` that a linked set lacks."""
        return (100 - self.percent) * size // 100


@dataclass(frozen=True)
class Band:
    low: int
    high: int  # sizes up to here take part
    segments: int
    deletions: int  # this many of the segments have one-deletion neighbourhoods
    needed: int  # what the segments of a set must tolerate, and one more


def plan(like: Likeness, largest: int) -> list[Band]:
    bands, low = [], 1
    while low <= largest:
        following = max(low + 1, int(low * _GROWTH))
        small = following - 1
        large = 100 * small // like.percent
        needed = like.difference(small + large) + 1

        def cost(segments: int) -> float:
            size, deletions = low / segments, needed - segments
            same = _ALIKE**size
            off = size * (1 - _ALIKE) * _ALIKE ** max(size - 1, 0)
            entries = segments + deletions * size
            return entries + 20 * (segments * same + deletions * off)

        best = min(range(math.ceil(needed / 2), needed + 1), key=cost)
        spare = 0 if best < 12 else 1 + math.ceil(0.03 * best)
        bands.append(Band(low, large, best + spare, needed - best, needed))
        low = following
    return bands


def sets_of(column: pa.Array, like: Likeness) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all texts, sorted by hash in each, and where each text's start
    (and the end)."""
    w = words(column, lower=True)
    hashes, n = w.hashes(), np.diff(w.first)
    own = window_starts(w.first, like.size)
    values = [windows(hashes, like.size)[own] if len(own) else np.zeros(0, np.uint64)]
    rows = [np.searchsorted(w.first, own, "right") - 1]
    for size in range(1, like.size):
        row = np.flatnonzero(n == size)
        if len(row):
            values.append(mix(windows(hashes, size)[w.first[row]] + np.uint64(size)))
            rows.append(row)
    value, row = np.concatenate(values), np.concatenate(rows)
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    return value[fresh], np.searchsorted(row[fresh], np.arange(len(n) + 1))


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    return total[first[1:]] - total[first[:-1]]


def _marks(values: np.ndarray, first: np.ndarray, which: int = 1) -> np.ndarray:
    """A hash of each set."""
    return mix(_sums(mix(values ^ np.uint64(which)), first))


def _digests(batches: Iterator[pa.RecordBatch], like: Likeness) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches):
        values, first = sets_of(piece.column(1), like)
        yield pa.RecordBatch.from_arrays(
            [piece.column(0), pa.array(np.diff(first)),
             pa.array(_marks(values, first).view(np.int64)), pa.array(_marks(values, first, 2).view(np.int64))],
            names=["id", "n", "one", "two"],
        )


def entries(values: np.ndarray, first: np.ndarray, like: Likeness) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index entries of sets: the set of each, its hash; and whether a set has so many
    empty segments that a link might not show."""
    sizes = np.diff(first)
    unsure = np.zeros(len(sizes), bool)
    rows, keys = [], []
    for number, band in enumerate(plan(like, int(sizes.max(initial=0)))):
        own = np.flatnonzero((sizes >= band.low) & (sizes <= band.high))
        if not len(own):
            continue
        n = band.segments
        at = ragged(first[own], sizes[own])
        value = values[at]
        owner = np.repeat(np.arange(len(own)), sizes[own])
        segment = (value >> np.uint64(24)) % np.uint64(n)
        slot = owner * n + segment.astype(np.int64)
        spread = mix(value + np.uint64(number))
        total = np.zeros(len(own) * n, np.uint64)
        np.add.at(total, slot, spread)
        count = np.bincount(slot, minlength=len(own) * n)
        neighbours = np.arange(n) < band.deletions
        tolerated = np.minimum(count.reshape(-1, n), 1 + neighbours)
        unsure[own] |= tolerated.sum(axis=1) < band.needed
        place = np.tile(np.arange(n, dtype=np.uint64), len(own)) + np.uint64(number << 32)
        filled = np.flatnonzero(count)
        rows.append(own[filled // n])
        keys.append(mix(total[filled] ^ mix(place[filled])))
        if band.deletions:
            less = np.flatnonzero(neighbours[segment.astype(np.int64)] & (count[slot] > 1))
            rows.append(own[owner[less]])
            keys.append(mix((total[slot[less]] - spread[less]) ^ mix(place[slot[less]])))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), unsure
    return np.concatenate(rows), np.concatenate(keys), unsure


_BLOCK = "range int, slice int, n int, first bigint, steps binary, owners binary, sets binary"


def _blocks(batches, like: Likeness, bits: int, ranges: int, slices: int) -> Iterator[pa.RecordBatch]:
    """Index entries of (text) in blocks, one for each slice of a range and about `_TOGETHER`
    entries.

    A block has `n` sorted hashes of `bits` bits (the first, and steps), for each the place
    of its set among the block's `sets`, and these as hashes. Blocks without entries name
    sets that are suspects anyhow."""
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def packed() -> pa.RecordBatch:
        keys, marks = (np.concatenate(x) for x in zip(*waiting, strict=True))
        sets, owner = np.unique(marks, return_inverse=True)
        order = np.lexsort((owner, keys))
        keys, owner = keys[order], owner[order]
        fresh = np.ones(len(keys), bool)
        fresh[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
        keys, owner = keys[fresh], owner[fresh]
        at = (keys >> np.uint64(bits - 32)) * np.uint64(ranges * slices) >> np.uint64(32)
        edges = np.searchsorted(at, np.arange(ranges * slices + 1))
        rows = []
        for i in np.flatnonzero(np.diff(edges)).tolist():
            own = keys[edges[i] : edges[i + 1]]
            used, place = np.unique(owner[edges[i] : edges[i + 1]], return_inverse=True)
            place = place.astype("<u2" if len(used) <= 1 << 16 else "<u4")
            rows.append((
                i // slices, i % slices, len(own), int(own[0]), _pressed(_steps(own), len(own)),
                _pressed(place.tobytes(), len(own)), sets[used].astype("<u8").tobytes(),
            ))
        return _block_rows(rows)

    for number, piece in enumerate(pieces(batches)):
        values, first = sets_of(piece.column(0), like)
        row, keys, unsure = entries(values, first, like)
        marks = _marks(values, first)
        unsure &= np.diff(first) > 0
        if unsure.any():
            yield _block_rows([(number % ranges, 0, 0, 0, b"", b"", marks[unsure].astype("<u8").tobytes())])
        if len(keys):
            waiting.append((keys >> np.uint64(64 - bits), marks[row]))
            size += len(keys)
        if size >= _TOGETHER:
            yield packed()
            waiting.clear()
            size = 0
    if waiting:
        yield packed()


def _steps(values: np.ndarray) -> bytes:
    """Steps between sorted values: their low four bytes, and where one needs it (a fifth, or
    all eight) the next byte of each, or the whole steps instead."""
    steps = np.diff(values, prepend=values[:1])
    low = steps.astype("<u4").tobytes()
    most = int(steps.max())
    if most < 1 << 32:
        return low
    return low + (steps >> np.uint64(32)).astype(np.uint8).tobytes() if most < 1 << 40 else steps.astype("<u8").tobytes()


def _values(first: int, n: int, steps: bytes) -> np.ndarray:
    if len(steps) == 8 * n:
        found = np.frombuffer(steps, "<u8")
    else:
        found = np.frombuffer(steps, "<u4", n).astype(np.uint64)
        if len(steps) == 5 * n:
            found |= np.frombuffer(steps, np.uint8, n, 4 * n).astype(np.uint64) << np.uint64(32)
    return np.cumsum(found, dtype=np.uint64) + np.uint64(first)


def _pressed(values: bytes, n: int) -> bytes:
    """`n` values of `_steps` or as they are, compressed: all their lowest bytes first, then the
    next ones, and so on. In front is how many bytes a value has."""
    width = len(values) // n
    low = width if width != 5 else 4  # a fifth byte is apart already
    planes = np.frombuffer(values, np.uint8, low * n).reshape(n, low).T.tobytes() + values[low * n :]
    return bytes([width]) + pa.compress(planes, codec="zstd", asbytes=True)


def _unpressed(pressed: bytes, n: int) -> bytes:
    width = pressed[0]
    low = width if width != 5 else 4
    planes = pa.decompress(pressed[1:], width * n, codec="zstd", asbytes=True)
    return np.frombuffer(planes, np.uint8, low * n).reshape(low, n).T.tobytes() + planes[low * n :]


def _block_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    columns = [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _BLOCK.split(", ")])


def _in_common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks come ordered by range and slice. Yields the sets (mark) with an entry that
    another has, for each range (or many of them) once."""
    waiting: list[tuple] = []
    found: list[np.ndarray] = []

    def sets_found() -> pa.RecordBatch:
        marks = np.unique(np.concatenate(found))
        found.clear()
        return pa.RecordBatch.from_arrays([pa.array(marks.view(np.int64))], names=["mark"])

    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if waiting and waiting[0][:2] != row[:2]:
                found.append(_agreeing(waiting))
                if waiting[0][0] != row[0] or sum(map(len, found)) > _SLICE:
                    yield sets_found()
                waiting.clear()
            waiting.append(row)
    if waiting:
        found.append(_agreeing(waiting))
        yield sets_found()


def _agreeing(blocks: list[tuple]) -> np.ndarray:
    """The sets with an entry that an unequal set has, in the blocks of one slice."""
    keys, marks, suspects = [], [], []
    for _, _, n, first, steps, owners, sets in blocks:
        sets = np.frombuffer(sets, "<u8")
        if not n:
            suspects.append(sets)
            continue
        steps, owners = _unpressed(steps, n), _unpressed(owners, n)
        keys.append(_values(first, n, steps))
        marks.append(sets[np.frombuffer(owners, f"<u{len(owners) // n}")])
    if keys:
        key, mark = np.concatenate(keys), np.concatenate(marks)
        order = np.argsort(key, kind="stable")
        key, mark = key[order], mark[order]
        fresh = np.ones(len(key), bool)
        fresh[1:] = key[1:] != key[:-1]
        group = np.cumsum(fresh) - 1
        unlike = np.zeros(int(group[-1]) + 1, bool)
        unlike[group[mark != mark[np.flatnonzero(fresh)][group]]] = True
        suspects.append(mark[unlike[group]])
    return np.unique(np.concatenate(suspects))


def suspected(texts: DataFrame, like: Likeness, shingles: int) -> DataFrame:
    """(mark): the hashes of sets that may be linked with an unequal one. `shingles` is the
    number of shingles of all sets together, which says how finely entries are dealt."""
    many = 2 * shingles + 1
    bits = min(64, max(40, many.bit_length() + _SPARE_BITS))
    # About an entry for each: 1.12 at sf0.1 for 80 percent of five words, 0.47 for 85 of four.
    # Each slice of a block names its sets again, so there are no more slices than needed.
    ranges = _RANGES + shingles // _RANGE
    slices = 1 + shingles // ranges // _SLICE
    blocks = texts.select("text").mapInArrow(lambda b: _blocks(b, like, bits, ranges, slices), _BLOCK)
    dealt = blocks.repartition("range").sortWithinPartitions("range", "slice")
    return dealt.mapInArrow(_in_common, "mark bigint").distinct()


def _thinned(texts: DataFrame, ids: DataFrame) -> tuple[DataFrame, Broadcast]:
    """Those of `texts` (id, text) whose id may be in `ids` (id), chosen where they lie by a bit
    set of fixed size: a text that is not needed is not moved. And the set."""
    bits = hash_bits(ids.select(F.xxhash64("id").alias("hash")), "hash", _ID_BITS, _PROBES)
    return texts.filter(may_be_in(bits, "id", _PROBES)), bits


def texts_of(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of `texts` (id, text) whose id is in `ids` (id), and few others, which take part
    in vain. Only if the set is so full that these are not few is there a join."""
    found, bits = _thinned(texts.filter("id IS NOT NULL"), ids)
    if wrongly(bits.value, _PROBES) > _IN_VAIN:
        found = found.join(ids, "id", "left_semi")
    found = store(found)
    bits.destroy()
    return found


def _shingles(batches, like: Likeness) -> Iterator[pa.RecordBatch]:
    return tally((sets_of(piece.column(1), like)[0] for piece in pieces(batches)), "key")


def _weights(values: np.ndarray, shared: Broadcast, often: Broadcast) -> np.ndarray:
    """Unshared shingles weigh nothing, frequent ones what they are frequent, others one."""
    weight = contains(shared.value, values, _PROBES).astype(np.int64)
    known, counts = often.value
    if not len(known):
        return weight
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return np.where(known[at] == values, counts[at], weight)


def _prefix_of(column: pa.Array, like: Likeness, shared: Broadcast, often: Broadcast):
    """Of the shared shingles that may be the first in common: their sets' rows, hashes and
    numbers of shingles before them; and the size of each set."""
    values, first = sets_of(column, like)
    sizes = np.diff(first)
    row = np.repeat(np.arange(len(sizes)), sizes)
    weight = _weights(values, shared, often)
    order = np.lexsort((values, weight, row))
    values, weight = values[order], weight[order]
    before = np.arange(len(row)) - first[row]
    kept = np.flatnonzero((weight > 0) & (before <= like.prefix(sizes)[row]))
    return row[kept], values[kept], before[kept], sizes


def _prefix_keys(batches, like: Likeness, shared: Broadcast, often: Broadcast) -> Iterator[pa.RecordBatch]:
    return tally((_prefix_of(piece.column(1), like, shared, often)[1] for piece in pieces(batches)), "key")


def _prefixes(batches, like: Likeness, shared: Broadcast, often: Broadcast, met: Broadcast) -> Iterator[pa.RecordBatch]:
    """(key, id, size, before) of these shingles, if another set may have them there as well."""
    for piece in pieces(batches):
        row, values, before, sizes = _prefix_of(piece.column(1), like, shared, often)
        kept = contains(met.value, values, _PROBES)
        row, values, before = row[kept], values[kept], before[kept]
        yield pa.RecordBatch.from_arrays(
            [pa.array(values.view(np.int64)), piece.column(0).take(pa.array(row)),
             pa.array(sizes[row].astype(np.int32)), pa.array(before.astype(np.int32))],
            names=["key", "id", "size", "before"],
        )


def _maps(batches, like: Likeness) -> Iterator[pa.RecordBatch]:
    """(id, size, parity map) of each set."""
    bits = 64 * len(_MAP)
    for piece in pieces(batches):
        values, first = sets_of(piece.column(1), like)
        sizes = np.diff(first)
        row = np.repeat(np.arange(len(sizes)), sizes)
        slot = row * bits + ((values >> np.uint64(32)) % np.uint64(bits)).astype(np.int64)
        odd = (np.bincount(slot, minlength=len(sizes) * bits) & 1).astype(np.uint8)
        maps = np.packbits(odd.reshape(-1, bits), axis=1).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [piece.column(0), pa.array(sizes.astype(np.int32)), *(pa.array(maps[:, i]) for i in range(len(_MAP)))],
            names=["id", "size", *_MAP],
        )


def _frequent(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent of the shingles in `counts` (key, n), sorted, and how frequent they
    are: all from the least power of two (16 at least) that `FREQUENT` of them reach at most."""
    sizes = counts.filter("n >= 16").groupBy(F.floor(F.log2("n")).cast("int").alias("size")).count()
    reached, least = 0, None
    for size, count in sorted(map(tuple, sizes.collect()), reverse=True):
        reached += count
        if reached > FREQUENT:
            break
        least = 1 << size
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    rows = counts.filter(F.col("n") >= least).select("key", "n").collect()
    keys = np.array([x.key for x in rows], np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], np.array([x.n for x in rows], np.int64)[order]


def _may_link(like: Likeness, a: str, b: str) -> str:
    """Whether two prefix rows leave room for a link."""
    return (
        f"100 * least({a}.size, {b}.size) >= {like.percent} * greatest({a}.size, {b}.size) AND "
        f"{100 + like.percent} * ({a}.before + {b}.before) <= {100 - like.percent} * ({a}.size + {b}.size)"
    )


def _maps_close(like: Likeness, a: str, b: str) -> str:
    """Whether the parity maps of two rows leave room for a link."""
    apart = " + ".join(f"bit_count({a}.{m} ^ {b}.{m})" for m in _MAP)
    return f"{100 + like.percent} * ({apart}) <= {100 - like.percent} * ({a}.size + {b}.size)"


def _close(pairs: DataFrame, maps: DataFrame, like: Likeness) -> DataFrame:
    """Those of `pairs` (a, b) whose parity maps leave room for a link. An id with several
    sets stays with any of them."""
    met = pairs.alias("p").join(maps.alias("x"), F.expr("p.a = x.id")).join(maps.alias("y"), F.expr("p.b = y.id"))
    return met.filter(_maps_close(like, "x", "y")).select("p.a", "p.b").distinct()


def _alike(batches, like: Likeness) -> Iterator[pa.RecordBatch]:
    """(a, b, text_a, text_b) to (a, b) of those that are linked."""
    for piece in pieces(batches, "text_a"):
        sides = [sets_of(piece.column(i), like) for i in (2, 3)]
        sizes = [np.diff(first) for _, first in sides]
        rows = np.concatenate([np.repeat(np.arange(len(piece)), n) for n in sizes])
        values = np.concatenate([values for values, _ in sides])
        order = np.lexsort((values, rows))
        values, rows = values[order], rows[order]
        same = (values[1:] == values[:-1]) & (rows[1:] == rows[:-1])
        common = np.bincount(rows[1:][same], minlength=len(piece))
        union = sizes[0] + sizes[1] - common
        linked = (100 * common >= like.percent * union) & (common > 0)
        yield piece.select(["a", "b"]).filter(pa.array(linked))


def _verified(pairs: DataFrame, texts: DataFrame, like: Likeness) -> DataFrame:
    """Those of the stored `pairs` (a, b) that are linked, by their whole sets; stored as well.
    Only texts of pairs are shuffled."""
    kind = dict(pairs.dtypes)["a"]
    texts, bits = _thinned(texts, pairs.select(F.explode(F.array("a", "b")).alias("id")))
    one = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b")
    found = store(both.mapInArrow(lambda batches: _alike(batches, like), f"a {kind}, b {kind}"))
    bits.destroy()
    return found


def links(texts: DataFrame, like: Likeness) -> DataFrame:
    """(a, b): links between suspects (id, text) that connect all that are connected."""
    kind = dict(texts.dtypes)["id"]
    counts = texts.mapInArrow(lambda b: _shingles(b, like), "key bigint, n bigint").groupBy("key").agg(
        F.sum("n").alias("n")
    )
    counts = store(counts.filter("n > 1"))
    shared = hash_bits(counts, "key", _TOKEN_BITS, _PROBES)
    often = texts.sparkSession.sparkContext.broadcast(_frequent(counts))
    release(counts)
    met = texts.mapInArrow(lambda b: _prefix_keys(b, like, shared, often), "key bigint, n bigint")
    met = hash_bits(met.groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1"), "key", _TOKEN_BITS, _PROBES)
    prefix = store(texts.mapInArrow(
        lambda b: _prefixes(b, like, shared, often, met), f"key bigint, id {kind}, size int, before int"
    ))
    for sent in (shared, often, met):
        sent.destroy()
    maps = store(texts.mapInArrow(
        lambda b: _maps(b, like), f"id {kind}, size int, " + ", ".join(f"{m} bigint" for m in _MAP)
    ))
    leader = prefix.groupBy("key").agg(F.min(F.struct("before", "id", "size")).alias("l")).select("key", "l.*")
    led = prefix.alias("p").join(leader.alias("l"), "key").filter("p.id <> l.id")
    stars = led.filter(_may_link(like, "p", "l")).select(F.col("p.id").alias("a"), F.col("l.id").alias("b"))
    stars = store(_close(_ordered(stars), maps, like))
    found = _verified(stars, texts, like)
    known = components(found)
    placed = prefix.join(known, "id", "left").withColumn("component", F.coalesce("component", "id"))
    heads = leader.select("key", "id").join(known, "id", "left").select(
        "key", F.coalesce("component", "id").alias("head")
    )
    placed = store(placed)
    # A pair without a common component has a side outside the leader's. Here many rows may
    # meet at a key, so the parity maps are in the join.
    strays = store(placed.join(heads, "key").filter("component <> head").drop("head").join(maps.drop("size"), "id"))
    around = placed.join(strays.select("key").distinct(), "key", "left_semi").join(maps.drop("size"), "id")
    meets = F.expr(f"p.component <> s.component AND {_may_link(like, 'p', 's')} AND {_maps_close(like, 'p', 's')}")
    rest = strays.alias("s").join(around.alias("p"), (F.col("s.key") == F.col("p.key")) & meets).select(
        F.col("s.id").alias("a"), F.col("p.id").alias("b")
    )
    rest = store(_ordered(rest).join(stars, ["a", "b"], "left_anti"))
    release(strays)
    release(prefix, placed, stars, maps)
    more = _verified(rest, texts, like)
    release(rest)
    return found.unionByName(more)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def jaccard_components(
    rows: DataFrame, key: str = "doc_id", text: str = "text", like: Likeness | None = None
) -> DataFrame:
    """key, n_shingles and component_id (the lowest key reachable by links) for each row."""
    like = like or Likeness()
    texts = rows.select(F.col(f"`{key}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    kind = dict(texts.dtypes)["id"]
    digests = store(texts.mapInArrow(
        lambda b: _digests(b, like), f"id {kind}, n bigint, one bigint, two bigint"
    ))
    one_each = store(
        digests.filter("n > 0 AND id IS NOT NULL").groupBy("n", "one", "two").agg(F.min("id").alias("first"))
    )
    shingles = digests.agg(F.sum("n")).first()[0] or 0
    marks = store(suspected(texts, like, shingles))
    firsts = store(
        one_each.join(marks.withColumnRenamed("mark", "one"), "one", "left_semi").select(F.col("first").alias("id")).distinct()
    )
    release(marks)
    suspects = texts_of(texts, firsts)
    found = links(suspects, like)
    release(firsts, suspects)
    # Rows of one id hang together, whatever their sets; so do rows of one set.
    same = digests.filter("n > 0 AND id IS NOT NULL").join(one_each, ["n", "one", "two"]).select(
        F.col("id").alias("a"), F.col("first").alias("b")
    )
    known = components(found.unionByName(same))
    return (
        digests.join(known, "id", "left")
        .select(
            F.col("id").alias(key), F.col("n").alias("n_shingles"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
