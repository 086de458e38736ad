"""SimHash near-duplicates, found with BK-trees.

A text's shingles are all runs of `SHINGLE` lower-cased words (A-Z only), repeats included,
joined by single spaces; a text of fewer words has one of all its words. A bit of the
fingerprint is 1 if more than half of the shingles' XXH64 (seed 42) have it. Fingerprints
link if they differ in `RADIUS` bits at most.

1. Equal fingerprints are one point from here on. Points are dealt into shards by parts of
   their bits: of `blocks` blocks of bits two linked points differ in `RADIUS` at most, so
   they agree in the others, and there is a shard for each choice of those. How many blocks
   there are follows from the number of points (`plan`).
2. In a shard points make a BK-tree: a node's children are keyed by their distance to it, and
   a search for a point at distance d from the node follows the edges d - `RADIUS` to
   d + `RADIUS` only. Trees are built and searched one height at a time for all shards of a
   batch. A subtree whose points are known to be connected to the one in search is skipped,
   and of the links between two connected parts one is kept: so a dense group of points
   costs about a search a point, and never all its pairs.
3. A shard of more than `TREE_POINTS` points is cut into several trees. Points of one tree meet
   as above; after that, trees of a shard are sent to each other whole (16 bytes a point),
   except for pairs of trees that are one component already, and are searched for its points.

A text without words, or null, has the fingerprint zero, which links like any other. Rows
with equal ids are a document with several fingerprints, each row linked by its own. A row
with a null id takes part; its component is the lowest id reachable, null if there is none.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyproof.llm.columns import pieces, ragged, words
from tallyproof.llm.components import components
from tallyproof.llm.stored import store

SHINGLE = 4
SEED = 42
RADIUS = 4
TREE_POINTS = 4096
HOT_ROWS = 200_000  # hot shards that are broadcast, 24 bytes each
_TOGETHER = 1 << 16  # points whose trees are built together
_FRONTIER = 1 << 22  # pairs of point and node compared at once, about

_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(x)
    for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)
_SHORT = 96  # longer spans are hashed one by one


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def _round(state: np.ndarray, value: np.ndarray) -> np.ndarray:
    return _turn(state + value * _P2, 31) * _P1


def span_xxh64(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of each byte span, all spans at once."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    eight = np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,))
    four = np.ndarray((len(data) + 1,), "<u4", padded.data, strides=(1,))
    sizes = ends - starts
    lanes = [np.uint64((seed + x) % (1 << 64)) for x in (int(_P1) + int(_P2), int(_P2), 0, -int(_P1))]
    state = np.full(len(starts), np.uint64((seed + int(_P5)) % (1 << 64)))
    at = starts.copy()
    striped = np.flatnonzero((sizes >= 32) & (sizes <= _SHORT))
    if len(striped):
        v = [np.full(len(striped), x) for x in lanes]
        stripes = sizes[striped] // 32
        for i in range(int(stripes.max())):
            own = np.flatnonzero(stripes > i)
            place = at[striped[own]]
            for j in range(4):
                v[j][own] = _round(v[j][own], eight[place + 8 * j])
            at[striped[own]] += 32
        total = _turn(v[0], 1) + _turn(v[1], 7) + _turn(v[2], 12) + _turn(v[3], 18)
        for x in v:
            total = (total ^ _round(np.zeros_like(x), x)) * _P1 + _P4
        state[striped] = total
    state += sizes.astype(np.uint64)
    short = sizes <= _SHORT
    left = np.where(short, ends - at, 0)
    while len(own := np.flatnonzero(left >= 8)):
        state[own] = _turn(state[own] ^ _round(np.zeros(len(own), np.uint64), eight[at[own]]), 27) * _P1 + _P4
        at[own] += 8
        left[own] -= 8
    if len(own := np.flatnonzero(left >= 4)):
        state[own] = _turn(state[own] ^ (four[at[own]].astype(np.uint64) * _P1), 23) * _P2 + _P3
        at[own] += 4
        left[own] -= 4
    while len(own := np.flatnonzero(left > 0)):
        state[own] = _turn(state[own] ^ (data[at[own]].astype(np.uint64) * _P5), 11) * _P1
        at[own] += 1
        left[own] -= 1
    state = (state ^ (state >> np.uint64(33))) * _P2
    state = (state ^ (state >> np.uint64(29))) * _P3
    state ^= state >> np.uint64(32)
    for i in np.flatnonzero(~short).tolist():
        state[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes(), seed)
    return state


def simhashes(column: pa.Array) -> np.ndarray:
    """Fingerprints of texts."""
    w = words(column, lower=True)
    n = np.diff(w.first)
    found = np.zeros(len(n), np.uint64)
    filled = np.flatnonzero(n)
    if not len(filled):
        return found
    # The words with one blank behind each, so shingles are spans of bytes.
    sizes = w.ends - w.starts + 1
    joined = np.append(w.data, np.uint8(0x20))[ragged(w.starts, sizes)]
    stops = np.cumsum(sizes)
    joined[stops - 1] = 0x20
    stops -= 1
    begins = stops + 1 - sizes
    per = np.maximum(n[filled] - SHINGLE + 1, 1)
    first = ragged(w.first[:-1][filled], per)
    last = first + np.repeat(np.minimum(n[filled], SHINGLE), per) - 1
    hashes = span_xxh64(joined, begins[first], stops[last])
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = np.add.reduceat(bits, np.cumsum(per) - per, axis=0, dtype=np.int32)
    found[filled] = np.packbits(2 * ones > per[:, None], axis=1, bitorder="little").view("<u8").ravel()
    return found


def fingerprints(rows: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, point): the key and the fingerprint (64 bits as a bigint) of each row."""
    texts = rows.select(F.col(f"`{key}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            found = simhashes(piece.column(1)).view(np.int64)
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(found)], names=["id", "point"])

    return texts.mapInArrow(run, f"id {dict(texts.dtypes)['id']}, point bigint")


def plan(points: int, radius: int = RADIUS) -> list[int]:
    """The bits that decide a point's shard, for each shard it is in.

    More blocks make more shards, which cost a shuffled row each, of fewer points, which
    cost comparisons; the weight of a comparison is a rough measure."""

    def cost(blocks: int) -> float:
        return comb(blocks, radius) * (1 + 0.03 * points / 2 ** (64 * (blocks - radius) / blocks))

    blocks = min(range(radius + 1, radius + 5), key=cost)
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [(1 << b) - (1 << a) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    chosen = [sum(x) for x in combinations(masks, blocks - radius)]
    return [x - (1 << 64) if x >= 1 << 63 else x for x in chosen]


class Forest:
    """BK-trees over `points`, one for each of the `groups` these come ordered by. Points of
    a group differ. `known` are labels of parts that are connected already."""

    def __init__(self, groups: np.ndarray, points: np.ndarray, known: np.ndarray | None = None):
        count = len(points)
        self.points = points
        fresh = np.ones(count, bool)
        fresh[1:] = groups[1:] != groups[:-1]
        self.root = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
        self.size = np.bincount(self.root, minlength=count)[self.root]
        self.parent, self.gap = np.full(count, -1), np.zeros(count, np.int64)
        self.heights: list[np.ndarray] = []
        rest = np.flatnonzero(~fresh)
        at = self.root[rest]
        while len(rest):
            gap = self.distance(points[rest], at)
            _, first, place = np.unique(at * 65 + gap, return_index=True, return_inverse=True)
            child = rest[first]
            self.parent[child], self.gap[child] = at[first], gap[first]
            self.heights.append(child)
            later = np.ones(len(rest), bool)
            later[first] = False
            rest, at = rest[later], child[place[later]]
        inner = np.flatnonzero(self.parent >= 0)
        edge = self.parent[inner] * 65 + self.gap[inner]
        order = np.argsort(edge, kind="stable")
        self.edges, self.below = edge[order], inner[order]
        self._label(known)

    def distance(self, values: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        return np.bitwise_count(values ^ self.points[nodes]).astype(np.int64)

    def _label(self, known: np.ndarray | None) -> None:
        """Connected parts as far as edges of the trees show them, if none are known."""
        up = np.where((self.gap > 0) & (self.gap <= RADIUS), self.parent, np.arange(len(self.points)))
        while not np.array_equal(up, up[up]):
            up = up[up]
        self.label = up if known is None else known

    def _subtrees(self, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lowest and the highest part in the subtree of each node."""
        low, high = part.copy(), part.copy()
        for nodes in reversed(self.heights):
            np.minimum.at(low, self.parent[nodes], low[nodes])
            np.maximum.at(high, self.parent[nodes], high[nodes])
        return low, high

    def tree_links(self) -> np.ndarray:
        """The nodes that are linked with their parent."""
        return np.flatnonzero((self.gap > 0) & (self.gap <= RADIUS))

    def search(self, values: np.ndarray, labels: np.ndarray, roots: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(which value, node): links of values with points in the trees of `roots`, which come
        in order. They connect all labels that any such link connects.

        Some values of each tree are searched first; what they connect is one part for the
        next, which skip subtrees that are all of their part."""
        _, codes = np.unique(np.concatenate((self.label, labels)), return_inverse=True)
        node_code, code = codes[: len(self.points)], codes[len(self.points) :]
        part = np.arange(len(codes))
        order = np.argsort(np.arange(len(values)) - np.searchsorted(roots, roots), kind="stable")
        budget = np.cumsum(self.size[roots[order]])
        start, limit = 0, max(1, _FRONTIER >> 6)
        while start < len(values):
            base = budget[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(budget, base + limit, "right")))
            limit = min(2 * limit, _FRONTIER)
            mine, yours = part[code], part[node_code]
            least, most = self._subtrees(yours)
            which = order[start:stop]
            node = roots[which]
            found = []
            while len(which):
                own = mine[which]
                open_ = (least[node] != own) | (most[node] != own)
                which, node, own = which[open_], node[open_], own[open_]
                gap = self.distance(values[which], node)
                hit = (gap <= RADIUS) & (yours[node] != own)
                found.append((which[hit], node[hit]))
                low = np.searchsorted(self.edges, node * 65 + np.maximum(gap - RADIUS, 1))
                high = np.searchsorted(self.edges, node * 65 + gap + RADIUS, "right")
                which, node = np.repeat(which, high - low), self.below[ragged(low, high - low)]
            which, node = (np.concatenate(x) for x in zip(*found, strict=True))
            _, first = np.unique(mine[which] * len(part) + yours[node], return_index=True)
            which, node = which[first], node[first]
            yield which, node
            part = _joined(part, mine[which], yours[node])
            start = stop


def _joined(part: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Parts after those of each pair are one, named by their lowest."""
    while True:
        one, two = part[a], part[b]
        if np.array_equal(one, two):
            return part
        np.minimum.at(part, np.maximum(one, two), np.minimum(one, two))
        while not np.array_equal(part, part[part]):
            part = part[part]


def _links(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])


def _in_trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (choice, value, tree, point) come ordered. Yields links (a, b) in each tree."""

    def linked(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = [rows.column(i).to_numpy() for i in range(3)]
        points = rows.column(3).to_numpy().view(np.uint64)
        fresh = np.zeros(len(points), bool)
        for x in keys:
            fresh[1:] |= x[1:] != x[:-1]
        forest = Forest(np.cumsum(fresh), points)
        nodes = forest.tree_links()
        yield _links(points[nodes], points[forest.parent[nodes]])
        for which, node in forest.search(points, forest.label, forest.root):
            yield _links(points[which], points[node])

    waiting: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not len(batch):
            continue
        waiting.append(batch)
        count += len(batch)
        if count < _TOGETHER:
            continue
        whole = pa.Table.from_batches(waiting).combine_chunks()
        last = np.ones(len(whole), bool)
        for i in range(3):
            column = whole.column(i).to_numpy()
            last &= column == column[-1]
        split = int(np.argmax(last))
        if split:
            yield from linked(whole.slice(0, split))
        waiting = whole.slice(split).to_batches()
        count = len(whole) - split
    if waiting:
        yield from linked(pa.Table.from_batches(waiting).combine_chunks())


def _between_trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The points of two trees a row, with their components. Yields links between the trees."""
    for batch in batches:
        for one, two in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
            a, b = (np.array([[x["point"], x["component"]] for x in side], np.int64) for side in (one, two))
            points, values = a[:, 0].view(np.uint64), b[:, 0].view(np.uint64)
            forest = Forest(np.zeros(len(points)), points, a[:, 1])
            for which, node in forest.search(values, b[:, 1], np.zeros(len(values), np.int64)):
                yield _links(values[which], points[node])


def links(points: DataFrame, count: int) -> DataFrame:
    """(a, b): links between distinct points (point) that connect all that are connected."""
    masks = plan(count)
    shards = F.explode(F.array(*[
        F.struct(F.lit(i).alias("choice"), F.col("point").bitwiseAND(F.lit(mask)).alias("value"))
        for i, mask in enumerate(masks)
    ]))
    dealt = points.select("point", shards.alias("shard")).select("shard.*", "point")
    hot = store(dealt.groupBy("choice", "value").count().filter(F.col("count") > TREE_POINTS).select(
        "choice", "value", F.ceil(F.col("count") / TREE_POINTS).alias("trees")
    ))
    few = hot.count()
    joined = dealt.join(F.broadcast(hot) if few <= HOT_ROWS else hot, ["choice", "value"], "left")
    tree = F.pmod(F.xxhash64("point", "choice"), F.coalesce("trees", F.lit(1).cast("bigint")))
    placed = joined.withColumn("tree", tree)
    order = ["choice", "value", "tree"]
    found = store(
        placed.select(*order, "point").repartition(*order).sortWithinPartitions(*order)
        .mapInArrow(_in_trees, "a bigint, b bigint")
    )
    if not few:
        return found
    known = components(found)
    cut = placed.filter("trees IS NOT NULL").join(known.withColumnRenamed("id", "point"), "point", "left")
    # A tree has about TREE_POINTS points: its shard's are dealt evenly by a hash.
    trees = store(cut.withColumn("component", F.coalesce("component", "point")).groupBy(*order).agg(
        F.collect_list(F.struct("point", "component")).alias("points"),
        F.min("component").alias("low"), F.max("component").alias("high"),
    ))
    sides = []
    for side in ("one", "two"):
        sides.append(trees.select("choice", "value", *[F.col(x).alias(f"{x}_{side}") for x in ("tree", "points", "low", "high")]))
    one, two = sides
    heads = one.drop("points_one").join(two.drop("points_two"), ["choice", "value"]).filter(
        "tree_one < tree_two AND NOT (low_one = high_one AND low_two = high_two AND low_one = low_two)"
    ).select("choice", "value", "tree_one", "tree_two")
    pairs = heads.repartition("choice", "value", "tree_one", "tree_two")
    whole = pairs.join(one, ["choice", "value", "tree_one"]).join(two, ["choice", "value", "tree_two"])
    return found.unionByName(whole.select("points_one", "points_two").mapInArrow(_between_trees, "a bigint, b bigint"))


def simhash_components(rows: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, fingerprint (16 hex digits) and component_id (the lowest key reachable) for each row."""
    each = store(fingerprints(rows, key, text))
    points = store(each.groupBy("point").agg(F.min("id").alias("least")))
    known = components(links(points.select("point"), points.count()))
    placed = points.join(known.withColumnRenamed("id", "point"), "point", "left").withColumn(
        "component", F.coalesce("component", "point")
    )
    lowest = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    found = placed.join(lowest, "component").select("point", "component_id")
    return each.join(found, "point").select(
        F.col("id").alias(key), F.lpad(F.lower(F.hex("point")), 16, "0").alias("fingerprint"), "component_id"
    )
