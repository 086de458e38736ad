"""Document fingerprints: a Merkle tree over paragraphs and sections.

A paragraph is a line with its line end; its node is a digest of its bytes. A section is
a run of paragraphs; it ends after a paragraph whose digest says so, so an edit moves no
other section's borders. A section's node is a digest of its paragraphs' nodes, the root
one of the sections' nodes. Equal texts have equal roots, and where two roots differ,
comparing sections and then paragraphs leads to the edits (`differing`).

A paragraph is cut into leaves, so that a text of one long line can be compared as well.
Borders depend on the eight bytes before them, whatever these are: texts without blanks have
leaves like others. A leaf has 128 code points at most. The first leaves of a text are
smaller (`_ZONES`), one code point at its very start, and never longer than two fifths of
what is before them. A leaf's digest covers 16 code points up to its end at least, so that
short leaves do not agree by chance.

The likeness of two fingerprints weighs nodes by their code points, from the root down: equal
roots give 1; sections that both have count whole and nothing below them is looked at; then
paragraphs of the other sections likewise; then leaves of the other paragraphs. It is twice
the weight in common divided by the weight of both texts. If the first half of a text
stands and the rest is replaced by no more than was there, that is 0.3 or more.

A fingerprint is text: ``root:section=paragraph.paragraph,section=..:leaves.leaves``, in hex,
with the leaves of each paragraph in order (24 bits of digest and the size).
A null text is fingerprinted as the empty text.
"""

from __future__ import annotations

import bisect
import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyproof.llm.columns import add_columns, buffers, mix, ragged, span_hash, text_array

SECTION_PARAGRAPHS = 4
# From this place in a text on: a border at one code point in so many, and the longest leaf.
_ZONES = ((0, 1, 1), (8, 2, 3), (16, 4, 6), (32, 8, 12), (64, 16, 24), (128, 32, 48), (512, 64, 128))
_CONTEXT = 16
_BATCH_CHARS = 1 << 20


def _digest(data: bytes, size: int) -> bytes:
    return hashlib.blake2b(data, digest_size=size).digest()


def tree(text: bytes) -> tuple[str, list[tuple[str, list[str]]]]:
    """Root and (section, its paragraphs)."""
    sections: list[list[bytes]] = [[]]
    for paragraph in text.splitlines(keepends=True) if text else []:
        node = _digest(paragraph, 16)
        sections[-1].append(node)
        if node[0] % SECTION_PARAGRAPHS == 0:
            sections.append([])
    nodes = [(_digest(b"".join(x), 16), x) for x in sections if x]
    root = _digest(b"".join(node for node, _ in nodes), 16)
    return root.hex(), [(node.hex()[:16], [x.hex()[:16] for x in below]) for node, below in nodes]


@dataclass
class Fingerprint:
    root: str
    sections: list[tuple[str, list[str]]]
    leaves: np.ndarray  # 24 bits of digest, eight of size
    first: np.ndarray  # where each paragraph's leaves start, and the end

    def __str__(self) -> str:
        packed = self.leaves.astype("<u4").tobytes().hex()
        below = ".".join(packed[8 * a : 8 * b] for a, b in zip(self.first[:-1], self.first[1:], strict=True))
        middle = ",".join(f"{node}={'.'.join(paragraphs)}" for node, paragraphs in self.sections)
        return f"{self.root}:{middle}:{below}"


def read(fingerprint: str) -> Fingerprint:
    """A fingerprint from its text."""
    top, middle, below = fingerprint.split(":")
    sections = [(x.split("=")[0], x.split("=")[1].split(".")) for x in middle.split(",") if x]
    packed = below.split(".") if sections else []
    first = np.cumsum([0] + [len(x) // 8 for x in packed])
    return Fingerprint(top, sections, np.frombuffer(bytes.fromhex("".join(packed)), "<u4"), first)


def leaves(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The leaves of all texts, where each text's start (and the end), and which leaves start
    a paragraph."""
    data, offsets = buffers(column)
    points = np.flatnonzero((data & 0xC0) != 0x80)
    if not len(points):
        return np.zeros(0, np.uint32), np.zeros(len(column) + 1, np.int64), np.zeros(0, bool)
    first = np.searchsorted(points, offsets)
    text_start = np.repeat(first[:-1], np.diff(first))
    place = np.arange(len(points)) - text_start
    begins, one_in, longest = (np.array(x) for x in zip(*_ZONES, strict=True))
    zone = np.searchsorted(begins, place, "right") - 1
    padded = np.concatenate((np.zeros(8, np.uint8), data))
    before = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))[points]
    line = place == 0
    previous = data[points - 1]
    line |= (previous == 0x0A) | ((previous == 0x0D) & (data[points] != 0x0A))
    border = line | (place == begins[zone]) | (mix(before) & (one_in[zone] - 1).astype(np.uint64) == 0)
    start = np.flatnonzero(border)
    gap, most = np.diff(start, append=len(points)), longest[zone[start]]
    parts = -(-gap // most)
    start = np.repeat(start, parts) + ragged(np.zeros(len(start), np.int64), parts) * np.repeat(most, parts)
    stop = np.append(start[1:], len(points))
    context = np.maximum(text_start[start], np.minimum(start, stop - _CONTEXT))
    ends = np.append(points, len(data))
    digest = span_hash(data, ends[context], ends[stop])
    values = (digest >> np.uint64(40) << np.uint64(8) | (stop - start).astype(np.uint64)).astype(np.uint32)
    return values, np.searchsorted(start, first), line[start]


def fingerprints(column: pa.Array) -> list[Fingerprint]:
    data, offsets = buffers(column)
    view = data.tobytes()
    values, first, opens = leaves(column)
    found = []
    for i in range(len(column)):
        root, sections = tree(view[offsets[i] : offsets[i + 1]])
        own = slice(first[i], first[i + 1])
        found.append(Fingerprint(root, sections, values[own], np.append(np.flatnonzero(opens[own]), own.stop - own.start)))
    return found


def root(fingerprint: str) -> str:
    return fingerprint.split(":", 1)[0]


def _without(nodes: list[str], others: list[str]) -> list[int]:
    """Positions of `nodes` left when each has been matched with an equal one of `others`."""
    spare = Counter(others)
    found = []
    for i, node in enumerate(nodes):
        if spare[node]:
            spare[node] -= 1
        else:
            found.append(i)
    return found


def _below(fingerprint: Fingerprint, sections: list[int]) -> list[int]:
    """Positions of the paragraphs of sections."""
    ends = np.cumsum([0] + [len(below) for _, below in fingerprint.sections]).tolist()
    return [x for i in sections for x in range(ends[i], ends[i + 1])]


def likeness(a: Fingerprint | str, b: Fingerprint | str) -> float:
    """How alike two fingerprints are, from 0 to 1."""
    a, b = (read(x) if isinstance(x, str) else x for x in (a, b))
    if a.root == b.root:
        return 1.0
    names = [[node for node, _ in x.sections] for x in (a, b)]
    paragraphs = [[node for _, below in x.sections for node in below] for x in (a, b)]
    left = []
    for x, own, other in ((a, 0, 1), (b, 1, 0)):
        left.append(_below(x, _without(names[own], names[other])))
    nodes = [[paragraphs[i][at] for at in left[i]] for i in (0, 1)]
    rest = []
    for x, own, other in ((a, 0, 1), (b, 1, 0)):
        at = np.array([left[own][i] for i in _without(nodes[own], nodes[other])], np.int64)
        rest.append(x.leaves[ragged(x.first[at], x.first[at + 1] - x.first[at])])
    total = [int((x.leaves & 0xFF).sum()) for x in (a, b)]
    # What has been matched above the leaves weighs the same on both sides.
    common = total[0] - int((rest[0] & 0xFF).sum())
    values, counts = np.unique(rest[0], return_counts=True)
    other = np.sort(rest[1])
    there = np.searchsorted(other, values, "right") - np.searchsorted(other, values, "left")
    common += int((np.minimum(there, counts) * (values & 0xFF).astype(np.int64)).sum())
    return 2 * common / sum(total)


def differing(a: str, b: str) -> tuple[list[int], list[int]]:
    """Positions of the paragraphs of `a` and of `b` that the other does not have.

    Sections both have are skipped whole."""
    split = [
        [(s.split("=")[0], s.split("=")[1].split(".")) for s in x.split(":")[1].split(",") if s]
        for x in (a, b)
    ]
    if root(a) == root(b):
        return [], []
    sections = [{node for node, _ in x} for x in split]
    paragraphs = [{p for _, below in x for p in below} for x in split]
    found = []
    for own, other in ((0, 1), (1, 0)):
        at, positions = 0, []
        for node, below in split[own]:
            if node not in sections[other]:
                positions += [at + i for i, p in enumerate(below) if p not in paragraphs[other]]
            at += len(below)
        found.append(positions)
    return found[0], found[1]


def fingerprint(rows: DataFrame, text: str = "text") -> DataFrame:
    """Adds the column fingerprint (replacing one of that name)."""
    return add_columns(
        rows, text, ["fingerprint string"],
        lambda: lambda column: [pa.array(map(str, fingerprints(text_array(column))), pa.string())],
    )


def edited_with_next(rows: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text beside its edited text, with both fingerprints.

    The edited text has the last half of its code points (rounded down) replaced by the
    first as many of the next row's text, in ascending order of `key` (nulls first, then by
    text); the row after the last is the first. Returns key, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited and near_next.

    Rows are cut into ranges of the key; the first rows of a range also go to the range
    before it, as what follows its last row. So the texts are shuffled once, and no order
    of the whole table is ever in one place. Only the lowest key of each range reaches the
    driver. Keys may be of any type that can be sorted.
    """
    spark = rows.sparkSession
    kind = rows.schema[key].dataType.simpleString()
    known = rows.select(F.col(f"`{key}`").alias("k"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The keys alone are cut into ranges; equal keys are in one.
    cut = known.select("k").filter("k IS NOT NULL").repartitionByRange(ranges, "k")
    lows = sorted(x.low for x in cut.groupBy(F.spark_partition_id()).agg(F.min("k").alias("low")).collect())
    void = not known.filter("k IS NULL").isEmpty()
    # Null keys come first, in the first range.
    heads = ([None] if void else lows[:1]) + lows[1:]
    if not heads:
        return spark.createDataFrame([], _EDITED.format(kind=kind)).withColumnRenamed("k", key)

    @F.arrow_udf("int")
    def part(keys: pa.Array) -> pa.Array:
        return pa.array([0 if x is None else max(0, bisect.bisect_right(lows, x) - 1) for x in keys.to_pylist()], pa.int32())

    placed = known.withColumn("part", part("k"))
    before = [(x, (i - 1) % len(heads)) for i, x in enumerate(heads)]
    borders = spark.createDataFrame(before, f"low {kind}, part int")
    # One row a range is broadcast.
    follows = known.join(F.broadcast(borders), F.col("k").eqNullSafe(F.col("low"))).drop("low")
    # Of many rows with a border's key the one with the least text follows.
    follows = follows.groupBy("part", "k").agg(F.min("t").alias("t")).withColumn("after", F.lit(True))
    dealt = placed.withColumn("after", F.lit(False)).unionByName(follows)
    ordered = dealt.repartition(max(1, len(heads)), "part").sortWithinPartitions("part", "after", "k", "t")
    return ordered.select("part", "after", "k", "t").mapInArrow(_edited, _EDITED.format(kind=kind)).withColumnRenamed("k", key)


_EDITED = (
    "k {kind}, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in order, those that follow a range behind it."""
    pending: list[tuple] = []  # (key, text, text that follows)
    chars, previous, schema = 0, None, None

    def stream():
        nonlocal schema
        for batch in batches:
            schema = batch.schema
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    for part, after, key, text in stream():
        if previous is not None and previous[0] == part:
            pending.append((previous[1], previous[2], text))
            chars += len(previous[2])
            if chars >= _BATCH_CHARS:
                yield _compared(pending, schema.field("k").type)
                pending, chars = [], 0
        previous = None if after else (part, key, text)
    if pending:
        yield _compared(pending, schema.field("k").type)


def _compared(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    edited = []
    for _, text, following in rows:
        half = len(text) // 2
        edited.append(text[: len(text) - half] + following[:half])
    # A row's text is the text that follows the row before it, so most are made once.
    own, new = (fingerprints(pa.array(x, pa.string())) for x in ([x[1] for x in rows], edited))
    chained = [rows[i][2] is rows[i + 1][1] for i in range(len(rows) - 1)] + [False]
    following = [
        own[i + 1] if chained[i] else fingerprints(pa.array([rows[i][2]], pa.string()))[0] for i in range(len(rows))
    ]
    near_edited = [likeness(a, b) for a, b in zip(own, new, strict=True)]
    near_next = [likeness(a, b) for a, b in zip(own, following, strict=True)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([x[0] for x in rows], kind),
            pa.array([len(x[1]) for x in rows], pa.int64()),
            pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited], pa.string()),
            pa.array(map(str, own), pa.string()),
            pa.array(map(str, new), pa.string()),
            pa.array(near_edited, pa.float64()),
            pa.array(near_next, pa.float64()),
        ],
        names=["k", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )
