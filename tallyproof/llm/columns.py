"""Arrow text columns as numpy arrays: bounded pieces, words, hashes.

A batch of Arrow rows can hold a gigabyte of text, and the arrays made from it several
times that, so `pieces` cuts batches into slices of a few megabytes (one row at least).
Words and hashes are computed for a slice at once, without a loop over rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE_BYTES = 1 << 20

# Separators are the six ASCII white-space characters; all else is part of a word.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False

# Words of digits, ASCII letters and everything beyond ASCII.
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # odd, so they have inverses
_SHINGLE = (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
_powers: dict[int, np.ndarray] = {}


def text_array(column: pa.Array) -> pa.Array:
    """The column as text without nulls (a null is an empty text)."""
    return column if column.null_count == 0 else pc.fill_null(column, "")


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and len + 1 offsets from 0."""
    column = text_array(column)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offset_buffer, data_buffer = column.buffers()
    if len(column) == 0 or offset_buffer is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(offset_buffer, kind)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    if data_buffer is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    data = np.frombuffer(data_buffer, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def text_of(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """An Arrow text column over one buffer."""
    return pa.LargeStringArray.from_buffers(
        len(offsets) - 1,
        pa.py_buffer(np.ascontiguousarray(offsets, np.int64)),
        pa.py_buffer(np.ascontiguousarray(data, np.uint8)),
    ).cast(pa.string())


def pieces(
    batches: Iterator[pa.RecordBatch], name: str = "text", limit: int = PIECE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most `limit` bytes in column `name`, or one row."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(name))
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < len(sizes):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all bits."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** n, modulo 2 ** 64."""
    known = _powers.get(base)
    if known is None or len(known) <= n:
        known = np.full(n + 1, base, np.uint64)
        known[0] = 1
        known = np.cumprod(known, dtype=np.uint64)
        if n <= 2 * PIECE_BYTES:  # what a single long text needs is not kept
            _powers[base] = known
    return known[: n + 1]


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """A 64-bit hash of each byte span, from prefix sums of one polynomial over all bytes."""
    base = _MULTIPLIERS[which]
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(base, len(data))[:-1], out=sums[1:])
    back = _power(pow(base, -1, 1 << 64), len(data))
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    """Word spans of a slice; those of row i are first[i] .. first[i + 1]."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self, which: int = 0) -> np.ndarray:
        return span_hash(self.data, self.starts, self.ends, which)


def words(column: pa.Array, kind: np.ndarray = SPACED, lower: bool = False) -> Words:
    data, offsets = buffers(column)
    if lower:
        data = LOWER[data]
    inside = kind[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[edges] = inside[edges]
    edges = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    stops[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    return Words(data, starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets))


def windows(hashes: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """Hash of every `size` consecutive word hashes, whatever row they are of."""
    n = max(0, len(hashes) - size + 1)
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total *= np.uint64(_SHINGLE[which])
        total += hashes[i : i + n]
    return mix(total)


def window_starts(first: np.ndarray, size: int) -> np.ndarray:
    """Which window starts lie in one row, as positions among all words."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    return ragged(first[:-1], counts)


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, .. for counts[i] values each, one after another."""
    shift = np.repeat(starts - (np.cumsum(counts) - counts), counts)
    return shift + np.arange(len(shift))


def code_points(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of code points in each text."""
    heads = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=heads[1:])
    return heads[offsets[1:]] - heads[offsets[:-1]]


def tally(hashes: Iterator[np.ndarray], name: str, together: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """(name, n): hashes with their number, summed up over about `together` of them."""
    waiting, size = [], 0

    def counted() -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(waiting), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts)], names=[name, "n"])

    for some in hashes:
        waiting.append(some)
        size += len(some)
        if size >= together:
            yield counted()
            waiting, size = [], 0
    if size:
        yield counted()


def add_columns(
    rows: DataFrame,
    text: str,
    added: list[str],
    factory: Callable[[], Callable[[pa.Array], list]],
    limit: int = PIECE_BYTES,
) -> DataFrame:
    """`rows` with columns made from the texts of column `text`.

    `added` has their names and types; columns of these names that `rows` has are
    replaced. Each task calls `factory` once and its result for every slice of texts.
    Names of columns may be anything: they are numbered on the way."""
    names = [x.split()[0] for x in added]
    kept = [name for name in rows.columns if name not in names]
    numbered = rows.select(*[F.col(f"`{name}`").alias(f"_{i}") for i, name in enumerate(kept)])
    at = kept.index(text)
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in numbered.schema]
    fields += [f"new_{i} {x.split(' ', 1)[1]}" for i, x in enumerate(added)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = factory()
        for piece in pieces(batches, f"_{at}", limit):
            made = [x if isinstance(x, pa.Array) else pa.array(x) for x in make(piece.column(at))]
            yield pa.RecordBatch.from_arrays(
                [*piece.columns, *made], names=[field.split(" ", 1)[0] for field in fields]
            )

    found = numbered.mapInArrow(run, ", ".join(fields))
    return found.select(
        *[F.col(f"_{i}").alias(name) for i, name in enumerate(kept)],
        *[F.col(f"new_{i}").alias(name) for i, name in enumerate(names)],
    )
