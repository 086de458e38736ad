"""A set of 64-bit hashes as bits of a fixed number, to thin out rows before a shuffle.

A member is always found; others are found sometimes, the more the fuller the set is. So
it may only drop rows that an exact join would drop later. Its size does not depend on
the data, which is what allows every task to hold it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyproof.llm.columns import mix

_SEGMENT = 1 << 19  # bits set together by one task: 64 KB
_TOGETHER = 1 << 20  # bits a task sends at once


def _places(values: np.ndarray, size: int, probes: int) -> np.ndarray:
    """`probes` bits for each hash, one row for each probe."""
    first = mix(values.view(np.uint64))
    step = mix(first) | np.uint64(1)
    bits = [first + np.uint64(i) * step for i in range(probes)]
    return np.stack(bits) & np.uint64(size - 1)


def hash_bits(hashes: DataFrame, name: str, size: int = 27, probes: int = 1) -> Broadcast:
    """2 ** size bits with `probes` set for each hash in column `name`, for all tasks.

    Every task sets the bits of its segments, so only finished segments are sent."""
    segments = (1 << size) // _SEGMENT

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, count = [], 0

        def packed() -> pa.RecordBatch:
            bits = np.unique(np.concatenate(waiting))
            segment = (bits // np.uint64(_SEGMENT)).astype(np.int32)
            starts = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1])))
            inner = np.split((bits % np.uint64(_SEGMENT)).astype(np.uint32), starts[1:])
            return pa.RecordBatch.from_arrays(
                [pa.array(segment[starts]), pa.array([x.tobytes() for x in inner], pa.binary())],
                names=["segment", "set"],
            )

        for batch in batches:
            if len(batch):
                waiting.append(_places(batch.column(0).to_numpy(), 1 << size, probes).ravel())
                count += len(waiting[-1])
            if count >= _TOGETHER:
                yield packed()
                waiting, count = [], 0
        if count:
            yield packed()

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for segment, some in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                bit = np.frombuffer(some, np.uint32)
                bits = found.setdefault(segment, np.zeros(_SEGMENT // 8, np.uint8))
                np.bitwise_or.at(bits, bit >> np.uint32(3), np.uint8(1) << (bit & np.uint32(7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.int32()), pa.array([x.tobytes() for x in found.values()], pa.binary())],
            names=["segment", "bits"],
        )

    bits = (
        hashes.select(F.col(name).alias("hash")).filter("hash IS NOT NULL")
        .mapInArrow(placed, "segment int, set binary")
        .repartition(min(segments, 16), "segment")
        .mapInArrow(filled, "segment int, bits binary")
    )
    whole = np.zeros((segments, _SEGMENT // 8), np.uint8)
    for row in bits.collect():
        whole[row.segment] = np.frombuffer(row.bits, np.uint8)
    return hashes.sparkSession.sparkContext.broadcast(whole.ravel())


def contains(bits: np.ndarray, hashes: np.ndarray, probes: int = 1) -> np.ndarray:
    found = np.ones(len(hashes), bool)
    for bit in _places(hashes, len(bits) * 8, probes):
        found &= (bits[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return found


def may_be_in(bits: Broadcast, key: str, probes: int = 1) -> Column:
    """Whether `key` may be one of those whose xxhash64 made the set. Python gets the hashes
    only, the row stays where it is."""

    @F.arrow_udf("boolean")
    def found(hashes: pa.Array) -> pa.Array:
        return pa.array(contains(bits.value, hashes.to_numpy(), probes))

    return found(F.xxhash64(key))


def wrongly(bits: np.ndarray, probes: int = 1) -> float:
    """The share of other hashes that are found as well."""
    return (int(np.bitwise_count(bits).sum()) / (8 * len(bits))) ** probes


def without(rows: DataFrame, gone: DataFrame, key: str, size: int = 26, probes: int = 2) -> DataFrame:
    """The rows whose `key` is not in `gone` (key). Those that may be in it are joined, the
    others stay where they are."""
    bits = hash_bits(gone.select(F.xxhash64(key).alias("hash")), "hash", size, probes)
    may_be_gone = may_be_in(bits, key, probes)
    return rows.filter(~may_be_gone).unionByName(rows.filter(may_be_gone).join(gone, key, "left_anti"))
