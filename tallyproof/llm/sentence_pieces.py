"""SentencePiece encoding and decoding through a table of distinct chunks.

The library writes each space as a marker and puts one in front of the text. If no piece
has a marker behind another character, no merge can cross from a word into the marker
that follows, so a text's ids are the ids of its chunks (markers and the word behind
them) one after another. Each distinct chunk of a slice is segmented once, by the
library, and its ids and its decoded bytes are joined back by position with numpy.

The table lives as long as a task and is emptied when it is large; what it holds never
changes a result. A null or empty text has the begin and end ids only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame

from tallyproof.llm.columns import add_columns, buffers, ragged, text_array

MARKER = "▁"
REMEMBERED = 1_000_000


@dataclass
class _Ragged:
    """Arrays one after another, with room to grow."""

    flat: np.ndarray
    starts: np.ndarray
    counts: np.ndarray

    @staticmethod
    def empty(kind: type) -> _Ragged:
        return _Ragged(np.zeros(0, kind), np.zeros(0, np.int64), np.zeros(0, np.int64))

    def add(self, flat: np.ndarray, counts: np.ndarray) -> None:
        starts = len(self.flat) + np.cumsum(counts) - counts
        self.flat = np.concatenate((self.flat, flat))
        self.starts = np.concatenate((self.starts, starts))
        self.counts = np.concatenate((self.counts, counts))

    def take(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The arrays of `which` one after another, and the end of each."""
        counts = self.counts[which]
        return self.flat[ragged(self.starts[which], counts)], np.cumsum(counts)


class Encoder:
    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        if any(MARKER in name.lstrip(MARKER) for name in names):
            raise ValueError("pieces of this model cross markers; chunks cannot be encoded alone")
        if model.encode(f" a {MARKER} ") != model.encode("▁a▁▁ "):
            raise ValueError("this model rewrites spaces; chunks cannot be encoded alone")
        self.model, self.begin, self.end = model, model.bos_id(), model.eos_id()
        self.lone = [model.piece_to_id(MARKER)]
        surface = [
            b"" if model.is_control(i)
            else bytes([int(name[3:5], 16)]) if model.is_byte(i)
            else " ⁇ ".encode() if model.is_unknown(i)
            else name.replace(MARKER, " ").encode()
            for i, name in enumerate(names)
        ]
        self.surface = _Ragged.empty(np.uint8)
        self.surface.add(
            np.frombuffer(b"".join(surface), np.uint8), np.array([len(x) for x in surface], np.int64)
        )
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids, self.texts = _Ragged.empty(np.uint32), _Ragged.empty(np.uint8)

    def _learn(self, chunks: list[bytes]) -> None:
        """Segments chunks. The library puts the first marker back itself."""
        found = self.model.encode([x[1:].decode() for x in chunks], num_threads=1)
        found = [ids or self.lone for ids in found]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.int64, counts.sum())
        self.ids.add(flat.astype(np.uint32), counts)
        size = self.surface.counts[flat]
        ends = np.concatenate(([0], np.cumsum(size)))[np.cumsum(counts)]
        self.texts.add(self.surface.take(flat)[0], np.diff(ends, prepend=0))
        self.known.update(zip(chunks, range(len(self.known), len(self.known) + len(chunks)), strict=True))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts and their ends, decoded bytes and their ends.

        Begin and end ids, and the space that decoding removes in front, are left out."""
        column = pc.replace_substring(text_array(column), MARKER, " ")
        data, offsets = buffers(pc.binary_join_element_wise("", column, " "))
        # Empty texts get no marker: their chunk is removed.
        filled = np.diff(offsets) > 1
        space = data == 0x20
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        begins[offsets[:-1]] = True
        starts = np.flatnonzero(begins)
        chunks = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts),
            [None, pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(np.ascontiguousarray(data))],
        ).dictionary_encode()
        distinct = chunks.dictionary.to_pylist()
        if len(self.known) > REMEMBERED:
            self.forget()
        new = [x for x in distinct if x not in self.known]
        if new:
            self._learn(new)
        table = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        which = table[chunks.indices.to_numpy()]
        last = np.searchsorted(starts, offsets[1:])
        if not filled.all():
            empty = np.zeros(len(starts), bool)
            empty[np.searchsorted(starts, offsets[:-1][~filled])] = True
            which = which[~empty]
            last = last - np.cumsum(~filled)
        ids, id_ends = self.ids.take(which)
        texts, text_ends = self.texts.take(which)
        at = lambda ends: np.concatenate(([0], ends))[last]
        return ids, at(id_ends), texts, at(text_ends)


def encode(rows: DataFrame, path: str, text: str = "text", decode: bool = True) -> DataFrame:
    """Adds ids array<int> (with begin and end) and decoded string to each row.

    Columns of these names that `rows` has are replaced."""
    return _encoded(rows, path, text, ["ids array<int>", *["decoded string"] * decode], _as_lists)


def encode_digests(rows: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Adds n_tokens, ids_sha256 and decoded_sha256 instead, which are much smaller."""
    added = ["n_tokens bigint", "ids_sha256 string", "decoded_sha256 string"]
    return _encoded(rows, path, text, added, _as_digests)


def _spans(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    return zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)


def _as_lists(encoder: Encoder, column: pa.Array, names: list[str]) -> list[pa.Array]:
    ids, ends, texts, text_ends = encoder.encode(column)
    size = len(ends)
    bounds = np.concatenate(([0], ends)) + 2 * np.arange(size + 1)
    flat = np.empty(bounds[-1], np.int32)
    inner = np.ones(len(flat), bool)
    inner[bounds[:-1]] = inner[bounds[1:] - 1] = False
    flat[inner], flat[bounds[:-1]], flat[bounds[1:] - 1] = ids, encoder.begin, encoder.end
    made = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat))]
    if "decoded" in names:
        view = texts.tobytes()
        made.append(pa.array([view[a + 1 : b].decode() for a, b in _spans(text_ends)], pa.string()))
    return made


def _as_digests(encoder: Encoder, column: pa.Array, names: list[str]) -> list[pa.Array]:
    ids, ends, texts, text_ends = encoder.encode(column)
    view, decoded = ids.astype("<u4").tobytes(), texts.tobytes()
    begin, end = encoder.begin.to_bytes(4, "little"), encoder.end.to_bytes(4, "little")
    digests = [
        hashlib.sha256(begin + view[4 * a : 4 * b] + end).hexdigest() for a, b in _spans(ends)
    ]
    texts = [hashlib.sha256(decoded[a + 1 : b]).hexdigest() for a, b in _spans(text_ends)]
    counts = np.diff(ends, prepend=0) + 2
    return [pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(texts, pa.string())]


def _encoded(rows: DataFrame, path: str, text: str, added: list[str], make) -> DataFrame:
    names = [x.split()[0] for x in added]

    def start():
        encoder = Encoder(path)
        return lambda column: make(encoder, column, names)

    return add_columns(rows, text, added, start, 4 << 20)
