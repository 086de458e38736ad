"""Chat formatting by columnar byte assembly.

A turn is written as ``<|im_start|>role\\ntext<|im_end|>\\n``. Roles and texts are escaped
so that no control string can occur inside: ``<``, any number of backslashes, ``|`` gets
one more backslash; in a role, backslashes and line ends are escaped as well. Both can be
undone. The loss mask of a conversation is the list of spans that hold the texts of
`assistant` turns, in code points of the formatted text.

Segment lengths, their running sums and the index of each output byte's source byte are
numpy arrays over many turns at once; bytes are copied by one indexed read into the
buffer that becomes the Arrow column.

Turns are dealt by conversation and sorted in their partition, then read as a stream: no
group is collected but the one text that is the result for a conversation. A null text or
role is empty, a null turn comes first, a null conversation is a conversation. Turns with
equal numbers are ordered by role, then text; repeated rows are repeated turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyproof.llm.columns import buffers, code_points, pieces, ragged

START, END = "<|im_start|>", "<|im_end|>"
LEARNT = "assistant"

_FORMATTED = "n_turns bigint, formatted string, loss_starts array<bigint>, loss_ends array<bigint>"


def escape(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(texts, r"<(\\*)\|", r"<\\\1|")


def escape_role(roles: pa.Array) -> pa.Array:
    roles = pc.replace_substring(escape(roles), "\\", "\\\\")
    return pc.replace_substring(roles, "\n", "\\n")


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def unescape_role(role: str) -> str:
    return unescape(re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role))


def assemble(
    segments: list[tuple[np.ndarray, np.ndarray]], rows: int
) -> tuple[np.ndarray, np.ndarray]:
    """Interleaves columns of byte segments: for each row its segment of each column.

    Columns are (data, offsets); one with a single row stands for all rows. Returns the
    bytes and the start of every segment (row by row, column by column) and the end."""
    lengths = np.empty((rows, len(segments)), np.int64)
    sources = np.empty((rows, len(segments)), np.int64)
    base = 0
    for i, (data, offsets) in enumerate(segments):
        lengths[:, i], sources[:, i] = np.diff(offsets), offsets[:-1] + base
        base += len(data)
    lengths, sources = lengths.ravel(), sources.ravel()
    starts = np.concatenate(([0], np.cumsum(lengths)))
    out = np.empty(starts[-1], np.uint8)
    np.take(np.concatenate([data for data, _ in segments]), ragged(sources, lengths), out=out)
    return out, starts


def _constant(text: str) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(text.encode(), np.uint8)
    return data, np.array([0, len(data)])


def format_turns(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the formatted turns, where each starts (and the end), and the code points
    before each turn's text, of its text and of the turn."""
    role, text = buffers(escape_role(roles)), buffers(escape(texts))
    columns = [_constant(START), role, _constant("\n"), text, _constant(END + "\n")]
    data, starts = assemble(columns, len(texts))
    points = code_points(data, starts).reshape(-1, len(columns))
    spans = np.stack((points[:, :3].sum(axis=1), points[:, 3], points.sum(axis=1)), axis=1)
    return data, starts[:: len(columns)], spans


def format_chats(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per conversation: its id, n_turns, formatted, loss_starts, loss_ends.

    Other columns of `turns` are ignored."""
    kind = turns.schema[conversation].dataType.simpleString()
    dealt = turns.select(
        F.col(f"`{conversation}`").alias("conversation"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    ).repartition("conversation")
    ordered = dealt.sortWithinPartitions("conversation", "turn", "role", "text")
    return ordered.drop("turn").mapInArrow(_assembled, f"conversation {kind}, {_FORMATTED}").select(
        F.col("conversation").alias(conversation), "n_turns", "formatted", "loss_starts", "loss_ends"
    )


class _Open:
    """A conversation whose end has not been seen."""

    def __init__(self, key):
        self.key, self.turns, self.parts, self.points = key, 0, [], 0
        self.starts, self.ends = [], []

    def add(self, part: bytes, spans: np.ndarray, learnt: np.ndarray) -> None:
        at = self.points + np.cumsum(spans[:, 2]) - spans[:, 2] + spans[:, 0]
        self.starts += at[learnt].tolist()
        self.ends += (at + spans[:, 1])[learnt].tolist()
        self.points += int(spans[:, 2].sum())
        self.turns += len(spans)
        self.parts.append(part)


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current = None
    for piece in pieces(batches):
        keys, roles, texts = piece.columns
        data, starts, spans = format_turns(roles, texts)
        learnt = pc.equal(roles, LEARNT).to_numpy(zero_copy_only=False)
        view = data.tobytes()
        ids = keys.to_pylist()
        done = []
        first = 0
        for stop in range(1, len(ids) + 1):
            if stop < len(ids) and ids[stop] == ids[first]:
                continue
            if current is None or current.key != ids[first]:
                done += [current] if current else []
                current = _Open(ids[first])
            part = slice(first, stop)
            current.add(view[starts[first] : starts[stop]], spans[part], learnt[part])
            first = stop
        if done:
            yield _rows(done, keys.type)
    if current:
        yield _rows([current], keys.type)


def _rows(chats: list[_Open], kind: pa.DataType) -> pa.RecordBatch:
    spans = pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            pa.array([x.key for x in chats], kind),
            pa.array([x.turns for x in chats], pa.int64()),
            pa.array([b"".join(x.parts).decode() for x in chats], pa.string()),
            pa.array([x.starts for x in chats], spans),
            pa.array([x.ends for x in chats], spans),
        ],
        names=["conversation", "n_turns", "formatted", "loss_starts", "loss_ends"],
    )


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    turns = formatted.split(START)[1:]
    split = (turn.removesuffix(END + "\n").split("\n", 1) for turn in turns)
    return [(unescape_role(role), unescape(text)) for role, text in split]


def digests(chats: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """Reads formatted conversations back: digests of their turns and of the masked text."""
    kind = chats.schema[conversation].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "formatted"):
            rows = []
            for _, text, starts, ends in zip(*(c.to_pylist() for c in piece.columns), strict=True):
                turns = parse(text)
                said = "".join(f"{role}\n{content}\n" for role, content in turns)
                learnt = "".join(
                    unescape(text[a:b]) for a, b in zip(starts, ends, strict=True)
                )
                rows.append((len(turns), _sha256(said), len(learnt), _sha256(learnt), len(text)))
            made = [pa.array(x) for x in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays([piece.columns[0], *made], names=names)

    names = ["conversation", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    read = chats.select(F.col(f"`{conversation}`").alias("conversation"), "formatted", "loss_starts", "loss_ends")
    found = read.mapInArrow(
        run,
        f"conversation {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
        "loss_sha256 string, formatted_chars bigint",
    )
    return found.withColumnRenamed("conversation", conversation)


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
