"""Token counts of a byte-level BPE vocabulary by rank-synchronous array merging.

Texts are cut into pre-tokens; the distinct ones of a slice are held as one ragged array
of symbols. In every round each sequence finds its lowest-rank pair and merges all its
occurrences at once; a sequence without a mergeable pair is done, and what counts is the
number of symbols left. All sequences of the slice advance together, so a round is a few
numpy calls however many there are. Only pairs beside a merge get a new rank.

In this vocabulary every symbol is made by exactly one merge, and a merge that uses it
has a higher rank. So merging equal pairs at once equals merging them one by one.

A null or empty text has no bytes and no tokens. Rows are never dropped or combined.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from tallyproof.llm.columns import add_columns, buffers, text_array

# Classes of code points, in the sense of Unicode.
_OTHER, _LETTER, _NUMBER, _SPACE = range(4)

# What may follow an apostrophe in a pre-token of its own.
_ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")

# Distinct pre-tokens a task remembers; it forgets all of them beyond that.
REMEMBERED = 1_000_000
_NEVER = np.int64(1) << 40


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary file: itself if it can be
    printed, else the next free one from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(byte if byte in shown else next(hidden)) for byte in range(256)]


class Vocabulary:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        ids = content["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in content["model"]["merges"]]
        self.added = [x["content"] for x in content["added_tokens"] if not x["normalized"]]
        self.byte_ids = np.array([ids[letter] for letter in _byte_letters()], np.int64)
        self.made = np.array([ids[a + b] for a, b in pairs], np.int64)
        if len(np.unique(self.made)) != len(self.made):
            raise ValueError("a symbol is made by several merges; they cannot be applied at once")
        self.width = max(ids.values()) + 1
        keys = np.array([ids[a] * self.width + ids[b] for a, b in pairs], np.int64)
        self.ranks = np.argsort(keys)
        self.keys = keys[self.ranks]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], _NEVER)

    def symbols_left(self, tokens: list[bytes]) -> np.ndarray:
        """Number of symbols each pre-token (not empty) is merged to."""
        lengths = np.array([len(x) for x in tokens], np.int64)
        result = lengths.copy()
        symbols = self.byte_ids[np.frombuffer(b"".join(tokens), np.uint8)]
        owner = np.repeat(np.arange(len(tokens)), lengths)
        ranks = np.full(len(symbols), _NEVER)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        ranks[inner] = self.rank(symbols[inner], symbols[inner + 1])
        while len(symbols):
            starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            lengths = np.diff(starts, append=len(symbols))
            lowest = np.minimum.reduceat(ranks, starts)
            result[owner[starts]] = lengths
            going = lowest < _NEVER
            if not going.all():
                kept = np.repeat(going, lengths)
                symbols, owner, ranks = symbols[kept], owner[kept], ranks[kept]
                lowest, lengths = lowest[going], lengths[going]
                if not len(symbols):
                    break
            hit = ranks == np.repeat(lowest, lengths)
            # Of pairs that overlap (equal symbols in a row) every second is taken.
            at = np.flatnonzero(hit)
            fresh = np.concatenate(([True], np.diff(at) > 1))
            order = np.arange(len(at))
            at = at[(order - np.maximum.accumulate(np.where(fresh, order, 0))) % 2 == 0]
            symbols[at] = self.made[ranks[at]]
            stays = np.ones(len(symbols), bool)
            stays[at + 1] = False
            place = (np.cumsum(stays) - 1)[at]
            symbols, owner, ranks = symbols[stays], owner[stays], ranks[stays]
            changed = np.zeros(len(symbols), bool)
            changed[place] = changed[place[place > 0] - 1] = True
            beside = np.flatnonzero(changed)
            ranks[beside] = _NEVER
            beside = beside[beside + 1 < len(symbols)]
            beside = beside[owner[beside] == owner[beside + 1]]
            ranks[beside] = self.rank(symbols[beside], symbols[beside + 1])
        return result


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of every code point."""
    table = np.zeros(0x110000, np.uint8)
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    everything = "".join(map(chr, points))
    points = np.array(points)
    for kind, name in ((_LETTER, "L"), (_NUMBER, "N"), (_SPACE, "White_Space")):
        for run in regex.finditer(rf"\p{{{name}}}+", everything):
            table[points[run.start() : run.end()]] = kind
    return table


def pre_tokens(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where pre-tokens start in code points; `first` has the starts of texts.

    A pre-token is a run of letters, of numbers, of white space or of anything else. A
    blank before a run that is not white space belongs to that run; another last
    character of white space before one is alone. An apostrophe that starts a pre-token
    takes one of a few endings from the letters behind it.
    """
    n = len(points)
    kind = _classes()[points]
    border = np.ones(n + 1, bool)
    border[1:n] = kind[1:] != kind[:-1]
    border[first] = True
    at_text = np.zeros(n + 1, bool)
    at_text[first] = at_text[n] = True
    starts = border[:n].copy()
    # The last character of white space before something else in the same text.
    last = np.flatnonzero((kind == _SPACE) & border[1:] & ~at_text[1:])
    starts[last] = True
    starts[last[points[last] == 0x20] + 1] = False
    marks = np.flatnonzero((points == 0x27) & starts & border[1:] & ~at_text[1:])
    marks = marks[kind[marks + 1] == _LETTER]
    if len(marks):
        padded = np.append(points, (0, 0))
        for ending in _ENDINGS:
            fits = np.ones(len(marks), bool)
            for i, letter in enumerate(ending, 1):
                fits &= padded[marks + i] == ord(letter)
                fits &= ~border[np.minimum(marks + i, n)] | (i == 1)
            hit = marks[fits]
            starts[hit + 1] = False
            after = hit + 1 + len(ending)
            starts[after[after < n]] = True
    return np.flatnonzero(starts)


class Counter:
    """Counts tokens of texts; remembers the counts of pre-tokens it has seen."""

    def __init__(self, path: str):
        self.vocabulary = vocabulary(path)
        self.special = regex.compile("|".join(map(regex.escape, self.vocabulary.added)) or r"(?!)")
        self.known: dict[bytes, int] = {}

    def counts(self, column: pa.Array) -> np.ndarray:
        """Number of tokens of each text. Special strings are one token and end a text."""
        column = text_array(column)
        extra = np.zeros(len(column), np.int64)
        owner = np.arange(len(column))
        if any(pc.any(pc.match_substring(column, x)).as_py() for x in self.vocabulary.added):
            parts = [self.special.split(x) for x in column.to_pylist()]
            sizes = np.array([len(x) for x in parts])
            extra, owner = sizes - 1, np.repeat(owner, sizes)
            column = pa.array([x for some in parts for x in some], pa.string())
        data, offsets = buffers(column)
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        heads = np.flatnonzero((data & 0xC0) != 0x80)
        texts = np.searchsorted(heads, offsets)
        starts = pre_tokens(points, texts[:-1][texts[:-1] < len(points)])
        tokens = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts),
            [None, pa.py_buffer(np.append(heads[starts], len(data))), pa.py_buffer(data.tobytes())],
        ).dictionary_encode()
        distinct = tokens.dictionary.to_pylist()
        if len(self.known) > REMEMBERED:
            self.known = {}
        new = [x for x in distinct if x not in self.known]
        if new:
            self.known.update(zip(new, self.vocabulary.symbols_left(new).tolist(), strict=True))
        left = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        sums = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(left[tokens.indices.to_numpy()], out=sums[1:])
        each = np.diff(sums[np.searchsorted(starts, texts)])
        return np.bincount(owner, each, len(extra)).astype(np.int64) + extra


def count_tokens(rows: DataFrame, path: str, text: str = "text", limit: int = 1024) -> DataFrame:
    """Adds n_bytes, n_tokens and over_limit (more than `limit` tokens) to each row.

    Columns of these names that `rows` has are replaced."""

    def start():
        counter = Counter(path)

        def make(column: pa.Array) -> list:
            column = text_array(column)
            tokens = counter.counts(column)
            return [pc.cast(pc.binary_length(column), pa.int64()), tokens, tokens > limit]

        return make

    added = ["n_bytes bigint", "n_tokens bigint", "over_limit boolean"]
    return add_columns(rows, text, added, start, 4 << 20)
