"""Spelling variants against a plain computation."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyproof.llm import queries, spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def words(rows):
    found = Counter()
    for key, text in rows:
        for run in RUN.findall(text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            hashed = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if hashed % 31 == 0:
                at = hashed % len(word)
                word = word[:at] + word[at + 1 :]
            found[word] += 1
    return {word: n for word, n in found.items() if len(word) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(n):
    """Sorted tuples of (word, form, root, n, n_near, form_n) for a vocabulary."""
    around = {}
    for word in n:
        for i in range(len(word)):
            around.setdefault(word[:i] + word[i + 1 :], set()).add(word)
        around.setdefault(word, set()).add(word)
    near = {word: set() for word in n}
    for group in around.values():
        for a in group:
            near[a].update(b for b in group if one_edit(a, b))
    form = {}
    for word in n:
        best = min(near[word], key=lambda x: (-n[x], x), default=None)
        form[word] = best if best is not None and n[best] >= 10 * n[word] else None
    rows = []
    for word in n:
        root = word
        while form[root]:
            root = form[root]
        rows.append((word, form[word] or "", root, n[word], len(near[word]), n[form[word]] if form[word] else 0))
    return sorted(rows)


def got(frame):
    found = spelling.spelling_variants(frame)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in found.collect())


def texts(seed, letters="abcdeéß", stems=40):
    """Words that are few edits from each other, with very unlike frequencies."""
    rng = random.Random(seed)
    known = []
    for _ in range(stems):
        stem = "".join(rng.choice(letters) for _ in range(rng.randint(6, 11)))
        known += [stem] * rng.choice([1, 5, 60, 700])
        for _ in range(rng.randint(0, 6)):
            at, kind = rng.randrange(len(stem)), rng.random()
            stem = stem[:at] + (rng.choice(letters) if kind < 0.7 else "") + stem[at + (kind > 0.4) :]
            known += [stem] * rng.choice([1, 4, 30])
    rng.shuffle(known)
    return [(i, " ".join(w.title() if rng.random() < 0.1 else w for w in known[i * 60 : i * 60 + 60])) for i in range(len(known) // 60 + 1)]


@pytest.mark.parametrize("seed,letters", [(1, "abcdeéß"), (2, "ab"), (3, "abcdefghijklmnopqrstuvwxyzäöü÷×Ä")])
def test_equals_all_edits(documents, seed, letters):
    rows = texts(seed, letters)
    want = expected(words(rows))
    assert got(documents(rows)) == want
    assert any(x[1] for x in want) and (seed == 2 or any(x[1] and x[2] != x[1] for x in want))


@pytest.mark.parametrize("symbols", [2, 3, 32])
def test_any_alphabet_will_do(documents, monkeypatch, symbols):
    monkeypatch.setattr(spelling, "SYMBOLS", symbols)
    rows = texts(4, stems=12)
    assert got(documents(rows)) == expected(words(rows))


def test_neighbourhood_is_whole_and_without_repeats():
    rng = random.Random(1)
    for _ in range(60):
        word = "".join(rng.choice("abcdefghäÿÀ") for _ in range(rng.randint(1, 9)))
        edits = {word} | {word[:i] + word[i + 1 :] for i in range(len(word))}
        for c in "abcdefgh":  # a letter for each symbol
            edits |= {word[:i] + c + word[i:] for i in range(len(word) + 1)}
            edits |= {word[:i] + c + word[i + 1 :] for i in range(len(word))}
        want = set(spelling.Reduced(pa.array(sorted(edits))).own().tolist())
        made = np.concatenate([h for _, h in spelling.Reduced(pa.array([word])).neighbours()]).tolist()
        assert set(made) == want and len(made) == len(want)


def test_one_edit_of_two_words():
    rng = random.Random(7)
    pairs = [("".join(rng.choice("abÄ") for _ in range(rng.randint(0, 5))), "".join(rng.choice("abÄ") for _ in range(rng.randint(0, 5)))) for _ in range(4000)]
    found = spelling.one_edit(*(pa.array(x) for x in zip(*pairs, strict=True))).tolist()
    assert found == [one_edit(a, b) for a, b in pairs] and any(found)


def test_a_typo_can_make_a_word_too_short(documents):
    key = next(i for i in range(1000) if zlib.crc32(f"{i}:abcdefg".encode()) % 31 == 0)
    rows = [(key, "abcdefg abcdefg"), (key + 1, "abcdefg abcdefg")]
    assert got(documents(rows)) == expected(words(rows)) and len(expected(words(rows))) == 1


def test_odd_rows(documents, odd, extra):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    want = expected(words(rows))
    assert got(odd) == want and got(extra.withColumn("word", F.lit("x")).withColumn("n", F.lit(1))) == want
    long = "xyz" * 30_000
    rows = [(1, f"{long} {long}"), (2, f"{long}x {long}x {long}x"), (3, None), (4, "")]
    found = {r.word: r.n_near for r in spelling.spelling_variants(documents(rows)).collect()}
    assert found == {long: 1, f"{long}x": 1}


def test_empty_table(documents):
    assert spelling.spelling_variants(documents([])).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    found = queries.op13_spelling(spark, folder).collect()
    assert sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in found) == expected(words(rows))
