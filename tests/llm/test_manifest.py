"""The Merkle manifest against a plain computation of the same trees."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tallyproof.llm import manifest, queries
from tests.llm.samples import corpus

NAMES = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def chosen():
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def lowered(text):
    return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def levels(leaves):
    found = [leaves]
    while len(found[-1]) > 1:
        below = found[-1]
        found.append([digest(*below[i : i + 16]) for i in range(0, len(below), 16)])
    return found


def expected(rows):
    """Tuples of NAMES for rows of (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0], digest(*map(field, row)), row))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in order:
        groups[name].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[name] = levels([leaf for _, leaf, _ in groups[name]])
    top = levels([trees[name][-1][0] for name in order])
    found = []
    for number, name in enumerate(order):
        for place, (key, leaf, row) in enumerate(groups[name]):
            node, siblings = leaf, []
            if key is not None and zlib.crc32(str(key).encode()) % 5 == 0:
                node = digest(*map(field, (*row[:4], lowered(row[4]))))
            for tree, at in ((trees[name], place), (top, number)):
                for nodes in tree[:-1]:
                    run, i = nodes[at // 16 * 16 : at // 16 * 16 + 16], at % 16
                    siblings += run[:i] + run[i + 1 :]
                    node = digest(*run[:i], node, *run[i + 1 :])
                    at //= 16
            root = top[-1][0]
            found.append((key, leaf, trees[name][-1][0], root, digest(*siblings), node, node == root))
    return ordered(found)


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


def table(rows):
    return [tuple(r) for r in rows.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def check(rows, **more):
    got = manifest.manifest(rows, tampered=chosen(), **more)
    assert got.columns == NAMES
    assert ordered(map(tuple, got.collect())) == expected(table(rows))


@pytest.mark.parametrize("trunk", [manifest.TRUNK, 3, 0])
def test_equals_plain_trees(documents, trunk):
    rng = random.Random(trunk)
    # One group of a third, groups of 1, 16, 17 and 257 rows, and more groups than a run has.
    sizes = {"hot": 400, "one": 1, "run": 16, "more": 17, "deep": 257, **{f"g{i}": rng.randint(1, 9) for i in range(40)}}
    names = [name for name, n in sizes.items() for _ in range(n)]
    rng.shuffle(names)
    rows = [(i * 7, f"Text {i} of {name.upper()}", name) for i, name in enumerate(names)]
    check(documents(rows), trunk=trunk)


@pytest.mark.parametrize("count", [1, 2, 16, 17])
def test_one_group(documents, count):
    check(documents([(i, f"Row {i}", "only") for i in range(count)]))


def test_only_lone_leaves(documents):
    check(documents([(i, f"Row {i}", f"s{i}") for i in range(20)]))


def test_odd_rows_ties_and_other_columns(odd, extra, documents):
    check(odd)
    more = odd.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.col("lang")))
    more = more.withColumn("source", F.when(F.col("doc_id") > 5, F.lit("é")).when(F.col("doc_id") > 2, F.lit("z")))
    check(more.withColumn("n_chars", F.when(F.col("doc_id") != 3, F.col("n_chars"))))
    # Columns that are not named do not enter, whatever their names.
    got = manifest.manifest(extra.withColumn("leaf", F.lit(1)).withColumn("tree", F.lit(2)), tampered=chosen())
    assert ordered(map(tuple, got.collect())) == expected(table(odd))


def test_only_lower_casing_is_found(documents):
    rows = [(i, t, "s") for i, t in enumerate(["Upper É", "lower é", None, "", "É"] * 8)]
    got = manifest.manifest(documents(rows), tampered=F.lit(True)).collect()
    assert {r.doc_id for r in got if not r.verified} == {i for i, t, _ in rows if t == "Upper É"}
    got = manifest.manifest(documents(rows)).collect()
    assert all(r.verified for r in got) and len(got) == 40


def test_empty_table(documents):
    assert manifest.manifest(documents([]), tampered=chosen()).collect() == []


def test_limit_on_recursion_is_put_back(spark, documents):
    name = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(name)
    check(documents([(i, text, "s") for i, text in corpus(3, 40)]))
    assert spark.conf.get(name) == before


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    got = ordered(map(tuple, queries.op11_merkle_manifest(spark, folder).collect()))
    assert got == expected(table(spark.read.parquet(f"{folder}/documents.parquet")))
