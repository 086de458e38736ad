"""SimHash fingerprints and components against the hash library and all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tallyproof.llm import queries, simhash
from tests.llm.samples import corpus

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    n = min(4, len(w))
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + n]).encode(), 42) for i in range(len(w) - n + 1)] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(points):
    """The lowest position connected with each of `points`."""
    values = np.array(points, np.uint64)
    root = list(range(len(points)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(points)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= 4) + i + 1:
            a, b = sorted((find(i), find(int(j))))
            root[b] = a
    return [find(i) for i in range(len(points))]


def expected(rows):
    """Rows of (id, fingerprint, component), for ids without nulls."""
    rows = sorted(rows, key=lambda r: r[0])
    points = [fingerprint(text) for _, text in rows]
    return sorted((r[0], f"{p:016x}", rows[c][0]) for r, p, c in zip(rows, points, linked(points), strict=True))


def got(frame):
    return sorted(map(tuple, simhash.simhash_components(frame).collect()))


def test_hash_is_that_of_the_library():
    rng = random.Random(1)
    data = bytes(rng.randrange(256) for _ in range(5000))
    spans = [(a, a + n) for n in [*range(0, 140), 500, 3000] for a in (rng.randrange(1500), rng.randrange(1500))]
    starts, ends = (np.array(x) for x in zip(*spans, strict=True))
    found = simhash.span_xxh64(np.frombuffer(data, np.uint8), starts, ends)
    assert found.tolist() == [xxhash.xxh64_intdigest(data[a:b], 42) for a, b in spans]


def test_fingerprints():
    texts = [text for _, text in corpus(1)] + ["", " \n", "Ein Wort", "a b c d", "Größe £5 日本語 😀 x", "w" * 5000 + " x"]
    assert simhash.simhashes(pa.array(texts)).tolist() == [fingerprint(x) for x in texts]


def scattered(seed, count=700):
    """Points in chains, dense groups and alone."""
    rng = random.Random(seed)
    points, centre = {0}, 0
    while len(points) < count:
        if rng.random() < 0.02:
            centre = rng.getrandbits(64)
        base = centre if rng.random() < 0.6 else rng.choice(list(points))
        points.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))))
    return sorted(points)


@pytest.mark.parametrize("tree_points,together", [(4096, 1 << 16), (20, 1 << 16), (4096, 50), (5, 1)])
def test_components_of_points(spark, monkeypatch, tree_points, together):
    monkeypatch.setattr(simhash, "TREE_POINTS", tree_points)
    monkeypatch.setattr(simhash, "_TOGETHER", together)
    monkeypatch.setattr(simhash, "_FRONTIER", 1000)
    points = scattered(together)
    signed = np.array(points, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(x,) for x in signed], "point bigint")
    links = [tuple(r) for r in simhash.links(frame, len(points)).collect()]
    place = {x: i for i, x in enumerate(signed)}
    for a, b in links:
        assert (points[place[a]] ^ points[place[b]]).bit_count() <= 4
    root = list(range(len(points)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        x, y = sorted((find(place[a]), find(place[b])))
        root[y] = x
    assert [find(i) for i in range(len(points))] == linked(points)


def test_more_points_make_finer_shards():
    for count in (10, 10**6, 10**8, 10**11):
        masks = simhash.plan(count)
        rng = random.Random(count)
        for _ in range(200):
            change = sum(1 << b for b in rng.sample(range(64), 4))
            # Two points that differ in four bits share a shard.
            assert any(change & (m % (1 << 64)) == 0 for m in masks)
    assert len(simhash.plan(10)) < len(simhash.plan(10**8)) < len(simhash.plan(10**11))


def test_a_dense_group_is_not_compared_pair_by_pair(monkeypatch):
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    points = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(6000)}
    forest = simhash.Forest(np.zeros(len(points)), np.array(sorted(points), np.uint64))
    compared = []
    distance = simhash.Forest.distance
    monkeypatch.setattr(simhash.Forest, "distance", lambda self, v, n: compared.append(len(v)) or distance(self, v, n))
    for _ in forest.search(forest.points, forest.label, forest.root):
        pass
    assert sum(compared) < len(points) ** 2 / 4


@pytest.mark.parametrize("seed", [1, 2])
def test_documents(documents, seed):
    rows = corpus(seed, 200)
    assert got(documents(rows)) == expected(rows)


def test_odd_rows(odd, extra):
    for rows in (odd, extra):
        found = simhash.simhash_components(rows).collect()
        assert len(found) == 14
        zero = [r for r in found if r.fingerprint == "0" * 16]
        assert {r.doc_id for r in zero} >= {1, 2, 3, None} and {r.component_id for r in zero} == {1}
        by_id = {(r.doc_id, r.fingerprint): r.component_id for r in found}
        same = fingerprint("same text here for you and me " * 4)
        assert by_id[(8, f"{same:016x}")] == 8 and by_id[(10, f"{same:016x}")] == 8
        alone = f"{fingerprint('no id but a text of some words'):016x}"
        assert by_id[(None, alone)] is None


def test_empty_table(documents):
    assert simhash.simhash_components(documents([])).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, queries.op12_simhash(spark, folder).collect())) == expected(rows)
