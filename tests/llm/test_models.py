"""The classifiers by held-out rows, the pipeline by its brute-force version, the queries."""

from __future__ import annotations

import os
import random
import re
import zlib
from itertools import accumulate

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from tallyproof.llm import labelled, quality, queries, secrets, toxicity
from tallyproof.llm.stored import intermediates, release
from tallyproof.sources.shared import shared_folder
from tests.llm.test_pairs import classes, moved, unlike

SF = "/root/testdata/sf0.01"


def read(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def test_held_out_rows_are_those_of_the_remainder(spark):
    got = spark.createDataFrame([(i,) for i in range(500)], "doc_id bigint").select("doc_id", labelled.held_out())
    assert all(r[1] == (zlib.crc32(str(r[0]).encode()) % 3 == 1) for r in got.collect())


@pytest.mark.parametrize(("module", "label", "least"), [(quality, "quality", 0.98), (toxicity, "toxic", 0.96)])
def test_held_out_accuracy(spark, module, label, least):
    labels, docs = (spark.read.parquet(f"/root/testdata/sf0.1/{x}.parquet") for x in ("labels", "documents"))
    rows = module.classify(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    right = sum(r.predicted == r[label] for r in rows) / len(rows)
    assert len(rows) > 100 and right >= least
    assert all(0 <= r.score <= 1 for r in rows)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_scores_depend_on_the_text_alone(spark, odd, extra, module):
    labels = read(spark, "labels")
    model = module.fit(read(spark, "documents").limit(400), labels)
    scored = [(r.text, r.score) for r in module.score(odd, model).collect()]
    assert len(scored) == 14 and all(0 <= s <= 1 for _, s in scored)
    by_text = {}
    for text, score in scored:
        assert by_text.setdefault(text or "", score) == pytest.approx(score)
    other = module.score(extra, model)
    assert sorted(r.score for r in other.collect()) == pytest.approx(sorted(s for _, s in scored))


@pytest.mark.parametrize("module", [quality, toxicity])
def test_without_labels_every_score_is_the_same(odd, spark, module):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = module.classify(odd, labels).collect()
    assert len(got) == 14 and {r.score for r in got} == {0.5}
    nulls = spark.createDataFrame([(None, 1, 1), (5, None, None)], "doc_id bigint, quality int, toxic int")
    assert {r.score for r in module.classify(odd, nulls).collect()} == {0.5}


def test_labels_of_held_out_rows_are_not_learnt(spark):
    labels = read(spark, "labels")
    turned = labels.withColumn("quality", labelled.F.when(labelled.held_out(), 1 - labelled.F.col("quality")).otherwise(
        labelled.F.col("quality")))
    docs = read(spark, "documents")
    first, second = ({r.doc_id: r.score for r in quality.classify(docs, x).collect()} for x in (labels, turned))
    assert first == pytest.approx(second)


def test_texts_that_share_their_lowest_words_are_all_learnt_from(documents, spark):
    rng = random.Random(6)
    names = [f"w{i}" for i in range(400)]
    hashes = [toxicity.words(pa.array(names), toxicity.ALPHANUMERIC).hashes(which) for which in (0, 1)]
    common = [names[int(h.argmin())] for h in hashes]
    rows = [(i, " ".join([*common, *rng.sample(names, 8), "vile" if i % 2 else "kind"])) for i in range(400)]
    rows += [(1000 + i, " ".join(["once", *[f"c{j}" for j in range(60)], f"v{i}"])) for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2 if i < 1000 else 1) for i, _ in rows], "doc_id bigint, toxic int")
    model = toxicity.fit(documents(rows), labels)
    weights = model.scored(toxicity.tokens(pa.array(["vile kind once"]))[1]) + toxicity.DRIFT
    # Near copies are one text.
    assert weights[0] > 0 and weights[1] == weights[2] == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(-5, 5), max_size=40))
def test_maximal_segments(scores):
    """Ruzzo and Tompa's definition: the best segment, then the same on both sides of it."""

    def split(a, b):
        best = (0, 0, 0)
        for i in range(a, b):
            for j, total in enumerate(accumulate(scores[i:b]), i + 1):
                if total > best[0] or (total == best[0] and total and (j - i) < best[2] - best[1]):
                    best = (total, i, j)
        if best[0] <= 0:
            return []
        return split(a, best[1]) + [(best[1], best[2], float(best[0]))] + split(best[2], b)

    found = toxicity.maximal_segments(np.array(scores, float))
    assert all(s > 0 and sum(scores[a:b]) == pytest.approx(s) for a, b, s in found)
    assert sum(s for _, _, s in found) == pytest.approx(sum(s for _, _, s in split(0, len(scores))))
    assert all(x[1] <= y[0] for x, y in zip(found, found[1:], strict=False))


def test_segments_of_a_slice_are_those_of_each_text():
    rng = np.random.default_rng(4)
    scores = rng.integers(-4, 5, 400).astype(float)
    first = np.array([0, 0, 50, 51, 200, 200, 400])
    got = list(toxicity._segments(scores, first))
    for i, (size, segments) in enumerate(got):
        own = scores[first[i] : first[i + 1]]
        assert size == len(own)
        assert [(a, b) for a, b, _ in segments] == [(a, b) for a, b, _ in toxicity.maximal_segments(own)]


def test_statistics_of_texts_alone_and_together():
    texts = ["", " \n", "one", "A!! B!! A!! B!!", "x y\nx y\nz.", "päß " * 50, "a" * 5_000]
    together = quality.statistics(pa.array(texts))
    assert together.shape == (7, quality._STATISTICS) and np.isfinite(together).all()
    for i, text in enumerate(texts):
        np.testing.assert_allclose(quality.statistics(pa.array([text]))[0], together[i])


def test_isotonic_scores_never_fall(spark):
    rng = random.Random(2)
    rows = [(x := rng.random(), int(rng.random() < x)) for _ in range(2_000)]
    scale = labelled.Isotonic(spark.createDataFrame(rows, "raw double, label int"), 0.0, 1.0)
    got = scale(np.linspace(-1, 2, 500))
    assert (np.diff(got) >= 0).all() and 0 <= got.min() < 0.15 and 0.85 < got.max() <= 1


def test_the_pipelines_stages(spark):
    docs = read(spark, "documents")
    known = {r.doc_id: r for r in docs.collect()}
    # Quality: what the classifier says about each row.
    judged = {r.doc_id: r.predicted for r in quality.classify(docs, read(spark, "labels")).collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_duplicates", "decontamination", "secrets", "sentencepiece"]
    assert corpus_pipeline.ORACLE_SQL is None
    out = stages["quality"](spark, docs, SF)
    assert out.columns == docs.columns
    kept = {r.doc_id for r in out.collect()}
    assert kept == {i for i, x in judged.items() if x}
    # Near duplicates: all pairs of what was kept.
    some = docs.filter(docs.doc_id.isin(list(kept)[:300]))
    rows = [(r.doc_id, r.text) for r in some.collect()]
    got = {r.doc_id for r in stages["near_duplicates"](spark, some, SF).collect()}
    assert got == {component for _, component in classes(rows, 80, 5).values()}
    # Decontamination: no ten words in a row of any item, and clean documents stay.
    items = [r.text for r in read(spark, "benchmark").collect()]
    words = lambda x: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), x))
    windows = {tuple(w[i : i + 10]) for w in map(words, items) for i in range(len(w) - 9)}
    left = {r.doc_id for r in stages["decontamination"](spark, docs, SF).collect()}
    for i, r in known.items():
        w = words(r.text)
        assert (i in left) == (not any(tuple(w[j : j + 10]) in windows for j in range(len(w) - 9)))
    # Secrets: masked texts are the texts but for the live spans; every row stays.
    spans = {r.doc_id: [s for s in r.spans if s.kind == "live"] for r in secrets.scan_secrets(docs).collect()}
    for r in stages["secrets"](spark, docs, SF).collect():
        text, at, want = known[r.doc_id].text, 0, ""
        for s in spans[r.doc_id]:
            if s.begin >= at:
                want += text[at : s.begin] + "<secret>"
            at = max(at, s.stop)
        assert r.text == want + text[at:] and r.n_chars == len(r.text)
    # SentencePiece: the library on each text.
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(queries.PIECES))
    for r in stages["sentencepiece"](spark, docs.limit(100), SF).collect():
        ids = [1, *library.encode(known[r.doc_id].text), 2]
        assert list(r.ids) == ids and r.decoded == library.decode(ids) and r.n_tokens == len(ids)


def test_near_duplicates_are_those_of_five_words_and_four_fifths(spark, documents):
    base = [f"w{i}" for i in range(44)]
    # Of 1's five-word shingles 2 has 36 of 44 in common, 3 has 35 of 45; of four words 2 has 37 of 45.
    rows = [(1, " ".join(base)), (2, " ".join([*base[:40], *[f"x{i}" for i in range(4)]]))]
    rows += [(3, " ".join([*base[5:], *[f"y{i}" for i in range(5)]]))]
    docs = read(spark, "documents").select("doc_id", "text").filter("doc_id between 200 and 640")
    rows += [(r.doc_id + 1000, r.text) for r in docs.collect()]
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        n = min(5, len(w))
        sets[i] = {tuple(w[j : j + n]) for j in range(len(w) - n + 1)} if w else set()
    root = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            both = len(sets[i] & sets[j]) if i < j else 0
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root[i], root[j]))
                root = {x: a if r == b else r for x, r in root.items()}
    got = {r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, documents(rows), SF).collect()}
    assert got == set(root.values()) and 2 not in got and 3 in got and 1615 not in got


def test_stages_take_odd_rows(spark, odd, extra):
    for rows in (odd, extra, odd.filter("false")):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, SF)
            assert (out.columns == rows.columns) or name == "sentencepiece"
            left = out.count()
            if name in ("secrets", "sentencepiece"):
                assert left == rows.count()
            if name == "near_duplicates" and left:
                # 1, 2 and 3 have no words, 4, 5 and 7 are alone, 6 copies 5, 10 copies 8; of 8's three rows two are equal.
                assert sorted(str(r.doc_id) for r in out.collect()) == sorted(["1", "2", "3", "4", "5", "7", "8", "8", "9", "None", "None"])


def test_near_duplicates_shuffle_only_texts_that_may_go(spark, documents, shuffled):
    rows = unlike(100)
    rows += [(100 + i, rows[i][1] + " end") for i in range(5)]
    kept = corpus_pipeline.near_duplicate_stage(spark, documents(rows), SF)
    assert 0 < moved(kept) < 8 * len(rows[0][1])
    assert sorted(r.doc_id for r in kept.collect()) == list(range(100))


def test_near_duplicates_of_rows_that_share_an_id(spark, documents):
    text = " ".join(f"w{i}" for i in range(30))
    other = " ".join(f"x{i}" for i in range(30))
    rows = [(1, text), (1, other), (1, "  "), (1, text), (2, other + " y"), (None, text + " z"), (None, "quite alone here"), (None, None)]
    got = corpus_pipeline.near_duplicate_stage(spark, documents(rows), SF).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in got) == sorted([
        ("1", text), ("1", other), ("1", "  "), ("None", "quite alone here"), ("None", "None"),
    ])


def test_a_run_leaves_one_folder_and_none_after_its_block(spark):
    def folders():
        base = shared_folder(spark).removeprefix("file:")
        return {name for name in os.listdir(base) if any(files for _, _, files in os.walk(f"{base}/{name}"))}

    before = folders()
    docs = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert docs.count() > 0 and len(folders() - before) == 1
    release(docs)
    assert folders() == before
    with intermediates(spark):
        assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
    assert folders() == before


@pytest.mark.parametrize("name", list(queries.queries()))
def test_queries_return_their_contract(spark, name):
    columns = {
        1: "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
        2: "doc_id n_words n_removed kept_sha256",
        3: "doc_id n_tokens ids_sha256 decoded_sha256",
        4: "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
        5: "doc_id n_shingles component_id",
        6: "doc_id held_out score predicted",
        7: "doc_id n_words n_hit n_items items_sha256 contaminated",
        8: "doc_id n_assign n_access n_hex base_sha256 spans",
        9: "doc_id n_bytes n_tokens over_limit",
        10: "doc_id held_out score predicted",
        11: "doc_id leaf subroot root proof_sha256 folded_root verified",
        12: "doc_id fingerprint component_id",
        13: "word form root n n_near form_n",
    }
    small = "/root/testdata/sf0.001"
    got = queries.queries()[name](spark, small)
    assert got.columns == columns[int(name[2:].split("_")[0])].split()
    if name.startswith("op13_"):
        return
    table = "conversations" if name.startswith("op1_") else "documents"
    rows = spark.read.parquet(f"{small}/{table}.parquet")
    expected = rows.select("conv_id").distinct().count() + 1 if table == "conversations" else rows.count()
    assert got.count() == expected
