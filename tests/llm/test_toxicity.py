from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loanlens.llm import blocks, lang_id, toxicity

from . import helpers


@pytest.fixture(scope="module")
def trained(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(500):
        own = [helpers.prose(rng, 8) for _ in range(rng.randint(2, 8))]
        toxic = int(rng.random() < 0.3)
        if toxic:
            own[rng.randrange(len(own))] += " you vile " + rng.choice(["grublings", "grubly", "grubness"])
        rows.append((i, ". ".join(own) + "."))
        labels.append((i, toxic))
    labels += [(3, labels[3][1]), (None, 1), (99999, 1), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    return docs, marks, toxicity.train(docs, marks, ~lang_id.held_out()), dict(labels[:500])


def test_held_out_documents_and_their_sentences(trained):
    docs, _, model, labels = trained
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = toxicity.score(docs.withColumn("held", lang_id.held_out()).where("held"), model).collect()
    assert len(rows) > 50
    assert np.mean([(r.score >= 0.5) == bool(labels[r.doc_id]) for r in rows]) > 0.97
    for r in rows:
        for s in r.offending:
            assert "vile" in texts[r.doc_id][s.start : s.end] or "grub" in texts[r.doc_id][s.start : s.end]


def test_edges(spark, trained):
    model = trained[2]
    docs = helpers.edge_docs(spark)
    got = toxicity.score(docs, model).collect()
    assert len(got) == docs.count()
    assert all(0 <= r.score <= 1 for r in got)
    rows = [(1, None), (2, ""), (3, " \n"), (4, "é😀 fine. YOU VILE GRUBLY thing! ok"), (4, "é😀 fine. YOU VILE GRUBLY thing! ok")]
    marked = {}
    for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect():
        marked.setdefault(r.doc_id, []).append(r)
    assert [marked[i][0].score for i in (1, 2, 3)] == [0.0, 0.0, 0.0]
    assert len(marked[4]) == 2 and marked[4][0] == marked[4][1] and marked[4][0].score > 0.5
    spans = marked[4][0].offending
    assert [rows[3][1][s.start : s.end].strip() for s in spans] == ["YOU VILE GRUBLY thing!"]


def test_nothing_to_learn(spark):
    docs, labels = helpers.empty_docs(spark), spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, ~lang_id.held_out())
    assert toxicity.score(docs, model).count() == 0
    assert {r.score for r in toxicity.score(helpers.edge_docs(spark), model).collect()} == {0.0}


def test_scores_are_noisy_or():
    text = "bad. good words here. bad worse! fine"
    data, offsets = blocks.text_bytes(pa.array([text]))
    hashes, sentence, stops = toxicity.sentence_words(data, offsets)
    assert len(stops) == 4 and stops.tolist() == [4, 21, 32, 37]
    assert np.bincount(sentence)[:4].tolist() == [1, 3, 2, 1]
    assert len(hashes) == 7


def test_scores_against_a_plain_loop(spark, trained):
    """Noisy-or over sentences, each with every word and opening once, by loops over the text."""
    docs, _, model, _ = trained
    weight = dict(zip(model.words.tolist(), model.weights.tolist(), strict=True))

    def features(sentence: str) -> set[int]:
        data, offsets = blocks.text_bytes(pa.array([sentence]))
        return set(toxicity.word_features(data, offsets)[0].tolist())

    rows = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    for r in docs.limit(120).collect():
        clean = 1.0
        for sentence in re.split(r"(?<=[.!?])(?=\s)|(?<=\n)", r.text):
            own = [weight[h] for h in features(sentence) if weight.get(h, 0) > 0]
            if own:
                clean *= 1 - 1 / (1 + np.exp(-(model.quiet + sum(own))))
        assert rows[r.doc_id].score == pytest.approx(1 - clean, abs=1e-9)


def test_few_labels_are_enough_for_a_clear_word(spark):
    rng = random.Random(2)
    rows = [(i, helpers.prose(rng, 30) + (" you vile grubling " if i % 7 == 0 else "") + helpers.prose(rng, 30)) for i in range(70)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 7 == 0)) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, ~lang_id.held_out())
    found = {r.doc_id: r.score >= 0.5 for r in toxicity.score(docs, model).collect()}
    assert found == {i: i % 7 == 0 for i, _ in rows}


def test_ties_and_repeats_leave_the_sample_bounded(spark):
    docs = spark.createDataFrame([(i % 9, "some text here") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i % 9, int(i % 9 < 4)) for i in range(27)], "doc_id long, toxic int")
    sample = toxicity.labelled_sample(docs, labels, F.lit(True), bound=2)
    ids = {(r.doc_id, r.toxic) for r in sample.collect()}
    assert len(ids) == 4 and sum(t for _, t in ids) == 2
    assert {(r.doc_id, r.toxic) for r in toxicity.labelled_sample(docs.repartition(5), labels, F.lit(True), bound=2).collect()} == ids
