from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanlens.llm import lang_id

from . import helpers


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(1)
    rows = [(i, helpers.prose(rng, 80), "en") for i in range(60)]
    rows += [(100 + i, helpers.prose(rng, 80, "le la que eau ai oi é en ou ent"), "fr") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return lang_id.trained(docs, ~lang_id.held_out())


def test_probabilities_sum_to_one(model):
    """For a seen and an unseen context, over the whole alphabet and the unknown character."""
    letters = " abcdefghijklmnopqrstuvwxyzé"
    for context in ("the", " th", "zzz"):
        total = np.zeros(len(model.languages))
        for char in [*letters, "ж"]:
            codes = np.array([ord(c) for c in context + char], np.uint32)
            whole = model.bits(codes, np.array([0, 4]))[0]
            before = model.bits(codes[:3], np.array([0, 3]))[0]
            weight = 1.0 if char in letters else model.alphabet_bits * 0 + 1
            total += weight * 2.0 ** -(whole - before)
        # Letters that no language has seen share the unknown character's part.
        assert np.all(total > 0.9) and np.all(total < 1.6)


def test_arrays_are_sorted(model):
    assert all(np.all(np.diff(k.astype(np.float64)) >= 0) for k in [*model.keys, *model.contexts])


def test_held_out_texts_and_edges(spark, model):
    rng = random.Random(9)
    rows = [(i, helpers.prose(rng, 40), "en") for i in range(30)]
    rows += [(50 + i, helpers.prose(rng, 40, "le la que eau ai oi é en ou ent"), "fr") for i in range(30)]
    rows += [(200, None, "x"), (201, "", "x"), (202, "123 *** 😀", "x"), (203, "zqxj wvkq " * 50, "?"), (203, "the ing", "en"), (None, "the ing", "en")]
    rows.append((300, " ".join(rows[0][1] for _ in range(9000)), "en"))  # longer than a block
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit(1))
    got = lang_id.identify(docs, model).collect()
    assert len(got) == len(rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    right = [by_id[i][0].lang_pred == lang for i, _, lang in rows[:60]]
    assert np.mean(right) > 0.95
    for i in (200, 201, 202):
        assert (by_id[i][0].lang_pred, by_id[i][0].score, by_id[i][0].rejected) == ("und", 0.0, True)
        assert by_id[i][0].cross_entropy is None
    assert sorted(r.rejected for r in by_id[203]) == [False, True]
    assert by_id[300][0].lang_pred == "en" and not by_id[300][0].rejected
    assert by_id[300][0].cross_entropy == pytest.approx(by_id[0][0].cross_entropy, abs=0.1)
    assert all(0 <= r.score <= 1 for r in got)


def test_noise_in_a_corpus_is_rejected(spark):
    rng = random.Random(2)
    rows = [(i, helpers.prose(rng, 40), "en") for i in range(600)]
    rows += [(1000 + i, "".join(rng.choice("theangirosd") for _ in range(80)), "en") for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lang_id.trained(docs, F.lit(True))
    got = {r.doc_id: r.rejected for r in lang_id.identify(docs.where("doc_id < 1000"), model).collect()}
    assert not any(got.values())
    new = [(i, "".join(rng.choice("theangirosd") for _ in range(80)), None) for i in range(40)]
    got = lang_id.identify(spark.createDataFrame(new, docs.schema), model).collect()
    assert all(r.rejected for r in got)


def test_carried_columns_keep_their_names(spark, model):
    docs = helpers.edge_docs(spark)
    found = lang_id.identify(docs, model, carry=docs.columns)
    assert found.columns == [*docs.columns, "lang_pred", "_score", "cross_entropy", "rejected"]
    assert found.count() == docs.count()


def test_empty_table_and_no_labels(spark):
    docs = helpers.empty_docs(spark)
    assert lang_id.trained(docs, F.lit(True)) is None
    assert lang_id.identify(docs, None).count() == 0
    one = spark.createDataFrame([(1, "text")], "doc_id long, text string")
    assert [tuple(r)[1:] for r in lang_id.identify(one, None).collect()] == [("und", 0.0, None, True)]


def test_bound_on_learning_rows(spark):
    rows = [(i, "some text", "en") for i in range(400)] + [(1000 + i, "autre texte", "fr") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    counts = {r.lang: r["count"] for r in lang_id.learning_rows(docs, F.lit(True), 50).groupBy("lang").count().collect()}
    assert counts == {"en": 50, "fr": 20}


def test_normalised_text():
    codes, starts, lettered = lang_id.normalised(["Ab, cD!", None, "", "12"])
    chars = ["".join(map(chr, codes[a:b])) for a, b in zip(starts[:-1], starts[1:], strict=True)]
    assert chars == [" ab cd ", " ", " ", " "]
    assert lettered.tolist() == [True, False, False, False]
    assert math.isclose(2.0 ** -0, 1)
