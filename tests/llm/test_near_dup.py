from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loanlens.llm import blocks, near_dup
from loanlens.llm.components import components

from . import helpers


def found(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def test_edges_match_brute_force(spark):
    docs = helpers.edge_docs(spark)
    rows = [(r[0], r[1]) for r in helpers.edge_rows()]
    for width, least in ((3, 85), (5, 80)):
        result = near_dup.near_duplicates(docs, width, least)
        assert found(result) == helpers.components(rows, width, least)
        assert all(r.kept == (r.doc_id == r.component_id) for r in result.collect())


def test_near_copies_of_one_text_match_brute_force(spark):
    rng = random.Random(5)
    base = helpers.prose(rng, 120).split(" ")
    rows = []
    for i in range(150):
        own = list(base)
        for _ in range(rng.randint(0, 7)):
            own[rng.randrange(len(own))] = f"w{rng.randrange(40)}"
        rows.append((i, " ".join(own)))
    rows += [(1000 + i, rows[3][1]) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(near_dup.near_duplicates(docs)) == helpers.components(rows, 3, 85)


def test_small_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK_ROWS", 4)
    monkeypatch.setattr(near_dup, "BROADCAST_IDS", 0)
    rows = [(r[0], r[1]) for r in helpers.edge_rows(11)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(near_dup.near_duplicates(docs)) == helpers.components(rows, 3, 85)


def test_empty_table(spark):
    assert near_dup.near_duplicates(helpers.empty_docs(spark)).count() == 0


def test_deduplicate_keeps_one_of_each_group_and_all_columns(spark):
    docs = helpers.edge_docs(spark)
    kept = near_dup.deduplicate(docs, 5, 80)
    assert kept.columns == docs.columns
    rows = [(r[0], r[1]) for r in helpers.edge_rows()]
    wanted = sorted({c for _, _, c in helpers.components(rows, 5, 80)})
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == wanted
    assert kept.where(F.col("doc_id").isNull()).count() == 1


def test_deduplicate_does_not_shuffle_texts_for_the_ids_that_stay(spark):
    prose = helpers.prose(random.Random(5), 60)
    rows = [(i, f"{prose} {i} own {i * 7}") if i % 10 else (i, prose) for i in range(1, 200)]
    docs = spark.createDataFrame([*rows, (10, "again " * 9), (None, "no id")], "doc_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = near_dup.deduplicate(docs, 5, 100)
        got = sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in kept.collect())
        assert "SortMergeJoin" not in kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    wanted = [(False, i, t) for i, t in rows if i % 10] + [(False, 10, "again " * 9), (True, 0, "no id")]
    assert got == sorted(wanted)


def test_estimate_is_close_to_the_similarity(spark):
    rng = random.Random(2)
    base = helpers.prose(rng, 400).split(" ")
    other = list(base)
    for place in rng.sample(range(400), 12):
        other[place] = "else"
    texts = [" ".join(base), " ".join(other)]
    rows = near_dup.signatures(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    pair = rows.where("doc_id = 0").alias("a").crossJoin(rows.where("doc_id = 1").alias("b"))
    one, two = (helpers.shingles(t, 3) for t in texts)
    assert pair.select(near_dup.estimate("a", "b").alias("e")).first().e == pytest.approx(len(one & two) / len(one | two), abs=0.1)


@pytest.mark.parametrize("least", [50, 80, 85, 99, 100])
def test_bands_fit_the_minima(least):
    assert 1 <= near_dup.bands(least) * near_dup.ROWS <= near_dup.MINIMA


def test_sets_do_not_depend_on_neighbours():
    texts = ["a b c d", "", "a b c d", "x"]
    data, offsets = blocks.text_bytes(pa.array(texts))
    together = near_dup.shingle_sets(data, offsets, 3)
    alone, at = blocks.text_bytes(pa.array(["a b c d"]))
    assert np.array_equal(together[0], near_dup.shingle_sets(alone, at, 3)[0])
    assert np.array_equal(together[0], together[2]) and len(together[1]) == 0 and len(together[3]) == 1


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(30)] + [(5, 5), (300, 200), (200, 300)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 300: 200}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
