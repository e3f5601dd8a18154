from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loanlens.llm import blocks, lattice, vocabulary

from . import helpers


@pytest.fixture(scope="module")
def model():
    return lattice.lattice(vocabulary.load())


def split(model, texts: list[str], keys) -> list[list[int]]:
    data, offsets = blocks.text_bytes(pa.array(texts, pa.string()))
    ids, lengths = lattice.sample(model, data, offsets, np.asarray(keys, np.uint64))
    return [p.tolist() for p in np.split(ids, np.cumsum(lengths)[:-1])]


def test_draws_follow_the_weights(model):
    """All segmentations of a word, against their shares in many draws."""
    index = {p: i for i, p in enumerate(vocabulary.load().pieces) if p}

    def ways(rest: bytes):
        if not rest:
            return [[]]
        return [[index[rest[:n]], *tail] for n in range(1, len(rest) + 1) if rest[:n] in index for tail in ways(rest[n:])]

    paths = ways(b"thing")
    weights = [math.exp(sum(model.log_weight[i] for i in p)) for p in paths]
    n = 20000
    drawn = Counter(map(tuple, split(model, ["thing"] * n, blocks.mix(np.arange(n).astype(np.uint64)))))
    for path, weight in zip(paths, weights, strict=True):
        assert drawn[tuple(path)] / n == pytest.approx(weight / sum(weights), abs=0.015)
    assert sum(drawn.values()) == n and set(drawn) <= set(map(tuple, paths))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="the ing\n\t▁é日😀\x00", max_size=40), min_size=1, max_size=6))
def test_decoding_gives_the_text_back(texts):
    own = lattice.lattice(_vocabulary())
    data, offsets = blocks.text_bytes(pa.array(texts, pa.string()))
    ids, lengths = lattice.sample(own, data, offsets, np.arange(len(texts)).astype(np.uint64))
    assert lattice.joined(own, ids, lengths).cast(pa.string()).to_pylist() == texts


_kept: list = []


def _vocabulary():
    if not _kept:
        _kept.append(vocabulary.load())
    return _kept[0]


def test_draws_depend_on_key_and_text_alone(model):
    long = "the thing is " * 300 + "x" * 1000 + "é" * 700
    alone = split(model, [long], [77])[0]
    among = split(model, ["other words", long, "", long, long], [1, 77, 5, 77, 78])
    assert alone == among[1] == among[3] != among[4]


def test_edges_through_spark(spark):
    docs = helpers.edge_docs(spark)
    rows = lattice.decode(lattice.encode(docs, carry=("text", "score"))).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.decoded == r.text
        assert (r.ids is None) == (r.text is None) and (r.text != "" or r.ids == [])
    again = lattice.encode(docs.repartition(5), carry=("text",)).collect()
    assert sorted((str(r.doc_id), r.text or "", r.ids or []) for r in again) == sorted((str(r.doc_id), r.text or "", r.ids or []) for r in rows)
    other = lattice.encode(docs, seed=1).agg(F.sum(F.hash("ids"))).first()
    assert other != lattice.encode(docs).agg(F.sum(F.hash("ids"))).first()


def test_empty_table(spark):
    assert lattice.decode(lattice.encode(helpers.empty_docs(spark))).count() == 0
