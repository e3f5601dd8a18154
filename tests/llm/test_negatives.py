"""Hard negatives against all pairs, with ties, repeats, small chunks and rows that take no part."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from loanlens.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, score int, slot int, place int, q int, rank int"


def sample(seed: int = 5, n: int = 300) -> list[tuple]:
    rng = random.Random(seed)
    rows = [[i, [round(rng.uniform(-0.2, 0.9), 1) for _ in range(4)], rng.randrange(3)] for i in range(n)]
    for i in range(40, min(n, 90)):  # one group of equal vectors, over all labels
        rows[i][1] = list(rows[20][1])
    rows[7][2], rows[8][1], rows[9][1], rows[11][1] = None, None, [0.1, None, 0.2, 0.3], [0.1, math.nan, 0.2, 0.3]
    rows[12][1], rows[13][1], rows[14][1] = [math.inf, 0.1, 0.1, 0.1], [], [0.5, 0.5]
    rows[0][1] = [-x for x in rows[1][1]]  # an anchor with scores below zero
    rows += [[20, rows[20][1], rows[20][2]], [30, [0.9] * 4, 2], [30, [0.8] * 4, 0], [None, [0.5] * 4, 1]]
    return [(*r, 1, 2, 3, 4, 5) for r in rows]


def brute(rows: list[tuple], every: int, positives: int, top: int) -> list[tuple]:
    own: dict[int, tuple] = {}
    for i, v, label, *_ in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        import numpy as np

        q = tuple(math.floor(256 * float(np.float32(x))) for x in v)
        own[i] = min(own.get(i, (label, q)), (label, q))
    out = []
    for a, (label, q) in own.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, w, strict=False)), i, m) for i, (m, w) in own.items() if i != a)
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            fits = [x for x in scored if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s]
            out += [(a, p, r + 1, i, -s, -n) for r, (n, i, _) in enumerate(fits[:top])]
    return sorted(out)


@pytest.mark.parametrize(("chunk", "partitions"), [(1 << 20, 1), (256, 3)])
def test_all_pairs(spark, chunk, partitions):
    rows = sample()
    df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    found = negatives.mine(negatives.vectors(df), F.col("vec_id") % 10 == 0, chunk_bytes=chunk)
    expected = brute(rows, 10, 5, 10)
    assert sorted(tuple(r) for r in found.collect()) == expected
    assert len(expected) > 300


def test_extra_columns_and_nothing_to_do(spark):
    rows = sample(n=60)
    df = negatives.vectors(spark.createDataFrame(rows, SCHEMA)).withColumn("score", F.lit("x"))
    assert sorted(tuple(r) for r in negatives.mine(df, F.col("vec_id") % 20 == 0, 2, 3).collect()) == brute(rows, 20, 2, 3)
    empty = negatives.vectors(spark.createDataFrame([], SCHEMA))
    assert negatives.mine(empty, F.col("vec_id") % 10 == 0).collect() == []
    alone = negatives.vectors(spark.createDataFrame(rows[:1], SCHEMA))
    assert negatives.mine(alone, F.col("vec_id") % 10 == 0).collect() == []


def test_scores_stay_exact():
    import numpy as np

    rng = np.random.default_rng(1)
    for size in (100, 1 << 14, 1 << 24):
        a, b = rng.integers(-size, size, (5, 64)), rng.integers(-size, size, (7, 64))
        assert (negatives.products(a, b) == a @ b.T).all()
