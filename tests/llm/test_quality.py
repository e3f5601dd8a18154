"""The quality classifier: statistics, sums and calibration against plain loops, and held-out rows."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanlens.llm import lang_id, quality, queries
from tests.llm import helpers

SMALL = "/root/testdata/sf0.01"


def plain(text: str | None) -> dict[str, float]:
    data = (text or "").encode()
    words = [w.encode() for w in helpers.words(text)]
    lines = [line for line in data.split(b"\n") if line]
    pairs = list(zip(words, words[1:], strict=False))
    lengths = [len(w) for w in words]
    mean = sum(lengths) / max(1, len(lengths))
    counts = Counter(data)
    return {
        "log_bytes": math.log1p(len(data)),
        "log_words": math.log1p(len(words)),
        "word_spread": math.log1p(math.sqrt(sum((n - mean) ** 2 for n in lengths) / max(1, len(words)))),
        "longest": math.log1p(max(lengths, default=0)),
        "capital_letters": len(re.findall(rb"[A-Z]", data)) / max(1, len(re.findall(rb"[A-Za-z]", data))),
        "same_as_last": sum(a == b for a, b in pairs) / max(1, len(words)),
        "new_words": len(set(words)) / max(1, len(words)),
        "new_pairs": len(set(pairs)) / max(1, len(pairs)),
        "repeated_lines": (len(lines) - len(set(lines))) / max(1, len(lines)),
        "stops": len(re.findall(rb"[.,;:]", data)) / max(1, len(words)),
        "byte_entropy": -sum(n / len(data) * math.log2(n / len(data)) for n in counts.values()),
        "wide_bytes": sum(b > 127 for b in data) / max(1, len(data)),
    }


def test_statistics(spark):
    rows = helpers.edge_rows()
    found = Counter(
        (r["doc_id"], tuple(round(x, 6) for x in r["stats"])) for r in quality.measure(helpers.edge_docs(spark)).collect()
    )
    assert sum(found.values()) == len(rows)
    by_id = {}
    for (i, stats), _ in found.items():
        by_id.setdefault(i, []).append(dict(zip(quality.NAMES, stats, strict=True)))
    for i, text, *_ in rows:
        expected = {k: pytest.approx(v, abs=1e-5) for k, v in plain(text).items()}
        assert any({k: own[k] for k in expected} == expected for own in by_id[i])


def test_sums_are_those_of_all_rows(spark):
    rng = np.random.default_rng(3)
    stats, y = rng.normal(size=(500, 5)), rng.integers(0, 2, 500)
    df = spark.createDataFrame(
        [(s.tolist(), int(t), i % quality.FOLDS) for i, (s, t) in enumerate(zip(stats, y, strict=True))],
        "stats array<double>, y int, fold int",
    ).repartition(6)
    sums = quality.normal_equations(df, lambda s: np.column_stack([s, s**2, np.ones(len(s))]), 11)
    z = np.column_stack([stats, stats**2, np.ones(500)])
    for k in range(quality.FOLDS):
        own = np.arange(500) % quality.FOLDS == k
        assert np.allclose(sums[k], z[own].T @ np.column_stack([z[own], y[own]]))
    weights = quality.solve(sums, 1e-9)
    assert np.allclose(weights[:, -1], np.linalg.lstsq(z, y, rcond=None)[0], atol=1e-5)


def test_isotonic_is_the_best_rising_fit():
    rng = np.random.default_rng(4)
    knots, total = np.arange(12.0), rng.integers(1, 6, 12).astype(float)
    good = np.minimum(rng.integers(0, 6, 12), total).astype(float)
    at, levels = quality.isotonic(knots, good, total)
    assert (np.diff(levels) > 0).all() and (np.diff(at) > 0).all()
    # The min-max formula of isotonic regression.
    share = lambda a, b: good[a : b + 1].sum() / total[a : b + 1].sum()
    exact = [max(min(share(a, b) for b in range(i, 12)) for a in range(i + 1)) for i in range(12)]
    assert np.allclose(sorted(set(np.round(exact, 9))), np.round(levels, 9))


def test_held_out_rows(spark):
    rows = queries.op13_quality(spark, SMALL)
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    own = rows.where("held_out").join(labels, "doc_id").select("quality", "predicted", "score").collect()
    good, bad = [r for r in own if r["quality"] == 1], [r for r in own if r["quality"] == 0]
    assert len(good) > 40 and len(bad) > 5
    assert sum(r["predicted"] for r in good) >= 0.97 * len(good)
    assert sum(1 - r["predicted"] for r in bad) >= 0.6 * len(bad)
    assert rows.count() == 1000


def test_edges(spark):
    docs = helpers.edge_docs(spark)
    stats = quality.measure(docs)
    labels = spark.createDataFrame(
        [(i, i % 2, 0) for i in range(20)] + [(3, 0, 0), (4, None, 0), (None, 1, 0), (5, 7, 0)],
        "doc_id long, quality int, toxic int",
    )
    model = quality.train(stats, labels, ~lang_id.held_out())
    scores = quality.score(stats.withColumn("score", F.lit("x")), model).collect()
    assert len(scores) == docs.count() and all(0 <= r["score"] <= 1 for r in scores)
    again = quality.score(stats, quality.train(stats.repartition(3), labels, ~lang_id.held_out())).collect()
    order = lambda rows: sorted((str(r["doc_id"]), round(r["score"], 6)) for r in rows)
    assert order(scores) == order(again)
    assert quality.train(stats, labels.where("quality = 1"), F.lit(True)) is None
    assert {r["score"] for r in quality.score(stats, None).collect()} == {0.5}
    empty = quality.measure(helpers.empty_docs(spark))
    assert quality.score(empty, model).collect() == [] and quality.train(empty, labels, F.lit(True)) is None
