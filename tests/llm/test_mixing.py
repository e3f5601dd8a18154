from __future__ import annotations

import random

import pytest

from loanlens.llm import mixing

from . import helpers


def reshared(sizes: dict, weights=(3, 1, 2), share=1.5, most=2) -> dict:
    """Targets by dealing the excess again until none is above its stop."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_ = dict.fromkeys(order, 0.0), set(order)
    left = share * sum(sizes.values())
    while open_ and left > 1e-9:
        total = sum(weight[s] for s in open_)
        part = {s: left * weight[s] / total for s in open_}
        left = 0.0
        for s in list(open_):
            target[s] += part[s]
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = float(most * sizes[s])
                open_.remove(s)
    return target


@pytest.mark.parametrize("seed", range(6))
def test_targets_match_resharing(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": rng.choice([0, 5, 100, 1000, 50000]) for i in range(rng.randint(1, 9))}
    if seed % 2:
        sizes[None] = 77
    rows = [(s, n) for s, n in sizes.items()]
    got = mixing.targets(spark.createDataFrame(rows, "source string, source_size long")).collect()
    wanted = reshared(sizes)
    assert {r.source: pytest.approx(r.target, abs=1e-6) for r in got} == wanted


def brute(rows: list[tuple]) -> list[tuple]:
    import hashlib

    sizes: dict = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(helpers.words(text))
    goal = reshared(sizes)
    out = []
    for doc, text, source in rows:
        size = len(helpers.words(text))
        whole = int(goal[source] // sizes[source]) if sizes[source] else 0
        budget = int(goal[source] - whole * sizes[source])
        at = {}
        for other, t, s in rows:
            if s == source:
                h = int(hashlib.md5(("null" if other is None else str(other)).encode()).hexdigest()[:9], 16)
                at[h] = at.get(h, 0) + len(helpers.words(t))
        taken, extra = 0, False
        own = int(hashlib.md5(("null" if doc is None else str(doc)).encode()).hexdigest()[:9], 16)
        for h in sorted(at):
            fits = taken + at[h] <= budget or at[h] < 2 * (budget - taken)
            if h == own:
                extra = fits
            if not fits or taken + at[h] > budget:
                break
            taken += at[h]
        out.append((doc, size, sizes[source], round(goal[source], 6), size * (whole + extra)))
    return sorted(out, key=str)


def test_edges_match_brute_force(spark):
    rows = [(r[0], r[1], r[3]) for r in helpers.edge_rows()]
    got = mixing.mix(helpers.edge_docs(spark)).collect()
    found = sorted(((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in got), key=str)
    assert found == brute(rows)


def test_sources_come_near_their_targets(spark):
    rng = random.Random(4)
    rows = [(i, helpers.prose(rng, rng.randint(1, 80)), "hot" if i % 3 else f"s{i % 7}") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sums: dict = {}
    for r in mixing.mix(docs).collect():
        taken, target = sums.get(r.source, (0, 0))
        sums[r.source] = (taken + r.taken, r.target)
        assert r.taken <= 2 * r.size
    assert all(abs(taken - target) <= 41 for taken, target in sums.values())
    again = {(r.doc_id, r.taken) for r in mixing.mix(docs.repartition(7)).collect()}
    assert again == {(r.doc_id, r.taken) for r in mixing.mix(docs).collect()}


def test_mixed_rows_follow_the_copies(spark, monkeypatch):
    docs = helpers.edge_docs(spark)
    for bound in (mixing.BROADCAST_SOURCES, 0):
        monkeypatch.setattr(mixing, "BROADCAST_SOURCES", bound)
        out = mixing.mixed(docs)
        assert out.columns == docs.columns
        wanted = sum(r.copies for r in mixing.mix(docs).collect())
        assert out.count() == wanted


def test_empty_table(spark):
    assert mixing.mix(helpers.empty_docs(spark)).count() == 0
    assert mixing.mixed(helpers.empty_docs(spark)).count() == 0
