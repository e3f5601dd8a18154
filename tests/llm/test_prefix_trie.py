"""The prefix trie against a dictionary of all prefixes; running totals with keys over many ranges."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from loanlens.llm import prefix_trie
from loanlens.llm.scan import running

SCHEMA = "conv_id long, turn long, role string, text string, depth int, pos int, a int, part int, ending int, one int"


def sample(seed: int = 4) -> list[tuple]:
    rng = random.Random(seed)
    texts = ["", "Hello", "How are you", "Ünïcode 😀", "no"]
    rows: list[tuple] = []
    for c in [*range(-105, -95), *range(0, 40), 100, 101, 103, 250, 251, *range(300, 330)]:
        for t in range(rng.choice([1, 2, 3, 5, 8])):
            rows.append((c, None if t == 0 and c % 3 == 0 else t, rng.choice(["user", "user", None]), rng.choice(texts[: 2 + t % 3])))
    rows += [(7, 50, None, None), (7, 50, None, None), (None, 1, "user", "of no conversation"), (8, 3, None, "x" * 40000)]
    rows += [(c, t, "user", f"long {t}") for c in (100, 105) for t in range(10, 700)]  # one third of all rows, twice
    rng.shuffle(rows)
    return [(*r, 1, 2, 3, 4, 5, 6) for r in rows]


def brute(rows: list[tuple]) -> list[tuple]:
    own = defaultdict(list)
    for c, t, role, text, *_ in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, v in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        whole[c] = tuple(turns.get(base, [])[:h] + v[h:])
    members, kids = defaultdict(list), defaultdict(list)
    for c, v in whole.items():
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    sums, out = {}, []
    for k in sorted(members, key=len, reverse=True):
        saved = (len(members[k]) - 1) * len(k[-1][1]) if k else 0
        sums[k] = (sum(sums[x][0] for x in kids[k]) or 1, saved + sum(sums[x][1] for x in kids[k]))
        ends = ",".join(str(c) for c in sorted(c for c in members[k] if len(whole[c]) == len(k)))
        parent = min(members[k[:-1]]) if k else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(members[k]), len(k), parent, len(members[k]), len(kids[k]), *sums[k], sha))
    return sorted(out, key=str)


def found(spark, rows: list[tuple]) -> list[tuple]:
    nodes = prefix_trie.build(prefix_trie.opened(spark.createDataFrame(rows, SCHEMA)))
    assert nodes.columns == prefix_trie.COLUMNS
    return sorted((tuple(r) for r in nodes.collect()), key=str)


def test_all_prefixes(spark):
    rows = [r for r in sample() if not (r[0] == 8 and r[3] == "x" * 40000)]
    # Turns of one number with different contents may come either way round, so only equal ones stay here.
    expected = brute(rows)
    assert found(spark, rows) == expected
    assert max(r[3] for r in expected) > 80


def test_a_sketch_without_room_changes_nothing(spark, monkeypatch):
    rows = [r for r in sample(5) if r[0] is None or r[0] < 100]
    rng = np.random.default_rng(2)

    real = prefix_trie.sketch
    expected = brute(rows)
    monkeypatch.setattr(prefix_trie, "sketch", lambda d, n: np.full((4, 1024), 0b10101010, np.uint8))
    assert found(spark, rows) == expected
    # Some cells count too much: single prefixes then lie between grouped ones.
    monkeypatch.setattr(prefix_trie, "sketch", lambda d, n: _raised(real(d, n), rng))
    assert found(spark, rows) == expected


def _raised(cells: np.ndarray, rng) -> np.ndarray:
    counts = np.stack([cells >> s & 3 for s in (0, 2, 4, 6)], axis=-1)
    raised = np.where(rng.random(counts.shape) < 0.8, 2, counts)
    return (raised << np.array([0, 2, 4, 6])).sum(axis=-1).astype(np.uint8)


def test_ties_of_a_turn_number_are_settled_by_content(spark):
    rows = [(1, 5, "user", t, 1, 2, 3, 4, 5, 6) for t in "abcdef"]
    assert found(spark, rows) == found(spark, rows[::-1])


def test_small_and_empty_tables(spark):
    assert found(spark, []) == []
    one = [(6, None, None, None, 1, 2, 3, 4, 5, 6)]
    assert found(spark, one) == brute(one)
    twice = [(c, 0, "user", "same", 1, 2, 3, 4, 5, 6) for c in range(60)]
    assert found(spark, twice) == brute(twice)


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_running_totals(spark, partitions):
    rng = random.Random(1)
    rows = [(rng.choice([3, 3, 3, 3, -1, 9, 10]), i, rng.randrange(100), rng.getrandbits(63)) for i in range(3000)]
    expected, sums, xors = [], defaultdict(int), defaultdict(int)
    for k, i, v, w in rows:
        sums[k] += v
        xors[k] ^= w
        expected.append((k, i, v, w, sums[k], xors[k]))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "k long, part long, v long, w long").repartition(5)
        out = running(df, "k", ["part"], {"total": "v"}, {"mixed": "w"})
        assert sorted(tuple(r) for r in out.collect()) == sorted(expected)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
