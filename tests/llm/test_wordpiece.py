from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from loanlens.llm import blocks, vocabulary, wordpiece

from . import helpers


def greedy(word: bytes, opening: set, inner: set) -> int:
    """Pieces by longest match first; 0 if a part has no piece."""
    longest = max(map(len, opening | inner), default=0)
    at, count, pieces = 0, 0, opening
    while at < len(word):
        end = next((e for e in range(min(len(word), at + longest), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return 0
        at, count, pieces = end, count + 1, inner
    return count


def counted(machine, words: list[bytes]) -> list[int]:
    data, offsets = blocks.text_bytes(pa.array(words, pa.binary()))
    return wordpiece.count_words(machine, data, offsets[:-1], offsets[1:]).tolist()


def test_random_vocabularies_match_longest_match():
    rng = random.Random(7)
    for _ in range(60):
        def piece():
            return "".join(rng.choice("abc") for _ in range(rng.randint(1, 5))).encode()

        opening, inner = {piece() for _ in range(rng.randint(0, 12))}, {piece() for _ in range(rng.randint(0, 12))}
        words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 14))).encode() for _ in range(200)]
        machine = wordpiece.automaton(sorted(opening), sorted(inner))
        assert counted(machine, words) == [greedy(w, opening, inner) for w in words]


def test_edges_match_longest_match(spark):
    pieces = [p for p in vocabulary.load().pieces if p]
    opening = {p[1:] for p in pieces if p[:1] == b" " and len(p) > 1 and b" " not in p[1:]}
    inner = {p for p in pieces if b" " not in p}
    known: dict = {}
    wanted = []
    for r in helpers.edge_rows():
        sizes = [known.setdefault(w, greedy(w.encode(), opening, inner)) for w in helpers.words(r[1])]
        wanted.append((r[0], len(sizes), sizes.count(0), sum(max(1, s) for s in sizes)))
    got = [tuple(r) for r in wordpiece.count_tokens(helpers.edge_docs(spark)).collect()]
    assert sorted(got, key=str) == sorted(wanted, key=str)


def test_empty_table(spark):
    assert wordpiece.count_tokens(helpers.empty_docs(spark)).count() == 0


def test_words_of_a_block():
    data, offsets = blocks.text_bytes(pa.array([" a  b", None, "", "c\td\n", "é"]))
    starts, ends, rows = blocks.words(data, offsets)
    raw = data.tobytes()
    assert [(raw[a:b], r) for a, b, r in zip(starts, ends, rows, strict=True)] == [
        (b"a", 0), (b"b", 0), (b"c", 3), (b"d", 3), ("é".encode(), 4)
    ]
    hashes = blocks.span_hash(blocks.prefix_hash(data), starts, ends)
    assert len(np.unique(hashes)) == 5
