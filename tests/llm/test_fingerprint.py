from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa

from loanlens.llm import blocks, fingerprint

from . import helpers

RANKS = np.concatenate([np.full(1000, 8191), np.random.default_rng(0).permutation(fingerprint.LEVELS - 1000)]).astype(np.int32)


def naive_features(raw: bytes) -> list[bytes]:
    """Windows that are the best of at least 16 runs, straight from the definition."""
    if len(raw) < 64:
        return []
    ranks = []
    for i in range(len(raw) - 63):
        terms = sum(round(c * math.log2(c) * 1000) for c in Counter(raw[i : i + 64]).values())
        level = max(0, 6000 - ((terms + 32) >> 6))
        ranks.append(int(RANKS[level]))
    points: Counter = Counter()
    for i in range(len(ranks)):
        run = ranks[i : i + 64]
        best = min(run)
        if best < 8191:
            points[i + run.index(best)] += 1
    return [raw[i : i + 64] for i in sorted(points) if points[i] >= 16]


def test_features_match_the_definition():
    rng = random.Random(3)
    texts = [helpers.prose(rng, n) for n in (5, 40, 90, 200)] + ["", "ab" * 100, "x" * 64, "é" * 40 + helpers.prose(rng, 60)]
    made = fingerprint.fingerprints(pa.array(texts), RANKS)
    for text, digest in zip(texts, made, strict=True):
        distinct = list(dict.fromkeys(naive_features(text.encode())))
        if distinct:
            hashes = np.zeros(len(distinct), np.uint64)
            words = np.array([np.frombuffer(w, np.uint64) for w in distinct])
            for i in range(8):
                hashes = blocks.mix(hashes * np.uint64(0xD6E8FEB86659FD93) + words[:, i])
            assert digest == fingerprint.digest(hashes)
        else:
            assert len(digest) == (fingerprint.FILTER_BYTES if text else 0)


def test_equal_texts_have_equal_digests_in_any_company():
    rng = random.Random(4)
    texts = [helpers.prose(rng, 300) for _ in range(5)]
    together = fingerprint.fingerprints(pa.array([*texts, None, "", *reversed(texts)]), RANKS)
    alone = [fingerprint.fingerprints(pa.array([t]), RANKS)[0] for t in texts]
    assert together[:5] == alone == together[:6:-1]
    huge = helpers.prose(rng, 80000)
    assert fingerprint.fingerprints(pa.array([huge, texts[0]]), RANKS)[1] == alone[0]


def test_likeness():
    rng = random.Random(4)
    one, other = helpers.prose(rng, 1500), helpers.prose(rng, 1500)
    mixed = one[: len(one) // 2] + other[len(other) // 2 :]
    a, b, c, empty = fingerprint.fingerprints(pa.array([one, other, mixed, ""]), RANKS)
    assert fingerprint.likeness(a, a) == 1.0 and fingerprint.likeness(empty, empty) == 1.0
    assert fingerprint.likeness(a, empty) == 0.0
    assert fingerprint.likeness(a, b) < 0.2 < fingerprint.likeness(a, c) < 0.9
    assert fingerprint.likeness(a, c) == fingerprint.likeness(c, a)


def wanted(rows: list[tuple]) -> list[tuple]:
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()), reverse=True)
    out = []
    for i, (doc, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        changed = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        out.append((doc, len(text), hashlib.sha256(changed.encode()).hexdigest()))
    return sorted(out, key=str)


def test_next_documents_and_edits(spark):
    rows = [(r[0], r[1]) for r in helpers.edge_rows()]
    got = fingerprint.compare_with_next(helpers.edge_docs(spark)).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == wanted(rows)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


def test_one_document_and_none(spark):
    docs = spark.createDataFrame([(1, "a single text of some words")], "doc_id long, text string")
    row = fingerprint.compare_with_next(docs).collect()
    assert len(row) == 1 and row[0].near_next == 1.0
    assert fingerprint.compare_with_next(helpers.empty_docs(spark)).count() == 0
