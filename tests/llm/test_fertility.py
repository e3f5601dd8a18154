from __future__ import annotations

import math
import random
from collections import Counter

import sentencepiece

from loanlens.llm import fertility, vocabulary

from . import helpers


def base(text: str | None) -> tuple:
    text = text or ""
    own = helpers.words(text)
    lines = [x for x in text.split("\n") if helpers.words(x)]
    windows = [tuple(own[i : i + 5]) for i in range(len(own) - 4)]
    times = Counter(windows)
    again = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 5)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(own) < 10 or 100 * len(again) > 20 * len(own)
    return len(own), sum(map(len, own)), symbols, len(lines) - len(set(lines)), len(again), failed


def test_edges_match_brute_force(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary.DEFAULT_MODEL)
    wanted = []
    for r in helpers.edge_rows():
        ids = [i for w in helpers.words(r[1]) for i in model.encode(w)]
        entropy = -sum(n / len(ids) * math.log2(n / len(ids)) for n in Counter(ids).values())
        wanted.append((r[0], *base(r[1]), len(ids), sum(model.is_byte(i) for i in ids), round(abs(entropy), 6)))
    got = [
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.n_tokens,
         r.n_byte_tokens, round(abs(r.token_entropy), 6))
        for r in fertility.judge(helpers.edge_docs(spark)).collect()
    ]
    assert sorted(got, key=str) == sorted(wanted, key=str)


def test_lines_and_windows_of_neighbouring_rows(spark):
    rng = random.Random(8)
    words = "a b c d".split()
    texts = ["".join(rng.choice([*words, " ", "\n", " ", "\n"]) for _ in range(rng.randint(0, 80))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in fertility.judge(docs).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(texts[r.doc_id])


def test_bands_keep_prose_and_reject_codes(spark):
    rng = random.Random(8)
    rows = [(i, helpers.prose(rng, rng.randint(30, 60))) for i in range(200)]
    rows.append((500, " ".join("".join(rng.choice("0123456789abcdefXYZ@~^") for _ in range(20)) for _ in range(12))))
    rows.append((501, " ".join("𓀀𓁀𓂀" for _ in range(11)) + " words " + helpers.prose(rng, 30)))
    kept = {r.doc_id: r.kept for r in fertility.judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(kept[i] for i in range(200)) and not kept[500] and not kept[501]


def test_bands_reject_symbol_junk_and_lone_classes(spark):
    rng = random.Random(4)
    french = "le la que eau ai oi é en ou ent"
    rows = [(i, helpers.prose(rng, rng.randint(30, 60)), "en") for i in range(150)]
    rows += [(200 + i, helpers.prose(rng, rng.randint(30, 60), french), "fr") for i in range(150)]
    junk = " ".join(w + rng.choice(["$$$", "###", "&&&"]) for w in helpers.prose(rng, 45).split())
    rows += [(500, junk, "en"), (501, junk, "fr"), (502, " | ".join(helpers.prose(rng, 40).split()), "en")]
    # Alone in their length, script or language: these must not set their own bands.
    rows += [(503, " ".join(w + "$$$" for w in helpers.prose(rng, 5000).split()), "en")]
    rows += [(504, " ".join("".join(chr(rng.randrange(0x2C80, 0x2CE0)) for _ in range(9)) for _ in range(30)), "en")]
    rows += [(505, junk, "xx"), (506, helpers.prose(rng, 40), "yy"), (507, helpers.prose(rng, 11), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id: r.kept for r in fertility.judge(docs).collect()}
    assert [i for i, k in kept.items() if k != (i < 500 or i > 505)] == []


def test_empty_table(spark):
    assert fertility.judge(helpers.empty_docs(spark)).count() == 0


def test_quartiles_are_exact_however_rows_are_dealt_out(spark):
    rng = random.Random(8)
    rows = [(rng.choice("ab"), *(rng.choice([rng.random(), 0.5, 2.0]) for _ in fertility.FLOORS)) for _ in range(4001)]
    schema = "pool string, " + ", ".join(f"{m} double" for m in fertility.FLOORS)
    found = []
    for parts in (1, 3, 8):
        df = spark.createDataFrame(rows, schema).repartition(parts)
        found.append({r["pool"]: r for r in fertility.quartiles(df, ["pool"]).collect()})
    assert found[0] == found[1] == found[2]
    for pool in "ab":
        for i, m in enumerate(fertility.FLOORS):
            own = sorted(round(r[i + 1], 4) for r in rows if r[0] == pool)
            exact = [own[-(-len(own) * q // 4) - 1] for q in (1, 3)]
            assert [round(x, 4) for x in found[0][pool][m]] == exact


def test_the_verdict_follows_the_bands(spark):
    """kept against bands by exact quartiles, for a corpus of one class."""
    rng = random.Random(9)
    texts = [helpers.prose(rng, 120) for _ in range(80)] + ["### " * 30 + helpers.prose(rng, 90), helpers.prose(rng, 5)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = fertility.judge(docs).collect()
    passing = [r for r in rows if not r["base_failed"] and r["length_class"] == rows[0]["length_class"]]
    assert len(passing) >= fertility.LEAST_TEXTS and not rows[0]["base_failed"]
    for r in rows:
        if r["base_failed"]:
            assert not r["kept"]
        for m in fertility.FLOORS:
            if r["kept"]:
                assert r[f"{m}_low"] <= r[m] <= r[f"{m}_high"]
    bad = next(r for r in rows if r["doc_id"] == 80)
    assert not bad["kept"] and sum(r["kept"] for r in rows) >= 76
