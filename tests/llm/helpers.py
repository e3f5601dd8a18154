"""Small tables with everything that goes wrong in a corpus, and brute-force versions of the operators."""

from __future__ import annotations

import random
import re

SPACE = r"[\x20\x09-\x0D]"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score int, kept int, size int, row int, key int, rep int, weight int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def prose(rng: random.Random, n: int, syllables: str = "the an ing er on tion st sh re ed") -> str:
    parts = syllables.split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n))


def edge_rows(seed: int = 3) -> list[tuple]:
    """Null, empty, blank, one-word, long, repeated, similar and strange texts; a null id, a null source."""
    rng = random.Random(seed)
    base = [prose(rng, 60) for _ in range(12)]
    texts: list[str | None] = [None, "", " \n\t ", "one", "two words", "Café 😀 日本語 \x00 ▁ end", "a" * 5000, *base]
    for text in base[:6]:
        own = text.split(" ")
        own[rng.randrange(len(own))] = "changed"
        texts.append(" ".join(own))
    texts += [base[0], base[0].upper(), "x " * 20000, prose(rng, 15000), "line\nline\nline\nother words here\n\n"]
    texts += [prose(rng, 60, "le la que eau ai oi é en ou ent") for _ in range(8)]
    rows = [(i, t, "fr" if i >= len(texts) - 8 else "en", f"s{i % 3}") for i, t in enumerate(texts)]
    rows += [rows[8], rows[8], (None, "no id here at all", "en", None), (7, "another text under the id seven", None, None)]
    return [(i, t, lang, source, len(t or ""), 1, 2, 3, 4, 5, 6, 7) for i, t, lang, source in rows]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text: str | None, width: int) -> frozenset:
    own = [w.translate(LOWER) for w in words(text)]
    if not own:
        return frozenset()
    if len(own) < width:
        return frozenset([tuple(own)])
    return frozenset(tuple(own[i : i + width]) for i in range(len(own) - width + 1))


def components(rows: list[tuple], width: int, least: int) -> list[tuple]:
    """(doc_id, n_shingles, component) by comparing all pairs of rows; rows of one id and set are one node."""
    nodes = [(i, shingles(t, width)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    # Equal sets stand under their smallest id; an id's other texts keep to themselves.
    rep = {}
    for i, s in sorted(nodes, key=lambda n: n[0]):
        rep.setdefault(s, i)
    filled = [s for s in rep if s]
    for a in range(len(filled)):
        for b in range(a):
            met = len(filled[a] & filled[b])
            if 100 * met >= least * len(filled[a] | filled[b]):
                one, two = sorted((find(rep[filled[a]]), find(rep[filled[b]])))
                parent[two] = one
    return sorted((i, len(s), find(rep[s]) if s else i) for i, s in nodes)
