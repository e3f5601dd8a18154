from __future__ import annotations

import random
import re

import pytest

from loanlens.llm import pii

from . import helpers

# The base patterns as they are specified.
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind: str, value: str) -> bool:
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def base(text: str | None) -> list[tuple]:
    return [
        (k, m.start(), m.end())
        for k in range(4)
        for m in re.finditer(BASE[pii.KINDS[k]], text or "")
        if valid(pii.KINDS[k], m.group())
    ]


def tricky() -> list[str]:
    rng = random.Random(1)
    made = ["".join(rng.choice("0123456789.@+- ()abA_é😀\n%") for _ in range(rng.randint(1, 120))) for _ in range(300)]
    return made + [
        "a@b.cc@d.ee_x@d.ef", "1.2.3.4.5.6.7.8 00001.2.3.0255 999.1.1.1", "é4111111111111111é +12345678",
        "4111 1111 1111 1111-4111-1111-1111-1111 +1 (555) 123-4567 x", "+" * 50 + "1 2 3 4 5 6 7 8 9 ",
        ".a1" * 20000 + "a@" + "b.c" * 20000 + "1" * 50000, "mail me@here.org " * 2000,
    ]


def test_base_spans_match_the_patterns(spark):
    rows = [(i, t) for i, t in enumerate(tricky())]
    got = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        wanted = base(text)
        assert [tuple(s) for s in got[i].base] == wanted
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in wanted) for k in range(4)]
        assert {tuple(s) for s in got[i].base} <= {tuple(s) for s in got[i].found}


def test_edges_and_empty_table(spark):
    docs = helpers.edge_docs(spark)
    got = pii.find(docs).collect()
    assert len(got) == docs.count()
    assert all(r.base == [] and r.found == [] for r in got)
    assert pii.find(helpers.empty_docs(spark)).count() == 0
    out = pii.redact(docs)
    assert out.columns == docs.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, docs.collect()))
    assert pii.redact(helpers.empty_docs(spark)).count() == 0


def test_contexts_discover_unseen_identifiers(spark):
    rng = random.Random(3)
    rows = []
    for i in range(40):
        rows.append((i, f"{helpers.prose(rng, 5)} reach me at user{i}x@mail.org today {helpers.prose(rng, 5)}"))
    # The same context holds a name at a host without a dot; elsewhere that name stands alone.
    rows += [(100, "words then reach me at carol7@intranet today and more"), (101, "note carol7@intranet again")]
    rows += [(102, "version 12.5 of build 2024a"), (103, "nothing here")]
    got = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in ((100, rows[40][1]), (101, rows[41][1])):
        at = text.index("carol7@intranet")
        assert [tuple(s) for s in got[i].found] == [(0, at, at + 15)]
        assert got[i].base == [] and got[i].n_email == 0
    assert got[102].found == [] and got[103].found == []


def test_discovered_values_bring_in_new_patterns(spark):
    rows = [(i, f"you reach me at user{i}x@mail.org today and more") for i in range(40)]
    # Found beside the seeds, these names stand in a second context too, which holds no seed.
    rows += [(100 + i, f"you reach me at name{i}@intranet today and more") for i in range(12)]
    rows += [(200 + i, f"then ping desk via name{i}@intranet promptly or wait") for i in range(12)]
    rows += [(300, "then ping desk via zed9@intranet promptly or wait"), (301, "only zed9@intranet again")]
    rows += [(400 + i, f"the build has version 12.{i} since then") for i in range(12)]
    got = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        at = re.search(r"[a-z0-9]+@[a-z.]+", text)
        assert [tuple(s) for s in got[i].found] == ([(0, at.start(), at.end())] if at else [])


def redacted(text: str | None) -> str | None:
    spans = sorted(((a, b, k) for k, a, b in base(text)))
    islands: list[list] = []
    for a, b, k in spans:
        if islands and a < islands[-1][1]:
            islands[-1][1] = max(islands[-1][1], b)
        else:
            islands.append([a, b, k])
    out, place = "", 0
    for a, b, k in islands:
        out += text[place:a] + f"<{pii.KINDS[k].upper()}>"
        place = b
    return out + text[place:] if islands else text


def test_redaction(spark):
    rows = [(i, t, len(t), 1) for i, t in enumerate(tricky())] + [(5, "x@y.zz 10.0.0.1", 15, 2)] * 2 + [(900, None, 0, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, pii_key int")
    out = pii.redact(docs)
    assert out.columns == docs.columns
    found = sorted(((r.doc_id, r.text, r.n_chars, r.pii_key) for r in out.collect()), key=str)
    wanted = [(i, redacted(t), len(redacted(t) or ""), x) for i, t, _, x in rows]
    assert found == sorted(wanted, key=str)


def test_plan_runs_no_python(spark):
    plan = pii.occurrences(helpers.edge_docs(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("spans", [[], [(0, 1, 5)], [(0, 1, 5), (3, 0, 9)]])
def test_spans_as_text(spark, spans):
    df = spark.createDataFrame([(spans,)], "s array<struct<kind:int,start:long,end:long>>")
    assert df.select(pii.as_text("s").alias("t")).first().t == ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in spans)
