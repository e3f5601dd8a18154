from __future__ import annotations

import random
import re

import corpus_pipeline
import pytest

from loanlens.llm import mixing, queries
from loanlens.session import written

from . import helpers


def corpus() -> list[tuple]:
    rng = random.Random(12)
    french = "le la que eau ai oi é en ou ent"
    rows = [(i, helpers.prose(rng, 50), "en", f"s{i % 4}") for i in range(80)]
    rows += [(100 + i, helpers.prose(rng, 50, french), "fr" if i else None, f"s{i % 4}") for i in range(80)]
    rows += [(300 + i, rows[i][1] + " tail", "en", "s0") for i in range(10)]
    rows += [(400, "call +1 (555) 123-4567 or mail me.too@host.org " + rows[3][1][:200], "en", "s1")]
    rows += [(500, None, "en", "s1"), (501, "", "en", "s1"), (502, "12 34 -- 56", "en", "s2"), (503, "zq xj vk wz " * 30, "en", "s2")]
    rows += [rows[0], (None, helpers.prose(rng, 30), "en", None)]
    return [(i, t, lang, s, len(t or ""), 1) for i, t, lang, s in rows]


def test_stages_follow_their_operators(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string, lang string, source string, n_chars int, score int")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "personal_data", "mixing", "sentencepiece"]

    lettered = written(stages["language_id"](spark, docs, ""), "stage")
    ids = [r.doc_id for r in lettered.collect()]
    assert lettered.columns == columns and not {500, 501, 502} & set(ids)
    assert set(ids) >= set(range(80)) | set(range(100, 180)) | {400, None}
    assert lettered.where("doc_id = 100").first().lang == "fr"

    single = written(stages["near_duplicates"](spark, lettered, ""), "stage")
    rows = [(r.doc_id, r.text) for r in lettered.collect()]
    wanted = {c for _, _, c in helpers.components(rows, 5, 80)}
    kept = [r.doc_id for r in single.collect()]
    assert single.columns == columns and sorted(k for k in kept if k is not None) == sorted(wanted) and kept.count(None) == 1
    assert not set(kept) & set(range(300, 310))

    clean = written(stages["personal_data"](spark, single, ""), "stage")
    assert clean.columns == columns and clean.count() == single.count()
    before = {r.doc_id: r.text for r in single.collect()}
    for r in clean.collect():
        assert r.n_chars == len(r.text)
        if r.doc_id == 400:
            assert r.text.startswith("call <PHONE> or mail <EMAIL> ")
        else:
            assert r.text == before[r.doc_id]

    mixed = written(stages["mixing"](spark, clean, ""), "stage")
    assert mixed.columns == columns
    copies = {r.doc_id: r.copies for r in mixing.mix(clean).collect()}
    found: dict = {}
    for r in mixed.collect():
        found[r.doc_id] = found.get(r.doc_id, 0) + 1
    assert found == {i: n for i, n in copies.items() if n}

    last = stages["sentencepiece"](spark, mixed, "").collect()
    assert len(last) == mixed.count() and all(r.lossless and r.n_pieces == len(r.ids) for r in last)


def test_run_over_a_folder_and_an_empty_table(spark, tmp_path):
    docs = spark.createDataFrame(corpus()[:60], "doc_id long, text string, lang string, source string, n_chars int, score int")
    docs.write.parquet(f"{tmp_path}/full/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/full").count() > 0
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_queries_are_registered():
    names = sorted(queries.llm_queries(), key=lambda n: int(re.match(r"op(\d+)_", n)[1]))
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in names] == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.llm_oracles()))
def test_queries_match_their_sql(spark, name):
    from oracle.compare import bag, database

    from . import helpers as _  # noqa: F401

    folder = "/root/testdata/sf0.001"
    df = queries.llm_queries()[name](spark, folder)
    found = database(folder).execute(queries.llm_oracles()[name])
    names = [c[0] for c in found.description]
    assert bag(df.columns, df.collect()) == bag(names, found.fetchall())
