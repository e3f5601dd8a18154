"""Interval joins against all pairs; typed rejects with several faults; runs that go on where they broke off."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from conftest import TINY, rows

from loanlens.operators.intervals import interval_join
from loanlens.operators.rejects import Field, TooManyRejects, load_checked
from loanlens.plans import monthly as M
from loanlens.plans.catalog import AT, Sample
from loanlens.plans.resume import Stages


@pytest.mark.parametrize(("closed", "seed"), [(False, 1), (True, 2)])
def test_every_pair_that_holds(spark, closed, seed):
    rng = random.Random(seed)
    start = datetime(2001, 1, 1)

    def moment(days: float) -> datetime | None:
        return None if rng.random() < 0.03 else start + timedelta(seconds=round(rng.random() * days * 86400), microseconds=rng.choice([0, 0, 5]))

    points = [(i, rng.choice("aab"), moment(60)) for i in range(150)]
    points += [(1000 + i, "a", start + timedelta(days=3)) for i in range(80)]  # a hot moment
    spans = []
    for i in range(120):
        first = moment(60)
        length = rng.choice([timedelta(0), timedelta(seconds=1), timedelta(hours=5), timedelta(days=9), timedelta(days=40000), -timedelta(days=1)])
        spans.append((i, rng.choice("ab"), first, None if first is None else first + length))
    spans += [(900, "a", start + timedelta(days=3), start + timedelta(days=3)), (901, None, start, start + timedelta(days=50))]
    p = spark.createDataFrame(points, "n int, k string, at timestamp_ntz")
    s = spark.createDataFrame(spans, "m int, k string, first timestamp_ntz, last timestamp_ntz")
    found = interval_join(p, s, "at", "first", "last", ["k"], finest=3600, closed=closed)
    assert found.columns == ["n", "k", "at", "m", "first", "last"]
    expected = sorted(
        (n, m) for n, k, at in points for m, k2, a, b in spans
        if k == k2 and None not in (at, a, b) and a <= at and (at <= b if closed else at < b)
    )
    assert rows(found, "n", "m") == sorted(expected, key=str) and len(expected) > 500
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert interval_join(p, s.limit(0), "at", "first", "last", ["k"]).count() == 0


FIELDS = [Field("k", "bigint", required=True, low="0"), Field("d", "date"), Field("s", "string", required=True, width=2)]
RAW = [("1", "2001-01-01", "ab"), ("x", "2001-02-30", "abc"), (None, None, "a"), ("-4", "", None), ("5", None, ""), ("99999999999999999999", None, "a")]


def test_all_faults_of_a_row_are_named(spark):
    good, bad, counts = load_checked(spark, spark.createDataFrame(RAW, "k string, d string, s string"), FIELDS)
    assert dict(good.dtypes) == {"k": "bigint", "d": "date", "s": "string"}
    assert rows(good, "k", "s") == [(1, "ab"), (5, "")]
    found = {r["k"]: [(f["column"], f["errorCode"]) for f in r["faults"]] for r in bad.collect()}
    assert found == {
        "x": [("k", "BAD_TYPE"), ("d", "BAD_TYPE"), ("s", "TOO_WIDE")],
        None: [("k", "KEY_NULL")],
        "-4": [("k", "OUT_OF_RANGE"), ("d", "BAD_TYPE"), ("s", "KEY_NULL")],
        "99999999999999999999": [("k", "BAD_TYPE")],
    }
    assert counts == {"rows": 6, "rejected": 4}


def test_too_many_rejects_stop_the_load(spark):
    table = spark.createDataFrame(RAW, "k string, d string, s string")
    with pytest.raises(TooManyRejects, match="4 of 6"):
        load_checked(spark, table, FIELDS, most=0.5)
    good, bad, counts = load_checked(spark, table.limit(0), FIELDS, most=0.0)
    assert good.count() == bad.count() == 0 and counts == {"rows": 0, "rejected": 0}


def test_a_broken_run_goes_on(spark, tmp_path):
    sample = Sample(spark, TINY)
    folder = tmp_path / "run"
    tables = sample.facts(), sample.dim_merchant(), AT, M.V1
    first = Stages(spark, str(folder), "today", AT)

    def broken(df, name):
        if name.endswith("stage2"):
            raise InterruptedError(name)
        return first(df, name)

    with pytest.raises(InterruptedError):
        M.run(*tables, cut=broken)
    written = {p: p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}
    assert {p.parent.name.split("-stage")[1][0] for p in written} == {"0", "1"}

    second = Stages(spark, str(folder), "today", AT)
    result = second.finish(lambda: rows(M.run(*tables, cut=second)))
    assert second.reused == ["v1-stage0", "v1-stage1"]
    assert result == rows(M.run(*tables))
    assert not Path(folder).exists()

    # Other input, other tables; a table without Spark's mark is written again.
    third = Stages(spark, str(folder), "today", AT)
    third(spark.range(3), "s")
    assert not Stages(spark, str(folder), "tomorrow", AT).done("s") and third.done("s")
    for mark in folder.rglob("_SUCCESS"):
        mark.unlink()
    assert rows(third(spark.range(2), "s")) == [(0,), (1,)] and third.reused == []
