"""Metric steps: hand-made edges, stored runs, and relations between metrics."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from conftest import TINY, rows
from pyspark.sql import functions as F

from loanlens.functions.dates import AsOf, month_end, month_start
from loanlens.operators import ratios as R
from loanlens.operators import snapshots as S
from loanlens.plans import monthly as M
from loanlens.plans.catalog import AT, Sample

FACTS = (
    "Merch_Store_Id string, Subproduct string, Appl_No bigint, Cust_SSN string, Status string, "
    "From_Date date, To_Date date, Ref_Date date"
)
STORES = (
    "Merchant_Store_Id string, Product string, Business_Unit string, Region string, Province_State string, Store string"
)
STORE_ROWS = [
    ("z", "Zip", "Retail", "R1", "P1", "Store z"),
    ("m", "Mini Money", "Online", "R1", "P1", "Store m"),
    ("t", "Thurlow", "Retail", "R1", "P1", "Store t"),
]


def span(appl, ssn, first, last, status="Active", store="z"):
    return (store, "Zip 30" if store == "z" else "x", appl, ssn, status, first, last, first)


def placed(spark, facts):
    return S.facts_with_store(spark.createDataFrame(facts, FACTS), spark.createDataFrame(STORE_ROWS, STORES))


def test_month_arithmetic():
    assert month_start(date(2001, 1, 31), -1) == date(2000, 12, 1)
    assert month_end(date(2000, 1, 31), 1) == date(2000, 2, 29)
    at = AsOf(date(2001, 6, 15), 6)
    assert (at.window_opens_after, at.month, at.month_close) == (date(2000, 12, 31), date(2001, 6, 1), date(2001, 6, 30))


def test_span_counts_at_the_starts_it_covers(spark):
    at = AsOf(date(2001, 6, 15), 3)
    facts = placed(
        spark,
        [
            span(1, "a", date(2001, 3, 1), date(2001, 5, 1)),  # starts on a bound: not open there
            span(2, "a", date(2001, 4, 10), date(2001, 4, 30)),  # inside one month: never open at a bound
            span(3, "b", date(2001, 5, 2), date(2001, 4, 1)),  # ends before it starts
            span(4, "b", date(1999, 1, 1), date(2009, 1, 1)),
        ],
    )
    found = S.snapshots(S.month_bounds(facts, at), at, False)
    counted = {(r.Metric, r.Dateref): (int(r.Value_Cust), int(r.Value_Loan)) for r in found.collect()}
    assert counted[("Active BOM", date(2001, 4, 1))] == (2, 2)
    assert counted[("Active BOM", date(2001, 5, 1))] == (2, 2)
    assert counted[("Active BOM", date(2001, 6, 1))] == (1, 1)
    assert counted[("Active EOM", date(2001, 6, 1))] == (1, 1)
    assert ("Active EOM", date(2001, 3, 1)) not in counted


def test_online_small_loans_have_no_place(spark):
    found = placed(spark, [span(1, "a", AT.day, AT.day, store="m")]).collect()[0]
    assert (found.Province, found.Store, found.Region) == (" ", " ", "R1")


def test_mini_only_needs_the_same_moment_and_class(spark):
    at = AsOf(date(2001, 6, 15), 2)
    long_ago, later = date(2000, 1, 1), date(2001, 12, 31)
    facts = placed(
        spark,
        [
            span(1, "a", long_ago, later, store="m"),
            span(2, "a", long_ago, date(2001, 5, 15), store="t"),
            span(3, "b", long_ago, later, store="m"),
            span(4, "b", long_ago, later, "Collections", store="z"),
        ],
    )
    found = S.snapshots(S.mini_only_spans(S.month_bounds(facts, at)), at, True, ["BOM"])
    counted = {(r.Metric, r.Dateref): int(r.Value_Cust) for r in found.collect()}
    assert counted == {("Active BOM", date(2001, 5, 1)): 1, ("Active BOM", date(2001, 6, 1)): 2}
    assert {r.Product for r in found.collect()} == {"Mini Money Only"}


def test_default_of_two_kinds_counts_once_in_any(spark):
    day = date(2001, 5, 10)
    facts = placed(spark, [span(1, "a", day, day, "Default_C"), span(2, "a", day, day, "Default_P")])
    found = {r.Metric: int(r.Value_Cust) for r in S.flow_counts(S.window_events(facts, AT), False).collect()}
    assert found == {"Default (Charges)": 1, "Default (Principal)": 1, "Default (Any)": 1}


def stored(spark, *values, dims=("Retail", "Zip", "R1", "P1", "S1")):
    schema = (
        "Business_Unit string, Product string, Region string, Province string, Store string, Metric string, "
        "Dateref date, Value_Cust decimal(21,3), Value_Loan decimal(21,3), AsOf_Date date"
    )
    return spark.createDataFrame([(*dims, m, d, Decimal(v), Decimal(v), None) for m, d, v in values], schema)


def test_ratio_over_zero_is_null_and_rounds_half_up(spark):
    d, e = date(2001, 5, 1), date(2001, 4, 1)
    table = stored(spark, ("Active BOM", d, 0), ("Paid Off", d, 3), ("Active BOM", e, 16), ("Paid Off", e, 1))
    found = R.ratios(table, False, R.levels(False)[:1], False, ["Paid Off"])
    assert {r.Dateref: r.Value_Cust for r in found.collect()} == {d: None, e: Decimal("0.063")}


def test_gap_is_zero_where_nothing_was_observed(spark):
    d = date(2001, 5, 1)
    table = stored(spark, ("Active BOM", d, 10), ("New", d, 2))
    found = {r.Metric: r.Value_Cust for r in R.roll_forward(table, False, False).collect()}
    assert found["Active EOM Calculated"] == 12 and found["Active EOM Delta"] == 0


def test_rolled_up_rows_take_no_part_in_store_metrics(spark):
    d = date(2001, 5, 1)
    table = stored(spark, ("Active BOM", d, 10), dims=("Retail", "Zip", " ", " ", " "))
    assert R.roll_forward(table, False, False).count() == 0


@pytest.fixture(scope="module")
def sample(spark):
    return Sample(spark, TINY)


@pytest.mark.parametrize("kind", [M.V1, M.V2])
def test_run_meets_its_own_books(spark, sample, kind):
    table = sample.stored_before(kind, None)
    key = M.metric_key(kind)
    assert table.groupBy(*key).count().filter("count > 1").count() == 0
    wide = (
        table.filter("Region <> ' '")
        .groupBy(*S.dimensions(kind.with_subproduct), "Dateref")
        .pivot("Metric", ["Active EOM", "Active EOM Calculated", "Active EOM Delta", "Gross Churn", "Net Churn", "Reactivated"])
        .agg({"Value_Cust": "sum"})
    )
    broken = wide.filter(
        "(`Active EOM` <> 0 AND `Active EOM` <> `Active EOM Calculated` + `Active EOM Delta`) "
        "OR `Gross Churn` - coalesce(Reactivated, 0) <> `Net Churn`"
    )
    assert broken.count() == 0


def test_second_run_replaces_its_keys_and_keeps_stale_ones(spark, sample):
    first = sample.stored_before(M.V1, None)
    stale = stored(spark, ("Retired", date(2001, 5, 1), 7), dims=(" ", " ", " ", " ", " "))
    old_projection = stored(spark, ("Retired Proj", date(2001, 5, 1), 7), dims=(" ", " ", " ", " ", " "))
    wrong = first.withColumn("Value_Cust", (first.Value_Cust + 1).cast("decimal(21,3)"))
    before = wrong.unionByName(stale).unionByName(old_projection)
    again = M.run(sample.facts(), sample.dim_merchant(), AT, M.V1, stored=before)
    columns = [c for c in first.columns if c != "AsOf_Date"]
    kept = again.filter("Metric LIKE 'Retired%'")
    assert rows(kept, *columns) == rows(stale, *columns)
    assert rows(again.filter("Metric NOT LIKE 'Retired%'"), *columns) == rows(first, *columns)


def test_update_leaves_the_stored_day_of_derived_metrics(spark, sample):
    first = sample.stored_before(M.V1, None)
    day = date(1990, 1, 1)
    dated = first.withColumn("AsOf_Date", F.lit(day))
    again = M.run(sample.facts(), sample.dim_merchant(), AT, M.V1, stored=dated, until="churn")
    derived = again.filter("Metric IN ('Active EOM Delta', 'New Pct')").select("AsOf_Date").distinct()
    flows = again.filter("Metric = 'New'").select("AsOf_Date").distinct()
    assert rows(derived) == [(day,)] and (day,) not in rows(flows)
