"""Registered queries against their SQL, on data in which single keys hold a third of the rows."""

from __future__ import annotations

import pytest
from conftest import TINY

import __spark_entry__ as entry
from oracle.compare import database, difference
from oracle.skew import skewed

COMPARED = [
    "src_calendar", "sink_upsert", "sink_reject",
    "L02_collections", "L09_default_m_payment", "L12_react", "L16_paidrel_2", "L18_renewed_2", "L20_fact_load",
    "M01_bom_snapshot_v1", "M04_eom_mtd_v2", "M05_flow_counts_v1", "M12_charged_off_pct_v2", "M18_collections_eom_delta_v2",
    "M24_flow_projection_v2", "M37_mini_only_snapshots", "M38_mini_only_flows", "M42_mini_only_churn_pct_proj",
    "monthly_run_v1", "monthly_run_v2_six_months",
    "A02_loan_fincharge", "A09_pay_fincharge", "A11_pay_fees", "A22_ach_processed", "A35_status_new_principal",
    "A39_return_item_count", "A41_accounting_extract",
]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return skewed(TINY, str(tmp_path_factory.mktemp("skewed")))


@pytest.fixture(scope="module")
def con(folder):
    return database(folder)


def test_every_query_has_sql():
    """All but training-data operators that SQL can't express, where these are present."""
    missing = set(entry.queries()) - set(entry.oracle_sql())
    assert all(name == "pipeline" or name.startswith("op") for name in missing)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", COMPARED)
def test_query_equals_sql_and_joins_on_keys(spark, folder, con, name):
    df = entry.queries()[name](spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    count, found = difference(df, con, entry.oracle_sql()[name])
    assert not found and count


def test_entry(spark):
    assert entry.entry(spark).count() > 0
