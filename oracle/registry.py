"""Oracle SQL by query name."""

from __future__ import annotations

from oracle import loan_sql as L
from oracle.metric_sql import RATIOS, MetricSql


REJECTS = """
WITH raw AS (
  SELECT CASE WHEN o_orderkey % 29 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN 'N' || o_orderkey ELSE o_orderkey::VARCHAR END AS Appl_No,
         CASE WHEN o_orderkey % 17 = 0 THEN '12,5' WHEN o_orderkey % 31 = 0 THEN '-1'
              ELSE o_totalprice::DECIMAL(12,2)::VARCHAR END AS Req_Loan_Amt,
         CASE WHEN o_orderkey % 19 = 0 THEN '2001-13-45' ELSE o_orderdate::DATE::VARCHAR END AS Origin_Date,
         CASE WHEN o_orderkey % 23 = 0 THEN o_orderstatus || 'x' WHEN o_orderkey % 37 = 0 THEN NULL ELSE o_orderstatus END AS Loan_Status
  FROM orders
), judged AS (
  SELECT *, list_filter([
    CASE WHEN Appl_No IS NULL THEN {'c': 'KEY_NULL', 'm': 'column Appl_No must not be null'}
         WHEN TRY_CAST(Appl_No AS BIGINT) IS NULL THEN {'c': 'BAD_TYPE', 'm': 'column Appl_No is not of type bigint'} END,
    CASE WHEN Req_Loan_Amt IS NOT NULL AND TRY_CAST(Req_Loan_Amt AS DECIMAL(12,2)) IS NULL
           THEN {'c': 'BAD_TYPE', 'm': 'column Req_Loan_Amt is not of type decimal(12,2)'}
         WHEN TRY_CAST(Req_Loan_Amt AS DECIMAL(12,2)) < 0 THEN {'c': 'OUT_OF_RANGE', 'm': 'column Req_Loan_Amt is below 0'}
         WHEN TRY_CAST(Req_Loan_Amt AS DECIMAL(12,2)) > 350000 THEN {'c': 'OUT_OF_RANGE', 'm': 'column Req_Loan_Amt is above 350000'} END,
    CASE WHEN Origin_Date IS NULL THEN {'c': 'KEY_NULL', 'm': 'column Origin_Date must not be null'}
         WHEN TRY_CAST(Origin_Date AS DATE) IS NULL THEN {'c': 'BAD_TYPE', 'm': 'column Origin_Date is not of type date'} END,
    CASE WHEN Loan_Status IS NULL THEN {'c': 'KEY_NULL', 'm': 'column Loan_Status must not be null'}
         WHEN length(Loan_Status) > 1 THEN {'c': 'TOO_WIDE', 'm': 'column Loan_Status is longer than 1'} END
  ], lambda f: f IS NOT NULL) AS faults FROM raw
)
SELECT Appl_No, Req_Loan_Amt, Origin_Date, Loan_Status,
       array_to_string(list_transform(faults, lambda f: f.c), ', ') AS "errorCode",
       array_to_string(list_transform(faults, lambda f: f.m), ', ') AS "errorMessage"
FROM judged WHERE len(faults) > 0
"""

EVENT_PERIODS = """
WITH periods AS (
  SELECT n_nationkey::INT AS period, TIMESTAMP '2024-01-01' + to_hours(24 * n_nationkey::INT + 7 * (n_nationkey % 5)::INT) AS opens,
         to_hours([5, 40, 200][n_nationkey % 3 + 1] + n_nationkey::INT) AS length FROM nation
)
SELECT period, event_type, count(*) AS events, sum(value::DECIMAL(12,2))::DOUBLE AS total
FROM events JOIN periods ON ts >= opens AND ts < opens + length GROUP BY period, event_type
"""


def _status() -> dict[str, str]:
    names = {
        "L01_active": "Active", "L02_collections": "Collections", "L03_collections_m": "Collections_M",
        "L04_bankrupt": "Bankrupt", "L05_charged_off": "Charged off", "L06_default_c": "Default_C",
        "L07_default_p": "Default_P", "L08_default_m_status": "Default_M",
        "L09_default_m_payment": "Default_M by payment", "L10_due": "Due", "L11_new": "New", "L12_react": "React",
        "L13_paid_d": "Paid_D", "L14_paid_p": "Paid_P", "L15_paidrel_1": "PaidRel_1", "L16_paidrel_2": "PaidRel_2",
        "L17_renewed_1": "Renewed_1", "L18_renewed_2": "Renewed_2",
    }
    found = {op: L.status_sql(name) for op, name in names.items()}
    void = "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority LIKE '4%'"
    due = L.status_sql("Due").replace("WHEN '4' THEN 'V'", "WHEN '4' THEN 'O'")
    found["L19_void_purge"] = f"SELECT * FROM ({due}) WHERE Appl_No NOT IN ({void})"
    found["L20_fact_load"] = L.fact_sql()
    found["fact_load_second_run"] = L.second_run_sql()
    found["fact_load_changes"] = L.changes_sql()
    return found


def _tables() -> dict[str, str]:
    with_tables = f"WITH {L.TABLES}"
    calendar = (
        f"WITH {L.LOAN}, days AS (SELECT unnest(generate_series(date_trunc('month', min(origin)), "
        "last_day(max(origin))::TIMESTAMP, INTERVAL 1 DAY))::DATE AS d FROM loan), "
        "months AS (SELECT d, date_trunc('month', d)::DATE AS m FROM days)"
    )
    active = L.STATUS["Active"]
    prior = active.replace("2001-06-15", "2001-05-15")
    void = "SELECT appl FROM loan WHERE status = 'V'"
    return {
        "src_table": (
            f"WITH {L.LOAN} SELECT appl AS Appl_No, store_id AS Merch_Store_Id, cust AS Cust_Id, ssn AS Cust_SSN, "
            f"{L.day('origin', 'Origin_Date')}, {L.day('due', 'Req_Due_Date')}, status AS Loan_Status, "
            "kind AS Loan_Type, amount::DOUBLE AS Req_Loan_Amt, charge::DOUBLE AS Fin_Charge, "
            f"{L.day('last_paid', 'LastPmtDate')}, {L.day('changed', 'Last_Modified')}, renews AS Ren_ApplNo FROM loan"
        ),
        "src_calendar": (
            f"{calendar} SELECT {L.day('d', 'Date')}, {L.day('m', 'Month_Start')}, {L.day('last_day(d)', 'Month_End')}, "
            f"{L.day('m - 1', 'Prev_Month_End')} FROM months WHERE {L.in_window('d')}"
        ),
        "src_month_starts": (
            f"{calendar} SELECT DISTINCT {L.day('m', 'Month_Start')} FROM months "
            f"WHERE d > {L.OPENS_AFTER} AND d <= {L.AS_OF}"
        ),
        "sink_upsert": (
            f"{with_tables}, fresh AS ({active}), old AS ({prior}) SELECT {L.FACT_OUT} FROM ("
            "SELECT * FROM fresh UNION ALL SELECT * FROM old o WHERE NOT EXISTS (SELECT 1 FROM fresh f "
            "WHERE f.store_id = o.store_id AND f.sub = o.sub AND f.appl = o.appl AND f.ssn = o.ssn))"
        ),
        "sink_delete_window": (
            f"{with_tables} SELECT {L.FACT_OUT} FROM ({L.STATUS['Due']} UNION ALL {active}) "
            f"WHERE NOT (status = 'Due' AND d3 > last_day({L.AS_OF} - INTERVAL 3 MONTH))"
        ),
        "sink_delete_by_key": (
            f"WITH {L.LOAN}, {L.PAY} SELECT appl AS Appl_No, {L.day('paid_on', 'Pmt_Date')}, kind AS Pmt_Type, "
            f"principal::DOUBLE AS Principle_Paid FROM pay WHERE appl NOT IN ({void})"
        ),
        "sink_reject_typed": REJECTS,
        "interval_event_periods": EVENT_PERIODS,
        "interval_open_loans": (
            f"WITH {L.FACT}, days AS (SELECT DATE '2000-06-05' + (14 * n_nationkey + 2 * (n_nationkey % 4))::INT AS d FROM nation) "
            f"SELECT {L.day('d', 'day')}, product AS Product, count(DISTINCT ssn) AS customers, count(DISTINCT appl) AS loans "
            "FROM fact JOIN store USING (store_id) JOIN days ON d1 <= d AND d <= d2 WHERE status = 'Active' GROUP BY d, product"
        ),
        "sink_reject": (
            f"{with_tables} SELECT store_id AS Merch_Store_Id, sub AS Subproduct, appl AS Appl_No, ssn AS Cust_SSN, "
            "status AS Status, 'KEY_NULL' AS \"errorCode\", 'column Subproduct must not be null' AS \"errorMessage\" "
            "FROM spine WHERE sub IS NULL"
        ),
    }


def _metric_set(name: str) -> dict[str, str]:
    q = MetricSql(name)
    base = {
        "M01_bom_snapshot": q.bom(),
        "M02_eom_snapshot": q.eom(),
        "M05_flow_counts": q.flows(),
        "M06_default_any": q.flows(True),
        "M24_flow_projection": q.flow_proj(),
        "M25_default_any_projection": q.flow_proj(True),
    }
    base["M04_eom_mtd" if q.v2 else "M03_eom_zero_current"] = q.eom_to_date() if q.v2 else q.eom_zero()
    found = {op: q.query("base", lambda s, b=b: b) for op, b in base.items()}
    ops = [
        "M07_default_principal_pct", "M08_paid_off_pct", "M09_reactivated_pct", "M10_new_pct", "M11_reloaned_pct",
        "M12_charged_off_pct", "M13_default_any_pct", "M14_paid_after_default_pct",
    ]
    for op, m in zip(ops, RATIOS, strict=True):
        found[op] = q.query("derived", lambda s, m=m: q.ratio(m, s))
    ops = ["M15_active_eom_calc", "M16_active_eom_delta", "M17_collections_eom_calc", "M18_collections_eom_delta"]
    for op, w in zip(ops, q.ROLLS, strict=True):
        found[op] = q.query("derived", lambda s, w=w: q.roll(w, s))
    found["M19_level_rollup"] = q.query("derived", q.derived)
    for op, n in {"M20_gross_churn": "Gross Churn", "M22_net_churn": "Net Churn"}.items():
        found[op] = q.query("churn", lambda s, n=n: q.churn_abs(n, s))
    for op, n in {"M21_gross_churn_pct": "Gross Churn Pct", "M23_net_churn_pct": "Net Churn Pct"}.items():
        found[op] = q.query("churn", lambda s, n=n: q.churn_pct(n, s))
    for op, m in {
        "M26_active_delta_projection": "Active EOM Delta",
        "M27_collections_delta_projection": "Collections EOM Delta",
    }.items():
        found[op] = q.query("projection", lambda s, m=m: q.delta_proj(m, s))
    for op, n in {"M28_gross_churn_proj": "Gross Churn Proj", "M30_net_churn_proj": "Net Churn Proj"}.items():
        found[op] = q.query("churn_projected", lambda s, n=n: q.churn_abs_proj(n, s))
    for op, n in {"M29_gross_churn_pct_proj": "Gross Churn Pct", "M31_net_churn_pct_proj": "Net Churn Pct"}.items():
        found[op] = q.query("churn_projected", lambda s, n=n: q.churn_pct_proj(n, s))
    found["M32_ratio_proj"] = q.query("closing", lambda s: [b for m in RATIOS for b in q.ratio_proj(m, s)])
    ops = [
        "M33_active_eom_calc_proj", "M34_active_eom_proj",
        "M35_collections_eom_calc_proj", "M36_collections_eom_proj",
    ]
    for op, w in zip(ops, q.CLOSINGS, strict=True):
        found[op] = q.query("closing", lambda s, w=w: q.closing_one(w, s))
    return {f"{op}_{name}": sql for op, sql in found.items()}


def _mini_only() -> dict[str, str]:
    q = MetricSql("v2")
    key = " AND ".join(f"n.{d} IS NOT DISTINCT FROM b.{d}" for d in [*q.dims, "metric", "dateref"])
    snapshots = (
        f"SELECT * FROM ({q.bom(True)}\nUNION ALL\n{q.eom(True)}) b WHERE NOT EXISTS "
        f"(SELECT 1 FROM ({q.eom_to_date(True)}) n WHERE {key})\nUNION ALL\n{q.eom_to_date(True)}"
    )
    return {
        "M37_mini_only_snapshots": q.query("base", lambda s: snapshots),
        "M38_mini_only_flows": q.query("base", lambda s: [q.flows(False, True), q.flows(True, True)]),
        "M39_mini_only_ratios": q.query("derived_mini_only", q.derived_mini),
        "M40_mini_only_churn_pct": q.query("churn_mini_only", q.churn_mini),
        "M41_mini_only_projection": q.query("base", q.projection_mini),
        "M42_mini_only_churn_pct_proj": q.query("churn_projected_mini_only", q.churn_proj_mini),
        "M43_mini_only_ratio_proj": q.query("closing_mini_only", q.closing_mini),
    }


def loan_oracles() -> dict[str, str]:
    runs = {f"monthly_run_{n}": MetricSql(n).whole() for n in ("v1", "v2", "v2_plain")}
    # The second metric set may look back less far than the facts do.
    runs["monthly_run_v2_six_months"] = MetricSql("v2", months_back=6).whole()
    runs |= {f"monthly_run_second_{n}": MetricSql(n).second() for n in ("v1", "v2")}
    runs["pipeline_monthly"] = runs["monthly_run_v1"]
    runs["monthly_run_resumed"] = runs["monthly_run_v2"]
    pattern = f"SELECT * FROM ({runs['monthly_run_v2']}) WHERE Metric NOT LIKE '%Proj'"
    return {
        **_tables(), "sink_delete_pattern": pattern, **_status(),
        **_metric_set("v1"), **_metric_set("v2"), **_mini_only(), **runs,
    }
