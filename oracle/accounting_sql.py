"""SQL for the accounting tables, the entry blocks and the extract."""

from __future__ import annotations

from oracle.loan_sql import LOAN

MERCHANT = "00003"
START, END = "TIMESTAMP '1999-01-01'", "TIMESTAMP '2002-01-01'"
REPORT_TIME = "TIMESTAMP '2002-01-01 06:00:00'"
M = "DECIMAL(19,4)"

TABLES = f"""{LOAN},
la AS MATERIALIZED (
  SELECT appl, store_id, cust, ssn, CASE WHEN appl % 13 <> 0 THEN origin END AS origin, due, status, kind, amount,
         charge, changed, origin AS entered_on, CASE WHEN appl % 17 = 0 THEN 'P' ELSE 'A' END AS state,
         origin::TIMESTAMP + INTERVAL '9 hours 30 minutes' AS created, 'U' || appl % 3 AS user_id,
         'U' || appl % 4 AS origin_user, ['C', 'K', 'A'][appl % 3 + 1] AS disb, (appl % 3)::INT AS disb_sub,
         'CK' || appl AS check_no, left(store_id, 5)::BIGINT * 6 + appl % 6 AS rate_id
  FROM loan
),
cu AS (
  SELECT c_custkey AS cust, lpad(c_nationkey::VARCHAR, 5, '0') AS merchant, split_part(c_name, '#', 1) AS fname,
         CASE WHEN c_custkey % 3 <> 0 THEN 'M' || c_custkey % 10 END AS mname, split_part(c_name, '#', 2) AS lname,
         'S' || c_nationkey % 10 AS cstate, '9' || lpad(c_custkey::VARCHAR, 8, '0') AS ssn
  FROM customer
),
us AS (
  SELECT lpad(n_nationkey::VARCHAR, 5, '0') AS merchant, 'U' || i AS user_id,
         lpad(n_nationkey::VARCHAR, 5, '0') || '-U' || i AS login
  FROM nation, (SELECT unnest([0, 1, 2]) AS i)
),
rm AS (
  SELECT n_nationkey::BIGINT * 6 + j AS rate_id, lpad(n_nationkey::VARCHAR, 5, '0') || '000000' AS store_id,
         (10 + j * 2.50)::{M} AS fee, (4 + j)::{M} AS interest, [0, 2000, 0, 5000, 0, 0][j + 1]::{M} AS charge
  FROM nation, (SELECT unnest([0, 1, 2, 3, 4, 5]) AS j) WHERE j % 2 = 1
),
lines AS (
  SELECT *, l_linenumber + 8 * (l_partkey % 8) AS bucket FROM lineitem
),
py0 AS (
  SELECT l.l_orderkey * 10000000 + row_number() OVER (PARTITION BY l_orderkey, bucket ORDER BY l_partkey, l_suppkey,
           l_extendedprice, l_quantity, l_discount, l_tax, l_shipdate) * 64 + bucket AS no,
         appl, left(store_id, 5) || lpad((l_suppkey % 4)::VARCHAR, 6, '0') AS store_id,
         (entered_on + (7 * l_linenumber)::INT)::TIMESTAMP + INTERVAL 11 HOUR AS paid_at,
         CASE WHEN l_partkey % 24 < 12 THEN ['Y', '9', 'U', 'W', 'G', 'K', 'Q', '6', 'E', 'A', '1', 'H'][l_partkey % 24 + 1]
              ELSE CASE l_returnflag || l_linestatus WHEN 'RF' THEN 'N' WHEN 'RO' THEN 'P' WHEN 'AF' THEN 'S'
                   WHEN 'AO' THEN 'R' WHEN 'NF' THEN 'X' ELSE 'B' END END AS kind,
         ['C', 'K', 'A', 'G', NULL][l_suppkey % 5 + 1] AS mode, l_linenumber AS line,
         l_extendedprice::DECIMAL(12,2)::{M} AS amount, l_quantity::DECIMAL(12,2) AS qty,
         l_discount::DECIMAL(4,2) AS discount, l_tax::DECIMAL(4,2) AS tax,
         CASE WHEN l_partkey % 11 = 0 THEN -1 ELSE 1 END AS sign, (l_linenumber % 3)::INT AS misint
  FROM lines l JOIN la ON appl = l_orderkey
),
py1 AS (SELECT *, kind IN ('Y', '9') AND line % 2 = 0 AS blank FROM py0),
before AS (SELECT appl, line + 1 AS line, min(no) AS no FROM py1 GROUP BY ALL),
py AS MATERIALIZED (
  SELECT p.*, CASE WHEN p.kind = 'N' THEN b.no END AS ref,
         (CASE WHEN blank OR p.line % 3 = 0 THEN 0 ELSE qty * sign END)::{M} AS principal,
         CASE WHEN p.line <> 7 THEN (CASE WHEN blank THEN 0 ELSE amount::DECIMAL(12,2) * discount * sign END)::{M} END AS finance,
         (CASE WHEN blank THEN 0 ELSE tax * 100 END)::{M} AS late,
         CASE WHEN p.line % 4 <> 0 THEN 0::{M} END AS other,
         (CASE WHEN blank THEN 0 ELSE p.line % 2 * 5 END)::{M} AS fee
  FROM py1 p LEFT JOIN before b ON b.appl = p.appl AND b.line = p.line
),
vo AS (
  SELECT appl * 10 + 1 AS id, appl, changed::TIMESTAMP + INTERVAL '13 hours 20 minutes' AS created
  FROM la WHERE status = 'V' AND appl % 7 <> 0
),
fd AS (
  SELECT l_orderkey AS appl, ['B', 'F', 'L', 'X'][l_linenumber % 4 + 1] AS code,
         CASE WHEN l_linenumber <> 5 THEN (l_tax::DECIMAL(4,2) * 100)::{M} END AS amount
  FROM lineitem
),
bc AS (
  SELECT appl * 10 + 2 AS id, appl, status AS flag, amount::{M} AS principal,
         (charge::{M} * CASE WHEN appl % 5 = 0 THEN -1 ELSE 1 END)::{M} AS finance,
         CASE WHEN appl % 3 <> 0 THEN (12.50 + appl % 7)::{M} END AS fee,
         changed::TIMESTAMP + INTERVAL '16 hours 45 minutes' AS created
  FROM la WHERE status IN ('B', 'C')
),
hi AS (
  SELECT appl, ['N', 'O', 'R', 'C', 'B', 'G', 'D'][appl % 7 + 1] AS was,
         ['N', 'O', 'R', 'C', 'B', 'G', 'D'][CASE WHEN appl % 2 = 0 THEN appl % 7 ELSE (appl * 3 + 1) % 7 END + 1] AS now,
         amount::{M} AS old_principal, (amount + (appl % 3 - 1) * 50)::{M} AS new_principal,
         (appl % 5 * 10)::{M} AS old_finance, (appl % 7 * 10)::{M} AS new_finance,
         (appl % 2 * 5)::{M} AS old_fee, (appl % 3 * 5)::{M} AS new_fee,
         changed::TIMESTAMP + INTERVAL '12 hours 15 minutes' AS created
  FROM la WHERE appl % 9 <> 0
),
ac AS MATERIALIZED (
  SELECT appl * 10 + 3 AS no, appl, NULL::BIGINT AS pmt, store_id, 'Borrower ' || appl AS name, '22' AS code, 'C' AS purpose,
         CASE WHEN appl % 5 = 0 THEN 'F' ELSE 'S' END AS sent, (entered_on + 1)::TIMESTAMP + INTERVAL 8 HOUR AS sent_at,
         amount::{M} AS amount, appl % 11 = 0 AS deleted
  FROM la WHERE disb = 'A'
  UNION ALL
  SELECT no * 10 + 4, CASE WHEN appl % 4 <> 3 THEN appl END, no, store_id, 'Payer ' || appl, '27',
         ['B', 'C', 'M', 'N'][appl % 4 + 1], 'S', (paid_at::DATE + 1)::TIMESTAMP + INTERVAL '10 hours 30 minutes',
         amount, misint = 2
  FROM py WHERE mode = 'A'
),
ar AS (SELECT (no * 10 + 4) * 10 + 1 AS id, no * 10 + 4 AS ach FROM py WHERE mode = 'A' AND kind IN ('N', 'P', 'S')),
ic AS (SELECT no, (late + 1.25)::{M} AS amount FROM py WHERE kind = 'R'),
co AS (SELECT appl, changed::TIMESTAMP + INTERVAL '9 hours 15 minutes' AS placed, 'COL' || appl % 5 AS collector FROM la WHERE status = 'R'),
ev AS (
  SELECT event_id AS id, event_type, lpad((user_id % 25)::VARCHAR, 5, '0') || lpad((event_id % 4)::VARCHAR, 6, '0') AS store_id,
         ts::TIMESTAMP - INTERVAL 8766 DAY AS at, value::DECIMAL(12,2) AS amount, 'T' || user_id % 9 AS who
  FROM events
),
ck AS (
  SELECT CASE WHEN status = 'R' THEN 'REF-' || appl ELSE appl::VARCHAR END AS ref,
         CASE WHEN appl % 5 = 0 THEN 'XX' ELSE 'CK' || appl END AS check_no, amount::{M} AS amount,
         ((1 + appl % 3) * 2.50)::{M} AS fee, appl % 5 + 1 AS type_id, cust, store_id,
         (entered_on + 1)::TIMESTAMP + INTERVAL '14 hours 5 minutes' AS created, 'T' || appl % 6 AS who
  FROM la WHERE disb = 'K'
),
gl AS (
  SELECT lpad(n_nationkey::VARCHAR, 5, '0') AS merchant, t, a, 'D1-' || t || '-' || a AS d1,
         CASE WHEN t % 2 = 0 THEN 'D2-' || t || '-' || a END AS d2, 'C1-' || t || '-' || a AS c1,
         CASE WHEN a = 2 THEN 'C2-' || t || '-' || a END AS c2
  FROM nation, (SELECT unnest([1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 16, 20, 21, 22, 23, 24, 25, 27, 28, 29, 30,
                               80, 82, 84, 85, 87, 89, 90, 92, 95, 96]) AS t), (SELECT unnest([1, 2, 3]) AS a)
  WHERE (t + a) % 4 <> 0
),
ctx AS MATERIALIZED (
  SELECT l.*, c.merchant, c.fname || ' ' || coalesce(c.mname, '') || ' ' || c.lname AS name, c.cstate,
         o.placed, o.collector, u.login, coalesce(ou.login, '') AS origin_login
  FROM la l JOIN cu c USING (cust) JOIN us u ON u.merchant = c.merchant AND u.user_id = l.user_id
  LEFT JOIN co o ON o.appl = l.appl LEFT JOIN us ou ON ou.merchant = c.merchant AND ou.user_id = l.origin_user
  WHERE starts_with(l.store_id, '{MERCHANT}')
)"""

TYPES = {
    "Merchant_Id": "VARCHAR", "Loan_Originating_Store_Id": "VARCHAR", "Transaction_Originating_Store_Id": "VARCHAR",
    "Loan_Id": "BIGINT", "Cust_Ssn": "VARCHAR", "Cust_Name": "VARCHAR", "Loan_Orig_Date": "TIMESTAMP",
    "Loan_Due_Date": "TIMESTAMP", "Loan_Type": "VARCHAR", "Loan_Status": "VARCHAR", "OC_CollectionDate": "TIMESTAMP",
    "Assigned_Collector": "VARCHAR", "Emp_User_Id": "VARCHAR", "Tran_Date_Time": "TIMESTAMP", "Tran_Id": "BIGINT",
    "Tran_Lynk_Id": "BIGINT", "Tran_Type_Id": "INTEGER", "Tran_Mode": "VARCHAR", "Total_Amount_Of_Transaction": M,
    "Tran_Account": "INTEGER", "Fee_Type": "VARCHAR", "Loan_Disburse_Subtype": "INTEGER",
    "Payment_Sub_Type": "INTEGER", "Check_Number": "VARCHAR", "Returntype": "INTEGER", "Return_Item_Count": "INTEGER",
    "Cust_State": "VARCHAR", "ACH_No": "BIGINT", "Emp_Origin_UserID": "VARCHAR",
}

LOAN_SIDE = {
    "Merchant_Id": "x.merchant", "Loan_Originating_Store_Id": "x.store_id",
    "Transaction_Originating_Store_Id": "x.store_id", "Loan_Id": "x.appl", "Cust_Ssn": "x.ssn", "Cust_Name": "x.name",
    "Loan_Orig_Date": "coalesce(x.origin::TIMESTAMP, x.created)", "Loan_Due_Date": "x.due", "Loan_Type": "x.kind",
    "Loan_Status": "x.status", "OC_CollectionDate": "x.placed", "Assigned_Collector": "x.collector",
    "Emp_User_Id": "x.login", "Cust_State": "x.cstate", "Emp_Origin_UserID": "x.origin_login",
}

RATE = "LEFT JOIN rm r ON r.rate_id = x.rate_id"
RATE_ONLY = "JOIN rm r ON r.rate_id = x.rate_id"


def block(values: dict[str, str], source: str) -> str:
    cols = ", ".join(f"({values.get(n, 'NULL')})::{t} AS {n}" for n, t in TYPES.items())
    return f"SELECT {cols} FROM {source}"


def during(col: str) -> str:
    return f"{col} >= {START} AND {col} < {END}"


def share(paid: str, fee: str) -> str:
    """Share of a fee rounded to cents, in whole ten-thousandths so that no digit is lost."""
    p = f"(coalesce({paid}, 0) * 10000)::HUGEINT"
    f = f"(coalesce({fee}, 0) * 10000)::HUGEINT"
    c = "(coalesce(r.charge, 0) * 10000)::HUGEINT"
    # paid * fee / charge in cents, rounded half away from zero; charges here are never negative
    part = (
        f"(CASE WHEN {p} < 0 THEN -1 ELSE 1 END * ((2 * abs({p} * {f}) + 100 * {c}) // nullif(200 * {c}, 0)))::{M} / 100"
    )
    return (
        f"(CASE WHEN {p} > 0 AND {p} >= {c} THEN coalesce({fee}, 0) WHEN {p} > 0 AND {p} < {c} THEN {part} "
        f"WHEN {p} < 0 AND {p} >= {c} THEN -coalesce({fee}, 0) "
        f"WHEN {p} < 0 AND {p} < {c} AND {c} <> 0 THEN {part} ELSE 0 END)"
    )


def blocks() -> dict[str, str]:
    """Every entry block by query name."""
    b: dict[str, str] = {}
    sent = "LEFT JOIN ac t ON t.appl = x.appl AND t.code = '22' AND t.purpose = 'C' AND t.sent = 'S' AND NOT t.deleted"
    by_ach = "CASE WHEN x.kind = 'S' THEN t.no END"
    origination = "CASE WHEN r.rate_id IS NOT NULL THEN coalesce(r.fee, 0) ELSE x.charge END"

    def with_amount(values, amount, account, **more):
        return {**values, "Total_Amount_Of_Transaction": amount, "Tran_Account": account, **more}

    # loans
    loans = {
        **LOAN_SIDE, "Tran_Date_Time": "x.created", "Tran_Id": "x.appl",
        "Tran_Type_Id": "CASE x.kind WHEN 'S' THEN 1 WHEN 'R' THEN 2 END", "Tran_Mode": "x.disb",
        "Loan_Disburse_Subtype": "x.disb_sub", "Check_Number": "x.check_no", "ACH_No": by_ach,
    }
    where = f"WHERE {during('x.created')} AND x.state = 'A' AND x.status IN ('N', 'O', 'B', 'C', 'R', 'V', 'P', 'D')"
    b["A01_loan_principal"] = block(with_amount(loans, "x.amount", "1"), f"ctx x {sent} {where}")
    b["A02_loan_fincharge"] = block(with_amount(loans, origination, "2"), f"ctx x {sent} {RATE} {where}")
    b["A03_loan_cso_interest"] = block(
        with_amount(loans, "coalesce(r.interest, 0)", "6"), f"ctx x {sent} {RATE_ONLY} {where}"
    )
    # voids
    void = {
        **LOAN_SIDE, "Tran_Date_Time": "v.created", "Tran_Id": "v.id", "Tran_Lynk_Id": "x.appl", "Tran_Type_Id": "3",
        "Tran_Mode": "x.disb", "Loan_Disburse_Subtype": "x.disb_sub", "ACH_No": by_ach,
    }
    where = f"WHERE {during('v.created')}"
    of_void = f"vo v JOIN ctx x ON x.appl = v.appl {sent}"
    b["A04_void_principal"] = block(with_amount(void, "x.amount", "1"), f"{of_void} {where}")
    b["A05_void_fincharge"] = block(with_amount(void, origination, "2"), f"{of_void} {RATE} {where}")
    b["A06_void_cso_interest"] = block(
        with_amount(void, "coalesce(r.interest, 0)", "6"), f"{of_void} {RATE_ONLY} {where}"
    )
    b["A07_void_fee"] = block(
        with_amount(void, "coalesce(f.amount, 0)", "3", Fee_Type="f.code"),
        f"{of_void} JOIN fd f ON f.appl = x.appl {where} AND f.code NOT IN ('B', 'X')",
    )
    # payments
    counts = "(SELECT count(ar.id) FROM ar JOIN ac ON ar.ach = ac.no WHERE ac.appl = p.appl)"
    pay = {
        **LOAN_SIDE, "Transaction_Originating_Store_Id": "p.store_id", "Tran_Date_Time": "p.paid_at", "Tran_Id": "p.no",
        "Tran_Lynk_Id": "p.ref",
        "Tran_Type_Id": "CASE WHEN p.mode = 'G' THEN 9 ELSE CASE p.kind WHEN 'X' THEN 1 WHEN 'B' THEN 1 WHEN 'S' THEN 4 "
        "WHEN 'R' THEN 5 WHEN 'N' THEN 6 WHEN 'A' THEN 27 WHEN 'P' THEN 7 WHEN 'G' THEN 8 WHEN 'U' THEN 16 WHEN 'W' THEN 21 "
        "WHEN '1' THEN 22 WHEN 'E' THEN 24 WHEN '9' THEN 24 WHEN 'K' THEN 25 WHEN 'Q' THEN 29 WHEN '6' THEN 30 ELSE 23 END END",
        "Tran_Mode": "p.mode",
        "Payment_Sub_Type": "CASE WHEN p.mode <> 'C' THEN nullif(p.misint, 0) ELSE p.misint END",
        "Returntype": "CASE WHEN p.kind = 'N' THEN CASE WHEN q.kind IN ('S', 'R') THEN 1 WHEN q.kind IN ('P', 'K') THEN 2 "
        "WHEN q.kind = 'G' THEN 3 WHEN q.kind = 'Q' THEN 4 END END",
        "Return_Item_Count": counts, "ACH_No": "t.no",
    }
    of_pay = (
        "py p JOIN ctx x ON x.appl = p.appl LEFT JOIN py q ON q.no = p.ref "
        "LEFT JOIN ac t ON t.pmt = q.no AND NOT t.deleted"
    )
    where = f"WHERE {during('p.paid_at')}"
    cso_kinds = "p.kind IN ('X', 'B', 'S', 'R', 'N', 'A', 'P', 'G', 'W', 'K')"
    b["A08_pay_principal"] = block(
        with_amount(pay, "coalesce(p.principal, 0)", "1"), f"{of_pay} {where} AND coalesce(p.principal, 0) <> 0"
    )
    shared = f"CASE WHEN {cso_kinds} AND r.rate_id IS NOT NULL THEN {share('p.finance', 'r.fee')} ELSE coalesce(p.finance, 0) END"
    b["A09_pay_fincharge"] = block(
        with_amount(pay, shared, "2"), f"{of_pay} {RATE} {where} AND coalesce(p.finance, 0) <> 0"
    )
    b["A10_pay_cso_interest"] = block(
        with_amount(pay, share("p.finance", "r.interest"), "6"),
        f"{of_pay} {RATE_ONLY} {where} AND {cso_kinds} AND coalesce(p.finance, 0) <> 0",
    )
    fees = "coalesce(p.late, 0) + coalesce(p.other, 0) + coalesce(p.fee, 0)"
    b["A11_pay_fees"] = block(
        with_amount(pay, fees, "CASE p.kind WHEN 'B' THEN 4 WHEN 'X' THEN 5 ELSE 3 END", Fee_Type="p.kind"),
        f"{of_pay} {where} AND {fees} <> 0",
    )
    b["A12_interest_assessed"] = block(
        with_amount(
            pay, "i.amount", "2", Tran_Id="x.appl", Tran_Lynk_Id="p.no", Tran_Type_Id="20",
            Loan_Disburse_Subtype="x.disb_sub", ACH_No="NULL",
        ),
        "py p JOIN ic i ON i.no = p.no JOIN ctx x ON x.appl = p.appl LEFT JOIN py q ON q.no = p.ref " + where,
    )
    b["A13_prepayment"] = block(
        with_amount(pay, "p.amount", "NULL", Tran_Type_Id="CASE p.kind WHEN 'Y' THEN 26 ELSE 24 END"),
        f"{of_pay} {where} AND p.kind IN ('Y', '9') AND coalesce(p.principal, 0) = 0 AND coalesce(p.finance, 0) = 0 "
        "AND coalesce(p.fee, 0) = 0",
    )
    # bankruptcies, charge-offs
    for flag, first, name, kind in (("B", 14, "bankrupt", "28"), ("C", 18, "chargeoff", "11")):
        off = {
            **LOAN_SIDE, "Tran_Date_Time": "w.created", "Tran_Id": "w.id", "Tran_Lynk_Id": "x.appl",
            "Tran_Type_Id": kind, "Loan_Disburse_Subtype": "x.disb_sub",
        }
        of_off = "bc w JOIN ctx x ON x.appl = w.appl"
        where = f"WHERE {during('w.created')} AND w.flag = '{flag}'"
        late = {"Loan_Orig_Date": "x.created"} if flag == "C" else {}
        part = f"CASE WHEN r.rate_id IS NOT NULL THEN {share('w.finance', 'r.fee')} ELSE coalesce(w.finance, 0) END"
        b[f"A{first}_{name}_principal"] = block(with_amount(off, "w.principal", "1"), f"{of_off} {where}")
        b[f"A{first + 1}_{name}_fincharge"] = block(
            with_amount(off, part, "2", **late), f"{of_off} {RATE} {where}"
        )
        b[f"A{first + 2}_{name}_cso_interest"] = block(
            with_amount(off, share("w.finance", "r.interest"), "6"), f"{of_off} {RATE_ONLY} {where}"
        )
        b[f"A{first + 3}_{name}_fee"] = block(with_amount(off, "coalesce(w.fee, 0)", "3"), f"{of_off} {where}")
    # bank, cash, checks
    store = "CASE WHEN t.purpose = 'N' THEN t.store_id ELSE l.store_id END"
    b["A22_ach_processed"] = block(
        {
            "Merchant_Id": "left(t.store_id, 5)", "Loan_Originating_Store_Id": store,
            "Transaction_Originating_Store_Id": store, "Loan_Id": "l.appl", "Cust_Ssn": "l.ssn", "Cust_Name": "t.name",
            "Loan_Orig_Date": "coalesce(l.origin::TIMESTAMP, l.created)", "Loan_Due_Date": "l.due",
            "Loan_Type": "l.kind", "Loan_Status": "l.status", "Emp_User_Id": "u.login", "Tran_Date_Time": "t.sent_at",
            "Tran_Id": "t.no", "Tran_Lynk_Id": "l.appl", "Tran_Type_Id": "10",
            "Tran_Mode": "CASE t.purpose WHEN 'N' THEN 'b' ELSE 'A' END", "Total_Amount_Of_Transaction": "t.amount",
            "Cust_State": "c.cstate", "ACH_No": "t.no", "Emp_Origin_UserID": "coalesce(o.login, '')",
        },
        "ac t LEFT JOIN la l ON l.appl = t.appl LEFT JOIN cu c ON c.cust = l.cust "
        "LEFT JOIN us u ON u.merchant = c.merchant AND u.user_id = l.user_id "
        "LEFT JOIN us o ON o.merchant = c.merchant AND o.user_id = l.origin_user "
        f"WHERE {during('t.sent_at')} AND starts_with(t.store_id, '{MERCHANT}') AND NOT t.deleted",
    )

    def till(amount, kind, event, more, first="e.store_id"):
        values = {
            "Merchant_Id": "left(e.store_id, 5)", "Loan_Originating_Store_Id": first,
            "Transaction_Originating_Store_Id": "e.store_id", "Emp_User_Id": "e.who", "Tran_Date_Time": "e.at",
            "Tran_Id": "e.id", "Tran_Type_Id": kind, "Tran_Mode": "'C'", "Total_Amount_Of_Transaction": amount,
        }
        return block(
            values,
            f"ev e WHERE e.event_type = '{event}' AND {during('e.at')} AND starts_with(e.store_id, '{MERCHANT}') {more}",
        )

    gap = "((e.id % 3 - 1) * 2.25)"
    b["A23_petty_cash"] = till("e.amount", "12", "click", "")
    b["A24_bank_deposit"] = till("e.amount - 5", "13", "view", "AND e.amount - 5 > 0")
    b["A25_deposit_over_short"] = till(
        f"abs({gap})", f"CASE WHEN {gap} > 0 THEN 14 ELSE 15 END", "view", f"AND abs({gap}) > 0"
    )
    check = {
        "Merchant_Id": "left(k.store_id, 5)", "Loan_Originating_Store_Id": "k.store_id",
        "Transaction_Originating_Store_Id": "k.store_id", "Loan_Id": "l.appl", "Cust_Ssn": "c.ssn",
        "Cust_Name": "c.fname || ',    ' || c.mname || ' ' || coalesce(c.lname, '')", "Loan_Orig_Date": "l.created",
        "Loan_Due_Date": "l.due", "Loan_Type": "l.kind", "Loan_Status": "l.status", "Emp_User_Id": "k.who",
        "Tran_Date_Time": "k.created", "Tran_Id": "k.type_id", "Cust_State": "c.cstate",
    }
    of_check = (
        "ck k JOIN cu c ON c.cust = k.cust JOIN la l ON l.appl = try_cast(k.ref AS BIGINT) AND l.check_no = k.check_no "
        f"AND l.amount = k.amount WHERE {during('k.created')} AND starts_with(k.store_id, '{MERCHANT}')"
    )
    b["A26_cashed_checks"] = block(
        {**check, "Tran_Type_Id": "17", "Tran_Mode": "'K'", "Total_Amount_Of_Transaction": "k.amount"}, of_check
    )
    b["A27_cashed_check_disb"] = block(
        {**check, "Tran_Type_Id": "18", "Tran_Mode": "'C'", "Total_Amount_Of_Transaction": "k.amount - k.fee"}, of_check
    )
    b["A28_cash_in_out"] = till("e.amount", "19", "purchase", "", "NULL")
    # balance and status changes
    tracked = "('N', 'O', 'R', 'C', 'B', 'G')"

    def by_status(col, first):
        return (
            f"CASE {col} WHEN 'R' THEN {first + 1} WHEN 'C' THEN {first + 2} WHEN 'B' THEN {first + 3} "
            f"WHEN 'G' THEN {first + 4} ELSE {first} END"
        )

    names = (("principal", "principal", 1), ("finance", "fincharge", 2), ("fee", "fee", 3))
    change = {
        **LOAN_SIDE, "Tran_Date_Time": "h.created", "Tran_Id": "x.appl", "Tran_Lynk_Id": "x.appl", "Tran_Mode": "''",
    }
    of_change = f"hi h JOIN ctx x ON x.appl = h.appl WHERE {during('h.created')}"
    for i, (col, name, account) in enumerate(names):
        old, new = f"h.old_{col}", f"h.new_{col}"
        b[f"A{29 + i}_hist_{name}"] = block(
            with_amount(
                change, f"{new} - {old}", str(account),
                Tran_Type_Id=f"CASE WHEN {new} > {old} THEN {by_status('h.was', 90)} ELSE {by_status('h.was', 95)} END",
            ),
            f"{of_change} AND h.was = h.now AND h.was IN {tracked} AND {old} <> {new}",
        )
        b[f"A{32 + i}_status_old_{name}"] = block(
            with_amount(change, f"-{old}", str(account), Tran_Type_Id=by_status("h.was", 80)),
            f"{of_change} AND h.was <> h.now AND h.was IN {tracked} AND {old} <> 0",
        )
        b[f"A{35 + i}_status_new_{name}"] = block(
            with_amount(change, new, str(account), Tran_Type_Id=by_status("h.now", 85)),
            f"{of_change} AND h.was <> h.now AND h.now IN {tracked} AND {new} <> 0",
        )
    return b


def shown(names: dict[str, str]) -> str:
    """Report form of the columns: amounts as doubles, times as text."""

    def one(name, kind):
        if kind == M:
            return f"{name}::DOUBLE AS {name}"
        if kind == "TIMESTAMP":
            return f"strftime({name}, '%Y-%m-%d %H:%M:%S') AS {name}"
        return name

    return ", ".join(one(n, t) for n, t in names.items())


def extract_columns() -> str:
    def dated(col, form):
        return f"strftime(coalesce({col}, TIMESTAMP '1900-01-01'), '{form}')"

    day, moment = "%m/%d/%Y", "%m/%d/%Y %H:%M:%S"
    special = {
        "Cust_SSN": "coalesce(Cust_Ssn, '')",
        "Loan_Orig_Date": dated("Loan_Orig_Date", day),
        "Loan_Due_Date": dated("Loan_Due_Date", day),
        "Loan_Status": "coalesce(Loan_Status, 'I')",
        "OC_CollectionDate": dated("OC_CollectionDate", moment),
        "Tran_Date_Time": dated("Tran_Date_Time", moment),
        "Report_Date": f"strftime({REPORT_TIME}, '{moment}')",
        "Total_Amount_Of_Transaction": "coalesce(Total_Amount_Of_Transaction::DECIMAL(19,2)::VARCHAR, '')",
        "GL_Code_Debit1": "coalesce(g.d1, '')", "GL_Code_Debit2": "coalesce(g.d2, '')",
        "GL_Code_Credit1": "coalesce(g.c1, '')", "GL_Code_Credit2": "coalesce(g.c2, '')",
    }
    names = [n if n != "Cust_Ssn" else "Cust_SSN" for n in TYPES]
    names += ["Report_Date", "GL_Code_Debit1", "GL_Code_Debit2", "GL_Code_Credit1", "GL_Code_Credit2"]
    return ", ".join(f"{special.get(n, f'''coalesce({n}::VARCHAR, '')''')} AS {n}" for n in names)


def block_sql(name: str) -> str:
    return f"WITH {TABLES}\nSELECT {shown(TYPES)} FROM (\n{blocks()[name]}\n)"


def extract_sql() -> str:
    body = "\nUNION ALL\n".join(blocks().values())
    return (
        f"WITH {TABLES},\nreport AS (\n{body}\n)\nSELECT {extract_columns()} FROM report "
        "LEFT JOIN gl g ON g.merchant = Merchant_Id AND g.t = Tran_Type_Id AND g.a = Tran_Account"
    )


def params_sql() -> str:
    return (
        f"WITH {TABLES} SELECT store_id AS Merch_Store_Id, {START}::VARCHAR AS start_time, {END}::VARCHAR AS end_time, "
        f"EXISTS (SELECT 1 FROM rm WHERE starts_with(store_id, '{MERCHANT}')) AS is_cso, count(*) AS loans "
        f"FROM la WHERE starts_with(store_id, '{MERCHANT}') AND {during('created')} GROUP BY store_id"
    )


def proration_sql() -> str:
    return (
        f"WITH {TABLES} SELECT p.no AS Pmt_Tran_No, {share('p.finance', 'r.fee')}::DOUBLE AS fee_share, "
        f"{share('p.finance', 'r.interest')}::DOUBLE AS interest_share "
        "FROM py p JOIN la x ON x.appl = p.appl JOIN rm r ON r.rate_id = x.rate_id"
    )


def return_count_sql() -> str:
    return (
        f"WITH {TABLES} SELECT l.appl AS Appl_No, (SELECT count(ar.id) FROM ar JOIN ac ON ar.ach = ac.no "
        "WHERE ac.appl = l.appl) AS Return_Item_Count FROM la l"
    )


def accounting_oracles() -> dict[str, str]:
    extract = extract_sql()
    return {
        "A00_params": params_sql(),
        **{name: block_sql(name) for name in sorted(blocks())},
        "A38_cso_proration": proration_sql(),
        "A39_return_item_count": return_count_sql(),
        "A40_gl_enrich_and_format": extract,
        "A41_accounting_extract": extract,
        "A41_one_day_extract": extract.replace(START, "TIMESTAMP '2000-11-15'").replace(END, "TIMESTAMP '2000-11-16'"),
        "sink_extract": extract,
    }
