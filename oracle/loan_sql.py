"""SQL for the loan tables, the status rows and the fact table."""

from __future__ import annotations

AS_OF = "DATE '2001-06-15'"
MONTHS_BACK = 13
OPENS_AFTER = f"last_day({AS_OF} - INTERVAL {MONTHS_BACK} MONTH)"
CLOSES = f"last_day({AS_OF})"

STORE = """store AS (
  SELECT lpad(n_nationkey::VARCHAR, 5, '0') || lpad(i::VARCHAR, 6, '0') AS store_id,
         CASE WHEN i = 3 AND n_nationkey % 5 = 0 THEN NULL
              ELSE ['Zip', 'Pocket Money', 'Mini Money', 'Thurlow'][i + 1] END AS product,
         CASE WHEN r_regionkey % 2 = 0 THEN 'Online' ELSE 'Retail' END AS unit,
         'R' || r_regionkey AS region, 'P' || n_nationkey AS province, n_name || ' ' || i AS store_name
  FROM nation JOIN region ON n_regionkey = r_regionkey, (SELECT unnest([0, 1, 2, 3])::INT AS i)
)"""

LOAN = """loan AS MATERIALIZED (
  SELECT o_orderkey AS appl, lpad(c_nationkey::VARCHAR, 5, '0') || lpad((o_orderkey % 4)::VARCHAR, 6, '0') AS store_id,
         o_custkey AS cust, '9' || lpad(o_custkey::VARCHAR, 8, '0') AS ssn, o_orderdate::DATE AS origin,
         o_orderdate::DATE + (14 + o_orderkey % 17)::INT AS due,
         CASE o_orderstatus
           WHEN 'O' THEN CASE WHEN o_orderpriority LIKE '1%' THEN 'N' ELSE 'O' END
           WHEN 'F' THEN CASE WHEN left(o_orderpriority, 1) IN ('1', '2') THEN 'P' ELSE 'D' END
           ELSE CASE left(o_orderpriority, 1) WHEN '2' THEN 'C' WHEN '3' THEN 'B' WHEN '4' THEN 'V' ELSE 'R' END
         END AS status,
         CASE WHEN o_orderkey % 5 = 0 THEN 'R' ELSE 'S' END AS kind,
         CASE WHEN o_orderkey % 5 = 0 THEN
           lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate::DATE, o_orderkey) END AS renews,
         o_totalprice::DECIMAL(12,2) AS amount,
         o_totalprice::DECIMAL(12,2) * (155 + 10 * (o_orderkey % 10))::DECIMAL(6,0) * 0.001::DECIMAL(4,3) AS charge,
         o_orderdate::DATE + (20 + o_orderkey % 40)::INT AS last_paid,
         o_orderdate::DATE + (10 + o_orderkey % 80)::INT AS changed
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""

PAY = """pay AS MATERIALIZED (
  SELECT l_orderkey AS appl, o_orderdate::DATE + (7 * l_linenumber)::INT AS paid_on,
         CASE l_returnflag || l_linestatus WHEN 'RF' THEN 'N' WHEN 'RO' THEN 'P' WHEN 'AF' THEN 'S'
           WHEN 'AO' THEN 'R' WHEN 'NF' THEN 'X' WHEN 'NO' THEN 'B' END AS kind,
         CASE WHEN l_linenumber % 3 = 0 THEN 0 ELSE l_quantity END::DECIMAL(12,2) AS principal
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

SPINE = """spine AS MATERIALIZED (
  SELECT l.*, s.product,
         CASE WHEN s.product = 'Zip' THEN CASE WHEN l.charge / l.amount >= 0.21 THEN 'Zip 30' ELSE 'Zip Flex' END
              ELSE s.product END AS sub,
         l.status NOT IN ('I', 'V', 'W', 'G', '') AS good
  FROM loan l JOIN store s USING (store_id)
)"""


def in_window(expr: str) -> str:
    return f"({expr} > {OPENS_AFTER} AND {expr} <= {CLOSES})"


def rows(status: str, body: str, first: str, last: str | None = None, ref: str | None = None, one="a") -> str:
    last, ref = last or first, ref or first
    return (
        f"SELECT {one}.store_id, {one}.sub, {one}.appl, {one}.ssn, '{status}' AS status, "
        f"{first} AS d1, {last} AS d2, {ref} AS d3 {body}"
    )


TROUBLE = "SELECT 1 FROM pay p WHERE p.appl = a.appl AND p.kind IN ('N', 'P')"
FIRST_TROUBLE = "(SELECT min(p.paid_on) FROM pay p WHERE p.appl = a.appl AND p.kind IN ('N', 'P'))"
NOT_RENEWED = (
    "NOT EXISTS (SELECT 1 FROM loan n WHERE n.renews = a.appl AND n.status NOT IN ('I', 'V', 'W', ''))"
)
LATER_NEW = (
    "SELECT 1 FROM spine b WHERE b.ssn = a.ssn AND b.product = a.product AND b.appl <> a.appl "
    "AND b.kind = 'S' AND b.good AND b.origin > a.origin AND b.origin <= last_day(a.last_paid)"
)
EARLIER = (
    "SELECT 1 FROM spine b WHERE b.ssn = a.ssn AND b.product = a.product AND b.appl <> a.appl "
    "AND b.good AND b.origin < a.origin"
)
REPAID_PAIRS = (
    "FROM spine a JOIN spine b ON b.ssn = a.ssn AND b.product = a.product AND b.appl <> a.appl "
    "AND b.kind = 'S' AND b.good AND b.origin > a.origin AND b.origin <= last_day(a.last_paid) "
    f"WHERE a.status IN ('D', 'P') AND {in_window('a.last_paid')} AND {NOT_RENEWED}"
)
RENEWAL_PAIRS = (
    "FROM spine a JOIN loan n ON n.renews = a.appl AND n.ssn = a.ssn "
    "WHERE a.good AND a.product IS NOT NULL AND n.kind = 'R' "
    f"AND n.status NOT IN ('I', 'V', 'W', 'G', '') AND {in_window('n.origin')}"
)
KNOWN = "FROM spine a WHERE a.product IS NOT NULL"
STARTED = in_window("a.origin")


def _first_return(test: str, earlier: str) -> str:
    """Loans whose first return of a kind falls into the window."""
    return (
        "FROM (SELECT DISTINCT a.store_id, a.sub, a.appl, a.ssn, p.paid_on "
        "FROM spine a JOIN pay p ON p.appl = a.appl "
        f"WHERE a.good AND a.product IS NOT NULL AND p.kind = 'N' AND p.principal {test} 0 "
        f"AND {in_window('p.paid_on')} AND NOT EXISTS (SELECT 1 FROM pay q WHERE q.appl = a.appl "
        f"AND q.kind = 'N' AND q.paid_on < p.paid_on {earlier})) a"
    )


STATUS = {
    "Active": rows(
        "Active", f"{KNOWN} AND a.good AND {STARTED}", "a.origin",
        f"coalesce({FIRST_TROUBLE}, CASE WHEN a.status IN ('N', 'O') THEN {AS_OF} ELSE a.changed END)", AS_OF,
    ),
    "Collections": rows(
        "Collections", f"{KNOWN} AND a.good AND {STARTED} AND EXISTS ({TROUBLE})", FIRST_TROUBLE,
        f"CASE WHEN a.status IN ('P', 'C', 'B') THEN a.changed ELSE {AS_OF} END", AS_OF,
    ),
    "Collections_M": rows(
        "Collections_M", f"{KNOWN} AND a.status = 'R' AND {STARTED} AND NOT EXISTS ({TROUBLE})",
        "a.changed", AS_OF, AS_OF,
    ),
    "Bankrupt": rows("Bankrupt", f"{KNOWN} AND a.status = 'B' AND {in_window('a.last_paid')}", "a.last_paid"),
    "Charged off": rows("Charged off", f"{KNOWN} AND a.status = 'C' AND {in_window('a.last_paid')}", "a.last_paid"),
    "Default_C": rows("Default_C", _first_return("=", ""), "a.paid_on"),
    "Default_P": rows("Default_P", _first_return("<>", "AND q.principal <> 0"), "a.paid_on"),
    "Default_M": rows(
        "Default_M", f"{KNOWN} AND a.status = 'R' AND {in_window('a.changed')} AND NOT EXISTS ({TROUBLE})", "a.changed"
    ),
    "Default_M by payment": rows(
        "Default_M",
        f"{KNOWN} AND a.status IN ('R', 'P', 'C', 'B') AND {STARTED} "
        "AND EXISTS (SELECT 1 FROM pay p WHERE p.appl = a.appl AND p.kind = 'P') "
        "AND NOT EXISTS (SELECT 1 FROM pay p WHERE p.appl = a.appl AND p.kind = 'N')",
        "(SELECT min(p.paid_on) FROM pay p WHERE p.appl = a.appl AND p.kind = 'P')",
        "(SELECT min(p.paid_on) FROM pay p WHERE p.appl = a.appl AND p.kind = 'P')",
        AS_OF,
    ),
    "Due": rows(
        "Due", f"{KNOWN} AND a.good AND {in_window('a.due')} AND NOT (a.changed < a.due AND a.status IN ('C', 'B'))",
        "a.due",
    ),
    "New": rows("New", f"{KNOWN} AND a.good AND a.kind = 'S' AND {STARTED} AND NOT EXISTS ({EARLIER})", "a.origin"),
    "React": rows(
        "React",
        f"{KNOWN} AND a.good AND a.kind = 'S' AND {STARTED} AND EXISTS ({EARLIER}) "
        "AND NOT EXISTS (SELECT 1 FROM active f JOIN store s USING (store_id) WHERE f.ssn = a.ssn "
        "AND s.product = a.product AND f.appl <> a.appl AND f.d1 < a.origin "
        "AND f.d2 > date_trunc('month', a.origin)::DATE - 1)",
        "a.origin",
    ),
    "Paid_D": rows(
        "Paid_D",
        f"{KNOWN} AND a.status = 'D' AND {in_window('a.last_paid')} AND {NOT_RENEWED} AND NOT EXISTS ({LATER_NEW})",
        "a.last_paid",
    ),
    "Paid_P": rows("Paid_P", f"{KNOWN} AND a.status = 'P' AND {in_window('a.last_paid')}", "a.last_paid"),
    "PaidRel_1": rows(
        "PaidRel_1", f"FROM (SELECT DISTINCT a.store_id, a.sub, a.appl, a.ssn, a.last_paid {REPAID_PAIRS}) a",
        "a.last_paid",
    ),
    "PaidRel_2": rows(
        "PaidRel_2",
        f"FROM (SELECT b.store_id, b.sub, b.appl, b.ssn, b.origin, max(a.last_paid) AS ref {REPAID_PAIRS} "
        "GROUP BY ALL) a",
        "a.origin", "a.origin", "a.ref",
    ),
    "Renewed_1": rows("Renewed_1", RENEWAL_PAIRS, "n.origin"),
    "Renewed_2": rows(
        "Renewed_2", f"FROM (SELECT n.appl, n.origin {RENEWAL_PAIRS}) x JOIN spine a ON a.appl = x.appl", "a.origin"
    ),
}

TABLES = ",\n".join([STORE, LOAN, PAY, SPINE])
ACTIVE = f"active AS MATERIALIZED ({STATUS['Active']})"
FACT = (
    f"{TABLES},\n{ACTIVE},\nfact AS MATERIALIZED (\n"
    + "\nUNION ALL\n".join("SELECT * FROM active" if k == "Active" else v for k, v in STATUS.items())
    + "\n)"
)


def day(expr: str, name: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d') AS {name}"


FACT_OUT = (
    "store_id AS Merch_Store_Id, sub AS Subproduct, appl AS Appl_No, ssn AS Cust_SSN, status AS Status, "
    + ", ".join(day(e, n) for e, n in (("d1", "From_Date"), ("d2", "To_Date"), ("d3", "Ref_Date")))
)


def status_sql(*names: str) -> str:
    body = "\nUNION ALL\n".join(STATUS[n] for n in names)
    extra = f",\n{ACTIVE}" if "React" in names else ""
    return f"WITH {TABLES}{extra}\nSELECT {FACT_OUT} FROM (\n{body}\n)"


def fact_sql(where: str = "TRUE") -> str:
    return f"WITH {FACT}\nSELECT {FACT_OUT} FROM fact WHERE {where}"


# Statuses whose stored rows of the window a run drops first.
RELOADED = (
    "('Bankrupt', 'Charged off', 'Default_C', 'Default_M', 'Default_P', 'Due', 'New', 'PaidRel_1', 'PaidRel_2', "
    "'Paid_D', 'Paid_P', 'React', 'Renewed_1', 'Renewed_2')"
)
SAME_KEY = "f.store_id = o.store_id AND f.sub = o.sub AND f.appl = o.appl AND f.ssn = o.ssn AND f.status = o.status"


def before_voids(sql: str) -> str:
    return sql.replace("WHEN '4' THEN 'V'", "WHEN '4' THEN 'O'")


def a_month_ago(sql: str) -> str:
    return sql.replace(AS_OF, "DATE '2001-05-15'")


def stored_sql(old: str, ran_old: str, ran: str) -> str:
    """The facts of `old` after one more run. `old` is SQL for fact rows; the run counts its Active rows, too."""
    now = "\nUNION ALL\n".join("SELECT * FROM active_now" if k == "Active" else v for k, v in STATUS.items())
    return f"""WITH old AS MATERIALIZED ({old}), {TABLES},
active_now AS MATERIALIZED ({STATUS['Active']}),
active AS MATERIALIZED (
  SELECT * FROM active_now UNION ALL SELECT * FROM old o
  WHERE status = 'Active' AND NOT EXISTS (SELECT 1 FROM active_now f WHERE {SAME_KEY})
), fact AS MATERIALIZED ({now})
SELECT *, '{ran}' AS ran FROM fact UNION ALL
SELECT *, '{ran_old}' AS ran FROM old o
WHERE NOT (status IN {RELOADED} AND d3 > {OPENS_AFTER}) AND appl NOT IN (SELECT appl FROM loan WHERE status = 'V')
  AND NOT EXISTS (SELECT 1 FROM fact f WHERE {SAME_KEY})"""


def second_run_sql() -> str:
    old = f"SELECT * FROM ({before_voids(a_month_ago(f'WITH {FACT} SELECT * FROM fact'))})"
    rows_ = stored_sql(old, "2001-05-15 04:30:00", "2001-06-15 04:30:00")
    return f"SELECT {FACT_OUT}, ran AS RunTimeStamp FROM ({rows_})"


def changes_sql() -> str:
    old = before_voids(f"WITH {FACT} SELECT * FROM fact")
    old = old.replace("loan AS MATERIALIZED (", "all_loans AS MATERIALIZED (").replace(
        PAY,
        "loan AS (SELECT * FROM all_loans WHERE appl % 50 <> 7), "
        + PAY.replace("pay AS MATERIALIZED (", "all_pay AS MATERIALIZED (")
        + ", pay AS (SELECT * FROM all_pay WHERE appl % 40 <> 3)",
    )
    return f"SELECT {FACT_OUT} FROM ({stored_sql(f'SELECT * FROM ({old})', 'before', 'now')})"
