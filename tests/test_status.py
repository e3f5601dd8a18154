"""Status rules against brute-force SQL on small random loans, and hand-made edges."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import duckdb
import pytest
from conftest import rows
from pyspark.sql import functions as F

from loanlens.functions.dates import AsOf
from loanlens.operators.customer_history import customer_history
from loanlens.operators.status import (
    FACT_COLUMNS, FACT_KEY, _paid_off, _with_payments, _with_renewed, classify, loans_with_product, renewals, renewed_loans,
)
from loanlens.plans.fact import HISTORY_STATUSES, LOAN_STATUSES, RENEWAL_STATUSES, fact_batch, load_facts
from oracle import loan_sql as L

AT = AsOf(date(2001, 6, 15))
LOANS = (
    "Appl_No bigint, Merch_Store_Id string, Cust_Id bigint, Cust_SSN string, Origin_Date date, Req_Due_Date date, "
    "Loan_Status string, Loan_Type string, Ren_ApplNo bigint, Req_Loan_Amt decimal(12,2), Fin_Charge decimal(17,5), "
    "LastPmtDate date, Last_Modified date"
)
PAYMENTS = "Appl_No bigint, Pmt_Date date, Pmt_Type string, Principle_Paid decimal(12,2)"
STORES = "Merchant_Store_Id string, Product string"
STORE_ROWS = [("s0", "Zip"), ("s1", "Zip"), ("s2", "Pocket Money"), ("s3", "Mini Money"), ("s4", None)]
LOAN_NAMES = "appl store_id cust ssn origin due status kind renews amount charge last_paid changed".split()


def random_tables(seed: int, loans: int = 400, customers: int = 25):
    """Few customers and few days, so that all ties and overlaps of the rules occur."""
    r = random.Random(seed)
    first = date(2000, 4, 1)

    def day(span=440):
        return first + timedelta(days=r.randrange(span))

    loan_rows, pay_rows = [], []
    for appl in range(1, loans + 1):
        opened = day()
        amount = Decimal(r.choice([0, 100, 250, 400]))
        loan_rows.append(
            (
                appl, r.choice(["s0", "s1", "s2", "s3", "s4", "s9"]), 1, f"c{r.randrange(customers) ** 2 // customers}",
                opened, opened + timedelta(days=r.randrange(5, 40)), r.choice("NODPRCBVIWG") if r.random() > 0.03 else "",
                r.choice("SSSR"), r.randrange(1, loans) if r.random() < 0.3 else None, amount,
                amount * Decimal(r.choice(["0.20", "0.22"])), opened + timedelta(days=r.randrange(0, 60)),
                opened + timedelta(days=r.randrange(0, 90)),
            )
        )
        for _ in range(r.choice([0, 0, 1, 2, 4])):
            pay_rows.append((appl, opened + timedelta(days=r.randrange(0, 50)), r.choice("NPSRXN"), Decimal(r.choice([0, 0, 10]))))
    return loan_rows, pay_rows


def brute_force(loan_rows, pay_rows, names, stored=None):
    con = duckdb.connect()
    con.execute(
        "CREATE TABLE loan (appl BIGINT, store_id VARCHAR, cust BIGINT, ssn VARCHAR, origin DATE, due DATE, status VARCHAR,"
        " kind VARCHAR, renews BIGINT, amount DECIMAL(12,2), charge DECIMAL(17,5), last_paid DATE, changed DATE)"
    )
    con.executemany(f"INSERT INTO loan VALUES ({','.join('?' * 13)})", loan_rows)
    con.execute("CREATE TABLE pay (appl BIGINT, paid_on DATE, kind VARCHAR, principal DECIMAL(12,2))")
    con.executemany("INSERT INTO pay VALUES (?,?,?,?)", pay_rows)
    con.execute("CREATE TABLE store (store_id VARCHAR, product VARCHAR)")
    con.executemany("INSERT INTO store VALUES (?,?)", STORE_ROWS)
    spine = L.SPINE.replace("l.charge / l.amount", "l.charge / nullif(l.amount, 0)")
    active = L.STATUS["Active"]
    if stored:
        con.execute(
            "CREATE TABLE stored (store_id VARCHAR, sub VARCHAR, appl BIGINT, ssn VARCHAR, status VARCHAR, d1 DATE, d2 DATE, d3 DATE)"
        )
        con.executemany("INSERT INTO stored VALUES (?,?,?,?,?,?,?,?)", stored)
        key = "o.store_id = f.store_id AND o.sub = f.sub AND o.appl = f.appl AND o.ssn = f.ssn"
        active = (
            f"SELECT * FROM ({active}) UNION ALL SELECT * FROM stored o WHERE status = 'Active' "
            f"AND NOT EXISTS (SELECT 1 FROM ({active}) f WHERE {key})"
        )
    body = " UNION ALL ".join(L.STATUS[n] for n in names)
    found = con.execute(f"WITH {spine}, active AS MATERIALIZED ({active}) SELECT * FROM ({body})").fetchall()
    return sorted(found, key=lambda r: tuple((v is None, str(v)) for v in r))


def frames(spark, loan_rows, pay_rows):
    return (
        spark.createDataFrame(loan_rows, LOANS),
        spark.createDataFrame(pay_rows, PAYMENTS),
        spark.createDataFrame(STORE_ROWS, STORES),
    )


SINGLE = [n for n in L.STATUS if not n.startswith("Renewed")]


@pytest.mark.parametrize("seed", [1, 2])
def test_every_status_at_once(spark, seed):
    loan_rows, pay_rows = random_tables(seed)
    found = classify(*frames(spark, loan_rows, pay_rows), AT, SINGLE)
    assert rows(found, *FACT_COLUMNS) == brute_force(loan_rows, pay_rows, SINGLE)


@pytest.mark.parametrize("name", ["React", "PaidRel_2", "Paid_D", "New", "Default_C"])
def test_one_status(spark, name):
    loan_rows, pay_rows = random_tables(7)
    found = classify(*frames(spark, loan_rows, pay_rows), AT, [name])
    expected = brute_force(loan_rows, pay_rows, [name])
    assert expected and rows(found, *FACT_COLUMNS) == expected


def test_renewals(spark):
    loan_rows, pay_rows = random_tables(3)
    loans, _, stores = frames(spark, loan_rows, pay_rows)
    # Renewals keep customer and predecessor together.
    ssn = {r[0]: r[3] for r in loan_rows}
    linked = [(*r[:3], ssn.get(r[8], r[3]), *r[4:]) for r in loan_rows]
    loans = spark.createDataFrame(linked, LOANS)
    expected = brute_force(linked, pay_rows, RENEWAL_STATUSES)
    assert expected and rows(renewals(loans, stores, AT, RENEWAL_STATUSES), *FACT_COLUMNS) == expected


def test_react_looks_at_stored_rows_of_other_loans_only(spark):
    loan_rows, pay_rows = random_tables(11)
    r = random.Random(5)
    stored = []
    for row in loan_rows:
        if r.random() < 0.5:
            start = row[4] - timedelta(days=r.randrange(0, 200))
            store = r.choice([row[1], "s0", "s2", "s3"])
            sub = {"s0": r.choice(["Zip 30", "Zip Flex"]), "s2": "Pocket Money", "s3": "Mini Money"}.get(store, "Zip 30")
            stored.append((store, sub, row[0], row[3], r.choice(["Active", "Active", "Due"]), start, start + timedelta(days=r.randrange(0, 90)), start))
    stored = list({s[:5]: s for s in stored}.values())
    facts = spark.createDataFrame(
        stored, "Merch_Store_Id string, Subproduct string, Appl_No bigint, Cust_SSN string, Status string, "
        "From_Date date, To_Date date, Ref_Date date"
    )
    found = classify(*frames(spark, loan_rows, pay_rows), AT, ["React"], facts)
    expected = brute_force(loan_rows, pay_rows, ["React"], stored)
    assert expected != brute_force(loan_rows, pay_rows, ["React"])
    assert rows(found, *FACT_COLUMNS) == expected


def test_fact_load_has_one_row_per_key_and_repeats(spark):
    loan_rows, pay_rows = random_tables(4)
    tables = frames(spark, loan_rows, pay_rows)
    first = load_facts(*tables, AT)
    keys = rows(first, *FACT_KEY)
    assert len(keys) == len(set(keys))
    stored = spark.createDataFrame(first.collect(), first.schema)
    assert rows(load_facts(*tables, AT, stored), *FACT_COLUMNS) == rows(first, *FACT_COLUMNS)


def test_new_load_drops_reloaded_window_and_voids_but_keeps_older_rows(spark):
    loan_rows, pay_rows = random_tables(6)
    loans, payments, stores = frames(spark, loan_rows, pay_rows)
    void = next(r[0] for r in loan_rows if r[6] == "V")
    live = next(r[0] for r in loan_rows if r[6] == "D")
    schema = (
        "Merch_Store_Id string, Subproduct string, Appl_No bigint, Cust_SSN string, Status string, "
        "From_Date date, To_Date date, Ref_Date date"
    )
    old, recent = date(1999, 1, 1), date(2001, 6, 1)
    stored = spark.createDataFrame(
        [
            ("x", "old due", live, "c", "Due", old, old, old),
            ("x", "recent due", live, "c", "Due", recent, recent, recent),
            ("x", "recent span", live, "c", "Collections", recent, recent, recent),
            ("x", "old void", void, "c", "Due", old, old, old),
        ],
        schema,
    )
    found = load_facts(loans, payments, stores, AT, stored)
    kept = {r.Subproduct for r in found.filter("Merch_Store_Id = 'x'").collect()}
    assert kept == {"old due", "recent span"}
    fresh = rows(fact_batch(loans, payments, stores, AT, stored).select(*FACT_COLUMNS))
    assert rows(found.filter("Merch_Store_Id <> 'x'"), *FACT_COLUMNS) == fresh


def one_loan(spark, status="D", pays=(), **change):
    row = dict(
        zip(
            LOANS.replace(" bigint", "").replace(" string", "").replace(" date", "").replace(" decimal(12,2)", "")
            .replace(" decimal(17,5)", "").split(", "),
            (1, "s0", 1, "c", date(2001, 3, 1), date(2001, 3, 20), status, "S", None, Decimal(100), Decimal(21),
             date(2001, 4, 1), date(2001, 4, 2)),
            strict=True,
        )
    )
    row.update(change)
    loans = spark.createDataFrame([tuple(row.values())], LOANS)
    schema = PAYMENTS if not pays or not isinstance(pays[0][1], datetime) else PAYMENTS.replace("Pmt_Date date", "Pmt_Date timestamp_ntz")
    return loans, spark.createDataFrame(list(pays), schema), spark.createDataFrame(STORE_ROWS, STORES)


def test_rate_on_the_edge_is_zip_30(spark):
    found = classify(*one_loan(spark), AT, ["Active"]).collect()
    assert [r.Subproduct for r in found] == ["Zip 30"]
    found = classify(*one_loan(spark, Req_Loan_Amt=Decimal(0)), AT, ["Active"]).collect()
    assert [r.Subproduct for r in found] == ["Zip Flex"]


def test_active_ends_today_with_change_or_first_trouble(spark):
    def end(status, *pays):
        return classify(*one_loan(spark, status, pays), AT, ["Active"]).collect()[0].To_Date

    assert end("N") == AT.day
    assert end("D") == date(2001, 4, 2)
    later, sooner = (1, date(2001, 4, 9), "P", Decimal(1)), (1, date(2001, 4, 5), "N", Decimal(1))
    assert end("N", later, sooner) == date(2001, 4, 5)
    assert end("N", (1, date(2001, 3, 5), "S", Decimal(1))) == AT.day


def test_return_with_a_time_of_day_is_no_default(spark):
    at_noon = ((1, datetime(2001, 4, 5, 12), "N", Decimal(0)),)
    at_midnight = ((1, datetime(2001, 4, 5), "N", Decimal(0)),)
    assert classify(*one_loan(spark, "R", at_noon), AT, ["Default_C"]).count() == 0
    assert classify(*one_loan(spark, "R", at_midnight), AT, ["Default_C"]).count() == 1


def test_two_returns_on_the_first_day(spark):
    same_day = ((1, date(2001, 4, 5), "N", Decimal(5)), (1, date(2001, 4, 5), "N", Decimal(0)))
    found = classify(*one_loan(spark, "R", same_day), AT, ["Default_C", "Default_P"]).collect()
    assert sorted(r.Status for r in found) == ["Default_C", "Default_P"]


def test_store_without_product_has_no_status(spark):
    assert classify(*one_loan(spark, Merch_Store_Id="s4"), AT, SINGLE).count() == 0


def test_only_loans_paid_off_are_looked_up_among_the_renewed(spark):
    """Before: all loans were shuffled to meet the renewed ones. The others are False without a join."""
    loan_rows, _ = random_tables(11)
    loans = spark.createDataFrame(loan_rows, LOANS)
    spine = loans_with_product(loans, spark.createDataFrame(STORE_ROWS, STORES))
    found = _with_renewed(spine, loans, AT)
    joined = spine.join(renewed_loans(loans), "Appl_No", "left").withColumn("is_renewed", F.coalesce("renewal", F.lit(False)))
    asked = F.coalesce(_paid_off(AT), F.lit(False))
    assert rows(found.select("Appl_No", "is_renewed")) == rows(joined.select("Appl_No", F.col("is_renewed") & asked))
    assert 0 < found.filter("is_renewed").count() < joined.filter("is_renewed").count()
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    left = plan[plan.index("Join LeftOuter") :].split("Aggregate")[0]
    assert "Loan_Status" in left and " IN (D,P)" in left


def old_and_late(seed):
    """Random loans of the window, and as many of five years before; every third of those has a payment returned lately."""
    loan_rows, pay_rows = random_tables(seed, 200)
    back = timedelta(days=5 * 365)
    old = [
        (r[0] + 1000, *r[1:4], r[4] - back, r[5] - back, *r[6:11], r[11] - back if r[0] % 4 else r[11], r[12] - back)
        for r in loan_rows
    ]
    pays = [(p[0] + 1000, p[1] if p[0] % 3 == 0 else p[1] - back, *p[2:]) for p in pay_rows]
    return loan_rows + old, pay_rows + pays


@pytest.mark.parametrize("names", [LOAN_STATUSES, HISTORY_STATUSES])
def test_old_loans_keep_what_reaches_the_window(spark, names):
    loan_rows, pay_rows = old_and_late(8)
    expected = brute_force(loan_rows, pay_rows, names)
    assert {"Default_P", "Default_C"} <= {r[4] for r in expected if r[2] > 1000} or names is HISTORY_STATUSES
    found = classify(*frames(spark, loan_rows, pay_rows), AT, names)
    assert rows(found, *FACT_COLUMNS) == expected


def test_only_loans_that_a_rule_can_take_meet_their_payments(spark):
    """Before: every loan was shuffled to meet its payments."""
    loan_rows, pay_rows = old_and_late(9)
    loans, payments, stores = frames(spark, loan_rows, pay_rows)
    met = _with_payments(loans_with_product(loans, stores), payments, AT, True)
    late = {p[0] for p in pay_rows if p[2] == "N" and AT.window_opens_after < p[1] <= AT.month_close}
    old = {r.Appl_No for r in met.collect() if r.Appl_No > 1000 and (r.Appl_No - 1000) % 4}
    assert old and old <= late
    assert met.count() < loans.count()


def test_history_of_asked_days_only(spark):
    """Before: every loan and every day was shuffled once more, to meet each other."""
    loan_rows, _ = old_and_late(10)
    loans = spark.createDataFrame(loan_rows, LOANS)
    spine = _with_renewed(loans_with_product(loans, spark.createDataFrame(STORE_ROWS, STORES)), loans, AT)
    everything, asked = customer_history(spine, AT), customer_history(spine, AT, only_asked=True)
    assert set(rows(asked)) < set(rows(everything))
    assert rows(asked.filter(asked.day > AT.window_opens_after)) and asked.filter(asked.day < date(1997, 1, 1)).count()
