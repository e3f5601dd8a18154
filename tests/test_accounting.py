from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import TINY, rows
from pyspark.sql import functions as F

from loanlens.functions.loan import cso_share
from loanlens.operators import accounting as A
from loanlens.plans import extract
from loanlens.plans.accounting_catalog import P, Books

NOW = datetime(2002, 1, 1, 6)


@pytest.fixture(scope="module")
def books(spark):
    return Books(spark, TINY)


def test_params_by_length_and_whole_days():
    p = A.params(" 00003 ", date(2001, 1, 1), date(2001, 1, 31), NOW)
    assert (p.merchant, p.store, p.start, p.end) == ("00003", None, datetime(2001, 1, 1), datetime(2001, 2, 1))
    p = A.params("00003000002", datetime(2001, 1, 1, 9), datetime(2001, 1, 1, 17), NOW, exact_times=True)
    assert (p.merchant, p.store, p.start.hour, p.end.hour) == ("00003", "00003000002", 9, 17)
    p = A.params("00003", datetime(2001, 1, 1, 9), datetime(2001, 1, 1, 17), NOW)
    assert (p.start, p.end) == (datetime(2001, 1, 1), datetime(2001, 1, 2))
    for wrong in ("", "123", "000030000021"):
        with pytest.raises(ValueError):
            A.params(wrong, date(2001, 1, 1), date(2001, 1, 1), NOW)


@pytest.mark.parametrize(
    "paid, charge, expected",
    [
        ("30", "30", "12.50"),  # whole charge
        ("40", "30", "12.50"),
        ("10", "30", "4.17"),  # share in cents
        ("-10", "30", "-4.17"),  # reversed share
        ("-30", "30", "-12.50"),  # whole reversal, through the share
        ("-10", "-30", "-12.50"),  # only a charge below zero takes the third case
        ("-40", "-30", "16.67"),
        ("0", "30", "0"),
        (None, "30", "0"),
        ("5", "0", "12.50"),  # nothing charged, something paid
        ("-5", "0", "0"),
        ("-5", None, "0"),
    ],
)
def test_fee_share(spark, paid, charge, expected):
    money = [F.lit(x).cast("decimal(19,4)") for x in (paid, charge, "12.50")]
    found = spark.range(1).select(cso_share(*money)).first()[0]
    assert found == Decimal(expected)


def test_fee_share_of_missing_fee_is_zero(spark):
    money = [F.lit(x).cast("decimal(19,4)") for x in ("10", "30", None)]
    assert spark.range(1).select(cso_share(*money)).first()[0] == 0


def test_names_and_entries_shape(spark, books):
    tables = books.tables()
    context = A.loan_context(tables, P)
    for part in [*A.new_loans(tables, P, context, True), *A.balance_changes(tables, P, context), *A.petty_cash(tables, P)]:
        assert part.columns == list(A.REPORT) and len(part.columns) == 29
    customers = spark.createDataFrame(
        [("a", "b", "c"), ("a", None, "c"), (None, "b", "c"), ("a", "b", None)],
        "Cust_Fname string, Cust_MName string, Cust_Lname string",
    )
    assert {r[0] for r in customers.select(A.full_name()).collect()} == {"a b c", "a  c", None}


def test_formatted_blanks(spark):
    empty = spark.createDataFrame([tuple([None] * 29)], ", ".join(f"{n} {t}" for n, t in A.REPORT.items()))
    gl = empty.selectExpr("*", *[f"cast(null AS string) AS GL_Code_{c}" for c in ("Debit1", "Debit2", "Credit1", "Credit2")])
    found = A.formatted(gl, P).first().asDict()
    assert list(found) == A.EXTRACT and len(found) == 34
    assert found["Loan_Status"] == "I" and found["Loan_Orig_Date"] == "01/01/1900"
    assert found["OC_CollectionDate"] == "01/01/1900 00:00:00" and found["Report_Date"] == "01/01/2002 06:00:00"
    assert all(found[c] == "" for c in ("Loan_Id", "Cust_SSN", "Total_Amount_Of_Transaction", "GL_Code_Debit1"))


def test_extract_is_ordered_text_and_stores_add_up(spark, books):
    tables = books.tables()
    whole = extract.accounting_extract(tables, P)
    found = [r.Loan_Id for r in whole.collect()]
    assert found == sorted(found) and found
    per_store = 0
    for store in range(4):
        p = A.params(f"00003{store:06d}", date(1999, 1, 1), date(2001, 12, 31), NOW)
        per_store += extract.report(tables, p).count()
    assert per_store == len(found)


def test_merchant_without_shared_fees_has_no_interest_entries(spark, books):
    class NoRates:
        def __getattr__(self, name):
            table = getattr(books.tables(), name)
            return table.filter("false") if name == "rates" else table

    tables = NoRates()
    assert not A.has_cso(tables, P)
    context = A.loan_context(tables, P)
    found = extract.reduce(A.DataFrame.unionByName, A.new_loans(tables, P, context, False))
    assert rows(found.select("Tran_Account").distinct()) == [(1,), (2,)]


def test_payment_without_reference_gets_no_return_type(spark, books):
    tables = books.tables()
    frame = A.payment_frame(tables, P, A.loan_context(tables, P))
    assert frame.filter("Refno IS NULL AND ref_type IS NOT NULL").count() == 0
    assert frame.filter("Refno IS NOT NULL AND ref_type IS NULL").count() == 0


def test_whole_tables_meet_only_the_keys_asked_for(spark, books):
    """Before: all payments of the window met the loans, and all fees the voided ones."""
    tables = books.tables()
    context = books.loans_of_stores()

    def semi_joins(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("Join LeftSemi")

    assert semi_joins(A.payment_frame(tables, P, context)) == 2
    assert semi_joins(A.voids(tables, P, context, True, [A.FEE])[0]) == 2
    paid = A.payment_frame(tables, P, context).select("Pmt_Tran_No")
    plain = tables.payments.filter(P.during("Date_Created")).join(context.select("Appl_No"), "Appl_No").select("Pmt_Tran_No")
    assert rows(paid) == rows(plain) != []
