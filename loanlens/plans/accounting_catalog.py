"""The accounting operators as named queries over one folder of sample tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.functions.loan import cso_share
from loanlens.operators import accounting as A
from loanlens.operators.sinks import write_extract
from loanlens.plans import extract
from loanlens.plans.catalog import Query, Sample, plain
from loanlens.session import run_path
from loanlens.sources.sample_accounting import AccountingSample
from loanlens.sources.tables import clean_codes

P = A.params("00003", date(1999, 1, 1), date(2001, 12, 31), datetime(2002, 1, 1, 6))


class Books(Sample, AccountingSample):
    """Accounting sample tables; loans, payments and transfers are stored as a source would hold them."""

    def loan_appl(self, with_renewals: bool = True) -> DataFrame:
        """No accounting table needs the loan that is renewed; the loans without it are stored as `ca_loan_appl` only.

        With the renewed loan, a number that the orders repeat meets each of its rows. So it does here; the numbers
        that are repeated (if any) are stored first, so that few of them need no shuffle of the loans.
        """
        if with_renewals:
            return super().loan_appl()
        return self.met_as_often(AccountingSample.loan_appl(self, with_renewals=False), "Appl_No")

    def ca_loan_appl(self) -> DataFrame:
        build = super().ca_loan_appl
        return self._kept("ca_loan_appl", lambda: clean_codes(build(), extract.CODES["loans"]))

    def ca_payment(self) -> DataFrame:
        build = super().ca_payment
        return self._kept("ca_payment", lambda: clean_codes(build(), extract.CODES["payments"]))

    def ca_ach_processed(self) -> DataFrame:
        build = super().ca_ach_processed
        return self._kept("ca_ach_processed", lambda: clean_codes(build(), extract.CODES["ach"]))

    def loans_of_stores(self) -> DataFrame:
        return self._kept("accounting-loans", lambda: A.loan_context(self.tables(), P))

    def payments_of_stores(self) -> DataFrame:
        return self._kept("accounting-payments", lambda: A.payment_frame(self.tables(), P, self.loans_of_stores()))

    def report(self) -> DataFrame:
        return self._kept("accounting-report", lambda: extract.report(self.tables(), P))


def _joined(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _query(build: Callable[[A.Tables, DataFrame], list[DataFrame]]) -> Query:
    """A block as a query; `build` gets the tables and the loans of the stores."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        books = Books(spark, folder)
        return plain(_joined(build(books.tables(), books.loans_of_stores())))

    return query


def _paid(build: Callable[[A.Tables, DataFrame], list[DataFrame]]) -> Query:
    """A block over the payments of the window; `build` gets the tables and these payments."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        books = Books(spark, folder)
        return plain(_joined(build(books.tables(), books.payments_of_stores())))

    return query


def _by_line(first: int, names: list[tuple[str, int]], build) -> dict[str, Query]:
    """One query per account of a source of entries."""
    return {
        f"A{first + i:02d}_{name}": build(account) for i, (name, account) in enumerate(names)
    }


def _params(spark: SparkSession, folder: str) -> DataFrame:
    """The parameters as they apply, with the loans they select per store."""
    tables = Books(spark, folder).tables()
    loans = tables.loans.filter(P.here("Merch_Store_Id") & P.during("Date_Created"))
    return loans.groupBy("Merch_Store_Id").agg(
        F.lit(str(P.start)).alias("start_time"),
        F.lit(str(P.end)).alias("end_time"),
        F.lit(A.has_cso(tables, P)).alias("is_cso"),
        F.count("*").alias("loans"),
    )


def _proration(spark: SparkSession, folder: str) -> DataFrame:
    """Fee shares of every payment of a loan with a shared fee."""
    t = Books(spark, folder).tables()
    rated = t.payments.join(t.loans.select("Appl_No", "RateID"), "Appl_No").join(A.cso_rates(t), "RateID")

    def share(fee: str):
        return cso_share(F.col("Fincharge_Paid"), F.col("rate_charge"), F.col(fee))

    return plain(
        rated.select(
            "Pmt_Tran_No",
            share("Origination_Fee").alias("fee_share"),
            share("Interest_Fee").alias("interest_share"),
        )
    )


def _return_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Returned bank transfers of every loan."""
    t = Books(spark, folder).tables()
    return t.loans.join(A.return_counts(t, t.loans), "Appl_No", "left").select(
        "Appl_No", F.coalesce("returns", F.lit(0)).alias("Return_Item_Count")
    )


def _formatted(spark: SparkSession, folder: str) -> DataFrame:
    books = Books(spark, folder)
    return A.formatted(A.with_gl_codes(books.report(), books.tables()), P)


def _extract(spark: SparkSession, folder: str) -> DataFrame:
    return extract.accounting_extract(Books(spark, folder).tables(), P)


ONE_DAY = A.params("00003", date(2000, 11, 15), date(2000, 11, 15), datetime(2002, 1, 1, 6))


def _one_day(spark: SparkSession, folder: str) -> DataFrame:
    """The extract of a single day, as it is run every night."""
    return extract.accounting_extract(Books(spark, folder).tables(), ONE_DAY)


def _stored_extract(spark: SparkSession, folder: str) -> DataFrame:
    """The extract written as files and read back."""
    path = run_path(spark, "extract")
    write_extract(A.sorted_extract(_formatted(spark, folder)), path, "parquet")
    return spark.read.parquet(path)


def accounting_queries() -> dict[str, Query]:
    loan_lines = [("loan_principal", A.PRINCIPAL), ("loan_fincharge", A.FINANCE), ("loan_cso_interest", A.CSO_INTEREST)]
    void_lines = [
        ("void_principal", A.PRINCIPAL), ("void_fincharge", A.FINANCE),
        ("void_cso_interest", A.CSO_INTEREST), ("void_fee", A.FEE),
    ]
    pay_lines = [
        ("pay_principal", A.PRINCIPAL), ("pay_fincharge", A.FINANCE),
        ("pay_cso_interest", A.CSO_INTEREST), ("pay_fees", A.FEE),
    ]
    off_lines = [
        ("principal", A.PRINCIPAL), ("fincharge", A.FINANCE), ("cso_interest", A.CSO_INTEREST), ("fee", A.FEE),
    ]
    change_lines = [("principal", A.PRINCIPAL), ("fincharge", A.FINANCE), ("fee", A.FEE)]

    def cso(t: A.Tables) -> bool:
        return A.has_cso(t, P)

    found = {
        "A00_params": _params,
        **_by_line(1, loan_lines, lambda a: _query(lambda t, c: A.new_loans(t, P, c, cso(t), [a]))),
        **_by_line(4, void_lines, lambda a: _query(lambda t, c: A.voids(t, P, c, cso(t), [a]))),
        **_by_line(8, pay_lines, lambda a: _paid(lambda t, f: A.payments(t, f, cso(t), [a]))),
        "A12_interest_assessed": _paid(A.interest_assessed),
        "A13_prepayment": _paid(A.prepayments),
    }
    for first, name, flag in ((14, "bankrupt", "B"), (18, "chargeoff", "C")):
        lines = [(f"{name}_{line}", account) for line, account in off_lines]
        found |= _by_line(
            first, lines, lambda a, flag=flag: _query(lambda t, c: A.write_offs(t, P, c, cso(t), [flag], [a]))
        )
    found |= {
        "A22_ach_processed": _query(lambda t, c: A.ach_sent(t, P)),
        "A23_petty_cash": _query(lambda t, c: A.petty_cash(t, P)),
        "A24_bank_deposit": _query(lambda t, c: A.deposits(t, P, ["deposit"])),
        "A25_deposit_over_short": _query(lambda t, c: A.deposits(t, P, ["over_short"])),
        "A26_cashed_checks": _query(lambda t, c: A.cashed_checks(t, P, ["check"])),
        "A27_cashed_check_disb": _query(lambda t, c: A.cashed_checks(t, P, ["paid out"])),
        "A28_cash_in_out": _query(lambda t, c: A.cash_in_out(t, P)),
    }
    for first, prefix, kind in ((29, "hist", "changed"), (32, "status_old", "old"), (35, "status_new", "new")):
        lines = [(f"{prefix}_{line}", account) for line, account in change_lines]
        found |= _by_line(
            first, lines, lambda a, kind=kind: _query(lambda t, c: A.balance_changes(t, P, c, [kind], [a]))
        )
    return found | {
        "A38_cso_proration": _proration,
        "A39_return_item_count": _return_counts,
        "A40_gl_enrich_and_format": _formatted,
        "A41_accounting_extract": _extract,
        "A41_one_day_extract": _one_day,
        "sink_extract": _stored_extract,
    }
