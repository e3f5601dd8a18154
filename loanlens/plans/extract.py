"""The daily accounting extract: all sources of entries, general-ledger codes, text form."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame

from loanlens.operators import accounting as A
from loanlens.session import written
from loanlens.sources.tables import clean_codes


# Code columns by table; the source databases compare them without regard to case or trailing blanks.
CODES = {
    "loans": ["Loan_Type", "Loan_Status", "Appl_Status", "Disb_Mode"],
    "payments": ["Pmt_Type", "Pmt_Mode"],
    "ach": ["Tran_Code", "ACH_For", "ACH_Code", "ACH_Sent_Status"],
}


class Cleaned:
    """The tables with their codes in capitals and without trailing blanks."""

    def __init__(self, tables: A.Tables) -> None:
        self._tables = tables

    def __getattr__(self, name: str) -> DataFrame:
        table = getattr(self._tables, name)
        return clean_codes(table, CODES[name]) if name in CODES else table


def report(
    tables: A.Tables, p: A.Params, cut: Callable[[DataFrame, str], DataFrame] | None = written
) -> DataFrame:
    """Every entry of the window.

    The loans of the stores and the payments of the window feed many entries each. They are
    stored once; the sources are small unions over them.
    """
    keep = cut or A.as_is
    tables = Cleaned(tables)
    cso = A.has_cso(tables, p)
    context = keep(A.loan_context(tables, p), "extract-loans")
    paid = keep(A.payment_frame(tables, p, context), "extract-payments")
    parts = [
        *A.new_loans(tables, p, context, cso),
        *A.voids(tables, p, context, cso, keep=keep),
        *A.payments(tables, paid, cso, advance=True),
        *A.interest_assessed(tables, paid),
        *A.write_offs(tables, p, context, cso),
        *A.ach_sent(tables, p),
        *A.petty_cash(tables, p),
        *A.deposits(tables, p),
        *A.cashed_checks(tables, p),
        *A.cash_in_out(tables, p),
        *A.balance_changes(tables, p, context),
    ]
    return reduce(DataFrame.unionByName, parts)


def accounting_extract(tables: A.Tables, p: A.Params) -> DataFrame:
    """The ordered text extract.

    The entries are stored before the sort: a range sort reads its input twice, once to find
    the ranges.
    """
    stored = written(report(tables, p), "extract-entries")
    return A.sorted_extract(A.formatted(A.with_gl_codes(stored, tables), p))
