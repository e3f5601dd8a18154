"""Accounting entries: one function per source of entries, each a short chain of joins.

Every function returns entries in one row shape (`REPORT`). A source that books several amounts
of the same event (principal, finance charge, fee ...) is joined once and its lines are laid out
from the joined row, instead of joining once per line.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from datetime import date, datetime, time, timedelta
from functools import reduce
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.functions.loan import MONEY, cso_share, looked_up, zero_if_null
from loanlens.session import written

TIME = "timestamp_ntz"

# The shape of an entry.
REPORT = {
    "Merchant_Id": "string",
    "Loan_Originating_Store_Id": "string",
    "Transaction_Originating_Store_Id": "string",
    "Loan_Id": "bigint",
    "Cust_Ssn": "string",
    "Cust_Name": "string",
    "Loan_Orig_Date": TIME,
    "Loan_Due_Date": TIME,
    "Loan_Type": "string",
    "Loan_Status": "string",
    "OC_CollectionDate": TIME,
    "Assigned_Collector": "string",
    "Emp_User_Id": "string",
    "Tran_Date_Time": TIME,
    "Tran_Id": "bigint",
    "Tran_Lynk_Id": "bigint",
    "Tran_Type_Id": "int",
    "Tran_Mode": "string",
    "Total_Amount_Of_Transaction": MONEY,
    "Tran_Account": "int",
    "Fee_Type": "string",
    "Loan_Disburse_Subtype": "int",
    "Payment_Sub_Type": "int",
    "Check_Number": "string",
    "Returntype": "int",
    "Return_Item_Count": "int",
    "Cust_State": "string",
    "ACH_No": "bigint",
    "Emp_Origin_UserID": "string",
}

# Accounts of an entry.
PRINCIPAL, FINANCE, FEE, FEE_B, FEE_X, CSO_INTEREST = 1, 2, 3, 4, 5, 6

# Loan statuses reported for new loans.
REPORTED_STATUSES = ["N", "O", "B", "C", "R", "V", "P", "D"]
NEW_LOAN_TYPES = {"S": 1, "R": 2}

# Transaction type by payment type; payment mode G is type 9, other codes are 23.
GIFT_MODE, GIFT_TYPE, OTHER_PAYMENT = "G", 9, 23
PAYMENT_TRAN_TYPES = {
    "X": 1, "B": 1, "S": 4, "R": 5, "N": 6, "A": 27, "P": 7, "G": 8, "U": 16, "W": 21,
    "1": 22, "E": 24, "9": 24, "K": 25, "Q": 29, "6": 30,
}
CSO_PAYMENT_TYPES = ["X", "B", "S", "R", "N", "A", "P", "G", "W", "K"]
PREPAYMENT_TYPES = {"Y": 26, "9": 24}
RETURN_TYPES = {"S": 1, "R": 1, "P": 2, "K": 2, "G": 3, "Q": 4}

# Transaction types of balance changes, by loan status.
TRACKED_STATUSES = ["N", "O", "R", "C", "B", "G"]
RAISED = {"N": 90, "O": 90, "R": 91, "C": 92, "B": 93, "G": 94}
LOWERED = {"N": 95, "O": 95, "R": 96, "C": 97, "B": 98, "G": 99}
LEFT_STATUS = {"N": 80, "O": 80, "R": 81, "C": 82, "B": 83, "G": 84}
ENTERED_STATUS = {"N": 85, "O": 85, "R": 86, "C": 87, "B": 88, "G": 89}


class Tables(Protocol):
    """The source tables. Any object with these attributes will do, read eagerly or on first use."""

    loans: DataFrame
    customers: DataFrame
    users: DataFrame
    collections: DataFrame
    rates: DataFrame
    ach: DataFrame
    ach_returns: DataFrame
    payments: DataFrame
    voids: DataFrame
    fee_details: DataFrame
    interest: DataFrame
    charges: DataFrame
    history: DataFrame
    petty_cash: DataFrame
    balances: DataFrame
    cash: DataFrame
    checks: DataFrame
    gl_codes: DataFrame


@dataclass(frozen=True)
class Params:
    """Merchant or single store, the time window [start, end), and the time printed on the report."""

    merchant: str
    store: str | None
    start: datetime
    end: datetime
    report_time: datetime

    def here(self, store: str) -> Column:
        """Rows of the merchant's stores, or of the one store; both tests reach the scan."""
        test = F.col(store).startswith(self.merchant)
        return test if self.store is None else test & (F.col(store) == self.store)

    def during(self, at: str) -> Column:
        start, end = (F.lit(str(t)).cast(TIME) for t in (self.start, self.end))
        return (F.col(at) >= start) & (F.col(at) < end)


def params(
    store_id: str, first: date | datetime, last: date | datetime, report_time: datetime, exact_times: bool = False
) -> Params:
    """Eleven characters name a store, five a merchant. Days count whole unless times are exact."""
    wanted = store_id.strip()
    if len(wanted) not in (5, 11):
        raise ValueError("give a merchant of 5 or a store of 11 characters")
    store = wanted if len(wanted) == 11 else None

    def stamp(d: date | datetime) -> datetime:
        return d if isinstance(d, datetime) else datetime.combine(d, time())

    start, end = stamp(first), stamp(last)
    if not exact_times:
        start = datetime.combine(start.date(), time())
        end = datetime.combine(end.date() + timedelta(days=1), time())
    return Params(wanted[:5], store, start, end, report_time)


def has_cso(tables: Tables, p: Params) -> bool:
    """Whether the merchant has any fee-sharing rate; looks for a single row."""
    return bool(tables.rates.filter(F.col("StoreID").startswith(p.merchant) & F.col("CSOType")).head(1))


# -- layout ------------------------------------------------------------------------------------


Keep = Callable[[DataFrame, str], DataFrame]


def as_is(df: DataFrame, name: str) -> DataFrame:
    return df


@dataclass(frozen=True)
class Line:
    """One entry of an event: its account and amount, when it is booked, and other own columns."""

    account: Column | int | None
    amount: Column
    holds: Column | None = None
    own: dict[str, Column] = field(default_factory=dict)

    def columns(self) -> dict[str, Column]:
        account = self.account if isinstance(self.account, Column) else F.lit(self.account)
        return {"Tran_Account": account, "Total_Amount_Of_Transaction": self.amount, **self.own}


def entries(frame: DataFrame, shared: dict[str, Column], lines: Sequence[Line]) -> DataFrame:
    """Entries of a frame: columns that all lines share, and one row per line that holds."""

    def typed(values: dict[str, Column], name: str) -> Column:
        if name not in values:
            return F.expr(f"CAST(NULL AS {REPORT[name]}) AS {name}")
        return values[name].cast(REPORT[name]).alias(name)

    if len(lines) == 1:
        line = lines[0]
        rows = frame if line.holds is None else frame.filter(line.holds)
        values = {**shared, **line.columns()}
        return rows.select(*[typed(values, name) for name in REPORT])
    per_line = [n for n in REPORT if any(n in line.columns() for line in lines)]
    rows = []
    for line in lines:
        values = {**shared, **line.columns()}
        row = F.struct(*[typed(values, n) for n in per_line], F.lit(True).alias("booked"))
        rows.append(row if line.holds is None else F.when(line.holds, row))
    every = frame.select(*[typed(shared, n) for n in REPORT if n not in per_line], F.inline(F.array(*rows)))
    return every.filter("booked").select(*REPORT)


# -- the loan side of an entry -------------------------------------------------------------------


def full_name() -> Column:
    """First, middle and last name; a missing first or last name leaves no name at all."""
    return F.concat(
        F.col("Cust_Fname"), F.lit(" "), F.coalesce("Cust_MName", F.lit("")), F.lit(" "), F.col("Cust_Lname")
    )


def event_loans(tables: Tables, p: Params) -> DataFrame:
    """Numbers of the loans that have an event in the window: granted, voided, paid on, written off or corrected."""
    events = [
        tables.loans.filter(p.here("Merch_Store_Id") & p.during("Date_Created")).select("Appl_No"),
        tables.voids.filter(p.during("Date_Created") & (F.col("Void_Type") == "L")).select("Void_No"),
        tables.payments.filter(p.during("Date_Created")).select("Appl_No"),
        tables.charges.filter(p.during("Date_Created")).select("Appl_No"),
        tables.history.filter(p.during("DateCreated") & (F.col("recordstatusid") == "1")).select("ApplNo"),
    ]
    return reduce(DataFrame.union, events).dropna().distinct()


def loan_context(tables: Tables, p: Params) -> DataFrame:
    """Loans of the wanted stores that an entry of the window can be about, with customer, user, collector,
    originating user and (as a list) the rates of the loan.

    The loans are cut down to those with an event before anything is joined, so the work follows the window
    and not the age of the books. Users and rates are small lists, but nothing here forces a broadcast: the
    engine decides by their size. Several users or collection rows for a loan multiply its entries, as booked.
    Callers store the result: sources with a hot loan then join it straight from a shuffle.
    """
    loans = tables.loans.filter(p.here("Merch_Store_Id")).join(event_loans(tables, p), "Appl_No", "left_semi")
    loans = loans.join(return_counts(tables, loans), "Appl_No", "left")
    customers = tables.customers.select(
        "Cust_Id", "Cust_MerchantID", "Cust_State", full_name().alias("Cust_Name")
    )
    staff = tables.users.select(
        F.col("Merch_Id").alias("Cust_MerchantID"), "User_Id", F.col("Merchant_Userid").alias("Emp_User_Id")
    )
    origin = tables.users.select(
        F.col("Merch_Id").alias("Cust_MerchantID"),
        F.col("User_Id").alias("origin_user"),
        F.col("Merchant_Userid").alias("origin_name"),
    )
    placed = tables.collections.select("Appl_No", "PlacedIntoCollections", "Assigned_User_ID")
    return (
        loans.join(customers, "Cust_Id")
        .join(staff, ["Cust_MerchantID", "User_Id"])
        .join(placed, "Appl_No", "left")
        .join(origin, ["Cust_MerchantID", "origin_user"], "left")
        .join(rate_lists(tables), "RateID", "left")
        .select(
            "Appl_No", "Merch_Store_Id", "Cust_SSN", "Origin_Date", "Req_Due_Date", "Loan_Type", "Loan_Status",
            "Appl_Status", "Disb_Mode", "Cashdisbmode", "PrintedCheckNo", "rates", "Req_Loan_Amt", "Fin_Charge",
            F.col("Date_Created").alias("loan_created"),
            "Cust_MerchantID", "Cust_Name", "Cust_State", "PlacedIntoCollections", "Assigned_User_ID", "Emp_User_Id",
            F.coalesce("origin_name", F.lit("")).alias("origin_name"),
            F.coalesce("returns", F.lit(0)).alias("returns"),
        )
    )


def return_counts(tables: Tables, loans: DataFrame) -> DataFrame:
    """Returned bank transfers per loan, for the given loans. Deleted transfers count too."""
    wanted = tables.ach.select("Appl_No", "ACH_No").join(loans.select("Appl_No"), "Appl_No", "left_semi")
    returns = tables.ach_returns.select(F.col("Achno").alias("ACH_No"), "Achretid")
    return wanted.join(returns, "ACH_No").groupBy("Appl_No").agg(F.count("Achretid").alias("returns"))


def loan_side() -> dict[str, Column]:
    return {
        "Merchant_Id": F.col("Cust_MerchantID"),
        "Loan_Originating_Store_Id": F.col("Merch_Store_Id"),
        "Transaction_Originating_Store_Id": F.col("Merch_Store_Id"),
        "Loan_Id": F.col("Appl_No"),
        "Cust_Ssn": F.col("Cust_SSN"),
        "Cust_Name": F.col("Cust_Name"),
        "Loan_Orig_Date": F.coalesce(F.col("Origin_Date").cast(TIME), F.col("loan_created")),
        "Loan_Due_Date": F.col("Req_Due_Date"),
        "Loan_Type": F.col("Loan_Type"),
        "Loan_Status": F.col("Loan_Status"),
        "OC_CollectionDate": F.col("PlacedIntoCollections"),
        "Assigned_Collector": F.col("Assigned_User_ID"),
        "Emp_User_Id": F.col("Emp_User_Id"),
        "Cust_State": F.col("Cust_State"),
        "Emp_Origin_UserID": F.col("origin_name"),
    }


def cso_rates(tables: Tables) -> DataFrame:
    return tables.rates.filter("CSOType").select(
        "RateID", "Origination_Fee", "Interest_Fee", F.col("FinCharge").alias("rate_charge"), F.lit(True).alias("has_rate")
    )


def rate_lists(tables: Tables) -> DataFrame:
    """The fee-sharing rates of each rate number (a few) as one list."""
    rates = cso_rates(tables)
    rate = F.struct(*[c for c in rates.columns if c != "RateID"])
    return rates.groupBy("RateID").agg(F.collect_list(rate).alias("rates"))


def _rated(frame: DataFrame) -> DataFrame:
    """One row per rate of the loan (one without any); `first_rate` marks one row of each."""
    spread = frame.select("*", F.posexplode_outer("rates").alias("rate_no", "rate"))
    return spread.select("*", "rate.*", (F.coalesce("rate_no", F.lit(0)) == 0).alias("first_rate"))


# -- loans and voids -----------------------------------------------------------------------------


def _with_disbursement(context: DataFrame, tables: Tables, stored: bool = True) -> DataFrame:
    """The bank transfer that paid the loan out, for new loans. `stored`: see `_wanted`."""
    sent = tables.ach.filter(
        (F.col("Tran_Code") == "22")
        & (F.col("ACH_For") == "C")
        & (F.col("ACH_Code") == "SND")
        & (F.col("ACH_Sent_Status") == "S")
        & ~F.col("IsDeleted")
    ).select("Appl_No", F.col("ACH_No").alias("ach_no"))
    return context.join(_wanted(sent, "Appl_No", context.select("Appl_No"), stored), "Appl_No", "left")


def _wanted(large: DataFrame, key: str, keys: DataFrame, stored: bool = False) -> DataFrame:
    """Rows of a whole table whose key is asked for.

    A left outer join can't send its small left side to the large right one; this semi-join can. The keys are
    stored, as the engine takes a filtered table for as large as the whole one and would shuffle the large side;
    keys that are a column of a table that is `stored` already need no copy.
    """
    asked = keys.select(F.col(keys.columns[0]).alias("asked_key")).filter("asked_key IS NOT NULL")
    if not stored:
        asked = written(asked.distinct(), "asked-keys")
    return large.join(asked, F.col(key) == F.col("asked_key"), "left_semi")


def _paid_out_by() -> Column:
    return F.when(F.col("Loan_Type") == "S", F.col("ach_no"))


def _origination(cso: bool) -> list[Line]:
    has_rate = F.coalesce("has_rate", F.lit(False))
    lines = [
        Line(FINANCE, F.when(has_rate, zero_if_null(F.col("Origination_Fee"))).otherwise(F.col("Fin_Charge").cast(MONEY)))
    ]
    if cso:
        lines.append(Line(CSO_INTEREST, zero_if_null(F.col("Interest_Fee")), has_rate))
    return lines


def _pick(lines: list[Line], accounts: Sequence[int] | None) -> list[Line]:
    return [line for line in lines if accounts is None or line.account in accounts]


def _lay_out(
    frame: DataFrame, shared: dict[str, Column], plain: list[Line], rated: list[Line], accounts: Sequence[int] | None
) -> list[DataFrame]:
    """Entries that need no rate and entries that do, from one pass; a loan's rates must not multiply the former."""
    plain, rated = _pick(plain, accounts), _pick(rated, accounts)
    if not rated:
        return [entries(frame, shared, plain)] if plain else []
    once = [
        replace(line, holds=F.col("first_rate") if line.holds is None else F.col("first_rate") & line.holds) for line in plain
    ]
    return [entries(_rated(frame), shared, [*once, *rated])]


def new_loans(
    tables: Tables, p: Params, context: DataFrame, cso: bool, accounts: Sequence[int] | None = None
) -> list[DataFrame]:
    booked = context.filter(
        p.during("loan_created") & (F.col("Appl_Status") == "A") & F.col("Loan_Status").isin(REPORTED_STATUSES)
    )
    shared = {
        **loan_side(),
        "Tran_Date_Time": F.col("loan_created"),
        "Tran_Id": F.col("Appl_No"),
        "Tran_Type_Id": looked_up(F.col("Loan_Type"), NEW_LOAN_TYPES),
        "Tran_Mode": F.col("Disb_Mode"),
        "Loan_Disburse_Subtype": F.col("Cashdisbmode"),
        "Check_Number": F.col("PrintedCheckNo"),
        "ACH_No": _paid_out_by(),
    }
    plain = [Line(PRINCIPAL, F.col("Req_Loan_Amt"))]
    return _lay_out(_with_disbursement(booked, tables), shared, plain, _origination(cso), accounts)


def voids(
    tables: Tables, p: Params, context: DataFrame, cso: bool, accounts: Sequence[int] | None = None, keep: Keep = as_is
) -> list[DataFrame]:
    """Voided loans. `keep` may store the frame that both the amounts and the fees are laid out from."""
    void = tables.voids.filter(p.during("Date_Created") & (F.col("Void_Type") == "L")).select(
        F.col("Void_No").alias("Appl_No"), "Void_Id", F.col("Date_Created").alias("voided_at")
    )
    voided = void.join(context, "Appl_No")
    if accounts is None:
        voided = keep(voided, "extract-voids")
    frame = _with_disbursement(voided, tables, stored=False)
    shared = {
        **loan_side(),
        "Tran_Date_Time": F.col("voided_at"),
        "Tran_Id": F.col("Void_Id"),
        "Tran_Lynk_Id": F.col("Appl_No"),
        "Tran_Type_Id": F.lit(3),
        "Tran_Mode": F.col("Disb_Mode"),
        "Loan_Disburse_Subtype": F.col("Cashdisbmode"),
        "ACH_No": _paid_out_by(),
    }
    plain = [Line(PRINCIPAL, F.col("Req_Loan_Amt"))]
    found = _lay_out(frame, shared, plain, _origination(cso), accounts)
    if accounts is None or FEE in accounts:
        fees = _wanted(tables.fee_details.filter(~F.col("Feetypecode").isin("B", "X")), "Appl_No", voided.select("Appl_No"))
        line = Line(FEE, zero_if_null(F.col("Amount")), own={"Fee_Type": F.col("Feetypecode")})
        found.append(entries(frame.join(fees, "Appl_No"), shared, [line]))
    return found


# -- payments ------------------------------------------------------------------------------------


def payment_frame(tables: Tables, p: Params, context: DataFrame) -> DataFrame:
    """Payments of the window with their loan and the payment they refer to.

    Callers store the result: its keys are then sent to the tables that it is joined with. Most payments refer to
    none. They look up their own negative number, which no payment has, so that they do not all meet in one partition.
    """
    pay = tables.payments.filter(p.during("Date_Created")).withColumnRenamed("Merch_Store_Id", "paid_at_store").drop(
        "Date_Created"
    )
    # Payments on other loans leave before anything is shuffled.
    pay = _wanted(pay, "Appl_No", context.select("Appl_No"), stored=True)
    referred = tables.payments.select(F.col("Pmt_Tran_No").alias("ref_key"), F.col("Pmt_Type").alias("ref_type"))
    referred = _wanted(referred, "ref_key", pay.select("Refno"))
    ref_key = F.coalesce(F.col("Refno"), -F.col("Pmt_Tran_No"))
    return (
        pay.join(context, "Appl_No")
        .withColumn("wanted_ref", ref_key)
        .join(referred, (F.col("wanted_ref") == F.col("ref_key")) & F.col("Refno").isNotNull(), "left")
        .drop("wanted_ref")
    )


def _with_transfer(frame: DataFrame, tables: Tables) -> DataFrame:
    """The bank transfers of the payment referred to; several transfers multiply the entry."""
    sent = tables.ach.filter(~F.col("IsDeleted") & F.col("Pmt_No").isNotNull()).select(
        "Pmt_No", F.col("ACH_No").alias("ach_no")
    )
    sent = _wanted(sent, "Pmt_No", frame.select("ref_key"), stored=True)
    found = F.coalesce(F.col("ref_key"), -F.col("Pmt_Tran_No"))
    return frame.withColumn("transfer_of", found).join(
        sent, (F.col("transfer_of") == F.col("Pmt_No")) & F.col("ref_key").isNotNull(), "left"
    )


def _payment_side() -> dict[str, Column]:
    sub_type = F.col("Misintfield1")
    return {
        **loan_side(),
        "Transaction_Originating_Store_Id": F.col("paid_at_store"),
        "Tran_Date_Time": F.col("Pmt_Date"),
        "Tran_Id": F.col("Pmt_Tran_No"),
        "Tran_Lynk_Id": F.col("Refno"),
        "Tran_Type_Id": F.when(F.col("Pmt_Mode") == GIFT_MODE, GIFT_TYPE).otherwise(
            F.coalesce(looked_up(F.col("Pmt_Type"), PAYMENT_TRAN_TYPES), F.lit(OTHER_PAYMENT))
        ),
        "Tran_Mode": F.col("Pmt_Mode"),
        "Payment_Sub_Type": F.when(F.col("Pmt_Mode") != "C", F.nullif(sub_type, F.lit(0))).otherwise(sub_type),
        "Returntype": F.when(F.col("Pmt_Type") == "N", looked_up(F.col("ref_type"), RETURN_TYPES)),
        "Return_Item_Count": F.col("returns"),
        "ACH_No": F.col("ach_no"),
    }


def _paid(name: str) -> Column:
    return zero_if_null(F.col(name))


def payments(
    tables: Tables, frame: DataFrame, cso: bool, accounts: Sequence[int] | None = None, advance: bool = False
) -> list[DataFrame]:
    """Principal, finance charge, shared interest and fees of payments. `frame`: see `payment_frame`.

    `advance` adds the payments in advance, from the same pass.
    """
    principal, finance = _paid("Principle_Paid"), _paid("Fincharge_Paid")
    fees = _paid("latecharge_Paid") + _paid("Othcharge_Paid") + _paid("Feecharge_Paid")
    shares = F.col("Pmt_Type").isin(CSO_PAYMENT_TYPES) & F.coalesce("has_rate", F.lit(False))
    fee_account = F.when(F.col("Pmt_Type") == "B", FEE_B).when(F.col("Pmt_Type") == "X", FEE_X).otherwise(FEE)

    def share(fee: str) -> Column:
        return cso_share(finance, F.col("rate_charge"), F.col(fee))

    plain = []
    if accounts is None or PRINCIPAL in accounts:
        plain.append(Line(PRINCIPAL, principal, principal != 0))
    if accounts is None or FEE in accounts:
        plain.append(Line(fee_account, fees, fees != 0, {"Fee_Type": F.col("Pmt_Type")}))
    rated = []
    if accounts is None or FINANCE in accounts:
        amount = F.when(shares, share("Origination_Fee")).otherwise(finance)
        rated.append(Line(FINANCE, amount, finance != 0))
    if cso and (accounts is None or CSO_INTEREST in accounts):
        rated.append(Line(CSO_INTEREST, share("Interest_Fee"), shares & (finance != 0)))
    if advance:
        rated.append(Line(None, F.col("Pmt_Amt"), _in_advance(), {"Tran_Type_Id": _advance_type()}))
    return _lay_out(_with_transfer(frame, tables), _payment_side(), plain, rated, None)


def _in_advance() -> Column:
    unapplied = (_paid("Principle_Paid") == 0) & (_paid("Fincharge_Paid") == 0) & (_paid("Feecharge_Paid") == 0)
    return F.col("Pmt_Type").isin(list(PREPAYMENT_TYPES)) & unapplied


def _advance_type() -> Column:
    return looked_up(F.col("Pmt_Type"), PREPAYMENT_TYPES)


def prepayments(tables: Tables, frame: DataFrame) -> list[DataFrame]:
    """Payments in advance: booked with their whole amount, as nothing is applied yet."""
    early = _with_transfer(frame.filter(_in_advance()), tables)
    shared = {**_payment_side(), "Tran_Type_Id": _advance_type()}
    return [entries(_rated(early), shared, [Line(None, F.col("Pmt_Amt"))])]


def interest_assessed(tables: Tables, frame: DataFrame) -> list[DataFrame]:
    """Interest assessed with a payment: an entry on the loan, linked to the payment."""
    assessed = tables.interest.filter(F.col("intcalc_Typecode") == "A").select("Pmt_Tran_No", "Amount")
    shared = {
        **_payment_side(),
        "Tran_Id": F.col("Appl_No"),
        "Tran_Lynk_Id": F.col("Pmt_Tran_No"),
        "Tran_Type_Id": F.lit(20),
        "Loan_Disburse_Subtype": F.col("Cashdisbmode"),
    }
    del shared["ACH_No"]
    assessed = _wanted(assessed, "Pmt_Tran_No", frame.select("Pmt_Tran_No"), stored=True)
    return [entries(frame.join(assessed, "Pmt_Tran_No"), shared, [Line(FINANCE, F.col("Amount"))])]


# -- bankruptcies and charge-offs ------------------------------------------------------------------


def write_offs(
    tables: Tables,
    p: Params,
    context: DataFrame,
    cso: bool,
    flags: Sequence[str] = ("B", "C"),
    accounts: Sequence[int] | None = None,
) -> list[DataFrame]:
    """Bankruptcy (B) and charge-off (C) amounts."""
    booked = tables.charges.filter(p.during("Date_Created") & F.col("Bc_Flag").isin(list(flags))).withColumnRenamed(
        "Date_Created", "booked_at"
    )
    shared = {
        **loan_side(),
        "Tran_Date_Time": F.col("booked_at"),
        "Tran_Id": F.col("Bc_No"),
        "Tran_Lynk_Id": F.col("Appl_No"),
        "Tran_Type_Id": F.when(F.col("Bc_Flag") == "B", 28).otherwise(11),
        "Loan_Disburse_Subtype": F.col("Cashdisbmode"),
    }
    finance = _paid("Finamt")
    has_rate = F.coalesce("has_rate", F.lit(False))

    def share(fee: str) -> Column:
        return cso_share(finance, F.col("rate_charge"), F.col(fee))

    # The finance entry of a charge-off always carries the day the loan was entered.
    entered = F.when(F.col("Bc_Flag") == "C", F.col("loan_created")).otherwise(shared["Loan_Orig_Date"])
    plain = [Line(PRINCIPAL, F.col("Prinamt")), Line(FEE, _paid("Feeamt"))]
    amount = F.when(has_rate, share("Origination_Fee")).otherwise(finance)
    rated = [Line(FINANCE, amount, own={"Loan_Orig_Date": entered})]
    if cso:
        own = {"Loan_Orig_Date": shared["Loan_Orig_Date"]}
        rated.append(Line(CSO_INTEREST, share("Interest_Fee"), has_rate, own))
    return _lay_out(booked.join(context, "Appl_No"), shared, plain, rated, accounts)


# -- bank, cash and checks -------------------------------------------------------------------------


def ach_sent(tables: Tables, p: Params) -> list[DataFrame]:
    """Processed bank transfers; loan, customer and users are added where they exist."""
    sent = tables.ach.filter(p.during("ACH_Sent_Time") & p.here("Store_No") & ~F.col("IsDeleted")).withColumn(
        "loan_key", F.coalesce(F.col("Appl_No"), -F.col("ACH_No"))
    )
    loans = tables.loans.select(
        "Appl_No", "Merch_Store_Id", "Cust_Id", "Cust_SSN", "Origin_Date", "Date_Created", "Req_Due_Date",
        "Loan_Type", "Loan_Status", "User_Id", "origin_user",
    )
    loans = _wanted(loans, "Appl_No", sent.select("Appl_No"))
    customers = tables.customers.select("Cust_Id", "Cust_MerchantID", "Cust_State")
    staff = tables.users.select("Merch_Id", "User_Id", "Merchant_Userid")
    with_loan = (
        sent.drop("Appl_No")
        .join(loans, F.col("loan_key") == F.col("Appl_No"), "left")
        .join(customers, "Cust_Id", "left")
        .alias("a")
    )
    frame = with_loan.join(
        staff.alias("u"),
        (F.col("a.Cust_MerchantID") == F.col("u.Merch_Id")) & (F.col("a.User_Id") == F.col("u.User_Id")),
        "left",
    ).join(
        staff.alias("o"),
        (F.col("a.Cust_MerchantID") == F.col("o.Merch_Id")) & (F.col("a.origin_user") == F.col("o.User_Id")),
        "left",
    )
    store = F.when(F.col("ACH_For") == "N", F.col("Store_No")).otherwise(F.col("Merch_Store_Id"))
    shared = {
        "Merchant_Id": F.substring("Store_No", 1, 5),
        "Loan_Originating_Store_Id": store,
        "Transaction_Originating_Store_Id": store,
        "Loan_Id": F.col("Appl_No"),
        "Cust_Ssn": F.col("Cust_SSN"),
        "Cust_Name": F.col("Name"),
        "Loan_Orig_Date": F.coalesce(F.col("Origin_Date").cast(TIME), F.col("Date_Created")),
        "Loan_Due_Date": F.col("Req_Due_Date"),
        "Loan_Type": F.col("Loan_Type"),
        "Loan_Status": F.col("Loan_Status"),
        "Emp_User_Id": F.col("u.Merchant_Userid"),
        "Tran_Date_Time": F.col("ACH_Sent_Time"),
        "Tran_Id": F.col("ACH_No"),
        "Tran_Lynk_Id": F.col("Appl_No"),
        "Tran_Type_Id": F.lit(10),
        "Tran_Mode": F.when(F.col("ACH_For").isin("B", "C", "M"), "A").when(F.col("ACH_For") == "N", "b"),
        "Cust_State": F.col("Cust_State"),
        "ACH_No": F.col("ACH_No"),
        "Emp_Origin_UserID": F.coalesce("o.Merchant_Userid", F.lit("")),
    }
    return [entries(frame, shared, [Line(None, F.col("Ach_Amt"))])]


def _store_entry(store: str, at: str, number: str, user: str, kind: Column, mode: str = "C") -> dict[str, Column]:
    return {
        "Merchant_Id": F.substring(store, 1, 5),
        "Loan_Originating_Store_Id": F.col(store),
        "Transaction_Originating_Store_Id": F.col(store),
        "Emp_User_Id": F.col(user),
        "Tran_Date_Time": F.col(at),
        "Tran_Id": F.col(number),
        "Tran_Type_Id": kind,
        "Tran_Mode": F.lit(mode),
    }


def petty_cash(tables: Tables, p: Params) -> list[DataFrame]:
    rows = tables.petty_cash.filter(p.here("Store_Id") & p.during("Tran_Date"))
    shared = _store_entry("Store_Id", "Tran_Date", "Pettycashtranid", "UserCreated", F.lit(12))
    return [entries(rows, shared, [Line(None, F.col("Tran_Amount"))])]


def deposits(tables: Tables, p: Params, kinds: Sequence[str] = ("deposit", "over_short")) -> list[DataFrame]:
    """Bank deposits, and cash over (14) or short (15), from one read of the balances."""
    rows = tables.balances.filter(p.here("Merch_Store_ID") & p.during("Eff_Bal_Date"))
    gap = F.col("TotOverShort")
    lines = {
        "deposit": Line(
            None, F.col("Actual_Deposit"), F.col("Actual_Deposit") > 0, {"Tran_Type_Id": F.lit(13)}
        ),
        "over_short": Line(
            None, F.abs(gap), F.abs(gap) > 0, {"Tran_Type_Id": F.when(gap > 0, 14).otherwise(15)}
        ),
    }
    shared = _store_entry("Merch_Store_ID", "Eff_Bal_Date", "Balance_ID", "User_ID", F.lit(None))
    return [entries(rows, shared, [lines[k] for k in kinds])]


def cashed_checks(tables: Tables, p: Params, kinds: Sequence[str] = ("check", "paid out")) -> list[DataFrame]:
    """Loan checks cashed in a store, and the money paid out for them.

    The check must name a loan by number, check number and amount; a reference that is no
    number names none.
    """
    checks = tables.checks.filter(p.here("StoreID") & p.during("DateCreated")).select(
        "*", F.expr("try_cast(CheckRefNo AS BIGINT)").alias("ref_loan")
    )
    customers = tables.customers.select(
        F.col("Cust_Id").alias("CustID"), "Cust_SSN", "Cust_State", "Cust_Fname", "Cust_MName", "Cust_Lname"
    )
    loans = tables.loans.select(
        "Appl_No", "Req_Due_Date", "Loan_Type", "Loan_Status", "PrintedCheckNo", "Req_Loan_Amt",
        F.col("Date_Created").alias("loan_created"),
    )
    loans = _wanted(loans, "Appl_No", checks.select("ref_loan"))
    frame = checks.join(customers, "CustID").join(
        loans,
        (F.col("ref_loan") == F.col("Appl_No"))
        & (F.col("CheckNo") == F.col("PrintedCheckNo"))
        & (F.col("CheckAmount") == F.col("Req_Loan_Amt")),
    )
    shared = {
        **_store_entry("StoreID", "DateCreated", "CheckTypeID", "UserCreated", F.lit(None)),
        "Loan_Id": F.col("Appl_No"),
        "Cust_Ssn": F.col("Cust_SSN"),
        "Cust_Name": F.concat(
            F.col("Cust_Fname"), F.lit(",    "), F.col("Cust_MName"), F.lit(" "), F.coalesce("Cust_Lname", F.lit(""))
        ),
        "Loan_Orig_Date": F.col("loan_created"),
        "Loan_Due_Date": F.col("Req_Due_Date"),
        "Loan_Type": F.col("Loan_Type"),
        "Loan_Status": F.col("Loan_Status"),
        "Cust_State": F.col("Cust_State"),
    }
    lines = {
        "check": Line(None, F.col("CheckAmount"), own={"Tran_Type_Id": F.lit(17), "Tran_Mode": F.lit("K")}),
        "paid out": Line(
            None, F.col("CheckAmount") - F.col("FeeAmount"), own={"Tran_Type_Id": F.lit(18), "Tran_Mode": F.lit("C")}
        ),
    }
    return [entries(frame, shared, [lines[k] for k in kinds])]


def cash_in_out(tables: Tables, p: Params) -> list[DataFrame]:
    rows = tables.cash.filter(p.here("StoreID") & p.during("DateCreated"))
    shared = _store_entry("StoreID", "DateCreated", "CashSourceID", "UserCreated", F.lit(19))
    del shared["Loan_Originating_Store_Id"]
    return [entries(rows, shared, [Line(None, F.col("Amount"))])]


# -- balance and status changes --------------------------------------------------------------------

BALANCES = {PRINCIPAL: "principle", FINANCE: "finchg", FEE: "fee"}


def balance_changes(
    tables: Tables,
    p: Params,
    context: DataFrame,
    kinds: Sequence[str] = ("changed", "old", "new"),
    accounts: Sequence[int] = tuple(BALANCES),
) -> list[DataFrame]:
    """Balance corrections and manual status changes: nine possible entries from one history row.

    With the status unchanged, a changed balance is booked by its difference. With a changed
    status, the old balance leaves the old status and the new balance enters the new one.
    """
    rows = tables.history.filter(p.during("DateCreated") & (F.col("recordstatusid") == "1")).withColumnRenamed(
        "ApplNo", "Appl_No"
    )
    was, now = F.col("oldloanstatus"), F.col("newloanstatus")

    def line(kind: str, account: int) -> Line:
        old = F.col(f"old{BALANCES[account]}balance")
        new = F.col(f"new{BALANCES[account]}balance")
        diff = new - old
        if kind == "changed":
            kind_id = F.when(diff > 0, looked_up(was, RAISED)).otherwise(looked_up(was, LOWERED))
            holds = (was == now) & was.isin(TRACKED_STATUSES) & (diff != 0)
            return Line(account, diff, holds, {"Tran_Type_Id": kind_id})
        if kind == "old":
            holds = (was != now) & was.isin(TRACKED_STATUSES) & (old != 0)
            return Line(account, -old, holds, {"Tran_Type_Id": looked_up(was, LEFT_STATUS)})
        holds = (was != now) & now.isin(TRACKED_STATUSES) & (new != 0)
        return Line(account, new, holds, {"Tran_Type_Id": looked_up(now, ENTERED_STATUS)})

    rows = _wanted(rows, "Appl_No", context.select("Appl_No"), stored=True)
    shared = {
        **loan_side(),
        "Tran_Date_Time": F.col("DateCreated"),
        "Tran_Id": F.col("Appl_No"),
        "Tran_Lynk_Id": F.col("Appl_No"),
        "Tran_Mode": F.lit(""),
    }
    return [entries(rows.join(context, "Appl_No"), shared, [line(k, a) for k in kinds for a in accounts])]


# -- the extract -----------------------------------------------------------------------------------


def with_gl_codes(report: DataFrame, tables: Tables) -> DataFrame:
    """General-ledger codes by merchant, transaction type and account, where there are any."""
    codes = tables.gl_codes.select(
        F.col("Merchant_ID").alias("Merchant_Id"), "Tran_Type_Id", "Tran_Account",
        "GL_Code_Debit1", "GL_Code_Debit2", "GL_Code_Credit1", "GL_Code_Credit2",
    )
    return report.join(codes, ["Merchant_Id", "Tran_Type_Id", "Tran_Account"], "left")


# The extract's columns in order; every one is text.
EXTRACT = [
    "Merchant_Id", "Loan_Originating_Store_Id", "Transaction_Originating_Store_Id", "Loan_Id", "Cust_SSN",
    "Cust_Name", "Loan_Orig_Date", "Loan_Due_Date", "Loan_Type", "Loan_Status", "OC_CollectionDate",
    "Assigned_Collector", "Emp_User_Id", "Tran_Date_Time", "Report_Date", "Tran_Id", "Tran_Lynk_Id",
    "Tran_Type_Id", "Tran_Mode", "Total_Amount_Of_Transaction", "Tran_Account", "Fee_Type",
    "Loan_Disburse_Subtype", "Payment_Sub_Type", "Check_Number", "Returntype", "Return_Item_Count",
    "GL_Code_Debit1", "GL_Code_Debit2", "GL_Code_Credit1", "GL_Code_Credit2", "Cust_State", "ACH_No",
    "Emp_Origin_UserID",
]
NO_DATE = "1900-01-01 00:00:00"


def _dated(at: Column, with_time: bool) -> Column:
    """Month/day/year, with the time of day on request.

    Taken from the date-time's own text, as formatting goes through the session's time zone and
    would move times that do not exist there.
    """
    text = F.coalesce(at, F.lit(NO_DATE).cast(TIME)).cast("string")
    day = [F.substring(text, 6, 2), F.lit("/"), F.substring(text, 9, 2), F.lit("/"), F.substring(text, 1, 4)]
    return F.concat(*day, F.lit(" "), F.substring(text, 12, 8)) if with_time else F.concat(*day)


def formatted(report: DataFrame, p: Params) -> DataFrame:
    """The report as text: blanks for NULLs, a fixed early date for missing dates, money with cents."""
    special = {
        "Cust_SSN": F.coalesce("Cust_Ssn", F.lit("")),
        "Loan_Orig_Date": _dated(F.col("Loan_Orig_Date"), False),
        "Loan_Due_Date": _dated(F.col("Loan_Due_Date"), False),
        "Loan_Status": F.coalesce("Loan_Status", F.lit("I")),
        "OC_CollectionDate": _dated(F.col("OC_CollectionDate"), True),
        "Tran_Date_Time": _dated(F.col("Tran_Date_Time"), True),
        "Report_Date": _dated(F.lit(p.report_time.strftime("%Y-%m-%d %H:%M:%S")).cast(TIME), True),
        "Total_Amount_Of_Transaction": F.coalesce(
            F.col("Total_Amount_Of_Transaction").cast("decimal(19,2)").cast("string"), F.lit("")
        ),
    }
    return report.select(
        *[special.get(n, F.coalesce(F.col(n).cast("string"), F.lit(""))).alias(n) for n in EXTRACT]
    )


def sorted_extract(extract: DataFrame) -> DataFrame:
    """Ordered by loan number as text.

    Entries without a loan all share the blank number; further columns break the tie, so that
    the sort can split them over partitions.
    """
    return extract.orderBy("Loan_Id", "Tran_Type_Id", "Tran_Date_Time", "Tran_Id", "Tran_Account")

