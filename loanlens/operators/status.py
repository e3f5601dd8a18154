"""Loan status rules.

Each rule looks at one loan with a few facts attached (its product, its first return and
collection payments, whether it was renewed, what the customer did before and after) and says
whether the loan gets the status, and for which dates. All rules of one kind are answered in a
single pass over the loans; a single rule is a plain filter that reaches the scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.functions.dates import AsOf, is_midnight, month_of
from loanlens.functions.loan import NOT_A_RENEWAL, granted, subproduct
from loanlens.operators.customer_history import customer_history, first_granted, paid_since
from loanlens.session import written
from loanlens.sources.tables import clean_codes

FACT_KEY = ["Merch_Store_Id", "Subproduct", "Appl_No", "Cust_SSN", "Status"]
FACT_COLUMNS = [*FACT_KEY, "From_Date", "To_Date", "Ref_Date"]

# Columns whose values are compared without regard to case or trailing blanks.
LOAN_CODES = ["Loan_Status", "Loan_Type"]
PAYMENT_CODES = ["Pmt_Type"]

PAYMENTS, RENEWED, HISTORY = "payments", "renewed", "history"


@dataclass(frozen=True)
class Rule:
    """One status: when a loan has it, and its three dates."""

    status: str
    holds: Column
    starts: Column
    ends: Column
    refers: Column
    needs: tuple[str, ...] = ()


# -- attaching facts to loans ------------------------------------------------------------


def loans_with_product(loans: DataFrame, merchants: DataFrame, how: str = "inner") -> DataFrame:
    """Loans with the product of their store and the sub-product; unknown stores stay only with a left join.

    No broadcast hint: the engine broadcasts the stores where their size allows it.
    """
    stores = merchants.select("Merchant_Store_Id", "Product")
    return (
        loans.join(stores, loans.Merch_Store_Id == stores.Merchant_Store_Id, how)
        .withColumn("store_known", F.col("Merchant_Store_Id").isNotNull())
        .drop("Merchant_Store_Id")
        .withColumn("Subproduct", subproduct(F.col("Product"), F.col("Fin_Charge"), F.col("Req_Loan_Amt")))
    )


def payment_profile(payments: DataFrame) -> DataFrame:
    """Per loan the first returned (N) and collection (P) payments; one pass, combined before the shuffle."""
    returned = F.col("Pmt_Type") == "N"
    paid_at = F.col("Pmt_Date")
    return (
        payments.filter(F.col("Pmt_Type").isin("N", "P"))
        .groupBy("Appl_No")
        .agg(
            F.to_date(F.min(paid_at)).alias("first_trouble"),
            F.min(F.when(returned, paid_at)).alias("first_return"),
            F.min(F.when(returned & (F.col("Principle_Paid") == 0), paid_at)).alias("first_charge_return"),
            F.min(F.when(returned & (F.col("Principle_Paid") != 0), paid_at)).alias("first_principal_return"),
            F.to_date(F.min(F.when(F.col("Pmt_Type") == "P", paid_at))).alias("first_collected"),
        )
    )


def renewed_loans(loans: DataFrame) -> DataFrame:
    """Numbers of loans that a later application renews."""
    return (
        loans.filter(F.col("Ren_ApplNo").isNotNull() & ~F.col("Loan_Status").isin(NOT_A_RENEWAL))
        .groupBy(F.col("Ren_ApplNo").alias("Appl_No"))
        .agg(F.lit(True).alias("renewal"))
    )


def _paid_off(at: AsOf) -> Column:
    return F.col("Loan_Status").isin("D", "P") & at.in_window(F.to_date("LastPmtDate"))


def _with_renewed(spine: DataFrame, loans: DataFrame, at: AsOf) -> DataFrame:
    """`is_renewed` of the loans paid off in the window. No rule asks it of others: they have False and need no join."""
    asked = F.coalesce(_paid_off(at), F.lit(False))
    joined = spine.filter(asked).join(renewed_loans(loans), "Appl_No", "left")
    flagged = joined.withColumn("is_renewed", F.coalesce("renewal", F.lit(False))).drop("renewal")
    return flagged.unionByName(spine.filter(~asked).withColumn("is_renewed", F.lit(False)))


def _with_payments(spine: DataFrame, payments: DataFrame, at: AsOf, returns: bool) -> DataFrame:
    """The payment profile of loans that a rule without history can take: with a date of their own in the window, or
    (`returns`) with a payment returned in it.

    The latter's own dates stay out, as they tell nothing. The numbers asked for are stored first, so that the engine
    knows how few they are.
    """
    dates = ["Origin_Date", "LastPmtDate", "Last_Modified", "Req_Due_Date"]
    dated = reduce(Column.__or__, [F.coalesce(at.in_window(F.to_date(c)), F.lit(False)) for c in dates])
    near = spine.filter(dated)
    if returns:
        late = payments.filter((F.col("Pmt_Type") == "N") & at.in_window(F.to_date("Pmt_Date"))).select("Appl_No")
        late = written(late.distinct(), "returned")
        kept = ["Merch_Store_Id", "Subproduct", "Appl_No", "Cust_SSN", "Product", "Loan_Status"]
        blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in spine.schema if f.name not in kept]
        others = spine.filter(~dated).select(*kept).join(late, "Appl_No", "left_semi")
        near = near.unionByName(others.select(*kept, *blank))
    return near.join(payment_profile(payments), "Appl_No", "left")


def _with_history(wide: DataFrame, history: DataFrame, how: str = "left") -> DataFrame:
    return wide.join(
        history.withColumnRenamed("day", "Origin_Date"), ["Cust_SSN", "Product", "Origin_Date"], how
    )


def _with_asked_history(wide: DataFrame, history: DataFrame, at: AsOf, paid_earlier: bool) -> DataFrame:
    """History of the loans that a rule on it can take.

    These start in the window or were paid off in it. Any others (`paid_earlier`) have had an earlier loan paid off since
    their own start: the few such days are stored by themselves, so that the engine knows how few they are.
    """
    history = written(history, "history")
    started = at.in_window(F.to_date("Origin_Date"))
    near = F.coalesce((granted() & (F.col("Loan_Type") == "S") & started) | _paid_off(at), F.lit(False))
    found = _with_history(wide.filter(near), history)
    if not paid_earlier:
        return found
    since = written(history.filter(paid_since(F.col("day")) & ~at.in_window(F.to_date("day"))), "paid_since")
    others = wide.filter(~near & granted() & (F.col("Loan_Type") == "S"))
    return found.unionByName(_with_history(others, since, "inner"))


# -- the rules ---------------------------------------------------------------------------


def rules(at: AsOf) -> dict[str, Rule]:
    """All statuses that depend on one loan. Renewal pairs are in `renewals`."""
    known = F.col("Product").isNotNull()
    good = granted() & known
    status = F.col("Loan_Status")
    new_kind = F.col("Loan_Type") == "S"
    origin = F.to_date("Origin_Date")
    closed = F.to_date("LastPmtDate")
    changed = F.to_date("Last_Modified")
    today = F.lit(at.day)
    started = at.in_window(origin)
    trouble = F.col("first_trouble")
    trouble_free = trouble.isNull()
    earlier = F.coalesce(F.col("good_before"), F.lit(False))
    open_elsewhere = F.coalesce(F.col("open_before"), F.lit(0)) > 0
    reloaned = F.coalesce(F.col("next_new") <= F.last_day(closed), F.lit(False))
    not_renewed = ~F.col("is_renewed")
    charge_return, principal_return = F.col("first_charge_return"), F.col("first_principal_return")

    def on_day(name: str, holds: Column, day: Column, *needs: str) -> Rule:
        return Rule(name, holds, day, day, day, needs)

    listed = [
        Rule(
            "Active",
            good & started,
            F.col("Origin_Date"),
            F.when(trouble_free, F.when(status.isin("N", "O"), today).otherwise(changed)).otherwise(trouble),
            today,
            (PAYMENTS,),
        ),
        Rule(
            "Collections",
            good & started & trouble.isNotNull(),
            trouble,
            F.when(status.isin("P", "C", "B"), changed).otherwise(today),
            today,
            (PAYMENTS,),
        ),
        Rule(
            "Collections_M",
            known & started & (status == "R") & trouble_free,
            F.col("Last_Modified"),
            today,
            today,
            (PAYMENTS,),
        ),
        on_day("Bankrupt", known & (status == "B") & at.in_window(closed), closed),
        on_day("Charged off", known & (status == "C") & at.in_window(closed), closed),
        on_day(
            "Default_C",
            good
            & (charge_return == F.col("first_return"))
            & is_midnight(charge_return)
            & at.in_window(F.to_date(charge_return)),
            F.to_date(charge_return),
            PAYMENTS,
        ),
        on_day(
            "Default_P",
            good & is_midnight(principal_return) & at.in_window(F.to_date(principal_return)),
            F.to_date(principal_return),
            PAYMENTS,
        ),
        on_day(
            "Default_M",
            known & (status == "R") & trouble_free & at.in_window(changed),
            changed,
            PAYMENTS,
        ),
        Rule(
            "Default_M by payment",
            known
            & status.isin("R", "P", "C", "B")
            & F.col("first_collected").isNotNull()
            & F.col("first_return").isNull()
            & is_midnight(F.col("Origin_Date"))
            & started,
            F.col("first_collected"),
            F.col("first_collected"),
            today,
            (PAYMENTS,),
        ),
        on_day(
            "Due",
            good
            & is_midnight(F.col("Req_Due_Date"))
            & at.in_window(F.to_date("Req_Due_Date"))
            & ~(F.coalesce(F.col("Last_Modified") < F.col("Req_Due_Date"), F.lit(False)) & status.isin("C", "B")),
            F.to_date("Req_Due_Date"),
        ),
        on_day("New", good & new_kind & started & ~earlier, origin, HISTORY),
        Rule(
            "React",
            good & new_kind & started & earlier & ~open_elsewhere,
            F.col("Origin_Date"),
            F.col("Origin_Date"),
            origin,
            (HISTORY,),
        ),
        on_day(
            "Paid_D",
            known & (status == "D") & at.in_window(closed) & not_renewed & ~reloaned,
            closed,
            RENEWED,
            HISTORY,
        ),
        on_day("Paid_P", known & (status == "P") & at.in_window(closed), closed),
        on_day(
            "PaidRel_1",
            known & status.isin("D", "P") & at.in_window(closed) & not_renewed & reloaned,
            closed,
            RENEWED,
            HISTORY,
        ),
        Rule(
            "PaidRel_2",
            good & new_kind & (month_of(F.col("paid_before")) >= month_of(origin)),
            F.col("Origin_Date"),
            F.col("Origin_Date"),
            F.col("paid_before"),
            (HISTORY,),
        ),
    ]
    return {rule.status: rule for rule in listed}


# Rules whose rows carry another rule's label.
LABELS = {"Default_M by payment": "Default_M"}


def _emit(wide: DataFrame, chosen: Sequence[Rule]) -> DataFrame:
    """Fact rows of the chosen rules; several rules share one pass over the loans."""

    def row(rule: Rule) -> Column:
        return F.struct(
            F.lit(LABELS.get(rule.status, rule.status)).alias("Status"),
            rule.starts.cast("date").alias("From_Date"),
            rule.ends.cast("date").alias("To_Date"),
            rule.refers.cast("date").alias("Ref_Date"),
        )

    loan = ["Merch_Store_Id", "Subproduct", "Appl_No", "Cust_SSN"]
    if len(chosen) == 1:
        return wide.filter(chosen[0].holds).select(*loan, row(chosen[0]).alias("r")).select(*loan, "r.*")
    rows = F.array(*[F.when(r.holds, row(r)) for r in chosen])
    return wide.select(*loan, F.inline(rows)).filter(F.col("Status").isNotNull())


def classify(
    loans: DataFrame,
    payments: DataFrame,
    merchants: DataFrame,
    at: AsOf,
    statuses: Sequence[str],
    stored_facts: DataFrame | None = None,
) -> DataFrame:
    """Fact rows of the given statuses.

    `stored_facts` are fact rows of earlier runs: an Active row in there keeps a customer from
    counting as reactivated, just as the Active rows of this run do.
    """
    loans, payments = clean_codes(loans, LOAN_CODES), clean_codes(payments, PAYMENT_CODES)
    table = rules(at)
    chosen = [table[name] for name in statuses]
    needs = {need for rule in chosen for need in rule.needs}
    spine = loans_with_product(loans, merchants)
    wide = spine
    if PAYMENTS in needs and HISTORY not in needs:
        wide = _with_payments(spine, payments, at, not {"Default_C", "Default_P"}.isdisjoint(statuses))
    elif PAYMENTS in needs:
        wide = wide.join(payment_profile(payments), "Appl_No", "left")
    by_history = all(HISTORY in rule.needs for rule in chosen)
    if by_history:
        # Every rule on the history asks for a granted new loan or one paid off in the window.
        wide = wide.filter((granted() & (F.col("Loan_Type") == "S")) | _paid_off(at))
    if RENEWED in needs:
        wide = _with_renewed(wide, loans, at)
    if HISTORY in needs and set(statuses) == {"New"}:
        # Whether a customer had an earlier loan needs the first one's day only.
        wide = wide.join(first_granted(spine), ["Cust_SSN", "Product"], "left")
        wide = wide.withColumn("good_before", F.coalesce(F.col("first_day") < F.col("Origin_Date"), F.lit(False)))
    elif HISTORY in needs:
        spans = None
        if "React" in statuses:
            spans = active_spans(spine, payments, merchants, at, stored_facts)
        history = customer_history(_with_renewed(spine, loans, at), at, spans, by_history)
        if by_history:
            wide = _with_asked_history(wide, history, at, "PaidRel_2" in statuses)
        else:
            wide = _with_history(wide, history)
        if spans is None:
            wide = wide.withColumn("open_before", F.lit(0))
        elif stored_facts is not None:
            wide = _without_own_spans(wide, spine, stored_facts, merchants)
    return _emit(wide, chosen)


def active_spans(
    spine: DataFrame,
    payments: DataFrame,
    merchants: DataFrame,
    at: AsOf,
    stored_facts: DataFrame | None = None,
) -> DataFrame:
    """Customer, product and dates of every Active row: this run's, and stored ones it does not replace."""
    active = rules(at)["Active"]
    wide = spine.join(payment_profile(payments), "Appl_No", "left").filter(active.holds)
    fresh = wide.select(
        "Cust_SSN",
        "Product",
        active.starts.cast("date").alias("From_Date"),
        active.ends.cast("date").alias("To_Date"),
        "Appl_No",
        "Merch_Store_Id",
        "Subproduct",
    )
    columns = ["Cust_SSN", "Product", "From_Date", "To_Date"]
    if stored_facts is None:
        return fresh.select(*columns)
    stored = stored_facts.filter(F.col("Status") == "Active").join(
        fresh, ["Merch_Store_Id", "Subproduct", "Appl_No", "Cust_SSN"], "left_anti"
    )
    return fresh.select(*columns).unionByName(_with_store_product(stored, merchants).select(*columns))


def _with_store_product(facts: DataFrame, merchants: DataFrame) -> DataFrame:
    stores = merchants.select(F.col("Merchant_Store_Id").alias("Merch_Store_Id"), "Product")
    return facts.join(stores, "Merch_Store_Id")


def _without_own_spans(
    wide: DataFrame, spine: DataFrame, stored_facts: DataFrame, merchants: DataFrame
) -> DataFrame:
    """Take a loan's own stored Active rows out of `open_before`: only other loans count.

    They are counted from the loans before any history was joined (`spine`).
    """
    own = (
        _with_store_product(stored_facts.filter(F.col("Status") == "Active"), merchants)
        .select(
            "Appl_No",
            F.col("Cust_SSN").alias("own_ssn"),
            F.col("Product").alias("own_product"),
            F.col("From_Date").alias("own_from"),
            F.col("To_Date").alias("own_to"),
            *[F.col(c).alias(f"own_{c}") for c in ("Merch_Store_Id", "Subproduct")],
        )
    )
    # A stored row with the key of this run is replaced by a fresh one that starts on the
    # loan's own origin day and so was never counted against it.
    replaced = (F.col("own_Merch_Store_Id") == F.col("Merch_Store_Id")) & F.col("own_Subproduct").eqNullSafe(
        F.col("Subproduct")
    )
    counted = (
        spine.join(own, "Appl_No")
        .filter(
            (F.col("own_ssn") == F.col("Cust_SSN"))
            & (F.col("own_product") == F.col("Product"))
            & (F.col("own_from") < F.col("Origin_Date"))
            & (F.col("own_to") >= month_of(F.col("Origin_Date")))
            & ~replaced
        )
        .groupBy("Appl_No")
        .agg(F.count("*").alias("own_open"))
    )
    return (
        wide.join(counted, "Appl_No", "left")
        .withColumn("open_before", F.col("open_before") - F.coalesce("own_open", F.lit(0)))
        .drop("own_open")
    )


def renewals(loans: DataFrame, merchants: DataFrame, at: AsOf, statuses: Sequence[str]) -> DataFrame:
    """Renewal pairs: `Renewed_1` rows for the old loan, `Renewed_2` rows for the new one.

    One join on the loan number gives both; loans without a predecessor leave before it.
    """
    kept = ["Merch_Store_Id", "Subproduct", "Appl_No", "Cust_SSN"]
    loans = clean_codes(loans, LOAN_CODES)
    spine = loans_with_product(loans, merchants, "left").filter(granted())
    old = spine.filter(F.col("Product").isNotNull()).select(*[F.col(c).alias(f"old_{c}") for c in kept])
    new = spine.filter(
        (F.col("Loan_Type") == "R") & F.col("Ren_ApplNo").isNotNull() & at.in_window(F.to_date("Origin_Date"))
    ).select(*kept, "Ren_ApplNo", "store_known", F.to_date("Origin_Date").alias("renewed_on"))
    # The loans renewed in the window are stored first, so that the engine knows how few old loans are asked for.
    new = written(new, "renewing")
    old = old.join(new.select(F.col("Ren_ApplNo").alias("old_Appl_No")), "old_Appl_No", "left_semi")
    pairs = new.join(old, (F.col("Ren_ApplNo") == F.col("old_Appl_No")) & (F.col("Cust_SSN") == F.col("old_Cust_SSN")))

    def side(label: str, prefix: str) -> Column:
        return F.struct(*[F.col(f"{prefix}{c}").alias(c) for c in kept], F.lit(label).alias("Status"))

    sides = []
    if "Renewed_1" in statuses:
        sides.append(side("Renewed_1", "old_"))
    if "Renewed_2" in statuses:
        # Only the new loan's own row asks for the new loan's store.
        sides.append(F.when(F.col("store_known"), side("Renewed_2", "")))
    on = F.col("renewed_on")
    return (
        pairs.select(on, F.explode(F.array(*sides)).alias("s"))
        .filter(F.col("s").isNotNull())
        .select("s.*", on.alias("From_Date"), on.alias("To_Date"), on.alias("Ref_Date"))
    )
