"""The status load: all rules over all loans, merged into the stored fact table."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.functions.dates import AsOf, month_end, month_of, month_start
from loanlens.operators.partitioned import PartitionedTable, merge
from loanlens.operators.sinks import delete_by_key, delete_status_window, last_per_key, upsert
from loanlens.operators.status import FACT_COLUMNS, FACT_KEY, LOAN_CODES, classify, renewals
from loanlens.session import written
from loanlens.sources.tables import clean_codes

SPAN_STATUSES = ["Active", "Collections", "Collections_M"]
# Two passes: the second needs the customer history, the first does not.
LOAN_STATUSES = [
    *SPAN_STATUSES, "Bankrupt", "Charged off", "Default_C", "Default_P", "Default_M",
    "Default_M by payment", "Due", "Paid_P",
]
HISTORY_STATUSES = ["New", "React", "Paid_D", "PaidRel_1", "PaidRel_2"]
RENEWAL_STATUSES = ["Renewed_1", "Renewed_2"]
# Statuses whose stored rows of the window are removed before a reload.
RELOADED = [
    "Bankrupt", "Charged off", "Default_C", "Default_M", "Default_P", "Due", "New",
    "PaidRel_1", "PaidRel_2", "Paid_D", "Paid_P", "React", "Renewed_1", "Renewed_2",
]


def fact_batch(
    loans: DataFrame,
    payments: DataFrame,
    merchants: DataFrame,
    at: AsOf,
    stored: DataFrame | None = None,
) -> DataFrame:
    """Every fact row of one run, one row per key.

    Only renewal rows can repeat a key (a loan renewed twice); the latest renewal stays.
    """
    by_loan = classify(loans, payments, merchants, at, LOAN_STATUSES)
    by_history = classify(loans, payments, merchants, at, HISTORY_STATUSES, stored)
    renewed = last_per_key(
        renewals(loans, merchants, at, RENEWAL_STATUSES), FACT_KEY, ["From_Date", "To_Date", "Ref_Date"]
    )
    return by_loan.unionByName(by_history).unionByName(renewed)


def voided_loans(loans: DataFrame) -> DataFrame:
    return clean_codes(loans, LOAN_CODES).filter(F.col("Loan_Status") == "V").select("Appl_No")


def load_facts(
    loans: DataFrame,
    payments: DataFrame,
    merchants: DataFrame,
    at: AsOf,
    stored: DataFrame | None = None,
) -> DataFrame:
    """The fact table after one run over `stored` (nothing stored: a first run)."""
    batch = fact_batch(loans, payments, merchants, at, stored)
    if stored is None:
        return batch
    # No rule gives a voided loan a row, so only stored rows can be of one.
    kept = delete_status_window(stored, RELOADED, at.window_opens_after)
    return upsert(delete_by_key(kept, voided_loans(loans), "Appl_No"), batch, FACT_KEY)


# -- the stored fact table, split by status and reference month ------------------------------

BY = ("Status", "Ref_Month")


def fact_table(spark: SparkSession, path: str, loans: DataFrame) -> PartitionedTable:
    """The fact table in a folder. Every row carries the time of the run that wrote it."""
    number = loans.schema["Appl_No"].dataType
    text, day = T.StringType(), T.DateType()
    kinds = {"Merch_Store_Id": text, "Subproduct": text, "Appl_No": number, "Cust_SSN": text}
    kinds |= {"From_Date": day, "To_Date": day, "Ref_Date": day, "RunTimeStamp": T.TimestampNTZType()}
    kinds |= {"Status": text, "Ref_Month": day}
    return PartitionedTable(spark, path, T.StructType([T.StructField(n, k) for n, k in kinds.items()]), BY)


def stamped(batch: DataFrame, ran_at: datetime) -> DataFrame:
    stamp = F.lit(ran_at.isoformat(" ")).cast("timestamp_ntz")
    return batch.select(*FACT_COLUMNS, stamp.alias("RunTimeStamp"), month_of(F.col("Ref_Date")).alias("Ref_Month"))


def _still_open(stored: DataFrame, at: AsOf) -> DataFrame:
    """Stored rows that can bear on a loan of the window: open in its first month or later."""
    opens = month_start(at.window_opens_after + timedelta(days=1))
    return stored.filter((F.col("Status") == "Active") & (F.col("To_Date") >= F.lit(opens)))


def _reloaded(table: PartitionedTable, at: AsOf) -> set[tuple]:
    """Stored partitions whose rows a run drops before it writes its own."""
    after = at.window_opens_after
    return {(s, m) for s, m in table.partitions() if s in RELOADED and m is not None and m > after}


def delete_window(table: PartitionedTable, statuses: list[str], after: date) -> set[tuple]:
    """Drop stored rows of the given statuses that refer to a day after `after`; returns the partitions reached."""
    reached = {(s, m) for s, m in table.partitions() if s in statuses and m is not None and month_end(m) > after}
    table.replace(reached, delete_status_window(table.within(reached), statuses, after))
    return reached


def store_run(
    table: PartitionedTable, loans: DataFrame, payments: DataFrame, merchants: DataFrame, at: AsOf, ran_at: datetime,
    first: bool = False,
) -> set[tuple]:
    """One run into the stored table, as `load_facts` but in place; returns the partitions that were rewritten.

    The window of the reloaded statuses opens with a month, so whole partitions fall into it. Rows of a span status
    refer to the day of the run: last month's row of a loan that is still in the window is found by its key and goes.
    """
    if first:
        table.create(stamped(fact_batch(loans, payments, merchants, at), ran_at))
        return table.partitions()
    batch = fact_batch(loans, payments, merchants, at, _still_open(table.read(), at).select(*FACT_COLUMNS))
    batch = written(stamped(batch, ran_at), "batch")
    return merge(table, batch, FACT_KEY, _reloaded(table, at), F.lit(True), (voided_loans(loans), ["Appl_No"]))


def store_changes(
    table: PartitionedTable, loans: DataFrame, payments: DataFrame, merchants: DataFrame, at: AsOf, ran_at: datetime,
    changes: DataFrame,
) -> set[tuple]:
    """Bring the stored table up to date after some loans changed, on the day of its last run.

    `loans` and `payments` are the whole tables as they are now. `changes` (Appl_No, Cust_SSN, Ren_ApplNo) has the loan
    rows that changed or whose payments did, as they were and as they are. A loan bears on other loans of its
    customer, and on the loan that it renews; so all loans of the customers reached are classified anew, and nobody
    else's. The result is that of `store_run`, but for RunTimeStamp of rows that did not have to be looked at.
    """
    changes = changes.select("Appl_No", "Cust_SSN", "Ren_ApplNo")
    reached = changes.select("Appl_No").union(changes.select("Ren_ApplNo").dropna()).distinct()
    people = changes.select("Cust_SSN").union(loans.join(reached, "Appl_No", "left_semi").select("Cust_SSN"))
    people = written(people.dropna().distinct(), "people")
    own = written(loans.join(people, "Cust_SSN", "left_semi"), "own")
    # Renewals by other customers tell only that a loan is renewed; rows of their own are not wanted.
    renewing = loans.join(own.select(F.col("Appl_No").alias("Ren_ApplNo")), "Ren_ApplNo", "left_semi")
    renewing = renewing.join(people, "Cust_SSN", "left_anti")
    near = written(own.unionByName(renewing), "near")
    paid = payments.join(near.select("Appl_No"), "Appl_No", "left_semi")
    stored = _still_open(table.read(), at).join(people, "Cust_SSN", "left_semi")
    batch = fact_batch(near, paid, merchants, at, stored.select(*FACT_COLUMNS)).join(people, "Cust_SSN", "left_semi")
    batch = written(stamped(batch.select(*FACT_COLUMNS), ran_at), "batch")
    # Rows of the window that the run would have dropped and not written again, and rows of voided loans.
    reloaded = _reloaded(table, at)
    theirs = table.within(reloaded).join(people, "Cust_SSN", "left_semi").select(*FACT_KEY)
    void = voided_loans(own).select("Appl_No")
    stale = theirs.union(table.read().join(void, "Appl_No", "left_semi").select(*FACT_KEY))
    return merge(table, batch, FACT_KEY, removed=(written(stale.distinct(), "stale"), FACT_KEY))
