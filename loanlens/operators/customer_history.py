"""What a customer did with one product before and after a given day.

The rules "no earlier loan", "a later new loan", "no loan still open" compare each loan with all
other loans of the same customer and product. Joining the loans with each other would cost the
square of the group size, so the group is first added up per day; a customer with any number of
loans then has at most one row per calendar day, and running totals over these rows answer all
the rules. Loans pick up the answer with an equi-join on customer, product and day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loanlens.functions.dates import AsOf, month_of
from loanlens.functions.loan import granted

KEYS = ["Cust_SSN", "Product"]


def _loan_days(loans: DataFrame, at: AsOf) -> DataFrame:
    """Per origin day: any granted loan, any granted new loan, latest closing payment.

    A closing payment counts for a loan paid off in the window that nobody renewed.
    """
    good = granted()
    closed = (
        F.col("Loan_Status").isin("D", "P")
        & at.in_window(F.to_date("LastPmtDate"))
        & ~F.col("is_renewed")
    )
    return loans.select(
        *KEYS,
        F.col("Origin_Date").alias("day"),
        good.alias("good"),
        (good & (F.col("Loan_Type") == "S")).alias("new_loan"),
        F.when(closed, F.to_date("LastPmtDate")).alias("paid"),
        *[F.lit(0).alias(c) for c in ("opened", "closed", "open_in_month")],
    )


def _span_days(spans: DataFrame) -> DataFrame:
    """Open spans as dated +1 / -1 steps.

    A span counts from its first day; it stops counting with the month that follows its
    end. `open_in_month` marks spans that reach at least the start of their own first month.
    """
    blank = [F.lit(False).alias("good"), F.lit(False).alias("new_loan"), F.lit(None).cast("date").alias("paid")]
    first, last = F.to_date("From_Date"), F.to_date("To_Date")
    step = F.explode(
        F.array(
            F.struct(
                first.alias("day"),
                F.lit(1).alias("opened"),
                F.lit(0).alias("closed"),
                (last >= month_of(first)).cast("int").alias("open_in_month"),
            ),
            F.struct(
                F.greatest(first, last).alias("day"),
                F.lit(0).alias("opened"),
                F.lit(1).alias("closed"),
                F.lit(0).alias("open_in_month"),
            ),
        )
    )
    return spans.select(*KEYS, step.alias("s")).select(
        *KEYS, "s.day", *blank, "s.opened", "s.closed", "s.open_in_month"
    )


def first_granted(loans: DataFrame) -> DataFrame:
    """The day of each customer's first granted loan of a product; combined on each mapper before the shuffle."""
    return loans.filter(granted()).groupBy(*KEYS).agg(F.min("Origin_Date").alias("first_day"))


def paid_since(day: Column) -> Column:
    """Whether a loan that started before a day was paid off in its month or later."""
    return F.coalesce(month_of(F.col("paid_before")) >= month_of(day), F.lit(False))


def customer_history(
    loans: DataFrame, at: AsOf, open_spans: DataFrame | None = None, only_asked: bool = False
) -> DataFrame:
    """One row per customer, product and day, with

    `good_before`   a granted loan started earlier,
    `next_new`      the day of the next granted new loan,
    `paid_before`   the latest closing payment of loans that started earlier,
    `open_before`   how many spans began earlier and still run in this day's month.

    `loans` needs Cust_SSN, Product, Origin_Date, Loan_Status, Loan_Type, LastPmtDate, is_renewed;
    `open_spans` needs Cust_SSN, Product, From_Date, To_Date.
    `only_asked` gives only days that the rules ask about: days of the window, days of loans paid off in it, and days
    after the start of a loan that was paid off later.
    """
    # Days of loans that were not granted tell the other days nothing, and no rule asks about them.
    steps = _loan_days(loans.filter(granted()) if only_asked else loans, at)
    if open_spans is not None:
        steps = steps.unionByName(_span_days(open_spans))
    days = (
        steps.filter(F.col("Cust_SSN").isNotNull() & F.col("Product").isNotNull() & F.col("day").isNotNull())
        .groupBy(*KEYS, "day")
        .agg(
            F.max("good").alias("good"),
            F.max("new_loan").alias("new_loan"),
            F.max("paid").alias("paid"),
            F.sum("opened").alias("opened"),
            F.sum("closed").alias("closed"),
            F.sum("open_in_month").alias("open_in_month"),
        )
        .withColumn("month_no", F.year("day") * 12 + F.month("day"))
    )
    # Month and day sort like the day alone; naming both lets the month window reuse the sort.
    # "Later" is the reversed order read forwards: a frame that looks ahead would start over per row.
    in_order = W.partitionBy(*KEYS).orderBy("month_no", "day")
    reversed_order = W.partitionBy(*KEYS).orderBy(F.desc("day"))
    before = in_order.rowsBetween(W.unboundedPreceding, -1)
    after = reversed_order.rowsBetween(W.unboundedPreceding, -1)
    columns = [*KEYS, "day", "good_before", "next_new", "paid_before"]
    history = days.withColumns(
        {
            "good_before": F.coalesce(F.max("good").over(before), F.lit(False)),
            "paid_before": F.max("paid").over(before),
            "running": F.coalesce(F.sum(F.col("opened") - F.col("closed")).over(before), F.lit(0)),
        }
    )
    if open_spans is not None:
        columns.append("open_before")
        month = W.partitionBy(*KEYS, "month_no").orderBy("day")
        carried = F.first("running").over(month.rowsBetween(W.unboundedPreceding, 0))
        started = F.sum("open_in_month").over(month.rowsBetween(W.unboundedPreceding, -1))
        history = history.withColumn("open_before", carried + F.coalesce(started, F.lit(0)))
    next_new = F.min(F.when(F.col("new_loan"), F.col("day"))).over(after)
    history = history.withColumn("next_new", next_new)
    if only_asked:
        in_window = at.in_window(F.to_date("day"))
        history = history.filter(in_window | F.col("paid").isNotNull() | paid_since(F.col("day")))
    return history.select(*columns)
