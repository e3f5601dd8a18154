"""Base metrics: how many customers and loans are open at month bounds, and what happened in a month."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.functions.dates import AsOf, month_of, month_start
from loanlens.functions.loan import METRIC_VALUE, MINI, MINI_ONLY, POCKET, THURLOW, ZIP, looked_up

# The metric each event status counts into.
EVENT_METRICS = {
    "New": "New",
    "React": "Reactivated",
    "Paid_D": "Paid Off",
    "Paid_P": "Paid Off after Default",
    "Default_C": "Default (Charges)",
    "Default_P": "Default (Principal)",
    "Default_M": "Default (Principal)",
    "Charged off": "Charged Off",
    "Bankrupt": "Charged Off",
    "PaidRel_1": "Reloaned",
    "PaidRel_2": "Reloaned",
    "Renewed_1": "Reloaned",
    "Renewed_2": "Reloaned",
    "Due": "Due",
}
DEFAULT_ANY = "Default (Any)"
DEFAULT_STATUSES = ["Default_P", "Default_M", "Default_C"]
SPANS = {"Active": "Active", "Collections": "Collections", "Collections_M": "Collections"}

# Statuses that mark a customer as seen in another product; charge-offs and bankruptcies do not.
SEEN_STATUSES = [s for s in EVENT_METRICS if s not in ("Charged off", "Bankrupt")]
OTHER_PRODUCTS = [ZIP, POCKET, THURLOW]
OTHER_PRODUCTS_PROJECTED = [ZIP, POCKET]


def dimensions(with_subproduct: bool) -> list[str]:
    sub = ["Subproduct"] if with_subproduct else []
    return ["Business_Unit", "Product", *sub, "Region", "Province", "Store"]


def metric_columns(with_subproduct: bool) -> list[str]:
    return [*dimensions(with_subproduct), "Metric", "Dateref", "Value_Cust", "Value_Loan", "AsOf_Date"]


def facts_with_store(facts: DataFrame, merchants: DataFrame) -> DataFrame:
    """Fact rows with the dimensions of their store.

    Online small loans are not tied to a place: their province and store stay blank.
    """
    placeless = (F.col("Business_Unit") == "Online") & F.col("Product").eqNullSafe(MINI)
    stores = merchants.select(
        F.col("Merchant_Store_Id").alias("Merch_Store_Id"),
        "Business_Unit",
        "Product",
        "Region",
        F.when(placeless, " ").otherwise(F.col("Province_State")).alias("Province"),
        F.when(placeless, " ").otherwise(F.col("Store")).alias("Store"),
    )
    return facts.join(stores, "Merch_Store_Id")


def _span_class() -> Column:
    return F.when(F.col("Status") == "Active", "Active").otherwise("Collections")


def _is_span() -> Column:
    return F.col("Status").isin(list(SPANS))


# Month starts that one mask holds, a bit each; longer windows take several masks.
MASK_BITS = 60


def _months(at: AsOf) -> tuple[date, date]:
    return month_start(at.window_opens_after, 1), at.month


def month_bounds_of(at: AsOf) -> list[date]:
    """Every month start of the window, and the start of the month after it."""
    first, last = _months(at)
    count = (last.year - first.year) * 12 + last.month - first.month + 2
    return [month_start(first, i) for i in range(count)]


def _masks(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c.startswith("open_")]


def _span_rows(facts: DataFrame) -> DataFrame:
    return facts.filter(_is_span()).withColumn("class", _span_class())


def _is_open(day: date) -> Column:
    """Whether a span covers a day: it began before it and ends on it or later."""
    return F.coalesce((F.col("From_Date") < F.lit(day)) & (F.col("To_Date") >= F.lit(day)), F.lit(False))


def month_bounds(facts: DataFrame, at: AsOf) -> DataFrame:
    """Spans with the month starts of the window at which they are open, as bits (`open_0`, ...), and `today`.

    A span covers a run of month starts, so its bits come from the first and the last of them. Bits of the same
    customer or loan are united by "or" before anything is shuffled; no span is copied per month.
    """
    bounds = month_bounds_of(at)
    base = bounds[0].year * 12 + bounds[0].month

    def number(day: Column) -> Column:
        return F.year(day) * 12 + F.month(day) - F.lit(base)

    low = F.greatest(number(F.col("From_Date")) + 1, F.lit(0))
    high = F.least(number(F.col("To_Date")), F.lit(len(bounds) - 1))

    def mask(lowest: int) -> Column:
        first = F.greatest(low - lowest, F.lit(0))
        last = F.least(high - lowest, F.lit(MASK_BITS - 1))
        return F.when(last >= first, bits_between(first, last)).otherwise(F.lit(0).cast("long"))

    masks = {f"open_{i}": mask(i * MASK_BITS) for i in range(-(-len(bounds) // MASK_BITS))}
    rows = _span_rows(facts).filter((F.col("To_Date") >= F.lit(min(bounds[0], at.day))) & (F.col("From_Date") < F.lit(bounds[-1])))
    rows = rows.withColumns({**masks, "today": _is_open(at.day)})
    return rows.filter(_any_open(rows))


def bits_between(first: Column, last: Column) -> Column:
    """A long with the bits first to last set."""
    one = F.lit(1).cast("long")
    return F.call_function("shiftleft", one, last + 1) - F.call_function("shiftleft", one, first)


def _any_open(rows: DataFrame) -> Column:
    return reduce(Column.__or__, [F.col(c) != 0 for c in _masks(rows)], F.col("today"))


def open_on(facts: DataFrame, day: date) -> DataFrame:
    """Spans open on one day, marked as `today`."""
    return _span_rows(facts).filter(_is_open(day)).withColumn("today", F.lit(True))


def count_people_and_loans(rows: DataFrame, keys: Sequence[str], *extra: Column) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.count_distinct("Cust_SSN").cast(METRIC_VALUE).alias("Value_Cust"),
        F.count_distinct("Appl_No").cast(METRIC_VALUE).alias("Value_Loan"),
        *extra,
    )


def _no_as_of() -> Column:
    return F.lit(None).cast("date").alias("AsOf_Date")


def _counted_bits(rows: DataFrame, dims: Sequence[str], bounds: Sequence[date]) -> DataFrame:
    """Per group and class one list of (bound, Value_Cust, Value_Loan), the last of them, without bound, for today.

    A customer or loan is one row with united bits before it is counted.
    """
    masks = _masks(rows)
    who = F.explode(
        F.array(
            F.struct(F.lit(True).alias("person"), F.col("Cust_SSN").alias("id")),
            F.struct(F.lit(False).alias("person"), F.col("Appl_No").cast("string").alias("id")),
        )
    )
    each = rows.select(*dims, "class", who.alias("who"), *masks, "today").select(*dims, "class", "who.*", *masks, "today")
    united = each.groupBy(*dims, "class", "person", "id").agg(
        *[F.bit_or(c).alias(c) for c in masks], F.max("today").alias("today")
    )

    def counted(bit: Column, bound: Column) -> Column:
        known = bit & F.col("id").isNotNull()
        return F.struct(
            bound.cast("date").alias("bound"),
            F.count_if(known & F.col("person")).cast(METRIC_VALUE).alias("Value_Cust"),
            F.count_if(known & ~F.col("person")).cast(METRIC_VALUE).alias("Value_Loan"),
            F.max(bit).alias("seen"),
        )

    def bit(i: int) -> Column:
        place = F.lit(1 << (i % MASK_BITS)).cast("long")
        return F.col(f"open_{i // MASK_BITS}").bitwiseAND(place) != 0

    counts = [counted(bit(i), F.lit(b)) for i, b in enumerate(bounds)] if masks else []
    return united.groupBy(*dims, "class").agg(F.array(*counts, counted(F.col("today"), F.lit(None))).alias("counts"))


def snapshots(stored: DataFrame, at: AsOf, with_subproduct: bool, kinds: Sequence[str] = ("BOM", "EOM")) -> DataFrame:
    """Opening (BOM) and closing (EOM) counts per month, and with TODAY the current month's closing counts as they stand.

    The closing count of a month is the opening count of the next one, so each bound is counted once and
    reported under both names. The counts of the as-of day replace the current month's closing ones where there
    are any. `stored` comes from `month_bounds`, or (TODAY alone) from `open_on`.
    """
    dims = dimensions(with_subproduct)
    bounds = month_bounds_of(at) if _masks(stored) else []
    counts = F.col("counts")
    no_day = F.lit(None).cast("date")

    def report(kind: str, month: date, place: int, day: Column, wanted: Column) -> Column:
        own = counts[place]
        row = F.struct(
            F.concat("class", F.lit(f" {kind}")).alias("Metric"),
            F.lit(month).alias("Dateref"),
            own["Value_Cust"].alias("Value_Cust"),
            own["Value_Loan"].alias("Value_Loan"),
            day.alias("AsOf_Date"),
        )
        return F.when(own["seen"] & wanted, row)

    rows, today = [], len(bounds)
    if "BOM" in kinds:
        rows += [report("BOM", b, i, no_day, F.lit(True)) for i, b in enumerate(bounds[:-1])]
    if "EOM" in kinds:
        for i, month in enumerate(bounds[:-1]):
            replaced = "TODAY" in kinds and month == at.month
            rows.append(report("EOM", month, i + 1, no_day, ~counts[today]["seen"] if replaced else F.lit(True)))
    if "TODAY" in kinds:
        rows.append(report("EOM", at.month, today, F.lit(at.yesterday), F.lit(True)))
    counted = _counted_bits(stored, dims, bounds).select(*dims, "class", "counts")
    return counted.select(*dims, F.inline(F.array(*rows))).filter(F.col("Metric").isNotNull())


def closing_to_date(open_today: DataFrame, at: AsOf, with_subproduct: bool) -> DataFrame:
    """Closing counts of the current month as they stand on the as-of day."""
    return snapshots(open_today, at, with_subproduct, ["TODAY"])


def closing_zero(facts: DataFrame, at: AsOf, with_subproduct: bool) -> DataFrame:
    """Closing counts of the current month set to zero for every group that has spans at all."""
    dims = dimensions(with_subproduct)
    zero = F.lit(0).cast(METRIC_VALUE)
    return (
        facts.filter(_is_span())
        .select(*dims, F.concat(_span_class(), F.lit(" EOM")).alias("Metric"))
        .distinct()
        .select(
            *dims,
            "Metric",
            F.lit(at.month).alias("Dateref"),
            zero.alias("Value_Cust"),
            zero.alias("Value_Loan"),
            _no_as_of(),
        )
    )


def event_metrics() -> Column:
    """The metrics one event counts into (or NULL): its own, and any default also as `Default (Any)`.

    Customers with several kinds of default in a month count once in the latter, so it cannot
    be added up from the former.
    """
    own = looked_up(F.col("Status"), EVENT_METRICS)
    return F.array(
        F.when(F.col("Product").isNotNull(), own),
        F.when(F.col("Status").isin(DEFAULT_STATUSES), F.lit(DEFAULT_ANY)),
    )


def window_events(facts: DataFrame, at: AsOf) -> DataFrame:
    """Event rows from the window up to yesterday, one per metric they count into."""
    chosen = facts.filter(
        F.col("Status").isin(list(EVENT_METRICS))
        & (F.col("From_Date") > F.lit(at.window_opens_after))
        & (F.col("To_Date") < F.lit(at.day))
    )
    named = chosen.select("*", F.explode(event_metrics()).alias("Metric"), month_of(F.col("From_Date")).alias("Dateref"))
    return named.filter(F.col("Metric").isNotNull())


def flow_counts(events: DataFrame, with_subproduct: bool) -> DataFrame:
    """Customers and loans per month and event metric, with the last day counted."""
    keys = [*dimensions(with_subproduct), "Metric", "Dateref"]
    return count_people_and_loans(events, keys, F.max("To_Date").alias("AsOf_Date"))


# -- customers with small loans only -------------------------------------------------------


def _named_mini_only(rows: DataFrame) -> DataFrame:
    return rows.withColumn("Product", F.lit(MINI_ONLY))


def _seen_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that occur, at most a few times each.

    Doubles are removed within a bucket of loans, not altogether: the result is then not yet
    laid out by the key, so the anti-join shuffles both sides itself and can split a customer
    who holds a large part of the rows.
    """
    bucket = F.pmod(F.hash("Appl_No"), F.lit(8)).alias("bucket")
    return rows.select(*keys, bucket).distinct().drop("bucket")


def mini_only_spans(open_rows: DataFrame) -> DataFrame:
    """Small-loan spans of customers with no other product open at the same moment in the same class.

    What the customer has open elsewhere is one row of bits per class, taken off the spans' own in one join. The
    rows are gathered by one column more than they are joined by: the join then shuffles them itself and can
    split a customer who holds a large part of the spans.
    """
    masks = _masks(open_rows)
    elsewhere = open_rows.filter(F.col("Product").isin(OTHER_PRODUCTS) & F.col("Cust_SSN").isNotNull())
    spread = F.pmod(F.hash("Cust_SSN"), F.lit(1)).alias("spread")
    others = elsewhere.groupBy("Cust_SSN", "class", spread).agg(
        *[F.bit_or(c).alias(f"other_{c}") for c in masks], F.max("today").alias("other_today")
    )
    mini = open_rows.filter(F.col("Product") == MINI).join(others.drop("spread"), ["Cust_SSN", "class"], "left")
    left = {c: F.col(c).bitwiseAND(F.bitwise_not(F.coalesce(f"other_{c}", F.lit(0).cast("long")))) for c in masks}
    left["today"] = F.col("today") & ~F.coalesce("other_today", F.lit(False))
    rows = mini.withColumns(left).drop("other_today", *[f"other_{c}" for c in masks])
    return _named_mini_only(rows.filter(_any_open(rows)))


def mini_only_events(events: DataFrame, facts: DataFrame) -> DataFrame:
    """Small-loan events of customers without an event in another product in the same month."""
    seen = facts.filter(F.col("Product").isin(OTHER_PRODUCTS) & F.col("Status").isin(SEEN_STATUSES))
    others = _seen_keys(seen.withColumn("Dateref", month_of(F.col("From_Date"))), ["Cust_SSN", "Dateref"])
    mini = events.filter(F.col("Product") == MINI)
    return _named_mini_only(mini.join(others, ["Cust_SSN", "Dateref"], "left_anti"))


def mini_only_recent_events(events: DataFrame, facts: DataFrame, at: AsOf) -> DataFrame:
    """The same for projections: the other products are looked up in the current month only."""
    this_month = (F.col("From_Date") >= F.lit(at.month)) & (F.col("From_Date") < F.lit(month_start(at.month, 1)))
    seen = facts.filter(
        F.col("Product").isin(OTHER_PRODUCTS_PROJECTED) & F.col("Status").isin(SEEN_STATUSES) & this_month
    )
    others = _seen_keys(seen, ["Cust_SSN"])
    return _named_mini_only(events.filter(F.col("Product") == MINI).join(others, "Cust_SSN", "left_anti"))
