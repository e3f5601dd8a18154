"""Month-end projections from the events of the last thirty days and from past deltas."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.functions.dates import AsOf, month_end
from loanlens.functions.loan import METRIC_VALUE
from loanlens.operators.snapshots import EVENT_METRICS, dimensions, event_metrics

RATE_DAYS = 30
DELTA_MONTHS = 6


def recent_events(facts: DataFrame, at: AsOf) -> DataFrame:
    """Events of the last thirty full days, one row per projection they feed."""
    oldest = at.day - timedelta(days=RATE_DAYS + 1)
    chosen = facts.filter(
        F.col("Status").isin(list(EVENT_METRICS))
        & F.col("Product").isNotNull()
        & (F.col("From_Date") > F.lit(oldest))
        & (F.col("To_Date") < F.lit(at.day))
    )
    named = chosen.select("*", F.explode(event_metrics()).alias("base_metric"))
    return named.filter(F.col("base_metric").isNotNull()).withColumn("Metric", F.concat("base_metric", F.lit(" Proj")))


def flow_projection(events: DataFrame, at: AsOf, with_subproduct: bool) -> DataFrame:
    """The daily rate of the last thirty days times the days left in the month."""
    days_left = (at.month_close - at.yesterday).days

    def projected(counted: str) -> Column:
        rate = F.count_distinct(counted).cast("decimal(20,0)") * F.lit(days_left) / F.lit(RATE_DAYS)
        return rate.cast("decimal(28,4)").cast(METRIC_VALUE)

    return events.groupBy(*dimensions(with_subproduct), "Metric").agg(
        F.lit(at.month).alias("Dateref"),
        projected("Cust_SSN").alias("Value_Cust"),
        projected("Appl_No").alias("Value_Loan"),
    )


def delta_projection(metrics: DataFrame, at: AsOf, with_subproduct: bool, names: list[str]) -> DataFrame:
    """The average of the stored deltas of the last months, as the delta expected this month."""
    after = month_end(at.day, -DELTA_MONTHS)
    return (
        metrics.filter(
            F.col("Metric").isin(names) & (F.col("Dateref") < F.lit(at.month)) & (F.col("Dateref") > F.lit(after))
        )
        .groupBy(*dimensions(with_subproduct), F.concat("Metric", F.lit(" Proj")).alias("Metric"))
        .agg(
            F.lit(at.month).alias("Dateref"),
            F.avg("Value_Cust").cast("decimal(28,7)").cast(METRIC_VALUE).alias("Value_Cust"),
            F.lit(None).cast(METRIC_VALUE).alias("Value_Loan"),
        )
    )
