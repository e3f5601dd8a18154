"""Calendar rows and month starts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.functions.dates import AsOf, month_of


def calendar_days(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One row per day with its month bounds."""
    return _with_months(spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("Date")))


def calendar_of(table: DataFrame, column: str) -> DataFrame:
    """The calendar of a table: every day of the months its dates fall into."""
    span = table.agg(
        F.min(month_of(F.col(column))).alias("first"), F.max(F.last_day(column)).alias("last")
    )
    return _with_months(span.select(F.explode(F.sequence("first", "last")).alias("Date")))


def _with_months(days: DataFrame) -> DataFrame:
    return days.select(
        "Date",
        month_of(F.col("Date")).alias("Month_Start"),
        F.last_day("Date").alias("Month_End"),
        F.date_sub(month_of(F.col("Date")), 1).alias("Prev_Month_End"),
    )


def window_days(days: DataFrame, at: AsOf, to_month_end: bool = True) -> DataFrame:
    """Calendar rows of the rolling window: to the end of the month, or to the as-of day."""
    close = at.month_close if to_month_end else at.day
    return days.filter((F.col("Date") > F.lit(at.window_opens_after)) & (F.col("Date") <= F.lit(close)))


def month_starts(days: DataFrame, at: AsOf) -> DataFrame:
    return window_days(days, at, to_month_end=False).select("Month_Start").distinct()
