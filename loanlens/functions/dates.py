"""The as-of date of a run and the month windows that follow from it."""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(day: date, shift: int = 0) -> date:
    """First day of the month `shift` months after the month of `day`."""
    months = day.year * 12 + day.month - 1 + shift
    return date(months // 12, months % 12 + 1, 1)


def month_end(day: date, shift: int = 0) -> date:
    first = month_start(day, shift)
    return first.replace(day=calendar.monthrange(first.year, first.month)[1])


@dataclass(frozen=True)
class AsOf:
    """One run date. It replaces "today" everywhere, so a run can be repeated."""

    day: date
    months_back: int = 13

    @property
    def month(self) -> date:
        return month_start(self.day)

    @property
    def month_close(self) -> date:
        return month_end(self.day)

    @property
    def window_opens_after(self) -> date:
        """The last day that is too old: end of the month `months_back` months ago."""
        return month_end(self.day, -self.months_back)

    @property
    def yesterday(self) -> date:
        return self.day - timedelta(days=1)

    def in_window(self, anchor: Column) -> Column:
        """Anchor date inside the rolling window, up to the end of the current month.

        Both bounds are literals, so the test on a bare date column reaches the scan.
        """
        return (anchor > F.lit(self.window_opens_after)) & (anchor <= F.lit(self.month_close))


def month_of(col: Column) -> Column:
    return F.trunc(col, "MM").cast("date")


def is_midnight(col: Column) -> Column:
    """True where a date-time carries no time of day (always true for a plain date)."""
    stamp = col.cast("timestamp_ntz")
    return stamp == stamp.cast("date").cast("timestamp_ntz")
