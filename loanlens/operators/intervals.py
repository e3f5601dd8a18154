"""Interval joins as equi-joins: points that lie in intervals of any length and spacing.

Time is cut into bins, finer ones for short intervals and coarser ones for long ones: an interval goes to the
finest level at which it touches two bins at most, a point to its bin at every level that has intervals. Both sides
then meet by keys, level and bin, and the exact test follows. Nothing is compared with what lies far away, and no
interval is copied more than twice, however long it is. Straight from a shuffle, the join can split hot bins.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Each level's bins are so many times as wide as those of the level below.
STEP = 4


def seconds(moment: Column) -> Column:
    """A date or date-time as whole seconds (rounded down), whatever the session's zone."""
    stamp = moment.cast("timestamp_ntz")
    days = F.datediff(stamp.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    return days * 86400 + F.hour(stamp) * 3600 + F.minute(stamp) * 60 + F.floor(F.second(stamp))


def _bin(at: Column, level: Column, finest: int) -> Column:
    width = F.lit(finest) * F.pow(F.lit(float(STEP)), level).cast("long")
    return F.floor(at / width).cast("long")


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    at: str,
    first: str,
    last: str,
    keys: Sequence[str] = (),
    finest: int = 86400,
    closed: bool = False,
) -> DataFrame:
    """Every row of `points` with every row of `intervals` that holds it: first <= at < last (<= last if `closed`).

    `at`, `first` and `last` name date or date-time columns; `keys` are columns of both sides that must be equal as
    well. Column names of the two sides differ but for the keys. Intervals may overlap, leave gaps and differ in
    length; those that end before they begin hold nothing, nor do rows with a null bound or point. `finest` is the
    finest bin in seconds: about the length of the shortest intervals.
    """
    begin, end = seconds(F.col(first)), seconds(F.col(last))
    sound = intervals.filter(F.col(first) <= F.col(last) if closed else F.col(first) < F.col(last))
    # The least level whose bins are as wide as the interval is long: it then touches two of them at most.
    length = F.greatest(end - begin, F.lit(1)).cast("double")
    level = F.greatest(F.ceil(F.log(float(STEP), length / finest) - 1e-9), F.lit(0)).cast("int")
    levelled = sound.withColumn("_level", level)
    bins = F.sequence(_bin(begin, F.col("_level"), finest), _bin(end, F.col("_level"), finest))
    placed = levelled.withColumn("_bin", F.explode(bins))
    # One small number per level that occurs; there are no more than some twenty.
    levels = [r[0] for r in levelled.select("_level").distinct().collect()]
    if not levels:
        levels = [0]
    spread = points.filter(F.col(at).isNotNull()).withColumn("_level", F.explode(F.array(*[F.lit(n) for n in levels])))
    spread = spread.withColumn("_bin", _bin(seconds(F.col(at)), F.col("_level"), finest))
    left, right = spread.alias("p"), placed.alias("i")
    same = [F.col(f"p.{c}") == F.col(f"i.{c}") for c in [*keys, "_level", "_bin"]]
    inside = [F.col(first) <= F.col(at), F.col(at) <= F.col(last) if closed else F.col(at) < F.col(last)]
    own = [c for c in intervals.columns if c not in keys]
    joined = left.join(right, reduce(Column.__and__, [*same, *inside]))
    return joined.select(*[F.col(f"p.{c}") for c in points.columns], *[F.col(f"i.{c}") for c in own])
