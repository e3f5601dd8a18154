"""Typed loading: rows of text columns are cast and checked, and what does not fit is kept with all its faults."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loanlens.session import forget, written

# Codes of the faults, in the order in which they are looked for; a column has one fault at most.
KEY_NULL, BAD_TYPE, TOO_WIDE, OUT_OF_RANGE = "KEY_NULL", "BAD_TYPE", "TOO_WIDE", "OUT_OF_RANGE"
FAULTS = "faults"


@dataclass(frozen=True)
class Field:
    """A column of the target: its type, whether it may be missing, and its limits."""

    name: str
    kind: str
    required: bool = False
    width: int | None = None
    low: str | None = None
    high: str | None = None

    def value(self) -> Column:
        return F.col(self.name).try_cast(self.kind)

    def fault(self) -> Column:
        """A struct (column, code, message), or NULL."""
        raw, value = F.col(self.name), self.value()
        tests: list[tuple[Column, str, str]] = []
        if self.required:
            tests.append((raw.isNull(), KEY_NULL, "must not be null"))
        tests.append((raw.isNotNull() & value.isNull(), BAD_TYPE, f"is not of type {self.kind}"))
        if self.width is not None:
            tests.append((F.char_length(raw) > self.width, TOO_WIDE, f"is longer than {self.width}"))
        if self.low is not None:
            tests.append((value < F.lit(self.low).cast(self.kind), OUT_OF_RANGE, f"is below {self.low}"))
        if self.high is not None:
            tests.append((value > F.lit(self.high).cast(self.kind), OUT_OF_RANGE, f"is above {self.high}"))

        def named(code: str, message: str) -> Column:
            parts = {"column": self.name, "errorCode": code, "errorMessage": f"column {self.name} {message}"}
            return F.struct(*[F.lit(v).alias(k) for k, v in parts.items()])

        first = None
        for test, code, message in tests:
            first = F.when(test, named(code, message)) if first is None else first.when(test, named(code, message))
        return first


def checked(rows: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """The raw rows with `faults`: a list of all columns that do not fit, empty for a good row."""
    return rows.withColumn(FAULTS, F.array_compact(F.array(*[f.fault() for f in fields])))


def typed(rows: DataFrame, fields: Sequence[Field]) -> DataFrame:
    return rows.select(*[f.value().alias(f.name) for f in fields])


class TooManyRejects(ValueError):
    pass


def load_checked(
    spark: SparkSession, rows: DataFrame, fields: Sequence[Field], most: float = 1.0
) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """(good rows, typed; rejected rows as they came with `faults`; counts), from one pass over `rows`.

    The pass writes the checked rows, good and bad apart, and counts them as it goes. A share of rejected rows above
    `most` stops the load and leaves nothing behind.
    """
    seen = Observation("checked rows")
    bad = F.size(FAULTS) > 0
    every = checked(rows, fields).withColumn("rejected", bad)
    every = every.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if("rejected").alias("rejected"))
    stored = written(every, "checked", "rejected")
    counts = {k: int(v or 0) for k, v in seen.get.items()}
    if counts["rejected"] > most * counts["rows"]:
        forget(stored)
        raise TooManyRejects(f"{counts['rejected']} of {counts['rows']} rows do not fit")
    good = typed(stored.filter(~F.col("rejected")), fields)
    return good, stored.filter("rejected").drop("rejected"), counts
