"""Stored tables split by columns, changed partition by partition.

A run first finds the partitions that it touches, reads those alone, and puts their new content in place with
a dynamic partition overwrite. Files of other partitions are neither read as a whole nor written. What is found
and written depends on the stored rows and the run's input only, so a run that broke off is simply repeated.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loanlens.session import written


@dataclass(frozen=True)
class PartitionedTable:
    """A parquet folder split by the columns `by`, the last columns of `schema`."""

    spark: SparkSession
    path: str
    schema: StructType
    by: tuple[str, ...]

    def create(self, rows: DataFrame) -> None:
        """Write a first version; the path must be new. A partition is gathered, a large one split."""
        gathered = rows.select(*self.schema.names).hint("rebalance", *self.by)
        gathered.write.mode("errorifexists").partitionBy(*self.by).parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path).select(*self.schema.names)

    def partitions(self, rows: DataFrame | None = None) -> set[tuple]:
        """The partitions that have rows: of the table (the footers answer), or of `rows`. A few per month and status."""
        found = (self.read() if rows is None else rows).select(*self.by).distinct()
        return {tuple(r) for r in found.collect()}

    def test(self, chosen: Iterable[tuple]) -> Column:
        """Whether a row is of a chosen partition, in a form that prunes the scan."""
        ahead: dict = {}
        for *first, last in sorted(chosen, key=str):
            ahead.setdefault(tuple(first), []).append(last)

        def one_of(name: str, values: list) -> Column:
            own = [v for v in values if v is not None]
            tests = [F.col(name).isin(own)] if own else []
            if len(own) < len(values):
                tests.append(F.col(name).isNull())
            return reduce(Column.__or__, tests)

        def head(values: tuple) -> Column:
            tests = [one_of(name, [v]) for name, v in zip(self.by[:-1], values, strict=True)]
            return reduce(Column.__and__, tests, F.lit(True))

        tests = [head(first) & one_of(self.by[-1], last) for first, last in ahead.items()]
        return reduce(Column.__or__, tests, F.lit(False))

    def within(self, chosen: Iterable[tuple]) -> DataFrame:
        return self.read().filter(self.test(chosen))

    def outside(self, chosen: Iterable[tuple]) -> DataFrame:
        """Rows of the other partitions, read by their names: a negated test would not prune."""
        return self.within(self.partitions() - set(chosen))

    def holding(self, keys: DataFrame, key: list[str], besides: set[tuple]) -> set[tuple]:
        """Partitions other than `besides` with rows that match `keys` by `key`. Only key columns are read."""
        rest = self.outside(besides).select(*{c: None for c in [*key, *self.by]}).alias("t")
        return self.partitions(rest.join(keys.select(*key).alias("k"), equal(key, "t", "k"), "left_semi"))

    def replace(self, chosen: Iterable[tuple], rows: DataFrame) -> None:
        """Make `rows` the content of the chosen partitions; those without rows go.

        The new content is written aside first, as it may be read from the partitions that it replaces.
        """
        chosen = set(chosen)
        content = written(rows.select(*self.schema.names).hint("rebalance", *self.by), "replacing")
        filled = self.partitions(content)
        strange = filled - chosen
        if strange:
            raise ValueError(f"rows of partitions that are not replaced: {sorted(strange, key=str)[:3]}")
        if filled:
            gathered = content.hint("rebalance", *self.by)
            gathered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*self.by).parquet(self.path)
        emptied = chosen - filled
        if emptied:
            self._remove(emptied)

    def _remove(self, chosen: set[tuple]) -> None:
        """Delete the folders of partitions. A dynamic overwrite leaves a partition alone for which it has no row."""
        folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
        raw = self.spark.read.schema(self.schema).parquet(self.path)
        places = raw.filter(self.test(chosen)).select(folder.alias("folder")).distinct().collect()
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        for r in places:
            place = hadoop.Path(self.spark._jvm.java.net.URI(r["folder"]))
            place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)


def equal(keys: list[str], one: str, two: str) -> Column:
    """Null-safe equality of all keys."""
    return reduce(Column.__and__, [F.col(f"{one}.{k}").eqNullSafe(F.col(f"{two}.{k}")) for k in keys])


def merge(
    table: PartitionedTable,
    batch: DataFrame,
    key: list[str],
    opened: Iterable[tuple] = (),
    gone: Column | None = None,
    removed: tuple[DataFrame, list[str]] | None = None,
) -> set[tuple]:
    """Merge a run's `batch` (one row per key) into the table; returns the partitions that were rewritten.

    Stored rows with the key of a batch row give way to it, in whatever partition they are. In the partitions
    `opened`, rows for which `gone` holds are dropped; rows that match `removed` (keys, columns) are dropped
    everywhere. All else stays.
    """
    touched = table.partitions(batch) | (set(opened) & table.partitions())
    touched |= table.holding(batch, key, touched)
    if removed is not None:
        touched |= table.holding(removed[0], removed[1], touched)
    kept = table.within(touched)
    if gone is not None:
        kept = kept.filter(~F.coalesce(table.test(opened) & gone, F.lit(False)))
    if removed is not None:
        kept = kept.alias("t").join(removed[0].select(*removed[1]).alias("k"), equal(removed[1], "t", "k"), "left_anti")
    kept = kept.alias("t").join(batch.select(*key).alias("k"), equal(key, "t", "k"), "left_anti")
    table.replace(touched, kept.unionByName(batch))
    return touched
