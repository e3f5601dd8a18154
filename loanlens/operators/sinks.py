"""Changing stored tables: upsert, deletes and rejected rows, all as plain table expressions.

Each function returns the new content. A run writes it to a new version of the table, so an
interrupted write never leaves a half-changed table behind.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_per_key(batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the greatest by `order`; combined on each mapper before the shuffle."""
    rest = [c for c in batch.columns if c not in keys]
    ranked = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest if c not in order])
    return batch.groupBy(*keys).agg(F.max(ranked).alias("r")).select(
        *[F.col(c) if c in keys else F.col(f"r.{c}").alias(c) for c in batch.columns]
    )


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `batch` replace rows of `target` with the same key; other target rows stay.

    Columns that the batch does not carry keep the stored value. `batch` has one row per key.
    """
    carried = [c for c in target.columns if c not in batch.columns]
    if not carried:
        kept = target.alias("t").join(batch.select(*keys).alias("b"), _key_test(keys), "left_anti")
        return kept.unionByName(batch)
    stored = target.select(*keys, *carried)
    fresh = batch.alias("b").join(stored.alias("t"), _key_test(keys), "left").select(
        "b.*", *[F.col(f"t.{c}") for c in carried]
    )
    kept = target.alias("t").join(batch.select(*keys).alias("b"), _key_test(keys), "left_anti")
    return kept.unionByName(fresh)


def _key_test(keys: Sequence[str]) -> Column:
    test = F.lit(True)
    for key in keys:
        test = test & F.col(f"t.{key}").eqNullSafe(F.col(f"b.{key}"))
    return test


def delete_status_window(facts: DataFrame, statuses: Sequence[str], after: date) -> DataFrame:
    """Drop fact rows of the given statuses that refer to a day after `after`."""
    gone = F.col("Status").isin(list(statuses)) & (F.col("Ref_Date") > F.lit(after))
    return facts.filter(~F.coalesce(gone, F.lit(False)))


def delete_projections(metrics: DataFrame) -> DataFrame:
    """Drop stored projections before a new metric run."""
    return metrics.filter(~F.col("Metric").endswith("Proj"))


def delete_by_key(table: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    return table.join(gone.select(key), key, "left_anti")


def split_rejects(rows: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows fit to be stored, and the rest with an error code and message.

    A row is rejected when a key column is NULL. The first missing column is named.
    """
    missing = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required])
    good = rows.filter(missing.isNull())
    bad = rows.filter(missing.isNotNull()).select(
        "*",
        F.lit("KEY_NULL").alias("errorCode"),
        F.concat(F.lit("column "), missing, F.lit(" must not be null")).alias("errorMessage"),
    )
    return good, bad


def write_version(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Write one complete version of a table; the path must be new."""
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def write_database(df: DataFrame, url: str, table: str, properties: dict[str, str], writers: int = 16) -> None:
    """Append rows to a database table; a repeated run appends them again.

    The rows are dealt to `writers` connections by a shuffle, so the work before it keeps all its tasks.
    """
    df.repartition(writers).write.option("batchsize", "10000").jdbc(url, table, mode="append", properties=properties)


def write_extract(df: DataFrame, path: str, form: str = "csv") -> None:
    """Write the ordered extract as files."""
    writer = df.write.mode("errorifexists")
    if form == "csv":
        writer.option("header", "true").option("emptyValue", "").csv(path)
    else:
        writer.format(form).save(path)
