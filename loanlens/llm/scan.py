"""Running totals along keys of any length, and sums of arrays over tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.llm import blocks
from loanlens.session import written


def _along(values: np.ndarray, first: np.ndarray, xor: bool, start: int) -> np.ndarray:
    """Running totals within runs of rows; `first` has the first row of each row's run, `start` opens the first run."""
    gather, undo = (np.bitwise_xor.accumulate, np.bitwise_xor) if xor else (np.cumsum, np.subtract)
    total = gather(values)
    out = undo(total, np.where(first > 0, total[first - 1], 0))
    out[first == 0] = np.bitwise_xor(out[first == 0], start) if xor else out[first == 0] + start
    return out


def running(df: DataFrame, key: str, order: list, sums: dict[str, str], xors: dict[str, str] | None = None) -> DataFrame:
    """`df` with running totals added: name -> column (long, not null), up to and with each row, by `key` in `order`.

    Rows are dealt out by ranges of (key, order), so a key with most of the rows is spread over tasks. Each task adds
    up its own rows; a key that goes on in the next range (one per range at most) gets what came before added.
    `key` is a long without nulls. Rows equal in key and order may come either way round.
    """
    xors = xors or {}
    spark = df.sparkSession
    blocks.arrow_batches(spark)
    part, begin = blocks.fresh(df, "part", "begin")
    totals = {**sums, **xors}
    laid = df.repartitionByRange(key, *order).sortWithinPartitions(key, *order).withColumn(part, F.spark_partition_id())
    names = [*laid.columns, *totals]

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, dict.fromkeys(totals, 0)
        for batch in frames:
            if not batch.num_rows:
                continue
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            new = np.ones(len(keys), bool)
            new[1:] = keys[1:] != keys[:-1]
            first = np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))
            added = []
            for name, column in totals.items():
                values = batch.column(column).to_numpy(zero_copy_only=False)
                own = _along(values, first, name in xors, held[name] if keys[0] == last else 0)
                held[name] = int(own[-1])
                added.append(pa.array(own))
            last = keys[-1]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=names)

    schema = ", ".join([blocks.column_types(laid, laid.columns), *(f"`{n}` long" for n in totals)])
    local = written(laid.mapInArrow(run, schema), "running")
    # A range's last key goes on in the next one where that opens with it: a row per range, no more.
    ends = local.groupBy(part).agg(F.min(key).alias("low"), F.max(key).alias("high")).orderBy(part).collect()
    split = {a["high"] for a, b in zip(ends, ends[1:], strict=False) if a["high"] == b["low"]}
    if not split:
        return local.drop(part)
    long = spark.createDataFrame([(k,) for k in sorted(split)], f"`{key}` long")
    pieces = local.join(F.broadcast(long), key).groupBy(key, part).agg(
        *[F.sum(column).alias(name) for name, column in sums.items()],
        *[F.bit_xor(column).alias(name) for name, column in xors.items()],
    )
    carried, at, held = [], None, {}
    for r in pieces.orderBy(key, part).collect():
        if r[key] != at:
            at, held = r[key], dict.fromkeys(totals, 0)
        carried.append((at, r[part], *held.values()))
        held = {n: held[n] ^ r[n] if n in xors else held[n] + r[n] for n in totals}
    before = {n: f"{begin}_{i}" for i, n in enumerate(totals)}
    schema = ", ".join([f"`{key}` long, `{part}` int", *(f"`{b}` long" for b in before.values())])
    fixed = local.join(F.broadcast(spark.createDataFrame(carried, schema)), [key, part], "left")
    for name in totals:
        start = F.coalesce(before[name], F.lit(0))
        fixed = fixed.withColumn(name, F.col(name).bitwiseXOR(start) if name in xors else F.col(name) + start)
    return fixed.select(*df.columns, *totals)
