"""Shared helpers: Arrow text columns as byte blocks, their words and word hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from loanlens.session import ship

# Bytes of text that a task takes together. Its arrays need up to 200 bytes for each, and workers keep memory.
BLOCK_BYTES = 1 << 20
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
# An odd base and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def arrow_batches(spark: SparkSession) -> None:
    """For operators with functions that run in tasks: ship them, and keep very long texts from meeting in one batch."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(2 * BLOCK_BYTES))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores before it until no column of `df` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def column_types(df: DataFrame, names: list[str]) -> str:
    """The named columns as a schema string."""
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in names)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the offsets of its rows; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = column.cast(pa.large_binary()) if column.null_count == 0 else column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = wide.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[wide.offset : wide.offset + len(wide) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `limit` bytes; a longer text is a range of its own."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, hi
        lo = hi


def fold(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case; every other byte as it is."""
    return _FOLD[data]


def words(
    data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = _BREAK
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the row of each.

    Words are `[^\\x20\\x09-\\x0D]+`, or runs of bytes that `breaks` (by byte) does not mark.
    """
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    solid = ~breaks[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    filled = offsets[:-1][offsets[1:] > offsets[:-1]]
    first[filled] = solid[filled]
    tails = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    last[tails] = solid[tails]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, rows


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, in place."""
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next block."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, BLOCK_BYTES + 1024)
        factors = np.full(size, base, dtype=np.uint64)
        factors[0] = 1
        have = np.multiply.accumulate(factors)
        if size <= 4 * BLOCK_BYTES:
            _powers[base] = have
    return have[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash: entry i covers the first i bytes."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    values = data.astype(np.uint64)
    values += np.uint64(1)
    values *= _power(_BASE, len(data))
    np.cumsum(values, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans; equal bytes give equal hashes wherever they stand."""
    raw = prefix[ends] - prefix[starts]
    raw *= _power(_INVERSE, len(prefix))[starts]
    raw ^= (ends - starts).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return mix(raw)


def list_column(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the length of each row's list."""
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def rows_per_batch(frames: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES, column: str = "text"):
    """Each batch cut into parts of about `limit` bytes of text: (part, bytes, offsets)."""
    for batch in frames:
        if not batch.num_rows:
            continue
        place = batch.schema.get_field_index(column)
        data, offsets = text_bytes(batch.column(place))
        for lo, hi in slices(offsets, limit):
            at = offsets[lo : hi + 1]
            yield batch.slice(lo, hi - lo), data[at[0] : at[-1]], at - at[0]


def merged(frames: Iterator[pa.RecordBatch], limit: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches joined up to about `limit` bytes of text, so that equal words meet more often."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in frames:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.column(batch.schema.get_field_index(column)).nbytes
        if size >= limit:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
