"""Document fingerprints: digests of statistically improbable byte windows.

1. Each window of 64 bytes has an entropy, kept in 1/1000 bits by exact integer sums.
2. Its rarity is learned from the corpus: Spark counts the windows of all documents by entropy level, and
   a rarer level ranks first. Levels below LEAST_ENTROPY (padding, repeats) never count.
3. In every run of 64 neighbouring windows the best ranked one (the leftmost of equals) scores a point;
   windows with POPULAR points or more are the features. A text too short to have one is its own feature.
4. Each distinct feature sets five bits of a Bloom filter of 2048 bits; after 160 features a new filter is
   chained on.
5. Likeness: every filter of the digest with fewer filters is held against all of the other one; the bits
   in common beyond those expected by chance, over the most that could be, give 0 to 1, and the mean of the
   best values is the result, weighted by the filters' bits (both ways between digests of one length).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.llm import blocks
from loanlens.session import prepare, written

WINDOW, RUN, POPULAR = 64, 64, 16
LEVELS, LEAST_ENTROPY = 6001, 1000
FILTER_BYTES, PER_FILTER, HASHES = 256, 160, 5
_UNRANKED = np.int32(8191)
# Texts are taken together up to this many bytes, so that a rank and a place fit 32 bits.
TOGETHER = 1 << 17
# c * log2(c) in 1/64000 bits, so that a window's sum is exact and its 64th part is in 1/1000 bits.
_TERM = np.array([0] + [round(c * np.log2(c) * 1000) for c in range(1, WINDOW + 1)], np.int32)
# What the next equal byte adds, by the number there already.
_STEP = np.diff(_TERM).astype(np.int32)


def entropies(data: np.ndarray) -> np.ndarray:
    """Entropy, in 1/1000 bits, of the window that starts at each byte; needs at least WINDOW bytes."""
    n = len(data)
    back, ahead = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    equal = np.empty(n, np.bool_)
    for lag in range(1, WINDOW):
        same = equal[: n - lag]
        np.equal(data[lag:], data[:-lag], out=same)
        back[lag:] += same.view(np.uint8)
        ahead[: n - lag] += same.view(np.uint8)
    # Moving on by one byte takes the first byte out and the next one in.
    change = np.empty(n - WINDOW + 1, np.int32)
    change[0] = _TERM[np.bincount(data[:WINDOW], minlength=256)].sum() + WINDOW // 2
    np.subtract(_STEP.take(back[WINDOW:]), _STEP.take(ahead[: n - WINDOW]), out=change[1:])
    np.cumsum(change, out=change)
    change >>= 6
    np.subtract(LEVELS - 1, change, out=change)
    return np.maximum(change, 0, out=change)


def _padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a gap of WINDOW bytes after each, and where each starts."""
    lengths = np.diff(offsets)
    starts = np.concatenate([[0], np.cumsum(lengths + WINDOW)])
    out = np.zeros(int(starts[-1]), np.uint8)
    out[np.arange(len(data)) + np.repeat(starts[:-1] - offsets[:-1], lengths)] = data
    return out, starts


def _inside(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which window starts lie wholly in one text."""
    edge = np.zeros(n + 1, np.int32)
    full = lengths >= WINDOW
    np.add.at(edge, starts[:-1][full], 1)
    np.add.at(edge, starts[:-1][full] + lengths[full] - WINDOW + 1, -1)
    return np.cumsum(edge[:n]) > 0


def level_counts(docs: DataFrame) -> DataFrame:
    """(level, windows): the windows of all texts by entropy level; at most LEVELS rows."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LEVELS, np.int64)
        for _, data, offsets in blocks.rows_per_batch(frames, TOGETHER):
            padded, starts = _padded(data, offsets)
            if len(padded) < WINDOW:
                continue
            levels = entropies(padded)
            total += np.bincount(levels[_inside(starts, np.diff(offsets), len(levels))], minlength=LEVELS)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], names=["level", "windows"])

    parts = docs.select("text").mapInArrow(run, "level int, windows long")
    return parts.groupBy("level").agg(F.sum("windows").alias("windows"))


def rarity(docs: DataFrame) -> np.ndarray:
    """Rank of each entropy level: the fewer windows in the corpus, the lower; unranked below LEAST_ENTROPY."""
    blocks.arrow_batches(docs.sparkSession)
    counts = np.zeros(LEVELS, np.int64)
    for level, windows in level_counts(docs).collect():
        counts[level] = windows
    ranks = np.full(LEVELS, _UNRANKED, np.int32)
    order = np.lexsort((np.arange(LEVELS), counts))
    ranks[order] = np.arange(LEVELS)
    ranks[:LEAST_ENTROPY] = _UNRANKED
    return ranks


def features(data: np.ndarray, offsets: np.ndarray, ranks: np.ndarray) -> list[np.ndarray]:
    """The distinct feature hashes of each text, in order of first appearance."""
    lengths = np.diff(offsets)
    padded, starts = _padded(data, offsets)
    n = len(padded)
    rows = np.zeros(0, np.int64)
    found = np.zeros(0, np.uint64)
    if n >= WINDOW and (lengths >= WINDOW).any():
        levels = entropies(padded)
        inside = _inside(starts, lengths, len(levels))
        rank = np.where(inside, ranks[levels], _UNRANKED)
        # Rank above, place below: the least value of a run is its best ranked, leftmost window.
        kind, shift = (np.int32, 18) if n < 1 << 18 else (np.int64, 40)
        key = np.full(len(rank) + RUN, np.iinfo(kind).max, kind)
        key[: len(rank)] = rank
        key[: len(rank)] <<= shift
        key[: len(rank)] |= np.arange(len(rank), dtype=kind)
        width = 1
        while width < RUN:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        # A window is the best of neighbouring runs only, and of no run that starts in the gap before its text.
        key = np.where(inside, key[: len(rank)], np.iinfo(kind).max)
        at = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
        best = key[at[:-1]]
        good = (np.diff(at) >= POPULAR) & (best < kind(_UNRANKED) << shift)
        places = best[good] & ((1 << shift) - 1)
        whole = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[places].view(np.uint64)
        found = np.zeros(len(places), np.uint64)
        for i in range(WINDOW // 8):
            found = blocks.mix(found * np.uint64(0xD6E8FEB86659FD93) + whole[:, i])
        rows = np.searchsorted(starts, places, side="right") - 1
    cuts = np.searchsorted(rows, np.arange(len(lengths) + 1))
    out = []
    for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
        if b > a:
            _, first = np.unique(found[a:b], return_index=True)
            out.append(found[a:b][np.sort(first)])
        elif lengths[i]:
            text = data[offsets[i] : offsets[i + 1]]
            out.append(blocks.span_hash(blocks.prefix_hash(text), np.array([0]), np.array([len(text)])))
        else:
            out.append(found[:0])
    return out


def digest(own: np.ndarray) -> bytes:
    """Chained Bloom filters of 256 bytes, each with up to 160 features."""
    count = -(-len(own) // PER_FILTER)
    bits = np.zeros((count, FILTER_BYTES * 8), np.uint8)
    number = np.arange(len(own)) // PER_FILTER
    for i in range(HASHES):
        bits[number, ((own >> np.uint64(11 * i)) & np.uint64(2047)).astype(np.int64)] = 1
    return np.packbits(bits, axis=1, bitorder="little").tobytes()


def likeness(one: bytes, two: bytes) -> float:
    """0 to 1; two empty digests are alike, an empty and another one are not."""
    if one == two:
        return 1.0
    if not one or not two:
        return 0.0
    if len(one) == len(two):
        return (_mean_best(one, two) + _mean_best(two, one)) / 2
    return _mean_best(*sorted((one, two), key=len))


def _mean_best(one: bytes, two: bytes) -> float:
    """Mean of the best values of the first digest's filters, weighted by their bits."""
    a = np.frombuffer(one, np.uint64).reshape(-1, FILTER_BYTES // 8)
    b = np.frombuffer(two, np.uint64).reshape(-1, FILTER_BYTES // 8)
    set_a, set_b = np.bitwise_count(a).sum(axis=1, dtype=np.int64), np.bitwise_count(b).sum(axis=1, dtype=np.int64)
    best = np.zeros(len(a))
    for i in range(len(a)):
        common = np.bitwise_count(a[i] & b).sum(axis=1, dtype=np.int64)
        most = np.minimum(set_a[i], set_b)
        chance = set_a[i] * set_b / (FILTER_BYTES * 8)
        room = np.maximum(most - chance, 1e-9)
        best[i] = np.clip((common - chance) / room, 0.0, 1.0).max()
    return float(np.average(best, weights=set_a))


def fingerprints(texts: pa.Array, ranks: np.ndarray) -> list[bytes]:
    data, offsets = blocks.text_bytes(texts)
    out: list[bytes] = []
    for lo, hi in blocks.slices(offsets, TOGETHER):
        at = offsets[lo : hi + 1]
        out += [digest(own) for own in features(data[at[0] : at[-1]], at - at[0], ranks)]
    return out


def fingerprint(docs: DataFrame, ranks: np.ndarray | None = None) -> DataFrame:
    """doc_id and digest (binary) of each row of docs (doc_id, text); a null or empty text has an empty digest."""
    blocks.arrow_batches(docs.sparkSession)
    table = rarity(docs) if ranks is None else ranks

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            made = fingerprints(batch.column("text"), table)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made, pa.binary())], names=["doc_id", "digest"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, digest binary")


_COMPARED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double, first_of long, pending string, size long"
)


def edited(text: str, following: str) -> str:
    """The last floor(n / 2) code points replaced by the first as many (or all) of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compare(texts: list[str], following: list[str], ranks: np.ndarray) -> dict[str, list]:
    import hashlib

    changed = [edited(a, b) for a, b in zip(texts, following, strict=True)]
    made = fingerprints(pa.array([*texts, *following[-1:]], pa.string()), ranks)
    own, after = made[: len(texts)], [*made[1 : len(texts)], made[-1]]
    new = fingerprints(pa.array(changed, pa.string()), ranks)
    return {
        "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
        "fingerprint": own,
        "edited_fingerprint": new,
        "near_edited": [likeness(a, b) for a, b in zip(own, new, strict=True)],
        "near_next": [likeness(a, b) for a, b in zip(own, after, strict=True)],
    }


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Each document's digest, that of its edited text, and its likeness to that and to the next document.

    docs: doc_id, text (more columns are ignored). The next document is the one after it in descending
    order of doc_id, after the last the first; a single document is its own next. Rows that repeat an id
    stand in descending order of their text; rows with a null doc_id come last of all. A null text is
    empty. Returns doc_id, n_chars, edited_sha256, fingerprint and edited_fingerprint (binary), near_edited,
    near_next; an empty table gives an empty table.

    The rows are dealt out once, by ranges of doc_id. A task walks through its range in order; its last row
    waits for the first text of the next range. Those few rows (one per range) are finished from the written
    result.
    """
    spark = prepare(docs.sparkSession)
    blocks.arrow_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ranks = rarity(docs)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("text").desc()]
    dealt = docs.repartitionByRange(parts, F.col("doc_id").desc_nulls_last()).sortWithinPartitions(*order)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(ids, texts, result, first, pending):
            none = [None] * len(ids)
            columns = {"doc_id": ids, "n_chars": [len(t) for t in texts], **result}
            for name in ("edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"):
                columns.setdefault(name, none)
            columns |= {"first_of": first or none, "pending": pending or none, "size": [len(t) for t in texts]}
            names = [x.split()[0] for x in _COMPARED.split(", ")]
            kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64()}
            types = [kinds[x.split()[1]] for x in _COMPARED.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(columns[n], t) for n, t in zip(names, types, strict=True)], names=names)

        ids: list = []
        texts: list[str] = []
        started = False
        for batch in frames:
            new_ids, new_texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            if not new_ids:
                continue
            if not started:
                # Kept aside: what the range before waits for.
                started = True
                yield out(new_ids[:1], new_texts[:1], {}, [1], new_texts[:1])
            ids, texts = ids + new_ids, texts + new_texts
            if len(ids) > 1:
                yield out(ids[:-1], texts[:-1], _compare(texts[:-1], texts[1:], ranks), None, None)
            ids, texts = ids[-1:], texts[-1:]
        if ids:
            yield out(ids, texts, {}, [0], texts)

    made = dealt.withColumn("part", F.spark_partition_id()).select("doc_id", "text").mapInArrow(run, _COMPARED)
    made = written(made.withColumn("part", F.spark_partition_id()), "compared")
    # One first and one last text per range; ranges are in order of their number.
    firsts = made.where("first_of = 1").select("part", F.col("pending").alias("following"))
    lasts = made.where("first_of = 0").select("part", "doc_id", F.col("pending").alias("text"))
    found = sorted(r.part for r in firsts.select("part").collect())
    after = dict(zip(found, found[1:] + found[:1], strict=True))
    follows = spark.createDataFrame([(a, b) for a, b in after.items()], "part int, next_part int")
    ends = lasts.join(follows, "part").join(firsts.withColumnRenamed("part", "next_part"), "next_part")

    def finish(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for i, text, follow in zip(ids, texts, batch.column("following").to_pylist(), strict=True):
                result = _compare([text], [follow], ranks)
                columns = {"doc_id": [i], "n_chars": [len(text)], **result}
                yield pa.RecordBatch.from_pydict(columns, schema=_FINISHED)

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    schema = ", ".join(x for x in _COMPARED.split(", ") if x.split()[0] in names)
    late = ends.select("doc_id", "text", "following").mapInArrow(finish, schema)
    return made.where("first_of IS NULL").select(*names).unionByName(late)


_FINISHED = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.binary()),
     ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)
