"""Hard negatives of anchors: for each positive, the best of the other labels inside a window of scores.

A positive of score s takes negatives whose scores lie between LOW and HIGH percent of s. The windows of
an anchor's positives overlap. Their upper limits cut the scores into disjoint slots (one for each distinct
limit), so a row falls into one slot of an anchor at most, and a window is a run of slots from its own
downwards, cut off at its lower limit. Tasks keep the first `top` rows of each slot while they pass over
the rows (combiners); Spark merges these lists per anchor and slot; one descending list per anchor, its
slots laid end to end, then answers every window by a filter and a slice.

The anchors meet all rows in blocks: a chunk of at most CHUNK_BYTES of anchors goes to the executors, which
pass over the table twice, for the positives and then for the slots. Nothing of a row but its id and score
is shuffled, and no more than `top` of them per anchor, slot and task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loanlens.llm import blocks
from loanlens.session import prepare, written

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90
# Vectors of one chunk of anchors, sent to every executor: the bound of what is broadcast.
CHUNK_BYTES = 16 << 20
# Scores that a task holds at once.
TILE = 1 << 22
_NONE = np.iinfo(np.int64).min
FOUND = "anchor_id long, slot int, score long, vec_id long"
MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def vectors(rows: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, label, q (floor of `scale` times each component) of the rows that take part.

    A row without id, label or vector, with an empty vector, or with a null or non-finite component takes
    no part. Of rows that share a vec_id, the least by label and vector counts.
    """
    parts = F.transform("embedding", lambda x: x.cast("double"))
    sound = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    own = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND size(embedding) > 0").where(sound)
    own = own.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.struct(
            F.col("label").cast("long").alias("label"),
            F.transform(parts, lambda x: F.floor(x * scale)).alias("q"),
        ).alias("v"),
    )
    # One row an id, combined before the shuffle.
    own = own.groupBy("vec_id").agg(F.min("v").alias("v"))
    return own.select("vec_id", "v.label", "v.q")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as a matrix; shorter vectors count as if filled up with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    wide = max(width, int(lengths.max()))
    if len(flat) == len(lengths) * wide:
        return flat.reshape(len(lengths), wide)
    out = np.zeros((len(lengths), wide), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def products(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all rows; in floating point only where that is exact."""
    width = min(one.shape[1], two.shape[1])  # beyond it one side is zero
    one, two = one[:, :width], two[:, :width]
    most = int(np.abs(one).max(initial=0)) * int(np.abs(two).max(initial=0)) * width
    if most < 1 << 24:
        return (one.astype(np.float32) @ two.astype(np.float32).T).astype(np.int64)
    if most < 1 << 53:
        return (one.astype(np.float64) @ two.astype(np.float64).T).astype(np.int64)
    if most < 1 << 62:
        return one @ two.T
    raise ValueError("a score would not fit in 64 bits; scale the vectors down")


def _best(scores: np.ndarray, ids: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The first `top` columns of each row, by score descending, then id; scores of _NONE are empty places."""
    if scores.shape[1] > top:
        # Columns come by ascending id, so score and place make keys without ties.
        cut = np.partition(scores, scores.shape[1] - top, axis=1)[:, -top]
        above = scores > cut[:, None]
        room = top - above.sum(axis=1)
        even = (scores == cut[:, None]) & (cut > _NONE)[:, None]
        keep = above | (even & (np.cumsum(even, axis=1) <= room[:, None]))
        row, col = np.nonzero(keep)
        place = np.arange(len(row)) - np.searchsorted(row, row)
        out = np.full((len(scores), top), _NONE)
        out_ids = np.zeros((len(scores), top), np.int64)
        out[row, place], out_ids[row, place] = scores[row, col], ids[col] if ids.ndim == 1 else ids[row, col]
        return out, out_ids
    return scores, np.broadcast_to(ids, scores.shape)


class _Lists:
    """The best rows so far, one list for each anchor (and slot)."""

    def __init__(self, n: int, top: int):
        self.scores = np.full((n, top), _NONE)
        self.ids = np.zeros((n, top), np.int64)
        self.top = top

    def add(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Merge rows `scores` (one per list of `at`; columns by ascending id) into the lists."""
        new, new_ids = _best(scores, ids, self.top)
        worst = np.maximum(self.scores[at, -1:], _NONE + 1)
        some = np.flatnonzero((new >= worst).any(axis=1))
        if not len(some):
            return
        at = at[some]
        both = np.concatenate([self.scores[at], new[some]], axis=1)
        both_ids = np.concatenate([self.ids[at], new_ids[some]], axis=1)
        order = np.lexsort((both_ids, -np.maximum(both, _NONE + 1)), axis=1)[:, : self.top]
        self.scores[at] = np.take_along_axis(both, order, axis=1)
        self.ids[at] = np.take_along_axis(both_ids, order, axis=1)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, col = np.nonzero(self.scores > _NONE)
        return at, self.scores[at, col], self.ids[at, col]


def _tiles(frames: Iterator[pa.RecordBatch], anchors: int, width: int):
    """Blocks of rows by ascending id: ids, labels, vectors."""
    size = max(64, TILE // max(1, anchors))
    for batch in frames:
        for lo in range(0, batch.num_rows, size):
            part = batch.slice(lo, size)
            ids = part.column("vec_id").to_numpy(zero_copy_only=False)
            order = np.argsort(ids, kind="stable")
            labels = part.column("label").to_numpy(zero_copy_only=False)
            yield ids[order], labels[order], _matrix(part.column("q"), width)[order]


def _emit(ids: np.ndarray, slots: np.ndarray, found: tuple) -> pa.RecordBatch:
    at, scores, rows = found
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[at]), pa.array(slots[at].astype(np.int32)), pa.array(scores), pa.array(rows)],
        names=["anchor_id", "slot", "score", "vec_id"],
    )


def _positives(chunk, top: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's first `top` other rows of each anchor's label."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, own = chunk.value
        lists = _Lists(len(ids), top)
        for row_ids, row_labels, q in _tiles(frames, len(ids), own.shape[1]):
            for label in np.unique(row_labels):
                anchors = np.flatnonzero(labels == label)
                if not len(anchors):
                    continue
                same = row_labels == label
                scores = products(own[anchors], q[same])
                scores[ids[anchors][:, None] == row_ids[same][None, :]] = _NONE
                lists.add(anchors, scores, row_ids[same])
        yield _emit(ids, np.zeros(len(ids), np.int64), lists.rows())

    return run


def _slots(chunk, limits, top: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's first `top` rows of other labels in each slot: uppers[j + 1] < score <= uppers[j], score >= lowers[j]."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, own = chunk.value
        uppers, lowers = limits.value
        every = np.arange(len(ids))
        slots = [_Lists(len(ids), top) for _ in range(uppers.shape[1])]
        for row_ids, row_labels, q in _tiles(frames, len(ids), own.shape[1]):
            scores = products(own, q)
            scores[labels[:, None] == row_labels[None, :]] = _NONE
            for j, lists in enumerate(slots):
                fits = (scores <= uppers[:, j : j + 1]) & (scores >= lowers[:, j : j + 1])
                if j + 1 < len(slots):
                    fits &= scores > uppers[:, j + 1 : j + 2]
                some = np.flatnonzero(fits.any(axis=1))
                if len(some):
                    lists.add(every[some], np.where(fits[some], scores[some], _NONE), row_ids)
        for j, lists in enumerate(slots):
            yield _emit(ids, np.full(len(ids), j), lists.rows())

    return run


def _merged(found: DataFrame, top: int) -> DataFrame:
    """The first `top` rows of each anchor and slot."""
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top)


def slot_limits(scores: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Upper and lower limits of the slots of each anchor, by descending upper limit.

    scores: the positives' scores by anchor, descending, _NONE where there is none. Positives of one score
    have one window; the later of them give empty slots, as their upper limit is the next slot's own. A
    slot's lower limit is that of the last window that reaches it.
    """
    filled = scores > _NONE
    safe = np.where(filled, scores, -1)
    uppers = safe * high // 100
    lowers = -(-safe * low // 100)
    # A window of a negative score is empty.
    empty = ~filled | (safe < 0)
    return np.where(empty, _NONE + 1, uppers), np.where(empty, np.iinfo(np.int64).max, lowers)


def _chunk(rows: list[Row]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    width = max(len(r["q"]) for r in rows)
    q = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(rows):
        q[i, : len(r["q"])] = r["q"]
    return np.array([r["vec_id"] for r in rows]), np.array([r["label"] for r in rows]), q


def _windows(positives: DataFrame, slots: DataFrame, low: int, high: int, top: int) -> DataFrame:
    """Each window's rows: the anchor's slots end to end, best first, cut to the window's limits."""
    hit = F.struct((-F.col("score")).alias("s"), "vec_id")
    lists = slots.groupBy("anchor_id").agg(F.array_sort(F.collect_list(hit)).alias("hits"))
    own = positives.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    inside = F.filter(
        "hits",
        lambda h: (F.col("positive_score") * low <= -h["s"] * 100) & (-h["s"] * 100 <= F.col("positive_score") * high),
    )
    both = own.join(lists, "anchor_id").select(
        "anchor_id", "positive_id", "positive_score", F.posexplode(F.slice(inside, 1, top)).alias("at", "hit")
    )
    return both.select(
        "anchor_id",
        "positive_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("hit.vec_id").alias("negative_id"),
        "positive_score",
        (-F.col("hit.s")).alias("negative_score"),
    )


def mine(
    rows: DataFrame, anchor: Column, positives: int = POSITIVES, top: int = NEGATIVES, low: int = LOW, high: int = HIGH,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for vec_id, label, q as of `vectors`.

    `anchor` marks the anchors among the rows. An anchor's positives are its first `positives` other rows of the
    same label by inner product, ties by smaller id; each takes the first `top` rows of other labels whose score is
    at least `low` and at most `high` percent of its own. An anchor without a row of its label, and a window
    without rows, gives nothing; so does an empty table. Columns other than the three are ignored.
    """
    spark = prepare(rows.sparkSession)
    blocks.arrow_batches(spark)
    base = rows.select("vec_id", "label", "q")
    anchors = base.where(anchor)
    facts = anchors.agg(F.count("*").alias("n"), F.max(F.size("q")).alias("width")).first()
    if not facts["n"]:
        return spark.createDataFrame([], MINED)
    each = max(1, chunk_bytes // (8 * facts["width"]))
    chunks = 1 if facts["n"] <= each else 2 * -(-facts["n"] // each)
    part = F.pmod(F.xxhash64("vec_id"), F.lit(chunks))
    result = None
    for i in range(chunks):
        # Ids are distinct, so chunks of half the bound stay within it.
        own = anchors.where(part == i).orderBy("vec_id").collect()
        if not own:
            continue
        ids, labels, q = _chunk(own)
        chunk = spark.sparkContext.broadcast((ids, labels, q))
        found = written(_merged(base.mapInArrow(_positives(chunk, positives), FOUND), positives), "positives")
        scores = np.full((len(ids), positives), _NONE)
        for r in found.select("anchor_id", "place", "score").toLocalIterator():
            scores[np.searchsorted(ids, r["anchor_id"]), r["place"] - 1] = r["score"]
        limits = spark.sparkContext.broadcast(slot_limits(scores, low, high))
        slots = written(_merged(base.mapInArrow(_slots(chunk, limits, top), FOUND), top), "slots")
        mined = _windows(found, slots, low, high, top)
        result = mined if result is None else result.unionByName(mined)
    return result


ORACLE_SQL = """
WITH own AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), v AS (
    SELECT vec_id, label, q FROM own QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label, q) = 1
), pairs AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id))::INTEGER AS rank,
       n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
WHERE 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""
