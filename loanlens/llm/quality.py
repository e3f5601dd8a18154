"""Quality by a Gaussian kernel over document statistics, approximated by random Fourier features.

Each text becomes a row of statistics (`NAMES`). Standardised, they are mapped to FEATURES cosines of random
directions, whose inner products approximate a Gaussian kernel, and ridge regression fits the labels. Tasks add up
their share of the normal equations, one sum for each of FOLDS folds of the documents; Spark adds the shares block
by block, and the driver solves systems of a fixed size. Leaving out one fold's sum gives the scores of that fold
by a model which has not seen it; isotonic regression over a histogram of these scores maps them to
probabilities. No document is sampled: the sums cover every labelled one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.llm import blocks
from loanlens.session import prepare, written

NAMES = (
    "log_bytes log_words word_bytes word_spread longest capital_letters capital_words symbols calls pipes brackets "
    "digits stops marked_words same_as_last new_words new_pairs repeated_lines line_words unstopped_lines "
    "byte_entropy wide_bytes"
).split()
FEATURES, FOLDS, RIDGE = 256, 4, 1e-3
# The kernel's width in typical distances between two standardised rows; beyond REACH deviations values are cut.
WIDTH, REACH = 0.7, 5.0
# Bins of the calibration's histogram, over raw scores from -0.5 to 1.5.
BINS = 2048
STRIP = 16  # rows of the normal equations that are shuffled as one block

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True


def _marks(text: str) -> np.ndarray:
    own = np.zeros(256, bool)
    own[[ord(c) for c in text]] = True
    return own


_SYMBOL, _CALL, _PIPE = _marks("#*$%&@~^+=_\\/"), _marks("!?"), _marks("|")
_BRACKET, _DIGIT, _STOP = _marks("<>{}[]"), _marks("0123456789"), _marks(".,;:")
_LINE = np.zeros(256, bool)
_LINE[0x0A] = True


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _firsts(rows: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """How many distinct hashes each row has."""
    if not len(rows):
        return np.zeros(n)
    order = np.lexsort((hashes, rows))
    r, h = rows[order], hashes[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
    return np.bincount(r[new], minlength=n).astype(float)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of `NAMES` per text; all but the logarithms are shares or means, 0 for a text without words."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(float)

    def count(table: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(table[data])])
        return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)

    starts, ends, rows = blocks.words(data, offsets)
    words = np.bincount(rows, minlength=n).astype(float)
    length = (ends - starts).astype(float)
    mean = _share(np.bincount(rows, weights=length, minlength=n), words)
    spread = np.sqrt(np.maximum(_share(np.bincount(rows, weights=length**2, minlength=n), words) - mean**2, 0))
    longest = np.zeros(n)
    np.maximum.at(longest, rows, length)
    prefix = blocks.prefix_hash(data)
    word = blocks.span_hash(prefix, starts, ends)
    inner = rows[1:] == rows[:-1]
    again = np.bincount(rows[1:][inner & (word[1:] == word[:-1])], minlength=n)
    pairs = blocks.mix(word[:-1] * np.uint64(0x9FB21C651E98DF25) + word[1:])[inner] if len(word) else word
    pair_rows = rows[1:][inner] if len(word) else rows
    capital = np.bincount(rows[_CAPITAL[data[starts]]], minlength=n)
    marked = np.bincount(rows[(_SYMBOL | _CALL | _PIPE)[data[ends - 1]]], minlength=n)
    lines, line_ends, line_rows = blocks.words(data, offsets, _LINE)
    line_count = np.bincount(line_rows, minlength=n).astype(float)
    line_hash = blocks.span_hash(prefix, lines, line_ends)
    unstopped = np.bincount(line_rows[~(_STOP | _CALL)[data[line_ends - 1]]], minlength=n)
    histogram = np.bincount(np.repeat(np.arange(n), np.diff(offsets)) * 256 + data, minlength=n * 256).reshape(n, 256)
    share = histogram / np.maximum(size, 1)[:, None]
    entropy = -(share * np.log2(np.maximum(share, 1e-12))).sum(axis=1)
    return np.column_stack(
        [np.log1p(size), np.log1p(words), np.log1p(mean), np.log1p(spread), np.log1p(longest),
         _share(count(_CAPITAL), count(_LETTER)), _share(capital, words), _share(count(_SYMBOL), size),
         _share(count(_CALL), size), _share(count(_PIPE), size), _share(count(_BRACKET), size),
         _share(count(_DIGIT), size), _share(count(_STOP), words), _share(marked, words), _share(again, words),
         _share(_firsts(rows, word, n), words), _share(_firsts(pair_rows, pairs, n), words - 1),
         _share(line_count - _firsts(line_rows, line_hash, n), line_count), np.log1p(_share(words, line_count)),
         _share(unstopped, line_count), entropy, _share((histogram[:, 128:]).sum(axis=1), size)]
    )


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics (array) of each row of `docs` (doc_id, text; more columns are ignored)."""
    blocks.arrow_batches(docs.sparkSession)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in blocks.rows_per_batch(frames):
            values = statistics(data, offsets)
            lists = blocks.list_column(values.ravel(), np.full(part.num_rows, len(NAMES)), pa.float64())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], names=["doc_id", "stats"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, stats array<double>")


@dataclass
class Model:
    centre: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray  # one column per left-out fold, the last of all documents
    knots: np.ndarray  # calibration: raw scores and their probabilities
    levels: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.centre) / self.scale, -REACH, REACH)
        waves = np.cos(z @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.column_stack([waves, np.ones(len(stats))])

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        return np.interp(raw, self.knots, self.levels)


def _stats_of(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("stats").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def normal_equations(rows: DataFrame, features: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Per fold, the sums of z z' and (last column) z y over `rows` (stats, y, fold); z = features(stats), of `size` values.

    Every task adds up its rows and gives its sums in strips; a strip's shares are added in a stream.
    """
    strips = -(-size // STRIP)

    def task(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((FOLDS, size, size + 1))
        for batch in frames:
            if not batch.num_rows:
                continue
            z, y = features(_stats_of(batch)), batch.column("y").to_numpy(zero_copy_only=False).astype(float)
            fold = batch.column("fold").to_numpy(zero_copy_only=False)
            for k in range(FOLDS):
                own = z[fold == k]
                sums[k] += own.T @ np.column_stack([own, y[fold == k]])
        if sums.any():
            cut = [sums[:, i * STRIP : (i + 1) * STRIP].tobytes() for i in range(strips)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(strips)), pa.array(cut, pa.binary())], names=["strip", "sums"])

    def add(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}  # no more than `strips`, of a fixed size
        for batch in frames:
            for strip, share in zip(batch.column("strip").to_pylist(), batch.column("sums"), strict=True):
                own = np.frombuffer(share.as_py())
                held[strip] = held[strip] + own if strip in held else own
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.int64()), pa.array([v.tobytes() for v in held.values()], pa.binary())], names=["strip", "sums"]
        )

    shares = rows.mapInArrow(task, "strip long, sums binary")
    summed = shares.repartition(strips, "strip").mapInArrow(add, "strip long, sums binary")
    out = np.zeros((FOLDS, size, size + 1))
    for r in summed.collect():
        lo = r["strip"] * STRIP
        hi = min(lo + STRIP, size)
        out[:, lo:hi] = np.frombuffer(r["sums"]).reshape(FOLDS, hi - lo, size + 1)
    return out


def solve(sums: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Ridge weights: a column for each left-out fold, the last for all rows. The constant is not shrunk."""
    size = sums.shape[1]
    every = sums.sum(axis=0)
    out = []
    for own in [*(every - fold for fold in sums), every]:
        n = own[-1, size - 1]
        shrink = np.full(size, ridge * max(n, 1.0))
        shrink[-1] = 1e-9
        out.append(np.linalg.solve(own[:, :size] + np.diag(shrink), own[:, size]))
    return np.column_stack(out)


def isotonic(knots: np.ndarray, good: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pooled adjacent violators: the rising steps nearest to the shares good / total, at the pools' mean knots."""
    pools: list[list[float]] = []
    for x, g, t in zip(knots, good, total, strict=True):
        pools.append([x * t, g, t])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    own = np.array(pools)
    return own[:, 0] / own[:, 2], own[:, 1] / own[:, 2]


def train(stats: DataFrame, labels: DataFrame, keep: Column) -> Model | None:
    """A model from stats (doc_id, stats: see `measure`) and labels (doc_id, quality 0 or 1).

    `keep` marks the label rows to learn from. A document labelled more than once counts as good if all its labels
    say so; rows that share a labelled doc_id all count. None without labels of both kinds.
    """
    spark = prepare(stats.sparkSession)
    blocks.arrow_batches(spark)
    own = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).where(keep)
    own = own.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("y"))
    rows = stats.join(own, "doc_id").select(
        "stats", "y", F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("fold")), F.lit(FOLDS)).cast("int").alias("fold")
    )
    rows = written(rows, "labelled")
    parts = [F.col("stats")[i] for i in range(len(NAMES))]
    facts = rows.agg(
        F.count("*").alias("n"), F.sum("y").alias("good"),
        *[f(p).alias(f"{k}{i}") for i, p in enumerate(parts) for k, f in (("m", F.avg), ("s", F.stddev_pop))],
    ).first()
    if not facts["good"] or facts["good"] == facts["n"]:
        return None
    spread = np.array([facts[f"s{i}"] for i in range(len(NAMES))])
    random = np.random.default_rng(20240713)
    model = Model(
        centre=np.array([facts[f"m{i}"] for i in range(len(NAMES))]),
        scale=np.where(spread > 1e-9, spread, 1.0),
        directions=random.normal(0, 1 / (WIDTH * np.sqrt(2 * len(NAMES))), (len(NAMES), FEATURES)),
        phases=random.uniform(0, 2 * np.pi, FEATURES),
        weights=np.zeros((FEATURES + 1, FOLDS + 1)),
        knots=np.zeros(1),
        levels=np.zeros(1),
    )
    model.weights = solve(normal_equations(rows, model.features, FEATURES + 1))

    def unseen(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            if batch.num_rows:
                fold = batch.column("fold").to_numpy(zero_copy_only=False)
                raw = (model.features(_stats_of(batch)) * model.weights.T[fold]).sum(axis=1)
                at = np.floor((np.clip(raw, -0.5, 1.5) + 0.5) * (BINS / 2)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at), batch.column("y")], names=["bin", "y"])

    counts = rows.mapInArrow(unseen, "bin long, y int").groupBy("bin").agg(F.sum("y").alias("good"), F.count("*").alias("n"))
    bins = sorted((r["bin"], r["good"], r["n"]) for r in counts.collect())  # BINS + 1 at most
    at = np.array([b for b, _, _ in bins])
    good, total = np.array([g for _, g, _ in bins], float), np.array([n for _, _, n in bins], float)
    # One doubtful document at either end keeps the probabilities off 0 and 1.
    good[0], total[0], total[-1] = good[0] + 1, total[0] + 1, total[-1] + 1
    model.knots, model.levels = isotonic((at + 0.5) / (BINS / 2) - 0.5, good, total)
    return model


def score(stats: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score (0 to 1, higher: better) of each row of stats (see `measure`).

    Null and empty texts have statistics of 0 and are scored like others. Without a model every score is 0.5.
    """
    if model is None:
        return stats.select("doc_id", F.lit(0.5).alias("score"))
    blocks.arrow_batches(stats.sparkSession)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            if batch.num_rows:
                raw = model.features(_stats_of(batch)) @ model.weights[:, -1]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.calibrated(raw))], names=["doc_id", "score"])

    return stats.select("doc_id", "stats").mapInArrow(run, "doc_id long, score double")
