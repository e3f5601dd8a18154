"""Toxicity by multiple-instance learning: documents are labelled, sentences are scored.

A sentence's score is a logistic function of its words' weights; a document's is the noisy-or of its
sentences: 1 - product of (1 - sentence score). The weights are trained from document labels alone, by the
likelihood of the noisy-or, so that the sentences which make a document toxic are found without being
labelled. A word, and the opening of a longer word (PREFIXES bytes), counts once a sentence.

Training reads at most LEARN_DOCS labelled documents of each label (the bound), chosen by a hash of the id.
Spark counts in how many of them each word stands, by label. The features are the words whose share of toxic
documents chance alone would hardly give, tested against the number of labels and of words (MARGIN; the
MOST_WORDS clearest are the most); their weights are at least 0, so that a text does not grow toxic, or
less so, by length alone. What the driver fits is these words' places in the
sample's sentences.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.llm import blocks
from loanlens.session import written

LEARN_DOCS, MARGIN, MOST_WORDS = 4000, 1.0, 4000
QUIET = -9.0
PREFIXES = (6, 7)
STEPS, RATE, DECAY = 400, 0.1, 1e-3
_NOT_WORD = np.ones(256, bool)
_NOT_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?"]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


@dataclass
class Model:
    words: np.ndarray  # sorted hashes
    weights: np.ndarray
    quiet: float


def sentence_ends(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Ends of sentences: a line end, a mark `.!?` before white space, and the end of a text."""
    last = np.zeros(len(data) + 1, bool)
    if len(data):
        last[1:] = data == 0x0A
        stop = _STOP[data]
        last[1:-1] |= stop[:-1] & _SPACE[data[1:]]
    last[offsets[1:]] = True
    return np.flatnonzero(last)


def word_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (A-Z in lower case) and of their openings, and the byte at which each word starts."""
    data = blocks.fold(data)
    starts, ends, _ = blocks.words(data, offsets, _NOT_WORD)
    prefix = blocks.prefix_hash(data)
    hashes, places = [blocks.span_hash(prefix, starts, ends)], [starts]
    for size in PREFIXES:
        longer = starts[ends - starts > size]
        hashes.append(blocks.span_hash(prefix, longer, longer + size))
        places.append(longer)
    return np.concatenate(hashes), np.concatenate(places)


def sentence_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature hashes, the sentence of each, and the sentences' ends."""
    hashes, starts = word_features(data, offsets)
    stops = sentence_ends(data, offsets)
    return hashes, np.searchsorted(stops, starts, side="right"), stops


def labelled_sample(docs: DataFrame, labels: DataFrame, keep: F.Column, bound: int = LEARN_DOCS) -> DataFrame:
    """(doc_id, text, toxic): up to `bound` documents of each label; a repeated label counts as toxic if one is."""
    own = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).where(keep)
    own = own.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in own.groupBy("toxic").agg(F.count("*").alias("n")).collect()}  # two rows
    # The least hashes of each label: a share of it first, then a top list; no label is gathered in a task.
    h = F.xxhash64(F.col("doc_id").cast("string"), F.lit("toxic"))
    parts = []
    for label in sorted(counts):
        some = own.where((F.col("toxic") == label) & (F.pmod(h, F.lit(1 << 20)) / (1 << 20) * counts[label] < 2 * bound))
        order = [F.pmod(h, F.lit(1 << 20)), h, "doc_id"]
        parts.append(some.orderBy(*order).limit(bound))
    chosen = reduce(DataFrame.union, parts, own.limit(0)).select("doc_id", "toxic")
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def _word_counts(sample: DataFrame) -> DataFrame:
    """(word, toxic, docs): in how many documents of each label a word stands."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in blocks.rows_per_batch(frames):
            hashes, starts = word_features(data, offsets)
            rows = np.searchsorted(offsets, starts, side="right") - 1
            order = np.lexsort((hashes, rows))
            hashes, rows = hashes[order], rows[order]
            first = np.ones(len(hashes), bool)
            first[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
            toxic = np.asarray(part.column("toxic").to_pylist(), np.int64)
            for label in (0, 1):
                found, counts = np.unique(hashes[first & (toxic[rows] == label)], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.view(np.int64)), pa.array(np.full(len(found), label, np.int32)), pa.array(counts.astype(np.int64))],
                    names=["word", "toxic", "docs"],
                )

    return sample.mapInArrow(run, "word long, toxic int, docs long").groupBy("word").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("docs")).otherwise(0)).alias("bad"),
        F.sum(F.when(F.col("toxic") == 0, F.col("docs")).otherwise(0)).alias("good"),
    )


def _places(sample: DataFrame, chosen: np.ndarray) -> DataFrame:
    """(toxic, sentences): per document the features of its sentences, as lists of indices; others are left out."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in blocks.rows_per_batch(frames):
            hashes, sentence, stops = sentence_words(data, offsets)
            at = np.searchsorted(chosen, hashes)
            at[at == len(chosen)] = 0
            hit = chosen[at] == hashes
            pairs = np.unique(sentence[hit].astype(np.int64) * len(chosen) + at[hit])
            rows = np.searchsorted(offsets, stops, side="left") - 1
            row = rows[pairs // len(chosen)]
            lengths = np.bincount(row, minlength=part.num_rows)
            yield pa.RecordBatch.from_arrays(
                [part.column("toxic"), blocks.list_column(pairs // len(chosen), lengths, pa.int64()),
                 blocks.list_column(pairs % len(chosen), lengths, pa.int64())],
                names=["toxic", "sentence", "feature"],
            )

    return sample.mapInArrow(run, "toxic int, sentence array<long>, feature array<long>")


def _evidence(share: float) -> F.Column:
    """How surprising a word's share of toxic documents is (in nats; a bound of the binomial tail), 0 below `share`."""
    p = F.col("bad") / F.col("n")
    rest = F.when(p < 1, (1 - p) * F.log((1 - p) / F.lit(1 - share))).otherwise(0.0)
    return F.when(p > share, F.col("n") * (p * F.log(p / F.lit(share)) + rest)).otherwise(0.0)


def _limits(counted: DataFrame, share: float) -> DataFrame:
    """(n, least): the evidence that a word of n documents needs, one row per n, 2 * LEARN_DOCS at most.

    Of the words that as many documents have or more, no more than exp(-MARGIN) should pass by chance.
    """
    sizes = sorted(((r["n"], r["c"]) for r in counted.groupBy("n").agg(F.count("*").alias("c")).collect()), reverse=True)
    above = np.cumsum([c for _, c in sizes])
    rows = [(n, float(np.log(w) + MARGIN)) for (n, _), w in zip(sizes, above.tolist(), strict=True)]
    return counted.sparkSession.createDataFrame(rows, "n long, least double")


def train(docs: DataFrame, labels: DataFrame, keep: F.Column, bound: int = LEARN_DOCS) -> Model:
    """A model from docs (doc_id, text) and labels (doc_id, toxic); `keep` marks the label rows to learn from.

    Without labels of both kinds, or without telling words, the model has no words and calls nothing toxic.
    """
    blocks.arrow_batches(docs.sparkSession)
    sample = written(labelled_sample(docs, labels, keep, bound), "labelled")
    totals = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    nothing = Model(np.zeros(1, np.uint64), np.zeros(1), QUIET)
    if not bad or not good:
        return nothing
    counted = written(_word_counts(sample), "words").withColumn("n", F.col("bad") + F.col("good"))
    telling = counted.join(F.broadcast(_limits(counted, bad / (bad + good))), "n")
    telling = telling.withColumn("evidence", _evidence(bad / (bad + good))).where(F.col("evidence") >= F.col("least"))
    rows = telling.orderBy(F.col("evidence").desc(), "word").limit(MOST_WORDS).select("word").collect()
    if not rows:
        return nothing
    chosen = np.sort(np.array([r["word"] for r in rows], np.int64).view(np.uint64))
    return _fit(chosen, _places(sample, chosen).collect())


def _fit(chosen: np.ndarray, rows: list) -> Model:
    label = np.array([r["toxic"] for r in rows], np.float64)
    sentence, feature, doc_of = [], [], []
    count = 0
    for i, r in enumerate(rows):
        if len(r["sentence"]):
            _, inverse = np.unique(np.asarray(r["sentence"]), return_inverse=True)
            sentence.append(inverse + count)
            feature.append(np.asarray(r["feature"]))
            size = int(inverse.max()) + 1
            doc_of.append(np.full(size, i))
            count += size
    if not count:
        return Model(np.zeros(1, np.uint64), np.zeros(1), QUIET)
    s, f, d = np.concatenate(sentence), np.concatenate(feature), np.concatenate(doc_of)
    weights = np.full(len(chosen), 1.0)
    first, second = np.zeros(len(chosen)), np.zeros(len(chosen))
    for step in range(1, STEPS + 1):
        z = QUIET + np.bincount(s, weights=weights[f], minlength=count)
        log_keep = -np.logaddexp(0, z)
        total = np.bincount(d, weights=log_keep, minlength=len(label))
        # Sentences without features are left out here; together they add the leak below.
        p = np.clip(1 - np.exp(total), 1e-4, 1 - 1e-9)
        pull = np.where(label > 0, -(1 - p) / p, 1.0)
        slope = pull[d] / (1 + np.exp(-z))
        grad = np.bincount(f, weights=slope[s], minlength=len(chosen)) / len(label) * 100 + DECAY * weights
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        weights -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        np.clip(weights, 0.0, 20.0, out=weights)
    return Model(chosen, weights, QUIET)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1) and offending (sentences with a score of 0.5 or more: code point start, end, score).

    docs: doc_id, text (whole texts; more columns are ignored); one row each. Sentences without any of the
    model's words count as not toxic. A null or empty text, and one without words, scores 0.
    """
    blocks.arrow_batches(docs.sparkSession)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in blocks.rows_per_batch(frames):
            hashes, sentence, stops = sentence_words(data, offsets)
            at = np.searchsorted(model.words, hashes)
            at[at == len(model.words)] = 0
            hit = (model.words[at] == hashes) & (model.weights[at] > 0)
            pairs = np.unique(sentence[hit].astype(np.int64) * len(model.words) + at[hit])
            which, own = np.unique(pairs // len(model.words), return_inverse=True)
            z = model.quiet + np.bincount(own, weights=model.weights[pairs % len(model.words)], minlength=len(which))
            rows = np.searchsorted(offsets, stops[which], side="left") - 1
            keep = np.bincount(rows, weights=-np.logaddexp(0, z), minlength=part.num_rows)
            value = 1 / (1 + np.exp(-z))
            bad = value >= 0.5
            begins = np.maximum(np.where(which[bad] > 0, stops[which[bad] - 1], 0), offsets[rows[bad]])
            points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            home = points[offsets[rows[bad]]]
            spans = pa.StructArray.from_arrays(
                [pa.array(points[begins] - home), pa.array(points[stops[which[bad]]] - home), pa.array(value[bad])],
                names=["start", "end", "score"],
            )
            cuts = np.concatenate([[0], np.cumsum(np.bincount(rows[bad], minlength=part.num_rows))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(1 - np.exp(keep)), pa.ListArray.from_arrays(pa.array(cuts), spans)],
                names=["doc_id", "score", "offending"],
            )

    schema = "doc_id long, score double, offending array<struct<start:bigint,end:bigint,score:double>>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
