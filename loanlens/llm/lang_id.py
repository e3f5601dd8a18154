"""Language identification by interpolated Kneser-Ney character models.

One model per language, of orders 1 to ORDER, over letters in lower case with every run of other
characters as one blank. The n-grams of all languages stand in one sorted hash array per order with the
log probability that each language gives them; contexts have sorted arrays of back-off weights. A text
is scored by array lookups only: the language with the lowest cross-entropy (bits per character) wins.

Training: the LEARN_DOCS documents (the bound) of each language with the least hash of their id give, whole, the
n-gram counts, which Spark sums by language. No count is cut
before the discounts are estimated from those of n-grams seen once and twice.

Rejection: the bits per character under the best model are compared with those of a model that knows
nothing but the alphabet (log2 of the number of letters the models know). A text that the best language
describes no better than that is rejected, as is a text without letters. One in HELD_SHARE of the labelled rows is
kept out of the fit; these rows and all others beyond the bound are scored, and raise each language's ceiling
to the entropy that one in a thousand of them exceeds, but not beyond RAISE_WIDTH interquartile ranges over
their third quartile: noise under a label, if it is less than a quarter of a language's rows, raises nothing.
Those scores also set the scale of the score. REJECT_MARGIN is added to either ceiling.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanlens.llm import blocks
from loanlens.session import written

ORDER = 4
LEARN_DOCS = 1500
REJECT_MARGIN = 0.25
HELD_SHARE, RAISE_WIDTH = 8, 3.0
SCALES = (1.0, 0.5, 0.25, 0.1, 0.05, 0.02)
BLANK = 0x20
UNKNOWN = "und"
BROADCAST_IDS = 1_000_000
BLOCK_CHARS = 1 << 18


def _letter_tables() -> tuple[np.ndarray, np.ndarray]:
    """For the basic plane: the lower-case code point of a letter, or a blank; and whether it is a letter."""
    low = np.full(0x10000, BLANK, np.uint32)
    letter = np.zeros(0x10000, bool)
    for code in range(0x10000):
        if 0xD800 <= code < 0xE000:
            continue
        char = chr(code)
        if char.isalpha():
            letter[code] = True
            small = char.lower()
            low[code] = ord(small) if len(small) == 1 else code
    return low, letter


_tables: tuple[np.ndarray, np.ndarray] | None = None


def normalised(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts, each opened by a blank and with single blanks, their offsets, and which have a letter."""
    global _tables
    if _tables is None:
        _tables = _letter_tables()
    low, letter = _tables
    joined = "".join(" " + (t or "") for t in texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([1 + len(t or "") for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    plane = np.minimum(codes, 0xFFFF)
    out = low[plane]
    is_letter = letter[plane]
    high = np.flatnonzero(codes > 0xFFFF)
    if len(high):
        for i in high.tolist():
            char = chr(int(codes[i]))
            is_letter[i] = char.isalpha()
            out[i] = ord(char.lower()[0]) if char.isalpha() else BLANK
    keep = np.ones(len(out), bool)
    keep[1:] = ~((out[1:] == BLANK) & (out[:-1] == BLANK))
    keep[starts[:-1]] = True
    places = np.concatenate([[0], np.cumsum(keep)])
    seen = np.concatenate([[0], np.cumsum(is_letter)])
    return out[keep], places[starts], seen[starts[1:]] > seen[starts[:-1]]


def gram_hashes(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 1..order: the hash of the n characters that end at each place (meaningless before place n - 1)."""
    own = blocks.mix(codes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    out = [own]
    for n in range(2, order + 1):
        wider = np.zeros_like(own)
        wider[1:] = out[-1][:-1]
        wider = wider * np.uint64(0xD6E8FEB86659FD93) + own
        wider ^= wider >> np.uint64(29)
        out.append(wider)
    return out


@dataclass
class Model:
    """Sorted hash arrays; rows of `logs` and `back` hold one value per language, in bits."""

    languages: list[str]
    keys: list[np.ndarray]  # n-grams of order 1..ORDER
    logs: list[np.ndarray]
    contexts: list[np.ndarray]  # contexts of length 1..ORDER-1
    back: list[np.ndarray]
    unseen: np.ndarray  # bits of a character that no language has seen
    alphabet_bits: float
    ceilings: np.ndarray | None = None  # by language
    scale: float = 1.0

    def find(self, keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(keys, wanted)
        at[at == len(keys)] = 0
        return at, keys[at] == wanted

    def bits(self, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Bits per language of each text, summed over its characters after the opening blank."""
        hashes = gram_hashes(codes, len(self.keys))
        place = np.arange(len(codes)) - np.repeat(starts[:-1], np.diff(starts))
        total = np.zeros((len(codes), len(self.languages)), np.float32)
        todo = np.flatnonzero(place > 0)
        rest = todo
        for n in range(len(self.keys), 0, -1):
            long_enough = place[rest] >= n - 1
            here, short = rest[long_enough], rest[~long_enough]
            at, hit = self.find(self.keys[n - 1], hashes[n - 1][here])
            total[here[hit]] += self.logs[n - 1][at[hit]]
            missed = here[~hit]
            if n > 1 and len(missed):
                at, known = self.find(self.contexts[n - 2], hashes[n - 2][missed - 1])
                total[missed[known]] += self.back[n - 2][at[known]]
            rest = np.concatenate([missed, short]) if len(short) else missed
        total[rest] += self.unseen
        return np.add.reduceat(total, starts[:-1], axis=0).astype(np.float64)

    def measured(self, texts: list[str | None], scales: tuple[float, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language (-1 without letters), cross-entropy, and the score by scale of each text."""
        best = np.full(len(texts), -1)
        entropy, score = np.full(len(texts), np.nan), np.zeros((len(scales), len(texts)))
        lengths = np.cumsum([0] + [len(t or "") + 1 for t in texts])
        for lo, hi in blocks.slices(lengths, BLOCK_CHARS):
            codes, starts, lettered = normalised(texts[lo:hi])
            sums = self._sums(codes, starts)
            size = np.maximum(1, np.diff(starts) - 1)
            rate = sums / size[:, None]
            top = rate.argmin(axis=1)
            # Log odds of the best language, in nats, over a bounded number of characters.
            gap = (rate - rate.min(axis=1, keepdims=True)) * np.minimum(size, 200)[:, None] * math.log(2)
            best[lo:hi] = np.where(lettered, top, -1)
            entropy[lo:hi] = np.where(lettered, rate.min(axis=1), np.nan)
            for i, scale in enumerate(scales):
                score[i, lo:hi] = np.where(lettered, 1.0 / np.exp(-gap * scale).sum(axis=1), 0.0)
        return best, entropy, score

    def predict(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language (-1 without letters), cross-entropy, score, and rejection of each text."""
        best, entropy, score = self.measured(texts, (self.scale,))
        rejected = best < 0
        if self.ceilings is not None:
            rejected = rejected | (entropy > self.ceilings[best])
        return best, entropy, score[0], rejected

    def _sums(self, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        if len(codes) <= 2 * BLOCK_CHARS:
            return self.bits(codes, starts)
        # One very long text: parts that overlap by a context, their sums added.
        total = np.zeros((1, len(self.languages)))
        lap = len(self.keys) - 1
        for a in range(1, len(codes), BLOCK_CHARS):
            lead = min(a, lap)
            part = codes[a - lead : a + BLOCK_CHARS]
            total += self.bits(part, np.array([0, len(part)]))
            if lead > 1:
                total -= self.bits(part[:lead], np.array([0, lead]))
        return total


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, n, gram, prefix, suffix, count): n-gram counts by language, as text, summed by Spark."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
            for lang in sorted(set(langs)):
                own = [t for t, x in zip(texts, langs, strict=True) if x == lang]
                codes, starts, _ = normalised(own)
                alphabet, ids = np.unique(codes, return_inverse=True)
                base = len(alphabet)
                place = np.arange(len(codes)) - np.repeat(starts[:-1], np.diff(starts))
                for n in range(1, ORDER + 1):
                    ends = np.flatnonzero(place >= max(1, n - 1))
                    if not len(ends):
                        continue
                    packed = np.zeros(len(ends), np.int64)
                    for i in range(n):
                        packed = packed * base + ids[ends - n + 1 + i]
                    found, counts = np.unique(packed, return_counts=True)
                    spelt = np.empty((len(found), n), np.uint32)
                    for i in range(n - 1, -1, -1):
                        spelt[:, i] = alphabet[found % base]
                        found //= base
                    grams = spelt.view(f"<U{n}").ravel().tolist()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(grams)), pa.array([n] * len(grams), pa.int32()),
                         pa.array(grams, pa.string()), pa.array(counts.astype(np.int64))],
                        names=["lang", "n", "gram", "count"],
                    )

    parts = docs.select("lang", "text").mapInArrow(run, "lang string, n int, gram string, count long")
    return parts.groupBy("lang", "n", "gram").agg(F.sum("count").alias("count"))


def eligible(docs: DataFrame, keep: F.Column) -> DataFrame:
    """The labelled rows that may be learned from."""
    return docs.where(keep & F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.col("lang") != UNKNOWN))


def learning_ids(docs: DataFrame, keep: F.Column, bound: int = LEARN_DOCS) -> DataFrame:
    """(doc_id, lang) of the first `bound` texts of each language among the rows that `keep` marks, by a hash of the id."""
    some = eligible(docs, keep)
    part = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("lang")), F.lit(1 << 20)) / (1 << 20)
    some = some.select("lang", "doc_id", part.alias("part"))
    # One row per language; a share of some more than `bound` rows is taken where the rows are, so few are ordered.
    size = written(some.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    size = F.broadcast(size) if size.count() <= BROADCAST_IDS else size
    few = some.join(size, "lang").where(F.col("part") * F.col("n") < bound + 8 * math.sqrt(bound))
    order = Window.partitionBy("lang").orderBy("part", "doc_id")
    few = few.select("doc_id", "lang", "part").distinct().withColumn("r", F.row_number().over(order))
    chosen = written(few.where(F.col("r") <= bound).select("doc_id", "lang"), "learning-ids")
    # Few languages make few ids; a column of very many values is met by a shuffle instead.
    return F.broadcast(chosen) if chosen.count() <= BROADCAST_IDS else chosen


def learning_rows(docs: DataFrame, keep: F.Column, bound: int = LEARN_DOCS) -> DataFrame:
    """(lang, text): up to `bound` texts of each language among the rows that `keep` marks, by a hash of the id."""
    return docs.join(learning_ids(docs, keep, bound), ["doc_id", "lang"], "left_semi").select("lang", "text")


def fit(learning: DataFrame) -> Model | None:
    """A model from (lang, text), or None where there is nothing to learn from."""
    blocks.arrow_batches(learning.sparkSession)
    rows = gram_counts(learning).toPandas()
    if not len(rows):
        return None
    languages = sorted(rows["lang"].unique())
    counts: list[dict[str, dict[str, int]]] = [
        {lang: {} for lang in languages} for _ in range(ORDER + 1)
    ]
    for lang, n, gram, count in zip(rows["lang"], rows["n"], rows["gram"], rows["count"], strict=True):
        counts[n][lang][gram] = int(count)
    alphabet = sorted({g for lang in languages for g in counts[1][lang]})
    table = {lang: _probabilities([counts[n][lang] for n in range(ORDER + 1)], len(alphabet)) for lang in languages}
    keys, logs, contexts, back = [], [], [], []
    for n in range(1, ORDER + 1):
        grams = sorted({g for lang in languages for g in counts[n][lang]})
        values = np.array([[-math.log2(_prob(table[x], g)) for x in languages] for g in grams], np.float32)
        keys.append(_hash_all(grams, n))
        order = np.argsort(keys[-1])
        keys[-1] = keys[-1][order]
        logs.append(values.reshape(len(grams), len(languages))[order])
    for n in range(1, ORDER):
        heads = sorted({g for lang in languages for g in table[lang][1][n]})
        values = np.array([[-math.log2(table[x][1][n].get(g, 1.0)) for x in languages] for g in heads], np.float32)
        hashed = _hash_all(heads, n)
        order = np.argsort(hashed)
        contexts.append(hashed[order])
        back.append(values.reshape(len(heads), len(languages))[order])
    # A character no language has seen: the uniform part of the unigrams, once more over the alphabet.
    unseen = np.array([-math.log2(table[x][2] / (len(alphabet) + 1)) for x in languages], np.float32)
    return Model(languages, keys, logs, contexts, back, unseen, math.log2(len(alphabet) + 1))


def _hash_all(grams: list[str], n: int) -> np.ndarray:
    if not grams:
        return np.zeros(1, np.uint64)
    codes = np.frombuffer("".join(grams).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, n)
    # The same recurrence as gram_hashes, column by column.
    return gram_hashes_of(codes)


def gram_hashes_of(codes: np.ndarray) -> np.ndarray:
    columns = [blocks.mix(codes[:, i].astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) for i in range(codes.shape[1])]
    # gram_hashes extends a gram on the right: the hash of n characters comes from the n - 1 before the last.
    out = columns[0]
    for own in columns[1:]:
        out = out * np.uint64(0xD6E8FEB86659FD93) + own
        out ^= out >> np.uint64(29)
    return out


def _probabilities(counts: list[dict[str, int]], alphabet: int) -> tuple[list[dict], list[dict], float]:
    """Interpolated Kneser-Ney by order: discounted shares, back-off weights by context, and the uniform weight.

    The highest order keeps its counts; a lower one counts the different characters that come before.
    """
    used: list[dict[str, int]] = [{} for _ in range(ORDER + 1)]
    used[ORDER] = counts[ORDER]
    for n in range(ORDER - 1, 0, -1):
        before: dict[str, int] = {}
        for gram in counts[n + 1]:
            before[gram[1:]] = before.get(gram[1:], 0) + 1
        # A gram that only opens texts counts as having come after one character.
        used[n] = {g: before.get(g, 1) for g in counts[n]}
    shares: list[dict[str, float]] = [{} for _ in range(ORDER + 1)]
    weights: list[dict[str, float]] = [{} for _ in range(ORDER + 1)]
    uniform = 1.0
    for n in range(1, ORDER + 1):
        ones = sum(1 for c in used[n].values() if c == 1)
        twos = sum(1 for c in used[n].values() if c == 2)
        discount = min(0.9, max(0.1, ones / (ones + 2 * twos))) if ones else 0.5
        totals: dict[str, int] = {}
        kinds: dict[str, int] = {}
        for gram, c in used[n].items():
            totals[gram[:-1]] = totals.get(gram[:-1], 0) + c
            kinds[gram[:-1]] = kinds.get(gram[:-1], 0) + 1
        shares[n] = {g: (c - discount) / totals[g[:-1]] for g, c in used[n].items()}
        held = {h: discount * kinds[h] / totals[h] for h in totals}
        if n == 1:
            uniform = held.get("", 1.0)
        else:
            weights[n - 1] = held
    shares[0] = {"": 1.0 / (alphabet + 1)}
    return shares, weights, uniform


def _prob(table: tuple[list[dict], list[dict], float], gram: str) -> float:
    shares, weights, uniform = table
    value = shares[1].get(gram[-1], 0.0) + uniform * shares[0][""]
    for n in range(2, len(gram) + 1):
        part = gram[len(gram) - n :]
        weight = weights[n - 1].get(part[:-1])
        if weight is not None:
            value = shares[n].get(part, 0.0) + weight * value
    return value


def calibrated(model: Model, held: DataFrame) -> Model:
    """Set the rejection ceilings and the scale of the score from all of (lang, text), which the model has not seen."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.languages, UNKNOWN], dtype=object)
        for batch in frames:
            best, entropy, score = model.measured(batch.column("text").to_pylist(), SCALES)
            right = names[best] == np.array(batch.column("lang").to_pylist(), dtype=object)
            yield pa.RecordBatch.from_arrays(
                [pa.array(best.astype(np.int32)), pa.array(entropy, mask=np.isnan(entropy)), pa.array(right.astype(bool)),
                 *[pa.array(s) for s in score]],
                names=["best", "entropy", "right", *[f"score{i}" for i in range(len(SCALES))]],
            )

    columns = ", ".join(f"score{i} double" for i in range(len(SCALES)))
    scored = held.select("lang", "text").mapInArrow(run, f"best int, entropy double, right boolean, {columns}")
    # One row per language of the model, and one for texts without letters.
    sums = scored.groupBy("best").agg(
        F.count("*").alias("n"), F.sum(F.col("right").cast("long")).alias("right"),
        F.percentile_approx("entropy", F.array(F.lit(0.25), F.lit(0.75), F.lit(0.999)), 100_000).alias("q"),
        *[F.sum(f"score{i}").alias(f"score{i}") for i in range(len(SCALES))],
    ).collect()
    least = model.alphabet_bits + REJECT_MARGIN
    model.ceilings = np.full(len(model.languages), least)
    for r in sums:
        if r["best"] >= 0:
            low, high, most = r["q"]
            raised = min(most, high + RAISE_WIDTH * (high - low)) + REJECT_MARGIN
            model.ceilings[r["best"]] = max(least, raised)
    # The score's scale: the mean score of the texts should be their share of right answers.
    total = sum(r["n"] for r in sums)
    right = sum(r["right"] for r in sums) / total if total else 1.0
    for i, scale in enumerate(SCALES):
        model.scale = scale
        if sum(r[f"score{i}"] for r in sums) <= (max(right, 0.5) + 0.005) * total:
            break
    return model


def trained(docs: DataFrame, keep: F.Column, bound: int = LEARN_DOCS) -> Model | None:
    """A calibrated model from the rows of docs (doc_id, text, lang) that `keep` marks."""
    aside = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("held")), F.lit(HELD_SHARE)) == 0
    ids = learning_ids(docs, keep & ~aside, bound)
    learning = written(docs.join(ids, ["doc_id", "lang"], "left_semi").select("lang", "text"), "learning")
    model = fit(learning)
    if model is None:
        return None
    return calibrated(model, eligible(docs, keep).join(ids, ["doc_id", "lang"], "left_anti"))


def identify(docs: DataFrame, model: Model | None, carry: list[str] | None = None) -> DataFrame:
    """lang_pred, score, cross_entropy and rejected of each row of docs (doc_id, text), after its columns `carry`.

    Only the text is read; `carry` is doc_id alone unless given, and where a name is taken there, the new
    column gets underscores before it. A null text and one without letters are `und`, with score 0, a null
    cross-entropy and rejected; so is every text if there is no model. Repeated rows each give a row.
    """
    blocks.arrow_batches(docs.sparkSession)
    names = np.array([*(model.languages if model else []), UNKNOWN], dtype=object)
    carry = ["doc_id"] if carry is None else carry
    wanted = docs.select(*carry)
    added = blocks.fresh(wanted, "lang_pred", "score", "cross_entropy", "rejected")
    text = blocks.fresh(wanted, "read_text")[0]

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            texts = batch.column(text).to_pylist()
            if model is None or not texts:
                best, entropy = np.full(len(texts), -1), np.full(len(texts), np.nan)
                score, rejected = np.zeros(len(texts)), np.ones(len(texts), bool)
            else:
                best, entropy, score, rejected = model.predict(texts)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in carry], pa.array(names[best].tolist(), pa.string()), pa.array(score),
                 pa.array(entropy, mask=np.isnan(entropy)), pa.array(rejected)],
                names=[*carry, *added],
            )

    kinds = ", ".join(f"`{c}` {k}" for c, k in zip(added, ("string", "double", "double", "boolean"), strict=True))
    source = docs.select(*carry, docs["text"].alias(text))
    return source.mapInArrow(run, f"{blocks.column_types(docs, carry)}, {kinds}")


def held_out(key: str = "doc_id") -> F.Column:
    """Rows that no model learns from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))
