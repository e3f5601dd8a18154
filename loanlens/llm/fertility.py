"""Quality rules by tokeniser fertility.

A public vocabulary measures each text: characters and symbols per token, the share of byte-fallback tokens,
tokens per word (fertility), and the entropy of its tokens. Rejection bands are set per script (that of most of a
text's letters), language (`lang`, where the table has it) and, as a longer text has more kinds of tokens, power of
two of its length: Spark takes the quartiles of each measure over the texts of a class that pass the base rules, and
a text is rejected where a measure lies more than WIDTH interquartile ranges (and at least a floor) beyond its
quartiles. A class of fewer than LEAST_TEXTS texts takes the quartiles of more: of its language with up to
NEAR_LENGTHS lengths at either side, then of its script, then of the corpus, at last of the corpus in any length.

Base rules count words, symbols, repeated lines and words in repeated five-word windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanlens.llm import blocks
from loanlens.llm.vocabulary import DEFAULT_MODEL, model_bytes
from loanlens.session import prepare, written

WINDOW = 5
LEAST_WORDS, MOST_REPEATED = 10, 20
WIDTH = 3.0
LEAST_TEXTS, NEAR_LENGTHS, BROADCAST_CLASSES = 30, 2, 100_000
# Measures are rounded to 1 / GRID where quartiles are found.
GRID = 10_000
# The least entropy of a text judged by other lengths, as a share of the most that its tokens allow.
SHORT_ENTROPY = 0.8
# The least distance of the lower and upper bound from its quartile, so that a uniform corpus does not reject
# small differences. Many characters a token speak for a text in the vocabulary's own language: a wider bound.
FLOORS = {
    "chars_per_token": (0.2, 0.75),
    "byte_share": (1.0, 0.05),
    "token_entropy": (0.3, 1.0),
    "tokens_per_word": (4.0, 1.0),
    "symbols_per_token": (9.0, 0.05),
}
_ROOM = 2 << 20
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
SCRIPTS = ["latin", "greek", "cyrillic", "hebrew_arabic", "indic", "cjk", "other"]
# The script of a character by its first byte; bytes that open no letter of these have -1.
_SCRIPT = np.full(256, -1, np.int64)
_SCRIPT[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC3, 0xCA)]] = 0
_SCRIPT[0xCD:0xD0] = 1
_SCRIPT[0xD0:0xD4] = 2
_SCRIPT[0xD6:0xDE] = 3
_SCRIPT[0xE0] = 4
_SCRIPT[0xE3:0xEE] = 5
_SCRIPT[[0xE1, 0xE2, *range(0xEE, 0xF5)]] = 6


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many bytes of each row are marked."""
    upto = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return upto[offsets[1:]] - upto[offsets[:-1]]


def _grouped(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place, number of the group, and group sizes of equal (row, hash)."""
    own = blocks.mix(hashes ^ (rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    _, first, same, sizes = np.unique(own, return_index=True, return_inverse=True, return_counts=True)
    return first, same, sizes


def base_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[dict[str, np.ndarray], tuple]:
    """The base counts of each row, and its words (starts, ends, rows, hashes)."""
    n = len(offsets) - 1
    starts, ends, rows = blocks.words(data, offsets)
    prefix = blocks.prefix_hash(data)
    hashes = blocks.span_hash(prefix, starts, ends)
    points = (data & 0xC0) != 0x80
    counts = {
        "n_words": np.bincount(rows, minlength=n),
        "word_chars": _per_row(points, offsets) - _per_row(_SPACE[data], offsets),
        "n_symbols": _per_row(_SYMBOL[data], offsets),
    }
    # Lines: a line feed ends one, as does the end of a row.
    ends_line = np.zeros(len(data) + 1, bool)
    ends_line[offsets[1:]] = True
    ends_line[:-1] |= data == 0x0A
    line_end = np.flatnonzero(ends_line)
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets[:-1]] = True
    begins[1:] |= data == 0x0A
    line_start = np.flatnonzero(begins)
    # Each word lies in one line; lines with a word are those that words name.
    line = np.unique(np.searchsorted(line_start, starts, side="right") - 1)
    start = line_start[line]
    end = line_end[np.searchsorted(line_end, start, side="right")]
    row = np.searchsorted(offsets, start, side="right") - 1
    first, _, _ = _grouped(row, blocks.span_hash(prefix, start, end))
    counts["n_dup_lines"] = np.bincount(row, minlength=n) - np.bincount(row[first], minlength=n)
    covered = np.zeros(len(starts) + 1, np.int64)
    if len(starts) >= WINDOW:
        last = len(starts) - WINDOW + 1
        total = np.zeros(last, np.uint64)
        for i in range(WINDOW):
            total = total * np.uint64(0xD6E8FEB86659FD93) + hashes[i : i + last]
        inside = np.flatnonzero(rows[:last] == rows[WINDOW - 1 :])
        _, same, sizes = _grouped(rows[inside], blocks.mix(total[inside]))
        again = inside[sizes[same] > 1]
        np.add.at(covered, again, 1)
        np.add.at(covered, again + WINDOW, -1)
    repeated = np.cumsum(covered[:-1]) > 0
    counts["n_repeat_words"] = np.bincount(rows[repeated], minlength=n)
    return counts, (starts, ends, rows, hashes)


def _tokenised(model, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words' tokens, one after the other, and how many each word has."""
    lists = model.encode(words, out_type=int, num_threads=1)
    lengths = np.fromiter(map(len, lists), np.int64, len(lists))
    flat = np.fromiter((i for own in lists for i in own), np.int64, int(lengths.sum()))
    return flat, lengths


def token_measures(model, is_byte: np.ndarray, data: np.ndarray, n: int, word: tuple) -> dict[str, np.ndarray]:
    """Per row: tokens, byte-fallback tokens, and the entropy of its tokens in bits. Words are tokenised one by one."""
    starts, ends, rows, hashes = word
    if not len(starts):
        return {"n_tokens": np.zeros(n, np.int64), "n_byte_tokens": np.zeros(n, np.int64), "token_entropy": np.zeros(n)}
    _, first, same = np.unique(hashes, return_index=True, return_inverse=True)
    raw = data.tobytes()
    distinct = [raw[a:b].decode("utf-8", "replace") for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
    flat, lengths = _tokenised(model, distinct)
    begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    count = lengths[same]
    upto = np.concatenate([[0], np.cumsum(count)])
    ids = flat[np.repeat(begin[same] - upto[:-1], count) + np.arange(upto[-1])]
    row = np.repeat(rows, count)
    total = np.bincount(row, minlength=n)
    keys, times = np.unique(row * (1 << 20) + ids, return_counts=True)
    owner = keys >> 20
    share = times / total[owner]
    entropy = np.bincount(owner, weights=-share * np.log2(share), minlength=n)
    return {"n_tokens": total, "n_byte_tokens": np.bincount(row[is_byte[ids]], minlength=n), "token_entropy": np.maximum(entropy, 0.0)}


def scripts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The place in SCRIPTS of most of a row's letters; without letters the last."""
    kind = _SCRIPT[data]
    found = np.stack([_per_row(kind == k, offsets) for k in range(len(SCRIPTS))])
    return np.where(found.sum(axis=0) > 0, found.argmax(axis=0), len(SCRIPTS) - 1)


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens", "n_byte_tokens"]
_MEASURED = "doc_id long, " + ", ".join(f"{c} long" for c in _COUNTS) + ", token_entropy double, script string, lang string"


def measure(docs: DataFrame, model_path: str = DEFAULT_MODEL) -> DataFrame:
    """Base counts, token counts, token entropy and script of each row of docs (doc_id, text), and its lang if docs has it."""
    spark = docs.sparkSession
    blocks.arrow_batches(spark)
    shared = spark.sparkContext.broadcast(model_bytes(model_path))

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=shared.value)
        is_byte = np.array([model.is_byte(i) for i in range(model.get_piece_size())])
        for batch in blocks.merged(frames, _ROOM):
            for part, data, offsets in blocks.rows_per_batch(iter([batch]), _ROOM):
                counts, word = base_counts(data, offsets)
                counts |= token_measures(model, is_byte, data, part.num_rows, word)
                names = [SCRIPTS[i] for i in scripts(data, offsets).tolist()]
                columns = [pa.array(counts[c].astype(np.int64)) for c in _COUNTS]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *columns, pa.array(counts["token_entropy"]), pa.array(names), part.column("lang")],
                    names=[x.split()[0] for x in _MEASURED.split(", ")],
                )

    lang = docs["lang"].cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", lang.alias("lang")).mapInArrow(run, _MEASURED)


def _keys(script: str = "script", lang: str = "lang") -> Column:
    """The groups that a text's class may take its quartiles from: its language, its script, the corpus."""
    levels = [F.struct(script, lang), F.struct(script, F.lit(None).cast("string")), F.struct(*[F.lit(None).cast("string")] * 2)]
    return F.array(*[F.to_json(level, {"ignoreNullFields": "false"}) for level in levels])


def pools(sizes: DataFrame) -> DataFrame:
    """sizes (script, lang, length_class, n) with the group (key) and lengths (least, most) whose quartiles a class takes."""
    keyed = sizes.select("*", F.posexplode(_keys()).alias("level", "key"))
    cells = keyed.groupBy("key", F.col("length_class").alias("other")).agg(F.sum("n").alias("texts"))
    apart = F.abs(F.col("length_class") - F.col("other"))
    within = [F.sum(F.when(apart <= r, F.col("texts")).otherwise(0)).alias(f"n{r}") for r in range(NEAR_LENGTHS + 1)]
    near = keyed.join(cells, "key").groupBy("script", "lang", "length_class", "level", "key").agg(*within)
    reach = F.lit(None).cast("int")
    for r in range(NEAR_LENGTHS, -1, -1):
        reach = F.when(F.col(f"n{r}") >= LEAST_TEXTS, F.lit(r)).otherwise(reach)
    reach = F.coalesce(reach, F.when(F.col("level") == 2, F.lit(1000)))
    near = near.withColumn("reach", reach).where(F.col("reach").isNotNull())
    first = near.groupBy("script", "lang", "length_class").agg(F.min(F.struct("level", "reach", "key")).alias("p"))
    return first.select(
        "script", "lang", "length_class", F.col("p.key").alias("key"),
        (F.col("length_class") - F.col("p.reach")).alias("least"), (F.col("length_class") + F.col("p.reach")).alias("most"),
    )


def quartiles(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The lower and upper quartile of each measure, as a list of two, by `keys`.

    Measures are rounded to 1 / GRID and counted, and the counts added up in order: the result is exact for the
    rounded values, and the same however the rows are dealt out. A group has no more cells than there are values.
    """
    values = [F.struct(F.lit(m).alias("measure"), F.round(F.col(m) * GRID).cast("long").alias("at")) for m in FLOORS]
    cells = rows.select(*keys, F.explode(F.array(*values)).alias("v")).groupBy(*keys, "v.measure", "v.at")
    cells = cells.agg(F.count("*").alias("texts"))
    group = Window.partitionBy(*keys, "measure")
    upto = F.sum("texts").over(group.orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cells = cells.withColumn("upto", upto).withColumn("all", F.sum("texts").over(group))

    def quartile(share: int) -> Column:
        return F.min(F.when(F.col("upto") * 4 >= F.col("all") * share, F.col("at"))) / F.lit(float(GRID))

    each = cells.groupBy(*keys, "measure").agg(F.array(quartile(1), quartile(3)).alias("q"))
    return each.groupBy(*keys).agg(*[F.max(F.when(F.col("measure") == m, F.col("q"))).alias(m) for m in FLOORS])


def judge(docs: DataFrame, model_path: str = DEFAULT_MODEL, width: float = WIDTH) -> DataFrame:
    """The measures of each row of docs (doc_id, text, and lang where there is one) with base_failed and kept.

    base_failed: fewer than LEAST_WORDS words, or more than MOST_REPEATED percent of the words in windows found
    twice. kept: passes the base rules and lies within the bands of its class. A null or empty text has zeros
    and fails; repeated rows each give a row; an empty table gives an empty table.
    """
    prepare(docs.sparkSession)
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    some = F.greatest(F.col("n_tokens"), F.lit(1))
    rows = (
        measure(docs, model_path)
        .withColumn("chars_per_token", F.col("word_chars") / some)
        .withColumn("byte_share", F.col("n_byte_tokens") / some)
        .withColumn("tokens_per_word", F.col("n_tokens") / F.greatest(F.col("n_words"), F.lit(1)))
        .withColumn("symbols_per_token", F.col("n_symbols") / some)
        .withColumn("lang", F.coalesce("lang", F.lit("")))
        .withColumn("length_class", F.floor(F.log2(some.cast("double"))).cast("int"))
        .withColumn("base_failed", failed)
    )
    rows = written(rows, "measures")
    classes = ["script", "lang", "length_class"]
    passing = rows.where(~F.col("base_failed"))
    sizes = passing.groupBy(*classes).agg(F.count("*").alias("n"))
    own = written(pools(sizes), "pools")
    few = own.count() <= BROADCAST_CLASSES
    small = F.broadcast if few else (lambda table: table)
    # Which pools a class's texts count in: its own, and those of classes with few texts near it.
    kinds = own.select(F.col("key").alias("pool"), "least", "most").distinct()
    feeds = own.select(*classes, F.explode(_keys()).alias("pool")).join(kinds, "pool")
    feeds = feeds.where(F.col("length_class").between(F.col("least"), F.col("most")))
    bands = quartiles(passing.select(*classes, *FLOORS).join(small(feeds), classes), ["pool", "least", "most"])
    limits = []
    for m, (below, above) in FLOORS.items():
        low, high = F.get(m, F.lit(0)), F.get(m, F.lit(1))
        reach = (high - low) * width
        limits.append((low - F.greatest(reach, F.lit(below))).alias(f"{m}_low"))
        limits.append((high + F.greatest(reach, F.lit(above))).alias(f"{m}_high"))
    bands = bands.select(F.col("pool").alias("key"), "least", "most", *limits)
    bands = written(own.join(bands, ["key", "least", "most"]).drop("key"), "bands")
    judged = rows.join(small(bands), classes, "left")
    # A text can't have more entropy than its tokens allow, which longer neighbours do not know.
    most = F.log2(some.cast("double")) * SHORT_ENTROPY
    low = F.when(F.col("least") < F.col("most"), F.least(F.col("token_entropy_low"), most)).otherwise(F.col("token_entropy_low"))
    judged = judged.withColumn("token_entropy_low", low).drop("least", "most")
    within = F.lit(True)
    for m in FLOORS:
        within = within & F.col(m).between(F.col(f"{m}_low"), F.col(f"{m}_high"))
    return judged.withColumn("kept", ~F.col("base_failed") & F.coalesce(within, F.lit(False)))
