"""Personal data: pattern matches, and identifiers found by bootstrapping their lexical contexts.

DataFrame functions only. Base matches (email, ip, card, phone) are the seeds. Each occurrence of a seed,
and of any other token with digits or an at sign, stands in lexical patterns: its two words to the left,
and its left and right neighbours. Spark scores the graph of patterns and values in rounds:

    score(pattern, kind) = sum of the kind's confidence over the pattern's distinct values
                           / (number of its distinct values + SMOOTHING)
    confidence(value, kind) = 1 - product over its patterns of (1 - score(pattern, kind))

Seeds keep confidence 1 for their kind. A pattern counts once the confidences under it add up to
LEAST_SUPPORT and it holds a seed or a value that has reached ACCEPT: values found in one round bring in the
patterns they stand in with the next. Values that reach ACCEPT after ROUNDS rounds are personal data, wherever they occur.

Positions come from the pieces between matches: a match starts after all earlier pieces and matches, a
running sum over one text's matches. Patterns are written so that a text is scanned in linear time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanlens.llm import blocks
from loanlens.session import prepare, written

KINDS = ["email", "ip", "card", "phone"]
OTHER = len(KINDS)
MARK = -1
# A run is entered at its start only (or where the last match ended), so no run is scanned twice.
_TOKEN = r"(?<![A-Za-z0-9@._+/-])[A-Za-z._+/-]*+[0-9@][A-Za-z0-9@._+/-]*+"
PATTERNS = [
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])",
    r"\+[0-9][ ().0-9-]+[0-9]",
    _TOKEN,
]
_IP = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?:\.(?!$)|$)){4}$"
_WORD = r"[^\x20\x09-\x0D]+"
ROUNDS, SMOOTHING, LEAST_SUPPORT, ACCEPT = 3, 2.0, 3.0, 0.8
LEFT_CHARS, RIGHT_CHARS = 64, 32


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits pass the Luhn test; every second one from the right counts double."""
    size = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when((size - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), size), F.lit(0), add) % 10 == 0


def _valid(kind: Column, value: Column) -> Column:
    digits = _digits(value)
    return (
        F.when(kind == 0, F.lit(True))
        .when(kind == 1, value.rlike(_IP))
        .when(kind == 2, F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False))
        .when(kind == 3, F.length(digits).between(9, 15))
        .otherwise(F.lit(False))
    )


def _matches(text: Column, kind: int) -> Column:
    """Per match: its number, the length of the piece before it, its text, and the words beside it."""
    found = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), 0)
    pieces = F.split(text, PATTERNS[kind], -1)

    def entry(value: Column, i: Column) -> Column:
        before = F.get(pieces, i)
        left = F.lower(F.substring(before, F.greatest(F.length(before) - LEFT_CHARS + 1, F.lit(1)), F.lit(LEFT_CHARS)))
        right = F.lower(F.substring(F.get(pieces, i + 1), 1, RIGHT_CHARS))
        return F.struct(
            F.lit(kind).alias("kind"),
            i.alias("number"),
            F.length(before).cast("long").alias("skipped"),
            value.alias("value"),
            F.regexp_extract(left, rf"({_WORD})[\x20\x09-\x0D]+({_WORD})[\x20\x09-\x0D]*$", 1).alias("left2"),
            F.regexp_extract(left, rf"({_WORD})[\x20\x09-\x0D]*$", 1).alias("left1"),
            F.regexp_extract(right, rf"^[^\w]*({_WORD})", 1).alias("right1"),
        )

    return F.transform(found, entry)


_ENTRY = "array<struct<kind:int,number:int,skipped:bigint,value:string,left2:string,left1:string,right1:string>>"


def occurrences(docs: DataFrame) -> DataFrame:
    """Every seed and every other token with digits, one row each, and one row of kind MARK per document row.

    Columns: row (unique), doc_id, text_key, kind, start, end, value, left2, left1, right1, base.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")
    )
    none = F.array().cast(_ENTRY)
    numbers = F.col("text").rlike("[0-9]")
    mark = F.array(F.struct(F.lit(MARK), F.lit(0), F.lit(0).cast("long"), *[F.lit("")] * 4)).cast(_ENTRY)
    at = F.contains(F.col("text"), F.lit("@"))
    found = [F.when(at if k == 0 else numbers, _matches(F.col("text"), k).cast(_ENTRY)).otherwise(none) for k in range(OTHER)]
    found.append(F.when(at | numbers, _matches(F.col("text"), OTHER).cast(_ENTRY)).otherwise(none))
    key = F.when(at | numbers, F.md5("text"))
    spread = rows.select("row", "doc_id", key.alias("text_key"), F.explode(F.concat(mark, *found)).alias("m"))
    spread = spread.select("row", "doc_id", "text_key", "m.*")
    upto = Window.partitionBy("row", "kind").orderBy("number")
    placed = spread.withColumn("end", F.sum(F.col("skipped") + F.length("value")).over(upto))
    placed = placed.withColumn("start", F.col("end") - F.length("value"))
    placed = placed.withColumn("base", _valid(F.col("kind"), F.col("value")))
    placed = placed.where((F.col("kind") == MARK) | F.col("base") | (F.col("kind") == OTHER))
    # Tokens that meet a seed are no candidates.
    line = Window.partitionBy("row").orderBy("start", "end", "kind")
    before = F.max(F.when(F.col("base"), F.col("end"))).over(line.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(F.col("base"), F.col("start"))).over(line.rowsBetween(1, Window.unboundedFollowing))
    placed = placed.withColumn("taken", (F.coalesce(before, F.lit(0)) > F.col("start")) | (F.coalesce(after, F.col("end")) < F.col("end")))
    return placed.where((F.col("kind") != OTHER) | ~F.col("taken")).select(
        "row", "doc_id", "text_key", "kind", "start", "end", "value", "left2", "left1", "right1", "base"
    )


def discovered(found: DataFrame) -> DataFrame:
    """(value, as_kind): values of other tokens that the patterns of the seeds make personal data."""
    two = F.when(F.col("left2") != "", F.concat(F.lit("<"), "left2", F.lit(" "), "left1"))
    beside = F.when((F.col("left1") != "") & (F.col("right1") != ""), F.concat(F.lit("="), "left1", F.lit(" "), "right1"))
    links = found.where(F.col("kind") != MARK).select(
        F.explode(F.array_compact(F.array(two, beside))).alias("pattern"), "kind", "value"
    )
    # One row per pattern and value, however often they meet.
    links = links.groupBy("pattern", "kind", "value").agg(F.lit(1).alias("one")).drop("one")
    # Confidences are at most 1, so only patterns with enough values can ever score; seeds may come in later rounds.
    sizes = links.groupBy("pattern").agg(F.count("*").alias("values")).where(F.col("values") >= LEAST_SUPPORT)
    links = written(links.join(sizes, "pattern"), "links")
    fixed = links.where(F.col("kind") != OTHER).groupBy("pattern", "values", F.col("kind").alias("as_kind")).agg(
        F.count("*").cast("double").alias("trust")
    )
    open_links = links.where(F.col("kind") == OTHER).select("pattern", "values", "value")
    seeded = fixed.select("pattern").distinct()
    trusted = None
    for _ in range(ROUNDS):
        sums, active = fixed, seeded
        if trusted is not None:
            more = open_links.join(trusted, "value").select("pattern", "values", "as_kind", F.col("confidence").alias("trust"))
            sums = fixed.unionByName(more)
            sure = trusted.where(F.col("confidence") >= ACCEPT).select("value").distinct()
            active = seeded.unionByName(open_links.join(sure, "value", "left_semi").select("pattern")).distinct()
        score = sums.groupBy("pattern", "values", "as_kind").agg(F.sum("trust").alias("trust"))
        score = score.where(F.col("trust") >= LEAST_SUPPORT).join(active, "pattern", "left_semi").select(
            "pattern", "as_kind", (F.col("trust") / (F.col("values") + SMOOTHING)).alias("score")
        )
        trusted = open_links.join(score, "pattern").groupBy("value", "as_kind").agg(
            (1 - F.exp(F.sum(F.log(1 - F.col("score"))))).alias("confidence")
        )
        trusted = written(trusted, "trusted")
    best = trusted.groupBy("value").agg(F.max(F.struct("confidence", (-F.col("as_kind")).alias("k"))).alias("b"))
    return best.where(F.col("b.confidence") >= ACCEPT).select("value", (-F.col("b.k")).alias("as_kind"))


def spans(docs: DataFrame) -> DataFrame:
    """Rows of kind, start, end (code points, end exclusive) and base: all personal data of docs (doc_id, text).

    One row of kind MARK stands for each document row, also where nothing is found. A null text is empty.
    """
    prepare(docs.sparkSession)
    found = written(occurrences(docs), "occurrences")
    sure = found.where(F.col("kind") != OTHER).select("row", "doc_id", "text_key", "kind", "start", "end", "base")
    late = found.where(F.col("kind") == OTHER).join(discovered(found), "value")
    late = late.select("row", "doc_id", "text_key", F.col("as_kind").alias("kind"), "start", "end", "base")
    return sure.unionByName(late)


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base (sorted spans) and found (base and discovered spans).

    Reads doc_id and text. One row per row of docs, repeated ones included; counts and `base` are of the
    pattern matches. A null or empty text has none; an empty table gives an empty table. Spans are structs of
    kind (a place in KINDS), start and end, sorted.
    """
    rows = spans(docs).groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        *[F.sum(F.when(F.col("base") & (F.col("kind") == k), 1).otherwise(0)).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sort_array(F.collect_list(F.when(F.col("base"), F.struct("kind", "start", "end")))).alias("base"),
        F.sort_array(F.collect_list(F.when(F.col("kind") != MARK, F.struct("kind", "start", "end")))).alias("found"),
    )
    return rows.drop("row")


def as_text(column: str) -> Column:
    """Spans as kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(column, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def redact(docs: DataFrame) -> DataFrame:
    """docs with every span of personal data in `text` replaced by its kind in angle brackets.

    All columns stay; n_chars, where there is one, is the new length. Spans that meet are replaced as one,
    under the kind of the first. Texts without digits or an at sign pass unchanged and are not shuffled.
    """
    every = spans(docs)
    # Equal texts have equal spans, so the id and a digest of the text find them again.
    chosen = every.where(F.col("kind") != MARK).groupBy("doc_id", "text_key").agg(F.min("row").alias("row"))
    own = every.where(F.col("kind") != MARK).join(chosen.select("row"), "row", "left_semi")
    line = Window.partitionBy("row").orderBy("start", "end", "kind")
    reach = F.max("end").over(line.rowsBetween(Window.unboundedPreceding, -1))
    own = own.withColumn("opens", F.when(F.coalesce(reach, F.lit(0)) <= F.col("start"), 1).otherwise(0))
    own = own.withColumn("island", F.sum("opens").over(line))
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    islands = own.groupBy("row", "doc_id", "text_key", "island").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min(F.struct("start", "end", "kind"))["kind"].alias("kind")
    )
    cuts = islands.groupBy("row", "doc_id", "text_key").agg(
        F.sort_array(F.collect_list(F.struct("start", "end", F.get(names, F.col("kind")).alias("name")))).alias("cuts")
    )
    doc, key, spots = blocks.fresh(docs, "pii_doc", "pii_key", "pii_cuts")
    cuts = cuts.select(F.col("doc_id").alias(doc), F.col("text_key").alias(key), F.col("cuts").alias(spots))
    text = F.coalesce(docs["text"], F.lit(""))
    marked = text.rlike("[0-9@]")
    plain = docs.where(~marked)
    some = docs.where(marked).join(
        cuts, docs["doc_id"].cast("long").eqNullSafe(F.col(doc)) & (F.md5("text") == F.col(key)), "left"
    )

    def around(whole: Column) -> Column:
        """The pieces between the cuts, each but the last with the name of the cut after it."""
        ends = F.concat(F.array(F.lit(0).cast("long")), F.transform(spots, lambda c: c["end"]))

        def piece(c: Column, i: Column) -> Column:
            prior = F.get(ends, i)
            return F.concat(F.substring(whole, (prior + 1).cast("int"), (c["start"] - prior).cast("int")), c["name"])

        last = F.substring(whole, (F.element_at(ends, -1) + 1).cast("int"), F.length(whole))
        return F.concat(F.array_join(F.transform(spots, piece), ""), last)

    some = some.withColumn("text", F.when(F.col(spots).isNull(), F.col("text")).otherwise(around(F.col("text"))))
    if "n_chars" in docs.columns:
        some = some.withColumn(
            "n_chars",
            F.when(F.col(spots).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)),
        )
    return plain.unionByName(some.select(*docs.columns))
