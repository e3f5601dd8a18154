"""Mixing sources to target weights by hash-threshold histograms.

Every document has a hash, and a source takes the documents whose hash lies below a threshold. The
threshold is found without sorting: sizes are summed by source and hash bucket, the running sums name the
bucket in which the source's budget ends, and only that bucket is divided again, LEVELS times in all.
Buckets are nested, so what a higher level settled stays. The final pass is a filter by source and hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanlens.llm import blocks
from loanlens.session import prepare, written

# Three levels of 12 bits: the last bucket is one of 2**36 hash values.
LEVELS, LEVEL_BITS = 3, 12
HASH_DIGITS = LEVELS * LEVEL_BITS // 4
WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2
BROADCAST_SOURCES = 100_000
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Number of words; a null text has none. Breaks are made single blanks, so their count is known."""
    breaks = F.regexp_replace(text, WORD, "x")
    return F.coalesce(F.length(F.translate(breaks, " \t\n\x0b\f\r", "")).cast("long"), F.lit(0).cast("long"))


def document_hash(key: Column) -> Column:
    """The first 36 bits of the id's MD5, as a long; an absent id hashes like the word null."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("null"))), 1, HASH_DIGITS)
    return F.conv(digits, 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size, target of each row of `sizes` (source, source_size long).

    Sources by code point, null last, weigh weights[0], weights[1], ..., repeating. `share` of all sizes is
    dealt by weight; a target stops at `most` times its source's size and the excess is dealt again by
    weight. The common level (target per weight) of the sources below their stop is found from running
    sums over the sources ordered by size per weight. The windows see one row per source.
    """
    everything = Window.partitionBy(F.lit(0))
    placed = sizes.withColumn(
        "place", F.row_number().over(everything.orderBy(F.col("source").isNull(), F.col("source"))) - 1
    )
    listed = F.array(*[F.lit(w) for w in weights])
    placed = placed.withColumn("weight", F.element_at(listed, (F.col("place") % len(weights) + 1).cast("int")))
    placed = placed.withColumn("stop", (F.col("source_size") * most).cast("long"))
    before = everything.orderBy(F.col("stop") / F.col("weight"), "place").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        placed.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("weights", F.sum("weight").over(everything))
        .withColumn("stopped", F.coalesce(F.sum("stop").over(before), F.lit(0)))
        .withColumn("spent", F.coalesce(F.sum("weight").over(before), F.lit(0)))
    )
    # If all sources before this one stop, this is what is left per weight. The first source that it does
    # not lift above its own stop sets the level; behind it the value falls, so the first is the greatest.
    level = (F.col("total") * share - F.col("stopped")) / (F.col("weights") - F.col("spent"))
    placed = placed.withColumn("level", level)
    settled = F.max(F.when(F.col("level") * F.col("weight") <= F.col("stop"), F.col("level"))).over(everything)
    target = F.when(settled.isNull(), F.col("stop").cast("double")).otherwise(
        F.least(settled * F.col("weight"), F.col("stop").cast("double"))
    )
    return placed.select("source", "source_size", target.alias("target"))


def thresholds(hashed: DataFrame, budgets: DataFrame) -> DataFrame:
    """source and limit: the documents of the source with hash < limit come nearest to its budget.

    hashed: source, h, size; budgets: source, budget (long, below the source's sum). No hash value is split:
    the one in which the budget ends is taken if that comes nearer, so the sum is off by at most half the
    sizes at one of the 2**36 hash values.
    """
    state = budgets.withColumn("low", F.lit(0).cast("long")).withColumn("left", F.col("budget"))
    for level in range(LEVELS):
        width = 1 << (LEVEL_BITS * (LEVELS - 1 - level))
        span = width << LEVEL_BITS
        near = hashed.alias("d").join(state.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
        near = near.where((F.col("h") >= F.col("low")) & (F.col("h") < F.col("low") + span))
        sums = near.groupBy(F.col("s.source").alias("source"), "low", "left", F.floor((F.col("h") - F.col("low")) / width).alias("bucket")).agg(
            F.sum("size").alias("sum")
        )
        running = Window.partitionBy("source").orderBy("bucket")
        sums = sums.withColumn("upto", F.sum("sum").over(running))
        # Whole buckets within what is left are taken; the next one is the boundary.
        cut = sums.groupBy("source", "low", "left").agg(
            F.min(F.when(F.col("upto") > F.col("left"), F.struct("bucket", "sum"))).alias("edge"),
            F.max(F.when(F.col("upto") <= F.col("left"), F.col("upto"))).alias("fits"),
        )
        left = F.col("left") - F.coalesce("fits", F.lit(0))
        # The last boundary is one hash value.
        taken = F.when(F.col("edge.sum") < left * 2, 1).otherwise(0) if width == 1 else F.lit(0)
        low = F.col("low") + F.col("edge.bucket") * width + taken
        cut = cut.select("source", low.cast("long").alias("low"), left.alias("left"))
        state = written(cut, "thresholds")
    return state.select("source", F.col("low").alias("limit"))


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """One row per source: source, source_size, target, whole (copies of every document) and limit (hash below
    which a document is taken once more)."""
    sized = docs.select("source", document_hash(F.col("doc_id")).alias("h"), n_words(F.col("text")).alias("size"))
    sized = written(sized, "sized")
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = written(targets(sums, weights, share, most), "targets")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    goal = goal.withColumn("whole", whole.cast("long"))
    extra = F.floor(F.col("target") - F.col("whole") * F.col("source_size")).cast("long")
    budgets = goal.select("source", extra.alias("budget")).where("budget > 0")
    limit = thresholds(sized.where("size > 0").select("source", "h", "size"), budgets)
    goal = goal.alias("g").join(limit.alias("l"), F.col("g.source").eqNullSafe(F.col("l.source")), "left").select(
        "g.*", F.coalesce("limit", F.lit(0)).alias("limit")
    )
    return written(goal, "plan")


def _with_plan(docs: DataFrame, goal: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """docs joined to its source's row of the plan, and the new columns by their names in the plan."""
    names = dict(zip(goal.columns, blocks.fresh(docs, *[f"mix_{c}" for c in goal.columns]), strict=True))
    goal = goal.select(*[F.col(c).alias(n) for c, n in names.items()])
    # The plan is sent along up to a known size; more sources than that are met by a shuffle.
    goal = F.broadcast(goal) if goal.count() <= BROADCAST_SOURCES else goal
    full = docs.join(goal, docs["source"].eqNullSafe(F.col(names["source"])))
    return full, {c: F.col(n) for c, n in names.items()}


def _copies(doc_id: Column, own: dict[str, Column]) -> Column:
    return (own["whole"] + F.when(document_hash(doc_id) < own["limit"], 1).otherwise(0)).cast("long")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken of each row of docs (doc_id, text, source).

    size is the number of words (null text: 0); a source takes every document floor(target / source_size)
    times, and documents with a hash below the source's threshold once more; taken is size * copies. The
    hash depends on the doc_id alone, so reruns agree and rows that repeat an id are taken or left together.
    A source without words has target 0 and takes each document no times. A null source is a source of
    its own, the last. An empty table gives an empty table. More columns are ignored.
    """
    prepare(docs.sparkSession)
    goal = plan(docs, weights, share, most)
    full, own = _with_plan(docs.select("doc_id", "source", n_words(docs["text"]).alias("size")), goal)
    copies = _copies(F.col("doc_id"), own)
    return full.select(
        "doc_id", "source", "size", own["source_size"].alias("source_size"), own["target"].alias("target"),
        copies.alias("copies"), (F.col("size") * copies).alias("taken"),
    )


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """docs with each row as often as the mix takes it, by the rules of `mix`; all columns stay."""
    prepare(docs.sparkSession)
    full, own = _with_plan(docs, plan(docs, weights, share, most))
    times = _copies(docs["doc_id"], own)
    place = blocks.fresh(full, "copy")[0]
    taken = full.where(times > 0).withColumn(place, F.explode(F.sequence(F.lit(1).cast("long"), times)))
    return taken.select(*docs.columns)


ORACLE_SQL = """
WITH sized AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 9))::BIGINT AS h
  FROM documents),
sums AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source IS NULL, source) - 1 AS place
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, [3, 1, 2][(place % 3 + 1)::INT] AS weight, 2 * source_size AS stop FROM sums),
ranked AS (
  SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
         coalesce(sum(stop) OVER w, 0) AS stopped, coalesce(sum(weight) OVER w, 0) AS spent
  FROM weighed
  WINDOW w AS (ORDER BY stop / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levelled AS (
  SELECT *, (total * 1.5::DOUBLE - stopped) / (weights - spent) AS lvl FROM ranked),
settled AS (
  SELECT max(lvl) FILTER (WHERE lvl * weight <= stop) AS common FROM levelled),
goal AS (
  SELECT source, source_size,
         CASE WHEN common IS NULL THEN stop::DOUBLE ELSE least(common * weight, stop::DOUBLE) END AS target
  FROM levelled, settled),
parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM goal),
ordered AS (
  SELECT d.doc_id, d.size, g.source_size, g.target, g.whole,
         floor(g.target - g.whole * g.source_size)::BIGINT AS budget,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h RANGE UNBOUNDED PRECEDING) AS upto,
         sum(d.size) OVER (PARTITION BY d.source, d.h) AS here
  FROM sized d JOIN parts g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN upto <= budget OR (upto - here <= budget AND here < 2 * (budget - (upto - here)))
                             THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ordered
"""
