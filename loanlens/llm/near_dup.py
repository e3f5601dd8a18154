"""Near-duplicate groups by b-bit MinHash.

Every text becomes a set of word shingles (64-bit hashes). From 256 minima per set, bands of five name
candidate buckets, and the low four bits of each minimum are packed as four bit planes: two sets'
planes give the share of equal low bits by bit counts, and, corrected for chance collisions, an
estimate of their similarity. Candidates above a cautious estimate are confirmed on the full sets.

Links are found without listing a bucket's pairs:

1. equal sets are one class, stood for by the smallest id;
2. a class leaves its buckets where the shingles that it has alone rule out any link there;
3. in each bucket, every class is tested against one hub, first the class with the smallest share of
   shingles of its own, and the links found give components. As long as many comparisons are left, up to
   HUB_ROUNDS times, the bucket is tested against a new hub, drawn from the classes outside its largest
   component; a hub whose turn is over has all its links in the bucket and leaves it, and so does a bucket
   that is one component;
4. what is left are pairs of a bucket in different components: the smaller ones are compared with all of it, in
   an equi-join by bucket and block. Sizes and packed signatures first tell which classes have any partner
   that may be linked; these classes then meet with their full sets, and links come out.

Rows that are shuffled for comparisons carry signatures; sets are fetched for what passed by signature.
A bucket's unlinked lookalikes are compared with each other (by bit counts, in a join that Spark may split);
no pair is skipped. There are so many bands that a link at the threshold has no common band in less than
MISS of all cases; beyond that nothing is lost.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanlens.llm import blocks
from loanlens.llm.components import components
from loanlens.session import forget, prepare, written

MINIMA, ROWS, BITS = 256, 5, 4
LONGS = MINIMA // 64
MISS = 1e-7
# Tables of two or three numbers are sent to every executor up to so many rows (24 MB); beyond it they are shuffled.
BROADCAST_IDS = 1_000_000
PLANES = [f"p{i}" for i in range(LONGS * BITS)]
# Classes of a bucket that one task holds at once in the last comparison.
BLOCK_ROWS = 16384
HUB_ROUNDS = 4
# So few comparisons are made at once, without more hubs first; the result is the same.
FEW_PAIRS = 20_000_000
_SEEDS = np.random.default_rng(20240601)
_FACTOR = _SEEDS.integers(0, 1 << 32, MINIMA, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_SHIFT = _SEEDS.integers(0, 1 << 32, MINIMA, dtype=np.uint64).astype(np.uint32)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data = blocks.fold(data)
    starts, ends, rows = blocks.words(data, offsets)
    n = len(offsets) - 1
    if not len(starts):
        return [np.zeros(0, np.uint64)] * n
    word = blocks.span_hash(blocks.prefix_hash(data), starts, ends)
    counts = np.bincount(rows, minlength=n)
    first = np.concatenate([[0], np.cumsum(counts)])
    total = np.zeros(max(0, len(word) - width + 1), np.uint64)
    for i in range(width):
        total *= np.uint64(0xD6E8FEB86659FD93)
        total += word[i : i + len(total)]
    total = blocks.mix(total)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= width:
            own = np.sort(total[a : b - width + 1])
            keep = np.ones(len(own), bool)
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            out.append(own[keep])
        elif b > a:
            whole = np.full(1, b - a, np.uint64)
            for w in word[a:b]:
                whole = blocks.mix(whole * np.uint64(0xA0761D6478BD642F) + w)
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """The minima of filled sets, one row per set."""
    sizes = np.array([len(s) for s in sets])
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    base = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((MINIMA, len(sets)), np.uint32)
    work = np.empty_like(base)
    for k in range(MINIMA):
        np.multiply(base, _FACTOR[k], out=work)
        work += _SHIFT[k]
        np.minimum.reduceat(work, first, out=out[k])
    return np.ascontiguousarray(out.T)


def bands(least: int) -> int:
    """Bands for which pairs of a similarity of `least` percent are missed in less than MISS of all cases."""
    wanted = math.ceil(math.log(MISS) / math.log(1 - (least / 100) ** ROWS)) if least < 100 else 1
    return min(wanted, MINIMA // ROWS)


def band_keys(least: np.ndarray, count: int) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of the key."""
    part = least[:, : count * ROWS].reshape(len(least), count, ROWS).astype(np.uint64)
    key = np.tile(np.arange(1, count + 1, dtype=np.uint64), (len(least), 1))
    for i in range(ROWS):
        key = blocks.mix(key * np.uint64(0xE7037ED1A0B428DB) + part[:, :, i])
    return key.view(np.int64)


def bit_planes(least: np.ndarray) -> np.ndarray:
    """The low bits of the minima, one plane (a bit of every minimum, as longs) per bit."""
    mixed = least * np.uint32(0x9E3779B1)
    mixed ^= mixed >> np.uint32(15)
    out = np.empty((len(least), LONGS * BITS), np.int64)
    for bit in range(BITS):
        plane = np.packbits((mixed >> np.uint32(bit)).astype(np.uint8) & 1, axis=1, bitorder="little")
        out[:, LONGS * bit : LONGS * bit + LONGS] = plane.view(np.int64)
    return out


def digest(own: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set, whatever the order of its members."""
    if not len(own):
        return 0, 0
    parts = (blocks.mix(own ^ np.uint64(k)).sum(dtype=np.uint64) for k in (0x5851F42D4C957F2D, 0x14057B7EF767814F))
    one, two = (int(x.view(np.int64)) for x in parts)
    return one, two


def _signatures(width: int, count: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in blocks.rows_per_batch(frames):
            sets = shingle_sets(data, offsets, width)
            sizes = np.array([len(s) for s in sets], np.int64)
            filled = np.flatnonzero(sizes)
            planes = np.zeros((len(sets), LONGS * BITS), np.int64)
            keys = np.zeros((len(sets), count), np.int64)
            names = np.array([digest(s) for s in sets], np.int64)
            if len(filled):
                chosen = [sets[i] for i in filled]
                least = minima(chosen)
                planes[filled], keys[filled] = bit_planes(least), band_keys(least, count)
            lengths = np.where(sizes > 0, count, 0)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sizes), pa.array(names[:, 0]), pa.array(names[:, 1]),
                 *[pa.array(planes[:, i]) for i in range(LONGS * BITS)],
                 blocks.list_column(keys[filled].ravel(), lengths, pa.int64())],
                names=["doc_id", "n_shingles", "d0", "d1", *PLANES, "bands"],
            )

    return run


def signatures(docs: DataFrame, width: int = 3, least: int = 85) -> DataFrame:
    """doc_id, n_shingles, a 128-bit digest of the set (d0, d1), bit planes and band keys of each text."""
    blocks.arrow_batches(docs.sparkSession)
    schema = f"doc_id long, n_shingles long, d0 long, d1 long, {', '.join(p + ' long' for p in PLANES)}, bands array<long>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_signatures(width, bands(least)), schema)


def full_sets(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id, the first half of the set's digest, and the whole set."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in blocks.rows_per_batch(frames):
            sets = shingle_sets(data, offsets, width)
            lists = blocks.list_column(np.concatenate(sets).view(np.int64), np.array([len(s) for s in sets]), pa.int64())
            half = pa.array(np.array([digest(s)[0] for s in sets], np.int64))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), half, lists], names=["doc_id", "d0", "shingles"])

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(run, "doc_id long, d0 long, shingles array<long>")


def estimate(a: str, b: str) -> F.Column:
    """Similarity by equal low bits, corrected for chance: (equal - C) / (1 - C), C = 2 ** -BITS."""

    def equal(part: int) -> F.Column:
        differ = None
        for bit in range(BITS):
            name = PLANES[LONGS * bit + part]
            here = F.col(f"{a}.{name}").bitwiseXOR(F.col(f"{b}.{name}"))
            differ = here if differ is None else differ.bitwiseOR(here)
        return F.bit_count(F.bitwise_not(differ))

    chance = 2.0**-BITS
    same = sum((equal(part) for part in range(1, LONGS)), equal(0))
    return (same / F.lit(float(MINIMA)) - chance) / (1 - chance)


def _can_link(least: int) -> F.Column:
    """Whether sizes and shared shingles of the classes a and b allow a similarity of least percent."""
    common = F.least(F.col("a.shared"), F.col("b.shared"))
    return common * (100 + least) >= (F.col("a.n") + F.col("b.n")) * least


def _sent(ids: DataFrame, count: int) -> DataFrame:
    """The ids, sent to every executor where their number allows it."""
    return F.broadcast(ids) if count <= BROADCAST_IDS else ids


def _confirmed(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """The pairs (u, v) whose full sets have 100 * intersection >= least * union."""
    pairs = written(pairs, "pairs")
    count = 2 * pairs.count()
    ids = pairs.select(F.col("u").alias("doc_id")).union(pairs.select("v")).distinct()
    some = sets.join(_sent(ids, count), "doc_id", "left_semi")
    one = some.select(F.col("doc_id").alias("u"), F.col("shingles").alias("su"))
    two = some.select(F.col("doc_id").alias("v"), F.col("shingles").alias("sv"))
    met = F.size(F.array_intersect("su", "sv"))
    both = F.size("su") + F.size("sv") - met
    found = two.join(_sent(pairs, count), "v").join(one, "u").where(met * 100 >= both * least).select("u", "v")
    found = written(found, "links")
    forget(pairs)
    return found


def _mixed(rows: DataFrame) -> DataFrame:
    """Rows of the buckets that hold several components, with the largest one (main) and the bucket's size."""
    by_root = rows.groupBy("key", "root").agg(F.count("*").alias("c"))
    mixed = by_root.groupBy("key").agg(
        F.count("*").alias("roots"), F.sum("c").alias("size"), F.max(F.struct("c", "root")).alias("most")
    )
    mixed = written(mixed.where("roots > 1").select("key", F.col("most.root").alias("main"), "size"), "mixed")
    return rows.drop("main", "size").join(_sent(mixed, mixed.count()), "key")


def _met(rows: DataFrame, rank: F.Column, least: int, sure: float) -> DataFrame:
    """Rows with the hub of their bucket, the class that is least by `rank`: its id (hub), and whether the two may be
    linked and are in different components (passes)."""
    sign = ["doc_id", "root", "n", "shared", *PLANES]
    hub = rows.where(rank.isNotNull()).groupBy("key").agg(F.min(F.struct(rank.alias("r"), *sign)).alias("h"))
    hub = hub.select("key", *[F.col(f"h.{c}").alias(c) for c in sign])
    passes = (F.col("a.root") != F.col("b.root")) & _can_link(least) & (estimate("a", "b") >= sure)
    met = rows.alias("a").join(hub.alias("b"), "key").select("key", *[f"a.{c}" for c in sign], F.col("b.doc_id").alias("hub"), passes.alias("passes"))
    return written(met, "met")


def _block_links(rows: DataFrame, sets: DataFrame, least: int, sure: float) -> DataFrame:
    """Links between classes of a bucket in different components; each bucket is cut into blocks.

    First the classes are found that have any partner by size and signature; they alone then meet with their full
    sets, in a join that passes links only.
    """
    count = F.ceil(F.col("size") / BLOCK_ROWS).cast("int")
    block = F.pmod(F.xxhash64("doc_id"), count).cast("int").alias("block")
    spread = F.explode(F.sequence(F.lit(0), count - 1)).alias("block")
    same = (F.col("a.key") == F.col("b.key")) & (F.col("a.block") == F.col("b.block"))
    maybe = same & (F.col("a.root") != F.col("b.root")) & _can_link(least) & (estimate("a", "b") >= sure)
    minor, every = rows.where("root <> main").select("*", spread), rows.select("*", block)
    some = written(minor.alias("a").join(every.alias("b"), maybe, "left_semi"), "minor")
    others = written(every.alias("b").join(some.alias("a"), maybe, "left_semi"), "partners")
    ids = some.select("doc_id").union(others.select("doc_id")).distinct()
    whole = written(sets.join(_sent(ids, some.count() + others.count()), "doc_id", "left_semi").select("doc_id", "shingles"), "whole")
    met = F.size(F.array_intersect("a.shingles", "b.shingles"))
    linked = met * (100 + least) >= (F.size("a.shingles") + F.size("b.shingles")) * least
    pairs = some.join(whole, "doc_id").alias("a").join(others.join(whole, "doc_id").alias("b"), maybe & linked)
    ends = [F.greatest("a.doc_id", "b.doc_id").alias("u"), F.least("a.doc_id", "b.doc_id").alias("v")]
    links = written(pairs.select(*ends).distinct(), "links")
    forget(some, others, whole)
    return links


def near_duplicates(docs: DataFrame, width: int = 3, least: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row of `docs` (doc_id, text; more columns are ignored).

    Links join texts whose shingle sets (`width` words, A-Z in lower case) have a similarity of at
    least `least` percent. component_id is the smallest doc_id reachable; kept marks that document.
    A null, an empty text and one without words have an empty set and no links. Rows with a null
    doc_id are of no document and are left out. Rows that repeat a doc_id are linked by their own texts,
    and each gives a row. An empty table gives an empty table.
    """
    spark = prepare(docs.sparkSession)
    docs = docs.where(F.col("doc_id").isNotNull())
    marks = written(signatures(docs, width, least), "signatures")
    name = ["n_shingles", "d0", "d1"]
    # Rows of equal sets have equal signatures, so any of them stands for the class.
    signs = [F.first(c).alias(c) for c in [*PLANES, "bands"]]
    reps = marks.where("n_shingles > 0").groupBy(*name).agg(F.min("doc_id").alias("doc_id"), *signs)
    reps = written(reps, "classes")
    classes = reps.select(*name, F.col("doc_id").alias("rep"))
    members = marks.select("doc_id", *name, F.col("n_shingles").alias("size")).join(classes, name, "left")
    members = members.select("doc_id", F.col("size").alias("n_shingles"), F.coalesce("rep", "doc_id").alias("rep"))
    members = written(members, "members")
    forget(marks)
    spread = reps.select("doc_id", "d0", F.explode("bands").alias("key"))
    wide = written(spread.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key"), "keys")
    bucket = written(spread.join(_sent(wide, wide.count()), "key", "left_semi"), "buckets")
    candidates = written(bucket.select("doc_id", "d0").distinct(), "candidates")
    ids = _sent(candidates.select("doc_id").distinct(), candidates.count())
    sets = full_sets(docs.join(ids, "doc_id", "left_semi"), width).dropDuplicates(["doc_id", "d0"])
    known = _sent(candidates, candidates.count())
    sets = written(sets.join(known, ["doc_id", "d0"], "left_semi"), "sets")

    # Shingles that only one candidate has can't be common to two.
    crowd = sets.select("doc_id", "d0", F.explode("shingles").alias("s"))
    single = crowd.groupBy("s").agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id"), F.min("d0").alias("d0"))
    alone = single.where("n = 1").groupBy("doc_id", "d0").agg(F.count("*").alias("own"))
    nodes = reps.select("doc_id", F.col("n_shingles").alias("n"), "d0", *PLANES).join(known, ["doc_id", "d0"], "left_semi")
    nodes = nodes.join(alone, ["doc_id", "d0"], "left").withColumn("shared", F.col("n") - F.coalesce("own", F.lit(0)))
    nodes = nodes.where(F.col("shared") * 100 >= F.col("n") * least)
    placed = written(bucket.join(nodes, ["doc_id", "d0"]).select("key", "doc_id", "n", "shared", *PLANES), "placed")
    forget(reps, wide, bucket, candidates)
    # A link needs enough common shingles for the smallest partner that the bucket, and the threshold, allow.
    smallest = placed.groupBy("key").agg(F.min("n").alias("smallest"), F.count("*").alias("size")).where("size > 1")
    smallest = written(smallest, "smallest")
    partner = F.greatest(F.col("smallest") * 100, F.col("n") * least)
    rows = placed.join(_sent(smallest, smallest.count()), "key").where(
        (F.col("n") * 100 + partner) * least <= F.col("shared") * (100 + least) * 100
    )
    rows = written(rows.drop("smallest", "size").withColumn("root", F.col("doc_id")), "rows")
    forget(placed, smallest)

    # Estimates of linked pairs lie near their similarity (standard error 0.024): five errors below is safe.
    sure = least / 100 - 0.12
    roots = spark.createDataFrame([], "node long, root long")
    for turn in range(HUB_ROUNDS + 1):
        pairs_left = rows.where("root <> main").agg(F.sum("size")).first()[0] or 0 if turn else None
        if pairs_left == 0:
            break
        if turn == HUB_ROUNDS or (turn and pairs_left <= FEW_PAIRS):
            links = _block_links(rows, sets, least, sure)
            met = None
        else:
            rank = F.when(F.col("root") != F.col("main"), F.xxhash64("doc_id", F.lit(turn)).cast("double")) if turn else None
            met = _met(rows, -F.col("shared") / F.col("n") if rank is None else rank, least, sure)
            ends = [F.greatest("doc_id", "hub").alias("u"), F.least("doc_id", "hub").alias("v")]
            links = _confirmed(met.where("passes").select(*ends).distinct(), sets, least)
        if links.limit(1).count():
            # New links join the roots found so far, so the search starts from stars.
            roots = components(links.union(roots.select(F.col("node").alias("u"), F.col("root").alias("v"))))
        if met is None:
            break
        # A hub has all its links in the bucket now, and leaves it.
        left = met.where("doc_id <> hub").drop("hub", "passes", "root")
        left = left.join(_sent(roots.withColumnRenamed("node", "doc_id"), roots.count()), "doc_id", "left")
        left = written(_mixed(left.withColumn("root", F.coalesce("root", "doc_id"))), "rows")
        forget(rows, met)
        rows = left
    forget(rows, sets)
    result = members.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(
        "doc_id", "n_shingles", F.coalesce("root", "rep").alias("component_id")
    )
    return result.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def deduplicate(docs: DataFrame, width: int = 5, least: int = 80) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id, with all its columns.

    Of rows that repeat a kept doc_id, the one with the least text stays (null first). Rows with a null
    doc_id are of no group and stay.
    """
    found = written(near_duplicates(docs, width, least), "groups")
    # Most documents are kept once. The texts meet the ids of the others, which are fewer and can be sent to longer inputs.
    id_name, times, place = blocks.fresh(docs, "kept_id", "times", "place")
    counted = found.groupBy(F.col("doc_id").alias(id_name)).agg(F.sum(F.col("kept").cast("long")).alias(times))
    others = written(counted.where(F.col(times) != 1), "others")
    several = others.where(F.col(times) > 1)
    same = docs["doc_id"].cast("long") == F.col(id_name)
    named = docs.where(docs["doc_id"].cast("long").isNotNull())
    once = named.join(_sent(others.select(id_name), others.count()), same, "left_anti")
    order = Window.partitionBy("doc_id").orderBy("text")
    again = docs.join(_sent(several.select(id_name), several.count()), same, "left_semi").withColumn(place, F.row_number().over(order))
    again = again.where(F.col(place) == 1).select(*docs.columns)
    return once.unionByName(again).unionByName(docs.where(F.col("doc_id").isNull()))


# The exact result for width 3 and 85 percent: every pair that shares a shingle is compared.
ORACLE_SQL = r"""
WITH RECURSIVE read AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents WHERE doc_id IS NOT NULL
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
  FROM read
), spread AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
), links AS MATERIALIZED (
  SELECT a.doc_id AS u, b.doc_id AS v FROM spread a JOIN spread b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id, doc_id AS r FROM sets UNION SELECT reach.doc_id, v FROM reach JOIN links ON r = u
)
SELECT doc_id, max(n)::BIGINT AS n_shingles, min(r) AS component_id, doc_id = min(r) AS kept
FROM reach JOIN (SELECT doc_id, len(s) AS n FROM sets) USING (doc_id) GROUP BY doc_id
"""
