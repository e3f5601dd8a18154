"""The prefix trie of conversations: which openings are shared, by how many, and what sharing them saves.

Every prefix of a conversation has a 128-bit digest, the running exclusive-or of hashes of its turns with their
places (`scan.running`: no conversation is gathered in one task). Texts are hashed where they are read and never
shuffled. A count-min sketch over all digests is built in the tasks, added up in strips and sent to all of them: a
prefix that it counts once belongs to one conversation, so its node is final and is emitted where it is. Only the
others are grouped by digest.

Sums over subtrees need no walk by levels. A node's name is its smallest member, and the shared nodes of one name
are a chain that goes down from its top to the name's last shared turn. Chains hang on chains: their totals are
added up by doubling the distance (a round for each power of two), and running sums along each chain, from below,
give the nodes' values.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.llm import blocks
from loanlens.llm.scan import running
from loanlens.session import prepare, written

# The sketch: ROWS counters a prefix, CELLS_EACH cells a prefix in each row, and no more than MOST_CELLS in all (two
# bits each, 16 MB: the bound of what is broadcast). A fuller sketch proves fewer singletons; results stay the same.
ROWS, CELLS_EACH, MOST_CELLS = 4, 4, 1 << 26
STRIPS = 16
NOTHING = hashlib.sha256(b"").hexdigest()
COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), x, y (hashes of role and text), len (code points of the text).

    Turns are ordered by number (null first), those of one number by the hashes of their contents. A null role or text
    is empty. Rows without conv_id are of no conversation. Repeated rows are turns of their own.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    own = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.xxhash64(role, text).alias("x"),
        F.xxhash64(F.lit("y"), text, role).alias("y"),
        F.char_length(text).cast("long").alias("len"),
        F.lit(1).cast("long").alias("one"),
    )
    placed = running(own, "conv_id", [F.col("turn").asc_nulls_first(), "x", "y"], {"pos": "one"})
    return placed.select("conv_id", "pos", "x", "y", "len")


def rebuilt(own: DataFrame, opening: Column, base: Column) -> DataFrame:
    """Conversations (as of `turns`) whose first turns are another's: (conv_id, depth, x, y, len, ending).

    Of each conv_id, the first `opening` turns (5 at most) of conversation `base` come first (all if it has fewer),
    then its own after its first `opening`. A row of depth 0 stands for each conversation; there `ending` is its number
    of turns, and 0 elsewhere. Both arguments are expressions of conv_id.
    """
    item = F.struct("pos", "x", "y", "len")
    heads = own.where("pos <= 5").join(own.select(base.alias("conv_id")).distinct(), "conv_id", "left_semi")
    heads = heads.groupBy(F.col("conv_id").alias("base")).agg(F.array_sort(F.collect_list(item)).alias("head"))
    heads = written(heads, "heads")
    convs = own.groupBy("conv_id").agg(F.max("pos").alias("n"))
    convs = convs.withColumn("base", base).withColumn("h", opening.cast("long")).join(heads, "base", "left")
    convs = convs.withColumn("head", F.expr("slice(coalesce(head, array()), 1, cast(h as int))"))
    ending = (F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).cast("long")
    tops = convs.select("conv_id", ending.alias("ending"), F.posexplode(F.concat(
        F.array(F.struct(F.lit(0).cast("long").alias("pos"), F.lit(0).cast("long").alias("x"),
                         F.lit(0).cast("long").alias("y"), F.lit(0).cast("long").alias("len"))),
        "head",
    )).alias("depth", "t"))
    tops = tops.select("conv_id", F.col("depth").cast("long").alias("depth"), "t.x", "t.y", "t.len", "ending")
    tops = tops.withColumn("ending", F.when(F.col("depth") == 0, F.col("ending")).otherwise(0))
    sizes = heads.select("base", F.size("head").alias("has"))
    rest = own.withColumn("h", opening.cast("long")).where("pos > h").withColumn("base", base).join(sizes, "base", "left")
    shift = F.least(F.coalesce("has", F.lit(0)), F.col("h")) - F.col("h")
    rest = rest.select("conv_id", (F.col("pos") + shift).alias("depth"), "x", "y", "len", F.lit(0).cast("long").alias("ending"))
    return tops.unionByName(rest)


def prefixes(sequences: DataFrame) -> DataFrame:
    """conv_id, depth, the prefix's digest (a, b) and its parent's (pa, pb), len, and ending (turns of the conversation)."""
    real = F.col("depth") > 0
    marked = sequences.select(
        "conv_id", "depth", "len", F.col("ending").alias("mark"),
        F.when(real, F.xxhash64("depth", "x", "y")).otherwise(0).alias("i"),
        F.when(real, F.xxhash64("y", "depth", "x", F.lit("j"))).otherwise(0).alias("j"),
    )
    chained = running(marked, "conv_id", ["depth"], {"ending": "mark"}, {"a": "i", "b": "j"})
    parent = [F.col("a").bitwiseXOR(F.col("i")).alias("pa"), F.col("b").bitwiseXOR(F.col("j")).alias("pb")]
    return chained.select("conv_id", "depth", "a", "b", *parent, "len", "ending")


def _cells(a: np.ndarray, b: np.ndarray, row: int, size: int) -> np.ndarray:
    mixed = blocks.mix(a.view(np.uint64) + b.view(np.uint64) * np.uint64(2 * row + 0x9E3779B97F4A7C15))
    return (mixed & np.uint64(size - 1)).astype(np.int64)


def sketch(digests: DataFrame, count: int) -> np.ndarray:
    """A count-min sketch of (a, b): ROWS rows of counters that stop at 2."""
    wanted = min(max(count, 1) * CELLS_EACH, MOST_CELLS // ROWS)
    size = 1 << max(12, (wanted - 1).bit_length())
    size = min(size, MOST_CELLS // ROWS)
    width = ROWS * size // STRIPS

    def task(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((ROWS, size), np.uint8)
        for batch in frames:
            if batch.num_rows:
                a, b = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b"))
                for row in range(ROWS):
                    cell, times = np.unique(_cells(a, b, row, size), return_counts=True)
                    counts[row, cell] = np.minimum(counts[row, cell] + np.minimum(times, 2), 2)
        if counts.any():
            cut = [_packed(part) for part in counts.reshape(STRIPS, width)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(STRIPS)), pa.array(cut, pa.binary())], names=["strip", "cells"])

    def add(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}  # no more than STRIPS, of a fixed size
        for batch in frames:
            for strip, share in zip(batch.column("strip").to_pylist(), batch.column("cells"), strict=True):
                own = _unpacked(share.as_py())
                held[strip] = np.minimum(held[strip] + own, 2) if strip in held else own
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.int64()), pa.array([_packed(v) for v in held.values()], pa.binary())],
            names=["strip", "cells"],
        )

    shares = digests.select("a", "b").mapInArrow(task, "strip long, cells binary")
    out = np.zeros((STRIPS, width // 4), np.uint8)
    for r in shares.repartition(STRIPS, "strip").mapInArrow(add, "strip long, cells binary").collect():
        out[r["strip"]] = np.frombuffer(r["cells"], np.uint8)
    return out.reshape(ROWS, size // 4)


def _packed(counts: np.ndarray) -> bytes:
    four = counts.reshape(-1, 4)
    return (four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6).astype(np.uint8).tobytes()


def _unpacked(cells: bytes) -> np.ndarray:
    own = np.frombuffer(cells, np.uint8)
    return np.column_stack([own >> s & 3 for s in (0, 2, 4, 6)]).astype(np.uint8).ravel()


def screened(rows: DataFrame) -> DataFrame:
    """Prefix rows with `single` and `parent_single`: whether the sketch proves that one conversation has them."""
    spark = rows.sparkSession
    real = rows.where("depth > 0")
    counts = spark.sparkContext.broadcast(sketch(real, real.count()))
    names = [*rows.columns, "single", "parent_single"]

    def once(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.zeros(len(a), bool)
        for row, cells in enumerate(counts.value):
            at = _cells(a, b, row, 4 * len(cells))
            out |= (cells[at >> 2] >> (2 * (at & 3)).astype(np.uint8) & 3) == 1
        return out

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            if batch.num_rows:
                depth, a, b, pa_, pb = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("depth", "a", "b", "pa", "pb"))
                own, up = (depth > 0) & once(a, b), (depth > 1) & once(pa_, pb)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own), pa.array(up)], names=names)

    schema = f"{blocks.column_types(rows, rows.columns)}, single boolean, parent_single boolean"
    return rows.mapInArrow(run, schema)


def _member_digests(ends: DataFrame) -> DataFrame:
    """(a, b, sha): SHA-256 of the comma-joined conv_ids of each (a, b), ascending.

    Ids are dealt out by ranges and joined to a piece per batch there; a digest is one pass over its pieces, read as a stream.
    """
    laid = ends.select("a", "b", "conv_id").repartitionByRange("a", "b", "conv_id").sortWithinPartitions("a", "b", "conv_id")

    def pieces(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            if not batch.num_rows:
                continue
            a, b, ids = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b", "conv_id"))
            new = np.ones(len(a), bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            starts = np.flatnonzero(new)
            stops = np.append(starts[1:], len(a))
            text = [",".join(map(str, ids[i:j].tolist())) for i, j in zip(starts.tolist(), stops.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[starts]), pa.array(b[starts]), pa.array(ids[starts]), pa.array(text)], names=["a", "b", "low", "piece"]
            )

    def digests(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own = None, None
        for batch in frames:
            done = []
            for r in batch.to_pylist():
                if (r["a"], r["b"]) == at:
                    own.update(b"," + r["piece"].encode())
                    continue
                if at:
                    done.append((*at, own.hexdigest()))
                at, own = (r["a"], r["b"]), hashlib.sha256(r["piece"].encode())
            yield _digest_rows(done)
        if at:
            yield _digest_rows([(*at, own.hexdigest())])

    cut = laid.mapInArrow(pieces, "a long, b long, low long, piece string")
    cut = cut.repartition("a", "b").sortWithinPartitions("a", "b", "low")
    return cut.mapInArrow(digests, "a long, b long, sha string")


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    a, b, sha = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sha, pa.string())], names=["a", "b", "sha"]
    )


def _chain_totals(chains: DataFrame) -> DataFrame:
    """(chain, parent, at, leaves, saved) with the sums over all chains below added to each.

    After round k a chain holds the sums of those less than 2**k below it, and knows its ancestor 2**k above.
    """
    now = written(chains.withColumn("up", F.col("parent")), "chains")
    while now.where("up IS NOT NULL").limit(1).count():
        below = now.where("up IS NOT NULL").groupBy(F.col("up").alias("chain"))
        below = below.agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        higher = now.select(F.col("chain").alias("up"), F.col("up").alias("next"))
        now = now.join(below, "chain", "left").join(higher, "up", "left")
        now = now.select(
            "chain", "parent", "at",
            (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            F.col("next").alias("up"),
        )
        now = written(now, "chains")
    return now.drop("up")


def build(sequences: DataFrame) -> DataFrame:
    """The nodes of the trie over `sequences` (conv_id, depth, x, y, len, ending; see `rebuilt`).

    conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256. An empty table has no nodes. Equal turns are those of equal 128-bit digests.
    """
    prepare(sequences.sparkSession)
    blocks.arrow_batches(sequences.sparkSession)
    rows = written(screened(prefixes(sequences)), "prefixes")
    last = F.col("depth") == F.col("ending")
    tails = rows.where("single").withColumn("ended", last)
    common = rows.where("NOT single")
    nodes = common.groupBy("a", "b").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.count("*").alias("n_convs"),
        F.min("len").alias("len"), F.min("pa").alias("pa"), F.min("pb").alias("pb"),
        F.max(last).alias("ended"), F.min("parent_single").alias("parent_single"),
    )
    nodes = written(nodes, "nodes")
    # What hangs on grouped nodes: other grouped nodes, and the first single node of a conversation.
    kind = ["conv_id", "depth", "pa", "pb", "ended"]
    hanging = nodes.where("depth > 0 AND NOT parent_single").select(*kind, "n_convs", F.lit(True).alias("grouped"))
    hanging = hanging.union(
        tails.where("NOT parent_single").select(*kind, F.lit(1).cast("long").alias("n_convs"), F.lit(False).alias("grouped"))
    )
    names = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    parents = written(
        hanging.join(names, ["pa", "pb"]).select("conv_id", "depth", "parent_conv_id", "ended", "grouped"), "parents"
    )
    children = hanging.groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(
        F.count("*").alias("n_children"), F.sum((F.col("n_convs") == 1).cast("long")).alias("n_single")
    )
    counted = nodes.drop("pa", "pb").join(children, ["a", "b"], "left").fillna(0, ["n_children", "n_single"])
    above = parents.where("grouped").select("conv_id", "depth", "parent_conv_id")
    counted = written(counted.join(above, ["conv_id", "depth"], "left"), "counted")

    shared = _subtree_sums(counted.where("n_convs > 1 OR depth = 0"))
    alone = counted.where("n_convs = 1 AND depth > 0").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "conv_id").alias("parent_conv_id"), "n_convs",
        (~F.col("ended")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"), "a", "b",
    )
    grouped = shared.select(*alone.columns).union(alone)
    grouped = grouped.join(_member_digests(common.where(last)), ["a", "b"], "left")
    grouped = grouped.withColumn("ends_sha256", F.coalesce("sha", F.lit(NOTHING)))
    single = parents.where("NOT grouped").select("conv_id", "depth", "parent_conv_id", "ended").union(
        tails.where("parent_single").select("conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), "ended")
    )
    single = single.select(
        "conv_id", "depth", "parent_conv_id", F.lit(1).cast("long").alias("n_convs"),
        (~F.col("ended")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.when(F.col("ended"), F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(NOTHING).alias("ends_sha256"),
    )
    return grouped.select(*COLUMNS).union(single.select(*COLUMNS))


def _subtree_sums(shared: DataFrame) -> DataFrame:
    """The shared nodes with n_leaves and saved_tokens of their subtrees."""
    shared = shared.withColumn("leaves", F.col("n_single") + (F.col("n_children") == 0).cast("long"))
    shared = shared.withColumn("saved", (F.col("n_convs") - 1) * F.col("len"))
    chains = shared.groupBy(F.col("conv_id").alias("chain")).agg(
        F.min(F.struct("depth", "parent_conv_id")).alias("top"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
    )
    at = (F.col("top.depth") - 1).alias("at")
    totals = _chain_totals(chains.select("chain", F.col("top.parent_conv_id").alias("parent"), at, "leaves", "saved"))
    below = totals.where("parent IS NOT NULL").groupBy(F.col("parent").alias("conv_id"), F.col("at").alias("depth")).agg(
        F.sum("leaves").alias("below_leaves"), F.sum("saved").alias("below_saved")
    )
    own = shared.join(below, ["conv_id", "depth"], "left")
    own = own.withColumn("own_leaves", F.col("leaves") + F.coalesce("below_leaves", F.lit(0)))
    own = own.withColumn("own_saved", F.col("saved") + F.coalesce("below_saved", F.lit(0)))
    own = own.select("conv_id", "depth", "a", "b", "parent_conv_id", "n_convs", "n_children", "own_leaves", "own_saved")
    return running(own, "conv_id", [F.col("depth").desc()], {"n_leaves": "own_leaves", "saved_tokens": "own_saved"})


def opened(conversations: DataFrame) -> DataFrame:
    """The conversations with the openings of their hundreds' first ones: crc32 of the id as text, modulo 6, turns."""
    own = turns(conversations)
    return rebuilt(own, F.crc32(F.col("conv_id").cast("string")) % 6, F.col("conv_id") - F.col("conv_id") % 100)


ORACLE_SQL = """
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), own AS (
    SELECT conv_id, list({'role': role, 'text': text} ORDER BY pos) AS items,
           xor(4294967295, list_reduce(
               list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
               lambda crc, c: list_reduce(list_prepend(xor(crc, c), range(8)),
                   lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END))) % 6 AS h
    FROM turns GROUP BY conv_id
), whole AS (
    SELECT o.conv_id, list_concat(coalesce(b.items[1:o.h], []), o.items[o.h + 1:]) AS items
    FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100
), prefixes AS (
    SELECT conv_id, d AS depth, items[1:d] AS key, items[1:d - 1] AS parent_key, d = len(items) AS ended,
           coalesce(length(items[d].text), 0) AS chars
    FROM (SELECT conv_id, items, unnest(range(len(items) + 1)) AS d FROM whole)
), nodes AS (
    SELECT key, depth, min(conv_id) AS conv_id, any_value(parent_key) AS parent_key, count(*) AS n_convs,
           (count(*) - 1) * any_value(chars) AS saved,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ended), '')) AS ends_sha256
    FROM prefixes GROUP BY key, depth
), linked AS (
    SELECT n.*, p.conv_id AS parent_conv_id,
           (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.parent_key = n.key) AS n_children
    FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.key = n.parent_key
), sums AS (
    SELECT a.key, a.depth, sum((u.n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum(u.saved)::BIGINT AS saved_tokens
    FROM linked u JOIN prefixes a ON a.conv_id = u.conv_id AND a.depth <= u.depth GROUP BY a.key, a.depth
)
SELECT n.conv_id, n.depth::BIGINT AS depth, n.parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM linked n JOIN sums s ON s.depth = n.depth AND s.key = n.key
"""
