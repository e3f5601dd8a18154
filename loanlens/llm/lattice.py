"""SentencePiece encoding by sampling from the piece lattice, and lossless decoding.

A text's bytes are the nodes' places, every piece of the vocabulary that matches is an edge, and a character
that is no piece itself has its bytes' fallback pieces as edges. Forward filtering sums the weights of all
ways to each node; backward sampling then draws, from the end, one incoming edge after the other in
proportion to what it brings: an exact draw from all segmentations. A piece weighs 1 / (1 + rank) to the
power `sharpness`, with the rank that the model's score states (bytes rank last).

No piece reaches over a line feed or from a non-space to a space, so a text falls into segments whose
lattices are independent; equal segments of a block share one lattice, in which each draws for itself.
A stretch without such places, however long, is one segment: filtering goes through it place by place.

Draws come from a hash of seed, row key and place in the text: the same key and text give the same pieces
in any batch, partition or run. Spaces are kept one by one and the mark U+2581 itself becomes bytes, so
decoding gives the text back byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.llm import blocks
from loanlens.llm.vocabulary import DEFAULT_MODEL, Trie, Vocabulary, load, trie

SHARPNESS = 1.0
# Bytes of text taken together: more would share more segments, at some 150 bytes of memory each.
_ROOM = 1 << 19


@dataclass
class Lattice:
    pieces: Trie
    log_weight: np.ndarray
    byte_ids: np.ndarray
    texts: np.ndarray  # all pieces' bytes, one after the other
    begins: np.ndarray
    lengths: np.ndarray


def lattice(vocabulary: Vocabulary, sharpness: float = SHARPNESS) -> Lattice:
    ranks = np.where(np.array([p is not None for p in vocabulary.pieces]), -vocabulary.scores, len(vocabulary.pieces))
    written = [p or b"" for p in vocabulary.pieces]
    for byte, i in enumerate(vocabulary.byte_ids):
        if i >= 0:
            written[i] = bytes([byte])
    lengths = np.array([len(p) for p in written], np.int64)
    begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    log_weight = -sharpness * np.log1p(np.maximum(ranks, 0.0))
    return Lattice(trie(vocabulary.pieces), log_weight, vocabulary.byte_ids, np.frombuffer(b"".join(written), np.uint8), begins, lengths)


def segments(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of the segments, and the end of the data."""
    n = len(data)
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    space, line = data == 0x20, data == 0x0A
    first[1:n] |= space[1:] & ~space[:-1]
    first[:n] |= line
    first[1:n] |= line[:-1]
    return np.flatnonzero(first)


def edges(model: Lattice, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(from, to, piece) of all edges; places are bytes of `data`, ends[i] is the end of the segment of byte i."""
    n = len(data)
    whole_char = (data & 0xC0) != 0x80
    begin = np.flatnonzero(whole_char)
    froms, tos, ids = [], [], []
    single = np.zeros(n, bool)  # characters that are pieces

    def take(start: np.ndarray, state: np.ndarray, length: int) -> None:
        piece = model.pieces.value[state]
        hit = piece >= 0
        froms.append(start[hit])
        tos.append(start[hit] + length)
        ids.append(piece[hit])
        after = start[hit] + length
        char_end = np.searchsorted(begin, start[hit], side="right")
        alone = np.where(char_end < len(begin), begin[np.minimum(char_end, len(begin) - 1)], n) == after
        single[start[hit][alone]] = True

    root = model.pieces.step(np.zeros(256, np.int64), np.arange(256))
    state = root[data[begin]]
    known = state >= 0
    start, state = begin[known], state[known]
    take(start, state, 1)
    length = 1
    while len(start):
        inside = start + length < ends[start]
        start, state = start[inside], state[inside]
        if length == 1:
            state = model.pieces.first_two[data[start].astype(np.int64) * 256 + data[start + 1]]
        else:
            state = model.pieces.step(state, data[start + length].astype(np.int64))
        known = state >= 0
        start, state = start[known], state[known]
        length += 1
        take(start, state, length)
    char = begin[np.searchsorted(begin, np.arange(n), side="right") - 1] if len(begin) else np.zeros(n, np.int64)
    bare = np.flatnonzero(~single[char])
    froms.append(bare)
    tos.append(bare + 1)
    ids.append(model.byte_ids[data[bare]])
    return tuple(np.concatenate(x).astype(np.int32) for x in (froms, tos, ids))


def sample(model: Lattice, data: np.ndarray, offsets: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all rows, one after the other, and how many each row has. keys: one uint64 per row."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int32), np.zeros(len(offsets) - 1, np.int64)
    starts = segments(data, offsets)
    hashes = blocks.span_hash(blocks.prefix_hash(data), starts[:-1], starts[1:])
    _, first, same = np.unique(hashes, return_index=True, return_inverse=True)
    del hashes
    # The distinct segments, one after the other; a place between two is the end of one and the start of the next.
    size = starts[1:][first] - starts[first]
    home = np.concatenate([[0], np.cumsum(size)])
    source = np.repeat(starts[first] - home[:-1], size) + np.arange(home[-1])
    own_bytes = data[source]
    n_own = len(own_bytes)
    seg_end = np.repeat(home[1:], size)
    begin, end, piece = edges(model, own_bytes, seg_end)
    # Edges in the order of how far into its segment each ends, then by end, the longest first.
    depth = (end - np.repeat(home[:-1], size)[begin]).astype(np.int64)
    longest = int(model.lengths.max()) + 1
    if int(depth.max()) < (1 << 62) // (longest * (n_own + 1)):
        key = (depth * (n_own + 1) + end) * longest + (longest - 1 - (end - begin))
        order = np.argsort(key)
        del key
    else:  # numbers that would not fit in one key: a text of some hundred megabytes without a space
        order = np.lexsort((begin, end, depth))
    begin, end, piece, depth = begin[order], end[order], piece[order], depth[order]
    del order, seg_end, source, own_bytes
    weight = model.log_weight[piece]
    at_start = np.zeros(n_own + 1, bool)
    at_start[home] = True
    lead = np.concatenate([[0], np.flatnonzero(end[1:] != end[:-1]) + 1, [len(end)]])
    counts = np.diff(lead)
    # Forward, one depth after the other: the weight of all ways to each place.
    total = np.full(n_own + 1, -np.inf)  # by end place; a segment's start counts as 0
    levels = np.flatnonzero(np.append(np.diff(depth[lead[:-1]]), 1)) + 1
    first = 0
    for last in levels.tolist():
        a, b = int(lead[first]), int(lead[last])
        came = np.where(at_start[begin[a:b]], 0.0, total[begin[a:b]]) + weight[a:b]
        group = lead[first:last] - a
        top = np.maximum.reduceat(came, group)
        summed = np.add.reduceat(np.exp(came - np.repeat(top, counts[first:last])), group)
        total[end[lead[first:last]]] = top + np.log(summed)
        first = last
    # Backward: the running share of each place's incoming edges.
    upto = np.cumsum(np.exp(np.where(at_start[begin], 0.0, total[begin]) + weight - total[end]))
    upto -= np.repeat(np.concatenate([[0.0], upto[lead[1:-1] - 1]]), counts)
    upto[lead[1:] - 1] = 2.0
    first_edge = np.zeros(n_own + 1, np.int32)
    first_edge[end[lead[:-1]]] = lead[:-1]
    del weight, depth, total
    chosen = np.zeros(n + 1, np.int32)
    row = np.searchsorted(offsets, starts[:-1], side="right") - 1
    node = home[same + 1]
    shift = starts[:-1] - home[same]  # from a place in the distinct segments to the block
    floor = home[same]
    seed = keys[row] - offsets[row].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    while len(node):
        here = node + shift
        noise = blocks.mix(seed + here.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        u = (noise >> np.uint64(11)).astype(np.float64) * 2.0**-53
        e = first_edge[node]
        past = np.flatnonzero(u >= upto[e])
        while len(past):
            e[past] += 1
            past = past[u[past] >= upto[e[past]]]
        chosen[here] = piece[e] + 1
        node = begin[e]
        going = node > floor
        node, shift, floor, seed = node[going], shift[going], floor[going], seed[going]
    places = np.flatnonzero(chosen)
    lengths = np.diff(np.searchsorted(places, offsets, side="right"))
    return chosen[places] - 1, lengths


def joined(model: Lattice, ids: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The texts of the rows' pieces."""
    sizes = model.lengths[ids]
    upto = np.concatenate([[0], np.cumsum(sizes)])
    source = np.repeat(model.begins[ids] - upto[:-1], sizes) + np.arange(upto[-1])
    offsets = upto[np.concatenate([[0], np.cumsum(lengths)])]
    data = model.texts[source]
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())]
    ).cast(pa.binary())


def _same(model: Lattice, ids: np.ndarray, lengths: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each row's pieces, decoded, are its bytes."""
    back = joined(model, ids, lengths)
    found, at = blocks.text_bytes(back)
    if not np.array_equal(at, offsets):
        whole = data.tobytes()
        return np.array([back[i].as_py() == whole[offsets[i] : offsets[i + 1]] for i in range(len(lengths))], bool)
    wrong = np.concatenate([[0], np.cumsum(found != data)])
    return wrong[offsets[1:]] == wrong[offsets[:-1]]


def encode(
    docs: DataFrame, model_path: str = DEFAULT_MODEL, seed: int = 0, carry: tuple[str, ...] = (), verify: bool = False
) -> DataFrame:
    """doc_id, the columns in `carry`, and ids (array of int): a sampled segmentation of each row's text.

    docs: doc_id (the row key; any number of rows may share one), text. A null text has null ids, an empty
    text none. Equal keys and texts give equal ids. With `verify`, the pieces are decoded on the spot and
    `lossless` says whether they gave the text back.
    """
    spark = docs.sparkSession
    blocks.arrow_batches(spark)
    shared = spark.sparkContext.broadcast(lattice(load(model_path)))
    key = F.xxhash64(F.col("doc_id").cast("string"), F.lit(seed))
    row_key, text = blocks.fresh(docs, "row_key", "read_text")
    source = docs.select("doc_id", *carry, key.alias(row_key), docs["text"].alias(text))

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in blocks.merged(frames, _ROOM, text):
            for part, data, offsets in blocks.rows_per_batch(iter([batch]), _ROOM, text):
                keys = part.column(row_key).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                ids, lengths = sample(model, data, offsets, keys)
                lists = blocks.list_column(ids, lengths, pa.int32())
                if part.column(text).null_count:
                    lists = pa.ListArray.from_arrays(lists.offsets, lists.values, mask=part.column(text).is_null())
                kept = [part.column(c) for c in ("doc_id", *carry)]
                names = ["doc_id", *carry, "ids"]
                if verify:
                    kept, lists, names = [*kept, lists], pa.array(_same(model, ids, lengths, data, offsets)), [*names, "lossless"]
                yield pa.RecordBatch.from_arrays([*kept, lists], names=names)

    kinds = f"{blocks.column_types(docs, ['doc_id', *carry])}, ids array<int>"
    return source.mapInArrow(run, f"{kinds}, lossless boolean" if verify else kinds)


def decode(encoded: DataFrame, model_path: str = DEFAULT_MODEL, keep_ids: bool = True) -> DataFrame:
    """`encoded` (any columns and ids) with the column decoded: the text of the ids; null ids give null."""
    spark = encoded.sparkSession
    blocks.arrow_batches(spark)
    shared = spark.sparkContext.broadcast(lattice(load(model_path)))
    names = [c for c in encoded.columns if keep_ids or c != "ids"]

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in frames:
            lists = batch.column("ids")
            filled = lists.fill_null([]) if lists.null_count else lists
            offsets = np.asarray(filled.offsets)
            ids = np.asarray(filled.values)[offsets[0] : offsets[-1]]
            texts = joined(model, ids, np.diff(offsets))
            if lists.null_count:
                texts = pa.array([None if gone else t for gone, t in zip(lists.is_null().to_pylist(), texts.to_pylist(), strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], texts.cast(pa.string())], names=[*names, "decoded"])

    return encoded.mapInArrow(run, f"{blocks.column_types(encoded, names)}, decoded string")
