"""Token counts by a linear longest-match automaton.

Greedy longest-match word pieces are counted without building them. The vocabulary's opening pieces (of a
word's start) and inner pieces stand in one trie with two roots. Every node has a failure link: the node
that the automaton is in after it has popped the pieces which the longest match would cut off first, and the
number of these pieces, found in advance. A byte then costs one edge, or a popped count and a link for each
one missing; no byte is read twice. A word that ends between pieces, or has a character that no piece has,
is one unknown token.

Words are `[^\\x20\\x09-\\x0D]+`. Equal words of a block are counted once; the automaton walks all its
distinct words together, byte by byte.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.llm import blocks
from loanlens.llm.vocabulary import DEFAULT_MODEL, Trie, load

_ROOM = 2 << 20
DEAD = -1


@dataclass
class Automaton:
    edges: Trie
    fail: np.ndarray  # state after popping, DEAD if there is none
    popped: np.ndarray  # pieces popped on the way
    inner: int  # the root of the inner pieces, where a word may end


def automaton(opening: list[bytes], inner: list[bytes]) -> Automaton:
    """Failure links and popped counts for pieces that open a word and pieces inside one."""
    children: list[dict[int, int]] = [{}, {}]  # 0: start of a word, 1: after a piece
    final = [False, False]
    for root, pieces in ((0, opening), (1, inner)):
        for piece in pieces:
            state = root
            for byte in piece:
                if byte not in children[state]:
                    children[state][byte] = len(children)
                    children.append({})
                    final.append(False)
                state = children[state][byte]
            final[state] = final[state] or state > 1
    fail, popped = [DEAD] * len(children), [0] * len(children)
    waiting = deque([0, 1])
    while waiting:
        parent = waiting.popleft()
        for byte, state in children[parent].items():
            if final[state]:
                fail[state], popped[state] = 1, 1
            else:
                link, count = fail[parent], popped[parent]
                while link != DEAD and byte not in children[link]:
                    count += popped[link]
                    link = fail[link]
                if link != DEAD:
                    fail[state], popped[state] = children[link][byte], count
            waiting.append(state)
    pairs = sorted((s * 256 + b, t) for s, own in enumerate(children) for b, t in own.items())
    keys, to = np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64)
    edges = Trie(keys, to, np.zeros(0, np.int64), np.zeros(0, np.int64))
    return Automaton(edges, np.array(fail, np.int64), np.array(popped, np.int64), 1)


def count_words(machine: Automaton, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Pieces of each word (a span of `data`), 0 for a word that can't be cut into pieces."""
    size = ends - starts
    out = np.zeros(len(starts), np.int64)
    order = np.argsort(-size, kind="stable")
    state, tokens = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    alive = order
    falling = size[order]
    for t in range(int(size.max()) if len(size) else 0):
        # Longest first, so the words that still have a byte at t are a front part.
        alive = alive[: np.searchsorted(-falling, -t, side="left")]
        falling = falling[: len(alive)]
        byte = data[starts[alive] + t].astype(np.int64)
        todo = np.flatnonzero(state[alive] != DEAD)
        while len(todo):
            words = alive[todo]
            after = machine.edges.step(state[words], byte[todo])
            moved = after >= 0
            state[words[moved]] = after[moved]
            stuck = words[~moved]
            tokens[stuck] += machine.popped[state[stuck]]
            state[stuck] = machine.fail[state[stuck]]
            todo = todo[~moved][state[stuck] != DEAD]
    # A word ends where only whole pieces are left.
    left = np.flatnonzero((state != DEAD) & (state != machine.inner))
    while len(left):
        tokens[left] += machine.popped[state[left]]
        state[left] = machine.fail[state[left]]
        left = left[(state[left] != DEAD) & (state[left] != machine.inner)]
    done = state == machine.inner
    out[done] = tokens[done]
    return out


def from_model(path: str = DEFAULT_MODEL) -> Automaton:
    """Pieces that begin with a space open a word, the others stand inside one."""
    pieces = [p for p in load(path).pieces if p]
    opening = [p[1:] for p in pieces if p[:1] == b" " and len(p) > 1 and b" " not in p[1:]]
    return automaton(opening, [p for p in pieces if b" " not in p])


def count_tokens(docs: DataFrame, model_path: str = DEFAULT_MODEL) -> DataFrame:
    """doc_id, n_words, n_unknown and n_tokens of each row of docs (doc_id, text); whole texts.

    n_tokens has the pieces of all words, an unknown word counting one. A null or empty text, and one
    without words, has zeros; repeated rows each give a row.
    """
    spark = docs.sparkSession
    blocks.arrow_batches(spark)
    shared = spark.sparkContext.broadcast(from_model(model_path))

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks.merged(frames, _ROOM):
            for part, data, offsets in blocks.rows_per_batch(iter([batch]), _ROOM):
                starts, ends, rows = blocks.words(data, offsets)
                hashes = blocks.span_hash(blocks.prefix_hash(data), starts, ends)
                _, first, same = np.unique(hashes, return_index=True, return_inverse=True)
                tokens = count_words(shared.value, data, starts[first], ends[first])[same]
                n = part.num_rows
                counts = [np.bincount(rows, minlength=n), np.bincount(rows[tokens == 0], minlength=n),
                          np.bincount(rows, weights=np.maximum(tokens, 1), minlength=n)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[pa.array(c.astype(np.int64)) for c in counts]],
                    names=["doc_id", "n_words", "n_unknown", "n_tokens"],
                )

    schema = "doc_id long, n_words long, n_unknown long, n_tokens long"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
