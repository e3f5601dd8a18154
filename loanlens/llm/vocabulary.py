"""Piece vocabularies of public tokenizers as byte tries in flat arrays.

A model file is read on the driver, by its path; executors get its contents from Spark.
"""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path

import numpy as np

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"  # stands for a space in a piece


@dataclass
class Vocabulary:
    """Pieces as bytes by id (None: not a text piece), scores, and the id of each byte's fallback piece."""

    pieces: list[bytes | None]
    scores: np.ndarray
    byte_ids: np.ndarray


def model_bytes(path: str = DEFAULT_MODEL) -> bytes:
    return Path(path).read_bytes()


def load(path: str = DEFAULT_MODEL) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(path))
    size = model.get_piece_size()
    pieces: list[bytes | None] = []
    byte_ids = np.full(256, -1, np.int64)
    for i in range(size):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            pieces.append(None)
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            pieces.append(None)
        else:
            pieces.append(piece.replace(MARK, " ").encode())
    return Vocabulary(pieces, np.array([model.get_score(i) for i in range(size)]), byte_ids)


@dataclass
class Trie:
    """Edges as sorted keys state * 256 + byte with the state they lead to; state 0 is the root."""

    keys: np.ndarray
    to: np.ndarray
    value: np.ndarray  # per state: the piece's id, or -1
    first_two: np.ndarray  # state after two bytes from the root, -1 if there is none

    def step(self, states: np.ndarray, data: np.ndarray) -> np.ndarray:
        """The next state of each, -1 where no edge fits."""
        if not len(self.keys):
            return np.full(len(states), -1, np.int64)
        wanted = states * 256 + data
        at = np.searchsorted(self.keys, wanted)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == wanted, self.to[at], -1)


def trie(pieces: list[bytes | None]) -> Trie:
    children: dict[int, int] = {}
    value = [-1]
    for i, piece in enumerate(pieces):
        if not piece:
            continue
        state = 0
        for byte in piece:
            key = state * 256 + byte
            if key not in children:
                children[key] = len(value)
                value.append(-1)
            state = children[key]
        value[state] = i
    keys = np.array(sorted(children), np.int64)
    to = np.array([children[int(k)] for k in keys], np.int64)
    made = Trie(keys, to, np.array(value, np.int64), np.full(65536, -1, np.int64))
    pairs = np.arange(65536)
    one = made.step(np.zeros(65536, np.int64), pairs >> 8)
    known = one >= 0
    made.first_two[known] = made.step(one[known], pairs[known] & 255)
    return made
