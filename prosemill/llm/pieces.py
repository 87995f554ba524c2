"""Reading a SentencePiece model file: pieces, scores and the normaliser's flags."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

#: Fixed values of the public model format: piece kinds and model kinds.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2

#: The character that stands for a blank in pieces.
BLANK = "▁"


@dataclass(frozen=True)
class Model:
    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    model_kind: int
    byte_fallback: bool
    dummy_prefix: bool
    char_map: bytes
    trims_blanks: bool

    @property
    def unknown(self) -> int:
        return self.kinds.index(UNKNOWN)


def _number(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol buffer message."""
    at = 0
    while at < len(data):
        tag, at = _number(data, at)
        field, wire = tag >> 3, tag & 7
        if wire == 0:
            value, at = _number(data, at)
        else:
            if wire == 2:
                size, at = _number(data, at)
            else:
                size = {1: 8, 5: 4}[wire]
            value, at = data[at : at + size], at + size
        yield field, value


def read_model(data: bytes) -> Model:
    """Parse a model file. Models with own or unused pieces, with bare blanks or with the blank mark
    behind words are refused, since their texts would be encoded differently."""
    pieces, scores, kinds = [], [], []
    trainer: dict = {}
    rules: dict = {}
    for field, value in _fields(data):
        if field == 1:
            piece = dict(_fields(value))
            pieces.append(piece[1].decode())
            scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
            kinds.append(piece.get(3, NORMAL))
        elif field == 2:
            trainer = dict(_fields(value))
        elif field == 3:
            rules = dict(_fields(value))
    model = Model(
        pieces, scores, kinds, trainer.get(3, UNIGRAM), bool(trainer.get(35, 0)),
        bool(rules.get(3, 1)), rules.get(2, b""), bool(rules.get(4, 1)),
    )
    if {USER_DEFINED, UNUSED} & set(kinds) or not rules.get(5, 1) or trainer.get(24, 0):
        raise ValueError("This model has own or unused pieces, bare blanks or marks behind words.")
    return model
