"""SentencePiece encoding and decoding as shortest paths through a weighted transducer.

Four machines are compiled from a model file and composed with each input on the fly:

* the normaliser (see `normaliser`) rewrites characters by the model's table, and writes a blank mark
  before the text and for each blank;
* the piece machine (a trie with outputs) reads characters and writes piece ids;
* the byte machine stands in it for every character without a piece of its own: its one arc reads
  the character, costs more than any piece, and writes the ids of the character's bytes (or the
  unknown id, once for a run of such characters, if the model has no byte pieces);
* the pair acceptor weighs neighbouring pieces. For a unigram model each piece costs its negative
  score and pairs are free. For a byte-pair model a pair is free if merging the two pieces' joined
  text gives just these two back, and costs infinity if not.

The path of least weight in the tropical semiring (weights add along a path, the smaller of two
paths counts) is the encoding. For a byte-pair model this is exact: merges inside two neighbouring
tokens happen in the same order with or without the rest of the text, so all neighbours of the
true encoding are free pairs; and the first merge across a border of any other path would also
happen between its two pieces alone, so another path holds an infinite pair. Hence at most one
path of finite weight reaches each position, and one state per position is enough.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from prosemill.llm import frames
from prosemill.llm.normaliser import Normaliser
from prosemill.llm.pieces import BLANK, BPE, BYTE, NORMAL, UNIGRAM, read_model

#: A worker remembers the paths of pre-tokens in so many bytes, and so many pairs (memory, not results).
REMEMBERED_BYTES, REMEMBERED_PAIRS = 96 << 20, 300_000
#: Texts of about so many bytes are cut into parts together: a part takes many times its own bytes.
TOGETHER_BYTES = 1 << 20
#: A character without a piece costs this much more than the worst piece (a fixed value of the format).
STRANGE_COST = 10.0
INFINITY = float("inf")


class Transducer:
    """The composed machine of one model."""

    def __init__(self, data: bytes):
        model = read_model(data)
        if model.model_kind not in (UNIGRAM, BPE):
            raise ValueError("Only unigram and byte-pair models are piece machines.")
        self.model = model
        self.normaliser = Normaliser(model.char_map, model.trims_blanks)
        self.bpe = model.model_kind == BPE
        normal = [i for i, kind in enumerate(model.kinds) if kind == NORMAL]
        self.ids = {model.pieces[i]: i for i in normal}
        self.byte_ids = {}
        if model.byte_fallback:
            bytes_in_order = [i for i, kind in enumerate(model.kinds) if kind == BYTE]
            self.byte_ids = dict(enumerate(bytes_in_order))
        pack = struct.Struct("<i").pack
        self.packed = {piece: pack(i) for piece, i in self.ids.items()}
        self.packed_bytes = {byte: pack(i) for byte, i in self.byte_ids.items()}
        self.packed_unknown = pack(model.unknown)
        self.cost = {model.pieces[i]: -model.scores[i] for i in normal}
        self.strange = max(self.cost.values(), default=0.0) + STRANGE_COST
        # the trie: a dict per state; the output of a state is kept under the empty string
        self.trie: dict = {}
        for piece in self.ids:
            if self.bpe and len(piece) > 1 and self._merge(piece) != [piece]:
                continue  # merging never builds it
            state = self.trie
            for char in piece:
                state = state.setdefault(char, {})
            state[""] = piece
        crossed = any(BLANK in piece.lstrip(BLANK) for piece in self.ids) if self.ids else False
        lines = any("\n" in piece for piece in self.ids)
        #: Paths never cross these borders, so parts between them are solved alone and remembered.
        self.parts = re.compile(
            ".+" if crossed else f"{BLANK}*[^{BLANK}]+|{BLANK}+" if lines
            else f"\n|{BLANK}*[^{BLANK}\n]+|{BLANK}+", re.S)
        byte_of = {i: bytes([b]) for b, i in self.byte_ids.items()}
        self.shown = [
            byte_of.get(i, piece.replace(BLANK, " ").encode() if kind == NORMAL else b"")
            for i, (piece, kind) in enumerate(zip(model.pieces, model.kinds, strict=True))
        ]
        self.pairs: dict[tuple[str, str], bool] = {}
        self.remembered = frames.Remembered(REMEMBERED_BYTES)

    def forget(self) -> None:
        """Give up what was remembered of texts; the machine itself stays."""
        self.pairs = {}
        self.remembered = frames.Remembered(REMEMBERED_BYTES)

    def normal_form(self, text: str) -> str:
        """The output of the normaliser."""
        marked = self.normaliser.run(text).replace(" ", BLANK)
        return BLANK + marked if marked and self.model.dummy_prefix else marked

    def _merge(self, text: str) -> list[str]:
        """The byte-pair encoding of a short text, by its definition: best score first, then leftmost."""
        symbols = list(text)
        while True:
            best, place = INFINITY, -1
            for i in range(len(symbols) - 1):
                cost = self.cost.get(symbols[i] + symbols[i + 1], INFINITY)
                if cost < best:
                    best, place = cost, i
            if place < 0:
                return symbols
            symbols[place : place + 2] = [symbols[place] + symbols[place + 1]]

    def _free(self, left: str, right: str) -> bool:
        """Whether the pair acceptor lets two pieces stand side by side."""
        pair = (left, right)
        free = self.pairs.get(pair)
        if free is None:
            if len(self.pairs) >= REMEMBERED_PAIRS:
                self.pairs.clear()
            free = self.pairs[pair] = self._merge(left + right) == [left, right]
        return free

    def path(self, part: str) -> list[str]:
        """Pieces on the shortest path through one part."""
        return self._free_path(part) if self.bpe else self._cheapest_path(part)

    def _arcs(self, part: str, i: int) -> list[tuple[int, int, str]]:
        """Arcs that leave a position: the single character, then the pieces from short to long."""
        state = self.trie.get(part[i])
        arcs = [(i, i + 1, part[i])] if state is None or "" not in state else []
        j, n = i + 1, len(part)
        while state is not None:
            piece = state.get("")
            if piece is not None:
                arcs.append((i, j, piece))
            if j == n:
                break
            state = state.get(part[j])
            j += 1
        return arcs

    def _cheapest_path(self, part: str) -> list[str]:
        """Shortest path with free pairs: positions in order, the best arc into each."""
        n, cost, strange = len(part), self.cost, self.strange
        weight, back = [0.0] + [INFINITY] * n, [0] * (n + 1)
        for i in range(n):
            for _, j, piece in self._arcs(part, i):
                total = weight[i] + cost.get(piece, strange)
                if total < weight[j]:
                    weight[j], back[j] = total, i
        pieces = []
        while n:
            pieces.append(part[back[n] : n])
            n = back[n]
        return pieces[::-1]

    def _free_path(self, part: str) -> list[str]:
        """Shortest path if weights are zero or infinite: the first path to arrive is shortest, so
        long arcs are tried first. Only one free path leads to each position, so a position that
        has been reached needs no second visit."""
        n, trie, pairs, free_pair = len(part), self.trie, self.pairs, self._free
        last: list[str | None] = [None] * (n + 1)
        back = [0] * (n + 1)
        waiting = []
        i = 0
        while i < n:
            j = i + 1
            state = trie.get(part[i])
            ends = [(j, part[i])] if state is None or "" not in state else []
            while state is not None:
                if "" in state:
                    ends.append((j, state[""]))
                if j == n:
                    break
                state = state.get(part[j])
                j += 1
            waiting.append((i, last[i], ends))
            while True:
                start, before, ends = waiting[-1]
                if not ends:
                    waiting.pop()
                    continue
                end, piece = ends.pop()
                if last[end] is None:
                    if before is None:
                        break
                    free = pairs.get((before, piece))
                    if free or free is None and free_pair(before, piece):
                        break
            last[end], back[end], i = piece, start, end
        pieces = []
        while n:
            pieces.append(last[n])
            n = back[n]
        return pieces[::-1]

    def _written(self, char: str) -> bytes | None:
        """What the byte machine writes for a character; None is the unknown id."""
        if not self.byte_ids:
            return None
        return b"".join(self.packed_bytes[byte] for byte in char.encode())

    def part_ids(self, part: str) -> bytes:
        """Ids of one part as 32-bit numbers: what its shortest path writes."""
        packed, ids = [], self.packed
        unknown = False
        for piece in self.path(part):
            found = ids[piece] if piece in ids else self._written(piece)
            if found is not None:
                packed.append(found)
            elif not unknown:
                packed.append(self.packed_unknown)
            unknown = found is None
        return b"".join(packed)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        split = [self.parts.findall(self.normal_form(text)) for text in texts]
        known, missing = self.remembered.of(set().union(*split))
        new = {part: self.part_ids(part) for part in missing}
        self.remembered.add(new)
        known.update(new)
        return [np.frombuffer(b"".join(map(known.__getitem__, s)), dtype=np.int32) for s in split]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: pieces with marks as blanks, runs of bytes as UTF-8, no blank of the
        normaliser's own at the beginning."""
        shown = list(map(self.shown.__getitem__, ids.tolist()))
        if self.model.dummy_prefix or self.model.trims_blanks:
            for i, piece in enumerate(shown):
                shown[i] = piece.removeprefix(b" ")
                if shown[i] or not self.model.trims_blanks:
                    break
        return b"".join(shown).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def machine(data: bytes) -> Transducer:
    """The machine of a model, once in a worker."""
    return Transducer(data)


def encode_pieces(df: DataFrame, model: bytes, *more: str) -> DataFrame:
    """Per row the piece ids of its text, as `ids`; a null text counts as empty and has none.

    Repeated rows are encoded each; of other columns those named in `more` stay; an empty table
    gives an empty one.
    Texts of any length are encoded whole, part by part. The model is a fixed small file and is
    sent to every executor once.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)

    def prepare() -> Callable[[list[str]], list]:
        return lambda batch: [machine(sent.value).encode(batch)]

    return frames.map_texts(
        frames.texts(df, *more), "ids array<int>", prepare, TOGETHER_BYTES, finish=lambda: machine(sent.value).forget()
    )


def decode_pieces(df: DataFrame, model: bytes) -> DataFrame:
    """Per row the text of `ids`; null ids give a null text."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            shown = [
                None if ids is None else machine(sent.value).decode(np.array(ids, dtype=np.int64))
                for ids in batch.column("ids").to_pylist()
            ]
            yield frames.pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), frames.pa.array(shown, type=frames.pa.string())], names=["doc_id", "text"]
            )

    kept = df.select("doc_id", "ids")
    return kept.mapInArrow(run, frames.T.StructType([kept.schema["doc_id"], frames.T.StructField("text", frames.T.StringType())]))


def round_trip(df: DataFrame, model: bytes) -> DataFrame:
    """Per row: number of pieces, crc32 of their ids as little-endian 32-bit numbers, and whether
    decoding them gives the text back (a blank mark in a text comes back as a blank, so it does not)."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def prepare() -> Callable[[list[str]], list]:
        def work(batch: list[str]) -> list:
            codec = machine(sent.value)
            ids = codec.encode(batch)
            return [
                [len(x) for x in ids],
                [zlib.crc32(x.tobytes()) for x in ids],
                [codec.decode(x) == text for x, text in zip(ids, batch, strict=True)],
            ]

        return work

    return frames.map_texts(frames.texts(df), "n_pieces bigint, ids_crc32 bigint, restored boolean", prepare, TOGETHER_BYTES)
