"""Token counts by rank-synchronous array merging.

A byte-pair encoder merges, again and again, the neighbours whose joined piece has the lowest
rank. Here the pre-tokens of many documents lie one after the other in one ragged array, and in
each round every pre-token merges its own lowest-ranked pair, all places at once. What is left
is counted. Nothing is shuffled: a document's count needs its text and the model only.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosemill.llm import frames
from prosemill.llm.pieces import BLANK, BPE, NORMAL, read_model

#: A task remembers the counts of so many pre-tokens, then starts anew (memory, not results).
REMEMBERED = 300_000
#: Words merged together, which bounds the arrays of a round.
BLOCK = 20_000
#: Pre-tokens: a line feed, or blanks with what follows up to the next blank or line feed.
PRE_TOKEN = re.compile(f"\n|[ {BLANK}]*[^ {BLANK}\n]+|[ {BLANK}]+")
NEVER = np.int32(2**31 - 1)


class Merger:
    """The merge table of a model, and counting with it."""

    def __init__(self, data: bytes):
        model = read_model(data)
        if model.model_kind != BPE:
            raise ValueError("Merging needs a BPE model.")
        if model.char_map or model.trims_blanks:
            raise ValueError("This model rewrites characters or trims blanks: see `piece_codec`.")
        self.dummy_prefix = model.dummy_prefix
        normal = [i for i, kind in enumerate(model.kinds) if kind == NORMAL]
        symbols = {model.pieces[i]: n for n, i in enumerate(normal)}
        known = len(symbols)
        for piece in list(symbols):
            for char in piece:
                symbols.setdefault(char, len(symbols))
        if any("\n" in piece or BLANK in piece.lstrip(BLANK) for piece in symbols):
            raise ValueError("A piece crosses the pre-tokens' borders.")
        by_score = sorted({model.scores[i] for i in normal}, reverse=True)
        rank_of = {score: n for n, score in enumerate(by_score)}
        #: Symbols from here on are characters that no piece holds.
        self.strange = len(symbols)
        self.width = self.strange + 1
        rows = []
        for i in normal:
            piece, rank = model.pieces[i], rank_of[model.scores[i]]
            for cut in range(1, len(piece)):
                left, right = symbols.get(piece[:cut]), symbols.get(piece[cut:])
                if left is not None and right is not None:
                    rows.append((left * self.width + right, rank, symbols[piece]))
        table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 3)
        self.keys, self.ranks, self.merged = table[:, 0], table[:, 1].astype(np.int32), table[:, 2]
        chars = sorted((ord(s), n) for s, n in symbols.items() if len(s) == 1)
        self.chars = np.array([c for c, _ in chars], dtype=np.uint32)
        self.char_symbols = np.array([n for _, n in chars], dtype=np.int64)
        self.known = known
        self.byte_fallback = model.byte_fallback

    def _ranked(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair, NEVER if it does not merge, and its place in the table."""
        keys = left * self.width + right
        if not len(self.keys):
            return np.full(len(keys), NEVER), np.zeros(len(keys), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], NEVER), at

    def counts(self, words: list[str]) -> np.ndarray:
        """Tokens of each word, merged on its own; no word may be empty."""
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        at = np.minimum(np.searchsorted(self.chars, codes), len(self.chars) - 1)
        symbols = np.where(self.chars[at] == codes, self.char_symbols[at], self.strange)
        # a character without a piece of its own falls back to its bytes
        size = 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)
        cost = size if self.byte_fallback else np.ones(len(codes), dtype=np.int64)
        owner = np.repeat(np.arange(len(words)), lengths)
        totals = np.zeros(len(words), dtype=np.int64)
        while len(symbols):
            symbols, cost, owner = self._round(symbols, cost, owner, totals)
        return totals

    def _round(self, symbols, cost, owner, totals):
        """One merge round. Words with nothing left to merge are counted and leave."""
        same = owner[:-1] == owner[1:]
        rank, at = self._ranked(symbols[:-1], symbols[1:])
        rank = np.append(np.where(same, rank, NEVER), NEVER)
        starts = np.flatnonzero(np.append(True, ~same))
        lowest = np.minimum.reduceat(rank, starts)
        live = np.repeat(lowest < NEVER, np.diff(np.append(starts, len(symbols))))
        if not live.all():
            done = ~live
            plain = np.where(symbols[done] < self.known, 1, cost[done])
            np.add.at(totals, owner[done], plain)
            symbols, cost, owner, rank = symbols[live], cost[live], owner[live], rank[live]
            at = np.append(at, 0)[live]
            if not len(symbols):
                return symbols, cost, owner
            starts = np.flatnonzero(np.append(True, owner[:-1] != owner[1:]))
            lowest = lowest[lowest < NEVER]
        else:
            at = np.append(at, 0)
        sizes = np.diff(np.append(starts, len(symbols)))
        best = np.repeat(lowest, sizes)
        hit = _alternate(rank == best)
        # merges that open a pair of the same or a lower rank must be made one by one
        group = np.repeat(np.arange(len(starts)), sizes)
        many = np.bincount(group[hit], minlength=len(starts)) > 1
        if many.any():
            wary = self._opens(symbols, owner, at, hit, best)
            slow = np.zeros(len(starts), dtype=bool)
            slow[group[wary]] = True
            slow &= many
            if slow.any():
                places = np.flatnonzero(hit & slow[group])
                first = np.append(True, group[places[1:]] != group[places[:-1]])
                hit[places[~first]] = False
        places = np.flatnonzero(hit)
        symbols = symbols.copy()
        symbols[places] = self.merged[at[places]]
        keep = np.ones(len(symbols), dtype=bool)
        keep[places + 1] = False
        return symbols[keep], cost[keep], owner[keep]

    def _opens(self, symbols, owner, at, hit, best) -> np.ndarray:
        """Places of merges after which a pair of the same or a lower rank stands beside them."""
        places = np.flatnonzero(hit)
        made = symbols.copy()
        made[places] = self.merged[at[places]]
        last = len(symbols) - 1
        found = np.zeros(len(places), dtype=bool)
        ranks = best[places]
        # the right neighbour before it merges itself, and after
        right = np.minimum(places + 2, last)
        inside = (places + 2 <= last) & (owner[right] == owner[places])
        for side in (symbols[right], made[right]):
            rank, _ = self._ranked(made[places], side)
            found |= inside & (rank <= ranks)
        # the left neighbour, which is the merged symbol two places before if that one merged
        left = np.maximum(places - 1, 0)
        inside = (places > 0) & (owner[left] == owner[places])
        merged_left = (places > 1) & hit[np.maximum(places - 2, 0)]
        side = np.where(merged_left, made[np.maximum(places - 2, 0)], symbols[left])
        rank, _ = self._ranked(side, made[places])
        found |= inside & (rank <= ranks)
        return places[found]


def _alternate(mask: np.ndarray) -> np.ndarray:
    """Of each run of true values the first, third, fifth and so on: pairs that do not overlap."""
    index = np.arange(len(mask))
    start = np.maximum.accumulate(np.where(mask, -1, index))
    return mask & ((index - start) % 2 == 1)


@lru_cache(maxsize=2)
def merger(data: bytes) -> tuple[Merger, dict[str, int]]:
    """The table of a model and what is remembered with it, once in a worker."""
    return Merger(data), {}


def count_texts(data: bytes, batch: list[str]) -> list[int]:
    """Tokens of each text."""
    table, remembered = merger(data)
    prefix = " " if table.dummy_prefix else ""
    split = [PRE_TOKEN.findall(prefix + text) if text else [] for text in batch]
    missing = list(set().union(*split).difference(remembered))
    if len(remembered) + len(missing) > REMEMBERED:
        remembered.clear()
        missing = list(set().union(*split))
    # bounded pieces of work, so that one round's arrays stay small
    for start in range(0, len(missing), BLOCK):
        words = missing[start : start + BLOCK]
        counts = table.counts([w.replace(" ", BLANK) for w in words])
        remembered.update(zip(words, counts.tolist(), strict=True))
    return [sum(map(remembered.__getitem__, words)) for words in split]


def token_counts(df: DataFrame, model: bytes, limit: int = 4096) -> DataFrame:
    """Per row: UTF-8 bytes, tokens, and whether they are more than `limit`.

    A null text counts as empty and has no tokens; repeated rows are counted each; other
    columns are left out, so clashing names do no harm; an empty table gives an empty one.
    The model (under a few MB, a fixed file) is sent to every executor once.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)

    def prepare() -> Callable[[list[str]], list]:
        return lambda batch: [[len(t.encode()) for t in batch], count_texts(sent.value, batch)]

    counted = frames.map_texts(frames.texts(df), "n_bytes bigint, n_tokens bigint", prepare)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
