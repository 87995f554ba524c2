"""Terms of texts of tokens, one blank between two, numbered and counted within runs of rows of an Arrow batch."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A run of rows holds texts of about so many bytes, a longer text stands alone, and no more than so many
# rows: keys of a pair of words and a row fit 64 bits then.
RUN_BYTES = 4 << 20
RUN_ROWS = 1 << 16


def term_key(words, listed: int):
    """The key of a term of one or two words out of `listed`, by their numbers."""
    return words[0] if len(words) == 1 else (words[0] + 1) * listed + words[1]


@dataclass(frozen=True)
class Tokens:
    """Tokens in text order: the row of each one and its word's number, -1 for words not looked for."""

    rows: np.ndarray
    words: np.ndarray

    def then(self, other: Tokens) -> Tokens:
        """In each row these tokens, then the other ones."""
        rows = np.concatenate([self.rows, other.rows])
        order = np.argsort(rows, kind="stable")
        return Tokens(rows[order], np.concatenate([self.words, other.words])[order])

    def terms(self, listed: int, longest: int, shortest: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """Row and key of every term of so many tokens, out of `listed` words."""
        rows, keys = [], []
        if shortest == 1:
            known = self.words >= 0
            rows.append(self.rows[known])
            keys.append(self.words[known])
        if longest > 1:
            both = (self.rows[1:] == self.rows[:-1]) & (self.words[1:] >= 0) & (self.words[:-1] >= 0)
            rows.append(self.rows[1:][both])
            keys.append(term_key((self.words[:-1][both], self.words[1:][both]), listed))
        return np.concatenate(rows), np.concatenate(keys)


def runs(batch: pa.RecordBatch, columns: list[str]) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts in these columns hold about RUN_BYTES together."""
    lengths = [pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False) for name in columns]
    total = np.cumsum(np.sum(lengths, axis=0, dtype=np.int64))
    start = 0
    while start < batch.num_rows:
        before = total[start - 1] if start else 0
        stop = max(start + 1, min(start + RUN_ROWS, int(np.searchsorted(total, before + RUN_BYTES, "right"))))
        yield batch.slice(start, stop - start)
        start = stop


def numbered(run: pa.RecordBatch, columns: list[str], known: pa.Array | None = None) -> tuple[list[Tokens], pa.Array]:
    """Tokens of each column, and the words in the order of their numbers: the known ones, or all.

    A null text has no tokens; an empty one must not come.
    """
    lists = [pc.split_pattern(run.column(name), " ") for name in columns]
    flat = [each.flatten() for each in lists]
    coded = pa.concat_arrays(flat).dictionary_encode()
    words = coded.indices.to_numpy().astype(np.int64)
    if known is not None:
        at = pc.index_in(coded.dictionary, value_set=known).fill_null(-1).to_numpy(zero_copy_only=False)
        words = at.astype(np.int64)[words]
    found, start = [], 0
    for each, values in zip(lists, flat, strict=True):
        lengths = pc.fill_null(pc.list_value_length(each), 0).to_numpy(zero_copy_only=False)
        found.append(Tokens(np.repeat(np.arange(len(each)), lengths), words[start : start + len(values)]))
        start += len(values)
    return found, coded.dictionary if known is None else known


def counted(rows: np.ndarray, keys: np.ndarray, height: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of `height` rows, the distinct keys in order, the number of rows with each, and of occurrences."""
    if not len(keys):
        return keys, keys, keys
    cells = np.sort(keys * height + rows)
    ordered = cells // height
    starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    new = np.append(True, cells[1:] != cells[:-1])
    return ordered[starts], np.add.reduceat(new, starts, dtype=np.int64), np.diff(starts, append=len(cells))


def side_by_side(counts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The keys of several results of `counted` in order, and each result's two numbers of every key."""
    keys, found = np.unique(np.concatenate([each[0] for each in counts])), []
    for own, *numbers in counts:
        at = np.searchsorted(keys, own)
        for values in numbers:
            found.append(np.zeros(len(keys), dtype=np.int64))
            found[-1][at] = values
    return keys, found


def spelled(keys: np.ndarray, words: pa.Array) -> pa.Array:
    """The terms of some keys in order, pairs with a blank between their words."""
    listed = len(words)
    single, pairs = keys[keys < listed], keys[keys >= listed]
    if not len(pairs):
        return words.take(pa.array(single))
    first, second = words.take(pa.array(pairs // listed - 1)), words.take(pa.array(pairs % listed))
    return pa.concat_arrays([words.take(pa.array(single)), pc.binary_join_element_wise(first, second, " ")])


@dataclass(frozen=True)
class Listed:
    """A vocabulary by the numbers of its words: keys of terms in order, their positions, from 0 on, the
    idf by position, or None for counts alone, and the longest term in tokens."""

    keys: np.ndarray
    positions: np.ndarray
    idf: np.ndarray | None
    longest: int

    def entries(self, tokens: Tokens, listed: int, height: int) -> tuple[pa.ListArray, pa.ListArray]:
        """Positions and weights of the known terms of each row, by position."""
        rows, keys = tokens.terms(listed, self.longest)
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        hit = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), dtype=bool)
        width = max(len(self.keys), 1)
        cells = np.sort(rows[hit] * width + self.positions[at[hit]])
        starts = np.flatnonzero(np.append(True, cells[1:] != cells[:-1])[: len(cells)])
        rows, positions = cells[starts] // width, cells[starts] % width
        weights = np.diff(starts, append=len(cells)).astype(np.float64)
        if self.idf is not None:
            weights = weights * self.idf[positions]
            # Added up one after the other in the order of the positions.
            weights = weights / np.sqrt(np.bincount(rows, weights * weights, minlength=height))[rows]
        ends = pa.array(np.searchsorted(rows, np.arange(height + 1)).astype(np.int32))
        return (
            pa.ListArray.from_arrays(ends, pa.array(positions.astype(np.int32))),
            pa.ListArray.from_arrays(ends, pa.array(weights)),
        )
