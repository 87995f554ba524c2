"""A wavelet matrix over token ids, in one compressed byte string.

The ids are written over a dense alphabet of the shard, one bit per level from the highest bit
down; at each level the zeros move to the front in order. Ones are counted at every 64th bit, so
rank takes one lookup and one popcount, and select a binary search over ranks.
"""

from __future__ import annotations

import struct

import numpy as np
import zstandard

MAGIC = b"WVM1"
HEAD = struct.Struct("<4sQII")  # mark, tokens, size of the alphabet, levels


def _packed(raw: bytes) -> bytes:
    data = zstandard.ZstdCompressor(level=1).compress(raw)
    return struct.pack("<Q", len(data)) + data


class WaveletMatrix:
    def __init__(self, n: int, alphabet: np.ndarray, planes: list[np.ndarray]):
        """`planes` holds for each level the bits in order, 64 to a word, lowest bit first."""
        self.n, self.alphabet, self.planes = n, alphabet, planes
        self.before = [
            np.concatenate([[0], np.cumsum(np.bitwise_count(p), dtype=np.int64)]) for p in planes
        ]
        self.zeros = [n - int(b[-1]) for b in self.before]

    @classmethod
    def of(cls, tokens: np.ndarray) -> WaveletMatrix:
        present = np.zeros(int(tokens.max()) + 1 if len(tokens) else 0, dtype=bool)
        present[tokens] = True
        alphabet = np.flatnonzero(present).astype(np.uint32)
        levels = max(1, int(len(alphabet) - 1).bit_length()) if len(alphabet) else 0
        place = np.cumsum(present) - 1
        codes = place.astype(np.uint16 if levels <= 16 else np.uint32)[tokens]
        planes = []
        for level in range(levels - 1, -1, -1):
            bits = ((codes >> level) & 1).astype(bool)
            room = np.zeros(-(-len(codes) // 64) * 8, dtype=np.uint8)
            little = np.packbits(bits, bitorder="little")
            room[: len(little)] = little
            planes.append(room.view(np.uint64))
            codes = np.concatenate([codes[np.flatnonzero(~bits)], codes[np.flatnonzero(bits)]])
        return cls(len(codes), alphabet, planes)

    def to_bytes(self) -> bytes:
        head = HEAD.pack(MAGIC, self.n, len(self.alphabet), len(self.planes))
        parts = [_packed(self.alphabet.astype("<u4").tobytes())]
        parts += [_packed(plane.astype("<u8").tobytes()) for plane in self.planes]
        return head + b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        mark, n, _, levels = HEAD.unpack_from(data)
        if mark != MAGIC:
            raise ValueError("This is no wavelet file.")
        at, parts = HEAD.size, []
        for _ in range(levels + 1):
            (size,) = struct.unpack_from("<Q", data, at)
            parts.append(zstandard.ZstdDecompressor().decompress(data[at + 8 : at + 8 + size]))
            at += 8 + size
        planes = [np.frombuffer(p, dtype="<u8") for p in parts[1:]]
        return cls(n, np.frombuffer(parts[0], dtype="<u4"), planes)

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        plane = self.planes[level]
        inside = plane[np.minimum(word, len(plane) - 1)] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[level][word] + np.where(bit > 0, np.bitwise_count(inside), 0)

    def access(self, positions) -> np.ndarray:
        """Tokens at the positions."""
        at = np.asarray(positions, dtype=np.int64)
        code = np.zeros(at.shape, dtype=np.int64)
        for level, plane in enumerate(self.planes):
            bit = (plane[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0
            ones = self._ones(level, at)
            at = np.where(bit, self.zeros[level] + ones, at - ones)
            code = code << 1 | bit
        return self.alphabet[code]

    def _code(self, token: int) -> int:
        at = int(np.searchsorted(self.alphabet, token))
        return at if at < len(self.alphabet) and self.alphabet[at] == token else -1

    def _run(self, code: int, stop: int) -> tuple[int, int]:
        """Where the occurrences among the first `stop` tokens lie in the last order."""
        begin, end = np.array([0]), np.array([stop])
        for level in range(len(self.planes)):
            low, high = self._ones(level, begin), self._ones(level, end)
            if code >> (len(self.planes) - 1 - level) & 1:
                begin, end = self.zeros[level] + low, self.zeros[level] + high
            else:
                begin, end = begin - low, end - high
        return int(begin[0]), int(end[0])

    def rank(self, token: int, stop: int) -> int:
        """How often the token occurs among the first `stop` ones."""
        code = self._code(token)
        if code < 0:
            return 0
        begin, end = self._run(code, stop)
        return end - begin

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """Position of the k-th occurrence, counted from 0."""
        code = self._code(token)
        begin, end = self._run(code, self.n) if code >= 0 else (0, 0)
        if not 0 <= k < end - begin:
            raise IndexError("There are not so many occurrences.")
        at = begin + k
        for level in range(len(self.planes) - 1, -1, -1):
            if code >> (len(self.planes) - 1 - level) & 1:
                at = self._nth(level, at - self.zeros[level], True)
            else:
                at = self._nth(level, at, False)
        return at

    def _nth(self, level: int, k: int, one: bool) -> int:
        """Position of the k-th one or zero of a level."""
        low, high = 0, self.n - 1
        while low < high:
            mid = (low + high) // 2
            ones = int(self._ones(level, np.array([mid + 1]))[0])
            if (ones if one else mid + 1 - ones) > k:
                high = mid
            else:
                low = mid + 1
        return low

    def occurrences(self, token: int) -> np.ndarray:
        """All positions of the token, in order."""
        return np.array([self.select(token, k) for k in range(self.count(token))], dtype=np.int64)

    def tokens(self) -> np.ndarray:
        """All tokens in order: the levels are undone from the last to the first."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        codes = np.zeros(self.n, dtype=kind)
        for depth, level in enumerate(range(len(self.planes) - 1, -1, -1)):
            raw = self.planes[level].view(np.uint8)
            bits = np.unpackbits(raw, count=self.n, bitorder="little").view(bool)
            earlier = np.empty_like(codes)
            earlier[np.flatnonzero(~bits)] = codes[: self.zeros[level]]
            earlier[np.flatnonzero(bits)] = codes[self.zeros[level] :] | kind(1 << depth)
            codes = earlier
        return self.alphabet[codes] if self.n else np.zeros(0, dtype=np.uint32)
