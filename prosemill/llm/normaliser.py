"""The normaliser of a piece model as a transducer over characters.

A model's character table is a double array: a trie over UTF-8 bytes whose leaves point to what is
written instead. It is compiled into states of a machine that reads characters; from every place of
a text the machine follows its arcs as far as they go, writes what the last final state on the way
says, and goes on behind it. A character from which no arc leads on is written as it is.
"""

from __future__ import annotations

import re

import numpy as np

from prosemill.llm.pieces import BLANK

#: Fixed by the format of double arrays: bits of a unit.
LABEL, LEAF, VALUE, WIDE = 0x800000FF, 0x100, 0x7FFFFFFF, 0x200


def table_rules(table: bytes) -> dict[str, str]:
    """What a character table writes for which runs of characters."""
    if not table:
        return {}
    size = int.from_bytes(table[:4], "little")
    units = np.frombuffer(table, dtype="<u4", count=size // 4, offset=4)
    written = table[4 + size :]
    labels = np.arange(1, 256, dtype=np.int64)
    rules = {}

    def below(at: int) -> int:
        unit = int(units[at])
        return at ^ ((unit >> 10) << ((unit & WIDE) >> 6))

    waiting = [(below(0), b"")]
    while waiting:
        base, key = waiting.pop()
        places = base ^ labels
        inside = places < len(units)
        found = labels[inside][(units[places[inside]] & np.uint32(LABEL)) == labels[inside]]
        for label in found.tolist():
            at, longer = base ^ label, key + bytes([label])
            after = below(at)
            if units[at] & LEAF:
                start = int(units[after]) & VALUE
                rules[longer.decode()] = written[start : written.index(b"\0", start)].decode()
            waiting.append((after, longer))
    return rules


class Normaliser:
    """The machine of a character table, and what is done about blanks."""

    def __init__(self, table: bytes, trims: bool):
        self.trims = trims
        self.arcs: dict = {}
        for source, target in table_rules(table).items():
            state = self.arcs
            for char in source:
                state = state.setdefault(char, {})
            state[""] = target
        begins = "".join(map(re.escape, self.arcs))
        self.begins = re.compile(f"[{begins}]") if begins else None

    def _rewritten(self, text: str) -> list[str]:
        """What the machine writes, piece by piece."""
        out, behind, n = [], 0, len(text)
        for match in self.begins.finditer(text):
            start = match.start()
            if start < behind:
                continue
            state, at, end, target = self.arcs, start, start, None
            while at < n and (state := state.get(text[at])) is not None:
                at += 1
                if "" in state:
                    end, target = at, state[""]
            if target is not None:
                out += [text[behind:start], target]
                behind = end
        out.append(text[behind:])
        return out

    def run(self, text: str) -> str:
        """The normal form, blanks as blanks."""
        parts = [text] if self.begins is None else self._rewritten(text)
        if not self.trims:
            return "".join(parts)
        # of blanks one behind the other the first stays, none at the ends; at the end the marks
        # that stand for blanks go as well, whoever wrote them
        return re.sub(" {2,}", " ", "".join(parts)).lstrip(" ").rstrip(f" {BLANK}")
