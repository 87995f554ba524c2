"""Secret scan by lexing assignments.

Beside three plain patterns, a text is lexed as source code or configuration: names and the literals
assigned to them are paired, by `=`, `:`, `:=`, `=>` or `+=`, in chains, with string keys
(`config["db_password"]`), as arguments of calls, joined by `+`, on the next line, in brackets, in
triple quotes, and in markup. An unquoted word is a reference in source code and a value in
configuration (`NAME=value`, `name: value`, below a `[section]`). A name stands for the literals it was
last given, until it gets something else; a literal takes its score from every name it reaches, and
is reported when a sensitive name and its own look add up.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosemill.llm import frames

#: The plain patterns.
ASSIGN = re.compile(
    r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_VALUE, LEAST_ACCESS = 8, 16
KINDS = ("assign", "access", "hex", "literal")

#: Parts of names that say a value is secret, and how surely.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "token": 0.8,
    "apikey": 1.0, "credential": 0.8, "credentials": 0.8, "privatekey": 1.0, "accesskey": 1.0,
    "secretkey": 1.0, "authkey": 1.0, "bearer": 0.8, "signature": 0.4, "auth": 0.4, "key": 0.3, "pass": 0.6,
}
#: A name next to these is about something else.
HARMLESS = {"length", "size", "count", "url", "path", "file", "type", "name", "id", "hint", "field", "label", "expires", "public"}
HINTS = ("pass", "pwd", "secret", "token", "key", "credential", "bearer", "auth", "signature")
#: Bytes of lower-case hexadecimal digits to one, so that long runs are found by a plain search.
HEX_BYTES = bytes(chr(b) in "0123456789abcdef" for b in range(256))
LONG_RUN = b"\1" * 32
PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|\.+|change_?me|example|placeholder|dummy|none|null|true|false|undefined|your[_-].*|<.*>|\$\{.*\}|\$\(.*\)|%\(?\w+\)?s?|\{\{.*\}\})$")
#: A value without quotes, up to the next blank or bracket.
VALUE = re.compile(r"""[^\s"'`,;(){}\[\]<>+]+""")
TOKEN = re.compile(
    r"""(?P<text>(?<![A-Za-z0-9_])(?:[rbfuRBFU]{1,2})?(?:\"{3}[\s\S]*?\"{3}|'{3}[\s\S]*?'{3}|"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`))"""
    r"""|(?P<skip>::|->|\\\n)|(?P<sets>\+=|:=|=>|===?|!==?|<=|>=|=|:)|(?P<plus>\+)|(?P<note>(?<![^\s;])(?://|\#|--))"""
    r"""|(?P<name>[A-Za-z_$][A-Za-z0-9_$.-]*)|(?P<line>\n)|(?P<open>[(\[{])|(?P<close>[)\]}])|(?P<end>[,;<>])"""
    r"""|(?P<bare>[^\s"'`=:+,;(){}\[\]<>]+)"""
)
SECTION = re.compile(r"(?m)^[ \t]*\[[\w .:-]+\][ \t]*$")
ELEMENT = re.compile(r"<([A-Za-z_][\w.:-]*)>\s*([^<>\s]+)\s*</\1>")
TAG = re.compile(r"<[A-Za-z][^<>]*>")
ATTRIBUTE = re.compile(r"""([\w:.-]+)\s*=\s*("[^"]*"|'[^']*')""")
#: Attributes that name what another attribute holds, and that one.
NAMING, HELD = ("key", "name", "id"), "value"
WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
LEAST_SCORE = 1.2

Span = tuple[int, int]


def sensitivity(name: str) -> float:
    """How surely a name's value is secret: from its parts, alone and in pairs."""
    parts = [p.lower() for p in WORDS.findall(name)]
    if parts and parts[-1] in HARMLESS or "public" in parts:
        return 0.0
    pairs = [a + b for a, b in zip(parts, parts[1:], strict=False)]
    return max((SENSITIVE.get(p, 0.0) for p in parts + pairs), default=0.0)


def plausibility(literal: str) -> float:
    """How much a literal looks like a secret: long enough, without blanks, mixed and varied."""
    if len(literal) < 6 or PLACEHOLDER.match(literal) or any(c.isspace() for c in literal):
        return 0.0
    kinds = sum(any(f(c) for c in literal) for f in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
    counts = Counter(literal).values()
    entropy = -sum(k / len(literal) * math.log2(k / len(literal)) for k in counts)
    return min(1.0, 0.2 * kinds + 0.15 * entropy)


class Frame:
    """What is open between two brackets: the names being assigned, and what they get."""

    def __init__(self, receiver: list | None = None):
        self.around = receiver  # what an unnamed literal in here goes to
        self.idle()

    def idle(self) -> None:
        self.targets: list[str] = []
        self.sign = ""
        self.children: list = []
        self.waits = False  # for a value
        self.bare = False  # nothing stands behind the sign yet
        self.config = False  # an unquoted word is a value, not a reference
        self.next_line = False
        self.alone: tuple[str, int] | None = None  # the only operand so far, if it is a name

    @property
    def receiver(self) -> list | None:
        return self.children if self.targets else self.around


class Assignments:
    """The assignments of one text, in order: each is a node with its literals and the nodes of the
    names on its right, as they stood there. A node has one entry for each operand, so a text's
    nodes are no larger than the text, however its names refer to each other."""

    def __init__(self, text: str):
        self.text = text
        self.nodes: list[tuple[list[str], list]] = []
        self.current: dict[str, int] = {}  # the node of each name that holds literals
        self.section = SECTION.search(text)
        self.frames = [Frame()]
        self.name: str | None = None
        self._read()

    def _commit(self, frame: Frame) -> None:
        if frame.targets:
            if frame.children:
                self.nodes.append((frame.targets, frame.children))
            for target in frame.targets:
                if frame.children:
                    self.current[target] = len(self.nodes) - 1
                else:  # it holds something else now
                    self.current.pop(target, None)
        frame.idle()

    def _read(self) -> None:
        text, behind, last, last_end = self.text, 0, "", 0
        for token in TOKEN.finditer(text):
            kind, a, b = token.lastgroup, token.start(), token.end()
            if a < behind or kind == "skip":
                continue
            frame = self.frames[-1]
            if kind == "line":
                if last == "line" and not text[last_end:a].strip():  # an empty line closes what was left open
                    for left in reversed(self.frames):
                        self._commit(left)
                    self.frames, self.name = [Frame()], None
                elif len(self.frames) == 1:
                    if frame.targets and frame.bare:
                        frame.next_line = True
                    elif not frame.waits or not frame.targets:
                        self._commit(frame)
                    self.name = None
            elif kind == "note":
                if frame.targets and not frame.waits:
                    self._commit(frame)
                    stop = text.find("\n", b)
                    behind = len(text) if stop < 0 else stop
            elif kind == "sets":
                self._sign(frame, token.group(), a, b)
            elif kind == "plus":
                frame.waits, frame.alone = True, None
            elif kind == "end":
                self._commit(frame)
                self.name = None
            elif kind == "open":
                # behind a word it is a call or a subscript; what stands in a subscript is a key
                subscript = token.group() == "[" and a > 0 and (text[a - 1].isalnum() or text[a - 1] in "_])")
                inner = None if subscript or token.group() == "{" else frame.receiver
                frame.waits, frame.bare, frame.alone, frame.next_line = False, False, None, False
                self.frames.append(Frame(inner))
            elif kind == "close":
                self._commit(frame)
                if len(self.frames) > 1:
                    self.frames.pop()
            else:
                behind = self._word(frame, kind, token, last == "text")
            last, last_end = kind, b
        for left in reversed(self.frames):
            self._commit(left)

    def _sign(self, frame: Frame, sign: str, a: int, b: int) -> None:
        name, self.name = self.name, None
        if sign in ("==", "===", "!=", "!==", "<=", ">="):
            frame.children = []
            self._commit(frame)
        elif name is not None:
            if frame.targets and frame.alone and frame.alone[0] == name:
                del frame.children[frame.alone[1] :]  # a chain, or a type between name and value
                if not (frame.sign == ":" and sign == "="):
                    frame.targets.append(name)
            else:
                self._commit(frame)
                frame.targets = [name]
            frame.sign, frame.waits, frame.bare, frame.alone = sign, True, True, None
            if sign == "+=" and name in self.current:
                frame.children.append(self.current[name])
            apart = self.text[a - 1 : a].isspace() or self.text[b : b + 1].isspace()
            frame.config = len(self.frames) == 1 and (sign == ":" or self.section is not None or not apart)

    def _word(self, frame: Frame, kind: str, token: re.Match, behind_text: bool) -> int:
        """Take a literal or a name; gives the place to read on from."""
        text, a, b = self.text, token.start(), token.end()
        if frame.next_line:
            frame.next_line = False
            if kind != "text":
                self._commit(frame)
        if kind == "text":
            quoted = token.group().lstrip("rbfuRBFU")
            marks = 3 if quoted[:3] in ('"""', "\'\'\'") and len(quoted) >= 6 else 1
            begin, end = b - len(quoted) + marks, b - marks
            word = text[begin:end]
            begin += len(word) - len(word.lstrip())
            span = (begin, max(begin, end - (len(word) - len(word.rstrip()))))
        else:
            word, span = token.group(), (a, b)
        receiver, named, frame.bare = frame.receiver, bool(frame.targets), False
        if receiver is not None and (not named or frame.waits or kind == "text" and behind_text):
            first = not receiver and named
            before = len(receiver)
            if kind == "text":
                receiver.append(span)
            elif kind == "name" and text[b : b + 1] == "(":
                pass  # a call gives what it gives
            elif kind == "name" and word in self.current:
                receiver.append(self.current[word])
            elif named and (kind == "bare" or frame.config):
                span = VALUE.match(text, a).span()
                if text[span[1] : span[1] + 1] != "(":
                    receiver.append(span)
                b = span[1]
            if named:
                frame.alone = (word, before) if first and kind == "name" else None
                frame.waits = False
        else:
            frame.alone = None
        self.name = word
        return b


def markup(text: str) -> list[tuple[str, Span]]:
    """Name and literal of elements, and of attributes that another attribute of their tag names."""
    found = [(m[1], m.span(2)) for m in ELEMENT.finditer(text)]
    for tag in TAG.finditer(text):
        attributes = {m[1].lower(): m for m in ATTRIBUTE.finditer(text, tag.start(), tag.end())}
        held = attributes.get(HELD)
        for naming in NAMING:
            if held and naming in attributes:
                found.append((attributes[naming][2][1:-1], (held.start(2) + 1, held.end(2) - 1)))
    return found


def literals(text: str) -> dict[Span, float]:
    """Every literal that reaches a name, and how sensitive the most sensitive of those names is."""
    found: dict[Span, float] = {}
    if "<" in text:
        for name, span in markup(text):
            found[span] = max(found.get(span, 0.0), sensitivity(name))
    nodes = Assignments(text).nodes
    reached = [0.0] * len(nodes)
    for i in range(len(nodes) - 1, -1, -1):  # a node is only used by later ones
        targets, children = nodes[i]
        score = max(reached[i], *map(sensitivity, targets))
        for child in children:
            if isinstance(child, int):
                reached[child] = max(reached[child], score)
            else:
                found[child] = max(found.get(child, 0.0), score)
    return found


def _outside(spans_: list[Span], taken: list[Span]) -> list[Span]:
    """The spans that touch none of the taken ones."""
    merged: list[list[int]] = []
    for a, b in sorted(taken):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    ends = [b for _, b in merged]
    out = []
    for a, b in spans_:
        at = bisect.bisect_right(ends, a)  # the first that ends behind its start
        if at == len(merged) or merged[at][0] >= b:
            out.append((a, b))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the plain patterns, leftmost and apart within each kind."""
    found = []
    low = text.lower()
    if any(word in low for word in ASSIGN_WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    if LONG_RUN in text.encode("utf-8", "replace").translate(HEX_BYTES):
        found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


def spans(text: str) -> list[tuple[str, int, int]]:
    """All spans by start, then kind. Literals that a plain match touches are not reported again."""
    base = base_spans(text)
    found = list(base)
    low = text.lower()
    if ("=" in text or ":" in text or "<" in text) and any(hint in low for hint in HINTS):
        sensitive = {span: score for span, score in literals(text).items() if score}
        for a, b in _outside(list(sensitive), [(s, e) for _, s, e in base]):
            looks = plausibility(text[a:b])
            if looks and sensitive[a, b] + looks >= LEAST_SCORE:
                found.append(("literal", a, b))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def secret_spans(df: DataFrame) -> DataFrame:
    """Per row its spans as `spans` array of (kind, begin, end), in code points, end exclusive.

    A null text counts as empty; repeated rows are scanned each; a text of any length is scanned
    whole, in time that grows in proportion; an empty table gives no rows; other columns are left out.
    """
    kept = [f for f in frames.texts(df).schema.fields if f.name != "text"]
    fields = "spans array<struct<kind:string,begin:int,end:int>>"
    schema = frames.T.StructType([*kept, *frames.T.StructType.fromDDL(fields).fields])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for batch in batches:
            for part in frames.slices(batch):
                rows = [[dict(zip(("kind", "begin", "end"), s, strict=True)) for s in spans(t)] for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(rows, kind)], names=["doc_id", "spans"])

    return frames.texts(df).mapInArrow(run, schema)


def secret_report(df: DataFrame) -> DataFrame:
    """The spans as counts and text."""
    found = secret_spans(df)
    line = lambda x: F.concat_ws(":", x["kind"], x["begin"].cast("string"), x["end"].cast("string"))
    base = F.filter("spans", lambda x: x["kind"] != "literal")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(F.concat_ws(",", F.transform(base, line)), 256).alias("base_sha256"),
        F.concat_ws(",", F.transform("spans", line)).alias("spans"),
    )
