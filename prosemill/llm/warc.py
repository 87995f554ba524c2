"""The WARC format: records as bytes, their segments, and chunked transfer framing.

A record is a version line, named fields, an empty line and a block of the stated length; two line
ends close it. A block longer than a limit is cut into segments: the first record keeps the
type and gets segment number 1, the others are continuations that name it as their origin, and the
last of them states the whole length.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

VERSION = b"WARC/1.1"
#: Fixed by the format: line end, the end of a record, the profile of an identical payload.
LINE, END = b"\r\n", b"\r\n\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
HTTP_KIND = "application/http; msgtype=response"
HEX_SIZE = re.compile(rb"[0-9A-Fa-f]{1,16}")


class Malformed(ValueError):
    """What cannot be read as the format says."""


class Record(NamedTuple):
    """A record as it stands in an archive; names of fields are in small letters."""

    fields: dict[str, str]
    block: bytes


def digest(payload: bytes) -> str:
    """SHA-1 in base32, upper case."""
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def record_uri(*names: object) -> str:
    """A record's identifier, the same for the same names."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, 'warc:' + ':'.join(map(str, names)))}>"


def chunked(payload: bytes, size: int) -> bytes:
    """The payload in chunks of `size` bytes, closed by an empty one."""
    parts = []
    for at in range(0, len(payload), size):
        piece = payload[at : at + size]
        parts += [b"%x" % len(piece), LINE, piece, LINE]
    return b"".join([*parts, b"0", END])


def unchunked(framed: bytes) -> bytes:
    """The payload of a chunked body; extensions and trailers are passed over."""
    parts, at = [], 0
    while True:
        stop = framed.find(LINE, at)
        if stop < 0:
            raise Malformed("a chunk's size is cut off")
        size = framed[at:stop].split(b";", 1)[0].strip()
        if not HEX_SIZE.fullmatch(size):
            raise Malformed("a chunk's size is no number")
        at, length = stop + 2, int(size, 16)
        if not length:
            break
        if framed[at + length : at + length + 2] != LINE:
            raise Malformed("a chunk's end is not where its size says")
        parts.append(framed[at : at + length])
        at += length + 2
    while (stop := framed.find(LINE, at)) > at:  # trailers
        at = stop + 2
    if stop != at or at + 2 != len(framed):
        raise Malformed("bytes behind the last chunk, or none")
    return b"".join(parts)


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response: what follows its head, without the transfer framing."""
    head, found, body = block.partition(END)
    if not head.startswith(b"HTTP/") or not found:
        raise Malformed("no HTTP head")
    for line in head.split(LINE)[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"transfer-encoding" and value.strip().lower() == b"chunked":
            return unchunked(body)
    return body


def clean(value: str) -> str:
    """A field's value on one line: blanks and controls are written in per cent form."""
    return re.sub(r"[\x00-\x20\x7f-\x9f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), value)


def record_bytes(fields: dict[str, object], block: bytes) -> bytes:
    """A record without the line ends that close it."""
    lines = [VERSION, *(f"{name}: {value}".encode() for name, value in fields.items() if value is not None)]
    return LINE.join([*lines, b"Content-Length: %d" % len(block), b"", block])


def segmented(fields: dict[str, object], block: bytes, limit: int) -> Iterator[bytes]:
    """The record, or its segments of at most `limit` bytes of the block each."""
    if len(block) <= limit:
        yield record_bytes(fields, block)
        return
    origin = fields["WARC-Record-ID"]
    yield record_bytes(fields | {"WARC-Segment-Number": 1}, block[:limit])
    for number, at in enumerate(range(limit, len(block), limit), 2):
        more: dict[str, object] = {
            "WARC-Type": "continuation", "WARC-Record-ID": record_uri(origin, number), "WARC-Date": fields["WARC-Date"],
            "WARC-Segment-Origin-ID": origin, "WARC-Segment-Number": number,
        }
        if at + limit >= len(block):
            more["WARC-Segment-Total-Length"] = len(block)
        yield record_bytes(more, block[at : at + limit])


def unpacked(archive: bytes) -> bytes:
    """An archive as records; one of gzip members is unpacked."""
    if not archive.startswith(b"\x1f\x8b"):
        return archive
    parts = []
    while archive:
        member = zlib.decompressobj(31)
        parts.append(member.decompress(archive) + member.flush())
        if not member.eof:
            raise Malformed("a gzip member is cut off")
        archive = member.unused_data
    return b"".join(parts)


def records(archive: bytes) -> Iterator[Record]:
    """The records of an archive, found by their stated lengths alone."""
    archive, at = unpacked(archive), 0
    while at < len(archive):
        stop = archive.find(END, at)
        if stop < 0:
            raise Malformed("a record's head is cut off")
        first, *lines = archive[at:stop].split(LINE)
        if not first.startswith(b"WARC/"):
            raise Malformed("no record where one should begin")
        fields: dict[str, str] = {}
        name = ""
        for line in lines:
            if line[:1] in (b" ", b"\t") and name:  # a folded line goes on with the value before it
                fields[name] += " " + line.strip().decode("utf-8", "replace")
                continue
            key, found, value = line.partition(b":")
            if not found:
                raise Malformed("a field without a colon")
            name = key.strip().lower().decode("utf-8", "replace")
            fields[name] = value.strip().decode("utf-8", "replace")
        if not fields.get("content-length", "").isdecimal():
            raise Malformed("a record without its length")
        begin = stop + len(END)
        close = begin + int(fields["content-length"])
        if archive[close : close + len(END)] != END:
            raise Malformed("a record does not end where its length says")
        yield Record(fields, archive[begin:close])
        at = close + len(END)
