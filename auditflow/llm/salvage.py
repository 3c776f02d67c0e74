"""Reads WARC bytes that may be damaged, and says which bytes it could not read."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

MEMBER = b"\x1f\x8b\x08"
START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[0-9]\r\n")
VERSION = re.compile(rb"WARC/1\.[0-9]\r\n")
END = b"\r\n\r\n"
PIECE = 1 << 16


class Damaged(ValueError):
    """A check failed; the message says which."""


@dataclass
class Found:
    """A record with its place, or a gap with the reason why it was passed over."""

    start: int
    end: int
    reason: str | None = None
    headers: dict[str, str] = field(default_factory=dict)
    payload: bytes = b""


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record(data: bytes, at: int) -> Found:
    """The plain record that starts at ``at``."""
    version = VERSION.match(data, at)
    if not version:
        raise Damaged("no version line")
    head_end = data.find(END, version.end() - 2)
    if head_end < 0:
        raise Damaged("headers do not end")
    headers = {}
    for line in data[version.end():head_end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon or not name or name != name.strip() or b"\n" in line:
            raise Damaged("a header is no name and value")
        headers[name.decode("utf-8", "replace").lower()] = value.strip().decode("utf-8", "replace")
    length = headers.get("content-length", "")
    if not re.fullmatch("[0-9]+", length):
        raise Damaged("no content length")
    body = head_end + len(END)
    end = body + int(length)
    if data[end:end + len(END)] != END:
        raise Damaged("the record does not end where its length says")
    block = data[body:end]
    http = headers.get("content-type", "").startswith("application/http")
    payload = block.partition(END)[2] if http else block
    digest = headers.get("warc-payload-digest", "")
    if headers.get("warc-type") != "revisit" and digest.startswith("sha1:") and digest[5:] != base32_sha1(payload):
        raise Damaged("the payload does not have its digest")
    return Found(at, end + len(END), None, headers, payload)


def _member(data: bytes, at: int) -> list[Found]:
    """The records of the compressed member that starts at ``at``; their place is the member's."""
    inflate, out, fed = zlib.decompressobj(31), [], at
    try:
        while not inflate.eof and fed < len(data):
            out.append(inflate.decompress(data[fed:fed + PIECE]))
            fed += PIECE
    except zlib.error:
        raise Damaged("a compressed member is broken") from None
    if not inflate.eof:
        raise Damaged("a compressed member is cut short")
    end = min(fed, len(data)) - len(inflate.unused_data)
    plain, inside, found = b"".join(out), 0, []
    while inside < len(plain):
        record = _record(plain, inside)
        inside = record.end
        record.start, record.end = at, end
        found.append(record)
    if not found:
        raise Damaged("a compressed member holds no record")
    return found


def _at(data: bytes, at: int) -> list[Found]:
    return _member(data, at) if data.startswith(MEMBER, at) else [_record(data, at)]


def salvage(data: bytes) -> Iterator[Found]:
    """Records and gaps in the order of their places; together they cover all bytes.

    After a failed check the next place that looks like a member or a version line and holds a whole
    valid record goes on; everything before it is one gap, with the reason of the failure.
    """
    at = 0
    while at < len(data):
        try:
            found = _at(data, at)
            yield from found
            at = found[-1].end
        except Damaged as damage:
            start, reason = at, str(damage)
            at = len(data)
            for place in START.finditer(data, start + 1):
                try:
                    _at(data, place.start())
                except Damaged:
                    continue
                at = place.start()
                break
            yield Found(start, at, reason)

