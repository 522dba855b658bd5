"""Whether a file's parts are where its own tables say: a PDF's cross-references and a ZIP's directory, within bounds."""

from __future__ import annotations

import re
import struct

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Bytes at a PDF's start and end that its marks are looked for in, sections that are followed, entries that are tried.
HEAD, TAIL, SECTIONS, TRIED = 1024, 2048, 64, 16
#: Bytes of the longest end of a ZIP with its comment.
END = 22 + 0xFFFF
_SECTION, _LINE = re.compile(rb"\s*([0-9]{1,10}) ([0-9]{1,10})[ \r]*\r?\n"), re.compile(rb"[0-9]{10} [0-9]{5} [nf][ \r][\r\n]")
_OBJECT, _PREVIOUS = re.compile(rb"\s*[0-9]+\s+[0-9]+\s+obj\b"), re.compile(rb"/Prev\s+([0-9]+)")


def pdf(data: bytes) -> str:
    """ok; no header; truncated (no end mark, or no place of the cross-references before it); forged (what is at the place
    is no cross-reference table or stream, or an entry of a table points elsewhere than at an object)."""
    begin = data[:HEAD].find(b"%PDF-")
    if begin < 0:
        return "no header"
    tail = data[-TAIL:]
    place = re.search(rb"startxref\s+([0-9]{1,12})\s+%%EOF", tail[max(0, tail.rfind(b"startxref")) :])
    if not place:
        return "truncated"
    at, seen = begin + int(place[1]), set()
    while at not in seen and len(seen) < SECTIONS:
        seen.add(at)
        if at >= len(data):
            return "forged"
        if data[at : at + 4] != b"xref":
            return "ok" if _OBJECT.match(data, at) else "forged"
        at, tried = at + 4, 0
        while m := _SECTION.match(data, at):
            at = m.end() + 20 * int(m[2])
            if at > len(data) or int(m[2]) and not (_LINE.match(data, m.end()) and _LINE.match(data, at - 20)):
                return "forged"
            for i in range(m.end(), min(at, m.end() + 20 * TRIED), 20):
                if not _LINE.match(data, i):
                    return "forged"
                if tried < TRIED and data[i + 17 : i + 18] == b"n":
                    tried += 1
                    if not _OBJECT.match(data, begin + int(data[i : i + 10])):
                        return "forged"
        trailer = re.compile(rb"\s*trailer\b").match(data, at)
        if not trailer:
            return "forged"
        end = data.find(b"startxref", at)
        previous = _PREVIOUS.search(data, at, end if end >= 0 else len(data))
        if not previous:
            return "ok"
        at = begin + int(previous[1])
    return "ok"


def archive(data: bytes) -> str:
    """ok; no header; truncated (no end record, or its comment is cut); forged (the directory isn't where the end record
    says, has other entries than it says, or one of them points elsewhere than at a member)."""
    if data[:4] not in (b"PK\x03\x04", b"PK\x05\x06"):
        return "no header"
    at = data.rfind(b"PK\x05\x06", max(0, len(data) - END))
    if at < 0 or at + 22 > len(data):
        return "truncated"
    count, size, start, comment = struct.unpack_from("<HIIH", data, at + 10)
    if at + 22 + comment > len(data):
        return "truncated"
    if start + size > at:
        return "forged"
    here = start
    for _ in range(count):
        if data[here : here + 4] != b"PK\x01\x02" or here + 46 > at:
            return "forged"
        packed, name, extra, note = struct.unpack_from("<I4xHHH", data, here + 20)
        member = struct.unpack_from("<I", data, here + 42)[0]
        if data[member : member + 4] != b"PK\x03\x04" or member + 30 + packed > start:
            return "forged"
        here += 46 + name + extra + note
    return "ok" if here == start + size else "forged"


@F.pandas_udf(StringType())
def structure(content: pd.Series) -> pd.Series:
    """The state of PDFs and ZIPs as above; NULL for other files."""

    def state(data: bytes | None) -> str | None:
        if data is None:
            return None
        data = bytes(data)
        return archive(data) if data[:2] == b"PK" else pdf(data) if b"%PDF-" in data[:HEAD] else None

    return content.map(state, na_action="ignore")
