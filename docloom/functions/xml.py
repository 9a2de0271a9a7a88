"""Cleaning of a model's XML answers as column expressions, and the strict checks that need a parser."""

from __future__ import annotations

import bisect
import re
import xml.parsers.expat
from collections.abc import Iterator

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.functions.text import let

#: The element that frames a header, and literal escapes that a model leaves in place.
FRAME = "Document"
ESCAPES = [("\\u003c", "<"), ("\\u003e", ">"), ("\\n", "\n"), ("\\t", "\t"), ("\\r", ""), ('\\"', '"')]
#: Fixed pattern: an ampersand that begins no entity.
BARE_AMPERSAND = r"&(?!(amp|lt|gt|quot|apos|#\d+|#x[0-9a-fA-F]+);)"
#: Fixed pattern: characters that never belong in an answer.
STRAY = "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\uFFFD\\u200B-\\u200D\\uFEFF]"


def java_trim(text: Column) -> Column:
    """Without leading and trailing characters up to the blank."""
    return F.regexp_replace(text, "\\A[\\x00-\\x20]+|[\\x00-\\x20]+\\z", "")


def framed(answer: Column) -> Column:
    """From the first opening frame tag to the last closing one, code fences removed; null if there is none."""
    bare = java_trim(F.replace(F.replace(answer, F.lit("```xml"), F.lit("")), F.lit("```"), F.lit("")))

    def between(text: Column) -> Column:
        begin = F.instr(text, f"<{FRAME}>")
        size = F.length(text) - F.length(F.substring_index(text, f"</{FRAME}>", -1)) - begin + 1  # up to the last closing tag
        return F.when((begin > 0) & (size >= 2 * len(FRAME) + 5), F.substring(text, begin, size))

    return let(bare, between)


def escaped_ampersands(text: Column) -> Column:
    return F.regexp_replace(text, BARE_AMPERSAND, "&amp;")


def sanitized(text: Column) -> Column:
    """Cut after the first closing frame tag, literal escapes undone, stray characters dropped, bare ampersands escaped, ends trimmed."""

    def clean(own: Column) -> Column:
        end = F.instr(own, f"</{FRAME}>")
        out = F.when(end > 0, F.substring(own, F.lit(1), end + len(FRAME) + 2)).otherwise(own)
        for old, new in ESCAPES:
            out = F.replace(out, F.lit(old), F.lit(new))
        return java_trim(escaped_ampersands(F.regexp_replace(out, STRAY, "")))

    return let(text, clean)


def split_stored(stored: Column) -> tuple[Column, Column]:
    """(header, text) of a stored document: parted after the first closing frame tag and its line end."""
    end = F.instr(stored, f"</{FRAME}>")
    cut = end + len(FRAME) + 3
    return F.when(end > 0, F.substring(stored, F.lit(1), cut - 1)), F.when(end > 0, F.substring(stored, cut + 1, F.length(stored))).otherwise(stored)


class _Refused(Exception):
    pass


def is_valid(text: str) -> bool:
    """Well-formed, and without a document type."""

    def refuse(*_: object) -> None:
        raise _Refused

    parser = xml.parsers.expat.ParserCreate()
    parser.StartDoctypeDeclHandler = refuse
    try:
        parser.Parse(text.encode("utf-8", "surrogatepass"), True)
    except (_Refused, xml.parsers.expat.ExpatError, UnicodeError):
        return False
    return True


_MARKS = re.compile("[\"'>]")
_NAME = re.compile("[A-Za-z][A-Za-z0-9_.-]*")


class _Ends:
    """Where the '>' outside quotes stands for a scan from any place; found from the right in one pass over quotes and '>'."""

    def __init__(self, text: str):
        self.at = [m.start() for m in _MARKS.finditer(text)]
        self.end = [-1] * (len(self.at) + 1)
        following: dict[str, int] = {}
        for k in range(len(self.at) - 1, -1, -1):
            mark = text[self.at[k]]
            if mark == ">":
                self.end[k] = self.at[k]
            else:
                if mark in following:
                    self.end[k] = self.end[following[mark] + 1]
                following[mark] = k

    def __call__(self, place: int) -> int:
        return self.end[bisect.bisect_left(self.at, place)]


def tags(text: str) -> Iterator[tuple[int, str, str]]:
    """(position, name, "open" | "close" | "empty") of each tag. Quotes hide '>'; what is not closed is no tag."""
    end_of, at = _Ends(text), text.find("<")
    while at >= 0:
        begin = at + 1 + text.startswith("/", at + 1)
        name = _NAME.match(text, begin)
        end = end_of(name.end()) if name else -1
        if end >= 0:
            yield at, name[0], "close" if begin > at + 1 else "empty" if text[end - 1] == "/" else "open"
        at = text.find("<", end + 1 if end >= 0 else at + 1)


def completed(text: str, nested: bool = False) -> str | None:
    """The text with missing closing tags put in; null if none is missing or a closing tag was never opened.

    Several that belong at one place come out in the order in which the deployed service writes them, the last found
    first; `nested` writes them in the order in which they close.
    """
    open_, places = [], {}
    for at, name, kind in tags(text):
        if kind == "open":
            open_.append(name)
        elif kind == "close":
            if name not in open_:
                return None
            while open_[-1] != name:
                places.setdefault(at, []).append(open_.pop())
            open_.pop()
    if open_:
        places.setdefault(len(text), []).extend(reversed(open_))
    if not places:
        return None
    out, done = [], 0
    for at in sorted(places):
        names = places[at] if nested else places[at][::-1]
        out += [text[done:at], *[f"</{n}>" for n in names]]
        done = at
    return "".join(out) + text[done:]


REPAIRED = T.StructType([T.StructField("xml", T.StringType()), T.StructField("fix", T.StringType())])


def repaired(text: str, clean: str, nested: bool = False) -> tuple[str | None, str | None]:
    """(valid form, how it was reached) of an answer and its sanitized form; (null, null) if none is valid."""
    tries = [("none", text), ("sanitized", clean), ("completed", completed(text, nested))]
    if clean != text:
        tries.append(("sanitized and completed", completed(clean, nested)))
    return next(((x, how) for how, x in tries if x is not None and is_valid(x)), (None, None))
