"""Text of binary word documents (Word 97 and later): paragraphs and table rows in order, a line each.

A compound file is a small file system of sectors; its stream WordDocument begins with a table of places, by which the
pieces of the text and the properties of its paragraphs are found. Only what text and tables need is read. A file with a
password is unreadable for good; older formats and damaged files raise what any reader may.
"""

from __future__ import annotations

import re
import struct

from docloom.operators.extract import BadFormat

#: Fixed values of the formats: marks of a compound file and of its chains, places in the first block of a document.
MAGIC, END, MOST_SECTOR = bytes.fromhex("D0CF11E0A1B11AE1"), 0xFFFFFFFE, 0xFFFFFFFA
IDENT, OLDEST, ENCRYPTED, SECOND_TABLE = 0xA5EC, 101, 0x0100, 0x0200
CHARS_AT, PARAGRAPHS_AT, PIECES_AT = 0x4C, 0x102, 0x1A2
#: Paragraph properties (in a table, end of a row, the row's cells), and sizes of operands by the upper bits.
IN_TABLE, ROW_END, CELLS = 0x2416, 0x2417, 0xD608
OPERANDS = (1, 1, 2, 4, 2, 2, None, 3)
PAGE = 512
_FIELD = re.compile("\x13[^\x14\x15]*\x14([^\x15]*)\x15")
_BARE_FIELD = re.compile("\x13[^\x15]*\x15")
_CONTROL = re.compile("[\x00-\x08\x0b-\x1f\x7f]")


def _u16(data: bytes, at: int) -> int:
    return struct.unpack_from("<H", data, at)[0]


def _u32(data: bytes, at: int) -> int:
    return struct.unpack_from("<I", data, at)[0]


class Compound:
    """The streams of a compound file, by name."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a compound file")
        self.data, self.sector, self.small = data, 1 << _u16(data, 30), 1 << _u16(data, 32)
        places, block = list(struct.unpack_from("<109I", data, 76)), _u32(data, 68)
        for _ in range(_u32(data, 72)):
            more = struct.unpack(f"<{self.sector // 4}I", self._sector(block))
            places, block = places + list(more[:-1]), more[-1]
        table = b"".join(self._sector(p) for p in places if p <= MOST_SECTOR)
        self.next = struct.unpack(f"<{len(table) // 4}I", table)
        cut = self._chain(_u32(data, 60)) if _u32(data, 64) else b""
        self.small_next = struct.unpack(f"<{len(cut) // 4}I", cut)
        entries = self._chain(_u32(data, 48))
        self.entries: dict[str, tuple[int, int]] = {}
        for a in range(0, len(entries) - 127, 128):
            kind = entries[a + 66]
            if kind in (2, 5):
                name = "" if kind == 5 else entries[a : a + max(0, _u16(entries, a + 64) - 2)].decode("utf-16-le")
                self.entries[name] = (_u32(entries, a + 116), _u32(entries, a + 120))
        self.bits, self.limit = self._chain(self.entries[""][0]) if "" in self.entries and self.small_next else b"", _u32(data, 56)

    def _sector(self, n: int) -> bytes:
        own = self.data[(n + 1) * self.sector : (n + 2) * self.sector]
        return own + bytes(self.sector - len(own))

    def _links(self, start: int, table: tuple[int, ...]) -> list[int]:
        found = []
        while start <= MOST_SECTOR:
            if start >= len(table) or len(found) > len(table):
                raise ValueError("a broken chain of sectors")
            found.append(start)
            start = table[start]
        return found

    def _chain(self, start: int) -> bytes:
        return b"".join(map(self._sector, self._links(start, self.next)))

    def stream(self, name: str) -> bytes:
        if name not in self.entries:
            raise ValueError(f"no stream {name}")
        start, size = self.entries[name]
        if size >= self.limit:
            return self._chain(start)[:size]
        return b"".join(self.bits[n * self.small : (n + 1) * self.small] for n in self._links(start, self.small_next))[:size]


def pieces(main: bytes, table: bytes) -> list[tuple[str, int, int]]:
    """(text, place of its first character, bytes of a character) of the document's pieces in order."""
    at, size = _u32(main, PIECES_AT), _u32(main, PIECES_AT + 4)
    own = table[at : at + size]
    while own[:1] == b"\x01":  # what edits left
        own = own[3 + _u16(own, 1) :]
    if own[:1] != b"\x02":
        raise ValueError("no table of pieces")
    plan = own[5 : 5 + _u32(own, 1)]
    n = (len(plan) - 4) // 12
    ends, left, out = struct.unpack_from(f"<{n + 1}I", plan), _u32(main, CHARS_AT), []
    for k in range(n):
        count = min(ends[k + 1] - ends[k], left)
        place = _u32(plan, 4 * (n + 1) + 8 * k + 2)
        wide = not place & 0x40000000
        place = place if wide else (place & 0x3FFFFFFF) // 2
        raw = main[place : place + count * (1 + wide)]
        out.append((raw.decode("utf-16-le", "replace") if wide else raw.decode("cp1252", "replace"), place, 1 + wide))
        left -= count
    return out


def properties(main: bytes, table: bytes) -> list[tuple[int, int, bytes]]:
    """(from, to, changes) of the paragraphs' properties, by places in the stream."""
    at, size = _u32(main, PARAGRAPHS_AT), _u32(main, PARAGRAPHS_AT + 4)
    plan, out = table[at : at + size], []
    n = (len(plan) - 4) // 8
    for k in range(max(0, n)):
        number = _u32(plan, 4 * (n + 1) + 4 * k)
        page = main[number * PAGE : (number + 1) * PAGE]
        runs = page[PAGE - 1]
        places = struct.unpack_from(f"<{runs + 1}I", page)
        for r in range(runs):
            offset = 2 * page[4 * (runs + 1) + 13 * r]
            own = b""
            if offset:
                begin, length = (offset + 2, 2 * page[offset + 1]) if not page[offset] else (offset + 1, 2 * page[offset] - 1)
                own = page[begin + 2 : begin + length]
            out.append((places[r], places[r + 1], own))
    return sorted(out)


def changes(own: bytes) -> dict[int, bytes]:
    """The operands of a paragraph's property changes, by their codes."""
    found, at = {}, 0
    while at + 2 <= len(own):
        code = _u16(own, at)
        size, at = OPERANDS[code >> 13], at + 2
        if size is None:
            size, at = (_u16(own, at) - 1, at + 2) if code == CELLS else (own[at], at + 1)
        found[code] = own[at : at + size]
        at += size
    return found


def merge_tails(cells: bytes) -> list[bool]:
    """Which cells of a row continue a horizontal merge."""
    n = cells[0] if cells else 0
    first = 1 + 2 * (n + 1)
    return [_u16(cells, first + 20 * k) & 3 == 2 if first + 20 * k + 2 <= len(cells) else False for k in range(n)]


def cleaned(text: str) -> str:
    return _CONTROL.sub("", _BARE_FIELD.sub("", _FIELD.sub(r"\1", text)))


def read_doc(data: bytes) -> str:
    """Paragraphs and rows of tables, a line each: blank ones dropped, cells parted by tabs, continued merges left out."""
    import bisect

    streams = Compound(data)
    main = streams.stream("WordDocument")
    flags = _u16(main, 0x0A)
    if _u16(main, 0) != IDENT or _u16(main, 2) < OLDEST:
        raise ValueError("a document older than Word 97")
    if flags & ENCRYPTED:
        raise BadFormat("The document has a password")
    table = streams.stream("1Table" if flags & SECOND_TABLE else "0Table")
    runs = properties(main, table)
    starts = [a for a, _, _ in runs]

    lines: list[str] = []
    text, cell, row = "", [], []  # of the paragraph, the cell and the row at hand
    for piece, place, width in pieces(main, table):
        done = 0
        for mark in re.finditer("[\r\x07\x0c]", piece):
            text, done = text + piece[done : mark.start()], mark.end()
            at = place + width * mark.start()
            k = bisect.bisect_right(starts, at) - 1
            own = changes(runs[k][2]) if k >= 0 and at < runs[k][1] else {}
            if own.get(ROW_END, b"\0") != b"\0":
                tails = merge_tails(own.get(CELLS, b""))
                lines.append("\t".join(c for n, c in enumerate(row) if n >= len(tails) or not tails[n]))
                cell, row = [], []
            elif own.get(IN_TABLE, b"\0") != b"\0" or mark[0] == "\x07":
                cell.append(cleaned(text))
                if mark[0] == "\x07":
                    row.append(" ".join(c for c in cell if c))
                    cell = []
            else:
                lines.append(cleaned(text))
            text = ""
        text += piece[done:]
    lines.append(cleaned(text))
    return "".join(f"{x}\n" for x in lines if x.strip())
