"""PDF files that the queries and tests make: lines of text written in the ways in which programs write them."""

from __future__ import annotations

import zlib
from collections.abc import Callable

LINES_PER_PAGE = 50
TOP, STEP = 800, 14


def stream(body: bytes, head: bytes = b"") -> bytes:
    packed = zlib.compress(body)
    return b"<< /Length %d /Filter /FlateDecode %s >>\nstream\n%s\nendstream" % (len(packed), head, packed)


def pdf_of(objects: list[bytes], trailer: bytes = b"") -> bytes:
    """A file of objects 1, 2, ...; the first is the catalog."""
    out, places = bytearray(b"%PDF-1.5\n"), []
    for k, x in enumerate(objects):
        places.append(len(out))
        out += b"%d 0 obj\n%s\nendobj\n" % (k + 1, x)
    at = len(out)
    out += b"xref\n0 %d\n0000000000 65535 f \n" % (len(objects) + 1) + b"".join(b"%010d 00000 n \n" % p for p in places)
    return bytes(out + b"trailer\n<< /Size %d /Root 1 0 R %s >>\nstartxref\n%d\n%%%%EOF" % (len(objects) + 1, trailer, at))


def packed_pdf_of(objects: list[bytes]) -> bytes:
    """The same with everything but streams in an object stream, and a cross-reference stream."""
    inner = [k for k, x in enumerate(objects) if b"\nstream\n" not in x]
    holder, table = len(objects) + 1, len(objects) + 2
    bodies, head, at = [], [], 0
    for k in inner:
        head.append(b"%d %d" % (k + 1, at))
        bodies.append(objects[k])
        at += len(objects[k]) + 1
    first = b" ".join(head) + b" "
    out, places = bytearray(b"%PDF-1.5\n"), {k + 1: (2, holder, n) for n, k in enumerate(inner)}
    others = [(k + 1, x) for k, x in enumerate(objects) if k not in inner]
    others.append((holder, stream(first + b" ".join(bodies), b"/Type /ObjStm /N %d /First %d" % (len(inner), len(first)))))
    for number, x in others:
        places[number] = (1, len(out), 0)
        out += b"%d 0 obj\n%s\nendobj\n" % (number, x)
    at = len(out)
    places[table] = (1, at, 0)
    rows = [b"\0" + bytes(5)] + [bytes([kind]) + a.to_bytes(4, "big") + bytes([b & 255]) for kind, a, b in (places[k] for k in range(1, table + 1))]
    up, before = b"", bytes(6)
    for r in rows:  # each row as the difference to the one above
        up += b"\2" + bytes((x - y) & 255 for x, y in zip(r, before, strict=True))
        before = r
    out += b"%d 0 obj\n%s\nendobj\n" % (table, stream(up, b"/Type /XRef /Size %d /W [1 4 1] /Root 1 0 R /DecodeParms << /Predictor 12 /Columns 6 >>" % (table + 1)))
    return bytes(out + b"startxref\n%d\n%%%%EOF" % at)


PLAIN_FONT = b"<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica /Encoding /WinAnsiEncoding >>"


def document(pages: list[list[bytes]], fonts: list[bytes] = (PLAIN_FONT,), more: list[bytes] = (), resources: bytes = b"/Font << /F1 3 0 R >>") -> list[bytes]:
    """The objects of a file whose pages have these content streams; objects 3 and on are `fonts`, then `more`."""
    begin = 3 + len(fonts) + len(more)
    kids, rest = [], []
    for contents in pages:
        number = begin + len(rest)
        kids.append(b"%d 0 R" % number)
        refs = b" ".join(b"%d 0 R" % (number + 1 + k) for k in range(len(contents)))
        rest += [b"<< /Type /Page /Parent 2 0 R /Contents [%s] >>" % refs, *map(stream, contents)]
    tree = b"<< /Type /Pages /Kids [%s] /Count %d /MediaBox [0 0 595 842] /Resources << %s >> >>" % (b" ".join(kids), len(pages), resources)
    return [b"<< /Type /Catalog /Pages 2 0 R >>", tree, *fonts, *more, *rest]


def literal(text: str) -> bytes:
    return escaped(text.encode("cp1252", "replace"))


def escaped(raw: bytes) -> bytes:
    return b"(" + (raw if raw.isalnum() else raw.replace(b"\\", b"\\\\").replace(b"(", b"\\(").replace(b")", b"\\)")) + b")"


def paged(lines: list[str]) -> list[list[str]]:
    return [lines[k : k + LINES_PER_PAGE] for k in range(0, len(lines), LINES_PER_PAGE)] or [[]]


def steps(lines: list[str]) -> bytes:
    """Each line a step below the one before."""
    return b"BT /F1 12 Tf 1 0 0 1 50 %d Tm " % TOP + (b" 0 -%d Td " % STEP).join(literal(x) + b" Tj" for x in lines) + b" ET"


def kerned(line: str) -> bytes:
    """A line's words parted by gaps instead of blanks, each moved together a little in its middle."""
    words = [escaped(w[: len(w) // 2]) + b" 30 " + escaped(w[len(w) // 2 :]) for w in line.encode("cp1252", "replace").split(b" ")]
    return b"[" + b" -300 ".join(words) + b"] TJ"


def pdf_bytes(lines: list[str]) -> bytes:
    """A file with a line of text for each string."""
    return pdf_of(document([[steps(x)] for x in paged(lines)]))


def kerned_pdf(lines: list[str]) -> bytes:
    return pdf_of(document([[b"BT /F1 12 Tf %d TL 50 %d Td " % (STEP, TOP) + b" T* ".join(map(kerned, x)) + b" ET"] for x in paged(lines)]))


def quoted_pdf(lines: list[str]) -> bytes:
    """Lines shown by the operator that goes to the next line first, at the scale of the coordinate system."""
    return pdf_of(document([[b"q 2 0 0 2 100 0 cm BT /F1 6 Tf %d TL 10 %d Td " % (STEP // 2, TOP // 2) + b" ".join(literal(t) + b" '" for t in x) + b" ET Q"] for x in paged(lines)]))


def unordered_pdf(lines: list[str]) -> bytes:
    """Lines drawn from the last to the first, the second half of each before the first, each at its own place."""

    def drawn(n: int, line: str) -> bytes:
        words = line.split(" ")
        half, y = len(words) // 2, TOP - STEP * n
        left, right = " ".join(words[:half]), " ".join(words[half:])
        return b"BT /F1 12 Tf 1 0 0 1 %d %d Tm %s Tj ET BT /F1 12 Tf 1 0 0 1 50 %d Tm %s Tj ET" % (60 + 12 * len(left), y, literal(right), y, literal(left))

    return pdf_of(document([[b"\n".join(drawn(n, t) for n, t in reversed(list(enumerate(x))))] for x in paged(lines)]))


def mapped_pdf(lines: list[str]) -> bytes:
    """Codes of the file's own for all characters, two bytes each, with a map to Unicode."""
    code = {c: b"%04X" % (k + 1) for k, c in enumerate(sorted(set("".join(lines))))}
    pairs = [b"<%s> <%s>" % (k, c.encode("utf-16-be").hex().encode()) for c, k in code.items()]
    blocks = [pairs[k : k + 100] for k in range(0, len(pairs), 100)]
    cmap = b"1 begincodespacerange <0000> <FFFF> endcodespacerange\n" + b"\n".join(b"%d beginbfchar\n%s\nendbfchar" % (len(x), b"\n".join(x)) for x in blocks)
    font = b"<< /Type /Font /Subtype /Type0 /BaseFont /Own /Encoding /Identity-H /DescendantFonts [4 0 R] /ToUnicode 5 0 R >>"
    inner = b"<< /Type /Font /Subtype /CIDFontType2 /BaseFont /Own /DW 600 /CIDSystemInfo << /Registry (Adobe) /Ordering (Identity) /Supplement 0 >> >>"
    show = lambda t: b"<" + b"".join(map(code.__getitem__, t)) + b"> Tj"
    pages = [[b"BT /F1 12 Tf 50 %d Td " % TOP + (b" 0 -%d Td " % STEP).join(map(show, x)) + b" ET"] for x in paged(lines)]
    return pdf_of(document(pages, fonts=[font], more=[inner, stream(cmap)]))


def formed_pdf(lines: list[str]) -> bytes:
    """Objects in streams; each page's content in two streams that cut a text block, its first lines in a form."""
    pages = paged(lines)
    forms = [stream(steps(x[: len(x) // 2]), b"/Type /XObject /Subtype /Form /BBox [0 0 595 842]") for x in pages]
    names = b" ".join(b"/X%d %d 0 R" % (k, 4 + k) for k in range(len(pages)))
    contents = []
    for k, x in enumerate(pages):
        half = len(x) // 2
        contents.append([b"q /X%d Do Q BT /F1 12 Tf 1 0 0 1 50 %d" % (k, TOP - STEP * half), b"Tm " + (b" 0 -%d Td " % STEP).join(literal(t) + b" Tj" for t in x[half:]) + b" ET"])
    return packed_pdf_of(document(contents, more=forms, resources=b"/Font << /F1 3 0 R >> /XObject << %s >>" % names))


WRITERS: list[Callable[[list[str]], bytes]] = [pdf_bytes, kerned_pdf, quoted_pdf, unordered_pdf, mapped_pdf, formed_pdf]
