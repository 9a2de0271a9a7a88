"""The text that a page's content shows, where it shows it, and the lines that it forms.

Operators of text and of the coordinate system are followed through a page's content streams (which are one stream) and the
forms that it draws. Glyphs become pieces (text, place, advance); pieces are put in the order of their places: page,
direction of writing, y from the top down, x. A piece belongs to the line above it if it stands within NEAR of the y of
that line's first one; pieces of a line that a gap parts are chunks of their own.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from docloom.operators.pdf.fonts import Font
from docloom.operators.pdf.objects import END, Document, Lexer, Ref, Stream, Unread, Word

#: How far a piece may stand from its line's y.
NEAR = 2.5
MOST_NESTED = 24

Matrix = tuple[float, float, float, float, float, float]
UNIT: Matrix = (1.0, 0.0, 0.0, 1.0, 0.0, 0.0)


@dataclass(slots=True)
class Piece:
    page: int
    turn: int
    y: float
    x: float
    end: float
    size: float
    gap: float
    parts: list[str]
    text: str = field(init=False, default="")


def times(m: Matrix, n: Matrix) -> Matrix:
    """First m, then n."""
    a, b, c, d, e, f = m
    p, q, r, s, t, u = n
    return a * p + b * r, a * q + b * s, c * p + d * r, c * q + d * s, e * p + f * r + t, e * q + f * s + u


def joined(parts: list, font: Font | None) -> list:
    """Strings that moves of less than a gap part, as one: (string, the moves in units of the size). Codes of more than a byte stay with their strings."""
    if len(parts) < 2 or font is None or font.kind == "Type0":
        return parts
    most = 1000 * font.gap
    out: list = []
    raws, moves, at_end = [], 0, 0  # of the string so far, and the moves since its last part
    for part in parts:
        if not isinstance(part, bytes):
            at_end += part
            continue
        if raws and -most < at_end < most:
            raws.append(part)
            moves += at_end
        else:
            if raws:
                out.append((b"".join(raws), -moves / 1000))
            if at_end:
                out.append(at_end)
            raws, moves = [part], 0
        at_end = 0
    if raws:
        out.append((b"".join(raws), -moves / 1000))
    if at_end:
        out.append(at_end)
    return out


class Text:
    """The text state; a copy of it is saved with the coordinate system."""

    def __init__(self) -> None:
        self.font: Font | None = None
        self.size = self.between = self.words = self.leading = self.rise = 0.0
        self.stretch = 1.0


class Page:
    """Pieces of one page."""

    def __init__(self, doc: Document, page: dict, number: int, fonts: dict):
        self.doc, self.number, self.fonts = doc, number, fonts
        self.pieces: list[Piece] = []
        box = [float(doc.get(x)) for x in doc.get(page.get("CropBox")) or doc.get(page.get("MediaBox")) or (0, 0, 612, 792)]
        self.turned = int(doc.get(page.get("Rotate")) or 0) // 90 % 4
        low, left, high, right = min(box[1], box[3]), min(box[0], box[2]), max(box[1], box[3]), max(box[0], box[2])
        # device space as it is looked at: y from the top down
        self.device: Matrix = ((1, 0, 0, -1, -left, high), (0, 1, 1, 0, -low, -left), (-1, 0, 0, 1, right, -low), (0, -1, -1, 0, high, right))[self.turned]
        parts = doc.get(page.get("Contents"))
        parts = [parts] if isinstance(parts, Stream) else parts or []
        streams = [doc.get(p) for p in parts]
        if any(not isinstance(s, Stream) for s in streams):
            raise Unread("content that isn't there")
        self.run(b"\n".join(map(doc.unpacked, streams)), doc.get(page.get("Resources")) or {}, UNIT, Text(), 0)

    def font(self, resources: dict, name: str) -> Font:
        doc = self.doc
        ref = (doc.get(resources.get("Font")) or {}).get(name)
        key = ref if isinstance(ref, Ref) else (id(resources), name)
        if key not in self.fonts:
            found = doc.get(ref)
            if not isinstance(found, dict):
                raise Unread(f"no font {name}")
            self.fonts[key] = Font(doc, found, name)
        return self.fonts[key]

    def run(self, data: bytes, resources: dict, ctm: Matrix, state: Text, depth: int) -> None:
        """Follows a content stream."""
        if depth > MOST_NESTED:
            raise Unread("forms within forms without an end")
        lex, held, saved = Lexer(data, refs=False), [], []
        at = line = UNIT
        text = state

        def show(parts: list) -> None:
            """Strings, and moves back in thousandths of the size, from `at` on; `done` is the way since, in units of the size."""
            nonlocal at
            font, scale, done = text.font, text.size * text.stretch, 0.0
            put, spaced = None, bool(text.between or text.words)
            place = times(times((scale, 0, 0, text.size, 0, text.rise), at), times(ctm, self.device))
            if not spaced and not (place[0] and place[1]):
                parts = joined(parts, font)
            for part in parts:
                if not isinstance(part, (bytes, tuple)):
                    done -= part / 1000
                    continue
                if font is None:
                    raise Unread("text without a font")
                put = put or self.putting(place, font)
                if not spaced:
                    raw, moved = part if isinstance(part, tuple) else (part, 0.0)
                    letters, width = font.run(raw)
                    width += moved
                    if letters:
                        put(letters, done, width)
                    done += width
                    continue
                run, width = [], 0.0  # glyphs at once after another, and their advance
                for letters, own, blank in font.glyphs(part):
                    run.append(letters)
                    width += own
                    if extra := text.between + (text.words if blank else 0):
                        put("".join(run), done, width)
                        done += width + extra / (text.size or 1)
                        run, width = [], 0.0
                if run:
                    put("".join(run), done, width)
                done += width
            at = times((1, 0, 0, 1, done * scale, 0), at)

        def down(x: float, y: float) -> None:
            nonlocal at, line
            at = line = times((1, 0, 0, 1, x, y), line)

        while (x := lex.value()) is not END:
            if not isinstance(x, Word):
                held.append(x)
                continue
            op, args, held = bytes(x), held, []
            if op == b"BT":
                at = line = UNIT
            elif op == b"Tf":
                text.font, text.size = self.font(resources, args[0]), args[1]
            elif op == b"Td":
                down(*args)
            elif op == b"TD":
                text.leading = -args[1]
                down(*args)
            elif op == b"Tm":
                at = line = tuple(map(float, args))
            elif op == b"T*":
                down(0, -text.leading)
            elif op == b"Tj":
                show(args[:1])
            elif op == b"TJ":
                show(args[0])
            elif op == b"'":
                down(0, -text.leading)
                show(args[:1])
            elif op == b'"':
                text.words, text.between = args[0], args[1]
                down(0, -text.leading)
                show(args[2:3])
            elif op == b"Tc":
                text.between = args[0]
            elif op == b"Tw":
                text.words = args[0]
            elif op == b"TL":
                text.leading = args[0]
            elif op == b"Tz":
                text.stretch = args[0] / 100
            elif op == b"Ts":
                text.rise = args[0]
            elif op == b"cm":
                ctm = times(tuple(map(float, args)), ctm)
            elif op == b"q":
                saved.append((ctm, dict(text.__dict__)))
            elif op == b"Q":
                if saved:
                    ctm, text.__dict__ = saved.pop()
            elif op == b"gs":
                own = self.doc.get((self.doc.get(resources.get("ExtGState")) or {}).get(args[0])) or {}
                if "Font" in own:
                    raise Unread("a font set by a graphics state")
            elif op == b"Do":
                self.draw(args[0], resources, ctm, text, depth)
            elif op == b"BI":
                self.pass_image(lex)

    def draw(self, name: str, resources: dict, ctm: Matrix, text: Text, depth: int) -> None:
        form = self.doc.get((self.doc.get(resources.get("XObject")) or {}).get(name))
        if isinstance(form, Stream) and self.doc.get(form.head.get("Subtype")) == "Form":
            matrix = tuple(float(self.doc.get(x)) for x in self.doc.get(form.head.get("Matrix")) or UNIT)
            own = Text()
            own.__dict__ = dict(text.__dict__)
            self.run(self.doc.unpacked(form), self.doc.get(form.head.get("Resources")) or resources, times(matrix, ctm), own, depth + 1)

    def pass_image(self, lex: Lexer) -> None:
        """Goes to the end of an inline image."""
        while (x := lex.value()) is not END and not (isinstance(x, Word) and x == b"ID"):
            pass
        at = lex.at + 1
        while (end := lex.data.find(b"EI", at)) >= 0:
            if lex.data[end - 1 : end].isspace() and (lex.data[end + 2 : end + 3].isspace() or end + 2 == len(lex.data)):
                lex.at = end + 2
                return
            at = end + 2
        raise Unread("an inline image without an end")

    def putting(self, place: Matrix, font: Font) -> Callable[[str, float, float], None]:
        """Puts glyphs a way along the line from a place on; where they follow the ones before at once, they are added to their piece."""
        a, b, c, d, e, f = place
        turn = round(math.atan2(b, a) / (math.pi / 2)) % 4 if a or b else 0
        x0, y0 = ((e, f), (f, -e), (-e, -f), (-f, e))[turn]
        ahead, aside = ((a, b), (b, -a), (-a, -b), (-b, a))[turn]
        along, size = math.hypot(a, b), math.hypot(c, d)
        gap = along * font.gap
        pieces, number = self.pieces, self.number

        def put(letters: str, way: float, width: float) -> None:
            x, y = x0 + way * ahead, y0 + way * aside
            if pieces:
                last = pieces[-1]
                if last.turn == turn and abs(last.y - y) < 0.01 and -gap <= x - last.end <= last.gap:
                    last.parts.append(letters)
                    last.end, last.size, last.gap = x + along * width, max(last.size, size), gap
                    return
            pieces.append(Piece(number, turn, y, x, x + along * width, size, gap, [letters]))

        return put


def chunks_of(line: list[Piece]) -> list[str]:
    """The texts of a line's pieces from left to right, parted where gaps are; what is drawn twice at one place counts once."""
    out: list[str] = []
    end = gap = -math.inf
    drawn: list[Piece] = []
    for p in sorted(line, key=lambda p: p.x):
        if drawn and p.x - drawn[-1].x > p.gap:  # and so those before
            drawn = []
        drawn = [d for d in drawn if p.x - d.x <= p.gap] if drawn else drawn
        if drawn and any(d.text == p.text for d in drawn):
            continue
        drawn.append(p)
        if out and p.x - end <= gap:
            out[-1] += p.text
        else:
            out.append(p.text)
        end, gap = max(end, p.end), p.gap
    return out


def lines_of(pieces: list[Piece]) -> list[dict]:
    """(page, y, font, chunks) of the lines, in the order in which they are read."""
    lines: list[list[Piece]] = []
    for p in pieces:
        p.text = "".join(p.parts)
    for p in sorted((p for p in pieces if p.text.strip()), key=lambda p: (p.page, p.turn, p.y, p.x)):
        first = lines[-1][0] if lines else None
        if first is None or (first.page, first.turn) != (p.page, p.turn) or abs(p.y - first.y) > NEAR:
            lines.append([])
        lines[-1].append(p)
    return [{"page": x[0].page, "y": x[0].y, "font": max(p.size for p in x), "chunks": chunks_of(x)} for x in lines]


def read_lines(data: bytes) -> list[dict]:
    """The lines of a PDF file; `Unread` if its text can't be told as a whole and for certain."""
    doc, fonts, pieces = Document(data), {}, []
    for number, page in enumerate(doc.pages()):
        pieces += Page(doc, page, number, fonts).pieces
    return lines_of(pieces)
