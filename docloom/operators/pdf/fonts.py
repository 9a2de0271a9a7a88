"""What the codes of a font stand for and how wide they are.

A code's text comes from the font's own map to Unicode, else from its encoding and glyph names. A code that neither knows
is `Unread`: the file's text can't be told for certain.
"""

from __future__ import annotations

import functools
import re
import struct
import unicodedata
from collections.abc import Sequence

from docloom.operators.pdf.objects import END, Document, Lexer, Name, Stream, Unread, Word

#: The least gap between words as a share of a blank's advance and of the font's average advance.
OF_BLANK = 0.5
OF_AVERAGE = 0.3
#: Bytes of a string, and how many of them, whose text and advance a font keeps.
SHORT, MOST_KEPT = 16, 10_000
#: Names of glyphs that no rule below gives, and their characters.
_NAMED = dict(
    pair.split("=", 1)
    for pair in (
        "space=  exclam=! quotedbl=\" numbersign=# dollar=$ percent=% ampersand=& quotesingle=' parenleft=( parenright=) asterisk=* plus=+ comma=, hyphen=- period=. slash=/ "
        "zero=0 one=1 two=2 three=3 four=4 five=5 six=6 seven=7 eight=8 nine=9 colon=: semicolon=; less=< equal== greater=> question=? at=@ "
        "bracketleft=[ backslash=\\ bracketright=] asciicircum=^ underscore=_ grave=` braceleft={ bar=| braceright=} asciitilde=~ "
        "exclamdown=¡ cent=¢ sterling=£ currency=¤ yen=¥ brokenbar=¦ section=§ dieresis=¨ copyright=© ordfeminine=ª guillemotleft=« logicalnot=¬ registered=® macron=¯ degree=° plusminus=± "
        "acute=´ mu=µ paragraph=¶ periodcentered=· cedilla=¸ ordmasculine=º guillemotright=» onequarter=¼ onehalf=½ threequarters=¾ questiondown=¿ multiply=× divide=÷ "
        "AE=Æ Eth=Ð Oslash=Ø Thorn=Þ germandbls=ß ae=æ eth=ð oslash=ø thorn=þ dotlessi=ı Lslash=Ł lslash=ł OE=Œ oe=œ "
        "quoteleft=‘ quoteright=’ quotesinglbase=‚ quotedblleft=“ quotedblright=” quotedblbase=„ dagger=† daggerdbl=‡ bullet=• ellipsis=… perthousand=‰ guilsinglleft=‹ guilsinglright=› "
        "endash=– emdash=— trademark=™ Euro=€ fraction=⁄ florin=ƒ minus=− circumflex=ˆ tilde=˜ breve=˘ dotaccent=˙ ring=˚ hungarumlaut=˝ ogonek=˛ caron=ˇ "
        "fi=fi fl=fl ff=ff ffi=ffi ffl=ffl nbspace=  softhyphen=­ afii61352=№ afii10023=Ё afii10071=ё"
    ).split(" ")
    if "=" in pair
) | {"space": " ", "equal": "="}
_ACCENTS = {"grave": "̀", "acute": "́", "circumflex": "̂", "tilde": "̃", "macron": "̄", "breve": "̆", "dotaccent": "̇", "dieresis": "̈", "ring": "̊", "hungarumlaut": "̋", "caron": "̌", "cedilla": "̧", "commaaccent": "̧", "ogonek": "̨"}
#: What the standard encoding has beyond ASCII.
_STANDARD = {0x27: "’", 0x60: "‘"} | dict(zip([*range(0xA1, 0xB0), *range(0xB1, 0xB5), *range(0xB6, 0xBE), 0xBF, *range(0xC1, 0xC9), 0xCA, 0xCB, *range(0xCD, 0xD1), 0xE1, 0xE3, *range(0xE8, 0xEC), 0xF1, 0xF5, *range(0xF8, 0xFC)], "¡ ¢ £ ⁄ ¥ ƒ § ¤ ' “ « ‹ › fi fl – † ‡ · ¶ • ‚ „ ” » … ‰ ¿ ` ´ ˆ ˜ ¯ ˘ ˙ ¨ ˚ ¸ ˝ ˛ ˇ — Æ ª Ł Ø Œ º æ ı ł ø œ ß".split(" "), strict=True))
#: Advances of fonts that don't state them, in thousandths of the size: about those of the common sans-serif face.
_ABOUT = {c: w for w, cs in ((222, "ijl'|"), (278, " .,:;!/\\[]ftIr"), (333, "()-`\"*"), (722, "CDHNRUwБДЖМФЦШЩЫЮжмшщыю"), (667, "ABEKPSVXY&"), (778, "GOQ"), (833, "Mm"), (889, "%"), (944, "W"), (1015, "@")) for c in cs}


def of_name(name: str) -> str | None:
    """The text of a glyph by its name."""
    name = name.split(".")[0] or name
    if name in _NAMED:
        return _NAMED[name]
    if len(name) == 1:
        return name
    if m := re.fullmatch(r"uni((?:[0-9A-F]{4})+)|u([0-9A-F]{4,6})", name):
        codes = [int(m[1][k : k + 4], 16) for k in range(0, len(m[1]), 4)] if m[1] else [int(m[2], 16)]
        return "".join(map(chr, codes)) if all(c < 0xD800 or 0xDFFF < c < 0x110000 for c in codes) else None
    if m := re.fullmatch(r"afii100(\d\d)", name):  # Cyrillic letters in alphabetical order, with a place of its own for one
        k = int(m[1])
        for first, odd, base in ((17, 23, 0x410), (65, 71, 0x430)):
            if first <= k < first + 33 and k != odd:
                return chr(base + k - first - (k > odd))
        return None
    if name[0].isascii() and name[0].isalpha() and name[1:] in _ACCENTS:
        whole = unicodedata.normalize("NFC", name[0] + _ACCENTS[name[1:]])
        return whole if len(whole) == 1 else None
    parts = name.split("_")
    if len(parts) > 1:
        found = [of_name(p) if p else None for p in parts]
        return "".join(found) if None not in found else None
    return None


@functools.cache
def encoding(name: str) -> dict[int, str]:
    """code -> text of a named encoding."""
    codec = {"WinAnsiEncoding": "cp1252", "MacRomanEncoding": "mac_roman"}.get(name)
    if codec:
        out = {c: bytes([c]).decode(codec, "replace") for c in range(0x20, 0x100)}
        if codec == "cp1252":
            out |= {c: "•" for c in out if out[c] == "�" or c == 0x7F} | {0xA0: " ", 0xAD: "-"}
        return out
    if name == "StandardEncoding":
        return {c: chr(c) for c in range(0x20, 0x7F)} | _STANDARD
    raise Unread(f"encoding {name}")


def _number(raw: bytes) -> int:
    return int.from_bytes(raw, "big")


def _text(raw: bytes) -> str:
    return raw.decode("utf-16-be", "replace") if len(raw) > 1 else raw.decode("latin-1")


class CMap:
    """Code ranges, and what codes map to: texts (a map to Unicode) or numbers of glyphs (an encoding)."""

    def __init__(self, data: bytes):
        self.spaces: list[tuple[int, int, int]] = []
        self.texts: dict[int, str] = {}
        self.glyphs: list[tuple[int, int, int]] = []
        lex, held = Lexer(data, refs=False), []
        while (x := lex.value()) is not END:
            if not isinstance(x, Word):
                held.append(x)
                continue
            if x == b"usecmap":
                raise Unread("a map that needs another one")
            if x == b"endcodespacerange":
                self.spaces += [(len(a), _number(a), _number(b)) for a, b in zip(held[::2], held[1::2], strict=False)]
            elif x == b"endbfchar":
                self.texts |= {_number(a): _text(b) for a, b in zip(held[::2], held[1::2], strict=False)}
            elif x == b"endbfrange":
                for a, b, to in zip(held[::3], held[1::3], held[2::3], strict=False):
                    first, last = _number(a), min(_number(b), _number(a) + 0xFFFF)
                    for k in range(last - first + 1):
                        if isinstance(to, list):
                            if k < len(to):
                                self.texts[first + k] = _text(to[k])
                        else:
                            self.texts[first + k] = _text((_number(to) + k).to_bytes(len(to), "big"))
            elif x == b"endcidrange":
                self.glyphs += [(_number(a), _number(b), to) for a, b, to in zip(held[::3], held[1::3], held[2::3], strict=False)]
            elif x == b"endcidchar":
                self.glyphs += [(_number(a), _number(a), to) for a, to in zip(held[::2], held[1::2], strict=False)]
            held = []

    def codes(self, raw: bytes) -> list[int]:
        """The codes of a string, each as long as its range says."""
        out, at = [], 0
        while at < len(raw):
            for n in (1, 2, 3, 4):
                code = _number(raw[at : at + n])
                if any(size == n and low <= code <= high for size, low, high in self.spaces):
                    break
            else:
                raise Unread("a code outside its font's ranges")
            out.append(code)
            at += n
        return out

    def glyph(self, code: int) -> int:
        return next((to + code - a for a, b, to in self.glyphs if a <= code <= b), 0)


class Font:
    """`glyphs(string)`: (text, advance in units of the size, whether the code is the one-byte blank) of each code."""

    def __init__(self, doc: Document, font: dict, fallback: str):
        get = doc.get
        self.name = str(get(font.get("BaseFont")) or fallback)
        self.kind = get(font.get("Subtype"))
        self.known: dict[int, tuple[str, float, bool]] = {}
        self.texts: dict[int, str] = {}
        self.advances: dict[int, float] = {}
        self.runs: dict[bytes, tuple[str, float]] = {}
        own = get(font.get("ToUnicode"))
        self.map = CMap(doc.unpacked(own)).texts if isinstance(own, Stream) else {}
        self.ranges: CMap | None = None
        self.unit = 0.001
        if self.kind == "Type0":
            self._composite(doc, font)
        else:
            self._simple(doc, font)
        blank = self.width(0x20) if self.kind != "Type0" or self.map.get(0x20) == " " else next((self.width(c) for c, t in self.map.items() if t == " "), 0.0)
        stated = [w for w in self.widths.values() if w > 0]
        self.average = self.unit * (sum(stated) / len(stated) if stated else 500)
        self.blank = blank or 0.5 * self.average
        self.gap = min(OF_BLANK * self.blank, OF_AVERAGE * self.average)

    def _composite(self, doc: Document, font: dict) -> None:
        get, how = doc.get, doc.get(font.get("Encoding"))
        if isinstance(how, Stream):
            self.ranges = CMap(doc.unpacked(how))
        elif how not in ("Identity-H", "Identity-V"):
            raise Unread(f"encoding {how} of font {self.name}")
        inner = get(get(font["DescendantFonts"])[0])
        self.default, self.widths, self.letters = get(inner.get("DW", 1000)), {}, {}
        held = [get(x) for x in get(inner.get("W")) or []]
        while held:
            first, second = held[0], held[1]
            if isinstance(second, list):
                self.widths |= {first + k: get(w) for k, w in enumerate(second)}
                held = held[2:]
            else:
                self.widths |= dict.fromkeys(range(first, min(second, first + 0xFFFF) + 1), held[2])
                held = held[3:]

    def _simple(self, doc: Document, font: dict) -> None:
        get = doc.get
        about = get(font.get("FontDescriptor")) or {}
        embedded = any(k in about for k in ("FontFile", "FontFile2", "FontFile3")) or self.kind == "Type3"
        symbolic = bool(get(about.get("Flags", 0)) & 4) or re.search("Symbol|Dingbats|Wingdings", self.name) is not None
        how = get(font.get("Encoding"))
        base, changes = (how, []) if isinstance(how, Name) else (get(how.get("BaseEncoding")), get(how.get("Differences")) or []) if isinstance(how, dict) else (None, [])
        if base is None:  # the font's own; that of a plain font is the standard one, that of a symbol font isn't known
            self.letters = {} if symbolic or self.kind == "Type3" else dict(encoding("StandardEncoding"))
            if embedded and self.kind == "TrueType" and not symbolic:
                self.letters = {c: t for c, t in encoding("WinAnsiEncoding").items() if c < 0x7F}
        else:
            self.letters = dict(encoding(base))
        code = 0
        for x in map(get, changes):
            if isinstance(x, Name):
                found = of_name(x)
                self.letters.pop(code, None) if found is None else self.letters.update({code: found})
                code += 1
            else:
                code = x
        widths, first = get(font.get("Widths")) or [], get(font.get("FirstChar", 0))
        self.widths = {first + k: get(w) for k, w in enumerate(widths)}
        self.default = get(about.get("MissingWidth", 0)) if widths else None
        if self.kind == "Type3":
            self.unit = abs(get(font["FontMatrix"])[0])

    def width(self, code: int) -> float:
        if self.default is None:  # a font of the reader's own
            text = self.letters.get(code, "n")
            return 0.6 if "Courier" in self.name else _ABOUT.get(text, 556) * 0.001
        number = self.ranges.glyph(code) if self.ranges and self.ranges.glyphs else code
        return self.unit * self.widths.get(number, self.default)

    def _glyph(self, code: int) -> tuple[str, float, bool]:
        text = self.map.get(code, self.letters.get(code))
        if not text or "\0" in text or "�" in text:
            raise Unread(f"code {code} of font {self.name} has no character")
        return text, self.width(code), code == 0x20 and self.kind != "Type0"

    def _codes(self, raw: bytes) -> Sequence[int]:
        if self.kind != "Type0":
            return raw
        if self.ranges:
            return self.ranges.codes(raw)
        if len(raw) % 2:
            raise Unread("half a code")
        return struct.unpack(f">{len(raw) // 2}H", raw)

    def _learned(self, raw: bytes) -> Sequence[int]:
        """The codes of a string, all of them known from now on."""
        codes = self._codes(raw)
        for code in set(codes).difference(self.known) if len(codes) > 1 else codes:
            if code not in self.known:
                text, width, _ = self.known[code] = self._glyph(code)
                self.texts[code], self.advances[code] = text, width
        return codes

    def glyphs(self, raw: bytes) -> list[tuple[str, float, bool]]:
        return [self.known[c] for c in self._learned(raw)]

    def run(self, raw: bytes) -> tuple[str, float]:
        """(text, advance) of a whole string; those of short ones, which come again, are kept."""
        found = self.runs.get(raw)
        if found is None:
            codes = self._learned(raw)
            found = "".join(map(self.texts.__getitem__, codes)), sum(map(self.advances.__getitem__, codes))
            if len(raw) <= SHORT and len(self.runs) < MOST_KEPT:
                self.runs[raw] = found
        return found
