"""PDF text: object graph, fonts, text state and the order of lines; what can't be told for certain goes to OCR."""

from __future__ import annotations

import random
import re
import sys
import zlib

import pytest

from docloom.operators import extract
from docloom.operators.extract import read_pages
from docloom.operators.pdf import fonts, objects
from docloom.plans import documents, pdfs
from docloom.plans.pdfs import PLAIN_FONT, document, packed_pdf_of, pdf_of, stream

LINES = ["Hello (world) of \\ text", "second line é ñ here", "1. a list", "and more - words-", "last"] * 25


def texts(data: bytes) -> list[str] | str:
    lines, why = read_pages(data)
    return why or [" ".join(c.strip() for c in x["chunks"] if c.strip()) for x in lines]


def page(body: bytes, font: bytes = PLAIN_FONT, **more) -> bytes:
    return pdf_of(document([[body]], fonts=[font], **more))


def shown(body: bytes, **more) -> list[str] | str:
    return texts(page(b"BT /F1 12 Tf 14 TL 1 0 0 1 50 800 Tm " + body + b" ET", **more))


@pytest.mark.parametrize("write", pdfs.WRITERS)
def test_writers(write):
    data = write(LINES)
    assert texts(data) == LINES and not objects.Document(data).rebuilt
    assert {x["page"] for x in read_pages(data)[0]} == {0, 1, 2}


def test_text_state():
    assert shown(b"[(Supply) -300 (contract) -300 (number)] TJ") == ["Supply contract number"]
    assert shown(b"[(Sup) 20 (ply) -20 (con) 15 (tract)] TJ") == ["Supplycontract"]
    assert shown(b"(1. one) Tj T* (2. two) Tj (3) ' 1 0 (4) \"") == ["1. one", "2. two", "3", "4"]
    assert shown(b"(a) Tj 0 -20 TD (b) Tj T* (c) Tj") == ["a", "b", "c"]
    assert shown(b"(a) Tj 200 0 Td (b) Tj 20 2 Td (c) Tj") == ["a b c"] and shown(b"(a) Tj 20 3 Td (b) Tj") == ["b", "a"]
    assert shown(b"8 Tc (abc) Tj") == ["a b c"] and shown(b"20 Tw (a b) Tj 0 Tw 60 0 Td (c) Tj") == ["a b c"]
    assert shown(b"50 Tz (wide) Tj 3 Ts (r) Tj") == ["r", "wide"] and shown(b"1 Ts (r) Tj") == ["r"]
    assert shown(b"(nested (brackets) \\(and\\) \\101\\\n\\x) Tj") == ["nested (brackets) (and) Ax"]
    assert shown(b"<48 65 6C6C 6F2> Tj") == ["Hello"]


def test_blocks_begin_anew():
    """A matrix doesn't go on over text blocks; the order is that of places, not of drawing."""
    assert texts(page(b"BT /F1 12 Tf 50 700 Td (second) Tj ET BT 50 720 Td (first) Tj ET")) == ["first", "second"]
    ys = [x["y"] for x in read_pages(page(b"BT /F1 12 Tf 50 700 Td (second) Tj ET BT 50 720 Td (first) Tj ET"))[0]]
    assert ys == [pytest.approx(122), pytest.approx(142)]
    lines = [b"BT /F1 12 Tf 1 0 0 1 50 %d Tm (line %d) Tj ET" % (800 - 14 * k, k) for k in range(9)]
    random.Random(1).shuffle(lines)
    assert texts(page(b"\n".join(lines))) == [f"line {k}" for k in range(9)]


def test_coordinate_systems():
    body = b"q 0.5 0 0 0.5 0 0 cm BT /F1 24 Tf 100 1600 Td (a b) Tj ET Q q 1 0 0 1 0 -14 cm BT /F1 12 Tf 50 800 Td (c) Tj ET Q Q"
    got = read_pages(page(body))[0]
    assert [(x["chunks"], round(x["y"]), x["font"]) for x in got] == [(["a b"], 42, 12), (["c"], 56, 12)]
    for turn, matrix, step in ((90, b"0 1 -1 0 100 50", b"0 1 -1 0 114 50"), (180, b"-1 0 0 -1 500 100", b"-1 0 0 -1 500 114"), (270, b"0 -1 1 0 100 700", b"0 -1 1 0 86 700")):
        objs = document([[b"BT /F1 12 Tf %s Tm (first line) Tj %s Tm (second) Tj ET" % (matrix, step)]])
        turned = [x.replace(b"/MediaBox", b"/Rotate %d /MediaBox" % turn) for x in objs]
        assert texts(pdf_of(turned)) == ["first line", "second"]
        assert texts(pdf_of(objs)) == ["first line", "second"]  # turned text on a page that isn't


def test_what_is_drawn_twice_counts_once():
    assert texts(page(b"BT /F1 12 Tf 50 700 Td (bold) Tj ET BT /F1 12 Tf 50.4 700 Td (bold) Tj ET")) == ["bold"]
    assert texts(page(b"BT /F1 12 Tf 50 700 Td (so) Tj ET BT /F1 12 Tf 90 700 Td (so) Tj ET")) == ["so so"]


def simple(encoding: bytes = b"", about: bytes = b"", kind: bytes = b"TrueType", more: bytes = b"") -> bytes:
    descriptor = b"/FontDescriptor << /Type /FontDescriptor %s >>" % about if about else b""
    return b"<< /Type /Font /Subtype /%s /BaseFont /Own %s %s %s >>" % (kind, encoding, descriptor, more)


def test_simple_fonts():
    word = "Договор".encode("cp1251")
    names = b"/Encoding << /Differences [192 %s 224 %s] >>" % (b" ".join(b"/afii%d" % (10017 + k + (k > 5)) for k in range(32)), b" ".join(b"/afii%d" % (10065 + k + (k > 5)) for k in range(32)))
    assert shown(b"(" + word + b") Tj", font=simple(names)) == ["Договор"]
    unis = b"/Encoding << /Differences [1 /uni0414 /u043E /a.alt /f_i /eacute /Gbreve /space /zero /uni04140435] >>"
    assert shown(b"<010203040506070809> Tj", font=simple(unis)) == ["ДоafiéĞ 0Де"]
    for encoding in (b"/Encoding << /Differences [192 /g17 /g18] >>", b"/Encoding /Own-Cyrillic", b""):
        got = shown(b"(" + word + b") Tj", font=simple(encoding, b"/Flags 4 /FontFile2 9 0 R"))
        assert isinstance(got, str) and ("no character" in got or "Own-Cyrillic" in got)
    assert shown(b"(plain) Tj", font=simple(b"", b"/Flags 32 /FontFile2 9 0 R")) == ["plain"]
    assert isinstance(shown(b"(\xc4) Tj", font=simple(b"", b"/Flags 32 /FontFile2 9 0 R")), str)
    assert isinstance(shown(b"(abc) Tj", font=b"<< /Type /Font /Subtype /Type1 /BaseFont /Symbol >>"), str)
    assert shown(b"(it's \xae) Tj", font=b"<< /Type /Font /Subtype /Type1 /BaseFont /Times-Roman >>") == ["it’s fi"]
    assert shown(b"(\x80\x93\xa0\xad\x81) Tj") == ["€“ -•"] and shown(b"(\x8e) Tj", font=simple(b"/Encoding /MacRomanEncoding")) == ["é"]
    widths = simple(b"/Encoding /WinAnsiEncoding", b"/Flags 32 /MissingWidth 500", more=b"/FirstChar 97 /Widths [1000 100]")
    assert shown(b"(ab) Tj 13 0 Td (b) Tj", font=widths) == ["abb"] and shown(b"(ab) Tj 20 0 Td (b) Tj", font=widths) == ["ab b"]
    third = b"<< /Type /Font /Subtype /Type3 /FontMatrix [0.01 0 0 0.01 0 0] /FirstChar 1 /Widths [50 50] /Encoding << /Differences [1 /a /b] >> >>"
    assert shown(b"<0102> Tj 20 0 Td <01> Tj", font=third) == ["ab a"]


def test_glyph_names():
    assert [fonts.of_name(n) for n in ("A", "Aring", "scedilla", "Zcaron", "afii10023", "afii10071", "afii10049", "afii10097", "afii10072", "quotedblleft", "uniD800", "g12", "afii10999"[:8], "one.oldstyle")] == ["A", "Å", "ş", "Ž", "Ё", "ё", "Я", "я", "ж", "“", None, None, None, "1"]


def composite(cmap: bytes | None, encoding: bytes = b"/Identity-H", inner: bytes = b"/DW 1000") -> dict:
    font = b"<< /Type /Font /Subtype /Type0 /BaseFont /Own /Encoding %s /DescendantFonts [4 0 R] %s >>" % (encoding, b"/ToUnicode 5 0 R" if cmap else b"")
    return {"font": font, "more": [b"<< /Type /Font /Subtype /CIDFontType2 %s >>" % inner, stream(cmap or b"")]}


def test_composite_fonts():
    cmap = b"1 begincodespacerange <0000> <FFFF> endcodespacerange 2 beginbfchar <0001> <0414> <0002> <D83DDE00> endbfchar 2 beginbfrange <0010> <0012> <0061> <0020> <0021> [<0041> <00420043>] endbfrange"
    assert shown(b"<0001000200100011001200200021> Tj", **composite(cmap)) == ["Д😀abcABC"]
    assert "no character" in shown(b"<00010099> Tj", **composite(cmap))
    assert "no character" in shown(b"<00240025> Tj", **composite(None))
    assert "half" in shown(b"<000100> Tj", **composite(cmap))
    assert "UniGB" in shown(b"<0001> Tj", **composite(cmap, b"/UniGB-UCS2-H"))
    assert shown(b"<0010> Tj 7 0 Td <0011> Tj 20 0 Td <0012> Tj", **composite(cmap, inner=b"/DW 100 /W [16 [500 600] 18 20 700]")) == ["ab c"]
    own = b"2 begincodespacerange <00> <7F> <8000> <FFFF> endcodespacerange 1 begincidrange <8000> <80FF> 5 endcidrange"
    more = composite(b"2 beginbfchar <41> <0041> <8001> <0416> endbfchar")
    more["more"].append(stream(own))
    more["font"] = more["font"].replace(b"/Identity-H", b"6 0 R")
    assert shown(b"<41800141> Tj", **more) == ["AЖA"]


def test_undecodable_text_never_ends_as_text(spark):
    good = pdfs.pdf_bytes(["A readable line"])
    bad = [
        page(b"BT /F1 12 Tf 50 800 Td (fine) Tj <0024> Tj ET", **composite(None)), page(b"BT /F1 12 Tf (\xc4\xee) Tj ET", font=simple(b"", b"/Flags 4 /FontFile2 9 0 R")),
        page(b"BT /F2 12 Tf (x) Tj ET"), page(b"BT (no font) Tj ET"), page(b"BT /F1 12 Tf (open ET"), good.replace(b"/Filter /FlateDecode", b"/Filter /LZWDecode"),
        pdf_of([*document([[b"BT /F1 12 Tf 50 800 Td (first) Tj ET"], [b"BT /F1 12 Tf 50 800 Td (second) Tj ET"]])[:-1]]),
        pdf_of([x[:-30] + b"\nendstream" if k == 4 else x for k, x in enumerate(document([[b"BT /F1 12 Tf 50 800 Td (first line and more of it) Tj ET"]]))]),
        good.replace(b"/Root 1 0 R", b"/Root 1 0 R /Encrypt << >>"), page(b"BI /W 1 ID xxxx"), page(b"/X0 Do", resources=b"/XObject << /X0 3 0 R >>", font=stream(b"/X0 Do", b"/Subtype /Form")),
    ]
    frame = spark.createDataFrame([(k, bytearray(x)) for k, x in enumerate([good, *bad])], "id long, data binary")
    got = {r.id: (r.error_kind, r.text) for r in extract.extracted(frame).collect()}
    assert got == {0: (None, "A readable line\n")} | {k + 1: ("ocr", None) for k in range(len(bad))}


def test_object_graph():
    body = [[b"BT /F1 12 Tf 50 800 Td (one) Tj ET"], [b"BT /F1 12 Tf 50 800 Td (two) Tj ET"]]
    objs = document(body)
    good = pdf_of(objs)
    assert texts(good) == texts(packed_pdf_of(objs)) == ["one", "two"]
    # the order is the page tree's, not the file's
    assert texts(pdf_of([x.replace(b"4 0 R 6 0 R", b"6 0 R 4 0 R") if b"/Kids" in x else x for x in objs])) == ["two", "one"]
    nested = [x.replace(b"[4 0 R 6 0 R]", b"[8 0 R 6 0 R]") for x in objs] + [b"<< /Type /Pages /Kids [4 0 R] >>"]
    assert texts(pdf_of(nested)) == ["one", "two"]
    # a later revision replaces a page's content
    at = len(good)
    later = good + b"\n5 0 obj\n" + stream(b"BT /F1 12 Tf 50 800 Td (new) Tj ET") + b"\nendobj\n"
    table = b"xref\n5 1\n%010d 00000 n \ntrailer\n<< /Size 8 /Root 1 0 R /Prev %d >>\nstartxref\n%d\n%%%%EOF" % (at + 1, int(re.findall(rb"startxref\n(\d+)", good)[0]), len(later))
    assert texts(later + table) == ["new", "two"]
    # an object that isn't shown isn't read
    assert texts(pdf_of([*objs, stream(b"BT /F1 12 Tf (stray) Tj ET"), b"<< /Subtype /Image >>"])) == ["one", "two"]


def test_damaged_tables_are_rebuilt():
    objs = document([[b"BT /F1 12 Tf 50 800 Td (one) Tj ET"]])
    good, packed = pdf_of(objs), packed_pdf_of(objs)
    for data in (good.replace(b"startxref", b"startxxxx"), re.sub(rb"startxref\n\d+", b"startxref\n7", good), good[: good.index(b"xref")], b"junk\n" + good, re.sub(rb"startxref\n\d+", b"startxref\n7", packed)):
        assert texts(data) == ["one"] and objects.Document(data).rebuilt
    wrong = good.replace(b"/Length ", b"/Length 9")
    assert texts(wrong) == ["one"]


def test_filters():
    body = b"BT /F1 12 Tf 50 800 Td (packed) Tj ET"
    import base64

    for raw, how in ((body.hex().encode() + b">", b"/ASCIIHexDecode"), (base64.a85encode(zlib.compress(body)) + b"~>", b"[/ASCII85Decode /FlateDecode]"), (body, b"[]")):
        objs = document([[b""]])
        objs[-1] = b"<< /Length %d /Filter %s >>\nstream\n%s\nendstream" % (len(raw), how, raw)
        assert texts(pdf_of(objs)) == ["packed"]
    rng = random.Random(3)
    rows = [bytes(rng.randrange(256) for _ in range(6)) for _ in range(12)]
    out, before = b"", bytes(6)
    for k, row in enumerate(rows):
        kind, step = k % 5, 2
        left = bytes(step) + row[:-step]
        corner = bytes(step) + before[:-step]
        near = lambda a, b, c: min((a, b, c), key=lambda x: abs(a + b - c - x))
        guess = (bytes(6), left, before, bytes((a + b) // 2 for a, b in zip(left, before, strict=True)), bytes(near(a, b, c) for a, b, c in zip(left, before, corner, strict=True)))[kind]
        out += bytes([kind]) + bytes((x - g) & 255 for x, g in zip(row, guess, strict=True))
        before = row
    assert objects._predicted(out, {"Predictor": 15, "Columns": 3, "Colors": 2}) == b"".join(rows)


def test_inline_images_and_marks_are_passed():
    body = b"/P << /MCID 0 >> BDC BT /F1 12 Tf 50 800 Td (a) Tj ET EMC q BI /W 2 /H 2 /BPC 8 ID \x00EI(\xff) EI Q BT /F1 12 Tf 50 780 Td (b) Tj ET % (comment) Tj\n"
    assert texts(page(body)) == ["a", "b"]


def calls_of(run) -> int:
    """Python functions called by `run`."""
    found = 0

    def count(_, event, __):
        nonlocal found
        found += event == "call"

    sys.setprofile(count)
    try:
        run()
    finally:
        sys.setprofile(None)
    return found


def test_work_of_a_word():
    """Kerned text takes a few calls for a word (it took 31), and they grow with the text only."""
    lines = [" ".join(f"word{k * n}" for k in range(20)) for n in range(100)]
    once, twice = (calls_of(lambda d=pdfs.kerned_pdf(lines * n): read_pages(d)) for n in (1, 2))
    assert once < 12 * 2000 and twice < 2.1 * once


def test_plain_and_other_tokens():
    """What one expression takes at once, and what it leaves to the slower way."""
    got = []
    lex = objects.Lexer(rb"% note (x)" + b"\n(a)(b(c)\\)d) 12 -.5 3. 1-2 4 0 R[1 (x) -2.5()]% y" + b"\n[5 0 R (z)] /Na#20me/Plain <4a4B> <4 > << /K true >> Tj (e) ' null")
    while (x := lex.value()) is not objects.END:
        got.append(x)
    assert got == [b"a", rb"b(c))d", 12, -0.5, 3.0, b"1-2", objects.Ref(4), [1, b"x", -2.5, b""], [objects.Ref(5), b"z"], "Na me", "Plain", b"JK", b"@", {"K": True}, b"Tj", b"e", b"'", None]
    assert [type(x) for x in got if isinstance(x, objects.Word)] == [objects.Word] * 3


def test_strings_parted_by_moves():
    """Small moves join strings, larger ones either way part them; so do spacing, slant and two-byte codes."""
    assert shown(b"[(He) 30 (l) -20 -20 (lo) -300 (wor) 20 (ld) 500 -800 (x)] TJ") == ["Hello world x"]
    assert shown(b"0.01 Tc [(He) 30 (llo) -300 (you)] TJ") == ["Hello you"]
    assert shown(b"[-100 (a) () 5 (b) -2000] TJ (c) Tj") == ["ab c"]


def test_shown_characters():
    every = "".join(chr(c) for c in [*range(1, 0x3000), 0xFFFD, 0x1F600])
    assert documents.shown(every, False) == re.sub("[^\n\x20-\x7e\xa1-\xac\xae-\xff]", "?", every)
    assert documents.shown(every, True) == re.sub("[�\x7f]", "?", every)
