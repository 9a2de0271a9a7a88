from __future__ import annotations

import zlib

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.functions import xml as X
from docloom.operators import enrich, extract
from docloom.operators.word97 import read_doc
from docloom.plans.documents import docx_bytes
from docloom.plans.pdfs import pdf_bytes


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    ("name", "wanted"),
    [("a.docx", True), ("a.DOC", True), ("a.b.pdf", True), ("noext", False), ("a.txt", False), ("a.pdf ", True), (None, False), ("X Печатная форма.pdf", False), ("X печатная ФОРМА.pdf", False), ("Архив передачи 1.pdf", False), ("printform.pdf", True)],
)
def test_names(spark, name, wanted):
    assert one(spark, name, T.wanted_name) is wanted


@pytest.mark.parametrize(
    ("head", "fmt"),
    [(b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1x", "DOC"), (b"PK\x03", "DOCX"), (b"%PDF-1", "PDF"), (b"{\\rtf1", "RTF"), (b"<html>", "HTML"), (b"<!DOCTYPE a>", "HTML"), (b" <html", "UNKNOWN"), (b"<HTML", "UNKNOWN"), (b"P", "UNKNOWN"), (b"", "UNKNOWN"), (None, "UNKNOWN")],
)
def test_sniff(spark, head, fmt):
    assert one(spark, None if head is None else bytearray(head), T.sniff, "binary") == fmt


def test_gate(spark):
    rows = spark.createDataFrame([(None,), ("",), (" " * 30,), (" " * 30,), ("x" * 19,), ("x" * 20,), ("😀" * 10,)], "x string")
    assert [r.y for r in rows.select(T.too_short(F.col("x")).alias("y")).collect()] == [True, True, True, False, True, False, False]


def test_small_texts(spark):
    assert one(spark, bytearray(b"0123456789"), T.hex_head, "binary") == "30 31 32 33 34 35 36 37 …"
    assert one(spark, bytearray(b"01"), T.hex_head, "binary") == "30 31"
    assert "\r" not in one(spark, bytearray(b"x" * 100), T.base64_plain, "binary")
    assert one(spark, None, T.short_error) == "" and len(one(spark, "x" * 501, T.short_error)) == 501
    assert one(spark, "https://app1.example.org:80/x", T.host_of) == "app1.example.org" and one(spark, "nothing", T.host_of) is None
    assert one(spark, "a\x13CODE\x14res\x15b\x07\r", T.word_field_results) == "aresb\r"


@pytest.mark.parametrize(
    ("raw", "xml", "fix"),
    [
        ("<Document><A>1</A></Document>", "<Document><A>1</A></Document>", "none"),
        ("<Document><Header><Date>1</Header></Document>", "<Document><Header><Date>1</Date></Header></Document>", "completed"),
        ("<Document><Header><Name>A & B</Name></Header></Document>", "<Document><Header><Name>A &amp; B</Name></Header></Document>", "sanitized"),
        ("<Document><A>1</A></Document>tail<Document><A>2</A></Document>", "<Document><A>1</A></Document>", "sanitized"),
        ("<Document><A>x & y<B>1</A></Document>", "<Document><A>x &amp; y<B>1</B></A></Document>", "sanitized and completed"),
        ("<Document><A><B>1</Document>", None, None),
        ("<Document><A>1</B></A></Document>", None, None),
        ("no frame", None, None),
        (None, None, None),
    ],
)
def test_repair(spark, raw, xml, fix):
    got = enrich.validated(spark.createDataFrame([(1, raw)], "id long, content string")).first()
    assert (got.xml, got.fix) == (xml, fix)


def test_nested_repair_and_doctype():
    assert X.completed("<a><b>1</a>", nested=True) == "<a><b>1</b></a>" and X.completed("<D><A><B>1</D>", nested=True) == "<D><A><B>1</B></A></D>"
    assert X.completed("<a x='>'><b/></a>") is None and not X.is_valid("<!DOCTYPE a><a/>")


@settings(max_examples=60, deadline=None)
@given(st.text("<>/ab'\" ", max_size=40))
def test_repair_is_valid_or_nothing(text):
    xml, fix = X.repaired(text, text)
    assert (xml is None) == (fix is None) and (xml is None or X.is_valid(xml))


def plain_end(text, at):
    quote = ""
    for k in range(at, len(text)):
        if quote:
            quote = "" if text[k] == quote else quote
        elif text[k] in "\"'":
            quote = text[k]
        elif text[k] == ">":
            return k
    return -1


@settings(max_examples=200, deadline=None)
@given(st.text("<>/ab'\" ", max_size=40))
def test_tag_ends(text):
    end_of = X._Ends(text)
    assert [end_of(k) for k in range(len(text) + 1)] == [plain_end(text, k) for k in range(len(text) + 1)]


def test_unclosed_tags_take_linear_time():
    import time

    began = time.monotonic()
    assert X.completed("<a " * 100_000 + "'") is None
    assert time.monotonic() - began < 3


def test_framing(spark):
    cases = {"x <Document>a</Document> y <Document>b</Document> z": "<Document>a</Document> y <Document>b</Document>", "</Document><Document>": None, "<Document>": None, "```xml<Document></Document>```": "<Document></Document>", None: None, "</Document> <Document>x": None}
    frame = spark.createDataFrame([(k,) for k in cases], "x string")
    assert {r.x: r.y for r in frame.select("x", X.framed(F.col("x")).alias("y")).collect()} == cases


def test_cut_by_units(spark):
    rows = spark.createDataFrame([("abcdef",), ("a😀b",), ("😀😀",), ("ab😀",), ("",), (None,), ("яяяя",)], "x string")
    assert [r.y for r in rows.select(T.truncated(F.col("x"), 3).alias("y")).collect()] == ["abc", "a😀", "😀", "ab", "", None, "яяя"]


def test_docx(spark):
    data = docx_bytes(["One", " ", "Two & <x>"], [["a", "b"], ["", " "]])
    assert extract.read_docx(data) == "One\nTwo & <x>\na\tb\n"
    with pytest.raises(ValueError):
        extract.read_docx(b"PKxx")
    merged = data  # a cell that goes on a vertical merge is left out
    import io
    import zipfile

    with zipfile.ZipFile(io.BytesIO(merged)) as z:
        xml = z.read("word/document.xml").decode().replace("<w:tc><w:p><w:r><w:t>b", "<w:tc><w:tcPr><w:vMerge/></w:tcPr><w:p><w:r><w:t>b")
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", xml)
    assert extract.read_docx(out.getvalue()) == "One\nTwo & <x>\na\n"


def test_text_boxes_and_other_parts_of_paragraphs():
    """Boxes, deletions and content controls aren't text of a paragraph; links, fields, insertions and note marks are."""
    assert extract.read_docx(docx_bytes(["Before after", "x"], [["a", "b"]], rich=True)) == "Before after\nx\na\tb\n"
    body = (
        "<w:p><w:r><w:t>a</w:t><w:tab/><w:t>b</w:t><w:br/></w:r><w:sdt><w:sdtContent><w:r><w:t>control</w:t></w:r></w:sdtContent></w:sdt><w:ins><w:r><w:t>c</w:t></w:r></w:ins><w:fldSimple><w:r><w:t>d</w:t></w:r></w:fldSimple>"
        "<w:smartTag><w:hyperlink><w:r><w:t>e</w:t></w:r></w:hyperlink></w:smartTag><w:moveFrom><w:r><w:t>moved</w:t></w:r></w:moveFrom><w:r><w:instrText>PAGE</w:instrText><w:footnoteReference w:id='2'/></w:r></w:p>"
        "<w:sdt><w:sdtContent><w:p><w:r><w:t>control</w:t></w:r></w:p></w:sdtContent></w:sdt>"
    )
    data = zip_of(f"<w:document xmlns:w='http://schemas.openxmlformats.org/wordprocessingml/2006/main'><w:body>{body}</w:body></w:document>".encode())
    assert extract.read_docx(data) == "a\tb\ncde[footnoteRef:2]\n"


def doc_bytes(parts: list[tuple[str, dict]], flags: int = 0x0200, ident: int = 0xA5EC, version: int = 193) -> bytes:
    """A small binary word document: paragraphs with their marks and property changes, the text half in bytes, half in units."""
    import struct

    text = "".join(t for t, _ in parts)
    half = len(text) // 2
    main = bytearray(4 * 512)
    struct.pack_into("<HH", main, 0, ident, version)
    struct.pack_into("<H", main, 10, flags)
    struct.pack_into("<I", main, 0x4C, len(text))
    first, second = len(main), len(main) + 512
    body = text[:half].encode("cp1252").ljust(512, b"\0") + text[half:].encode("utf-16-le")
    place = lambda k: first + k if k < half else second + 2 * (k - half)
    ends, runs = [0], []
    for t, own in parts:
        ends.append(ends[-1] + len(t))
        runs.append(b"".join(struct.pack("<H", c) + v for c, v in own.items()))
    page, upper = bytearray(512), 510
    page[511] = len(runs)
    for k, own in enumerate(runs):
        struct.pack_into("<I", page, 4 * k, place(ends[k]))
        own = b"\0\0" + own + b"\0" * (len(own) % 2)
        upper -= (len(own) + 3) // 2 * 2
        page[upper : upper + 2 + len(own)] = bytes([0, len(own) // 2]) + own
        page[4 * (len(runs) + 1) + 13 * k] = upper // 2
    struct.pack_into("<I", page, 4 * len(runs), place(ends[-1] - 1) + 2)
    main[512:1024] = page
    plan = struct.pack("<3I", 0, half, len(text)) + struct.pack("<HIH", 0, 0x40000000 | 2 * first, 0) + struct.pack("<HIH", 0, second, 0)
    clx = b"\x01\x02\0ab" + b"\x02" + struct.pack("<I", len(plan)) + plan
    papx = struct.pack("<3I", 0, 1 << 20, 1)
    struct.pack_into("<II", main, 0x1A2, 0, len(clx))
    struct.pack_into("<II", main, 0x102, len(clx), len(papx))
    streams = [("WordDocument", bytes(main) + body), ("1Table", clx + papx)]
    content, fat, entries = b"", [0xFFFFFFFD, 0xFFFFFFFE], []
    entry = lambda name, kind, start, size: (name + "\0").encode("utf-16-le").ljust(64, b"\0") + struct.pack("<HB", 2 * len(name) + 2, kind) + bytes(49) + struct.pack("<III", start, size, 0)
    small, cut = b"", []
    for name, raw in streams:
        if len(raw) >= 4096:
            raise AssertionError("small streams only")
        begin, n = len(small) // 64, -(-len(raw) // 64)
        small += raw.ljust(64 * n, b"\0")
        cut += [begin + k + 1 for k in range(n - 1)] + [0xFFFFFFFE]
        entries.append(entry(name, 2, begin, len(raw)))
    sectors = lambda raw: -(-len(raw) // 512)
    chained = []
    for raw in (struct.pack(f"<{len(cut)}I", *cut), small):
        chained.append(len(fat))
        n = sectors(raw)
        fat += [len(fat) + k + 1 for k in range(n - 1)] + [0xFFFFFFFE]
        content += raw.ljust(512 * n, b"\0")
    directory = (entry("Root Entry", 5, chained[1], len(small)) + b"".join(entries)).ljust(512, b"\0")
    head = bytes.fromhex("D0CF11E0A1B11AE1") + bytes(16) + struct.pack("<HHHHH", 62, 3, 0xFFFE, 9, 6) + bytes(10) + struct.pack("<6I", 1, 1, 0, 4096, chained[0], 1)
    head += struct.pack("<2I", 0xFFFFFFFE, 0) + struct.pack("<109I", 0, *[0xFFFFFFFF] * 108)
    table = struct.pack(f"<{len(fat)}I", *fat).ljust(512, b"\xff")
    return head + table + directory + content


def test_binary_word_documents(spark):
    import struct

    inside, end = {0x2416: b"\1"}, {0x2416: b"\1", 0x2417: b"\1"}
    cells = lambda *kinds: {0xD608: struct.pack("<HB", 4 + 2 * len(kinds) + 20 * len(kinds), len(kinds)) + bytes(2 * len(kinds) + 2) + b"".join(struct.pack("<H", k) + bytes(18) for k in kinds)}
    parts = [("First ‘paragraph’\r", {}), (" \r", {}), ("a\r", inside), ("b\x07", inside), ("c\x07", inside), ("\x07", end | cells(0, 0)), ("d\x07", inside), ("tail\x07", inside), ("e\x07", inside), ("\x07", end | cells(1, 2, 0)), (" \x07", inside), ("\x07", end | cells(0)), ("see \x13PAGE\x1412\x15 and \x13REF x\x15more\r", {}), ("Последний абзац\r", {})]
    half = sum(len(t) for t, _ in parts) // 2
    assert half > 40
    data = doc_bytes(parts)
    assert read_doc(data) == "First ‘paragraph’\na b\tc\nd\te\nsee 12 and more\nПоследний абзац\n"
    rows = [(1, data), (2, doc_bytes(parts, flags=0x0300)), (3, doc_bytes(parts, version=100)), (4, data[:700]), (5, data[:8] + b"\xff" * 600)]
    got = {r.id: (r.error_kind, r.text is not None) for r in extract.extracted(spark.createDataFrame([(k, bytearray(d)) for k, d in rows], "id long, data binary")).collect()}
    assert got == {1: (None, True), 2: ("bad_format", False), 3: ("error", False), 4: ("error", False), 5: ("error", False)}


def test_extracted_kinds(spark):
    rows = [(1, docx_bytes(["Hello"])), (2, b"{\\rtf1"), (3, None), (4, pdf_bytes(["First line of", "text"])), (5, pdf_bytes([])), (6, bytes.fromhex("D0CF11E0A1B11AE1")), (7, b"PKbroken")]
    got = {r.id: r for r in extract.extracted(spark.createDataFrame([(i, None if d is None else bytearray(d)) for i, d in rows], "id long, data binary")).collect()}
    assert [got[i].error_kind for i in range(1, 8)] == [None, "bad_format", "bad_format", None, "ocr", "error", "error"]
    assert got[1].text == "Hello\n" and got[4].text == "First line of text\n" and "7B 5C 72 74 66 31" in got[2].error
    assert extract.extracted(spark.createDataFrame([], "id long, data binary")).isEmpty()


@pytest.mark.parametrize(
    ("lines", "expected"),
    [
        ([("abc-", 0, 10), ("def", 0, 24), ("x", 0, 38)], ["abcdef x"]),
        ([("Intro", 0, 10), ("1) one", 0, 24), ("- two", 0, 38), ("а) три", 0, 52)], ["Intro", "1) one", "- two", "а) три"]),
        ([("end of page", 0, 700), ("continues", 1, 10)], ["end of page continues"]),
        ([("a", 0, 100), ("b", 0, 50)], ["a", "b"]),
        ([("a", 0, 50), ("b", 0, 100)], ["a b"]),
        ([("-", 0, 10), ("x", 0, 24)], ["- x"]),
        ([(" ", 0, 10), ("x", 0, 24)], ["x"]),
    ],
)
def test_paragraphs(spark, lines, expected):
    rows = [(1, k, p, float(y), 12.0, [t]) for k, (t, p, y) in enumerate(lines)]
    frame = spark.createDataFrame(rows, "doc_id long, line_no int, page int, y float, font float, chunks array<string>")
    found = extract.paragraphs(frame)
    assert [r.text for r in found.orderBy("paragraph").collect()] == expected
    packed = frame.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "page", "y", "font", "chunks"))), lambda x: F.struct(x["page"].alias("page"), x["y"].alias("y"), x["font"].alias("font"), x["chunks"].alias("chunks"))).alias("lines"))
    assert extract.with_paragraphs(packed).first().read == "".join(x + "\n" for x in expected)


def zip_of(body: bytes, **flags) -> bytes:
    import io
    import zipfile

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", body)
    data = bytearray(out.getvalue())
    for place in (data.find(b"PK\x03\x04") + 6, data.find(b"PK\x01\x02") + 8):
        data[place] |= flags.get("bits", 0)
        data[place + 2 : place + 4] = flags.get("method", 0).to_bytes(2, "little")
    return bytes(data)


def test_damaged_files_never_fail_a_job(spark):
    """Encrypted, cut, oddly packed and broken files end as error rows or go to OCR."""
    good, page = docx_bytes(["Hello"]), pdf_bytes(["A readable page"])
    body = b"<w:document xmlns:w='http://schemas.openxmlformats.org/wordprocessingml/2006/main'><w:body/></w:document>"
    cases = {
        1: (good[: len(good) // 2], "error"), 2: (zip_of(body, bits=1), "error"), 3: (zip_of(body, method=99), "error"), 4: (zip_of(b"<w:document"), "error"), 5: (zip_of(b"<?xml version='1.0' encoding='nonsense'?><a/>"), "error"),
        6: (b"%PDF-1.4 << /Length 9 >>\nstream\nBT /F1 . Tf 1 0 0 1 5 ... Tm (x) Tj ET\nendstream", "ocr"), 7: (b"%PDF-1.4 << >> stream\nBT 1 ... Td (x) Tj ET endstream", "ocr"), 8: (page[:60], "ocr"), 9: (b"%PDF", "ocr"),
        10: (page.replace(b"/Root 1 0 R", b"/Root 1 0 R /Encrypt << /V 1 >>"), "ocr"), 11: (bytes.fromhex("D0CF11E0A1B11AE1") + b"x" * 600, "error"), 12: (good, None), 13: (page, None), 14: (zip_of(body), None), 15: (b"PK", "error"),
    }
    frame = spark.createDataFrame([(k, bytearray(v)) for k, (v, _) in cases.items()], "id long, data binary")
    got = {r.id: r for r in extract.extracted(frame).collect()}
    assert {k: got[k].error_kind for k in cases} == {k: kind for k, (_, kind) in cases.items()}
    assert all((got[k].error is None) == (kind is None) for k, (_, kind) in cases.items() if k not in (8, 9)) and got[14].text == ""

    def odd(data: bytes) -> str:
        raise MemoryError if b"m" in data else extract.BadFormat("password")

    rows = spark.createDataFrame([(1, bytearray(b"PKm")), (2, bytearray(b"PK"))], "id long, data binary")
    assert [(r.error_kind, r.error) for r in extract.extracted(rows, {"DOCX": odd}).orderBy("id").collect()] == [("error", "MemoryError"), ("bad_format", "password")]


def test_payloads_are_scanned_once(spark, tmp_path):
    spark.createDataFrame([(1, bytearray(docx_bytes(["Hello"])))], "id long, data binary").write.parquet(str(tmp_path / "p"))
    plan = extract.extracted(spark.read.parquet(str(tmp_path / "p")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("MapInArrow") == 1 and "Exchange" not in plan


def test_slices_are_bounded():
    """By rows and bytes, whatever the batch; no row is lost, one that is larger is by itself."""
    texts = [None, "", "x" * 5_000_000, *["y" * 100_000] * 50, *["z"] * 100]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["id", "text"])
    parts = list(extract.sliced(iter([batch.slice(0, 0), batch]), "text"))
    assert [i for p in parts for i in p.column("id").to_pylist()] == list(range(len(texts)))
    assert all(p.num_rows <= 32 and (p.num_rows == 1 or sum(len(t or "") for t in p.column("text").to_pylist()) <= 2 << 20) for p in parts)


def test_a_batch_of_payloads_is_read_in_slices(spark):
    """What a task makes of 1,000 texts never stands in memory at once: each slice's rows go on before the next are made."""
    rows = spark.range(0, 1000, 1, 1).select(F.repeat(F.lit("x"), 10_000).alias("text"))
    got = rows.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"]) for b in extract.sliced(batches, "text")), "n long").toPandas()
    assert got.n.sum() == 1000 and got.n.max() <= 32


def test_line_texts_are_stripped_of_what_java_calls_white(spark):
    white = "".join(chr(c) for c in range(1, 0x10000) if not 0xD800 <= c < 0xE000)
    both = spark.createDataFrame([([f"{c}a {c}b{c}{c}", c],) for c in white], "chunks array<string>").select(
        extract.line_text(F.col("chunks")).alias("ours"),
        F.expr(r"array_join(filter(transform(chunks, c -> regexp_replace(c, '\\A\\p{javaWhitespace}+|\\p{javaWhitespace}+\\z', '')), c -> c <> ''), ' ')").alias("java"))
    assert both.where("ours <> java").count() == 0
