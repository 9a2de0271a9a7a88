"""Text from payloads: routing by format, office documents, positioned page lines and their paragraphs.

Routing, line texts, paragraphs and gates are column expressions. Python reads only what is binary, row by row in Arrow
batches, in one pass over the payloads whatever their formats. A file that can't be read ends as an error row (a PDF goes
to OCR) and never fails the job; a format without a reader ends as an error of its own kind, never as an empty text.
"""

from __future__ import annotations

import io
import time
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions.text import BULLET, MIB, blank, hex_head, sniff
from docloom.operators.pdf.content import read_lines
from docloom.operators.pdf.objects import Unread

#: A reader: bytes -> text. Whatever it raises makes an error row; `BadFormat` marks a file that no later try can read.
Reader = Callable[[bytes], str]
#: The largest size of an unpacked part of a word document.
MOST_UNPACKED = 512 * MIB
LINES = "page int, y float, font float, chunks array<string>"
GAP = 1.3
#: Payloads read at a time, and about how many bytes of them (one larger payload is read by itself).
BATCH_ROWS = 32
BATCH_BYTES = 2 * MIB
#: Characters that Java calls whitespace.
_WHITE = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x1680, *range(0x2000, 0x2007), *range(0x2008, 0x200B), 0x2028, 0x2029, 0x205F, 0x3000)))
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
#: Parts of a paragraph that hold runs of its own.
_HOLDERS = {_W + x for x in ("hyperlink", "fldSimple", "ins", "moveTo", "smartTag")}


class BadFormat(ValueError):
    """A file that is unreadable for good, such as one with a password."""


def routed(payloads: DataFrame) -> DataFrame:
    """(id, data) with its format and, for formats that are not processed, the error."""
    fmt = sniff(F.col("data"))
    error = F.concat(F.lit("Unsupported format "), F.col("format"), F.lit(", "), F.coalesce(F.octet_length("data"), F.lit(0)).cast("string"), F.lit(" bytes, begins "), F.coalesce(hex_head(F.col("data")), F.lit("")))
    known = F.col("format").isin("DOC", "DOCX", "PDF")
    return payloads.withColumn("format", fmt).withColumns({"error_kind": F.when(~known, F.lit("bad_format")), "error": F.when(~known, error)})


def _run_text(run: ElementTree.Element) -> str:
    """What a run itself holds; not the text boxes in drawings that are anchored in it."""
    out = []
    for x in run:
        if x.tag == _W + "t":
            out.append(x.text or "")
        elif x.tag in (_W + "tab", _W + "ptab"):
            out.append("\t")
        elif x.tag in (_W + "br", _W + "cr"):
            out.append("\n")
        elif x.tag in (_W + "footnoteReference", _W + "endnoteReference"):
            out.append(f"[{x.tag.removeprefix(_W).removesuffix('erence')}:{x.get(_W + 'id', '')}]")
    return "".join(out)


def _runs(node: ElementTree.Element) -> str:
    """A paragraph's runs in order, those of links, fields, insertions and smart tags among them; content controls and deletions aren't."""
    return "".join(_run_text(x) if x.tag == _W + "r" else _runs(x) for x in node if x.tag == _W + "r" or x.tag in _HOLDERS)


def _continues(cell: ElementTree.Element) -> bool:
    """Whether a table cell goes on a vertical merge: marked without a value, or as going on."""
    mark = cell.find(f"{_W}tcPr/{_W}vMerge")
    return mark is not None and mark.get(_W + "val", "continue") == "continue"


def read_docx(data: bytes) -> str:
    """Paragraphs and tables of the body in order, a line each: blank ones dropped, cells parted by tabs, merged cells left out."""
    try:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            if z.getinfo("word/document.xml").file_size > MOST_UNPACKED:
                raise ValueError("its text is too large")
            body = ElementTree.fromstring(z.read("word/document.xml")).find(_W + "body")
    except Exception as e:  # damaged archives raise errors of many kinds
        raise ValueError(f"not a word document: {e}") from e
    lines = []
    for part in body if body is not None else ():
        if part.tag == _W + "p":
            lines.append(_runs(part))
        elif part.tag == _W + "tbl":
            for row in part.findall(_W + "tr"):
                cells = [" ".join(t for t in (_runs(p) for p in c.findall(_W + "p")) if t) for c in row.findall(_W + "tc") if not _continues(c)]
                lines.append("\t".join(cells))
    return "".join(f"{x}\n" for x in lines if x.strip())


def attempted(reader: Reader, data: bytes | None) -> tuple[str | None, str | None, str | None]:
    """(text, error kind, error) of a payload."""
    try:
        return reader(data or b""), None, None
    except BadFormat as e:
        return None, "bad_format", str(e)
    except Exception as e:  # one bad file must not fail the others
        return None, "error", str(e) or type(e).__name__


def read_pages(data: bytes | None) -> tuple[list[dict], str | None]:
    """(lines, None) of a PDF file, or ([], why its text can't be told as a whole and for certain)."""
    try:
        return read_lines(data or b""), None
    except Unread as e:
        return [], str(e)
    except Exception as e:  # numbers, types and nesting of damaged files fail in many ways
        return [], f"damaged content: {e or type(e).__name__}"


def sliced(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The batches in slices of few rows and bytes of a column, so that what a task makes of a slice stays small; then memory that Arrow keeps is given back."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for k, size in enumerate(sizes):
            if k > start and (k - start == BATCH_ROWS or held + size > BATCH_BYTES):
                yield batch.slice(start, k - start)
                start, held = k, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)
        batch = None  # not held while the next one is read
    pa.default_memory_pool().release_unused()


def read_payloads(rows: DataFrame, readers: dict[str, Reader]) -> DataFrame:
    """(id, format, size, parse_ms, text, error_kind, error, lines) of routed payloads, each read once by the reader of its format; PDF files without one give lines."""
    types = pa.schema([("id", pa.int64()), ("format", pa.string()), ("size", pa.int64()), ("parse_ms", pa.int64()), ("text", pa.string()), ("error_kind", pa.string()), ("error", pa.string())])
    line = pa.list_(pa.struct([("page", pa.int32()), ("y", pa.float32()), ("font", pa.float32()), ("chunks", pa.list_(pa.string()))]))

    def timed(*row) -> tuple:
        begun = time.monotonic()
        found = one(*row)
        return int((time.monotonic() - begun) * 1000), *found

    def one(fmt: str, data: bytes | None, kind: str | None, error: str | None) -> tuple:
        if kind is not None:
            return None, kind, error, None
        if fmt in readers:
            return *attempted(readers[fmt], data), None
        if fmt == "PDF":
            lines, fault = read_pages(data)
            return None, None, None if fault is None else f"Unread PDF content: {fault}", lines
        return None, "unsupported", f"No reader for {fmt}", None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, "data"):
            data = part.column("data").to_pylist()
            got = [timed(*x) for x in zip(part.column("format").to_pylist(), data, part.column("error_kind").to_pylist(), part.column("error").to_pylist(), strict=True)]
            columns = [part.column("id"), part.column("format"), pa.array([None if d is None else len(d) for d in data], pa.int64())]
            columns += [pa.array([g[0] for g in got], pa.int64()), *[pa.array([g[k] for g in got], pa.string()) for k in range(1, 4)]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([g[4] for g in got], line)], schema=types.append(pa.field("lines", line)))
            part = data = got = columns = None

    schema = f"id long, format string, size long, parse_ms long, text string, error_kind string, error string, lines array<struct<{LINES.replace(' ', ': ').replace(',:', ',')}>>"
    return rows.select("id", "data", "format", "error_kind", "error").mapInArrow(run, schema)


def line_text(chunks: Column) -> Column:
    """Chunks stripped, empty ones dropped, joined by one blank."""
    return F.array_join(F.filter(F.transform(chunks, lambda c: F.trim(c, F.lit(_WHITE))), lambda c: c != ""), " ")


def joined_lines(texts: Column) -> Column:
    """Lines as one paragraph: a hyphen at a line's end goes and the next line follows at once, else a blank parts them."""

    def add(done: Column, line: Column) -> Column:
        hyphen = (F.length(done) >= 2) & F.right(done, F.lit(1)).isin("-", "­")
        return F.when(done == "", line).when(hyphen, F.concat(F.substring(done, F.lit(1), F.length(done) - 1), line)).otherwise(F.concat(done, F.lit(" "), line))

    return F.aggregate(texts, F.lit(""), add)


def paragraphs(lines: DataFrame, gap_sign: int = 1) -> DataFrame:
    """(doc_id, paragraph, text) of lines (doc_id, line_no, page, y, font, chunks).

    A paragraph begins at a document's first line, at a list mark, or after a gap on the same page: the line above
    stands lower by more than 1.3 of its font (`gap_sign` 1, as deployed: where a next column begins) or higher (-1).
    Paragraphs go on across pages.
    """
    by = Window.partitionBy("doc_id").orderBy("line_no")
    rows = lines.withColumn("line", line_text(F.col("chunks"))).where("line <> ''")
    above = lambda c: F.lag(c).over(by)
    gap = (above("page") == F.col("page")) & (gap_sign * (above("y") - F.col("y")) > GAP * above("font"))
    begins = above("line_no").isNull() | F.col("line").rlike(BULLET) | F.coalesce(gap, F.lit(False))
    rows = rows.withColumn("begins", begins).withColumn("paragraph", F.sum(F.col("begins").cast("int")).over(by))
    found = rows.groupBy("doc_id", "paragraph").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("own"))
    return found.select("doc_id", "paragraph", joined_lines(F.transform("own", lambda x: x["line"])).alias("text"))


def with_paragraphs(rows: DataFrame, gap_sign: int = 1) -> DataFrame:
    """The rows with `lines` (an array) replaced by `read`: the paragraphs of these lines, as `paragraphs` forms them, each ended by a line end.

    A document's lines are at hand in its row, so neither a shuffle nor a window is needed; every step is an array
    expression whose work grows with the text.
    """
    names = [c for c in rows.columns if c != "lines"]
    own = F.transform("lines", lambda x: F.struct(x["page"].alias("page"), x["y"].alias("y"), x["font"].alias("font"), line_text(x["chunks"]).alias("line")))
    rows = rows.select(*names, F.filter(own, lambda x: x["line"] != "").alias("own"))
    above = lambda k: F.get(F.col("own"), k - 1)
    gap = lambda x, k: (above(k)["page"] == x["page"]) & (gap_sign * (above(k)["y"] - x["y"]) > GAP * above(k)["font"])
    begins = F.transform("own", lambda x, k: (k == 0) | x["line"].rlike(BULLET) | F.coalesce(gap(x, k), F.lit(False)))
    rows = rows.select(*names, "own", begins.alias("begins"))

    def piece(x: Column, k: Column) -> Column:
        line, last = x["line"], F.coalesce(F.get(F.col("begins"), k + 1), F.lit(True))
        glued = F.right(line, F.lit(1)).isin("-", "\u00ad") & ((F.length(line) >= 2) | ~F.get(F.col("begins"), k))
        return F.when(last, F.concat(line, F.lit("\n"))).when(glued, F.substring(line, F.lit(1), F.length(line) - 1)).otherwise(F.concat(line, F.lit(" ")))

    return rows.select(*names, F.array_join(F.transform("own", piece), "").alias("read"))


def ocr_gate(text: Column, parse_error: Column, size: Column, most_mb: int = 12) -> Column:
    """What a page document needs next: `text` (it has a text layer), `ocr`, or `oversized` (a scan too large for OCR)."""
    scan = blank(text) | F.coalesce(parse_error, F.lit(False))
    return F.when(~scan, "text").when(size > most_mb * MIB, "oversized").otherwise("ocr")


def extracted(payloads: DataFrame, readers: dict[str, Reader] | None = None, ocr_max_mb: int = 12) -> DataFrame:
    """(id, format, text, error_kind, error, parse_ms) of payloads (id, data): cached texts should be kept out of it beforehand.

    The payloads are scanned once. `readers` adds to, or replaces, those for DOCX, DOC and PDF; what has no reader is
    `unsupported` and can be tried again once there is one. A PDF file whose text could not be read as a whole goes to
    OCR, as does one without a text.
    """
    from docloom.operators.word97 import read_doc

    own = {"DOCX": read_docx, "DOC": read_doc} | (readers or {})
    rows = with_paragraphs(read_payloads(routed(payloads), own).withColumn("paged", F.col("lines").isNotNull()))
    next_ = ocr_gate(F.col("read"), F.col("error").isNotNull(), F.col("size"), ocr_max_mb)
    paged = F.col("paged")
    text = F.when(paged, F.when(F.col("error").isNull() & ~blank(F.col("read")), F.col("read"))).otherwise(F.col("text"))  # a part of a text is none
    kind = F.when(paged, F.when(next_ != "text", next_)).otherwise(F.col("error_kind"))
    return rows.select("id", "format", text.alias("text"), kind.alias("error_kind"), "error", "parse_ms")


def with_cache(claims: DataFrame, cached: DataFrame, extract: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(id, text) of claims (id, ...): texts cached by an earlier try, and `extract` of the other claims alone."""
    known = cached.where("parsed_text is not null").select("id", F.col("parsed_text").alias("text"))
    fresh = extract(claims.join(known.select("id"), "id", "left_anti"))
    return claims.select("id").join(known, "id").unionByName(fresh.select("id", "text"))
