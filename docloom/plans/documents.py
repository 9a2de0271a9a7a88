"""Queries on texts, pages and answers."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.functions import xml as X
from docloom.operators import enrich, extract
from docloom.plans.pdfs import WRITERS, mapped_pdf, pdf_bytes
from docloom.plans.virtual import ctes, view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


_EXT = "case when position('.' in file_name) > 0 then lower(rtrim(regexp_extract(file_name, '[^.]*$'), ' ')) end"


@query(ctes("vfiles") + f" select file_id, {_EXT} as extension, coalesce({_EXT} in ('doc', 'docx', 'pdf'), false) and not file_name ilike '%печатная форма%' and not file_name ilike '%архив передачи%' as wanted from vfiles")
def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extensions, and which files are taken in."""
    name = F.col("file_name")
    return view(spark, sf_dir, "vfiles").select("file_id", T.extension(name).alias("extension"), T.wanted_name(name).alias("wanted"))


@query("select doc_id, case when n_chars * 1000 >= 10485760 then 'heavy' else 'light' end as route from documents")
def size_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "documents").select("doc_id", T.size_route(F.col("n_chars") * 1000).alias("route"))


@query("select doc_id, regexp_full_match(text, '\\s*') or length(text) < 20 as short, length(text) as units, substr(text, 1, 400) as head from documents")
def text_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which texts are too short to go on, their lengths in UTF-16 units, and what a model would see of them at most."""
    text = F.col("text")
    return view(spark, sf_dir, "documents").select("doc_id", T.too_short(text).alias("short"), T.utf16_length(text).cast("long").alias("units"), T.truncated(text, 400).alias("head"))


@query(
    r"""select doc_id, case when length(text) <= 500 then text else substr(text, 1, 500) || '…' end as error,
 case when length(line) <= 160 then line else substr(line, 1, 160) || '…' end as line from (select *, trim(regexp_replace(text, '[ \t\n\x0B\f\r]+', ' ', 'g'), ' ') as line from documents)"""
)
def error_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "documents").select("doc_id", T.short_error(F.col("text")).alias("error"), T.one_line(F.col("text")).alias("line"))


@query(r"select page_id, nullif(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/:?#]+)', 1), '') as host, regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/:?#]+)', 1) <> '' as valid, regexp_replace(trim(url, ' '), '/$', '') as base from pages")
def page_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts, validity and base addresses."""
    url = F.col("url")
    return view(spark, sf_dir, "pages").select("page_id", T.host_of(url).alias("host"), T.valid_server(url).alias("valid"), T.base_url(url).alias("base"))


_HEADS = ["", "PK", "%PDF-1.7 ", "{\\rtf1", "<html>", " <html>", "<HTML>"]
_HEADED = "select page_id, concat(case page_id % 7 " + " ".join(f"when {k} then '{h}'" for k, h in enumerate(_HEADS)) + " end, html) as body from pages"


@query(
    f"""with p as ({_HEADED}) select page_id, case when body = '' then 'UNKNOWN' when starts_with(body, 'PK') then 'DOCX' when starts_with(body, '%PDF') then 'PDF' when starts_with(body, '{{\\rtf') then 'RTF'
 when starts_with(body, '<html') or starts_with(body, '<!DOCTYPE') then 'HTML' else 'UNKNOWN' end as format,
 rtrim(regexp_replace(substr(hex(encode(body)), 1, 16), '(..)', '\\1 ', 'g'), ' ') || case when strlen(body) > 8 then ' …' else '' end as head from p"""
)
def sniffed_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formats by the first bytes, and those bytes in hex."""
    head = F.element_at(F.array(*map(F.lit, _HEADS)), (F.col("page_id") % 7 + 1).cast("int"))
    data = F.encode(F.concat(head, F.col("html")), "UTF-8")
    return view(spark, sf_dir, "pages").select("page_id", T.sniff(data).alias("format"), T.hex_head(data).alias("head"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    line = F.when(F.col("line_no") % 5 == 2, F.concat("line", F.lit("-"))).when(F.col("line_no") % 7 == 3, F.concat(F.lit("1) "), "line")).otherwise(F.col("line"))
    y = F.when(F.col("line_no") % 11 == 10, 10.0).otherwise((F.col("line_no") % 40) * 14.0 + 40.0)
    return rows.select("doc_id", "line_no", F.floor(F.col("line_no") / 40).cast("int").alias("page"), y.cast("float").alias("y"), F.lit(12.0).cast("float").alias("font"), F.split(line, "  ").alias("chunks"))


@query(
    r"""with l as (select doc_id, unnest(range(len(ls))) as line_no, unnest(ls) as line from (select doc_id, string_split(text, chr(10)) as ls from documents)),
m as (select doc_id, line_no, line_no // 40 as page, cast(case when line_no % 11 = 10 then 10.0 else (line_no % 40) * 14.0 + 40.0 end as float) as y,
 array_to_string(list_filter(list_transform(string_split(case when line_no % 5 = 2 then line || '-' when line_no % 7 = 3 then '1) ' || line else line end, '  '),
  lambda c: regexp_replace(c, '^[\x09-\x0D\x1C-\x20]+|[\x09-\x0D\x1C-\x20]+$', '', 'g')), lambda c: c <> ''), ' ') as line from l),
k as (select *, lag(line_no) over w is null or regexp_matches(line, '^[ \t\n\x0B\f\r]*([•●▪◦*–—-]|[0-9]{1,3}[.)]|[A-Za-zА-Яа-яЁё][.)])[ \t\n\x0B\f\r]+')
  or coalesce(lag(page) over w = page and lag(y) over w - y > 1.3 * 12, false) as begins from m where line <> '' window w as (partition by doc_id order by line_no)),
p as (select *, sum(begins::int) over (partition by doc_id order by line_no) as paragraph from k)
select doc_id, cast(paragraph as bigint) as paragraph, list_reduce(list(line order by line_no), lambda a, b: case when length(a) >= 2 and right(a, 1) in ('-', chr(173)) then left(a, length(a) - 1) || b else a || ' ' || b end) as text
from p group by doc_id, paragraph"""
)
def paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines assembled into paragraphs."""
    return extract.paragraphs(_lines(spark, sf_dir))


_WRAPPED = "concat('pre ```xml <Document><Name>', text, ' \\u003cb\\u003e \\n &amp; & &#12; &x; ', chr(7), '</Name></Document> post <Document>2</Document> ```')"
_FRAMED = f"regexp_extract({_WRAPPED}, '(?s)<Document>.*</Document>')"


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = ["pre ```xml <Document><Name>", None, " \\u003cb\\u003e \\n &amp; & &#12; &x; \x07</Name></Document> post <Document>2</Document> ```"]
    return view(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.concat(*[F.col("text") if p is None else F.lit(p) for p in parts]).alias("content"))


@query(f"select doc_id as id, {_FRAMED} as framed from documents")
def framed_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answers(spark, sf_dir).select("id", X.framed(F.col("content")).alias("framed"))


def _sanitized_sql(x: str) -> str:
    """The sanitized form of a framed text in SQL, which has no look-ahead: all ampersands are escaped, then entities restored."""
    undone = f"""replace(replace(replace(replace(replace(replace(substr({x}, 1, position('</Document>' in {x}) + 10), '\\u003c', '<'), '\\u003e', '>'), '\\n', chr(10)), '\\t', chr(9)), '\\r', ''), '\\"', '"')"""
    return rf"regexp_replace(replace(regexp_replace({undone}, '[\x00-\x08\x0B\x0C\x0E-\x1F\x{{FFFD}}\x{{200B}}-\x{{200D}}\x{{FEFF}}]', '', 'g'), '&', '&amp;'), '&amp;((amp|lt|gt|quot|apos|#[0-9]+|#x[0-9a-fA-F]+);)', '&\1', 'g')"


_AMPED = _sanitized_sql(_FRAMED)


@query(f"select doc_id as id, {_AMPED} as clean from documents")
def sanitized_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answers(spark, sf_dir).select("id", X.sanitized(X.framed(F.col("content"))).alias("clean"))


@query(r"select doc_id, regexp_replace(replace(text, '&', '&amp;'), '&amp;((amp|lt|gt|quot|apos|#[0-9]+|#x[0-9a-fA-F]+);)', '&\1', 'g') as text from documents")
def escaped_ampersands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "documents").select("doc_id", X.escaped_ampersands(F.col("text")).alias("text"))


_TAILS = ["</Name></Header></Document>", "</Header></Document>", "</Name></Header></Name></Document>", "</Document>"]
#: What makes a text without tags unfit for XML: a control character, or an ampersand that begins no entity.
_UNFIT = r"(regexp_matches({x}, '[\x00-\x08\x0B\x0C\x0E-\x1F]') or contains(regexp_replace({x}, '&(amp|lt|gt|quot|apos|#[0-9]+|#x[0-9a-fA-F]+);', '', 'g'), '&'))"


@query(
    f"""with a as (select doc_id as id, doc_id % 4 as k, concat('<Document><Header><Name>', replace(regexp_replace(text, '[<>]', '', 'g'), '```', ''), {' '.join(f"case when doc_id % 4 = {k} then '{t}' else '' end," for k, t in enumerate(_TAILS))} '') as x from documents),
b as (select *, {_sanitized_sql("x")} as clean, {_UNFIT.format(x="x")} as unfit from a)
select id, case when k = 0 then case when unfit then clean else x end when k = 1 then replace(case when unfit then clean else x end, '</Header>', '</Name></Header>') end as xml,
 case when k = 0 then case when unfit then 'sanitized' else 'none' end when k = 1 then case when unfit then 'sanitized and completed' else 'completed' end end as fix from b"""
)
def repaired_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers valid as they are or after a repair, of four kinds: sound, a closing tag missing, one that was never opened, two missing at one place."""
    docs = view(spark, sf_dir, "documents")
    tail = F.element_at(F.array(*map(F.lit, _TAILS)), (F.col("doc_id") % 4 + 1).cast("int"))
    return enrich.validated(docs.select(F.col("doc_id").alias("id"), F.concat(F.lit("<Document><Header><Name>"), F.regexp_replace("text", "[<>]", ""), tail).alias("content")))


@query(
    """with h as (select doc_id, concat('<Document><Header><Number>', cast(doc_id as string), '</Number><Date>', lpad(cast(doc_id % 28 + 1 as string), 2, '0'), '.01.2024</Date></Header></Document>', chr(10), text) as stored from documents)
select doc_id, regexp_extract(stored, '<Number>([^<]*)</Number>', 1) as number, strptime(regexp_extract(stored, '<Date>([^<]*)</Date>', 1), '%d.%m.%Y')::date::varchar as dated,
 substr(stored, position('</Document>' in stored) + 12) as text from h"""
)
def stored_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored documents parted into header and text, fields of the header read by its schema."""
    from docloom.schema import HEADER

    day = F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0")
    stored = F.concat(F.lit("<Document><Header><Number>"), F.col("doc_id").cast("string"), F.lit("</Number><Date>"), day, F.lit(".01.2024</Date></Header></Document>"))
    docs = view(spark, sf_dir, "documents").select("doc_id", T.enriched(stored, F.col("text")).alias("stored"))
    header, text = X.split_stored(F.col("stored"))
    rows = docs.select("doc_id", F.from_xml(header, HEADER).alias("h"), text.alias("text"))
    return rows.select("doc_id", F.col("h.Header.Number").alias("number"), F.to_date(F.try_to_timestamp(F.col("h.Header.Date"), F.lit("dd.MM.yyyy"))).cast("string").alias("dated"), "text")


_ENVELOPE = """case (conv_id + turn) % 8 when 0 then concat('{"IsSuccess":true,"Notes":"turn ', cast(turn as string), '","Data":"True"}') when 1 then '{"IsSuccess":true}' when 2 then '{"IsSuccess":false,"Notes":"InvalidPdfException at 0"}'
 when 3 then '{"IsSuccess":false,"Notes":"busy"}' when 4 then '{"x":1}' when 5 then '{bad' when 6 then concat(' plain ', cast(turn as string), ' ') else '  ' end"""


@query(
    f"""with c as (select conv_id, turn, case when (conv_id + turn) % 17 = 0 then 0 when (conv_id + turn) % 19 = 0 then 503 else 200 end as st, {_ENVELOPE} as body from conversations),
d as (select *, trim(body, ' ') as t, json_valid(trim(body, ' ')) as js from c), e as (select *, case when js then json_extract_string(t, '$.IsSuccess') end as ok, case when js then coalesce(json_extract_string(t, '$.Notes'), '') end as notes from d)
select conv_id, turn, case when st = 0 then 'transport_error' when st <> 200 then 'http_error' when t = '' then 'service_refusal' when not starts_with(t, '{{') then 'success' when ok = 'true' then 'success'
 when ok is not null and contains(notes, 'InvalidPdfException') then 'document_error' else 'service_refusal' end as outcome,
 case when st <> 200 or t = '' then null when not starts_with(t, '{{') then t when ok = 'true' then notes end as text from e"""
)
def ocr_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OCR servers' answers of all kinds."""
    key = F.col("conv_id") + F.col("turn")
    rows = view(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(key % 17 == 0, 0).when(key % 19 == 0, 503).otherwise(200).alias("st"), F.expr(_ENVELOPE).alias("body"))
    return rows.withColumn("a", enrich.ocr_answer(F.col("st"), F.col("body"))).select("conv_id", "turn", "a.outcome", "a.text")


_REPLY = """case (conv_id + turn) % 7 when 0 then '{"choices":[{"finish_reason":"stop","message":{"content":"good"}}],"usage":{"prompt_tokens":10,"completion_tokens":2}}' when 1 then '{"choices":[{"finish_reason":"length","message":{"content":"cut"}}]}'
 when 2 then '{"choices":[{"finish_reason":"","message":{"content":" ","reasoning_content":"thought"}}]}' when 3 then '{"choices":[]}' when 4 then '{"error":{"message":"overloaded"}}' when 5 then '{"choices":[{"message":{"content":""}}]}' else '<html>502 Bad Gateway</html>' end"""
_STATUS = "case (conv_id * 3 + turn) % 9 when 0 then 401 when 1 then 404 when 2 then 400 when 3 then 429 when 4 then 503 when 5 then 0 else 200 end"


@query(
    f"""with c as (select conv_id, turn, {_STATUS} as st, {_REPLY} as body, (conv_id + turn) % 7 as k from conversations)
select conv_id, turn, case when st = 401 then 'permanent' when st between 400 and 499 and contains(body, 'Bad Gateway') then 'transient' when st between 400 and 499 then 'permanent' when st <> 200 then 'transient'
 when k in (3, 4, 5, 6) then 'transient' when k = 1 then 'bad_output' else 'ok' end as outcome,
 case when st = 200 and k = 0 then 'good' when st = 200 and k = 2 then 'thought' end as content, cast(case when k = 0 then 10 else -1 end as int) as prompt_tokens,
 st in (401, 429, 503, 0) or (st between 400 and 499 and contains(body, 'Bad Gateway')) as breaker_failure from c"""
)
def llm_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model's answers of all kinds."""
    rows = view(spark, sf_dir, "conversations").select("conv_id", "turn", F.expr(_STATUS).alias("st"), F.expr(_REPLY).alias("body"))
    return rows.withColumn("a", enrich.llm_answer(F.col("st"), F.col("body"))).select("conv_id", "turn", "a.outcome", "a.content", "a.prompt_tokens", "a.breaker_failure")


@query("select doc_id, base64(encode(text)) as data, length(text) as n from documents")
def payload_base64(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "documents").select("doc_id", T.base64_plain(F.encode("text", "UTF-8")).alias("data"), F.length("text").cast("long").alias("n"))


@query(
    r"""select doc_id, regexp_replace(regexp_replace(regexp_replace(t, '\x13[^\x14\x15]*\x14([^\x15]*)\x15', '\1', 'g'), '\x13[^\x15]*\x15', '', 'g'), '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]', '', 'g') as text
from (select doc_id, concat(chr(19), 'PAGE', chr(20), '7', chr(21), text, chr(7), chr(19), 'REF', chr(21), 'end', chr(13)) as t from documents)"""
)
def word_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of a word processor without field codes and control marks."""
    raw = F.concat(F.lit("\x13PAGE\x147\x15"), "text", F.lit("\x07\x13REF\x15end\r"))
    return view(spark, sf_dir, "documents").select("doc_id", T.word_field_results(raw).alias("text"))


def docx_bytes(paragraphs: list[str], rows: list[list[str]] = (), rich: bool = False) -> bytes:
    """A small word document, for tests and the query below. `rich`: each paragraph in two runs, one of them in a link, with a deletion and a text box; each table row with a cell that goes on a vertical merge."""
    esc = lambda t: t.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    run = lambda t: f"<w:r><w:t>{esc(t)}</w:t></w:r>"
    p = lambda t: f"<w:p>{run(t)}</w:p>"
    box = f"<w:txbxContent>{p('boxed')}</w:txbxContent>"
    aside = f"<w:del><w:r><w:delText>gone</w:delText></w:r></w:del><w:r><mc:AlternateContent><mc:Choice><w:drawing>{box}</w:drawing></mc:Choice><mc:Fallback><w:pict>{box}</w:pict></mc:Fallback></mc:AlternateContent></w:r>" if rich else ""
    paragraph = lambda t: f"<w:p><w:pPr/>{run(t[: len(t) // 2])}{aside}<w:hyperlink>{run(t[len(t) // 2 :])}</w:hyperlink></w:p>" if rich else p(t)
    goes_on = f"<w:tc><w:tcPr><w:vMerge/></w:tcPr>{p('merged')}</w:tc>" if rich else ""
    table = "<w:tbl>" + "".join("<w:tr>" + goes_on + "".join(f"<w:tc>{p(c)}</w:tc>" for c in r) + "</w:tr>" for r in rows) + "</w:tbl>" if rows else ""
    body = "".join(map(paragraph, paragraphs)) + table
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f'<?xml version="1.0" encoding="UTF-8"?><w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:mc="http://schemas.openxmlformats.org/markup-compatibility/2006"><w:body>{body}</w:body></w:document>')
    return out.getvalue()


@query(
    """with c as (select doc_id, regexp_replace(text, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\r]', '', 'g') as text from documents)
select doc_id as id, case when doc_id % 5 = 0 then 'RTF' when doc_id % 5 = 1 then 'UNKNOWN' else 'DOCX' end as format, case when doc_id % 5 < 2 then 'bad_format' end as error_kind,
 case doc_id % 5 when 0 then 'Unsupported format RTF, 8 bytes, begins 7B 5C 72 74 66 31 20 78' when 1 then 'Unsupported format UNKNOWN, 5 bytes, begins 70 6C 61 69 6E' end as error,
 case when doc_id % 5 >= 2 then array_to_string(list_filter(string_split(text, chr(10)), lambda x: not regexp_full_match(x, '\\s*')), chr(10)) || case when regexp_full_match(text, '\\s*') then '' else chr(10) end || 'a\tb' || chr(10) end as text from c""".replace("'a\\tb'", "'a' || chr(9) || 'b'")
)
def extracted_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of generated word documents, plain ones and ones with links, deletions, text boxes and merged cells, and the errors of other formats."""
    def run(batches):
        for b in extract.sliced(batches, "text"):
            ids, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
            data = [b"{\\rtf1 x" if i % 5 == 0 else b"plain" if i % 5 == 1 else docx_bytes(t.split("\n"), [["a", "b"]], rich=i % 2 == 0) for i, t in zip(ids, texts, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(data, pa.binary())], names=["id", "data"])
            b = texts = data = None

    docs = view(spark, sf_dir, "documents").select("doc_id", F.regexp_replace("text", "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\r]", "").alias("text"))
    return extract.extracted(docs.mapInArrow(run, "id long, data binary")).select("id", "format", "error_kind", "error", "text")


#: Characters that fonts with the usual encoding show; the fixture writes others as question marks, but for the style that maps all.
_OTHERS = bytes(c if c == 0x0A or 0x20 <= c < 0x7F or 0xA0 < c != 0xAD else 0x3F for c in range(256))
_BLANKS = "[\\x00-\\x09\\x0B-\\x20]"
_PDF_LINES = r"""c as (select doc_id, regexp_replace(text, '[\x00-\x09\x0B-\x20]+', ' ', 'g') as text from documents),
l as (select doc_id, unnest(range(len(ls))) as line_no, unnest(ls) as line from (select doc_id, string_split(regexp_replace(text, case when doc_id % 6 = 4 then '[\x{FFFD}\x7F]' else '[^\n\x20-\x7E\x{A1}-\x{AC}\x{AE}-\x{FF}]' end, '?', 'g'), chr(10)) as ls from c)),
m as (select doc_id, line_no, trim(line, ' ') as line from l),
k as (select *, lag(line_no) over w is null or regexp_matches(line, '^([•●▪◦*–—-]|[0-9]{1,3}[.)]|[A-Za-zА-Яа-яЁё][.)])[ \t\n\x0B\f\r]+') as begins from m where line <> '' window w as (partition by doc_id order by line_no)),
p as (select *, sum(begins::int) over (partition by doc_id order by line_no) as paragraph from k),
q as (select doc_id, paragraph, list_reduce(list(line order by line_no), lambda a, b: case when length(a) >= 2 and right(a, 1) in ('-', chr(173)) then left(a, length(a) - 1) || b else a || ' ' || b end) as own from p group by doc_id, paragraph),
t as (select doc_id, string_agg(own, chr(10) order by paragraph) || chr(10) as text from q group by doc_id)"""


def shown(text: str, mapped: bool) -> str:
    """The text with question marks for what its file can't show."""
    return text.replace("\uFFFD", "?").replace("\x7F", "?") if mapped else text.encode("latin-1", "replace").translate(_OTHERS).decode("latin-1")


@query(f"with {_PDF_LINES} select d.doc_id as id, 'PDF' as format, case when t.text is null then 'ocr' end as error_kind, t.text from documents d left join t using (doc_id)")
def pdf_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs of PDF files that are written in six ways: steps, gaps for blanks, quotes under a scaled system, lines out of order, own codes with a map, forms and object streams. A file without a line goes to OCR."""
    def run(batches):
        for b in extract.sliced(batches, "text"):
            ids, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
            data = [(write := WRITERS[i % len(WRITERS)])(shown(t, write is mapped_pdf).split("\n")) for i, t in zip(ids, texts, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(data, pa.binary())], names=["id", "data"])
            b = texts = data = None

    # runs of blanks and controls but line ends become a blank; those that are one already needn't be found
    docs = view(spark, sf_dir, "documents").select("doc_id", F.regexp_replace("text", f"[\\x00-\\x09\\x0B-\\x1F]{_BLANKS}*| {_BLANKS}+", " ").alias("text"))
    return extract.extracted(docs.mapInArrow(run, "id long, data binary")).select("id", "format", "error_kind", "text")


def damaged(kind: int, text: str) -> bytes:
    """Payloads that no reader can read as they are, of six kinds; the last is sound."""
    word, page = docx_bytes([text]), pdf_bytes(["A readable line"])
    locked = bytearray(word)
    locked[6] |= 1
    locked[word.find(b"PK\x01\x02") + 8] |= 1
    odd = [word[: len(word) // 2], bytes(locked), page.replace(b"/Contents", b"/Kontents").replace(b"/Type /Pages", b"/Type /Paged"), page.replace(b"/Filter /FlateDecode", b"/Filter /RunLengthDecode"), bytes.fromhex("D0CF11E0A1B11AE1") + b"\0" * 100]
    return odd[kind] if kind < len(odd) else word


@query(
    """with c as (select doc_id, regexp_replace(text, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\r]', '', 'g') as text from documents)
select doc_id as id, case doc_id % 6 when 2 then 'PDF' when 3 then 'PDF' when 4 then 'DOC' else 'DOCX' end as format, case doc_id % 6 when 0 then 'error' when 1 then 'error' when 2 then 'ocr' when 3 then 'ocr' when 4 then 'error' end as error_kind,
 case when doc_id % 6 = 5 then case when regexp_full_match(text, '\\s*') then '' else text || chr(10) end end as text from c"""
)
def damaged_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cut, locked and broken files among sound ones: each ends as a row of its own, none fails the job."""
    def run(batches):
        for b in extract.sliced(batches, "text"):
            ids, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([damaged(i % 6, t) for i, t in zip(ids, texts, strict=True)], pa.binary())], names=["id", "data"])
            b = texts = data = None

    docs = view(spark, sf_dir, "documents").select("doc_id", F.regexp_replace("text", "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\r]", "").alias("text"))
    found = extract.extracted(docs.mapInArrow(run, "id long, data binary"))
    return found.select("id", "format", "error_kind", "text")
