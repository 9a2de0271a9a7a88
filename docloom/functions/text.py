"""Column expressions on names, texts, addresses and payload heads. All are built-in functions, inside generated code."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

MIB = 1024 * 1024
#: The file types taken in, and words in names of printed forms and transfer archives.
EXTENSIONS = ("doc", "docx", "pdf")
UNWANTED_NAMES = ("Печатная форма", "Архив передачи")
#: What a payload of each format begins with, in the order of the tests.
MAGIC = [("DOC", bytes.fromhex("D0CF11E0A1B11AE1")), ("DOCX", b"PK"), ("PDF", b"%PDF"), ("RTF", b"{\\rtf"), ("HTML", b"<html"), ("HTML", b"<!DOCTYPE")]
#: Fixed pattern: list marks at the start of a line.
BULLET = r"^\s*([•●▪◦\-*–—]|\d{1,3}[.)]|[A-Za-zА-Яа-яЁё][.)])\s+"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often `use` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def blank(text: Column) -> Column:
    """Whether a text is null or only white space, as Java's isBlank sees it (a no-break space is not)."""
    return text.isNull() | text.rlike(r"\A\p{javaWhitespace}*\z")


def utf16_length(text: Column) -> Column:
    """Length in UTF-16 units."""
    return (F.octet_length(F.encode(text, "UTF-16LE")) / 2).cast("int")


def too_short(text: Column, least: int = 20) -> Column:
    """The gate before enrichment: blank, or shorter than `least` units."""
    return blank(text) | (utf16_length(text) < least)


def extension(name: Column) -> Column:
    """Lower-case extension without trailing blanks; null for a name without a dot."""
    return F.when(F.instr(name, ".") > 0, F.lower(F.rtrim(F.substring_index(name, ".", -1))))


def wanted_name(name: Column, unwanted: tuple[str, ...] = UNWANTED_NAMES, any_case: bool = True) -> Column:
    """Whether a file is taken in: a known extension and none of the unwanted words; null names are not."""
    ok = F.coalesce(extension(name).isin(*EXTENSIONS), F.lit(False))
    for word in unwanted:
        ok = ok & ~(name.ilike(f"%{word}%") if any_case else name.like(f"%{word}%"))
    return F.coalesce(ok, F.lit(False))


def size_route(size: Column, heavy_mb: int = 10) -> Column:
    return F.when(F.coalesce(size, F.lit(0)) >= heavy_mb * MIB, "heavy").otherwise("light")


def truncated(text: Column, most: int) -> Column:
    """The first `most` UTF-16 units; a pair of units is not parted, so that what is left is a text."""

    def cut(wide: Column) -> Column:
        pair = F.hex(F.substring(wide, 2 * most, 1)).between("D8", "DB")
        return F.decode(F.substring(wide, F.lit(1), F.when(pair, 2 * most - 2).otherwise(2 * most)), "UTF-16LE")

    return F.when(F.octet_length(text) <= most, text).when(utf16_length(text) == F.length(text), F.substring(text, 1, most)).otherwise(let(F.encode(text, "UTF-16LE"), cut))


def short_error(error: Column, most: int = 500) -> Column:
    """An error fit for storing: null becomes empty, a long one ends with an ellipsis."""
    return F.when(error.isNull(), F.lit("")).when(F.length(error) <= most, error).otherwise(F.concat(F.substring(error, 1, most), F.lit("…")))


def one_line(text: Column, most: int = 160) -> Column:
    """White space runs made one blank, ends trimmed, long text cut."""
    return short_error(F.trim(F.regexp_replace(text, r"\s+", " ")), most)


def host_of(url: Column) -> Column:
    """The host of an address, without scheme, port and path."""
    return F.nullif(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/:?#]+)", 1), F.lit(""))


def valid_server(url: Column) -> Column:
    return F.coalesce(host_of(url).isNotNull(), F.lit(False))


def base_url(url: Column) -> Column:
    """An address without one trailing slash."""
    return F.regexp_replace(F.trim(url), "/$", "")


def base64_plain(data: Column) -> Column:
    """Base64 without line breaks."""
    return F.regexp_replace(F.base64(data), "[\r\n]", "")


def hex_head(data: Column, n: int = 8) -> Column:
    """The first bytes in hex, parted by blanks, with an ellipsis if there are more."""
    shown = F.regexp_replace(F.hex(F.substring(data, 1, n)), "(..)(?=.)", "$1 ")
    return F.when(F.octet_length(data) > n, F.concat(shown, F.lit(" …"))).otherwise(shown)


def sniff(data: Column) -> Column:
    """A payload's format, by its first bytes alone."""
    found = None
    for name, head in MAGIC:
        hit = F.startswith(data, F.lit(bytearray(head)))
        found = F.when(hit, name) if found is None else found.when(hit, name)
    return F.when(data.isNull() | (F.octet_length(data) == 0), "UNKNOWN").otherwise(found.otherwise("UNKNOWN"))


def seconds_between(a: Column, b: Column) -> Column:
    """Second boundaries between two instants."""
    return F.unix_seconds(b.cast("timestamp")) - F.unix_seconds(a.cast("timestamp"))


def word_field_results(text: Column) -> Column:
    """A word processor's text without field codes and control marks; a field's result stays."""
    text = F.regexp_replace(F.coalesce(text, F.lit("")), "\x13[^\x14\x15]*\x14([^\x15]*)\x15", "$1")
    text = F.regexp_replace(text, "\x13[^\x15]*\x15", "")
    return F.regexp_replace(text, "[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", "")


def enriched(header: Column, text: Column) -> Column:
    """What is stored for a document: its header, if any, a line end and its text."""
    return F.when(F.coalesce(header, F.lit("")) == "", text).otherwise(F.concat(header, F.lit("\n"), text))
