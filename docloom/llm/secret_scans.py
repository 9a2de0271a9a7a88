"""Secrets in texts: all rules in one pass over the bytes of whole texts, by one automaton (automaton.py).

The driver compiles the rules; tasks get the transition arrays. Three base rules find assignments, access key ids and long
hexadecimal runs; the others know the published forms of common credentials. Each rule's matches are the leftmost ones
that don't overlap; matches of different rules may.

Edge cases: null and empty texts have no spans; bytes that aren't UTF-8 count as U+FFFD; places count code points, ends
are exclusive; null ids and repeated rows are rows like others; an empty table gives an empty result; other columns are
ignored; a text of any length is read whole, in lanes that continue one another.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.automaton import BREAK, Rule, Scanner
from docloom.llm.shared import documents, flat_text, id_and_text, map_chunks

#: Fixed patterns: those of the base kinds, then published forms of credentials.
BASE = [
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", least=8, tail=True, fold=True),
    Rule("access", r"AKIA[A-Z0-9]+", least=16),
    Rule("hex", r"[0-9a-f]{32,}"),
]
MORE = [
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", least=30),
    Rule("pem", r"-----BEGIN[A-Z0-9\x20]*PRIVATE\x20KEY-----"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", least=15),
    Rule("url", r"://[A-Za-z0-9._~%-]+:[A-Za-z0-9._~%!$&*+-]+@"),
]


def joined_texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(the texts' bytes with a break after each, where each begins and one more)."""
    flat, offsets = flat_text(column)
    n = len(offsets) - 1
    out = np.full(len(flat) + n, BREAK, np.uint8)
    out[np.arange(len(flat)) + np.repeat(np.arange(n), np.diff(offsets))] = flat
    return out, offsets + np.arange(n + 1)


def spans_of(scan: Scanner, column: pa.Array) -> list[list[dict]]:
    """The spans of each text, by start, then kind as listed."""
    data, begin = joined_texts(column)
    rule, start, end = scan.matches(data)
    text = np.searchsorted(begin, start, side="right") - 1
    points = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
    names = [r.name for r in scan.rules]
    out: list[list[dict]] = [[] for _ in range(len(begin) - 1)]
    columns = (text, rule, points[start] - points[begin[text]], points[end] - points[begin[text]])
    for t, r, a, b in zip(*(x.tolist() for x in columns), strict=True):
        out[t].append({"kind": names[r], "start": a, "end": b})
    return out


def secret_spans(docs: DataFrame, rules: list[Rule] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans array of (kind, start, end)) of every row."""
    scan = Scanner(BASE + MORE if rules is None else rules)

    def run(chunk: pa.RecordBatch) -> dict:
        return {"doc_id": chunk.column("doc_id"), "spans": spans_of(scan, chunk.column("text"))}

    return map_chunks(id_and_text(docs, id_col, text_col), run, "doc_id long, spans array<struct<kind: string, start: long, end: long>>")


def listed(spans: Column) -> Column:
    """kind:start:end of the spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def op11_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(documents(spark, sf_dir))

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s.kind.isin(*kinds))

    counts = [F.size(of(r.name)).cast("long").alias(f"n_{r.name}") for r in BASE]
    base = of(*[r.name for r in BASE])
    return found.select("doc_id", *counts, F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def _matches_sql(k: int, rule: Rule) -> str:
    """A rule's matches and the pieces between them give the places."""
    pattern = rule.pattern
    if rule.fold:  # the keywords in front; the rest has no letters outside classes that hold both cases
        pattern = re.sub(r"^\(.*?\)", lambda m: re.sub("[a-z]", lambda c: f"[{c[0].upper()}{c[0]}]", m[0]), pattern)
    pattern = pattern.replace("'", "''")
    counted = "regexp_extract(m, '^[^:=]*[:=]\\x20*[\"'']?(.*)$', 1)" if rule.tail else "m"
    return f"""
select n, {k} as k, '{rule.name}' as kind, m, list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) as a
from (select n, ms, p, unnest(ms) as m, unnest(range(1, len(ms) + 1)) as i
      from (select n, regexp_extract_all(t, '{pattern}') as ms, string_split_regex(t, '{pattern}') as p from texts) where len(ms) > 0)
where length({counted}) >= {rule.least}"""


_SPAN = "concat(kind, ':', cast(a as bigint), ':', cast(a as bigint) + length(m)), ',' order by a, k"
OP11_SQL = f"""
with texts as (select row_number() over () as n, cast(doc_id as bigint) as doc_id, coalesce(text, '') as t from documents),
spans as ({" union all ".join(_matches_sql(k, r) for k, r in enumerate(BASE + MORE))}),
listed as (select n, count(*) filter (k = 0) as n_assign, count(*) filter (k = 1) as n_access, count(*) filter (k = 2) as n_hex,
                  string_agg({_SPAN}) filter (k < 3) as base, string_agg({_SPAN}) as spans from spans group by n)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from texts left join listed using (n)
"""
