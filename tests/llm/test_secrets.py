"""The combined automaton and the secret scans against Python's regular expressions."""

from __future__ import annotations

import hashlib
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docloom.llm import automaton, secret_scans
from docloom.llm.automaton import Rule, Scanner
from docloom.llm.secret_scans import BASE, MORE

RULES = BASE + MORE
PIECES = ["password", "PassWd", "secret", "Token", "api_key", "APIKEY", "api", "=", ":", " ", "  ", '"', "'", "abc", "deadbeef" * 3, "0123456789", "f" * 40, "AKIA", "A1B2C3D4E5F6", "xoxb-", "ghp_", "a" * 37, "eyJ", ".", "-", "-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN ", "://", "user", "@", "é", "日", "\n", "ſecret", "Z" * 9]
TEXTS = st.lists(st.sampled_from(PIECES), max_size=30).map("".join)


def plain(text: str, rules=RULES) -> list[tuple[str, int, int]]:
    """Spans by `re`, one rule after the other."""
    out = []
    for k, rule in enumerate(rules):
        for m in re.finditer(rule.pattern, text, re.ASCII | (re.IGNORECASE if rule.fold else 0)):
            length = len(m[2]) if rule.tail else len(m[0])
            if length >= rule.least:
                out.append((m.start(), k, rule.name, m.end()))
    return [(name, a, b) for a, _, name, b in sorted(out)]


@pytest.fixture(scope="module")
def scan():
    return Scanner(RULES)


@settings(max_examples=400, deadline=None)
@given(st.lists(TEXTS, max_size=6))
def test_scan_equals_plain(texts):
    found = secret_scans.spans_of(cached(), pa.array(texts, pa.string()))
    assert [[(s["kind"], s["start"], s["end"]) for s in x] for x in found] == [plain(t) for t in texts]


_CACHE: list[Scanner] = []


def cached() -> Scanner:
    if not _CACHE:
        _CACHE.append(Scanner(RULES))
    return _CACHE[0]


def test_lanes_continue_one_another(scan):
    """Matches across lanes, in values longer than many lanes, and one that ends at the end of the text."""
    for before in (0, 1, 500, 511, 512, 513, 5000):
        text = "x " * (before // 2) + "y" * (before % 2) + " token = " + "Ab1" * 900 + ' ; "' + "0f" * 2000
        got = secret_scans.spans_of(scan, pa.array([text, None, text + "g", ""]))
        assert [[(s["kind"], s["start"], s["end"]) for s in x] for x in got] == [plain(text), [], plain(text + "g"), []]


def test_failing_matches_take_their_place(scan):
    for text in ("token: secret: abcdefghij", "token=secret=abcdefgh12", "AKIAAKIA12345678", "password = 'short' password='long enough' secret==abcdefg"):
        got = secret_scans.spans_of(scan, pa.array([text]))[0]
        assert [(s["kind"], s["start"], s["end"]) for s in got] == plain(text)


@settings(max_examples=150, deadline=None)
@given(st.sampled_from(["ab+", "a(b|c)+d?d", "[ab]{2,4}c", "x[^xy]y", "(ab|abc|b)q+", "aa(ba)*z"]), st.text("abcdqxyz", max_size=60))
def test_other_rules(pattern, text):
    rule = [Rule("r", pattern)]
    try:
        scan = Scanner(rule)
    except ValueError:
        return
    got = secret_scans.spans_of(scan, pa.array([text]))[0]
    assert [(s["start"], s["end"]) for s in got] == [m.span() for m in re.finditer(pattern, text)]


@pytest.mark.parametrize(("pattern", "fault"), [("a", "one byte"), ("a*", "nothing at all"), ("ab(cd)?", "becomes incomplete"), ("abcd|bc", "before an earlier"), (r"(ab)\1", "can't have"), ("^ab", "can't have"), ("ab+?", "can't have")])
def test_rules_that_one_pass_cannot_scan(pattern, fault):
    with pytest.raises(ValueError, match=fault):
        Scanner([Rule("r", pattern)])


def test_minimal_automata():
    assert len(automaton.scanner(Rule("r", "(aa|ab|ba|bb)(c|c)")).table) == len(automaton.scanner(Rule("r", "[ab][ab]c")).table)
    whole = automaton.combined([automaton.scanner(Rule("r", p)) for p in ("ab+", "bc+")])
    assert whole.marks[0] == 0 and set(whole.marks.tolist()) == {0, 1, 2}


def test_op11(spark, make, odd_rows):
    rows = odd_rows + [(30, "é token: abcdefgh日"), (30, "é token: abcdefgh日"), (None, "AKIA" + "B" * 20), (31, "日" * 3000 + " secret='" + "0a" * 20 + "' ghp_" + "x" * 36)]
    got = secret_scans.secret_spans(make(rows)).collect()
    key = lambda x: (x[0] or -1, str(x[1]))
    assert sorted(((r.doc_id, [(s.kind, s.start, s.end) for s in r.spans]) for r in got), key=key) == sorted(((i, plain(t or "")) for i, t in rows), key=key)
    assert secret_scans.secret_spans(make([])).isEmpty()
    damaged = spark.sql("select 1L as doc_id, cast(x'FF746F6B656E3A6162636465666768FF' as string) as text")
    assert [(s.kind, s.start, s.end) for s in secret_scans.secret_spans(damaged).first().spans] == [("assign", 1, 15)]


def test_op11_query(spark, make, odd_rows, tmp_path):
    rows = [*odd_rows, (30, "token: abcdefgh AKIA" + "B" * 20), (31, "f" * 40 + " Api_Key=\"" + "e" * 40)]
    make(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = secret_scans.op11_secret_scans(spark, str(tmp_path)).toPandas().sort_values("doc_id").values.tolist()
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    names = "doc_id, n_assign, n_access, n_hex, base_sha256, spans"
    assert got == [list(r) for r in con.sql(f"select {names} from ({secret_scans.OP11_SQL}) order by doc_id").fetchall()]
    base = ",".join(f"{k}:{a}:{b}" for k, a, b in plain(rows[-1][1], BASE))
    assert got[-1][1:5] == [1, 0, 2, hashlib.sha256(base.encode()).hexdigest()]
    assert np.sum([r[1] for r in got]) == 2
