"""Runs of words against a plain version."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.brute import WORD

from docloom.llm import periods


def plain(words: list, least: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by their definition."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= 2 * q:
                found.setdefault((start, i + q), q)  # the smallest period comes first
    return sorted((s, e - s, q) for (s, e), q in found.items() if e - s >= max(least, 2 * q))


@settings(max_examples=500, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=50), st.sampled_from([2, 4, 12]))
def test_runs_equal_plain(words, least):
    assert periods.runs(np.array(words, np.int64), least) == plain(words, least)


def test_runs_of_structured_words():
    """Powers, Fibonacci and Thue-Morse words, long periods."""
    a, b = [0], [0, 1]
    while len(b) < 600:
        a, b = b, b + a
    morse = [bin(k).count("1") % 2 for k in range(512)]
    rng = random.Random(1)
    block = [rng.randrange(9) for _ in range(90)]
    for words in (b, morse, [1] * 300, block * 5 + block[:40], [0] * 40 + [1] * 40 + [0, 1] * 30, block + block[::-1] + block):
        for least in (2, 12):
            assert periods.runs(np.array(words), least) == plain(words, least)


def test_a_false_hash_is_found_out(monkeypatch):
    """With a base that makes hashes lie, the search is done again."""
    bases = iter([1, 1, 123_456_789_123])

    class Rng:
        def __init__(self, seed):
            pass

        def randrange(self, low, high):
            return next(bases)

    monkeypatch.setattr(periods.random, "Random", Rng)
    words = [1, 2, 3, 4, 5, 6, 7, 8, 9, 12, 11, 14] + [1, 2, 3, 4, 5, 6, 7, 8, 9, 11, 12, 14] + [1, 2, 3, 4, 5, 6, 7, 8, 9, 12, 11, 14]
    assert periods.runs(np.array(words), 12) == plain(words, 12)
    assert next(bases, None) is None


def expected(doc_id, text, planted: bool = True) -> tuple:
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if planted and n and h % 10 == 0:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = plain(words, 12) if n < 2000 else periods.runs(np.unique(words, return_inverse=True)[1], 12)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    exponent = None if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, len(found), *best, exponent, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_op13(spark, make, odd_rows, prose, tmp_path):
    rng = random.Random(2)
    rows = odd_rows + [(100 + k, prose(rng, rng.randrange(10, 400), rng.choice([2, 5, 400]))) for k in range(120)]
    rows += [(300 + k, (prose(rng, 7) + " ") * 9 + prose(rng, 30) + " " + "é日 x " * 30) for k in range(20)]
    rows += [rows[-1], (None, "a b " * 20), (None, None)]
    make(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in periods.op13_periodic_runs(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted((expected(i, t) for i, t in rows), key=str)
    assert sum(r[1] > 0 for r in got) > 30


def test_texts_and_edges(spark, make):
    text = "go on and on and on and on and on and on now"
    row = periods.periodic_runs(make([(1, text)])).first()
    assert (row.n_runs, row.longest, row.runs, row.kept) == (0, None, [], text)
    row = periods.periodic_runs(make([(1, text)]), least=8).first()
    assert (row.n_runs, tuple(row.longest), [tuple(r) for r in row.runs], row.kept) == (1, (1, 11, 2), [(1, 11, 2)], "go on and now")
    assert periods.periodic_runs(make([])).isEmpty()
    many = periods.periodic_runs(make([(1, "a " * 200_000), (2, "a b " * 100_000 + "c"), (2, "a")])).collect()
    assert sorted((r.doc_id, r.n_runs, r.kept) for r in many) == [(1, 1, "a"), (2, 0, "a"), (2, 1, "a b c")]
