from __future__ import annotations

import random

import pytest

DDL = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """A documents table with extra columns whose names clash with the operators' own."""

    def build(rows, extra: bool = True):
        rows = [(*r, "en", "src0", None if r[1] is None else len(r[1])) if len(r) == 2 else r for r in rows]
        frame = spark.createDataFrame(rows, DDL)
        if not extra:
            return frame
        from pyspark.sql import functions as F

        names = ["n_words", "found", "mark", "digest", "node", "size", "shard", "length", "score", "own_n_words", "late_found", "keys", "part"]
        return frame.withColumns({n: F.lit("clash") for n in names})

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and white texts, ties, repeated rows, letters of several planes, a very long text."""
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "Éa", "ñu", "日本", "😀", "x#y", "a|b", "<|endoftext|>", "don't", "12345", "THE"]
    prose = lambda n: " ".join(rng.choice(words) + str(rng.randrange(50)) * rng.randrange(2) for _ in range(n))
    base = prose(300)
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one"), (6, "one two three"), (7, base), (8, base), (9, base + " tail end"), (10, base[: len(base) // 2]), (11, prose(30_000)), (12, "x" * 100_000)]
    rows += [(13, "same line\n" * 60), (14, "a  b   c \n\n d"), (15, " lead " + prose(40) + "  "), (16, "\x0b\x0c\r\x1c é "), (17, prose(4)), (18, prose(5)), (19, prose(64))]
    return rows + [(20 + k, prose(60) + " " + base) for k in range(3)]


@pytest.fixture(scope="session")
def prose():
    def build(rng: random.Random, n: int, size: int = 400) -> str:
        return " ".join(f"w{rng.randrange(size)}" for _ in range(n))

    return build
