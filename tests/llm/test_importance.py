"""Importance resampling against a plain version."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docloom.llm import importance

TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text: str | None, longest: int) -> tuple[int, list[str]]:
    words = TOKEN.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return len(words), [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def plain(docs: list, target: list, longest: int = 1, buckets: int = 10_000, percent: int = 10, least: int = 20) -> list[tuple]:
    """(doc_id, n_features, weight, score, rank) of each document, in no order."""
    at = lambda f: zlib.crc32(f.encode()) % buckets
    found = [(i, *features(t, longest)) for i, t in docs]
    s = Counter(at(f) for _, _, fs in found for f in fs)
    t = Counter(at(f) for x in target for f in features(x, longest)[1])
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets))))
    rows = []
    for i, n, fs in found:
        weight = sum(gain(at(f)) for f in fs)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, n, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = len(able) * percent // 100
    ranks = {k: n + 1 for n, k in enumerate(sorted((k for k, r in enumerate(rows) if r[1] >= least), key=lambda k: (-rows[k][4], rows[k][0] is None, rows[k][0] or 0))[:drawn])}
    return [(i, n, w, sc, ranks.get(k)) for k, (i, _, n, w, sc) in enumerate(rows)]


def ordered(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=str)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 4), max_size=12), max_size=8), st.integers(1, 4))
def test_tuples(texts, longest):
    ids = np.array([x * 7 for t in texts for x in t], np.int64)
    first = np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64)
    numbers, sizes, found, often = importance.tuples_of(ids, first, longest)
    numbers = numbers.tolist()
    for t, size in zip(texts, sizes.tolist(), strict=True):
        got = Counter(tuple(found[k].tolist()) for k in (numbers.pop(0) for _ in range(size)))
        assert got == Counter(tuple(x * 7 for x in t[i : i + n]) for n in range(1, longest + 1) for i in range(len(t) - n + 1))
    assert not numbers and len({tuple(f.tolist()) for f in found}) == len(found) and often.sum() == sizes.sum()


@pytest.fixture(scope="module")
def target(spark):
    texts = ["alpha BETA gamma é日本", None, "", "the same line 12345 alpha alpha"]
    return texts, spark.createDataFrame([(k, t, "clash") for k, t in enumerate(texts)], "item_id long, text string, chunk string")


@pytest.mark.parametrize(("longest", "buckets"), [(1, 10_000), (3, 97)])
def test_op12(spark, make, odd_rows, target, longest, buckets):
    rng = random.Random(3)
    rows = odd_rows + [(100 + k, " ".join(rng.choice(["alpha", "beta", "Gamma", "x-y", "日本é", "12345"]) for _ in range(18 + k % 5))) for k in range(60)]
    rows += [(100, rows[len(odd_rows)][1]), (None, rows[-1][1]), (None, rows[-1][1])]
    got = importance.resampled(make(rows), target[1], longest=longest, buckets=buckets, percent=50).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert ordered(got) == ordered(plain(rows, target[0], longest, buckets, percent=50))


def test_empty_tables(spark, make, target):
    assert importance.resampled(make([]), target[1]).isEmpty()
    rows = [(1, "a b c"), (2, None)] + [(k, "w " * 25) for k in range(3, 20)]
    got = importance.resampled(make(rows), target[1].limit(0)).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert ordered(got) == ordered(plain(rows, []))


def test_ranks_over_many_parts(spark):
    """A third of all rows with one score and id, ranges on several tasks: every rank once, in order."""
    from pyspark.sql import functions as F

    rows = spark.range(30_000, numPartitions=5).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 1000).alias("doc_id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("score"), F.col("id").cast("string").alias("place"))
    got = importance.ranked(rows, 20_000).collect()
    drawn = sorted((r for r in got if r.rank is not None), key=lambda r: r["rank"])
    assert len(got) == 30_000 and [r["rank"] for r in drawn] == list(range(1, 20_001))
    assert [(-r.score, r.doc_id, r.place) for r in drawn] == sorted((-r.score, r.doc_id, r.place) for r in got)[:20_000]


def test_op12_query(spark, make, odd_rows, target, tmp_path):
    rows = odd_rows + [(100 + k, f"alpha beta {k} " * 9) for k in range(40)]
    make(rows).write.parquet(f"{tmp_path}/documents.parquet")
    target[1].write.parquet(f"{tmp_path}/benchmark.parquet")
    got = ordered(importance.op12_importance_resampling(spark, str(tmp_path)).collect())
    assert got == ordered(plain(rows, target[0]))
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    assert got == ordered(con.sql(f"select doc_id, n_features, weight, score, rank from ({importance.OP12_SQL})").fetchall())
