"""BPE rounds, token counts, packing and sharding against the libraries and the laws of their contracts."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docloom.llm import bpe, packing, sharding, token_counts
from docloom.llm.shared import scratch

public_tokenizers = pytest.importorskip("public_tokenizers")
BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def library(path):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


TEXTS = st.one_of(st.text(max_size=60), st.lists(st.sampled_from(["a", " ", "  ", "\n", "\t", "'s", "don't", "ab", "é", "日本", "😀", "12", "!!", "<|endoftext|>", " ", " ", "\x85", "\x1c", "Ǆ", "ß"]), max_size=25).map("".join))


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_rounds_equal_library(text):
    ids = bpe.Encoder(BYTES)([text])[0]
    lib = library_cache(BYTES)
    expected = lib.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ids, "<u4").tolist() == expected
    assert bpe.decode(BYTES, ids) == lib.decode(expected, skip_special_tokens=False)
    assert token_counts.Counter(BYTES)([text]) == [len(expected)]


_CACHE: dict = {}


def library_cache(path):
    return _CACHE.setdefault(path, library(path))


def test_op3_and_op10(spark, make, odd_rows):
    lib = library_cache(BYTES)
    rows = odd_rows + odd_rows[3:6] + [(None, "no id")]
    expected = []
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        text = lib.decode(ids, skip_special_tokens=False)
        expected.append((i or -1, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    got = [(r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.bpe_round_trip(make(rows), BYTES).collect()]
    assert sorted(got) == sorted(expected)
    kept = bpe.bpe_round_trip(make(rows[:8]), BYTES, with_ids=True).collect()
    assert {r.doc_id: r.ids for r in kept} == {i: lib.encode(t or "", add_special_tokens=False).ids for i, t in rows[:8]}
    cache = scratch(spark, "test-cache")
    for _ in range(2):  # the second time from the cache alone
        counts = token_counts.token_counts(make(rows), BYTES, cache, limit=64).collect()
        assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in counts) == sorted((i or -1, len((t or "").encode()), n[1], n[1] > 64) for (i, t), n in zip(rows, expected, strict=True))
    assert spark.read.parquet(cache).count() == len({t or "" for _, t in rows})
    assert token_counts.token_counts(make([]), BYTES, scratch(spark, "test-cache")).isEmpty() and bpe.bpe_round_trip(make([]), BYTES).isEmpty()


def test_other_forms_are_refused(make):
    with pytest.raises(ValueError, match="pre-tokenizer"):
        bpe.bpe_round_trip(make([(1, "a")]), WORDS)


def test_invalid_utf8(spark):
    raw = spark.createDataFrame([(1, bytearray(b"ab \xff cd")), (2, bytearray(b"\xc3"))], "doc_id long, raw binary").selectExpr("doc_id", "cast(raw as string) as text")
    lib, fixed = library_cache(BYTES), {1: "ab \ufffd cd", 2: "\ufffd"}
    assert {r.doc_id: r.n_tokens for r in bpe.bpe_round_trip(raw, BYTES).collect()} == {i: len(lib.encode(t, add_special_tokens=False).ids) for i, t in fixed.items()}
    assert {r.doc_id: r.n_bytes for r in token_counts.token_counts(raw, BYTES, scratch(spark, "test-cache")).collect()} == {i: len(t.encode()) for i, t in fixed.items()}
    assert packing.pack(raw, WORDS).count() == 2


def test_cached_texts_are_not_shuffled(spark, make, prose, tmp_path):
    """With all digests known no text is fetched; with one missing, only its text passes a shuffle; copies of one text are counted by the broadcast."""
    rng = random.Random(3)
    rows = [(k, prose(rng, 30)) for k in range(40)] + [(100 + k, "one hot text") for k in range(30)]
    cache = scratch(spark, "test-cache")
    first = {r.doc_id: r.n_tokens for r in token_counts.token_counts(make(rows), BYTES, cache).collect()}
    assert first == {i: len(library_cache(BYTES).encode(t, add_special_tokens=False).ids) for i, t in rows}
    files = set(spark.read.parquet(cache).inputFiles())
    assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(make(rows), BYTES, cache).collect()} == first
    assert spark.read.parquet(cache).count() == 41 and {f for f in set(spark.read.parquet(cache).inputFiles()) - files if spark.read.parquet(f).count()} == set()
    keyed = make(rows).selectExpr("unhex(sha2(text, 256)) as digest", "text")
    texts = token_counts.missing_texts(keyed, keyed.where("text = 'one hot text'").select("digest").distinct())
    assert [r.text for r in texts.collect()] == ["one hot text"]
    plan = texts._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftSemi" in plan and plan.index("Aggregate") < plan.index("Join LeftSemi")


def test_other_tokenizer_versions_miss(spark, make):
    cache = scratch(spark, "test-cache")
    one = token_counts.token_counts(make([(1, "Hello there")]), BYTES, cache).first().n_tokens
    other = token_counts.token_counts(make([(1, "Hello there")]), WORDS, cache).first().n_tokens
    assert spark.read.parquet(cache).select("tokenizer").distinct().count() == 2 and one and other


def laws_of_packing(rows, pieces, window=4096):
    lib = library_cache(WORDS)
    ids = {i: [*lib.encode(t or "", add_special_tokens=False).ids, 2] for i, t in rows}
    docs, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        docs[p.doc_id].append(p)
        sequences[p.sequence_id].append(p)
        own = np.array(ids[p.doc_id][p.start : p.start + p.length], "<u4").tobytes()
        assert zlib.crc32(own) == p.ids_crc32 and len(ids[p.doc_id]) == p.doc_tokens
    for i, own in docs.items():
        at = 0
        for p in sorted(own, key=lambda p: p.start):
            assert p.start == at
            at += p.length
        assert at == len(ids[i])
    assert set(docs) == set(ids)
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
    return sum(map(len, ids.values())), len(sequences)


def test_packing_laws(make, odd_rows, prose):
    rng = random.Random(2)
    rows = odd_rows + [(1000 + k, prose(rng, int(rng.paretovariate(1.1) * 20) % 6000)) for k in range(400)]
    pieces = packing.pack(make(rows), WORDS).collect()
    tokens, sequences = laws_of_packing(rows, pieces)
    assert tokens / (sequences * 4096) > 0.97
    assert packing.pack(make([]), WORDS).isEmpty()
    few = packing.pack(make([(1, None), (2, "a b")]), WORDS).collect()
    laws_of_packing([(1, None), (2, "a b")], few)


def test_word_ids_equal_library(odd_rows):
    texts = [(t or "") for _, t in odd_rows]
    got = packing.token_ids(WORDS, [t.encode() for t in texts])
    assert packing.splits_at_space(WORDS)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [x.ids for x in library_cache(WORDS).encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=64, max_size=64))
def test_plan_places_every_piece(counts):
    counts = np.array([0, *counts[1:]], np.int64)
    rows, n = packing.plan(counts, window=64, step=8)
    fill = np.zeros(n, np.int64)
    for length in range(1, 64):
        own = rows[rows[:, 0] == length]
        own = own[np.argsort(own[:, 1])]
        for r in range(counts[length]):
            hit = own[np.searchsorted(own[:, 1], r, side="right") - 1]
            fill[hit[2] + (hit[3] + r - hit[1]) // hit[4]] += length
    assert fill.max(initial=0) <= 64 and (fill > 0).all() and fill.sum() == (counts * np.arange(64)).sum()


def plain_packing(lengths: list[int], window: int) -> int:
    """Sequences of first-fit decreasing, piece by piece."""
    room: list[int] = []
    for n in sorted(lengths, reverse=True):
        k = next((k for k, r in enumerate(room) if r >= n), None)
        if k is None:
            room.append(window - n)
        else:
            room[k] -= n
    return len(room)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_plan_is_as_tight_as_plain_packing(seed):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(4095, 1 + (rng.pareto(1.2, 3000) * 120).astype(int))
    rows, n = packing.plan(np.bincount(lengths, minlength=4096))
    assert -(-int(lengths.sum()) // 4096) <= n <= 1.01 * plain_packing(lengths.tolist(), 4096) + 1


def test_nnls_is_optimal():
    rng = np.random.default_rng(1)
    a, b = rng.random((12, 30)), rng.random(12) * 10
    x = packing.nnls(a, b)
    slope = a.T @ (a @ x - b)
    assert (x >= 0).all() and slope.min() > -1e-5 and np.abs(slope[x > 1e-6]).max() < 1e-5


@pytest.mark.parametrize("shards", [1, 5, 24])
def test_sharding_law(make, odd_rows, shards):
    rows = odd_rows + odd_rows[:6] + [(None, "no id")] + [(100 + k, f"text {k % 30}") for k in range(300)]
    got = sharding.shard(make(rows), shards).collect()
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in got) == sorted((i or -1, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    sizes = [len(by.get(k, [])) for k in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and set(by) <= set(range(shards))
    assert sharding.shard(make([]), shards).isEmpty()


def plain_walk(positions: list[int], shards: int, factor: float) -> list[int]:
    """Row by row along the ring: the shard of each position, in ring order."""
    ring = sharding.nodes(shards)
    least, more = divmod(len(positions), shards)
    exact = [least + (s < more) for s in range(shards)]
    room = exact if factor <= 1 else [max(q, int(factor * len(positions) / shards) + 1) for q in exact]
    out = []
    for p in sorted(positions):
        k = next((k for k, (at, _) in enumerate(ring) if at > p), 0)
        while not room[ring[k % len(ring)][1]]:
            k += 1
        room[ring[k % len(ring)][1]] -= 1
        out.append(ring[k % len(ring)][1])
    return out


@pytest.mark.parametrize("factor", [1.0, 1.3])
def test_sharding_equals_a_plain_walk(make, factor):
    """Row by row, hot rows and null ids among them, whatever the layout and however copies are dealt out."""
    rows = [(k, f"text {k % 17}") for k in range(400)] + [(5, "same")] * 200 + [(None, "same")] * 150 + [(5, "other")] * 3
    docs = make(rows)
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    at = docs.select("doc_id", crc.alias("crc"), F.shiftrightunsigned(F.xxhash64("doc_id", crc), 2).alias("at")).collect()
    order = sorted(at, key=lambda r: (r["at"], r.doc_id or -1, r.crc))
    wanted = sorted((r.doc_id or -1, r.crc, s) for r, s in zip(order, plain_walk([r["at"] for r in at], 7, factor), strict=True))
    results = []
    for frame, copies in ((docs, 10_000), (docs, 7), (docs.repartition(7), 10_000), (docs.repartition(3, "text"), 50), (docs.orderBy(F.rand(3)), 1)):
        got = sharding.shard(frame, 7, factor, copies=copies).collect()
        assert sorted((r.doc_id or -1, r.text_crc32, r.shard) for r in got) == wanted
        by = defaultdict(list)
        for r in got:
            by[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in by.values())
        results.append(sorted(tuple(x or -1 for x in r) for r in got))
    assert all(r == results[0] for r in results)


def test_one_shard_more_moves_little(make):
    """Loads up to a tenth over the mean, 24 shards and 25: how many rows move, beside the 1 in 25 that must."""
    docs = make([(k, f"t{k}") for k in range(20_000)])
    a, b = (sharding.shard(docs, s, load_factor=1.1).select("doc_id", F.col("shard").alias(f"s{s}")) for s in (24, 25))
    moved = a.join(b, "doc_id").where("s24 <> s25").count() / 20_000
    assert 0.02 < moved < 0.35


def test_bounded_loads_move_little(make):
    docs = make([(k, f"t{k}") for k in range(3000)])
    a, b = (sharding.shard(docs, s, load_factor=1.25).select("doc_id", F.col("shard").alias(f"s{s}")) for s in (10, 11))
    both = a.join(b, "doc_id").collect()
    assert sum(r.s10 != r.s11 for r in both) < 0.45 * 3000
    assert max(np.bincount([r.s10 for r in both])) <= 1.25 * 300 + 1
