"""The Jaccard join and substring dedup against plain versions."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.llm import jaccard, substrings
from docloom.llm.components import components
from tests.llm.brute import classes, deduplicated, shingle_set


def changed(rng: random.Random, text: str, n: int) -> str:
    words = text.split(" ")
    for _ in range(n):
        k = rng.randrange(len(words))
        words[k : k + rng.randrange(2)] = [f"z{rng.randrange(10**6)}"] * rng.randrange(3)
    return " ".join(words)


def family_rows(prose, seed: int, families: int, copies: int, sizes: tuple[int, int]) -> list[tuple[int, str]]:
    """Groups of near copies at all distances, passages that many share, and short texts."""
    rng = random.Random(seed)
    passage = prose(rng, 40, 10**6)
    rows = []
    for _ in range(families):
        base = prose(rng, rng.randrange(*sizes), 10**6)
        rows += [changed(rng, base, rng.randrange(0, max(2, len(base) // 40))) for _ in range(copies)]
    rows += [passage + " " + prose(rng, rng.randrange(5, 60), 10**6) for _ in range(40)]
    rows += [prose(rng, rng.randrange(0, 9), 3) for _ in range(60)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize(("seed", "families", "copies", "sizes"), [(1, 12, 12, (8, 40)), (2, 6, 25, (40, 200)), (3, 2, 60, (60, 90)), (4, 3, 8, (600, 1500))])
def test_jaccard_components(make, prose, seed, families, copies, sizes):
    rows = family_rows(prose, seed, families, copies, sizes)
    got = {r.doc_id: r for r in jaccard.jaccard_classes(make(rows)).collect()}
    expected = classes(rows)
    assert {i: r.component_id for i, r in got.items()} == expected
    assert all(got[i].n_shingles == len(shingle_set(t)) for i, t in rows)
    assert len(set(expected.values())) < len(rows)


def test_hot_keys_dealt_out(make, prose):
    """The same classes where nearly every group is cut into tiles and every leader salted."""
    rows = family_rows(prose, 7, 3, 40, (60, 90))
    found = jaccard.row_classes(make(rows), tile_pairs=1, many=2).collect()
    least = {}
    for r in found:
        if r.root is not None:
            least[r.root] = min(r.doc_id, least.get(r.root, r.doc_id))
    assert {r.doc_id: least.get(r.root, r.doc_id) for r in found} == classes(rows)


def test_jaccard_odd_rows(spark, make, odd_rows):
    rows = odd_rows
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_classes(make(rows)).collect())
    expected = classes(rows)
    assert got == sorted((i, len(shingle_set(t)), expected[i]) for i, t in rows)
    twice = jaccard.jaccard_classes(make(rows + rows[3:8] + [(None, "no id here at all"), (None, None)]))
    assert twice.count() == len(rows) + 7 and {r.component_id for r in twice.where("doc_id is null").collect()} == {None}
    assert {r.doc_id: r.component_id for r in twice.where("doc_id is not null").collect()} == expected
    assert jaccard.jaccard_classes(make([])).isEmpty()


def test_one_of_each(make, odd_rows):
    rows = odd_rows + odd_rows[3:8] + [(None, "no id")]
    left = jaccard.one_of_each(make(rows))
    assert left.columns == make(rows).columns
    expected = classes(odd_rows)
    assert sorted(r.doc_id for r in left.where("doc_id is not null").collect()) == sorted(i for i, c in expected.items() if i == c)
    assert left.where("doc_id is null").count() == 1


def test_one_id_with_several_texts(make, prose):
    """Unique texts survive, whichever id they share; copies go by rows."""
    rng = random.Random(6)
    a, b, c, d = (prose(rng, 200, 10**6) for _ in range(4))
    rows = [(1, a), (5, a + " more"), (5, b), (5, c), (5, c), (7, c + " more"), (8, ""), (8, ""), (None, d), (None, d), (None, a), (9, None)]
    classes_ = {(r.doc_id, r.n_shingles): r.component_id for r in jaccard.jaccard_classes(make(rows)).where("doc_id is not null").collect()}
    assert classes_ == {(1, 196): 1, (5, 197): 1, (5, 196): 5, (7, 197): 5, (8, 0): 8, (9, 0): 9}
    left = jaccard.one_of_each(make(rows))
    assert left.columns == make(rows).columns
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=key) == sorted([(1, a), (5, b), (5, c), (8, ""), (8, ""), (None, d), (9, None)], key=key)


def test_invalid_utf8(spark):
    raw = bytearray(b"good words here \xff\xfe and on and on " + b"more words to fill a window of twenty words or so in all, yes it does " * 2)
    docs = spark.createDataFrame([(1, raw), (2, raw), (3, bytearray(b"\xc3"))], "doc_id long, raw binary").selectExpr("doc_id", "cast(raw as string) as text", "'en' as lang", "'s' as source", "0L as n_chars")
    assert {r.doc_id: r.component_id for r in jaccard.jaccard_classes(docs).collect()} == {1: 1, 2: 1, 3: 3}
    assert [r.doc_id for r in jaccard.one_of_each(docs).orderBy("doc_id").collect()] == [1, 3]
    assert substrings.substring_dedup(docs).where("doc_id = 2").first().kept == ""
    assert substrings.without_repeats(docs).count() == 2


def test_every_linked_pair_shares_a_probed_key(prose):
    """The pigeonhole: sets at the very limit share a key that one of them probes, on every level and depth."""
    import pyarrow as pa

    rng = random.Random(9)
    for size in [*range(4, 40), 60, 100, 300, 1000]:
        base = [f"v{rng.randrange(10**9)}" for _ in range(size)]
        other = base.copy()
        while True:  # replace until one more would break the link
            k = rng.randrange(len(other))
            trial = other[:k] + ([f"u{rng.randrange(10**9)}"] if rng.random() < 0.5 else []) + other[k + 1 :]
            if 100 * len(set(base) & set(trial)) < 80 * len(set(base) | set(trial)):
                break
            other = trial
        sets = [np.sort(np.array([hash(x) & (2**64 - 1) for x in s], np.uint64)) for s in (base, other)]
        found, first = np.concatenate(sets), np.array([0, len(sets[0]), len(sets[0]) + len(sets[1])])
        keys, flags, which = jaccard.all_keys(found, first, np.zeros(2, bool))
        rows = [{k: f for k, f, w in zip(keys.tolist(), flags.tolist(), which.tolist()) if w == side} for side in (0, 1)]
        ok = any(k in rows[1 - s] and f & jaccard.PROBES and not (f & jaccard.ONE_DELETION and rows[1 - s][k] & jaccard.ONE_DELETION) for s in (0, 1) for k, f in rows[s].items())
        assert ok or sets[0].tolist() == sets[1].tolist(), size
    assert pa is not None


def test_sketch_is_a_bound(prose):
    import pyarrow as pa

    rng = random.Random(3)
    base = prose(rng, 300, 10**6)
    found, first = jaccard.shingles(pa.array([base, changed(rng, base, 20)]))
    a, b = (set(found[first[k] : first[k + 1]].tolist()) for k in (0, 1))
    bits = np.unpackbits(jaccard.sketches(found, first), axis=1)
    assert (bits[0] != bits[1]).sum() <= len(a ^ b)


def test_components(spark):
    rng = random.Random(1)
    pairs = [(k, k + 1) for k in range(100, 160)] + [(0, rng.randrange(1, 40)) for _ in range(60)] + [(70, 71), (71, 72), (72, 70), (80, 80)]
    frame = spark.createDataFrame(pairs, "a long, b long")
    got = {r.node: r.root for r in components(frame).collect()}
    assert {got[k] for k in range(100, 161)} == {100} and {got[k] for k in (70, 71, 72)} == {70} and 80 not in got
    assert {got[b] for a, b in pairs if a == 0} == {0}
    assert components(frame.where("false")).isEmpty()


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_substrings(make, prose, seed):
    rng = random.Random(seed)
    passages = [prose(rng, n, 10**6) for n in (15, 19, 20, 21, 27, 60, 200)]
    rows = []
    for k in range(120):
        parts = [prose(rng, rng.randrange(0, 50), 10**6) for _ in range(3)]
        parts += [rng.choice(passages) for _ in range(rng.randrange(3))]
        rng.shuffle(parts)
        rows.append((k * 7 % 120, rng.choice([" ", "\n", "  "]).join(parts)))
    rows.append((500, passages[5] + " " + passages[5]))
    rows.append((501, " ".join(["x"] * 90)))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.substring_dedup(make(rows), salts=seed).collect()}
    assert got == deduplicated(rows)


def test_substrings_odd_rows(spark, make, odd_rows):
    expected = deduplicated(odd_rows)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.substring_dedup(make(odd_rows)).collect()}
    assert got == expected
    digests = substrings.substring_dedup(make(odd_rows), digest_only=True).collect()
    assert {r.doc_id: r.kept_sha256 for r in digests} == {i: hashlib.sha256(k.encode()).hexdigest() for i, (_, _, k) in expected.items()}
    more = odd_rows + [odd_rows[6], (None, odd_rows[6][1]), (None, None)]
    again = substrings.substring_dedup(make(more)).collect()
    assert len(again) == len(more) and {r.n_removed for r in again if r.doc_id == 7} == {0}
    assert sorted(r.n_removed for r in again if r.doc_id is None) == [0, 300]
    assert substrings.substring_dedup(make([])).isEmpty()


def test_without_repeats(make, odd_rows):
    docs = make(odd_rows)
    left = substrings.without_repeats(docs)
    assert left.columns == docs.columns
    got, expected = {r.doc_id: r.text for r in left.collect()}, deduplicated(odd_rows)
    texts = dict(odd_rows)
    assert got == {i: (kept if gone else texts[i]) for i, (_, gone, kept) in expected.items() if kept or not gone}


def test_difference_cover():
    assert {(a - b) % substrings.PERIOD for a in substrings.COVER for b in substrings.COVER} == set(range(substrings.PERIOD))
    assert F is not None
