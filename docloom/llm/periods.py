"""Runs of words: stretches that repeat with a period, found through Lyndon words, and texts with each run collapsed to its first period.

A run is a stretch with smallest period q, at least 2q words long, that no neighbouring word extends. Every run holds a
Lyndon word of length q, the longest one at its start, of the words' order or of the opposite one. So both orders are gone
through from right to left: a stack (each place's next smaller suffix) gives the longest Lyndon word at every place, and its
square is extended to both sides. Suffixes are compared, and stretches extended, by the longest common extension: the first
words directly, then by prefix hashes modulo a prime in growing and shrinking steps; where two stretches differ, they are
told apart by the words. Every run found is verified word by word; should a hash have lied, the search is done again
with another base.

Only words in repeated windows go through that: a run of L >= LEAST words has L - q >= LEAST / 2 words that occur again q
words later, so all its words lie in windows of LEAST / 2 words that the text holds twice. Stretches of other words can't
touch a run and are left out beforehand (numpy, over chunks of texts).

Edge cases: null and empty texts have no words and no runs; bytes that aren't UTF-8 count as U+FFFD; null ids and repeated
rows are rows like others; an empty table gives an empty result; other columns are ignored; a text is read whole by one
task, in memory and time that grow with its words (times the logarithm of the longest run's length).
"""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.shared import documents, flat_text, id_and_text, map_chunks
from docloom.llm.textstats import covered
from docloom.llm.wordflow import SPACE, bounds, fits, joined, mixed, windows

LEAST = 12
PRIME = (1 << 61) - 1
#: Words that are compared one by one before hashes are.
DIRECT = 8

Run = tuple[int, int, int]


class Extensions:
    """Longest common extensions of places in a sequence of numbers from 1 on."""

    def __init__(self, words: list[int], base: int):
        self.words = words
        self.sums, self.powers = [0], [1]
        h, power = 0, 1
        for w in words:
            h = (h * base + w) % PRIME
            power = power * base % PRIME
            self.sums.append(h)
            self.powers.append(power)

    def same(self, i: int, j: int, size: int) -> bool:
        sums, power = self.sums, self.powers[size]
        return (sums[i + size] - sums[i] * power - sums[j + size] + sums[j] * power) % PRIME == 0

    def right(self, i: int, j: int) -> int:
        """How many words from i and from j > i on are the same."""
        words, most = self.words, len(self.words) - j
        near = min(most, DIRECT)
        for k in range(near):
            if words[i + k] != words[j + k]:
                return k
        done, step = near, DIRECT
        while done + step <= most and self.same(i + done, j + done, step):
            done += step
            step *= 2
        while step:
            if done + step <= most and self.same(i + done, j + done, step):
                done += step
            step //= 2
        return done

    def left(self, i: int, j: int) -> int:
        """How many words before i and before j > i are the same."""
        words, most = self.words, i
        near = min(most, DIRECT)
        for k in range(1, near + 1):
            if words[i - k] != words[j - k]:
                return k - 1
        done, step = near, DIRECT
        while done + step <= most and self.same(i - done - step, j - done - step, step):
            done += step
            step *= 2
        while step:
            if done + step <= most and self.same(i - done - step, j - done - step, step):
                done += step
            step //= 2
        return done


def candidates(words: list[int], base: int, least: int) -> set[Run]:
    """(start, end, period) of the runs of at least `least` words."""
    n, ext = len(words), Extensions(words, base)
    right, left = ext.right, ext.left
    found: set[Run] = set()
    known: dict[int, tuple[int, int]] = {}  # the leftmost stretch so far of each period
    for opposite in (False, True):
        known.clear()
        after = [n] * (n + 1)  # where the next smaller suffix begins
        for i in range(n - 1, -1, -1):
            j, same = i + 1, 0
            while j < n:
                stretch = known.get(j - i)
                same = stretch[1] - j if stretch and stretch[0] <= i and j <= stretch[1] else right(i, j)
                if j + same == n or (words[i + same] < words[j + same]) == opposite:
                    break
                j, same = after[j], 0
            after[i] = j
            period = j - i
            stretch = known.get(period)
            if stretch and stretch[0] <= i and j <= stretch[1]:
                continue
            before = left(i, j)
            if before + same >= period:
                known[period] = (i - before, j + same)
                if period + before + same >= least:
                    found.add((i - before, j + same, period))
    return found


def is_run(words: np.ndarray, run: Run) -> bool:
    start, end, period = run
    inside = np.array_equal(words[start : end - period], words[start + period : end])
    return inside and (start == 0 or words[start - 1] != words[start + period - 1]) and (end == len(words) or words[end] != words[end - period])


def runs(words: np.ndarray, least: int = LEAST) -> list[Run]:
    """(start, length, period) of the runs of at least `least` words, by start and period."""
    rng = random.Random(len(words))
    while True:
        found = candidates((words.astype(np.int64) + 1).tolist(), rng.randrange(1 << 40, PRIME), least)
        if all(is_run(words, r) for r in found):
            return sorted((s, e - s, p) for s, e, p in found)


def stretches(codes: np.ndarray, first: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(text, start, end) of the stretches of words that can hold a run."""
    size = least // 2
    text, ok = fits(first, len(codes), size)
    at = np.flatnonzero(ok)
    key = joined(text[at].astype(np.uint64), windows(mixed(codes.astype(np.uint64)), size)[at])
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(at), dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    if not again.any():
        return []
    inside = covered(at[again], len(codes), size)
    cut = np.zeros(len(codes) + 1, dtype=bool)
    cut[first] = True
    begin = np.flatnonzero(inside & (np.r_[True, ~inside[:-1]] | cut[:-1]))
    end = np.flatnonzero(inside & (np.r_[~inside[1:], True] | cut[1:])) + 1
    long = end - begin >= least
    return list(zip(text[begin[long]].tolist(), begin[long].tolist(), end[long].tolist(), strict=True))


def as_they_are(doc_ids: list[int | None], first: np.ndarray) -> np.ndarray:
    return np.arange(first[-1])


def repeated_tails(doc_ids: list[int | None], first: np.ndarray) -> np.ndarray:
    """The place that each word is taken from, where texts whose id's checksum ends in 0 get a tail that repeats itself (a null id's doesn't)."""
    out = np.arange(first[-1])
    for k, doc_id in enumerate(doc_ids):
        n = int(first[k + 1] - first[k])
        if doc_id is None or not n:
            continue
        group, last = divmod(zlib.crc32(str(doc_id).encode()), 10)
        if last == 0:
            a = group % n
            period = 1 + (n - a) // (3 + group % 8)
            out[first[k] + a : first[k + 1]] = first[k] + a + np.arange(n - a) % period
    return out


def periodic_runs(docs: DataFrame, least: int = LEAST, taken: Callable = as_they_are, digest_only: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_runs, longest (start, length, period) or null, runs array of the same, kept) of every row.

    `kept` are the words outside runs and those of each run's first period, joined by one blank. `taken` may rearrange a
    text's words beforehand. With `digest_only` runs_sha256 and kept_sha256 stand for both columns.
    """

    def run(chunk: pa.RecordBatch) -> dict:
        data, offsets = flat_text(chunk.column("text"))
        starts, ends, first = bounds(data, offsets)
        sizes = np.r_[0, np.cumsum(ends - starts)].astype(np.int64)
        compact = np.ascontiguousarray(data[~SPACE[data]])
        codes = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(sizes), pa.py_buffer(compact)]).dictionary_encode().indices.to_numpy()
        source = taken(chunk.column("doc_id").to_pylist(), first)
        codes = codes[source]
        found: list[list[Run]] = [[] for _ in range(len(first) - 1)]
        change = np.zeros(len(codes) + 1, np.int64)
        for text, a, b in stretches(codes, first, least):
            for start, length, period in runs(codes[a:b], least):
                found[text].append((a + start - int(first[text]), length, period))
                change[a + start + period] += 1
                change[a + start + length] -= 1
        stay = np.flatnonzero(np.cumsum(change[:-1]) == 0)
        raw = compact.tobytes()
        words = [raw[a:b] for a, b in zip(sizes[source[stay]].tolist(), sizes[source[stay] + 1].tolist(), strict=True)]
        kept = [b" ".join(words[a:b]) for a, b in itertools.pairwise(np.searchsorted(stay, first).tolist())]
        found = [sorted(x, key=lambda r: (r[0], r[2])) for x in found]
        as_rows = lambda x: [dict(zip(("start", "length", "period"), r, strict=True)) for r in x]
        longest = [as_rows([min(x, key=lambda r: (-r[1], r[0], r[2]))])[0] if x else None for x in found]
        out = {"doc_id": chunk.column("doc_id"), "n_runs": [len(x) for x in found], "longest": longest}
        if not digest_only:
            return out | {"runs": [as_rows(x) for x in found], "kept": [x.decode("utf-8", "replace") for x in kept]}
        sha = lambda x: hashlib.sha256(x).hexdigest()
        return out | {"runs_sha256": [sha("".join(f"{s},{n},{p}\n" for s, n, p in x).encode()) for x in found], "kept_sha256": [sha(x) for x in kept]}

    shape = "struct<start: long, length: long, period: long>"
    rest = "runs_sha256 string, kept_sha256 string" if digest_only else f"runs array<{shape}>, kept string"
    return map_chunks(id_and_text(docs, id_col, text_col), run, f"doc_id long, n_runs long, longest {shape}, {rest}")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(documents(spark, sf_dir), taken=repeated_tails, digest_only=True)
    exponent = F.floor(1000 * F.col("longest.length") / F.col("longest.period")).cast("long")
    return found.select("doc_id", "n_runs", "longest.start", "longest.length", "longest.period", exponent.alias("exponent_milli"), "runs_sha256", F.col("kept_sha256").alias("collapsed_sha256"))
