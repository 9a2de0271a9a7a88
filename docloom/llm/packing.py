"""Packing token sequences by non-negative least squares over shallow length combinations.

Documents are tokenized, ended with one id and cut at multiples of the window; each piece but a document's last one
fills a window by itself. The last pieces' lengths form a histogram of fewer than `window` numbers, whatever the
input. Lengths are gathered into classes of STEP tokens; all ways to fill a window exactly with at most DEPTH classes
are enumerated, the repeat counts that best match the histogram are solved by non-negative least squares and rounded
down, and what is left over is packed greedily, longest first, again as patterns with repeat counts. Pieces are then
ranked within their length and take sequence numbers from the patterns, so no piece passes the driver.

Edge cases: null and empty texts are one piece of the end id; bytes that aren't UTF-8 count as U+FFFD; repeated rows are
packed each; null ids are kept; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import itertools
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.llm.shared import documents, id_and_text, map_chunks, written
from docloom.llm.token_counts import library

WINDOW, END_ID = 4096, 2
STEP, DEPTH = 32, 3
#: Rows of one length that a task ranks, about.
SALT_ROWS = 20_000
#: And at most one row in so many of all.
SHARE = 200
MEMO = 1_200_000


@functools.cache
def memo_of(path: str) -> dict[bytes, bytes]:
    """Ids of the words that this Python worker has met, for one tokenizer."""
    return {}


def token_ids(path: str, texts: list[bytes]) -> list[bytes]:
    """Little-endian 32-bit ids of each text, for tokenizers whose words end at white space (asked of `splits_at_space`)."""
    memo = memo_of(path)
    if len(memo) > MEMO:
        memo.clear()
    words = [t.split() for t in texts]
    new = list(set(itertools.chain.from_iterable(words)).difference(memo))
    if new:
        got = library(path).encode([w.decode() for w in new], is_pretokenized=True, add_special_tokens=False)
        ends = (4 * np.cumsum(np.bincount(np.array(got.word_ids, dtype=np.int64), minlength=len(new)))).tolist()
        ids = np.array(got.ids, dtype="<u4").tobytes()
        memo.update(zip(new, (ids[a:b] for a, b in itertools.pairwise([0, *ends])), strict=True))
    return [b"".join(map(memo.__getitem__, w)) for w in words]


def splits_at_space(path: str) -> bool:
    """Whether the tokenizer's pattern keeps no white space, so that words can be encoded one by one."""
    import json

    spec = json.loads(library(path).to_str())
    first = ((spec["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
    return first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True


def pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): every text's ids with the end id, cut at multiples of the window."""
    by_word, last = splits_at_space(tokenizer), END_ID.to_bytes(4, "little")

    def run(chunk: pa.RecordBatch) -> dict:
        texts = chunk.column("text").fill_null("")
        if by_word:
            ids = token_ids(tokenizer, texts.cast(pa.binary()).to_pylist())
        else:
            ids = [np.array(x.ids, dtype="<u4").tobytes() for x in library(tokenizer).encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
        rows = []
        for doc, own in zip(chunk.column("doc_id").to_pylist(), ids, strict=True):
            own += last
            n = len(own) // 4
            rows += [(doc, a, min(window, n - a), zlib.crc32(own[4 * a : 4 * (a + window)]), n) for a in range(0, n, window)]
        return dict(zip(("doc_id", "start", "length", "ids_crc32", "doc_tokens"), zip(*rows, strict=True), strict=True))

    return map_chunks(id_and_text(docs, id_col, text_col), run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def combinations(parts: int, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """All multisets of at most `depth` numbers from 1 that add up to `parts`, largest first."""
    out: list[tuple[int, ...]] = []

    def grow(left: int, most: int, have: tuple[int, ...]) -> None:
        if not left:
            out.append(have)
        elif len(have) < depth:
            for x in range(min(most, left), 0, -1):
                if x * (depth - len(have)) < left:
                    break
                grow(left - x, x, (*have, x))

    grow(parts, parts, ())
    return out


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 600) -> np.ndarray:
    """x >= 0 with the least |a x - b|, by the active-set method."""
    x, free = np.zeros(a.shape[1]), np.zeros(a.shape[1], dtype=bool)
    gram, target = a.T @ a, a.T @ b
    for _ in range(rounds):
        slope = np.where(free, -np.inf, target - gram @ x)
        if slope.max() <= 1e-9 * max(1.0, b.max()):
            break
        free[slope.argmax()] = True
        while True:
            at = np.flatnonzero(free)
            best = np.linalg.solve(gram[np.ix_(at, at)] + 1e-9 * np.eye(len(at)), target[at])
            if (best > 1e-9).all():
                x[:] = 0
                x[at] = best
                break
            bad = best <= 1e-9
            share = x[at][bad] / np.maximum(x[at][bad] - best[bad], 1e-12)
            x[at] += share.min() * (best - x[at])
            drop = at[bad][share <= share.min() + 1e-12]
            x[drop] = 0
            free[drop] = False
    return x


def plan(counts: np.ndarray, window: int = WINDOW, step: int = STEP, depth: int = DEPTH) -> tuple[np.ndarray, int]:
    """counts[n]: pieces of length n (below the window). Returns rows (length, from rank, base, skip, per sequence) and the number of sequences.

    Rank r of a length lies in the last row whose `from rank` is not above r, in sequence base + (skip + r - from) // per.
    """
    counts = counts.astype(np.int64).copy()
    used, rows, sequences = np.zeros_like(counts), [], 0
    classes = -(-np.arange(len(counts)) // step)
    supply = np.bincount(classes, counts, minlength=window // step + 1)[1:].astype(np.int64)
    combos = combinations(window // step, depth)
    if supply.sum() and combos:
        a = np.zeros((window // step, len(combos)))
        for k, combo in enumerate(combos):
            for x in combo:
                a[x - 1, k] += 1
        repeats, left = np.floor(nnls(a, supply.astype(float)) + 1e-6).astype(np.int64), supply.copy()
        for k in np.flatnonzero(repeats):
            need = a[:, k].astype(np.int64)
            n = int(min(repeats[k], (left[need > 0] // need[need > 0]).min()))
            if n:
                left -= n * need
                for c in np.flatnonzero(need):
                    _take(rows, used, counts, np.arange(min(len(counts) - 1, (c + 1) * step), c * step, -1), n * int(need[c]), sequences, int(need[c]))
                sequences += n
    left = counts - used
    while left.sum():
        room, need = window, {}
        while room:
            fits = np.flatnonzero((left - _as_array(need, len(left)))[: room + 1] > 0)
            if not len(fits):
                break
            n = int(fits[-1])
            k = min(int(left[n]) - need.get(n, 0), room // n)
            need[n] = need.get(n, 0) + k
            room -= n * k
        times = min(int(left[n]) // k for n, k in need.items())
        for n, k in need.items():
            _take(rows, used, counts, np.array([n]), times * k, sequences, k)
            left[n] -= times * k
        sequences += times
    return np.array(rows, dtype=np.int64).reshape(-1, 5), sequences


def _as_array(need: dict[int, int], size: int) -> np.ndarray:
    out = np.zeros(size, np.int64)
    for n, k in need.items():
        if n < size:
            out[n] = k
    return out


def _take(rows: list, used: np.ndarray, counts: np.ndarray, lengths: np.ndarray, total: int, base: int, per: int) -> None:
    """`total` pieces of the lengths in turn, `per` of them for each sequence from `base` on."""
    skip = 0
    for n in lengths:
        k = int(min(counts[n] - used[n], total - skip))
        if k > 0:
            rows.append((int(n), int(used[n]), base, skip, per))
            used[n] += k
            skip += k


def packed(found: DataFrame, window: int = WINDOW) -> DataFrame:
    """Pieces with (sequence_id, offset, padded_to)."""
    spark = found.sparkSession
    found = written(found.withColumn("written_by", F.spark_partition_id()), "pieces")  # tells repeated rows apart
    histogram = {r.length: r.n for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}
    counts = np.zeros(window, np.int64)
    for n, k in histogram.items():
        if n < window:
            counts[n] = k
    rows, sequences = plan(counts, window)
    rows = np.concatenate([rows, [[window, 0, sequences, 0, 1]]])
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    shared = spark.sparkContext.broadcast((rows, (rows[:, 0] << 44) | rows[:, 1]))

    most = max(histogram.values(), default=0)
    salts = 1 + max(most // SALT_ROWS, SHARE * most // max(1, sum(histogram.values())))
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "written_by"), F.lit(salts)))
    per_salt = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    per_salt = per_salt.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32")
    ranked = salted.withColumn("own", F.row_number().over(own) - 1).join(per_salt, ["length", "salt"])
    ranked = ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("before") + F.col("own")).alias("rank"))

    def number(chunk: pa.RecordBatch) -> dict:
        table, keys = shared.value
        length, rank = (chunk.column(c).to_numpy() for c in ("length", "rank"))
        hit = table[np.searchsorted(keys, (length << 44) | rank, side="right") - 1]
        out = {c: chunk.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank")}
        return out | {"sequence_id": hit[:, 2] + (hit[:, 3] + rank - hit[:, 1]) // hit[:, 4]}

    placed = map_chunks(ranked, number, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, rank long, sequence_id long", text="")
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "rank")
    ahead = F.coalesce(F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("length").over(Window.partitionBy("sequence_id"))
    placed = placed.withColumn("offset", ahead).withColumn("total", total)
    power = F.col("total").bitwiseAND(F.col("total") - 1) == 0
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", F.when(power, F.col("total")).otherwise(F.lit(window)).cast("long").alias("padded_to"))


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded_to)."""
    return packed(pieces(docs, tokenizer, window, id_col, text_col), window)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
