"""Importance resampling towards a target: documents drawn by how much their hashed n-grams resemble a benchmark's.

Words are mapped to integers once, and everything that is counted is a tuple of integers:
1. Each chunk of texts becomes one row: its distinct words and, for every text, the words' numbers in that list.
2. The distinct words of all chunks make the dictionary, an id for each word, written with its counts. A word has a row
   for each chunk at most, so no word is hot: its share is that of one word in a chunk's list.
3. N-grams are tuples of ids, numbered anew within the chunk; one row per chunk and distinct tuple carries the counts.
   Single words need no new numbers: a row of the dictionary is a tuple, a place in a chunk's list is its number.
4. The bytes of each distinct tuple are put together from the dictionary and hashed once; buckets get their totals.
5. The gains of the buckets go back to the chunks' tuples by a join, and every text adds up those of its numbers.
Only the totals of the buckets (a parameter's number) pass the driver. Documents are ranked in ranges of their scores:
a distributed sort, written, numbers within each part and the sizes of the parts before it.

Edge cases: null texts have no words; documents without features weigh 0; a null id is hashed as an empty one and comes
after equal scores; rows of one id are rows like others, repeated ones get ranks of their own; bytes that aren't UTF-8
count as U+FFFD; an empty target or an empty table is one without counts; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.llm.shared import documents, flat_text, id_and_text, map_chunks, valid, with_values, written
from docloom.llm.wordflow import LOWER, bounds

#: Bytes outside words, once A-Z are lower case.
OUTSIDE = np.zeros(256, dtype=bool)
OUTSIDE[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True

#: Half of the range of 32 bits: gains of both signs fit in it.
BIAS = 1 << 31

CODED = "chunk long, target boolean, doc_ids array<long>, n_words array<int>, sizes array<int>, codes binary, words array<string>, counts array<long>"
GRAMS = "chunk long, target boolean, doc_ids array<long>, n_words array<int>, sizes array<int>, codes binary, tuples array<array<long>>, counts array<long>"


def packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32 byte by byte, the lowest of all first, and compressed: most have high bytes of zero."""
    return pa.compress(np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), codec="zstd", asbytes=True)


def unpacked(blob: bytes, count: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(blob, 4 * count, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


def coded(texts: DataFrame, target: bool) -> DataFrame:
    """A row per chunk of texts (doc_id, text): distinct words, their counts, and the words of all texts as places in that list."""
    made = [0]  # chunks of this task

    def run(chunk: pa.RecordBatch) -> dict:
        data, offsets = flat_text(chunk.column("text"))
        data = LOWER[data]
        starts, ends, first = bounds(data, offsets, OUTSIDE)
        lengths = ends - starts
        words = pa.Array.from_buffers(pa.large_utf8(), len(starts), [None, pa.py_buffer(np.r_[0, np.cumsum(lengths)].astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[~OUTSIDE[data]]))]).dictionary_encode()
        codes = words.indices.to_numpy()
        counts = np.diff(first).astype(np.int32)
        number = (TaskContext.get().partitionId() << 32) + (made[0] << 1) + target
        made[0] += 1
        return {
            "chunk": [number], "target": [target], "doc_ids": [chunk.column("doc_id").to_pylist()], "n_words": [counts], "sizes": [counts],
            "codes": [packed(codes)], "words": [words.dictionary.to_pylist()], "counts": [np.bincount(codes, minlength=len(words.dictionary))],
        }

    return map_chunks(texts, run, CODED)


def both_counts(n: Column) -> list[Column]:
    """Totals of `n` outside the target and in it."""
    return [F.sum(F.when(~F.col("target"), n).otherwise(0)).alias("raw"), F.sum(F.when(F.col("target"), n).otherwise(0)).alias("in_target")]


def dictionary(chunks: DataFrame) -> DataFrame:
    """(word, id, raw, in_target) of the distinct words with their counts, written once, so that the ids stay."""
    spread = chunks.select("target", F.explode(F.arrays_zip("words", "counts")).alias("x"))
    words = spread.groupBy(F.col("x.words").alias("word")).agg(*both_counts(F.col("x.counts")))
    return written(words.withColumn("id", F.monotonically_increasing_id()), "word-ids")


def with_words(chunks: DataFrame, words: DataFrame) -> DataFrame:
    """(chunk, code, word, ...) of each chunk's distinct words with what the dictionary's rows have besides."""
    return chunks.select("chunk", F.posexplode("words").alias("code", "word")).join(words, "word")


def tuples_of(ids: np.ndarray, first: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
    """(numbers of all runs of 1 to `longest` ids in each text, runs of each text, distinct tuples, how often each occurs)."""
    text, place, key, found = [], [], [], []
    known, base = np.unique(ids, return_inverse=True)
    run = base.astype(np.int64)
    done = 0
    for n in range(1, longest + 1):
        if n > 1:  # the number of the run before, followed by one more id
            run = run[:-1] * (len(known) + 1) + base[n - 1 :] if len(run) else run
        owner = np.searchsorted(first, np.arange(len(run)), side="right") - 1
        inside = np.arange(len(run)) + n <= first[owner + 1] if len(run) else np.zeros(0, bool)
        at = np.flatnonzero(inside)
        _, sample, number = np.unique(run[at], return_index=True, return_inverse=True)
        text.append(owner[at])
        place.append(at)
        key.append(number + done)
        found += [ids[at[s] : at[s] + n] for s in sample.tolist()]
        done += len(sample)
        run = np.unique(run, return_inverse=True)[1].astype(np.int64)  # small again, whatever n
    text, place, key = (np.concatenate(x) for x in (text, place, key))
    order = np.argsort(text, kind="stable")
    return key[order], np.bincount(text, minlength=len(first) - 1), found, np.bincount(key, minlength=done)


def tupled(chunks: DataFrame, ids: DataFrame, longest: int) -> DataFrame:
    """The chunks with tuples of ids in place of words."""
    own = ids.groupBy("chunk").agg(F.transform(F.array_sort(F.collect_list(F.struct("code", "id"))), lambda x: x.id).alias("ids"))

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"sizes": [], "codes": [], "tuples": [], "counts": []}
        for ids, codes, counts in zip(batch.column("ids"), batch.column("codes").to_pylist(), batch.column("n_words").to_pylist(), strict=True):
            words = ids.values.to_numpy()[unpacked(codes, sum(counts))]
            numbers, sizes, found, often = tuples_of(words, np.r_[0, np.cumsum(counts)].astype(np.int64), longest)
            for name, value in (("sizes", sizes.astype(np.int32)), ("codes", packed(numbers)), ("tuples", found), ("counts", often)):
                out[name].append(value)
        return {n: batch.column(n) for n in ("chunk", "target", "doc_ids", "n_words")} | out

    return map_chunks(chunks.drop("words", "counts").join(own, "chunk"), run, GRAMS, text="")


def bucket(gram: Column, buckets: int) -> Column:
    return (F.crc32(gram.cast("binary")) % buckets).cast("int").alias("bucket")


def hashed(spread: DataFrame, words: DataFrame, buckets: int) -> DataFrame:
    """(key, raw, in_target, bucket) of the distinct tuples with their counts on both sides; each one's bytes are put together and hashed once."""
    totals = written(spread.groupBy("key").agg(*both_counts(F.col("n"))).withColumn("number", F.monotonically_increasing_id()), "distinct-tuples")
    spelled = with_values(totals.select("number", F.posexplode("key").alias("place", "id")), words, "id", "word")
    texts = spelled.groupBy("number").agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("parts"))
    gram = F.array_join(F.transform("parts", lambda x: x.word), " ")
    return written(totals.join(texts.select("number", bucket(gram, buckets)), "number").select("key", "raw", "in_target", "bucket"), "hashed-tuples")


def gains(rows: list, buckets: int) -> list[tuple[int, int]]:
    """(bucket, gain) from (bucket, raw, target) of the buckets that have any."""
    raw, target = sum(r[1] for r in rows), sum(r[2] for r in rows)
    return [(b, math.floor(1000 * math.log((t + 1) * (raw + buckets) / ((s + 1) * (target + buckets))))) for b, s, t in rows]


def weights(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10_000) -> DataFrame:
    """(doc_id, n_words, n_features, weight, place) of every row of (doc_id, text), `place` telling rows apart; `target` has a column `text`."""
    spark = docs.sparkSession
    sides = coded(docs, False).unionByName(coded(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), True))
    chunks = written(sides, "coded-texts")
    words = dictionary(chunks)
    if longest == 1:  # rows of the dictionary are the tuples
        grams, distinct = chunks, words.select("word", "raw", "in_target", bucket(F.col("word"), buckets))
    else:
        grams = written(tupled(chunks, with_words(chunks, words.select("word", "id")).select("chunk", "code", "id"), longest), "coded-tuples")
        spread = grams.select("chunk", "target", F.posexplode(F.arrays_zip("tuples", "counts")).alias("code", "x")).select("chunk", "target", "code", F.col("x.tuples").alias("key"), F.col("x.counts").alias("n"))
        distinct = hashed(spread, words, buckets)
    totals = distinct.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("in_target").alias("in_target"))
    table = spark.createDataFrame(gains([tuple(r) for r in totals.collect()], buckets), "bucket int, gain long")
    gained = distinct.join(F.broadcast(table), "bucket").drop("bucket", "raw", "in_target")
    if longest == 1:
        back = with_words(chunks.where(~F.col("target")), gained)
    else:
        back = with_values(spread.where(~F.col("target")).select("chunk", "code", "key"), written(gained, "tuple-gains"), "key", "gain")
    pair = F.shiftleft(F.col("code").cast("long"), 32) + F.col("gain") + BIAS  # a number and its gain in one integer, so that a list of them is short
    back = back.groupBy("chunk").agg(F.sort_array(F.collect_list(pair)).alias("gains"))

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {n: [] for n in ("doc_id", "n_words", "n_features", "weight", "place")}
        for chunk, ids, n_words, sizes, codes, own in zip(*(batch.column(n) for n in ("chunk", "doc_ids", "n_words", "sizes", "codes", "gains")), strict=True):
            ends = np.cumsum(sizes.values.to_numpy())
            gain = (own.values.to_numpy() & 0xFFFFFFFF) - BIAS if own.is_valid else np.zeros(0, np.int64)
            each = gain[unpacked(codes.as_py(), int(ends[-1]))] if len(gain) else gain
            total = np.r_[0, np.cumsum(each)]
            out["doc_id"] += ids.as_py()
            out["n_words"] += n_words.as_py()
            out["n_features"] += sizes.as_py()
            out["weight"] += (total[ends] - total[np.r_[0, ends[:-1]]]).tolist()
            out["place"] += [f"{chunk.as_py()}/{k}" for k in range(len(ends))]
        return out

    rows = grams.where(~F.col("target")).select("chunk", "doc_ids", "n_words", "sizes", "codes").join(back, "chunk", "left")
    return map_chunks(rows, run, "doc_id long, n_words long, n_features long, weight long, place string", text="")


def noise(seed: str, doc_id: Column) -> Column:
    """A Gumbel variate in thousandths, rounded down, from the id's digest alone."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def ranked(rows: DataFrame, drawn: int) -> DataFrame:
    """Written rows (doc_id, score, place, ...) with `rank`: 1 to `drawn` by score, highest first, then id; null beyond. No task orders more than a range of scores."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("place")]
    parts = written(rows.orderBy(*order).withColumn("part", F.spark_partition_id()), "by-score")
    sizes = sorted((r.part, r.n) for r in parts.groupBy("part").agg(F.count("*").alias("n")).collect())
    before = itertools.accumulate([0, *(n for _, n in sizes)])
    table = rows.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(sizes, before)], "part int, before long")
    rank = F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy(*order))
    found = parts.join(F.broadcast(table), "part").withColumn("rank", rank.cast("long"))
    return found.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).drop("part", "before")


def resampled(docs: DataFrame, target: DataFrame, percent: int = 10, longest: int = 1, buckets: int = 10_000, least_words: int = 20, seed: str = "2024", id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row: `percent` of those with at least `least_words` words are drawn."""
    found = weights(id_and_text(docs, id_col, text_col), target.select(valid(target[target_col]).alias("text")), longest, buckets)
    scored = written(found.withColumn("score", F.col("weight") + noise(seed, F.col("doc_id"))), "scored")
    able = F.col("n_words") >= least_words
    drawn = percent * scored.where(able).count() // 100
    rest = scored.where(~able).withColumn("rank", F.lit(None).cast("long"))
    return ranked(scored.where(able), drawn).unionByName(rest).drop("place")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampled(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


OP12_SQL = r"""
with checks as (select list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as tab),
texts as (select row_number() over () as n, cast(doc_id as bigint) as doc_id, text, false as target from documents union all select null, null, text, true from benchmark),
split as (select n, doc_id, target, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from texts),
words as (select n, target, unnest(ws) as w from split),
counted as (select w, count(*) filter (not target) as s, count(*) filter (target) as t from words group by w),
bytes as (select w, s, t, list_transform(range(octet_length(encode(w))), lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::bigint) as bs from counted),
hashed as (select w, s, t, xor(list_reduce(list_prepend(4294967295, bs), lambda c, b: xor(c >> 8, tab[1 + (xor(c, b) & 255)])), 4294967295) % 10000 as bucket from bytes, checks),
totals as (select bucket, sum(s)::double as s, sum(t)::double as t, sum(sum(s)) over ()::double as ss, sum(sum(t)) over ()::double as tt from hashed group by bucket),
gains as (select w, floor(1000 * ln((t + 1) * (ss + 10000) / ((s + 1) * (tt + 10000))))::bigint as gain from (select w, bucket from hashed) join totals using (bucket)),
weighed as (select n, sum(gain)::bigint as weight from words join gains using (w) where not target group by n),
scored as (select n, doc_id, len(ws)::bigint as n_features, coalesce(weight, 0) as weight,
                  coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint + 0.5::double) / 4294967296::double)))::bigint as score
           from split left join weighed using (n) where not target),
placed as (select n, row_number() over (order by score desc, doc_id nulls last) as rank, count(*) over () as able from scored where n_features >= 20)
select doc_id, n_features, weight, score, case when rank <= 10 * able // 100 then rank end as rank from scored left join placed using (n)
"""
