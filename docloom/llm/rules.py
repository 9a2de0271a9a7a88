"""Quality rules with thresholds that adapt to each language and source.

Every text's counts become ratios in thousandths. A mergeable quantile sketch of each ratio is kept per language and
source: a log-linear histogram whose buckets keep a value's six leading bits (at most 1/32 off), merged by adding
counts, so Spark builds it with a partial aggregation and the merged result doesn't depend on the order. Quantiles
read from the sketch give the limits, median +- REACH spreads. Where only high values fail, most rows of a group are
near 0 and what is below the median tells nothing, so the spread is the distance from the median to the upper quartile
or half of that to the upper tenth, whichever is more (of about equal size in a normal distribution; the tenth also sees
a tail that fewer than a quarter of the rows have), or a small least spread. Where both sides fail, it is the distance to
the quartile on the other side, or a least spread. A group's sketch is blended with that of its language, merged over
sources, as if PRIOR rows of it were the group's own, and the language's likewise with that of the whole table: a small
group is judged mostly by the wider ones, a large one by itself, without a step at any size. The limits are joined back on
language and source: they are broadcast if they have no more than 50,000 rows; beyond that Spark picks the join and splits
a hot source.

Edge cases: null texts have no words and fail the base rules, as do empty ones; null languages and sources count as
empty strings; repeated rows are kept, each with the same verdict; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.llm.shared import annotated, broadcast_if_small, documents, map_chunks, names_of, written
from docloom.llm.textstats import statistics

#: Rows that the wider sketch counts for in a blend.
PRIOR = 200
REACH = 6
#: Slack of a comparison of summed weights, as a share.
SLACK = 1e-9
#: ratio -> (numerator, denominator, least spread in thousandths, sides on which it fails)
RATIOS = {
    "symbols": ("n_symbols", "n_words", 5, "high"),
    "dup_lines": ("n_dup_lines", "n_lines", 30, "high"),
    "repeats": ("n_repeat_words", "n_words", 25, "high"),
    "echoes": ("n_echo_words", "n_words", 5, "high"),
    "word_length": ("word_chars", "n_words", 400, "both"),
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_echo_words"]


def counted(docs: DataFrame, names: list[str], id_col: str = "doc_id", text_col: str = "text", extra: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, `extra` string columns, the named statistics of the text) of each row."""
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"), *[F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in extra])

    def run(chunk: pa.RecordBatch) -> dict:
        found = statistics(chunk.column("text"))
        return {c: chunk.column(c) for c in ("doc_id", *extra)} | {c: found[c] for c in names}

    return map_chunks(rows, run, ", ".join(["doc_id long", *[f"{c} string" for c in extra], *[f"{c} long" for c in names]]))


def with_counts(docs: DataFrame, names: list[str], text_col: str = "text") -> tuple[DataFrame, str]:
    """(every row with all its columns and the named statistics of its text, the prefix of their names)."""
    return annotated(docs, lambda chunk: statistics(chunk.column(chunk.schema.get_field_index(text_col))), ", ".join(f"{c} long" for c in names), text_col)


def ratio(name: str, prefix: str = "") -> Column:
    over, under, _, _ = RATIOS[name]
    over, under = F.col(prefix + over), F.col(prefix + under)
    return F.when(under > 0, F.floor(over * 1000 / under)).otherwise(F.lit(0)).cast("long")


def base_fails(prefix: str = "") -> Column:
    words = F.col(f"{prefix}n_words")
    return (words < 20) | (100 * F.col(f"{prefix}n_repeat_words") > 30 * words)


def beyond(prefix: str = "") -> Column:
    """The names of the ratios beyond their limits."""
    over = [F.when((ratio(r, prefix) > F.col(f"{prefix}{r}_high")) | (ratio(r, prefix) < F.col(f"{prefix}{r}_low")), F.lit(r)) for r in RATIOS]
    return F.array_compact(F.array(*over))


def bucket(value: Column) -> Column:
    """The least value with the same six leading bits."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketch(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, ratio, bucket, n): the quantile sketches of every ratio for each group of rows."""
    melted = rows.select(*keys, F.explode(F.array(*[F.struct(F.lit(r).alias("ratio"), bucket(ratio(r)).alias("bucket")) for r in RATIOS])).alias("x"))
    return melted.groupBy(*keys, "x.ratio", "x.bucket").agg(F.count("*").alias("n"))


def merged(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """The sketches of coarser groups."""
    return sketches.groupBy(*keys, "ratio", "bucket").agg(F.sum("n").alias("n"))


def shares(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, ratio, bucket, share): each bucket's share of its group."""
    whole = sketches.groupBy(*keys, "ratio").agg(F.sum("n").alias("total"))
    return sketches.join(whole, [*keys, "ratio"]).select(*keys, "ratio", "bucket", (F.col("n") / F.col("total")).alias("share"))


def blended(sketches: DataFrame, keys: list[str], wider: DataFrame, wider_keys: list[str]) -> DataFrame:
    """(keys, ratio, bucket, share): each group's sketch with PRIOR rows of the wider one, whose buckets include the group's."""
    whole = sketches.groupBy(*keys, "ratio").agg(F.sum("n").alias("total"))
    cells = whole.join(wider, [*wider_keys, "ratio"]).join(sketches, [*keys, "ratio", "bucket"], "left")
    weight = F.coalesce("n", F.lit(0)) + PRIOR * F.col("share")
    return cells.select(*keys, "ratio", "bucket", (weight / (F.col("total") + PRIOR)).alias("share"))


def quantiles(found: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, ratio, quartiles q1 to q3 and upper tenth d9); a quantile is the least bucket that covers its share."""
    run = found.withColumn("upto", F.sum("share").over(Window.partitionBy(*keys, "ratio").orderBy("bucket")))
    at = lambda name, share: F.min(F.when(F.col("upto") >= share - SLACK, F.col("bucket"))).alias(name)
    return run.groupBy(*keys, "ratio").agg(at("q1", 0.25), at("q2", 0.5), at("q3", 0.75), at("d9", 0.9))


def limits(sketches: DataFrame) -> DataFrame:
    """(lang, source, low and high limit of each ratio) of sketches by lang and source."""
    lang = blended(merged(sketches, ["lang"]), ["lang"], shares(merged(sketches, []), []), [])
    lang = broadcast_if_small(written(lang, "language-sketches"))  # else a language with millions of sources were one hot key
    found = quantiles(blended(sketches, ["lang", "source"], lang, ["lang"]), ["lang", "source"])
    cells = []
    for name, (_, _, least, sides) in RATIOS.items():
        q1, q2, q3, d9 = map(F.col, ("q1", "q2", "q3", "d9"))
        spreads = [q2 - q1] if sides == "both" else [q3 - q2, F.floor((d9 - q2) / 2)]
        high = q2 + REACH * F.greatest(*spreads, F.lit(least).cast("long"))
        low = q2 - REACH * F.greatest(q3 - q2, F.lit(least)) if sides == "both" else F.lit(-1).cast("long")
        cells += [F.max(F.when(F.col("ratio") == name, high)).alias(f"{name}_high"), F.max(F.when(F.col("ratio") == name, low)).alias(f"{name}_low")]
    return found.groupBy("lang", "source").agg(*cells)


def counted_rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    renamed = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), docs[lang_col].alias("lang"), docs[source_col].alias("source"))
    return written(counted(renamed, COUNTS, extra=("lang", "source")).withColumn("base_failed", base_fails()), "rule-counts")


def fitted_limits(counts: DataFrame) -> DataFrame:
    """The limits that the rows which pass the base rules give, written: a row for each language and source."""
    return written(limits(written(sketch(counts.where("not base_failed"), ["lang", "source"]), "rule-sketches")), "rule-limits")


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """A row for each row: the counts, base_failed, kept, and each ratio's verdict in `failed` (names of the ratios beyond their limits)."""
    rows = counted_rows(docs, id_col, text_col, lang_col, source_col)
    judged = rows.join(broadcast_if_small(fitted_limits(rows)), ["lang", "source"], "left").withColumn("failed", beyond())
    kept = ~F.col("base_failed") & (F.size("failed") == 0)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "failed")


def kept_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows, as they are, that the rules keep. Texts are counted again where they lie, so only the limits are joined."""
    counts = counted_rows(docs, id_col, text_col, lang_col, source_col)
    found = fitted_limits(counts)
    rows, own = with_counts(docs, COUNTS, text_col)
    found = broadcast_if_small(found.select(*[F.col(c).alias(own + c) for c in found.columns]))
    empty = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    judged = rows.join(found, (empty(lang_col) == F.col(f"{own}lang")) & (empty(source_col) == F.col(f"{own}source")), "left")
    return judged.where(~base_fails(own) & (F.size(beyond(own)) == 0)).select(*names_of(docs))


def op2_adaptive_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir)).drop("failed")
