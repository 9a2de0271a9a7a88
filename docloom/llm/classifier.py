"""A quality classifier: a sparse ensemble of rules over text statistics.

Small classification trees are grown on bootstrap rows and random features of a labelled sample; the path to each of
their nodes is a conjunctive rule (`symbols > 0.2 and words <= 90`). A logistic regression with a lasso penalty weighs
the rules and leaves most of them at zero. The rest compile into one Spark column expression, so that scoring runs in
generated code over the statistics, which one pass over the whole texts has counted.

The fit uses at most SAMPLE labelled documents, those of the least hashes of their ids: the stated bound, so the driver's
work stays the same at any size. The ids are chosen first, without a text; only the chosen documents are counted for the
fit. Scores depend on the text alone. Rows whose crc32(id as text) mod 5 is 0 are held out.

Edge cases: null texts count as empty and get a score like all others; a null id counts as the empty text, so its row
is held out; repeated labels of an id count once (the least); labels of null are ignored; of rows of one id with
different texts the fit takes the least text; without labels, or with labels of one kind, every score is the smoothed
share of label 1; repeated rows are kept; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.rules import counted, with_counts
from docloom.llm.shared import documents, names_of, written
from docloom.llm.textstats import NAMES

SAMPLE = 20_000
TREES, DEPTH, CUTS, LEAST_LEAF = 24, 3, 24, 20
PENALTY = 0.002
STEPS = 400
THRESHOLD = 0.3

#: feature -> (numerator, denominator) of counts; the denominator counts as 1 at least.
FEATURES = {
    "words": ("n_words", None),
    "word_length": ("word_chars", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
    "symbols": ("n_symbols", "n_words"),
    "symbol_ends": ("n_symbol_ends", "n_words"),
    "bars": ("n_bars", "n_words"),
    "bangs": ("n_bangs", "n_words"),
    "stops": ("n_stops", "n_words"),
    "punctuation": ("n_punct", "word_chars"),
    "digits": ("n_digits", "word_chars"),
    "wide": ("n_wide", "word_chars"),
    "upper": ("n_upper", "word_chars"),
    "lower": ("n_lower", "word_chars"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "echoes": ("n_echo_words", "n_words"),
    "short_words": ("n_short_words", "n_words"),
    "long_words": ("n_long_words", "n_words"),
}

#: A condition: (feature, limit, whether it holds above the limit).
Condition = tuple[str, float, bool]
Rule = tuple[Condition, ...]


def feature(name: str, prefix: str = "") -> Column:
    over, under = FEATURES[name]
    return F.col(prefix + over).cast("double") if under is None else F.col(prefix + over) / F.greatest(F.col(prefix + under), F.lit(1))


@dataclass(frozen=True)
class Ensemble:
    """intercept + weight of each rule that holds = log odds of label 1."""

    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def column(self, prefix: str = "") -> Column:
        """The score as an expression over columns named as the features, after a prefix."""
        odds = F.lit(self.intercept)
        for rule, weight in self.rules:
            holds = None
            for name, limit, above in rule:
                one = F.col(prefix + name) > limit if above else F.col(prefix + name) <= limit
                holds = one if holds is None else holds & one
            odds = odds + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-odds))


def _paths(x: np.ndarray, y: np.ndarray, rows: np.ndarray, names: list[str], cuts: list[np.ndarray], rng: np.random.Generator, above: Rule = ()) -> Iterator[Rule]:
    """The rules of a tree grown on some rows: the path to each node but the root."""
    if above:
        yield above
    own = y[rows]
    if len(above) == DEPTH or len(rows) < 2 * LEAST_LEAF or own.min() == own.max():
        return
    best = None
    for f in rng.choice(len(names), size=max(1, len(names) // 2), replace=False):
        if not len(cuts[f]):
            continue
        place = np.searchsorted(cuts[f], x[rows, f], side="left")  # the first cut not below the value
        n = np.cumsum(np.bincount(place, minlength=len(cuts[f]) + 1))[:-1]
        ones = np.cumsum(np.bincount(place, own, minlength=len(cuts[f]) + 1))[:-1]
        rest, rest_ones = len(rows) - n, own.sum() - ones
        ok = (n >= LEAST_LEAF) & (rest >= LEAST_LEAF)
        if ok.any():
            impure = ones * (n - ones) / np.maximum(n, 1) + rest_ones * (rest - rest_ones) / np.maximum(rest, 1)
            impure[~ok] = np.inf
            k = int(impure.argmin())
            if best is None or impure[k] < best[0]:
                best = (float(impure[k]), int(f), float(cuts[f][k]))
    if best is None:
        return
    _, f, limit = best
    high = x[rows, f] > limit
    for side, part in ((False, rows[~high]), (True, rows[high])):
        yield from _paths(x, y, part, names, cuts, rng, (*above, (names[f], limit, side)))


def grow(x: np.ndarray, y: np.ndarray, names: list[str], seed: int = 7) -> list[Rule]:
    """The distinct rules of all trees. Half of a tree's rows come from each label, so that the rarer one counts."""
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.round(np.quantile(column, np.arange(1, CUTS) / CUTS), 6)) for column in np.concatenate([x, x[y == 0], x[y == 0], x[y == 0]]).T]
    found: dict[Rule, None] = {}
    kinds = [np.flatnonzero(y == v) for v in (0, 1)]
    for _ in range(TREES):
        rows = np.concatenate([rng.choice(k, size=min(len(y), 4000) // 2) for k in kinds])
        found.update(dict.fromkeys(_paths(x, y, rows, names, cuts, rng)))
    return list(found)


def holds(x: np.ndarray, names: list[str], rules: list[Rule]) -> np.ndarray:
    """(rows, rules): whether each rule holds, as floats."""
    out = np.ones((len(x), len(rules)), dtype=bool)
    at = {n: k for k, n in enumerate(names)}
    for k, rule in enumerate(rules):
        for name, limit, above in rule:
            value = x[:, at[name]]
            out[:, k] &= value > limit if above else value <= limit
    return out.astype(np.float32)


def lasso(r: np.ndarray, y: np.ndarray, penalty: float = PENALTY) -> tuple[float, np.ndarray]:
    """(intercept, weights) of a logistic regression with a lasso penalty, by accelerated proximal gradient steps."""
    n, spread = len(y), np.maximum(r.std(axis=0), 0.02)
    z = ((r - r.mean(axis=0)) / spread).astype(np.float32)
    lead = z[:, :0].sum() if not z.shape[1] else float(np.linalg.norm(z.T @ z / n, 2))
    step = 1 / (0.25 * (lead + 1))
    w, b = np.zeros(z.shape[1]), float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
    v, c, t = w.copy(), b, 1.0
    for _ in range(STEPS):
        error = 1 / (1 + np.exp(-(z @ v + c))) - y
        new = v - step * (z.T @ error / n)
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        new_b = c - step * error.mean()
        ahead = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = new + (t - 1) / ahead * (new - w), new_b + (t - 1) / ahead * (new_b - b)
        w, b, t = new, new_b, ahead
    weights = w / spread
    return float(b - (weights * r.mean(axis=0)).sum()), weights


def fit(x: np.ndarray, y: np.ndarray, names: list[str]) -> Ensemble:
    if len(y) < 2 * LEAST_LEAF or y.min() == y.max():
        return Ensemble(float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))), ())
    rules = grow(x, y, names)
    intercept, weights = lasso(holds(x, names, rules), y)
    return Ensemble(intercept, tuple((rule, float(w)) for rule, w in zip(rules, weights, strict=True) if abs(w) > 1e-4))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def chosen(ids: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, quality) of at most `sample` labelled ids that aren't held out and occur among `ids` (doc_id)."""
    marks = labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    marks = written(marks.where(~held_out(F.col("doc_id"))).join(ids, "doc_id", "left_semi").withColumn("place", F.xxhash64("doc_id", F.lit("fit"))), "fit-labels")
    total = marks.count()
    if total > sample:  # most of the rest goes where it lies, so that the ordering below sees about twice the sample
        marks = marks.where(F.pmod(F.col("place"), F.lit(1_000_000)) < min(1_000_000, 2_000_000 * sample // total + 1000))
    return marks.orderBy(F.pmod(F.col("place"), F.lit(1_000_000)), "place", "doc_id").limit(sample).select("doc_id", "quality")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Ensemble:
    """An ensemble fitted to a bounded sample of the labelled documents."""
    names = list(FEATURES)
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    marks = F.broadcast(written(chosen(own.select("doc_id"), labels, sample), "fit-ids"))  # at most `sample` rows
    texts = own.join(marks.select("doc_id"), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    stats = counted(texts, NAMES).select("doc_id", *[feature(n).alias(n) for n in FEATURES])
    got = np.array([tuple(r) for r in stats.join(marks, "doc_id").select("doc_id", "quality", *names).collect()], dtype=np.float64).reshape(-1, len(names) + 2)
    got = got[np.lexsort(got.T[::-1])]  # the fit must not depend on the order in which rows arrive
    return fit(got[:, 2:], (got[:, 1] > 0).astype(np.float64), names)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, by an ensemble trained on the labels."""
    ensemble = train(docs, labels, id_col, text_col)
    stats = counted(docs, NAMES, id_col, text_col).select("doc_id", *[feature(n).alias(n) for n in FEATURES])
    scored = stats.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), ensemble.column().alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows, as they are, that the ensemble doesn't reject. Texts are counted where they lie, so they need no join."""
    ensemble = train(docs, labels, id_col, text_col)
    rows, own = with_counts(docs, NAMES, text_col)
    rows = rows.select(*names_of(docs), *[feature(n, own).alias(f"{own}f_{n}") for n in FEATURES])
    return rows.where(ensemble.column(f"{own}f_") >= threshold).select(*names_of(docs))


def op1_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
