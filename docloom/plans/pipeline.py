"""One round of document processing: claim, read, recognise, enrich, judge, settle. A lazy plan but for the calls to services.

A round reads the history of earlier ones: attempts of tasks, what OCR servers and the model did. Penalised servers are
not asked, a paused breaker holds the model back, delays grow with a task's failures in a row, and poison documents and
zombies are rejected. What the round itself saw is returned, to be appended to the history.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.text import enriched, size_route, too_short
from docloom.operators import enrich, metrics, policy, queue
from docloom.operators.extract import Reader, extracted
from docloom.operators.governed import Limits, Pace, Wall
from docloom.schema import ATTEMPTS, MODEL_CALLS, SERVER_EVENTS, TEXTS, Settings
from docloom.sources import catalog
from docloom.sources.scratch import kept
from docloom.streaming.policies import Standing


@dataclass(frozen=True)
class Services:
    """What a round calls. Without a model, documents are stored without a header."""

    ocr: enrich.Client | None = None
    ocr_servers: tuple[str, ...] = ()
    llm: enrich.Client | None = None
    model: str = "model"
    prompt: str = "Answer with an XML header."
    at_once: int = 6
    readers: dict[str, Reader] = field(default_factory=dict)
    pace: Pace = field(default_factory=Wall)


@dataclass(frozen=True)
class History:
    """What earlier rounds saw, or what one round adds: attempts of tasks, events of OCR servers, calls of the model.

    With `standing` (the states that `streaming.policies` keeps) a round judges by it and reads none of the others.
    """

    attempts: DataFrame
    events: DataFrame
    calls: DataFrame
    standing: Standing | None = None
    samples: DataFrame | None = None  # metrics.SAMPLES of what one round did

    def servers_down(self, servers: tuple[str, ...], now: Column, cfg: Settings) -> tuple[str, ...]:
        """Those of the servers that may not be asked now."""
        if self.standing:
            ready = policy.ready_servers(self.standing.servers.where(F.col("server").isin(*servers)), now)
        else:
            ready = policy.standing(self.events.where(F.col("server").isin(*servers)), now, cfg)
        return tuple(r.server for r in ready.where("not ready").collect())

    def model_paused(self, now: Column, cfg: Settings) -> bool:
        held = policy.paused_models(self.standing.models, now, cfg) if self.standing else policy.paused(self.calls, now, cfg)
        return not held.where("paused").isEmpty()

    def model_failures(self, cfg: Settings) -> int:
        """Failures in a row that the model's breaker counts."""
        states = self.standing.models if self.standing else policy.model_states(self.calls, cfg)
        row = states.agg(F.max("failures0")).first()
        return row[0] or 0

    def verdicts(self, fresh: DataFrame, cfg: Settings) -> DataFrame:
        if self.standing:
            return policy.verdicts_after(self.standing.tasks, self.standing.instances, fresh, cfg)
        return policy.round_verdicts(self.attempts, fresh, cfg)

    @staticmethod
    def empty(spark: SparkSession) -> History:
        return History(*(spark.createDataFrame([], ddl) for ddl in (ATTEMPTS, SERVER_EVENTS, MODEL_CALLS)))


@dataclass(frozen=True)
class Round:
    """What a round leaves: the queue and the results after it, its outcomes, and what it adds: to the history, to the
    results, and to the texts (`schema.TEXTS`) of tasks that are tried again."""

    queue: DataFrame
    results: DataFrame
    outcomes: DataFrame
    seen: History
    added: DataFrame
    texts: DataFrame


def _none(kind: str = "string") -> Column:
    return F.lit(None).cast(kind)


def handed_back(claims: DataFrame, seconds: int, why: str) -> DataFrame:
    """Claims that go back untried after a fixed delay: no attempt, no failure."""
    return claims.select("id", F.lit("transient").alias("outcome"), F.lit(why).alias("error"), F.lit(seconds).alias("wait"), _none().alias("xml_data"), F.lit(False).alias("tried"), _none().alias("detail"))


def run_round(tasks: DataFrame, results: DataFrame, files: DataFrame, binaries: DataFrame, services: Services, owner: str, token: str, now: Column, cfg: Settings = Settings(), history: History | None = None, cached: DataFrame | None = None, leases: DataFrame | None = None, heavy_slots: int | None = None) -> Round:
    """Claims a batch and settles each of its tasks once.

    Texts that were read for tasks tried again stay in the queue, or, with `cached` (`schema.TEXTS`), in that table: the
    round looks its claims up there and leaves the queue's own `parsed_text` alone, so that a queue carries no texts.
    With `leases` nothing is claimed: these rows were leased under the token before, and the queue that the round leaves
    is these rows settled. `heavy_slots` is how many large files the owner can take now.
    """
    spark = tasks.sparkSession
    history = history or History.empty(spark)
    prompt = enrich.assembled_prompt(services.prompt)
    limits = Limits(per_slot=cfg.calls_per_slot, slot_wait_ms=cfg.llm_slot_wait_ms, backoff_ms=cfg.llm_backoff_ms, failures=cfg.breaker_failures, pause_ms=1000 * cfg.breaker_pause_seconds, in_flight=cfg.ocr_in_flight, cooldown_ms=1000 * cfg.ocr_cooldown_seconds)
    if leases is None:
        picked = kept(queue.claim(tasks, now, cfg.batch, cfg), "claims")
        leased = queue.leased(tasks, picked, owner, token, now)
    else:
        picked = leased = leases
    claims = leased.where((F.col("claim_token") == token) & (F.col("locked_by") == owner)).select("id", "file_id", "file_name", "claim_token", "parsed_text")
    if cached is not None:
        ids = picked.select("id")
        ids = F.broadcast(ids) if cfg.batch is not None and cfg.batch <= 100_000 else ids  # the claims are a batch at most
        known = cached.join(ids, "id", "left_semi").groupBy("id").agg(F.min("parsed_text").alias("known"))
        claims = kept(claims.join(known, "id", "left").withColumn("parsed_text", F.coalesce("known", "parsed_text")).drop("known"), "leases")
    try:
        heads = kept(catalog.headers(claims, files, binaries), "heads")
    except (PySparkException, Py4JJavaError) as e:  # the catalog can't be read now: the whole batch waits
        back = handed_back(claims, cfg.header_retry_seconds, f"No headers: {type(e).__name__}")
        return _settled(tasks.sparkSession, leased, results, back, None, False, History.empty(spark), history, owner, token, now, cfg)
    missing = catalog.missing_sources(claims, heads).select("id", F.lit("no_source").alias("error_kind"))

    # large files have a small pool of their own; those that it can't take now go back
    heavy = heads.where(size_route(F.col("size_bytes"), cfg.heavy_mb) == "heavy").select("id")
    waiting = kept(heavy.join(heavy.orderBy("id").limit(cfg.heavy_batch if heavy_slots is None else heavy_slots), "id", "left_anti"), "waiting")
    back = handed_back(waiting, cfg.full_pool_retry_seconds, "The pool of large files is full")
    mine = claims.join(heads.select("id"), "id", "left_semi").join(waiting, "id", "left_anti")

    stored = mine.where("parsed_text is not null").select("id", F.col("parsed_text").alias("text"), _none().alias("error_kind"), _none().alias("error"))
    fresh = mine.where("parsed_text is null").select("id", "file_id", "file_name")
    data = catalog.payloads(fresh, files, binaries)
    read = kept(extracted(data, services.readers, cfg.ocr_max_mb), "extracted")
    times = read.select("id", "parse_ms", _none("long").alias("model_ms"), _none("long").alias("ocr_ms"))
    samples = [spark.createDataFrame([], metrics.SAMPLES)]
    own = read.where("error_kind is null or error_kind <> 'ocr'").select("id", "text", "error_kind", "error")
    scans = read.where("error_kind = 'ocr'").select("id")
    events, calls = (spark.createDataFrame([], ddl) for ddl in (SERVER_EVENTS, MODEL_CALLS))
    if services.ocr and services.ocr_servers:
        down = history.servers_down(services.ocr_servers, now, cfg)
        cursor = zlib.crc32(token.encode()) if history.standing else history.events.count()  # where the round robin goes on
        scanned, asked = enrich.recognized(scans.join(data, "id").join(fresh.select("id", "file_name"), "id"), list(services.ocr_servers), services.ocr, services.at_once, cfg.ocr_tries, down, cursor, limits, services.pace)
        kind = F.element_at(F.create_map(*[F.lit(x) for pair in enrich.SERVER_EVENT.items() for x in pair]), F.col("outcome"))
        events = asked.select(F.col("target").alias("server"), now.cast("timestamp").alias("ts"), (F.shiftleft(F.col("attempt").cast("long"), 48) + F.pmod("id", F.lit(1 << 48))).alias("seq"), kind.alias("event"))
        times = times.unionByName(asked.select("id", _none("long").alias("parse_ms"), _none("long").alias("model_ms"), F.col("elapsed_ms").alias("ocr_ms")))
        samples.append(metrics.server_samples(asked.select(now.cast("timestamp").alias("ts"), F.col("target").alias("server"), "outcome", "elapsed_ms")))
        samples.append(metrics.unavailable_samples(scanned.where("error_kind = 'ocr_unavailable'").select(now.cast("timestamp").alias("ts"))))
    else:
        scanned = scans.select("id", _none().alias("text"), F.lit("ocr_unavailable").alias("error_kind"), F.lit("No OCR server").alias("error"))
    apart = cached is not None
    new = own.unionByName(scanned).withColumn("fresh", F.lit(True))
    texts = kept(stored.withColumn("fresh", F.lit(False)).unionByName(new), "texts")
    texts = texts.withColumn("error_kind", F.when(F.col("error_kind").isNull() & too_short(F.col("text"), cfg.min_text_length), "short_text").otherwise(F.col("error_kind")))

    good = texts.where("error_kind is null").select("id", "text")
    if services.llm and not history.model_paused(now, cfg):
        request = enrich.llm_request(services.model, prompt, F.col("text"), max_chars=cfg.max_text_chars)
        headed, asked = enrich.with_headers(good, request, services.llm, cfg.llm_at_once, cfg.llm_tries, limits, services.pace, history.model_failures(cfg))
        calls = asked.where("ok is not null").select(F.lit("chat").alias("server"), now.cast("timestamp").alias("ts"), (F.shiftleft(F.col("attempt").cast("long"), 48) + F.pmod("id", F.lit(1 << 48))).alias("seq"), "ok")
        times = times.unionByName(asked.select("id", _none("long").alias("parse_ms"), F.col("elapsed_ms").alias("model_ms"), _none("long").alias("ocr_ms")))
        fixed = asked.join(headed.select("id", "fix"), "id").withColumn("fix", F.when(F.col("outcome") == "ok", F.col("fix")))
        bad = headed.where("error_kind = 'llm_bad_output'").select("id", F.lit(True).alias("bad"))
        fixed = fixed.join(bad, "id", "left").withColumn("outcome", F.when(F.col("bad") & (F.col("outcome") == "ok"), "bad_output").otherwise(F.col("outcome")))
        samples.append(metrics.model_samples(fixed.withColumn("ts", now.cast("timestamp")), cfg.slow_response_ms, cfg.max_tokens))
    elif services.llm:
        headed = good.select("id", _none().alias("xml"), F.lit("llm_unavailable").alias("error_kind"), F.lit("Model: paused by the breaker").alias("error"))
    else:
        headed = good.select("id", F.lit("").alias("xml"), _none().alias("error_kind"), _none().alias("error"))
    ended = good.join(headed.select("id", "xml", "error_kind", "error"), "id").select("id", F.coalesce("error_kind", F.lit("saved")).alias("error_kind"), "error", F.when(F.col("error_kind").isNull(), enriched(F.col("xml"), F.col("text"))).alias("xml_data"))
    failed = texts.where("error_kind is not null").select("id", "error_kind", "error", _none().alias("xml_data"))
    gone = missing.select("id", "error_kind", _none().alias("error"), _none().alias("xml_data"))
    all_ = ended.unionByName(failed).unionByName(gone).withColumn("c", policy.classified(F.col("error_kind")))
    tried = all_.select("id", F.col("c.outcome").alias("outcome"), F.coalesce("error", "c.detail").alias("error"), _none("int").alias("wait"), "xml_data", F.lit(True).alias("tried"), F.col("c.detail").alias("detail"))
    seen = History(History.empty(spark).attempts, events, calls, samples=reduce(DataFrame.unionByName, samples))
    return _settled(spark, leased, results, tried.unionByName(back), texts, apart, seen, history, owner, token, now, cfg, times)


def _settled(spark: SparkSession, leased: DataFrame, results: DataFrame, endings: DataFrame, texts: DataFrame | None, apart: bool, seen: History, history: History, owner: str, token: str, now: Column, cfg: Settings, times: DataFrame | None = None) -> Round:
    """The round after endings (id, outcome, error, wait, xml_data, tried): transient ones are judged by the history, then all settle."""
    endings = kept(endings, "endings")
    alive = F.when(F.col("outcome").isin(*policy.ALIVE), 0).otherwise(1)  # a success in a round shows that its instance works
    attempt = lambda rows: rows.where("tried").select(F.col("id").alias("task_id"), now.cast("timestamp").alias("ts"), alive.cast("long").alias("seq"), "outcome", "error", F.lit(owner).alias("instance"))
    verdicts = history.verdicts(attempt(endings), cfg).withColumnRenamed("task_id", "id")
    rows = endings.join(verdicts, "id", "left")
    caught = F.col("tried") & F.col("verdict").isin("poison", "zombie")
    words = F.when(F.col("verdict") == "poison", F.concat(F.lit("Poison document: "), "error")).otherwise(F.concat(F.lit("Zombie: "), F.col("streak").cast("string"), F.lit(" transient failures in a row, the last: "), "error"))
    delay = F.coalesce("wait", policy.jittered(F.coalesce("backoff", policy.backoff_seconds(F.lit(1))), F.concat(F.lit(token), F.col("id").cast("string"))))
    judged = rows.select("id", F.when(caught, "rejected").otherwise(F.col("outcome")).alias("outcome"), F.when(caught, words).otherwise(F.col("error")).alias("error"), delay.alias("delay_seconds"), "xml_data", "tried", F.when(caught, F.col("verdict")).otherwise(F.col("detail")).alias("detail"))
    judged = kept(judged, "outcomes")
    outcomes = judged.select("id", F.lit(owner).alias("locked_by"), F.lit(token).alias("claim_token"), "outcome", "error", "delay_seconds", "xml_data")
    again = spark.createDataFrame([], TEXTS)
    if texts is not None:  # what was read stays with tasks that are tried again
        retried = outcomes.where("outcome in ('transient', 'failed')").select("id")
        again = texts.where("fresh and text is not null").join(retried, "id", "left_semi").select("id", F.col("text").alias("parsed_text"))
    if texts is not None and not apart:
        read_now = texts.where("text is not null").select("id", F.col("text").alias("fresh_text"))
        with_texts = leased.join(read_now, "id", "left").withColumn("parsed_text", F.coalesce("fresh_text", "parsed_text")).select(*leased.columns)
    else:
        with_texts = leased
    added = queue.new_results(leased, outcomes, now)
    times = spark.createDataFrame([], "id long, parse_ms long, model_ms long, ocr_ms long") if times is None else times
    spent = times.groupBy("id").agg(*[F.sum(c).alias(c) for c in ("parse_ms", "model_ms", "ocr_ms")])
    ended = judged.join(spent, "id", "left").select(now.cast("timestamp").alias("ts"), F.when(F.col("tried"), F.col("outcome")).alias("outcome"), "detail", "parse_ms", "model_ms", _none("long").alias("load_ms"), sum(F.coalesce(c, F.lit(0)) for c in ("parse_ms", "model_ms", "ocr_ms")).alias("total_ms"))
    samples = metrics.task_samples(ended, cfg.slow_parse_ms)
    samples = samples if seen.samples is None else samples.unionByName(seen.samples)
    return Round(queue.settled(with_texts, outcomes, now), queue.with_results(results, leased, outcomes, now), outcomes, History(attempt(judged), seen.events, seen.calls, samples=samples), added, again)
