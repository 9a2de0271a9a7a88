"""Retry, poison, zombie, outage, breaker and penalty policies as window folds over an attempt log.

The log is `schema.ATTEMPTS`. What a key's history leaves is folded per minute and carried over the minutes. Order within a task is (ts, seq). Outcomes: `transient` counts; `done`, `empty` and
`rejected` end a task's streaks; `failed` leaves them as they are; `done` and `empty` show that an instance works.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.schema import Settings

#: Error texts that blame the document, of an envelope and of an error that is retried.
ENVELOPE_MARKS = ("InvalidPdfException", "Rebuild failed", "PDF header", "Startxref", "not a PDF")
DOCUMENT_MARKS = ("IsSuccess=false", "InvalidPdfException", "Rebuild failed")
TERMINAL, ALIVE = ("done", "empty", "rejected"), ("done", "empty")
MINUTE = 60


def has_any(text: Column, marks: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for mark in marks:
        found = found | F.coalesce(F.contains(text, F.lit(mark)), F.lit(False))
    return found


def document_specific(error: Column) -> Column:
    """Whether an error depends on the document rather than on a server."""
    return has_any(error, DOCUMENT_MARKS)


def backoff_seconds(streak: Column, base: int = 60, growth: float = 1.6, most: int = 900) -> Column:
    """The full delay after so many failures in a row."""
    return F.least(F.lit(float(most)), base * F.pow(F.lit(growth), F.greatest(F.lit(0), streak - 1))).cast("int")


def jittered(full: Column, seed: Column) -> Column:
    """A delay between one half and two halves of `full` (integer division), set by a seed column so that it can be repeated."""
    half = F.floor(full / 2)
    return (half + F.pmod(F.xxhash64(seed), half + 1)).cast("int")


def outages(attempts: DataFrame, minutes: int = 10, before: DataFrame | None = None) -> DataFrame:
    """The attempts with `outage`: no success of the instance within the last minutes, or ever. `before` (instance, succeeded) has the last successes before these attempts.

    The last success is looked up per minute first and carried over the minutes of an instance, so no window holds more
    than a minute's attempts or an instance's minutes.
    """
    minute = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / MINUTE)
    success = F.when(F.col("outcome").isin(*ALIVE), F.col("ts"))
    rows = attempts.withColumn("minute", minute)
    per = rows.groupBy("instance", "minute").agg(F.max(success).alias("last"))
    above = Window.partitionBy("instance").orderBy("minute").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(F.col("instance").alias("i"), F.col("minute").alias("m"), F.max("last").over(above).alias("carried"))
    inside = Window.partitionBy("instance", "minute").orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("here", F.max(success).over(inside)).join(per, F.col("instance").eqNullSafe(F.col("i")) & (F.col("minute") == F.col("m")))
    last = F.coalesce("here", "carried")
    if before is not None:
        rows = rows.join(before.select(F.col("instance").alias("earlier_i"), "succeeded"), F.col("instance").eqNullSafe(F.col("earlier_i")), "left")
        last = F.coalesce(last, "succeeded")
    quiet = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(last.cast("timestamp")) > minutes * MINUTE * 1_000_000
    return rows.withColumn("outage", last.isNull() | quiet).select(*attempts.columns, "outage")


def streaks(attempts: DataFrame, cfg: Settings = Settings(), before: DataFrame | None = None, successes: DataFrame | None = None) -> DataFrame:
    """Transient failures with their counts in a row: (task_id, ts, seq, specific, outage, poison, any).

    `poison` counts document-specific failures in a row; `any` counts all outside outages. A terminal outcome, or more
    than the idle time since the last failure, starts both anew. Counts go on from `before` (task_id, last, poison0,
    any0: where each task stood after earlier attempts) and `successes` (as in `outages`).
    """
    by = Window.partitionBy("task_id").orderBy("ts", "seq")
    ended = F.coalesce(F.sum(F.when(F.col("outcome").isin(*TERMINAL), 1).otherwise(0)).over(by), F.lit(0))
    rows = outages(attempts, cfg.outage_minutes, successes).withColumn("life", ended).where("outcome = 'transient'")
    rows = rows.withColumn("specific", document_specific(F.col("error")))
    if before is None:
        rows = rows.withColumns({"last": F.lit(None).cast("timestamp"), "poison0": F.lit(0), "any0": F.lit(0)})
    else:
        rows = rows.join(before.select(F.col("task_id").alias("earlier_t"), "last", "poison0", "any0"), F.col("task_id").eqNullSafe(F.col("earlier_t")), "left").drop("earlier_t")
    life = Window.partitionBy("task_id", "life").orderBy("ts", "seq")
    previous = F.coalesce(F.lag("ts").over(life).cast("timestamp"), F.when(F.col("life") == 0, F.col("last").cast("timestamp")))
    gap = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(previous)
    rows = rows.withColumn("idle", F.sum(F.when(gap > cfg.idle_minutes * MINUTE * 1_000_000, 1).otherwise(0)).over(life))
    streak = Window.partitionBy("task_id", "life", "idle").orderBy("ts", "seq")
    rows = rows.withColumn("breaks", F.sum(F.when(F.col("specific"), 0).otherwise(1)).over(streak)).withColumn("quiet", F.sum(F.col("outage").cast("int")).over(streak))
    on = lambda mark, count: F.when((F.col("life") == 0) & (F.col("idle") == 0) & (F.col(mark) == 0), F.coalesce(F.col(count), F.lit(0))).otherwise(0)
    poison = F.sum(F.col("specific").cast("int")).over(Window.partitionBy("task_id", "life", "idle", "breaks").orderBy("ts", "seq")) + on("breaks", "poison0")
    any_ = F.sum(F.when(F.col("outage"), 0).otherwise(1)).over(Window.partitionBy("task_id", "life", "idle", "quiet").orderBy("ts", "seq")) + on("quiet", "any0")
    return rows.select("task_id", "ts", "seq", "specific", "outage", poison.alias("poison"), any_.alias("any"))


def verdicts(counted: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Streaks with their verdict: poison first, then zombie, else another try after `backoff` seconds (without jitter)."""
    verdict = F.when(F.col("poison") >= max(2, cfg.poison_retries), "poison").when(F.col("any") >= max(10, cfg.zombie_retries), "zombie").otherwise("transient")
    return counted.withColumn("verdict", verdict).withColumn("backoff", F.when(F.col("verdict") == "transient", backoff_seconds(F.col("any"))))


def classified(error_kind: Column) -> Column:
    """struct(outcome, detail) of how processing ended; `transient` goes on to `verdicts`."""
    table = {
        "saved": ("done", None), "short_text": ("empty", None), "oversized": ("rejected", "oversized"), "empty_ocr": ("rejected", "empty_ocr"), "bad_format": ("rejected", "bad_format"),
        "llm_bad_output": ("failed", "llm_bad_output"), "llm_permanent": ("failed", "llm_config"), "llm_unavailable": ("transient", None), "ocr_unavailable": ("transient", None),
        "no_source": ("missing", None), "lease_lost": ("dropped", None),
    }
    outcome = detail = None
    for kind, (a, b) in table.items():
        hit = error_kind == kind
        outcome = F.when(hit, a) if outcome is None else outcome.when(hit, a)
        detail = F.when(hit, F.lit(b).cast("string")) if detail is None else detail.when(hit, F.lit(b).cast("string"))
    return F.struct(outcome.otherwise("failed").alias("outcome"), detail.otherwise("error").alias("detail"))


def _by_minute(events: DataFrame, key: str) -> DataFrame:
    return events.withColumn("minute", F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / MINUTE))


def _with_before(rows: DataFrame, key: str, per: DataFrame) -> DataFrame:
    """The rows with what `per` (key, minute, ...) holds for their minute. No window holds more than a minute's events or a key's minutes, however long its history."""
    per = per.withColumnsRenamed({key: "k", "minute": "m"})
    return rows.join(per, F.col(key).eqNullSafe(F.col("k")) & (F.col("minute") == F.col("m"))).drop("k", "m")


def breaker(events: DataFrame, key: str, cfg: Settings = Settings(), before: DataFrame | None = None) -> DataFrame:
    """The breaker's state at each event (key, ts, seq, ok): failures in a row after it, whether it was paused before, until when it pauses.

    The third failure in a row pauses; each further one extends the pause; a success clears both; a pause also just ends.
    `before` (key, failures0, at0) is where each stood after earlier events: failures in a row, and when the last event was.
    """
    inside = Window.partitionBy(key, "minute").orderBy("ts", "seq")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    rows = _by_minute(events, key).withColumn("bad", F.when(F.col("ok"), 0).otherwise(1)).withColumn("fine", F.coalesce(F.col("ok"), F.lit(False)).cast("int"))
    rows = rows.withColumn("runs", F.sum("fine").over(upto))
    within = F.sum("bad").over(Window.partitionBy(key, "minute", "runs").orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("within", within)
    # a minute leaves the failures since its last success, added to those before it where it has none
    ends = F.max_by(F.struct("within", "runs"), F.struct("ts", "seq"))
    by = Window.partitionBy(key).orderBy("minute")
    per = rows.groupBy(key, "minute").agg(ends.alias("ends"), F.max(F.struct("ts", "seq")).alias("at"))
    per = per.withColumn("reset", F.sum((F.col("ends.runs") > 0).cast("int")).over(by))
    per = per.withColumn("left", F.sum("ends.within").over(Window.partitionBy(key, "reset").orderBy("minute")))
    kind = dict(events.dtypes)["ts"]
    if before is None:
        per = per.withColumns({"failures0": F.lit(None).cast("long"), "at0": F.lit(None).cast(kind)})
    else:
        per = per.join(before.select(F.col(key).alias("earlier"), "failures0", "at0"), F.col(key).eqNullSafe(F.col("earlier")), "left").drop("earlier")
    per = per.withColumn("left", F.col("left") + F.when(F.col("reset") == 0, F.coalesce("failures0", F.lit(0))).otherwise(0))
    held = F.coalesce(F.lag("left").over(by), "failures0").alias("ends_before")
    rows = _with_before(rows, key, per.select(key, "minute", held, F.coalesce(F.lag("at.ts").over(by), F.col("at0").cast(kind)).alias("at_before")))
    failures = F.when(F.col("runs") > 0, F.col("within")).otherwise(F.coalesce("ends_before", F.lit(0)) + F.col("within")).cast("long")
    until = lambda n, ts: F.when(n >= cfg.breaker_failures, ts + F.make_dt_interval(secs=F.lit(cfg.breaker_pause_seconds)))
    rows = rows.withColumn("failures", failures).withColumn("paused_until", until(F.col("failures"), F.col("ts")))
    earlier = F.when(F.lag("ts").over(inside).isNotNull(), F.lag("paused_until").over(inside)).otherwise(until(F.col("ends_before"), F.col("at_before")))
    rows = rows.withColumn("paused", F.coalesce(F.col("ts") < earlier, F.lit(False)))
    return rows.select(*events.columns, "failures", "paused_until", "paused")


def penalties(events: DataFrame, cfg: Settings = Settings(), before: DataFrame | None = None) -> DataFrame:
    """A server's penalties after each event (server, ts, seq, event), on top of those `before` (server, transport0, logical0: until when).

    `transport` sets the transport penalty, which a `green` probe clears; `refusal` extends the logical one, which only
    time ends. `ready` is whether the server may be asked right then.
    """
    until = F.col("ts") + F.make_dt_interval(secs=F.lit(cfg.ocr_cooldown_seconds))
    mark = F.when(F.col("event").isin("transport", "green"), F.struct("ts", "seq", F.when(F.col("event") == "transport", until).alias("until")))
    rows = _by_minute(events, "server").withColumn("mark", mark).withColumn("logical", F.when(F.col("event") == "refusal", until))
    above = Window.partitionBy("server").orderBy("minute").rowsBetween(Window.unboundedPreceding, -1)
    per = rows.groupBy("server", "minute").agg(F.max("mark").alias("last"), F.max("logical").alias("held"))
    rows = _with_before(rows, "server", per.select("server", "minute", F.max("last").over(above).alias("mark_before"), F.max("held").over(above).alias("logical_before")))
    upto = Window.partitionBy("server", "minute").orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, 0)
    mark = F.coalesce(F.max("mark").over(upto), F.col("mark_before"))
    transport, logical = mark["until"], F.greatest(F.max("logical").over(upto), "logical_before")
    if before is not None:
        rows = rows.join(before.select(F.col("server").alias("earlier"), "transport0", "logical0"), F.col("server").eqNullSafe(F.col("earlier")), "left")
        transport, logical = F.when(mark.isNotNull(), transport).otherwise(F.col("transport0")), F.greatest(logical, "logical0")
    rows = rows.withColumn("transport_until", transport).withColumn("logical_until", logical)
    held = F.coalesce(F.col("ts") < F.col("transport_until"), F.lit(False)) | F.coalesce(F.col("ts") < F.col("logical_until"), F.lit(False))
    return rows.withColumn("ready", ~held).select(*events.columns, "transport_until", "logical_until", "ready")


def standing(events: DataFrame, now: Column, cfg: Settings = Settings()) -> DataFrame:
    """(server, ready): whether each server may be asked now, by its last penalties."""
    last = latest(penalties(events, cfg).select("server", "ts", "seq", "transport_until", "logical_until"))
    held = F.coalesce(now < F.col("transport_until"), F.lit(False)) | F.coalesce(now < F.col("logical_until"), F.lit(False))
    return last.select("server", (~held).alias("ready"))


def paused(calls: DataFrame, now: Column, cfg: Settings = Settings()) -> DataFrame:
    """(server, paused): whether the breaker of each model holds calls back now."""
    last = latest(breaker(calls, "server", cfg).select("server", "ts", "seq", "paused_until"))
    return last.select("server", F.coalesce(now < F.col("paused_until"), F.lit(False)).alias("paused"))


def round_verdicts(log: DataFrame, fresh: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """(task_id, verdict, backoff, streak) of this round's transient failures `fresh`, by them and the log of earlier attempts.

    Only what can matter is counted: all attempts of these tasks, and of others the successes that show an instance works,
    as far back as those attempts go.
    """
    tasks = fresh.where("outcome = 'transient'").select("task_id").distinct()
    own = log.unionByName(fresh).join(tasks, "task_id", "left_semi")
    since = own.agg(F.min("ts").alias("since"))
    alive = log.unionByName(fresh).where(F.col("outcome").isin(*ALIVE)).join(tasks, "task_id", "left_anti").crossJoin(F.broadcast(since))  # one row
    alive = alive.where(F.col("ts") >= F.col("since") - F.make_dt_interval(mins=F.lit(cfg.outage_minutes))).drop("since")
    counted = verdicts(streaks(own.unionByName(alive), cfg), cfg)
    last = counted.groupBy("task_id").agg(F.max_by(F.struct("verdict", "backoff", "poison", "any"), F.struct("ts", "seq")).alias("v"))
    return last.join(tasks, "task_id", "left_semi").select("task_id", "v.verdict", "v.backoff", F.when(F.col("v.verdict") == "poison", F.col("v.poison")).otherwise(F.col("v.any")).alias("streak"))


def task_states(attempts: DataFrame, cfg: Settings = Settings(), before: DataFrame | None = None, successes: DataFrame | None = None) -> DataFrame:
    """(task_id, last, poison0, any0) of each task that new attempts change: where it stands after them; nulls where its streaks ended."""
    at = F.struct("ts", "seq")
    ended = attempts.where(F.col("outcome").isin(*TERMINAL)).groupBy("task_id").agg(F.max(at).alias("ended"))
    failed = streaks(attempts, cfg, before, successes).groupBy("task_id").agg(F.max_by(F.struct("ts", "seq", "poison", "any"), at).alias("f"))
    both = failed.join(ended, "task_id", "full")
    open_ = F.col("f").isNotNull() & (F.col("ended").isNull() | (F.col("ended") < F.struct("f.ts", "f.seq")))
    return both.select("task_id", F.when(open_, F.col("f.ts")).alias("last"), F.when(open_, F.col("f.poison")).alias("poison0"), F.when(open_, F.col("f.any")).alias("any0"))


def instance_states(attempts: DataFrame) -> DataFrame:
    """(instance, succeeded): the last success of each instance among these attempts."""
    return attempts.where(F.col("outcome").isin(*ALIVE)).groupBy("instance").agg(F.max("ts").alias("succeeded"))


def model_states(calls: DataFrame, cfg: Settings = Settings(), before: DataFrame | None = None) -> DataFrame:
    """(server, failures0, at0) of each model that was called, after these calls."""
    return latest(breaker(calls, "server", cfg, before).select("server", "ts", "seq", "failures")).select("server", F.col("failures").alias("failures0"), F.col("ts").alias("at0"))


def server_states(events: DataFrame, cfg: Settings = Settings(), before: DataFrame | None = None) -> DataFrame:
    """(server, transport0, logical0) of each server that something was seen of, after these events."""
    last = latest(penalties(events, cfg, before).select("server", "ts", "seq", "transport_until", "logical_until"))
    return last.select("server", F.col("transport_until").alias("transport0"), F.col("logical_until").alias("logical0"))


def ready_servers(servers: DataFrame, now: Column) -> DataFrame:
    """(server, ready) of servers by their states."""
    held = F.coalesce(now < F.col("transport0"), F.lit(False)) | F.coalesce(now < F.col("logical0"), F.lit(False))
    return servers.select("server", (~held).alias("ready"))


def paused_models(models: DataFrame, now: Column, cfg: Settings = Settings()) -> DataFrame:
    """(server, paused) of models by their states."""
    until = F.col("at0") + F.make_dt_interval(secs=F.lit(cfg.breaker_pause_seconds))
    return models.select("server", F.coalesce((F.col("failures0") >= cfg.breaker_failures) & (now < until), F.lit(False)).alias("paused"))


def verdicts_after(before: DataFrame, successes: DataFrame, fresh: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """As `round_verdicts`, from where tasks and instances stood instead of the log."""
    counted = verdicts(streaks(fresh, cfg, before, successes), cfg)
    last = counted.groupBy("task_id").agg(F.max_by(F.struct("verdict", "backoff", "poison", "any"), F.struct("ts", "seq")).alias("v"))
    return last.select("task_id", "v.verdict", "v.backoff", F.when(F.col("v.verdict") == "poison", F.col("v.poison")).otherwise(F.col("v.any")).alias("streak"))


def latest(states: DataFrame, key: str = "server") -> DataFrame:
    """The last state of each server."""
    return states.groupBy(key).agg(F.max_by(F.struct(*[c for c in states.columns if c != key]), F.struct("ts", "seq")).alias("s")).select(key, "s.*")


def snapshot(states: DataFrame) -> DataFrame:
    """One row (available, servers, snapshot) of servers' last states: how many may be asked, and a line that names each as up or down."""
    mark = F.concat("server", F.lit("="), F.when(F.col("ready"), "UP").otherwise("DOWN"))
    return states.agg(F.count_if("ready").alias("available"), F.count("*").alias("servers"), F.array_join(F.array_sort(F.collect_list(mark)), ", ").alias("snapshot"))


def exhausted(last_error: Column, snapshot: Column) -> Column:
    """The error of a request that no server took; it carries the last answer's words, by which documents are judged."""
    return F.concat(F.lit("No OCR server available: "), F.coalesce(last_error, F.lit("none was asked")), F.lit(" ["), snapshot, F.lit("]"))


def slow_parse(parse_ms: Column, most_ms: int = 10_000) -> Column:
    return parse_ms > most_ms


def rotation(servers: DataFrame, cursor: int, count: int) -> DataFrame:
    """Servers (index, name) in the order in which the request of that cursor asks them."""
    return servers.orderBy(F.pmod(F.col("index") - cursor, F.lit(count)))
