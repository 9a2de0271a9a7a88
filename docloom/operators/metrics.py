"""Queue gauges, counters, timers and throughput as aggregates over the queue and the logs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.operators import policy
from docloom.schema import ERROR, NEW, Settings

STATUSES = {0: "new", 1: "processing", 2: "done", 3: "error"}
OUTCOMES = ("done", "transient", "empty", "missing", "failed", "rejected")
REQUEST_OUTCOMES = ("success", "transport_error", "http_error", "document_error", "service_refusal")


def queue_depth(queue: DataFrame) -> DataFrame:
    """(status, n) for every known status, zero where the queue has none."""
    spark = queue.sparkSession
    counts = queue.groupBy("status").agg(F.count("*").alias("n"))
    all_ = spark.range(len(STATUSES)).select(F.col("id").cast("int").alias("status"))
    return all_.join(counts, "status", "left").select("status", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def oldest_pending(queue: DataFrame, now: Column, max_retries: int = 2) -> DataFrame:
    """Seconds since the oldest task that waits (new, or failed with retries left) was made; 0 if none waits."""
    waits = queue.where((F.col("status") == NEW) | ((F.col("status") == ERROR) & (F.col("retry_count") < max_retries)))
    return waits.agg(F.min("created_at").alias("oldest")).select(F.coalesce(F.unix_seconds(now.cast("timestamp")) - F.unix_seconds(F.col("oldest").cast("timestamp")), F.lit(0)).alias("seconds"))


def counters(log: DataFrame, *names: str) -> DataFrame:
    return log.groupBy(*names).agg(F.count("*").alias("n"))


def filled_counters(log: DataFrame, servers: DataFrame, outcomes: tuple[str, ...] = REQUEST_OUTCOMES) -> DataFrame:
    """(server, outcome, n) for every server and outcome, zeros included: each server's row gets the few outcomes as an array, no join of rows with rows."""
    grid = servers.select("server", F.explode(F.array(*[F.lit(o) for o in outcomes])).alias("outcome"))
    return grid.join(counters(log, "server", "outcome"), ["server", "outcome"], "left").select("server", "outcome", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def timers(log: DataFrame, value: str, *names: str, decimals: int = 3) -> DataFrame:
    """Count, sum, largest and the nearest-rank median and 95th percentile of a duration."""
    x = F.col(value)
    rank = lambda p: F.expr(f"percentile_disc({p}) within group (order by {value})").cast("double")
    return log.groupBy(*names).agg(F.count(x).alias("n"), F.round(F.sum(x), decimals).alias("total"), F.max(x).alias("largest"), rank(0.5).alias("median"), rank(0.95).alias("p95"))


def timer_buckets(log: DataFrame, value: str, bounds: list[float], *names: str) -> DataFrame:
    """Cumulative histogram counts (le, n), as a metrics endpoint shows them."""
    per = [F.count_if(F.col(value) <= b).alias(f"b{k}") for k, b in enumerate(bounds)]
    wide = log.groupBy(*names).agg(*per, F.count(value).alias("all"))
    cells = F.array(*[F.struct(F.lit(str(b)).alias("le"), F.col(f"b{k}").alias("n")) for k, b in enumerate(bounds)], F.struct(F.lit("+Inf").alias("le"), F.col("all").alias("n")))
    return wide.select(*names, F.inline(cells))


def token_sums(log: DataFrame) -> DataFrame:
    """Prompt and completion tokens; an unknown count is negative and ignored."""
    known = lambda c: F.coalesce(F.sum(F.when(F.col(c) >= 0, F.col(c))), F.lit(0)).cast("long")
    return log.agg(known("prompt_tokens").alias("prompt"), known("completion_tokens").alias("completion"))


def per_minute(log: DataFrame, last: int = 30) -> DataFrame:
    """(minute, n) of the last minutes that have entries."""
    return log.groupBy(F.date_trunc("minute", "ts").alias("minute")).agg(F.count("*").alias("n")).orderBy(F.desc("minute")).limit(last).orderBy("minute")


def index_quantiles(log: DataFrame, value: str, *names: str, least: int = 10) -> DataFrame:
    """Median, 95th percentile and largest by position in the sorted values, for groups of at least `least`.

    The position is n * p rounded half to even, at most n - 1. Values are ranked by a window, not gathered.
    """
    by = Window.partitionBy(*names)
    n = F.count(value).over(by)
    rows = log.where(F.col(value).isNotNull()).withColumn("n", n).where(F.col("n") >= least)
    rows = rows.withColumn("k", F.row_number().over(by.orderBy(value)) - 1)
    at = lambda p: F.max(F.when(F.col("k") == F.least(F.col("n") - 1, F.bround(F.col("n") * p)), F.col(value)))
    return rows.groupBy(*names).agg(F.max("n").alias("n"), at(0.5).alias("median"), at(0.95).alias("p95"), F.max(value).alias("largest"))


def shares(log: DataFrame, bad: Column, *names: str) -> DataFrame:
    """The share of bad entries in per cent and its grade: below 1 ok, up to 3 watch, above reduce; per hour, how many there were."""
    share = F.col("bad") * 100.0 / F.col("n")
    hours = F.greatest((F.unix_seconds(F.col("to").cast("timestamp")) - F.unix_seconds(F.col("since").cast("timestamp"))) / 3600.0, F.lit(1 / 3600))
    found = log.groupBy(*names).agg(F.count("*").alias("n"), F.count_if(bad).alias("bad"), F.min("ts").alias("since"), F.max("ts").alias("to"))
    grade = F.when(share < 1, "ok").when(share <= 3, "watch").otherwise("reduce")
    return found.select(*names, "n", "bad", F.round(share, 4).alias("share"), grade.alias("grade"), F.round(F.col("n") / hours, 4).alias("per_hour"))


def overview(log: DataFrame, value: str, success: str = "success", timeout: str = "transport", refusal: str = "refusal") -> DataFrame:
    """One row on a log of calls (ts, event, a duration in ms): outcomes, the share of timeouts, successes an hour, median, 95th percentile and largest duration.

    Quantiles are by position, as in `index_quantiles`. The log is never ranked in one task: counts by whole seconds show
    which second holds a position, and only the values of that second are looked at.
    """
    found = log.agg(
        F.count("*").alias("n"), F.count_if(F.col("event") == success).alias("successes"), F.count_if(F.col("event") == timeout).alias("timeouts"), F.count_if(F.col("event") == refusal).alias("refusals"),
        F.max(value).alias("largest"), F.min("ts").alias("since"), F.max("ts").alias("to"), F.count(value).alias("timed"),
    )
    hours = F.greatest((F.unix_seconds(F.col("to").cast("timestamp")) - F.unix_seconds(F.col("since").cast("timestamp"))) / 3600.0, F.lit(1 / 3600))
    values = log.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(F.count("*").alias("k")).withColumn("second", F.floor(F.col("v") / 1000))
    seconds = values.groupBy("second").agg(F.sum("k").alias("k")).withColumn("upto", F.sum("k").over(Window.orderBy("second")))  # no more rows than a timeout has seconds
    places = found.select(F.inline(F.array(*[F.struct(F.lit(name).alias("name"), F.least(F.col("timed") - 1, F.bround(F.col("timed") * p)).alias("place")) for name, p in (("median", 0.5), ("p95", 0.95))])))
    hit = seconds.join(F.broadcast(places), (F.col("upto") > F.col("place")) & (F.col("upto") - F.col("k") <= F.col("place"))).select("name", "second", "place", (F.col("upto") - F.col("k")).alias("before"))
    fine = values.join(F.broadcast(hit), "second").withColumn("upto", F.col("before") + F.sum("k").over(Window.partitionBy("name").orderBy("v")))
    at = fine.where("upto > place").groupBy().agg(*[F.min(F.when(F.col("name") == n, F.col("v"))).alias(n) for n in ("median", "p95")])
    rows = found.crossJoin(at)  # one row and one row
    return rows.select("n", "successes", "timeouts", "refusals", F.round(F.col("timeouts") * 100.0 / F.col("n"), 4).alias("timeout_share"), F.round(F.col("successes") / hours, 4).alias("successes_per_hour"), "median", "p95", "largest")


#: Label values that are there from the start, with zeros.
FAILED_KINDS = ("llm_bad_output", "llm_config", "error")
REJECTED_REASONS = ("bad_format", "empty_ocr", "oversized", "poison", "zombie")
MODEL_OUTCOMES = ("success", "server_error", "network_error", "no_slot", "token_refresh", "client_error")
PHASES = ("total", "load", "parse", "model")
BOUNDS = (0.1, 1.0, 5.0, 10.0, 60.0, 300.0)
SAMPLES = "ts timestamp, name string, labels map<string,string>, value double"
ROLLUP = "minute timestamp, name string, labels map<string,string>, n long, total double, largest double, last double, last_ts timestamp, buckets array<long>"


def _labels(**columns: Column) -> Column:
    pairs = [x for name, c in columns.items() for x in (F.lit(name), c.cast("string"))]
    return F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")


def _samples(frame: DataFrame, *rows: tuple[str, Column, Column, Column]) -> DataFrame:
    """SAMPLES of each row for each (name, labels, value, whether it counts)."""
    cells = F.array(*[F.when(hit, F.struct(F.lit(name).alias("name"), labels.alias("labels"), value.cast("double").alias("value"))) for name, labels, value, hit in rows])
    return frame.select("ts", F.explode(F.filter(cells, lambda x: x.isNotNull())).alias("x")).select(F.col("ts").cast("timestamp").alias("ts"), "x.*")


def task_samples(tasks: DataFrame, slow_parse_ms: int = 10_000) -> DataFrame:
    """Of endings (ts, outcome, detail, total_ms, load_ms, parse_ms, model_ms): counters by outcome and kind or reason, phases, slow parses.

    The total time counts for every attempt, the other phases for saved ones. A claim that went back untried has no outcome.
    """
    one, yes, o = F.lit(1), F.lit(True), F.col("outcome")
    detail = F.coalesce(F.col("detail"), F.lit("error"))
    phase = lambda name: ("task_duration_seconds", _labels(phase=F.lit(name)), F.col(f"{name}_ms") / 1000, F.col(f"{name}_ms").isNotNull() & ((F.lit(name == "total") & o.isNotNull()) | (o == "done")))
    return _samples(
        tasks, ("tasks_total", _labels(outcome=o), one, o.isin("done", "transient", "empty", "missing")), ("tasks_total", _labels(outcome=o, kind=detail), one, o == "failed"),
        ("tasks_total", _labels(outcome=o, reason=detail), one, o == "rejected"), ("slow_parses_total", _labels(), one, policy.slow_parse(F.col("parse_ms"), slow_parse_ms)), *map(phase, PHASES), ("tasks_claimed_total", _labels(), one, yes),
    )


def server_samples(requests: DataFrame) -> DataFrame:
    """Of OCR requests (ts, server, outcome, elapsed_ms), probes not among them: counters by server and outcome, durations."""
    server, yes = F.col("server"), F.lit(True)
    return _samples(requests, ("ocr_requests_total", _labels(server=server, outcome=F.col("outcome")), F.lit(1), yes), ("ocr_duration_seconds", _labels(server=server), F.col("elapsed_ms") / 1000, F.col("elapsed_ms").isNotNull()))


def unavailable_samples(files: DataFrame) -> DataFrame:
    """Of files (ts) that no OCR server took."""
    return _samples(files, ("ocr_unavailable_total", _labels(), F.lit(1), F.lit(True)))


def ingest_samples(counts: DataFrame) -> DataFrame:
    """Of ingests (ts, n)."""
    return _samples(counts, ("ingest_new_total", _labels(), F.col("n"), F.lit(True)))


def model_outcome(http_status: Column, outcome: Column) -> Column:
    """How a call of the model counts."""
    refreshed = http_status.isin(401, 403) & (outcome == "transient")
    return (
        F.when(outcome == "no_slot", "no_slot").when(http_status == 0, "network_error").when(refreshed, "token_refresh").when(http_status.between(400, 499), "client_error").when(~http_status.between(200, 299), "server_error")
        .when(http_status.isNotNull(), "success")
    )


def model_samples(calls: DataFrame, slow_ms: int = 60_000, max_tokens: int = 20_000) -> DataFrame:
    """Of the model's calls (ts, http_status, outcome, elapsed_ms, prompt_tokens, completion_tokens, fix): requests, durations, tokens, slow ones, answers near their limit, bad ones and repairs."""
    from docloom.operators.enrich import near_limit, slow

    kind, one = model_outcome(F.col("http_status"), F.col("outcome")), F.lit(1)
    well = kind == "success"
    tokens = lambda t: ("llm_tokens_total", _labels(type=F.lit(t)), F.col(f"{t}_tokens"), well & (F.col(f"{t}_tokens") >= 0))
    return _samples(
        calls, ("llm_requests_total", _labels(outcome=kind), one, kind.isNotNull()), ("llm_duration_seconds", _labels(), F.col("elapsed_ms") / 1000, well), ("llm_last_duration_ms", _labels(), F.col("elapsed_ms"), well), tokens("prompt"), tokens("completion"),
        ("llm_slow_total", _labels(), one, well & slow(F.col("elapsed_ms"), slow_ms)), ("llm_near_limit_total", _labels(), one, well & near_limit(F.col("completion_tokens"), max_tokens)),
        ("llm_bad_output_total", _labels(), one, F.col("outcome") == "bad_output"), ("llm_xml_repair_total", _labels(), one, F.col("fix").isNotNull()),
    )


def _with_key(frame: DataFrame) -> DataFrame:
    return frame.withColumn("key", F.to_json(F.array_sort(F.map_entries("labels"))))  # maps don't group


def rolled(samples: DataFrame) -> DataFrame:
    """ROLLUP of samples: a row for each minute, name and labels, with a cumulative histogram over BOUNDS."""
    rows = _with_key(samples).withColumn("minute", F.date_trunc("minute", "ts"))
    below = F.array(*[F.count_if(F.col("value") <= b) for b in BOUNDS])
    last = F.max(F.struct("ts", "value"))
    found = rows.groupBy("minute", "name", "key").agg(F.any_value("labels").alias("labels"), F.count("*").alias("n"), F.sum("value").alias("total"), F.max("value").alias("largest"), last.alias("l"), below.alias("buckets"))
    return found.select("minute", "name", "labels", "n", "total", "largest", F.col("l.value").alias("last"), F.col("l.ts").alias("last_ts"), "buckets")


def merged_rollups(rollups: DataFrame, minute: Column | None = None) -> DataFrame:
    """Rollups of minutes as rollups of longer times (`minute`, such as hours), or of all."""
    rows = _with_key(rollups).withColumn("minute", F.lit(None).cast("timestamp") if minute is None else minute)
    cells = F.array(*[F.sum(F.col("buckets")[k]) for k in range(len(BOUNDS))])
    last = F.max(F.struct("last_ts", "last"))
    found = rows.groupBy("minute", "name", "key").agg(F.any_value("labels").alias("labels"), F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("largest").alias("largest"), last.alias("l"), cells.alias("buckets"))
    return found.select("minute", "name", "labels", "n", "total", "largest", F.col("l.last").alias("last"), F.col("l.last_ts").alias("last_ts"), "buckets")


def zeros(servers: tuple[str, ...]) -> list[tuple[str, str, dict[str, str]]]:
    """(kind, name, labels) of every metric that comes from samples."""
    counters_ = [("tasks_total", {"outcome": o}) for o in ("done", "transient", "empty", "missing")] + [("tasks_total", {"outcome": "failed", "kind": k}) for k in FAILED_KINDS] + [("tasks_total", {"outcome": "rejected", "reason": r}) for r in REJECTED_REASONS]
    counters_ += [(n, {}) for n in ("tasks_claimed_total", "ingest_new_total", "slow_parses_total", "llm_slow_total", "llm_near_limit_total", "llm_bad_output_total", "llm_xml_repair_total", "ocr_unavailable_total")]
    counters_ += [("llm_requests_total", {"outcome": o}) for o in MODEL_OUTCOMES] + [("llm_tokens_total", {"type": t}) for t in ("prompt", "completion")] + [("ocr_requests_total", {"server": s, "outcome": o}) for s in servers for o in REQUEST_OUTCOMES]
    timers_ = [("task_duration_seconds", {"phase": p}) for p in PHASES] + [("llm_duration_seconds", {})] + [("ocr_duration_seconds", {"server": s}) for s in servers]
    return [("counter", *x) for x in counters_] + [("timer", *x) for x in timers_] + [("gauge", "llm_last_duration_ms", {})]


def from_rollups(rollups: DataFrame, servers: tuple[str, ...]) -> DataFrame:
    """(name, labels, value) of all counters, timers (count, sum, largest and cumulative buckets) and last values, zeros included."""
    spark = rollups.sparkSession
    listed = _with_key(spark.createDataFrame(zeros(servers), "kind string, name string, labels map<string,string>"))
    found = _with_key(merged_rollups(rollups)).drop("labels", "minute")
    rows = listed.join(F.broadcast(found), ["name", "key"], "left")  # a row for each metric
    number = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("double")
    cell = lambda suffix, value, labels: F.struct(F.concat("name", F.lit(suffix)).alias("name"), labels.alias("labels"), value.alias("value"))
    le = lambda bound: F.map_concat("labels", _labels(le=F.lit(bound)))
    buckets = [cell("_bucket", F.coalesce(F.col("buckets")[k], F.lit(0)).cast("double"), le(str(b))) for k, b in enumerate(BOUNDS)] + [cell("_bucket", number("n"), le("+Inf"))]
    timer = F.array(cell("_count", number("n"), F.col("labels")), cell("_sum", number("total"), F.col("labels")), cell("_max", number("largest"), F.col("labels")), *buckets)
    cells = F.when(F.col("kind") == "timer", timer).when(F.col("kind") == "gauge", F.array(cell("", number("last"), F.col("labels")))).otherwise(F.array(cell("", number("total"), F.col("labels"))))
    return rows.select(F.inline(cells))


def gauges(queue: DataFrame, up: DataFrame, models: DataFrame, now: Column, cfg: Settings = Settings()) -> DataFrame:
    """(name, labels, value) of what holds now: the queue, servers (server, ready, in_flight), models (failures0, at0)."""
    row = lambda frame, name, labels, value: frame.select(F.lit(name).alias("name"), labels.alias("labels"), value.cast("double").alias("value"))
    known = F.element_at(F.create_map(*[F.lit(x) for pair in STATUSES.items() for x in pair]), F.col("status"))
    paused = policy.paused_models(models, now, cfg).agg(F.coalesce(F.max(F.col("paused").cast("int")), F.lit(0)).alias("n"))
    server = _labels(server=F.col("server"))
    parts = [
        row(queue_depth(queue), "queue_depth", _labels(status=known), F.col("n")),
        row(oldest_pending(queue, now, cfg.max_retries), "queue_oldest_pending_seconds", _labels(), F.col("seconds")),
        row(queue.agg(F.count_if(F.col("status") == 1).alias("n")), "workers_in_flight", _labels(), F.col("n")),
        row(up, "ocr_server_up", server, F.col("ready").cast("int")),
        row(up, "ocr_server_in_flight", server, F.coalesce("in_flight", F.lit(0))),
        row(up.agg(F.count_if("ready").alias("n")), "ocr_servers_available", _labels(), F.col("n")),
        row(up.agg(F.count("*").alias("n")), "ocr_servers_registered", _labels(), F.col("n")),
        row(up.agg(F.lit(0).alias("n")), "llm_in_flight", _labels(), F.col("n")),  # no call is under way between rounds
        row(models.agg(F.coalesce(F.max("failures0"), F.lit(0)).alias("n")), "llm_consecutive_failures", _labels(), F.col("n")),
        row(paused, "llm_paused", _labels(), F.col("n")),
    ]
    return reduce(DataFrame.unionByName, parts)


def catalogue(queue: DataFrame, rollups: DataFrame, events: DataFrame, calls: DataFrame, servers: tuple[str, ...], now: Column, cfg: Settings = Settings()) -> DataFrame:
    """(name, labels, value) of every metric of the service, zeros included: `rollups` of samples, and what holds now by the servers' events (probes among them) and the model's calls."""
    listed = queue.sparkSession.createDataFrame([(s,) for s in servers], "server string")
    up = listed.join(policy.standing(events, now, cfg), "server", "left").select("server", F.coalesce("ready", F.lit(True)).alias("ready"), F.lit(0).alias("in_flight"))
    return from_rollups(rollups, servers).unionByName(gauges(queue, up, policy.model_states(calls, cfg), now, cfg))


def exposition(metrics: DataFrame) -> DataFrame:
    """Lines of the text format of metrics endpoints, from rows (name, labels map, value)."""
    pairs = F.array_sort(F.transform(F.map_entries("labels"), lambda e: F.concat(e["key"], F.lit('="'), F.regexp_replace(e["value"], r'(["\\])', r"\\$1"), F.lit('"'))))
    label = F.when(F.size("labels") > 0, F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))).otherwise("")
    return metrics.select(F.concat("name", label, F.lit(" "), F.col("value").cast("string")).alias("line"))
