"""Queries on attempt and call logs: policies and metrics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators import metrics, policy
from docloom.plans.virtual import ctes, view
from docloom.sources.logs import matching, since_restart, token_usage
from docloom.sources.logs import minute_deltas as deltas

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


_STREAKS = (
    ctes("vlog")
    + """, a as (select *, max(case when outcome in ('done', 'empty') then ts end) over (partition by instance order by ts, seq rows unbounded preceding) as last,
  sum(case when outcome in ('done', 'empty', 'rejected') then 1 else 0 end) over (partition by task_id order by ts, seq) as life from vlog),
b as (select task_id, ts, seq, life, contains(error, 'IsSuccess=false') as specific, last is null or ts - last > interval 10 minute as outage from a where outcome = 'transient'),
c as (select *, ts - lag(ts) over (partition by task_id, life order by ts, seq) > interval 60 minute as gap from b),
d as (select *, sum(case when gap then 1 else 0 end) over (partition by task_id, life order by ts, seq) as idle from c),
e as (select *, sum(case when specific then 0 else 1 end) over w as breaks, sum(outage::int) over w as quiet from d window w as (partition by task_id, life, idle order by ts, seq)),
f as (select task_id, ts, seq, specific, outage, cast(sum(specific::int) over (partition by task_id, life, idle, breaks order by ts, seq) as bigint) as poison,
  cast(sum(case when outage then 0 else 1 end) over (partition by task_id, life, idle, quiet order by ts, seq) as bigint) as any from e)"""
)


@query(_STREAKS + " select * from f")
def failure_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document-specific and other failures in a row, outages and idle times taken into account."""
    return policy.streaks(view(spark, sf_dir, "vlog"))


#: Streaks of a log so dense that default settings reach every verdict.
_DENSE = ctes("vdense") + _STREAKS.removeprefix(ctes("vlog")).replace("from vlog", "from vdense")
_LONG = "cast(least(900.0, 60 * pow(1.6, greatest(0, \"any\" - 1))) as double)"


@query(_DENSE + f""" select task_id, seq, case when poison >= 3 then 'poison' when "any" >= 10 then 'zombie' else 'transient' end as verdict, cast(case when poison < 3 and "any" < 10 then floor({_LONG}) end as int) as backoff from f""")
def retry_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Poison, zombie or another try, with the delay before jitter."""
    return policy.verdicts(policy.streaks(view(spark, sf_dir, "vdense"))).select("task_id", "seq", "verdict", "backoff")


@query(ctes("vlog") + ", c as (select task_id, count(*) filter (outcome = 'transient') as streak from vlog group by task_id) select task_id, streak, cast(floor(least(900.0, 60 * pow(1.6, greatest(0, streak - 1)))) as int) as seconds from c")
def backoff_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full delay after as many failures as each task ever had."""
    counts = view(spark, sf_dir, "vlog").groupBy("task_id").agg(F.count_if(F.col("outcome") == "transient").alias("streak"))
    return counts.withColumn("seconds", policy.backoff_seconds(F.col("streak")))


@query(
    ctes("vcalls")
    + """, r as (select *, coalesce(sum(ok::int) over (partition by server order by ts, seq), 0) as run from vcalls),
f as (select *, cast(sum(case when ok then 0 else 1 end) over (partition by server, run order by ts, seq) as bigint) as failures from r),
u as (select *, case when failures >= 3 then ts + interval 60 second end as paused_until from f)
select server, ts, seq, failures, paused_until, coalesce(ts < lag(paused_until) over (partition by server order by ts, seq), false) as paused from u"""
)
def breaker_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The breaker at every call."""
    return policy.breaker(view(spark, sf_dir, "vcalls"), "server").select("server", "ts", "seq", "failures", "paused_until", "paused")


@query(
    ctes("vcalls")
    + """, g as (select *, count(case when event in ('transport', 'green') then 1 end) over (partition by server order by ts, seq) as k, max(case when event = 'refusal' then ts + interval 30 second end) over (partition by server order by ts, seq) as logical_until from vcalls),
h as (select *, max(case when event = 'transport' then ts + interval 30 second end) over (partition by server, k) as transport_until from g)
select server, ts, seq, event, transport_until, logical_until, not (coalesce(ts < transport_until, false) or coalesce(ts < logical_until, false)) as ready from h"""
)
def server_penalties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Servers' penalties after every event."""
    return policy.penalties(view(spark, sf_dir, "vcalls")).select("server", "ts", "seq", "event", "transport_until", "logical_until", "ready")


_KINDS = "('saved', 'short_text', 'oversized', 'empty_ocr', 'bad_format', 'llm_bad_output', 'llm_permanent', 'llm_unavailable', 'ocr_unavailable', 'no_source', 'lease_lost', 'boom')"


@query(
    f"""with k as (select event_id, list_extract({_KINDS.replace('(', '[').replace(')', ']')}, cast(event_id % 12 + 1 as int)) as kind from events)
select event_id, kind, case kind when 'saved' then 'done' when 'short_text' then 'empty' when 'no_source' then 'missing' when 'lease_lost' then 'dropped' when 'oversized' then 'rejected' when 'empty_ocr' then 'rejected' when 'bad_format' then 'rejected'
 when 'llm_unavailable' then 'transient' when 'ocr_unavailable' then 'transient' else 'failed' end as outcome,
 case kind when 'llm_permanent' then 'llm_config' when 'boom' then 'error' when 'oversized' then kind when 'empty_ocr' then kind when 'bad_format' then kind when 'llm_bad_output' then kind end as detail from k"""
)
def classified_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each kind of ending is settled."""
    kinds = [k.strip(" '") for k in _KINDS.strip("()").split(",")]
    kind = F.element_at(F.array(*map(F.lit, kinds)), (F.col("event_id") % 12 + 1).cast("int"))
    rows = view(spark, sf_dir, "events").select("event_id", kind.alias("kind"))
    return rows.withColumn("c", policy.classified(F.col("kind"))).select("event_id", "kind", "c.outcome", "c.detail")


@query(ctes("vlog") + " select instance, outcome, count(*) as n from vlog group by all")
def outcome_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.counters(view(spark, sf_dir, "vlog"), "instance", "outcome")


@query(
    ctes("vcalls")
    + """, c as (select server, case event when 'transport' then 'transport_error' when 'refusal' then 'service_refusal' else 'success' end as outcome from vcalls),
g as (select * from (select distinct server from vcalls), (select unnest(['success', 'transport_error', 'http_error', 'document_error', 'service_refusal']) as outcome))
select g.server, g.outcome, count(c.server) as n from g left join c using (server, outcome) group by all"""
)
def request_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests by server and outcome, zeros included."""
    calls = view(spark, sf_dir, "vcalls")
    outcome = F.when(F.col("event") == "transport", "transport_error").when(F.col("event") == "refusal", "service_refusal").otherwise("success")
    return metrics.filled_counters(calls.withColumn("outcome", outcome), calls.select("server").distinct())


@query(ctes("vcalls") + " select cast(sum(case when prompt_tokens >= 0 then prompt_tokens else 0 end) as bigint) as prompt, cast(sum(case when completion_tokens >= 0 then completion_tokens else 0 end) as bigint) as completion from vcalls")
def token_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.token_sums(view(spark, sf_dir, "vcalls"))


@query(ctes("vcalls") + " select server, count(value) as n, round(sum(value), 3) as total, max(value) as largest, quantile_disc(value, 0.5) as median, quantile_disc(value, 0.95) as p95 from vcalls group by server")
def latency_timers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.timers(view(spark, sf_dir, "vcalls"), "value", "server")


@query(
    ctes("vcalls")
    + """, r as (select doc_id, elapsed_ms, count(*) over (partition by doc_id) as n, row_number() over (partition by doc_id order by elapsed_ms) - 1 as k from vcalls),
i as (select *, least(n - 1, cast(round_even(n * 0.5, 0) as bigint)) as m, least(n - 1, cast(round_even(n * 0.95, 0) as bigint)) as q from r where n >= 10)
select doc_id, max(n) as n, max(case when k = m then elapsed_ms end) as median, max(case when k = q then elapsed_ms end) as p95, max(elapsed_ms) as largest from i group by doc_id"""
)
def latency_by_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles by position, for documents with ten calls or more."""
    return metrics.index_quantiles(view(spark, sf_dir, "vcalls"), "elapsed_ms", "doc_id")


@query(
    ctes("vcalls")
    + """, b as (select unnest(['1.0', '5.0', '10.0', '50.0', '+Inf']) as le) select server, le, count(*) filter (le = '+Inf' or value <= case when le = '+Inf' then 0 else cast(replace(le, '+Inf', '0') as double) end) as n from vcalls, b group by server, le"""
)
def latency_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.timer_buckets(view(spark, sf_dir, "vcalls"), "value", [1.0, 5.0, 10.0, 50.0], "server")


@query(ctes("vcalls") + " select date_trunc('minute', ts) as minute, count(*) as n from vcalls group by 1 order by 1 desc limit 30")
def last_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls of the last thirty minutes that had any (the limit is the report's)."""
    return metrics.per_minute(view(spark, sf_dir, "vcalls"))


@query(ctes("vcalls") + ", m as (select server, date_trunc('day', ts) as minute, cast(max(seq) as bigint) as n from vcalls group by all) select server, minute, n, n - lag(n) over (partition by server order by minute) as delta from m")
def count_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of a cumulative count from one reading to the next."""
    readings = view(spark, sf_dir, "vcalls").groupBy("server", F.date_trunc("day", "ts").alias("minute")).agg(F.max("seq").alias("n"))
    return deltas(readings, "n", "server").withColumn("minute", F.col("minute").cast("timestamp_ntz"))


@query(
    ctes("vcalls")
    + """, s as (select server, count(*) as n, count(*) filter (event = 'transport') as bad, min(ts) as a, max(ts) as b from vcalls group by server)
select server, n, bad, round(bad * 100.0 / n, 4) as share, case when bad * 100.0 / n < 1 then 'ok' when bad * 100.0 / n <= 3 then 'watch' else 'reduce' end as grade,
 round(n / greatest(cast(epoch(date_trunc('second', b)) - epoch(date_trunc('second', a)) as double) / 3600, 1.0 / 3600), 4) as per_hour from s"""
)
def timeout_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.shares(view(spark, sf_dir, "vcalls"), F.col("event") == "transport", "server")


@query(ctes("vcalls") + ", r as (select server, max(ts) as restarted from vcalls where seq % 500 = 7 group by server) select server, cast(count(*) as bigint) as n from vcalls left join r using (server) where restarted is null or ts >= restarted group by server")
def since_last_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries since each server's last restart marker."""
    log = view(spark, sf_dir, "vcalls").withColumn("message", F.when(F.col("seq") % 500 == 7, "service started").otherwise(F.col("event")))
    return since_restart(log, "service started", "server").groupBy("server").agg(F.count("*").alias("n"))


@query(ctes("vcalls") + " select ts, prompt_tokens as prompt, completion_tokens as completion from vcalls where prompt_tokens >= 0 and completion_tokens >= 0")
def token_ceiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompt and completion tokens that log messages state, most first."""
    message = F.concat(F.lit("tokens="), F.col("prompt_tokens").cast("string"), F.lit("/"), F.col("completion_tokens").cast("string"), F.lit(" done"))
    return token_usage(view(spark, sf_dir, "vcalls").where("prompt_tokens >= 0 and completion_tokens >= 0").withColumn("message", message))


@query(ctes("vcalls") + " select server, ts, seq from vcalls where event = 'refusal' order by ts desc, seq desc limit 8")
def last_refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last eight entries that match a pattern (the limit is the report's)."""
    log = view(spark, sf_dir, "vcalls").withColumn("message", F.concat(F.lit("refused, call "), F.lpad(F.col("seq").cast("string"), 12, "0"))).where("event = 'refusal'")
    return matching(log, "^refus", 8).select("server", "ts", "seq")


@query(
    ctes("vcalls")
    + """, r as (select elapsed_ms, count(*) over () as n, row_number() over (order by elapsed_ms) - 1 as k from vcalls), q as (select max(case when k = least(n - 1, cast(round_even(n * 0.5, 0) as bigint)) then elapsed_ms end) as median, max(case when k = least(n - 1, cast(round_even(n * 0.95, 0) as bigint)) then elapsed_ms end) as p95 from r),
s as (select count(*) as n, count(*) filter (event = 'success') as successes, count(*) filter (event = 'transport') as timeouts, count(*) filter (event = 'refusal') as refusals, max(elapsed_ms) as largest, min(ts) as a, max(ts) as b from vcalls)
select n, successes, timeouts, refusals, round(timeouts * 100.0 / n, 4) as timeout_share, round(successes / greatest(cast(epoch(date_trunc('second', b)) - epoch(date_trunc('second', a)) as double) / 3600, 1.0 / 3600), 4) as successes_per_hour, median, p95, largest from s, q"""
)
def service_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row on the whole log: outcomes, rates and times."""
    return metrics.overview(view(spark, sf_dir, "vcalls"), "elapsed_ms")


@query(ctes("vcalls") + """ select concat('requests_total{outcome="', event, '",server="', server, '"} ', cast(count(*) as string)) as line from vcalls group by server, event""")
def metric_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters in the text format of metrics endpoints."""
    counts = metrics.counters(view(spark, sf_dir, "vcalls"), "server", "event")
    labels = F.create_map(F.lit("server"), "server", F.lit("outcome"), "event")
    return metrics.exposition(counts.select(F.lit("requests_total").alias("name"), labels.alias("labels"), F.col("n").alias("value")))


@query(
    ORACLE["server_penalties"].replace("select server, ts, seq, event, transport_until", ", x as (select server, ts, seq, event, transport_until").replace("as ready from h", "as ready from h), y as (select server, arg_max(ready, seq) as ready from x group by server)")
    + " select count(*) filter (ready) as available, count(*) as servers, string_agg(server || '=' || case when ready then 'UP' else 'DOWN' end, ', ' order by server) as snapshot from y"
)
def available_servers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many servers may be asked at the end of the log."""
    return policy.snapshot(policy.latest(policy.penalties(view(spark, sf_dir, "vcalls")).select("server", "ts", "seq", "ready")))


@query("select doc_id, case lower(trim(source, ' ')) when 'src0' then 'web' when 'src1' then 'books' else source end as kind from documents")
def normalized_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docloom.operators.enrich import normalized_type

    return view(spark, sf_dir, "documents").select("doc_id", normalized_type(F.col("source"), {"SRC0": "web", "src1": "books"}).alias("kind"))
