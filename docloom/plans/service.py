"""Queries on what keeps the service going: policies by states, calls in waves, the catalogue of metrics."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators import enrich, metrics, policy
from docloom.operators.governed import Limits, Stepped, numbered
from docloom.plans import logs
from docloom.plans.virtual import NOW, ctes, now, view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
CUT = "timestamp_ntz '2024-01-15 12:00:00'"


def query(sql: str):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__], ORACLE[f.__name__] = f, sql
        return f

    return register


def _parts(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, DataFrame]:
    """A log up to a time, and after it."""
    log = view(spark, sf_dir, name)
    return log.where(f"ts < {CUT}"), log.where(f"ts >= {CUT}")


@query(logs.ORACLE["failure_streaks"])
def streaks_by_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaks of a log in two parts, the second counted from the states after the first."""
    first, second = _parts(spark, sf_dir, "vlog")
    states = policy.task_states(first).where("last is not null")
    return policy.streaks(first).unionByName(policy.streaks(second, before=states, successes=policy.instance_states(first)))


@query(logs.ORACLE["breaker_states"])
def breaker_by_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The breaker at every call of a log in two parts, the second from the states after the first."""
    first, second = _parts(spark, sf_dir, "vcalls")
    every = policy.breaker(first, "server").unionByName(policy.breaker(second, "server", before=policy.model_states(first)))
    return every.select("server", "ts", "seq", "failures", "paused_until", "paused")


@query(logs.ORACLE["server_penalties"])
def penalties_by_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Penalties after every event of a log in two parts, the second from the states after the first."""
    first, second = _parts(spark, sf_dir, "vcalls")
    every = policy.penalties(first).unionByName(policy.penalties(second, before=policy.server_states(first)))
    return every.select("server", "ts", "seq", "event", "transport_until", "logical_until", "ready")


class Outage:
    """A model that takes a second for each answer and fails for texts that say so."""

    def ask(self, target: str, request: str) -> tuple[int, str | None, int]:
        if "outage" in json.loads(request)["messages"][1]["content"]:
            return 503, "busy", 1000
        return 200, json.dumps({"choices": [{"finish_reason": "stop", "message": {"content": "<Document><A>x</A></Document>"}}]}), 1000


@query(
    """with r as (select doc_id, row_number() over (order by doc_id) - 1 as k, count(*) over () as n from documents),
w as (select doc_id, k, k // cast(ceil(n / 10) as bigint) as wave from r)
select doc_id as id, 1 as attempt, wave, case when wave <= 2 then 'ok' when wave = 3 then 'no_slot' else 'paused' end as outcome, case when wave <= 3 then wave * 1000 else 3000 end as at_ms, case when wave <= 2 then 1000 end as elapsed_ms, case when wave <= 2 then true when wave = 3 then false end as ok from w
union all select doc_id, 2, wave - 3, case wave when 3 then 'ok' when 4 then 'transient' else 'paused' end, case wave when 3 then 5000 when 4 then 6000 else 7000 end, case when wave <= 4 then 1000 end, case wave when 3 then true when 4 then false end from w where wave >= 3"""
)
def governed_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All attempts of calls in ten waves: the fourth waits too long for a slot, which pauses the rest; after the pause between attempts the fifth meets an outage, which pauses it again."""
    docs, n = numbered(view(spark, sf_dir, "documents").select(F.col("doc_id").alias("id")))
    each = -(-n // 10)
    texts = docs.select("id", F.when(F.floor(F.col("nth") / each) == 4, "a text of the outage").otherwise("a text").alias("text"))
    at_once = 5 if each % 5 == 0 else 1
    limits = Limits(per_slot=each // at_once, slot_wait_ms=2500, backoff_ms=2000, failures=3, pause_ms=1500)
    request = enrich.llm_request("model", "Answer.", F.col("text"))
    _, calls = enrich.with_headers(texts, request, Outage(), at_once, 2, limits, Stepped())
    return calls.select("id", "attempt", "wave", "outcome", "at_ms", "elapsed_ms", "ok")


SERVERS = tuple(f"app{k}" for k in range(6))
_STATUS = "case event when 'transport' then 0 when 'refusal' then 500 when 'green' then 401 else 200 end"
_ANSWER = "case when event in ('transport', 'refusal', 'green') then 'transient' when seq % 10 = 0 then 'bad_output' else 'ok' end"
_FIX = "case when event = 'success' and seq % 10 <> 0 and seq % 4 = 1 then 'closed' end"
_SERVER = "case event when 'transport' then 'transport_error' when 'refusal' then 'service_refusal' when 'green' then 'http_error' else 'success' end"
_ENDING = "case outcome when 'other' then 'rejected' else outcome end"
_DETAIL = "case outcome when 'failed' then case seq % 3 when 0 then 'llm_bad_output' when 1 then 'llm_config' else 'error' end when 'other' then case seq % 5 when 0 then 'bad_format' when 1 then 'empty_ocr' when 2 then 'oversized' when 3 then 'poison' else 'zombie' end end"
_LISTED = ", ".join(f"('{kind}', '{name}', '{','.join(f'{k}={v}' for k, v in sorted(labels.items()))}')" for kind, name, labels in metrics.zeros(SERVERS))
_CELLS = " ".join(f"union all select name || '_bucket', labels || case when labels = '' then '' else ',' end || 'le={b}', coalesce(b{k}, 0) from j where kind = 'timer'" for k, b in enumerate(metrics.BOUNDS))


@query(
    ctes("vcalls", "vlog", "vqueue")
    + f""", calls as (select ts, {_STATUS} as st, {_ANSWER} as o, elapsed_ms as ms, prompt_tokens as pt, completion_tokens as ct, {_FIX} as fix from vcalls),
tasks as (select ts, {_ENDING} as o, {_DETAIL} as d, seq * 37 % 12000 as parse, seq % 5000 as model from vlog),
samples as (select ts, 'tasks_total' as name, 'outcome=' || o as labels, 1.0::double as v from tasks where o in ('done', 'transient') union all select ts, 'tasks_total', 'kind=' || d || ',outcome=failed', 1 from tasks where o = 'failed'
 union all select ts, 'tasks_total', 'outcome=rejected,reason=' || d, 1 from tasks where o = 'rejected' union all select ts, 'tasks_claimed_total', '', 1 from tasks union all select ts, 'slow_parses_total', '', 1 from tasks where parse > 10000
 union all select ts, 'task_duration_seconds', 'phase=total', (parse + model) / 1000.0 from tasks union all select ts, 'task_duration_seconds', 'phase=parse', parse / 1000.0 from tasks where o = 'done' union all select ts, 'task_duration_seconds', 'phase=model', model / 1000.0 from tasks where o = 'done'
 union all select ts, 'ocr_requests_total', 'outcome=' || {_SERVER} || ',server=' || server, 1 from vcalls union all select ts, 'ocr_duration_seconds', 'server=' || server, elapsed_ms / 1000.0 from vcalls
 union all select ts, 'llm_requests_total', 'outcome=' || case st when 0 then 'network_error' when 401 then 'token_refresh' when 500 then 'server_error' else 'success' end, 1 from calls
 union all select ts, 'llm_duration_seconds', '', ms / 1000.0 from calls where st = 200 union all select ts, 'llm_last_duration_ms', '', ms from calls where st = 200 union all select ts, 'llm_tokens_total', 'type=prompt', pt from calls where st = 200 and pt >= 0 union all select ts, 'llm_tokens_total', 'type=completion', ct from calls where st = 200 and ct >= 0
 union all select ts, 'llm_slow_total', '', 1 from calls where st = 200 and ms >= 5000 union all select ts, 'llm_near_limit_total', '', 1 from calls where st = 200 and ct * 5 >= 70 * 4 union all select ts, 'llm_bad_output_total', '', 1 from calls where o = 'bad_output' union all select ts, 'llm_xml_repair_total', '', 1 from calls where fix is not null),
a as (select name, labels, count(*) as n, sum(v) as total, max(v) as largest, max(row(ts, v))[2] as last, {', '.join(f'count(*) filter (v <= {b}) as b{k}' for k, b in enumerate(metrics.BOUNDS))} from samples group by name, labels),
z as (select * from (values {_LISTED}) as z(kind, name, labels)),
j as (select z.*, coalesce(n, 0) as n, coalesce(total, 0) as total, coalesce(largest, 0) as largest, coalesce(last, 0) as last, b0, b1, b2, b3, b4, b5 from z left join a using (name, labels)),
pen as (with {ORACLE['penalties_by_states'].removeprefix(ctes('vcalls') + ', ')}),
up as (select server, arg_max(case when transport_until > timestamp '{NOW}' or logical_until > timestamp '{NOW}' then 0 else 1 end, row(ts, seq)) as ready from pen group by server),
br as (with {ORACLE['breaker_by_states'].removeprefix(ctes('vcalls') + ', ')}),
mo as (select server, max(row(ts, seq, failures))[3] as f, max(ts) as seen from br group by server),
found as (select name, labels, total as value from j where kind = 'counter' union all select name, labels, last from j where kind = 'gauge' union all select name || '_count', labels, n from j where kind = 'timer' union all select name || '_sum', labels, total from j where kind = 'timer' union all select name || '_max', labels, largest from j where kind = 'timer' {_CELLS}
 union all select name || '_bucket', labels || case when labels = '' then '' else ',' end || 'le=+Inf', n from j where kind = 'timer'
 union all select 'queue_depth', 'status=' || ['new', 'processing', 'done', 'error'][s + 1], count(id) from range(4) t(s) left join vqueue on status = s group by s
 union all select 'queue_oldest_pending_seconds', '', coalesce(date_diff('second', min(created_at), timestamp '{NOW}'), 0) from vqueue where status = 0 or (status = 3 and retry_count < 2) union all select 'workers_in_flight', '', count(*) filter (status = 1) from vqueue
 union all select 'ocr_server_up', 'server=' || server, ready from up union all select 'ocr_server_in_flight', 'server=' || server, 0 from up union all select 'ocr_servers_available', '', sum(ready) from up union all select 'ocr_servers_registered', '', count(*) from up union all select 'llm_in_flight', '', 0
 union all select 'llm_consecutive_failures', '', max(f) from mo union all select 'llm_paused', '', max(case when f >= 3 and seen + interval 60 second > timestamp '{NOW}' then 1 else 0 end) from mo)
select name, array_to_string(list_sort(string_split(labels, ',')), ',') as labels, round(value::double, 6) as value from found"""
)
def metric_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every metric, from samples that were rolled up by minutes and merged, and from what holds now."""
    calls, tasks = view(spark, sf_dir, "vcalls"), view(spark, sf_dir, "vlog")
    model = calls.selectExpr("ts", f"{_STATUS} as http_status", f"{_ANSWER} as outcome", "elapsed_ms", "prompt_tokens", "completion_tokens", f"{_FIX} as fix")
    endings = tasks.selectExpr("ts", f"{_ENDING} as outcome", f"{_DETAIL} as detail", "cast(null as bigint) as load_ms", "seq * 37 % 12000 as parse_ms", "seq % 5000 as model_ms").withColumn("total_ms", F.col("parse_ms") + F.col("model_ms"))
    samples = metrics.task_samples(endings).unionByName(metrics.server_samples(calls.selectExpr("ts", "server", f"{_SERVER} as outcome", "elapsed_ms"))).unionByName(metrics.model_samples(model, slow_ms=5000, max_tokens=70))
    found = metrics.catalogue(view(spark, sf_dir, "vqueue"), metrics.rolled(samples), calls.select("server", "ts", "seq", "event"), calls.select("server", "ts", "seq", "ok"), SERVERS, now())
    labels = F.array_join(F.array_sort(F.transform(F.map_entries("labels"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ",")
    return found.select("name", labels.alias("labels"), F.round("value", 6).alias("value"))
