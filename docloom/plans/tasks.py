"""Queries on the task queue and the document catalog."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.text import UNWANTED_NAMES, seconds_between
from docloom.operators import metrics, queue
from docloom.plans.virtual import KIND, NOW, ctes, now, view
from docloom.schema import EMPTY_MESSAGE, MISSING_MESSAGE, Settings
from docloom.sources import catalog
from docloom.sources.changelog import ChangeLog
from docloom.sources.scratch import fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

ELIGIBLE = f"""((status = 0 and (next_attempt_at is null or next_attempt_at <= timestamp '{NOW}'))
 or (status = 1 and locked_at < timestamp '{NOW}' - interval 3600 second)
 or (status = 3 and retry_count < 2 and updated_at < timestamp '{NOW}' - interval 60 second))"""
ORDER = "case status when 1 then 0 when 0 then 1 else 2 end, case when status = 3 then date_diff('second', timestamp '2000-01-01', created_at) else 0 end, created_at desc, id"


def query(sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


@query(ctes("vqueue") + " select cast(s as int) as status, count(id) as n from range(4) t(s) left join vqueue on status = s group by s")
def queue_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks of each status, zeros included."""
    return metrics.queue_depth(view(spark, sf_dir, "vqueue"))


@query(ctes("vqueue") + f" select coalesce(date_diff('second', min(created_at), timestamp '{NOW}'), 0) as seconds from vqueue where status = 0 or (status = 3 and retry_count < 2)")
def oldest_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Age of the oldest task that waits."""
    return metrics.oldest_pending(view(spark, sf_dir, "vqueue"), now())


@query(ctes("vqueue") + f" select id, status, created_at, retry_count from vqueue where {ELIGIBLE} order by {ORDER} limit 1000")
def claim_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next thousand tasks in claim order (the limit is the operator's)."""
    return queue.claim(view(spark, sf_dir, "vqueue"), now(), 1000).select("id", "status", "created_at", "retry_count")


_LEASED = f""", picked as (select id from vqueue where {ELIGIBLE} order by {ORDER} limit 1000)
select q.id, case when p.id is null then q.status else 1 end as status, case when p.id is null then q.locked_by else 'host/1/abc' end as locked_by,
 case when p.id is null then q.locked_at else timestamp '{NOW}' end as locked_at, case when p.id is null then q.claim_token else 'batch-1' end as claim_token, q.updated_at
from vqueue q left join picked p on p.id = q.id"""


@query(ctes("vqueue") + _LEASED)
def claimed_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole queue after a batch was leased."""
    tasks = view(spark, sf_dir, "vqueue")
    return queue.leased(tasks, queue.claim(tasks, now(), 1000), "host/1/abc", "batch-1", now()).select("id", "status", "locked_by", "locked_at", "claim_token", "updated_at")


@query(
    ctes("vqueue")
    + f""" select case when {ELIGIBLE} then 'claimable' when status = 2 then 'done' when status = 1 then 'leased' when status = 0 then 'scheduled' when retry_count >= 2 then 'exhausted' else 'cooling' end as state,
 count(*) as n from vqueue group by 1"""
)
def queue_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the tasks wait for."""
    return queue.due(view(spark, sf_dir, "vqueue"), now())


_SETTLED = f""", o as (select id, outcome, error, delay_seconds from voutcomes join vqueue using (id, locked_by, claim_token) where outcome <> 'heartbeat' or status = 1),
j as (select q.*, o.outcome as o, o.error as oe, o.delay_seconds as od from vqueue q left join o on o.id = q.id)
select id, cast(case when o = 'done' then 2 when o = 'transient' then 0 when o is null or o = 'heartbeat' then status else 3 end as int) as status,
 case when o = 'done' then null when o = 'failed' then substr(coalesce(oe, ''), 1, 2000)
  when o = 'rejected' then case when oe is null then '' when length(oe) <= 500 then oe else substr(oe, 1, 500) || '…' end
  when o = 'empty' then '{EMPTY_MESSAGE}' when o = 'missing' then '{MISSING_MESSAGE}' else error_message end as error_message,
 cast(case when o in ('failed', 'missing') then retry_count + 1 when o in ('empty', 'rejected') then 9999 else retry_count end as int) as retry_count,
 case when o = 'transient' then timestamp '{NOW}' + to_seconds(od) else next_attempt_at end as next_attempt_at,
 case when o in ('done', 'empty', 'rejected') then null else parsed_text end as parsed_text,
 case when o is null or o = 'heartbeat' then locked_by end as locked_by,
 case when o is null then locked_at when o = 'heartbeat' then timestamp '{NOW}' end as locked_at,
 case when o is null or o = 'heartbeat' then claim_token end as claim_token,
 case when o is null or o = 'heartbeat' then updated_at else timestamp '{NOW}' end as updated_at from j"""


@query(ctes("vqueue", "voutcomes") + _SETTLED)
def settled_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole queue after outcomes of all kinds, stale leases among them."""
    after = queue.settled(view(spark, sf_dir, "vqueue"), view(spark, sf_dir, "voutcomes"), now())
    return after.select("id", "status", "error_message", "retry_count", "next_attempt_at", "parsed_text", "locked_by", "locked_at", "claim_token", "updated_at")


def _logged(table: DataFrame) -> ChangeLog:
    """A queue as a log of changes, its rows in the base."""
    spark = table.sparkSession
    log = ChangeLog(spark, fresh_path(spark, "queue"), ", ".join(f"{n} {kind}" for n, kind in table.dtypes), "id", buckets=8)
    log.change(lambda _: table)
    log.compact()
    return log


@query(ctes("vqueue") + _LEASED)
def claims_by_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The queue after a claim that was committed as the rows that it changed."""
    log = _logged(view(spark, sf_dir, "vqueue"))
    log.change(lambda q: queue.claimed_rows(q, "host/1/abc", "batch-1", now(), 1000), "claim/batch-1")
    return log.read().select("id", "status", "locked_by", "locked_at", "claim_token", "updated_at")


@query(ctes("vqueue", "voutcomes") + _SETTLED)
def outcomes_by_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The queue after outcomes that were committed as the rows that they changed, and merged into the buckets that they touch."""
    log = _logged(view(spark, sf_dir, "vqueue"))
    log.change(lambda q: queue.settled_rows(q, view(spark, sf_dir, "voutcomes"), now()), "settle/1")
    log.compact()
    return log.read().select("id", "status", "error_message", "retry_count", "next_attempt_at", "parsed_text", "locked_by", "locked_at", "claim_token", "updated_at")


@query(
    ctes("vqueue", "vfiles")
    + f""", live as (select id, locked_by from vqueue where status = 1 and locked_at >= timestamp '{NOW}' - interval 3600 second),
sized as (select l.id, l.locked_by, coalesce(d.n_chars >= 4096, false) as heavy from live l left join documents d on d.doc_id = l.id),
held as (select locked_by, count(*) filter (not heavy) as light, count(*) filter (heavy) as heavy from sized group by locked_by)
select locked_by, light, heavy, greatest(0, 900 - light) as free_light, greatest(0, 60 - heavy) as free_heavy from held"""
)
def owner_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leases that each owner holds and the slots that it has free, large files apart."""
    heads = view(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), (F.col("n_chars") * 256).alias("size_bytes"))
    return queue.slots(view(spark, sf_dir, "vqueue"), heads, now(), Settings(slots=900, heavy_batch=60, heavy_mb=1))


def _one(outcome: str, *columns: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tasks = view(spark, sf_dir, "vqueue")
        return queue.settled(tasks, view(spark, sf_dir, "voutcomes").where(F.col("outcome") == outcome), now()).select("id", *columns)

    run.__name__ = f"apply_{outcome}"
    return run


_COLUMNS = ("status", "error_message", "retry_count", "next_attempt_at", "parsed_text", "locked_by", "locked_at", "claim_token", "updated_at")
for _outcome in queue.OUTCOMES:
    _these = ctes("vqueue", "voutcomes") + _SETTLED.replace("where outcome <> 'heartbeat' or status = 1", f"where outcome = '{_outcome}' and (outcome <> 'heartbeat' or status = 1)")
    query(_these)(_one(_outcome, *_COLUMNS))


@query(
    ctes("vqueue", "voutcomes")
    + f""", done as (select q.id as doc_id, q.file_id, q.file_name, o.xml_data, q.locked_by as created_by, timestamp '{NOW}' as created_at from vqueue q join voutcomes o using (id, locked_by, claim_token) where o.outcome = 'done'),
old as (select id as doc_id, file_id, file_name, concat('old ', cast(id as string)) as xml_data, 'earlier' as created_by, created_at from vqueue where status = 2)
select * from done union all select * from old where doc_id not in (select doc_id from done)"""
)
def stored_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results after the done outcomes: each replaces its document's earlier one."""
    tasks = view(spark, sf_dir, "vqueue")
    old = tasks.where("status = 2").select(F.col("id").alias("doc_id"), "file_id", "file_name", F.concat(F.lit("old "), F.col("id").cast("string")).alias("xml_data"), F.lit("earlier").alias("created_by"), "created_at")
    return queue.with_results(old, tasks, view(spark, sf_dir, "voutcomes"), now())


# catalog: cards are orders, kinds their priorities, versions their lines, files parts named as documents are

_CATALOG = f"""link_cards as (select cast(o_orderkey as string) as card from orders),
cards as (select cast(o_orderkey as string) as card from orders where o_orderstatus = 'O' and o_orderdate >= timestamp '1996-01-01 12:00:00' - interval 400 day),
kinds as (select cast(o_orderkey as string) as card from orders where lower(case when o_orderkey % 3 = 0 then 'KIND-A' else 'kind-b' end) = '{KIND}'),
versions as (select cast(l_orderkey as string) as card, concat(cast(l_orderkey as string), '/', cast(l_linenumber as string)) as version from lineitem),
vfs as (select concat(cast(l_orderkey as string), '/', cast(l_linenumber as string)) as version, cast(l_partkey as string) as file_id from lineitem),
parts as (select cast(p_partkey as string) as file_id, concat('part', cast(p_partkey as string), case p_partkey % 6 when 0 then '.docx' when 1 then '.DOC' when 2 then '.txt' when 3 then '.Pdf ' when 4 then '' else ' печатная форма.pdf' end) as file_name from part),
wanted as (select file_id, file_name from parts where position('.' in file_name) > 0 and lower(rtrim(regexp_extract(file_name, '[^.]*$'))) in ('doc', 'docx', 'pdf')
 and not file_name ilike '%{UNWANTED_NAMES[0]}%' and not file_name ilike '%{UNWANTED_NAMES[1]}%'),
found as (select distinct file_id, file_name from link_cards join cards using (card) join kinds using (card) join versions using (card) join vfs using (version) join wanted using (file_id))"""


def _catalog(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    orders, lines, part = (view(spark, sf_dir, t) for t in ("orders", "lineitem", "part"))
    card, version = F.col("o_orderkey").cast("string"), F.concat(F.col("l_orderkey").cast("string"), F.lit("/"), F.col("l_linenumber").cast("string"))
    key = F.col("p_partkey")
    suffix = F.element_at(F.array(*map(F.lit, (".docx", ".DOC", ".txt", ".Pdf ", "", " печатная форма.pdf"))), (key % 6 + 1).cast("int"))
    return {
        "link_cards": orders.select(card.alias("card_id")),
        "card_main_info": orders.select(card.alias("instance_id"), F.when(F.col("o_orderstatus") == "O", 0).when(F.col("o_orderstatus") == "F", 1).alias("uploaded"), F.col("o_orderdate").alias("made_at")),
        "doc_sys": orders.select(card.alias("instance_id"), F.when(F.col("o_orderkey") % 3 == 0, "KIND-A").otherwise("kind-b").alias("Kind")),
        "doc_files": lines.select(F.col("l_orderkey").cast("string").alias("instance_id"), version.alias("version_id")),
        "v_files": lines.select(version.alias("instance_id"), F.col("l_partkey").cast("string").alias("file_id")),
        "files": part.select(key.cast("string").alias("file_id"), F.concat(F.lit("part"), key.cast("string"), suffix).alias("file_name"), key.cast("string").alias("binary_id")),
    }


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.ingest_candidates(_catalog(spark, sf_dir), view(spark, sf_dir, "vearlier"), KIND, F.lit("1996-01-01 12:00:00").cast("timestamp_ntz"), lookback_days=400)


@query(ctes("vqueue", "vearlier") + f", {_CATALOG} select file_id, min(file_name) as file_name from found where file_id not in (select file_id from vearlier) group by file_id")
def ingest_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New files: a six-table chain of joins and an anti join."""
    return _candidates(spark, sf_dir)


_OLD = _CATALOG.replace("from orders)", "from orders where o_orderkey % 7 <> 0)", 1).replace("from lineitem)", "from lineitem where l_linenumber <> 2)").replace("from part)", "from part where p_partkey % 11 <> 0)")


@query(
    ctes("vqueue", "vearlier")
    + f""", before as (with {_OLD} select file_id from found), after as (with {_CATALOG} select file_id, file_name from found)
select file_id, min(file_name) as file_name from after where file_id not in (select file_id from before) and file_id not in (select file_id from vearlier) group by file_id"""
)
def changed_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What new links, versions and files add to the candidates: found from the cards that they touch, those that were candidates before left out by the queue."""
    whole, at = _catalog(spark, sf_dir), F.lit("1996-01-01 12:00:00").cast("timestamp_ntz")
    number = {"link_cards": F.col("card_id").cast("long") % 7 == 0, "doc_files": F.col("version_id").endswith("/2"), "v_files": F.col("instance_id").endswith("/2"), "files": F.col("file_id").cast("long") % 11 == 0}
    is_new = {t: number.get(t, F.lit(False)) for t in whole}
    old, new = ({t: df.where(is_new[t] if fresh else ~is_new[t]) for t, df in whole.items()} for fresh in (False, True))
    queued = view(spark, sf_dir, "vearlier")
    before = catalog.ingest_candidates(old, queued, KIND, at, lookback_days=400)
    queued = queue.ingested(queued, before, now())
    return catalog.candidates_of_changes(whole, new, queued, KIND, at, lookback_days=400)


_FRESH = ctes("vqueue", "vearlier") + f", {_CATALOG}, fresh as (select file_id, min(file_name) as file_name from found where file_id not in (select file_id from vearlier) group by file_id)"


@query(
    _FRESH
    + f""" select file_id, file_name, cast(status as int) as status, cast(retry_count as int) as retry_count, created_at from vearlier
union all select file_id, file_name, 0, 0, timestamp '{NOW}' from fresh"""
)
def ingested_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The queue with the new files as tasks."""
    return queue.ingested(view(spark, sf_dir, "vearlier"), _candidates(spark, sf_dir), now()).select("file_id", "file_name", "status", "retry_count", "created_at")


@query(_FRESH + ", top as (select max(id) as top from vearlier) select (select count(*) from fresh) as n, (select top from top) + 1 as first_id, (select top from top) + (select count(*) from fresh) as last_id, (select count(*) from fresh) as ids")
def ingested_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of the new tasks: each its own, without a gap, from the largest one on."""
    earlier = view(spark, sf_dir, "vearlier")
    new = queue.ingested(earlier, _candidates(spark, sf_dir), now()).join(earlier.select("id"), "id", "left_anti")
    return new.agg(F.count("*").alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.countDistinct("id").alias("ids"))


@query(_FRESH.replace("from vearlier)", f"from vearlier where created_at >= timestamp '{NOW}' - interval 10 day)") + " select file_id, file_name from fresh")
def recent_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New files where only tasks of the look-back count as queued."""
    found = _catalog(spark, sf_dir)
    shifted = F.lit(NOW).cast("timestamp_ntz")
    years = F.lit("1996-01-01 12:00:00").cast("timestamp_ntz")
    cards = found["card_main_info"].withColumn("made_at", F.when(F.col("made_at") >= years - F.make_dt_interval(days=F.lit(400)), shifted))
    return catalog.ingest_candidates(found | {"card_main_info": cards}, view(spark, sf_dir, "vearlier"), KIND, shifted, lookback_days=10, whole_history=False)


def _claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "vqueue").where("status = 1").select("id", "claim_token", F.col("id").cast("string").alias("file_id"), "file_name")


def _binaries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = view(spark, sf_dir, "documents")
    key = F.col("doc_id").cast("string")
    stored = F.when(F.col("doc_id") % 10 == 7, F.concat(F.lit("moved-"), key)).otherwise(key)  # not where the catalog says
    return docs.select(key.alias("file_id"), key.alias("binary_id")), docs.select(stored.alias("id"), F.when(F.col("doc_id") % 5 > 0, F.encode("text", "UTF-8")).alias("data"))


_HEADERS = """ select q.id, q.claim_token, cast(q.id as string) as file_id, q.file_name, cast(case when d.doc_id % 5 > 0 then coalesce(strlen(d.text), 0) else 0 end as bigint) as size_bytes
from vqueue q join documents d on d.doc_id = q.id where q.status = 1 and d.doc_id % 10 <> 7"""


@query(ctes("vqueue") + _HEADERS)
def claim_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes and names of the claimed tasks' files."""
    return catalog.headers(_claims(spark, sf_dir), *_binaries(spark, sf_dir))


@query(ctes("vqueue") + " select q.id, sha256(d.text) as sha256 from vqueue q join documents d on d.doc_id = q.id where q.status = 1 and d.doc_id % 10 <> 7 and d.doc_id % 5 > 0")
def claimed_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bytes of the claimed tasks' files, by their digests."""
    return catalog.payloads(_claims(spark, sf_dir), *_binaries(spark, sf_dir)).where("data is not null").select("id", F.sha2("data", 256).alias("sha256"))


@query(ctes("vqueue") + f", h as ({_HEADERS}) select id, claim_token from vqueue where status = 1 and id not in (select id from h)")
def missing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claimed tasks whose file is gone."""
    claims = _claims(spark, sf_dir)
    return catalog.missing_sources(claims, catalog.headers(claims, *_binaries(spark, sf_dir))).select("id", "claim_token")


@query(ctes("vqueue") + f" select id, date_diff('second', created_at, timestamp '{NOW}') as waits, date_diff('second', created_at, updated_at) as took from vqueue")
def task_ages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second boundaries since each task was made, and up to its last change."""
    return view(spark, sf_dir, "vqueue").select("id", seconds_between(F.col("created_at"), now()).alias("waits"), seconds_between(F.col("created_at"), F.col("updated_at")).alias("took"))


@query(ctes("vqueue") + " select id, coalesce(parsed_text, concat('parsed ', cast(id as string))) as text from vqueue where status = 1")
def cached_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of the claimed tasks: the cache where an earlier try left one, extraction for the others alone."""
    from docloom.operators.extract import with_cache

    tasks = view(spark, sf_dir, "vqueue")
    extract = lambda rows: rows.select("id", F.concat(F.lit("parsed "), F.col("id").cast("string")).alias("text"))
    return with_cache(tasks.where("status = 1").select("id"), tasks.select("id", "parsed_text"), extract)
