"""The task queue as pure transitions: each function takes the queue and what happened, and returns the queue after it.

A queue is a table of `schema.QUEUE`; `now` is always given, never read from a clock, so that every step can be
repeated. An owner's outcome counts only while its lease holds: id, owner and claim token must all match, else the row
stays as it is. A queue lives as a log of changes with many writers (`sources.changelog`), or as snapshots with one
(`sources.snapshots`). Functions named `..._rows` return only the rows that change.
"""

from __future__ import annotations

import os
import socket
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions.text import short_error, size_route, truncated
from docloom.schema import DONE, EMPTY_MESSAGE, ERROR, MISSING_MESSAGE, NEW, PROCESSING, TERMINAL_RETRIES, Settings

EPOCH_2000 = 946_684_800
#: Outcomes by which an owner hands a task back, in the order that decides between two of one task.
OUTCOMES = ("done", "empty", "rejected", "failed", "transient", "missing", "heartbeat")


def owner_name() -> str:
    """host/process/random: made once on the driver."""
    return f"{socket.gethostname()}/{os.getpid()}/{uuid.uuid4().hex[:8]}"


def new_token() -> str:
    """One token for a whole batch, made once on the driver: a column function would give each row its own, and again on a retry."""
    return str(uuid.uuid4())


def eligible(now: Column, cfg: Settings = Settings()) -> Column:
    """Whether a task can be claimed: new and due, leased too long, or failed with retries left."""
    before = lambda c, s: F.col(c) < now - F.make_dt_interval(secs=F.lit(s))
    fresh = (F.col("status") == NEW) & (F.col("next_attempt_at").isNull() | (F.col("next_attempt_at") <= now))
    stale = (F.col("status") == PROCESSING) & before("locked_at", cfg.stale_seconds)
    again = (F.col("status") == ERROR) & (F.col("retry_count") < cfg.max_retries) & before("updated_at", cfg.retry_delay_seconds)
    return F.coalesce(fresh | stale | again, F.lit(False))


def claim_order() -> list[Column]:
    """Stale leases first, then new tasks, both latest first; retries last and oldest first, by whole seconds."""
    rank = F.when(F.col("status") == PROCESSING, 0).when(F.col("status") == NEW, 1).otherwise(2)
    age = F.when(F.col("status") == ERROR, F.unix_seconds(F.col("created_at").cast("timestamp")) - EPOCH_2000).otherwise(0)
    return [rank.asc(), age.asc(), F.col("created_at").desc(), F.col("id").asc()]


def claim(queue: DataFrame, now: Column, limit: int | None, cfg: Settings = Settings()) -> DataFrame:
    """The next `limit` tasks: a distributed top-k, not a sort of the queue; without a limit all that can be claimed, a filter."""
    able = queue.where(eligible(now, cfg))
    return able if limit is None else able.orderBy(*claim_order()).limit(limit)


def leased(queue: DataFrame, picked: DataFrame, owner: str, token: str, now: Column) -> DataFrame:
    """The queue with the picked tasks leased to an owner under one token."""
    mine = picked.select("id", F.lit(True).alias("mine"))
    hit = F.coalesce(F.col("mine"), F.lit(False))
    changed = queue.join(mine, "id", "left")
    return changed.withColumns(
        {
            "status": F.when(hit, F.lit(PROCESSING)).otherwise(F.col("status")),
            "locked_by": F.when(hit, F.lit(owner)).otherwise(F.col("locked_by")),
            "locked_at": F.when(hit, now).otherwise(F.col("locked_at")),
            "claim_token": F.when(hit, F.lit(token)).otherwise(F.col("claim_token")),
        }
    ).select(*queue.columns)


def settled(queue: DataFrame, outcomes: DataFrame, now: Column) -> DataFrame:
    """The queue after outcomes (`schema.OUTCOMES`), in one join whatever their kinds.

    Two outcomes of one lease count once, the earlier in OUTCOMES. `missing` and all others need the owner's lease;
    `heartbeat` only renews it.
    """
    place = F.array_position(F.array(*[F.lit(o) for o in OUTCOMES]), F.col("outcome"))
    names = ["outcome", "error", "delay_seconds"]
    one = outcomes.where(place > 0).groupBy("id", "locked_by", "claim_token").agg(F.min_by(F.struct(*names), place).alias("did"))
    one = one.select(F.col("id").alias("o_id"), F.col("locked_by").alias("o_by"), F.col("claim_token").alias("o_token"), "did")
    rows = queue.join(one, (F.col("id") == F.col("o_id")) & (F.col("locked_by") == F.col("o_by")) & (F.col("claim_token") == F.col("o_token")), "left")
    did = F.when((F.col("did.outcome") != "heartbeat") | (F.col("status") == PROCESSING), F.col("did.outcome"))
    rows = rows.withColumn("o", did)
    is_ = lambda *names: F.col("o").isin(*names)
    freed = is_(*OUTCOMES[:-1])
    own = lambda c: F.col(c)
    return rows.withColumns(
        {
            "status": F.when(is_("done"), DONE).when(is_("transient"), NEW).when(freed, ERROR).otherwise(own("status")),
            "error_message": F.when(is_("done"), F.lit(None)).when(is_("failed"), truncated(F.coalesce("did.error", F.lit("")), 2000)).when(is_("rejected"), short_error(F.col("did.error")))
            .when(is_("empty"), F.lit(EMPTY_MESSAGE)).when(is_("missing"), F.lit(MISSING_MESSAGE)).otherwise(own("error_message")),
            "retry_count": F.when(is_("failed", "missing"), own("retry_count") + 1).when(is_("empty", "rejected"), TERMINAL_RETRIES).otherwise(own("retry_count")),
            "next_attempt_at": F.when(is_("transient"), now + F.make_dt_interval(secs=F.coalesce("did.delay_seconds", F.lit(0)))).otherwise(own("next_attempt_at")),
            "parsed_text": F.when(is_("done", "empty", "rejected"), F.lit(None)).otherwise(own("parsed_text")),
            "locked_by": F.when(freed, F.lit(None)).otherwise(own("locked_by")),
            "locked_at": F.when(freed, F.lit(None)).when(is_("heartbeat"), now).otherwise(own("locked_at")),
            "claim_token": F.when(freed, F.lit(None)).otherwise(own("claim_token")),
            "updated_at": F.when(freed, now).otherwise(own("updated_at")),
        }
    ).select(*queue.columns)


def claimed_rows(queue: DataFrame, owner: str, token: str, now: Column, limit: int | None, cfg: Settings = Settings()) -> DataFrame:
    """The rows that a claim changes: the next `limit` tasks, leased. For tables that are written by their changes."""
    picked = claim(queue, now, limit, cfg)
    return leased(picked, picked, owner, token, now)


def settled_rows(queue: DataFrame, outcomes: DataFrame, now: Column) -> DataFrame:
    """The rows that outcomes can change, settled."""
    return settled(queue.join(outcomes.select("id").distinct(), "id", "left_semi"), outcomes, now)


def renewed_rows(queue: DataFrame, owner: str, now: Column) -> DataFrame:
    """The leases of an owner, renewed."""
    return queue.where((F.col("status") == PROCESSING) & (F.col("locked_by") == owner)).withColumn("locked_at", now.cast("timestamp"))


def slots(queue: DataFrame, heads: DataFrame, now: Column, cfg: Settings = Settings()) -> DataFrame:
    """(locked_by, light, heavy, free_light, free_heavy) of each owner with leases that still hold.

    `heads` (id, size_bytes) tells large files, which have slots of their own; a lease without a size is light.
    """
    live = queue.where((F.col("status") == PROCESSING) & (F.col("locked_at") >= now - F.make_dt_interval(secs=F.lit(cfg.stale_seconds)))).select("id", "locked_by")
    sized = live.join(heads.select("id", size_route(F.col("size_bytes"), cfg.heavy_mb).alias("route")), "id", "left")
    heavy = F.coalesce(F.col("route") == "heavy", F.lit(False))
    held = sized.groupBy("locked_by").agg(F.count_if(~heavy).alias("light"), F.count_if(heavy).alias("heavy"))
    free = lambda most, used: F.greatest(F.lit(0).cast("long"), F.lit(most) - F.col(used))
    return held.withColumns({"free_light": free(cfg.slots, "light"), "free_heavy": free(cfg.heavy_batch, "heavy")})


def free_slots(queue: DataFrame, heads: DataFrame, owner: str, now: Column, cfg: Settings = Settings()) -> tuple[int, int]:
    """(light, heavy) slots that an owner has free: what its next claim may take."""
    row = slots(queue.where(F.col("locked_by") == owner), heads, now, cfg).first()
    return (row.free_light, row.free_heavy) if row else (cfg.slots, cfg.heavy_batch)


def new_tasks(queue: DataFrame, candidates: DataFrame, now: Column) -> DataFrame:
    """Candidates (file_id, file_name) that aren't queued as new tasks, one for each file id. Ids go on from the largest."""
    known = queue.select("file_id").distinct()
    fresh = candidates.where("file_id is not null").groupBy("file_id").agg(F.min("file_name").alias("file_name")).join(known, "file_id", "left_anti")
    blank = {f.name: F.lit(None).cast(f.dataType) for f in queue.schema.fields}
    # ids without one global window: consecutive within a partition of file ids, partitions one after the other
    parts = fresh.withColumn("part", F.pmod(F.xxhash64("file_id"), F.lit(1024)))
    sizes = parts.groupBy("part").agg(F.count("*").alias("n"))
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    top = queue.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top"))
    rank = F.row_number().over(Window.partitionBy("part").orderBy("file_id"))
    rows = parts.withColumn("rank", rank).join(F.broadcast(before), "part").crossJoin(F.broadcast(top))  # 1024 rows and one row
    new = blank | {"id": F.col("top") + F.col("before") + F.col("rank"), "file_id": F.col("file_id"), "file_name": F.col("file_name"), "status": F.lit(NEW), "retry_count": F.lit(0), "created_at": now}
    return rows.select(*[new[c].cast(queue.schema[c].dataType).alias(c) for c in queue.columns])


def ingested(queue: DataFrame, candidates: DataFrame, now: Column) -> DataFrame:
    """The queue with candidates added as `new_tasks`."""
    return queue.unionByName(new_tasks(queue, candidates, now))


def new_results(queue: DataFrame, outcomes: DataFrame, now: Column) -> DataFrame:
    """The results of the outcomes `done` whose lease holds in the queue before them."""
    done = outcomes.where("outcome = 'done'").groupBy("id", "locked_by", "claim_token").agg(F.min("xml_data").alias("xml_data"))
    return queue.join(done, ["id", "locked_by", "claim_token"]).select(F.col("id").alias("doc_id"), "file_id", "file_name", "xml_data", F.col("locked_by").alias("created_by"), now.alias("created_at"))


def with_results(results: DataFrame, queue: DataFrame, outcomes: DataFrame, now: Column) -> DataFrame:
    """The results after `new_results`: each replaces its document's earlier result."""
    new = new_results(queue, outcomes, now)
    return results.join(new.select("doc_id"), "doc_id", "left_anti").select(*new.columns).unionByName(new)


def latest_results(results: DataFrame) -> DataFrame:
    """One row for each document of results that were only appended: the latest, of equally late ones the greatest."""
    rest = [c for c in results.columns if c not in ("doc_id", "created_at")]
    last = results.groupBy("doc_id").agg(F.max(F.struct("created_at", *rest)).alias("last"))
    return last.select("doc_id", "last.*").select(*results.columns)


def due(queue: DataFrame, now: Column, cfg: Settings = Settings()) -> DataFrame:
    """Tasks by what they wait for: claimable, scheduled, leased, exhausted, done."""
    state = (
        F.when(eligible(now, cfg), "claimable").when(F.col("status") == DONE, "done").when(F.col("status") == PROCESSING, "leased").when(F.col("status") == NEW, "scheduled")
        .when(F.col("retry_count") >= cfg.max_retries, "exhausted").otherwise("cooling")
    )
    return queue.groupBy(state.alias("state")).agg(F.count("*").alias("n"))
