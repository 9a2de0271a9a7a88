"""Continuous operation: micro-batches that carry the same transitions as batch jobs into the next version of the tables.

A queue is a `ChangeLog`, which many instances write at once and whose ticks write the rows that change, or `Snapshots`,
which one instance writes whole. A micro-batch that is run again after a failure finds its mark and changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from docloom.operators import metrics, queue
from docloom.plans.pipeline import History, Services, run_round
from docloom.schema import ATTEMPTS, ERROR, MODEL_CALLS, NEW, PROCESSING, RESULTS, SERVER_EVENTS, TERMINAL_RETRIES, Settings
from docloom.sources import catalog
from docloom.sources.changelog import ChangeLog, Journal
from docloom.sources.scratch import kept
from docloom.sources.snapshots import Snapshots
from docloom.streaming.policies import Policies

#: How far journals were read.
MARKS = "name string, version long"
#: A micro-batch's time as a column; fixed by the caller in tests.
Clock = Callable[[DataFrame], Column]


def clock(_: DataFrame) -> Column:
    return F.current_timestamp()


def changed(tasks: ChangeLog | Snapshots, mark: str, rows: Callable[[DataFrame], DataFrame], whole: Callable[[DataFrame], DataFrame]) -> None:
    """The next version of a queue: from the rows that change where it is a log of changes, else from all of it."""
    if isinstance(tasks, ChangeLog):
        tasks.change(rows, mark)
    elif not tasks.has(mark):
        tasks.write(whole(tasks.read()), mark)


def ingest(candidates: DataFrame, tasks: ChangeLog | Snapshots, name: str = "ingest", at: Clock = clock, histories: Histories | None = None) -> DataStreamWriter:
    """New files (file_id, file_name) become tasks; one that is queued already, or comes twice, does not. On a log of changes, `histories` count them."""

    def step(batch: DataFrame, number: int) -> None:
        changed(tasks, f"{name}/{number}", lambda q: queue.new_tasks(q, batch, at(batch)), lambda q: queue.ingested(q, batch, at(batch)))
        if histories and isinstance(tasks, ChangeLog):
            added = sum(x[2] for x in tasks.state().deltas if x[3] == f"{name}/{number}")
            counted = tasks.spark.createDataFrame([(added,)], "n long").withColumn("ts", at(batch).cast("timestamp"))
            histories.rollups.append(metrics.rolled(metrics.ingest_samples(counted)), f"{name}/{number}")

    return candidates.writeStream.foreachBatch(step).queryName(name)


def ingest_changes(ticks: DataFrame, changes: dict[str, Journal], tasks: ChangeLog, marks: ChangeLog, kind: str, cfg: Settings = Settings(), name: str = "catalog", at: Clock = clock) -> DataStreamWriter:
    """At each tick, the files that rows added to the catalog's journals since the last one make candidates become tasks.

    `marks` (schema MARKS) keeps how far each journal was read. It moves after the tasks are there; rows that are read
    again add nothing, as their files are queued.
    """

    def step(batch: DataFrame, number: int) -> None:
        now, seen = at(batch), {r.name: r.version for r in marks.read().collect()}  # a row for each table
        new = {t: j.since(seen.get(t, 0)) for t, j in changes.items()}
        if all(version == seen.get(t, 0) for t, (version, _) in new.items()):
            return
        catalog_now = {t: j.read(new[t][0]) for t, j in changes.items()}
        rows = {t: added for t, (_, added) in new.items()}
        tasks.change(lambda q: queue.new_tasks(q, catalog.candidates_of_changes(catalog_now, rows, q, kind, now, cfg.lookback_days), now))
        marks.change(lambda _: tasks.spark.createDataFrame([(t, version) for t, (version, _) in new.items()], MARKS))

    return ticks.writeStream.foreachBatch(step).queryName(name)


def settle(outcomes: DataFrame, tasks: ChangeLog | Snapshots, results: Snapshots | Journal, name: str = "settle", at: Clock = clock) -> DataStreamWriter:
    """Outcomes of workers settle their tasks; results are written first, so that a task is done only once its result is there."""

    def step(batch: DataFrame, number: int) -> None:
        mark = f"{name}/{number}"
        if tasks.has(mark):
            return
        before, when = tasks.read(), at(batch)
        if isinstance(results, Journal):
            results.append(queue.new_results(before, batch, when), mark)
        elif not results.has(mark):
            results.write(queue.with_results(results.read(), before, batch, when), mark)
        changed(tasks, mark, lambda q: queue.settled_rows(q, batch, when), lambda q: queue.settled(q, batch, when))

    return outcomes.writeStream.foreachBatch(step).queryName(name)


class Histories:
    """The history of rounds at a path, as journals, and with `states` where everything stands after it, so that a round reads what is new instead of all."""

    def __init__(self, spark: SparkSession, path: str, states: bool = False):
        self.spark = spark
        self.journals = {name: Journal(spark, f"{path}/{name}", ddl) for name, ddl in (("attempts", ATTEMPTS), ("events", SERVER_EVENTS), ("calls", MODEL_CALLS))}
        self.rollups = Journal(spark, f"{path}/rollups", metrics.ROLLUP)
        self.states = Policies(spark, f"{path}/states") if states else None

    def read(self) -> History:
        """All of the history."""
        return History(**{name: j.read() for name, j in self.journals.items()})

    def judging(self, cfg: Settings = Settings()) -> History:
        """What a round judges by: the states, brought up to date, or all of the history."""
        if not self.states:
            return self.read()
        self.states.catch_up(*self.journals.values(), cfg)
        return replace(History.empty(self.spark), standing=self.states.standing())

    def append(self, seen: History, mark: str) -> None:
        for name, j in self.journals.items():
            j.append(getattr(seen, name), mark)
        if seen.samples is not None:
            self.rollups.append(metrics.rolled(seen.samples), mark)


def poll(ticks: DataFrame, tasks: ChangeLog | Snapshots, results: Snapshots | Journal, files: DataFrame, binaries: DataFrame, services: Services, owner: str, cfg: Settings = Settings(), paused: Callable[[], bool] = lambda: False, name: str = "poll", at: Clock = clock, histories: Histories | None = None, texts: Journal | None = None) -> DataStreamWriter:
    """A round of processing at each tick of a stream (such as the rate source), unless the caller or the model's breaker pauses it.

    The tick's number makes the claim token, so a repeated tick claims under the same one. With `histories`, each round is
    judged by those before it and leaves what it saw there. With a journal for `results` a round writes the results it
    adds only (`queue.latest_results` reads them), and with one of `schema.TEXTS` the queue carries no texts, so that a
    tick writes its batch and the queue's narrow columns.

    On a log of changes a tick commits its claim first, of no more tasks than the owner has slots free, and its outcomes
    when the round is over; other instances claim and settle between the two.
    """

    def step(batch: DataFrame, number: int) -> None:
        many = isinstance(tasks, ChangeLog)
        mark, now = f"{name}/{owner}/{number}" if many else f"{name}/{number}", at(batch)
        token = f"{owner}/{mark}"
        if paused() or tasks.has(mark):
            return
        history = histories.judging(cfg) if histories else None
        if history and services.llm and history.model_paused(now, cfg):
            return
        leases = heavy = None
        if many:
            claim(tasks, owner, token, cfg.batch, now, cfg, files, binaries, f"claim/{mark}")
            leases = kept(leased_under(tasks.read(), owner, token), "leases")
            others = tasks.read().where((F.col("locked_by") == owner) & (F.col("claim_token") != token))
            heavy = queue.free_slots(others, catalog.headers(others, files, binaries), owner, now, cfg)[1]
        earlier = tasks.spark.createDataFrame([], RESULTS) if isinstance(results, Journal) else results.read()  # what is only added to isn't read
        done = run_round(leases if many else tasks.read(), earlier, files, binaries, services, owner, token, now, cfg, history, texts.read() if texts else None, leases, heavy)
        if isinstance(results, Journal):
            results.append(done.added, mark)
        elif not results.has(mark):
            results.write(done.results, mark)
        if texts and not texts.has(mark):
            texts.append(done.texts, mark)
        if histories:
            histories.append(done.seen, mark)
        if many:  # rows whose lease was lost meanwhile stay as they are: the outcomes are fenced
            tasks.change(lambda q: with_texts(queue.settled_rows(q, done.outcomes, now), done.queue), mark)
        else:
            tasks.write(done.queue, mark)

    return ticks.writeStream.foreachBatch(step).queryName(name)


def with_texts(rows: DataFrame, round_queue: DataFrame) -> DataFrame:
    """Settled rows with the texts that the round read for tasks that are tried again."""
    read = round_queue.where("parsed_text is not null").select("id", F.col("parsed_text").alias("read_now"))
    open_ = F.col("status").isin(NEW, ERROR) & (F.col("retry_count") < TERMINAL_RETRIES)
    return rows.join(read, "id", "left").withColumn("parsed_text", F.coalesce("parsed_text", F.when(open_, F.col("read_now")))).select(*rows.columns)


def heartbeat(ticks: DataFrame, tasks: ChangeLog | Snapshots, owner: str, name: str = "heartbeat", at: Clock = clock) -> DataStreamWriter:
    """At each tick, the leases that an owner holds are renewed."""

    def step(batch: DataFrame, number: int) -> None:
        now = at(batch)

        def whole(before: DataFrame) -> DataFrame:
            held = before.where((F.col("status") == PROCESSING) & (F.col("locked_by") == owner))
            beats = held.select("id", "locked_by", "claim_token", F.lit("heartbeat").alias("outcome"), F.lit(None).cast("string").alias("error"), F.lit(None).cast("int").alias("delay_seconds"), F.lit(None).cast("string").alias("xml_data"))
            return queue.settled(before, beats, now)

        changed(tasks, f"{name}/{owner}/{number}", lambda q: queue.renewed_rows(q, owner, now), whole)

    return ticks.writeStream.foreachBatch(step).queryName(name)


def evict(ticks: DataFrame, histories: Histories, cfg: Settings = Settings(), name: str = "evict", at: Clock = clock) -> DataStreamWriter:
    """At each tick, streaks that have been idle for too long end."""

    def step(batch: DataFrame, number: int) -> None:
        if histories.states:
            histories.states.evict(at(batch), cfg)

    return ticks.writeStream.foreachBatch(step).queryName(name)


def probe(ticks: DataFrame, servers: tuple[str, ...], events: Journal, alive: Callable[[str], bool], name: str = "probe", at: Clock = clock) -> DataStreamWriter:
    """At each tick, every OCR server is asked for a sign of life: `green` clears a transport penalty, none sets one."""

    def step(batch: DataFrame, number: int) -> None:
        found = [(s, k, "green" if alive(s) else "transport") for k, s in enumerate(servers)]
        rows = events.spark.createDataFrame(found, "server string, seq long, event string").withColumn("ts", at(batch).cast("timestamp"))
        events.append(rows, f"{name}/{number}")

    return ticks.writeStream.foreachBatch(step).queryName(name)


def report(ticks: DataFrame, tasks: Snapshots, histories: Histories, servers: tuple[str, ...], path: str, cfg: Settings = Settings(), name: str = "report", at: Clock = clock) -> DataStreamWriter:
    """At each tick, the metric catalogue as lines of text in a folder of its number."""

    def step(batch: DataFrame, number: int) -> None:
        history = histories.read()
        found = metrics.catalogue(tasks.read(), histories.rollups.read(), history.events, history.calls, servers, at(batch), cfg)
        metrics.exposition(found).coalesce(1).write.mode("overwrite").text(f"{path}/{name}-{number}")  # a line for each metric, whatever the queue's size

    return ticks.writeStream.foreachBatch(step).queryName(name)


def leased_under(tasks: DataFrame, owner: str, token: str) -> DataFrame:
    return tasks.where((F.col("claim_token") == token) & (F.col("locked_by") == owner) & (F.col("status") == PROCESSING))


def claim(tasks: ChangeLog | Snapshots, owner: str, token: str, limit: int | None, now: Column, cfg: Settings = Settings(), files: DataFrame | None = None, binaries: DataFrame | None = None, mark: str | None = None) -> DataFrame:
    """Leases the next tasks in a new version and returns them. With the catalog's tables, no more than the owner has slots free."""

    def most(q: DataFrame) -> int | None:
        if files is None or binaries is None:
            return limit
        held = q.where((F.col("status") == PROCESSING) & (F.col("locked_by") == owner))
        free = queue.free_slots(held, catalog.headers(held, files, binaries), owner, now, cfg)[0]
        return free if limit is None else min(limit, free)

    changed(tasks, mark or f"claim/{token}", lambda q: queue.claimed_rows(q, owner, token, now, most(q), cfg), lambda q: queue.leased(q, queue.claim(q, now, most(q), cfg), owner, token, now))
    return leased_under(tasks.read(), owner, token)
