"""Calls to services in waves, so that what one wave shows governs the next.

A wave is a Spark job of at most so many calls for each slot; no more run at once than there are slots (partitions). Its
answers are judged and appended as part of the job, so no call is made twice. Between waves the driver knows a few numbers
only: failures in a row, until when the breaker or a server's penalty holds, the time. While the breaker holds, the rest
of an attempt ends without a call; a request that has waited too long for its wave ends for want of a slot; what may be
tried again waits for `backoff` times the attempt, without holding a slot.
"""

from __future__ import annotations

import itertools
import time
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.sources.scratch import fresh_path

ANSWERS = "id long, target string, http_status int, body string, elapsed_ms long"


class Client(Protocol):
    def ask(self, target: str, request: str) -> tuple[int, str | None, int]:
        """(HTTP status, 0 if the connection failed; body; milliseconds)."""


class Pace(Protocol):
    """The time in milliseconds, and waiting. `passed` is told how long a wave's slowest call took."""

    def now(self) -> int: ...

    def sleep(self, ms: int) -> None: ...

    def passed(self, ms: int) -> None: ...


class Wall:
    """The machine's own clock, from its making on."""

    def __init__(self) -> None:
        self.begun = time.monotonic()

    def now(self) -> int:
        return int((time.monotonic() - self.begun) * 1000)

    def sleep(self, ms: int) -> None:
        time.sleep(ms / 1000)

    def passed(self, ms: int) -> None:
        pass


class Stepped(Wall):
    """A clock that goes on only by what it is told, for replays and tests."""

    def __init__(self) -> None:
        self.at = 0

    def now(self) -> int:
        return self.at

    def sleep(self, ms: int) -> None:
        self.at += ms

    passed = sleep


@dataclass(frozen=True)
class Limits:
    """Deployed values. `per_slot`: calls of a slot in one wave; None: all in one wave."""

    at_once: int = 6
    per_slot: int | None = 1
    slot_wait_ms: int = 120_000
    backoff_ms: int = 2000
    failures: int = 3
    pause_ms: int = 60_000
    in_flight: int = 4
    cooldown_ms: int = 30_000

    def wave(self, slots: int) -> int | None:
        return None if self.per_slot is None else max(1, slots * self.per_slot)


@dataclass
class Breaker:
    """Failures in a row and until when they hold calls back."""

    limits: Limits
    failures: int = 0
    until: int = -1

    def seen(self, answers: DataFrame, now: int) -> None:
        """Takes a wave's answers (ok, elapsed_ms, id) in the order in which they came."""
        at = F.struct("elapsed_ms", "id")
        last = answers.agg(F.max(F.when(F.col("ok"), at)).alias("last")).first().last
        bad = answers.where(~F.col("ok"))
        if last is not None:
            self.failures = 0
            bad = bad.where((F.col("elapsed_ms") > last.elapsed_ms) | ((F.col("elapsed_ms") == last.elapsed_ms) & (F.col("id") > last.id)))
        self.failed(bad.count(), now, cleared=last is not None)

    def failed(self, n: int, now: int, cleared: bool = False) -> None:
        self.failures += n
        if n and self.failures >= self.limits.failures:
            self.until = now + self.limits.pause_ms
        elif cleared:
            self.until = -1


def numbered(rows: DataFrame) -> tuple[DataFrame, int]:
    """(rows with their number `nth` in the order of ids from 0 on, how many they are), written by ranges of ids, so no task orders all. The driver gets a count for each range."""
    spark, path = rows.sparkSession, fresh_path(rows.sparkSession, "numbered")
    parts = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "id").withColumn("part", F.spark_partition_id())
    parts.write.parquet(path)
    parts = spark.read.schema(parts.schema).parquet(path)
    sizes = sorted((r.part, r.n) for r in parts.groupBy("part").agg(F.count("*").alias("n")).collect())
    *before, count = itertools.accumulate((n for _, n in sizes), initial=0)
    table = spark.createDataFrame([(p, b) for (p, _), b in zip(sizes, before, strict=True)], "part int, before long")
    nth = F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy("id")) - 1
    return parts.join(F.broadcast(table), "part").select(*rows.columns, nth.alias("nth")), count


def dealt(requests: DataFrame, wave: int | None) -> tuple[DataFrame, int]:
    """(requests with `wave`, number of waves), written by wave; waves follow the order of ids."""
    spark, path = requests.sparkSession, fresh_path(requests.sparkSession, "requests")
    waves, rows = 1, requests.withColumn("wave", F.lit(0))
    if wave is not None:
        placed, count = numbered(requests)
        waves = max(1, -(-count // wave))
        rows = placed.withColumn("wave", F.floor(F.col("nth") / wave).cast("int")).drop("nth")
    rows.write.partitionBy("wave").parquet(path)
    return spark.read.schema(rows.schema).parquet(path), waves


def asked(requests: DataFrame, client: Client) -> DataFrame:
    """ANSWERS of requests (id, target, request), a partition's one after the other. A plan: each run of it calls."""
    types = pa.schema([("id", pa.int64()), ("target", pa.string()), ("http_status", pa.int32()), ("body", pa.string()), ("elapsed_ms", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [client.ask(t, r) for t, r in zip(batch.column("target").to_pylist(), batch.column("request").to_pylist(), strict=True)]
            columns = [pa.array(x, t) for x, t in zip(zip(*got, strict=True), list(types.types)[2:], strict=True)] if got else [pa.array([], t) for t in list(types.types)[2:]]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("target"), *columns], schema=types)

    return requests.select("id", "target", "request").mapInArrow(run, ANSWERS)


@dataclass
class Answers:
    """Judged answers, appended wave by wave: (id, target, attempt, wave, at_ms, elapsed_ms, ok, *judged)."""

    empty: DataFrame
    path: str = field(init=False)

    def __post_init__(self) -> None:
        self.path = fresh_path(self.empty.sparkSession, "answers")
        self.empty.write.parquet(self.path)

    def add(self, rows: DataFrame) -> None:
        names = {f.name: f.dataType for f in self.empty.schema.fields}
        rows.select(*[F.col(n).cast(t) if n in rows.columns else F.lit(None).cast(t).alias(n) for n, t in names.items()]).write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        return self.empty.sparkSession.read.schema(self.empty.schema).parquet(self.path)

    def of(self, attempt: int, wave: int) -> DataFrame:
        return self.read().where((F.col("attempt") == attempt) & (F.col("wave") == wave))


def model_calls(requests: DataFrame, client: Client, judged: dict[str, Column], schema: str, limits: Limits, tries: int, pace: Pace, failures: int = 0) -> DataFrame:
    """All attempts of requests (id, request), judged by expressions over ANSWERS: `outcome` (transient ones are tried again), `ok` for the breaker, and others.

    Attempts that made no call have the outcome `paused` or `no_slot` and no answer.
    """
    spark, breaker = requests.sparkSession, Breaker(limits, failures)
    answers = Answers(spark.createDataFrame([], f"id long, target string, attempt int, wave int, at_ms long, elapsed_ms long, {schema}"))
    left = requests.select("id", F.lit("chat").alias("target"), "request")
    for attempt in range(1, tries + 1):
        rows, waves = dealt(left, limits.wave(limits.at_once))
        begun = pace.now()
        for wave in range(waves):
            mine, now = rows.where(F.col("wave") == wave), pace.now()
            marks = {"attempt": F.lit(attempt), "at_ms": F.lit(now)}
            if now < breaker.until:
                answers.add(rows.where(F.col("wave") >= wave).withColumns(marks | {"outcome": F.lit("paused")}))
                break
            if now - begun > limits.slot_wait_ms:
                answers.add(mine.withColumns(marks | {"outcome": F.lit("no_slot"), "ok": F.lit(False)}))
                breaker.failed(mine.count(), now)
                continue
            got = asked(mine.repartition(limits.at_once, "id"), client)
            answers.add(got.withColumns(judged).withColumns(marks | {"wave": F.lit(wave)}))
            here = answers.of(attempt, wave)
            pace.passed(here.agg(F.max("elapsed_ms")).first()[0] or 0)
            breaker.seen(here.select("id", "ok", "elapsed_ms"), pace.now())
        again = answers.read().where((F.col("attempt") == attempt) & F.col("outcome").isin("transient", "paused", "no_slot")).select("id")
        if attempt == tries or again.isEmpty():
            break
        left = left.join(again, "id", "left_semi")
        pace.sleep(limits.backoff_ms * attempt)
    return answers.read()


def server_calls(requests: DataFrame, servers: list[str], client: Client, judged: dict[str, Column], schema: str, limits: Limits, tries: int, pace: Pace, down: tuple[str, ...] = (), cursor: int = 0, settled: tuple[str, ...] = (), punished: tuple[str, ...] = ()) -> tuple[DataFrame, tuple[str, ...]]:
    """(all attempts, servers that may not be asked at the end) of requests (id, request), each asking one server after the other.

    The wave's requests are dealt to the servers that aren't penalised, in rotation from `cursor` on, and no server has
    more than `in_flight` of them at once: its requests lie in as many partitions. An outcome in `punished` keeps a server
    out for the cooldown, one in `settled` ends a request, any other sends it to another server.
    """
    spark, slots = requests.sparkSession, limits.in_flight or limits.at_once
    answers = Answers(spark.createDataFrame([], f"id long, target string, attempt int, wave int, at_ms long, elapsed_ms long, {schema}"))
    until = dict.fromkeys(down, 1 << 62)
    rows, waves = dealt(requests.select("id", "request", F.xxhash64("id").alias("place")), limits.wave(min(limits.at_once, slots * len(servers))))
    for wave in range(waves):
        left = rows.where(F.col("wave") == wave)
        for attempt in range(1, tries + 1):
            now = pace.now()
            order = [s for s in servers if until.get(s, -1) <= now]
            if not order:
                break
            turn = F.pmod(F.col("place") + cursor + attempt - 1, F.lit(len(order)))
            placed = left.withColumns({"target": F.element_at(F.array(*map(F.lit, order)), (turn + 1).cast("int")), "slot": (turn * slots + F.pmod(F.xxhash64("id", F.lit(attempt)), F.lit(slots))).cast("int")})
            got = asked(placed.repartitionById(len(order) * slots, "slot"), client)
            answers.add(got.withColumns(judged).withColumns({"attempt": F.lit(attempt), "wave": F.lit(wave), "at_ms": F.lit(now)}))
            here = answers.of(attempt, wave)
            pace.passed(here.agg(F.max("elapsed_ms")).first()[0] or 0)
            failed = here.where(F.col("outcome").isin(*punished)).select("target").distinct().collect()  # no more than there are servers
            until |= {r.target: max(until.get(r.target, -1), pace.now() + limits.cooldown_ms) for r in failed}
            again = here.where(~F.col("outcome").isin(*settled)).select("id")
            if again.isEmpty():
                break
            left = left.join(again, "id", "left_semi")
    return answers.read(), tuple(s for s in servers if until.get(s, -1) > pace.now())
