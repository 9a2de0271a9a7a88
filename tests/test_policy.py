from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from docloom.operators import metrics, policy
from docloom.schema import ATTEMPTS
from docloom.streaming import state

T0 = datetime(2024, 1, 1)
DOC, INFRA = "x IsSuccess=false", "connection reset"


def attempts(spark, kinds: list[str], alive: bool = True, step: int = 60):
    rows, names = [], {"doc": ("transient", DOC), "infra": ("transient", INFRA)}
    for k, kind in enumerate(kinds):
        outcome, error = names.get(kind, (kind, None))
        rows.append((1, T0 + timedelta(seconds=k * step), k, outcome, error, "i"))
        if alive:
            rows.append((2, T0 + timedelta(seconds=k * step - 1), k, "done", None, "i"))
    return spark.createDataFrame(rows, ATTEMPTS)


@pytest.mark.parametrize(
    ("kinds", "alive", "poison", "any_"),
    [
        (["doc", "doc", "infra", "doc", "doc", "doc"], True, [1, 2, 0, 1, 2, 3], [1, 2, 3, 4, 5, 6]),
        (["infra"] * 10, True, [0] * 10, list(range(1, 11))),
        (["infra"] * 5, False, [0] * 5, [0] * 5),
        (["doc", "doc", "failed", "doc"], True, [1, 2, 3], [1, 2, 3]),
        (["doc", "doc", "done", "doc"], True, [1, 2, 1], [1, 2, 1]),
        (["doc", "doc", "rejected", "doc"], True, [1, 2, 1], [1, 2, 1]),
    ],
)
def test_streaks_batch_and_stream(spark, tmp_path, kinds, alive, poison, any_):
    log = attempts(spark, kinds, alive)
    batch = policy.streaks(log).where("task_id = 1").orderBy("ts", "seq").collect()
    assert [(r.poison, r.any) for r in batch] == list(zip(poison, any_, strict=True))
    with_outage = policy.outages(log)
    with_outage.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = state.streaks(spark.readStream.schema(with_outage.schema).parquet(str(tmp_path / "in")))
    name = f"streaks_{abs(hash((tuple(kinds), alive)))}"
    run = stream.writeStream.format("memory").queryName(name).trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    run.awaitTermination(120)
    got = spark.table(name).where("task_id = 1").orderBy("ts", "seq").collect()
    assert [(r.poison, r.any) for r in got] == [(r.poison, r.any) for r in batch]


def test_verdicts(spark):
    poison = policy.verdicts(policy.streaks(attempts(spark, ["doc"] * 3))).where("task_id = 1").orderBy("seq").collect()
    assert [r.verdict for r in poison] == ["transient", "transient", "poison"]
    zombie = policy.verdicts(policy.streaks(attempts(spark, ["infra"] * 10))).where("task_id = 1").orderBy("seq").collect()
    assert zombie[-1].verdict == "zombie" and zombie[0].backoff == 60


def test_idle_streak_starts_anew(spark):
    got = policy.streaks(attempts(spark, ["doc", "doc"], step=3700)).where("task_id = 1").orderBy("seq").collect()
    assert [r.poison for r in got] == [1, 1]


def test_backoff(spark):
    got = [r.s for r in spark.range(10).select(policy.backoff_seconds(F.col("id")).alias("s")).collect()]
    assert got == [60, 60, 96, 153, 245, 393, 629, 900, 900, 900]
    rows = spark.range(500).select(policy.jittered(F.lit(153), F.col("id")).alias("s")).agg(F.min("s"), F.max("s")).first()
    assert rows[0] >= 76 and rows[1] <= 152


def test_breaker_batch_and_stream(spark, tmp_path):
    marks = [(0, False), (1, False), (2, False), (30, False), (50, True), (200, False), (201, False), (202, False), (300, False)]
    events = spark.createDataFrame([("s", T0 + timedelta(seconds=t), k, ok) for k, (t, ok) in enumerate(marks)], "server string, ts timestamp, seq long, ok boolean")
    batch = policy.breaker(events, "server").orderBy("seq").collect()
    assert [r.failures for r in batch] == [1, 2, 3, 4, 0, 1, 2, 3, 4]
    assert [r.paused for r in batch] == [False, False, False, True, True, False, False, False, False]
    events.coalesce(1).write.parquet(str(tmp_path / "in"))
    run = state.breaker(spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))).writeStream.format("memory").queryName("breaker_states").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    run.awaitTermination(120)
    got = spark.table("breaker_states").orderBy("seq").collect()
    assert [(r.failures, r.paused, r.paused_until) for r in got] == [(r.failures, r.paused, r.paused_until) for r in batch]


def test_states_carry_over_minutes(spark):
    """Long random histories, folded by minutes, against a plain fold over all events of a server."""
    import random

    rng, marks = random.Random(4), []
    for server in ("a", "b", None):
        t = 0
        for k in range(300):
            t += rng.choice([0, 1, 20, 70, 400])
            marks.append((server, T0 + timedelta(seconds=t), k, rng.random() < 0.3, rng.choice(["transport", "green", "refusal", "success"])))
    frame = spark.createDataFrame(marks, "server string, ts timestamp, seq long, ok boolean, event string")
    state, expected = {}, {}
    for server, ts, seq, ok, event in marks:
        failures, until, transport, logical = state.get(server, (0, None, None, None))
        paused, failures = until is not None and ts < until, 0 if ok else failures + 1
        until = ts + timedelta(seconds=60) if failures >= 3 else None
        later = ts + timedelta(seconds=30)
        transport = later if event == "transport" else None if event == "green" else transport
        logical = later if event == "refusal" else logical
        state[server] = failures, until, transport, logical
        expected[server, seq] = (failures, until, paused), (transport, logical, not any(u is not None and ts < u for u in (transport, logical)))
    got = {(r.server, r.seq): (r.failures, r.paused_until, r.paused) for r in policy.breaker(frame.drop("event"), "server").collect()}
    assert got == {k: v[0] for k, v in expected.items()}
    got = {(r.server, r.seq): (r.transport_until, r.logical_until, r.ready) for r in policy.penalties(frame.drop("ok")).collect()}
    assert got == {k: v[1] for k, v in expected.items()}


def test_penalties_batch_and_stream(spark, tmp_path):
    marks = [(0, "transport"), (5, "green"), (6, "refusal"), (7, "transport"), (8, "green"), (20, "success"), (40, "success")]
    events = spark.createDataFrame([("s", T0 + timedelta(seconds=t), k, e) for k, (t, e) in enumerate(marks)], "server string, ts timestamp, seq long, event string")
    batch = policy.penalties(events).orderBy("seq").collect()
    assert [r.ready for r in batch] == [False, True, False, False, False, False, True]
    events.coalesce(1).write.parquet(str(tmp_path / "in"))
    run = state.penalties(spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))).writeStream.format("memory").queryName("penalty_states").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    run.awaitTermination(120)
    got = spark.table("penalty_states").orderBy("seq").collect()
    assert [(r.ready, r.transport_until, r.logical_until) for r in got] == [(r.ready, r.transport_until, r.logical_until) for r in batch]


def test_empty_logs(spark):
    empty = spark.createDataFrame([], ATTEMPTS)
    assert policy.verdicts(policy.streaks(empty)).isEmpty() and metrics.counters(empty, "outcome").isEmpty()
    assert metrics.token_sums(spark.createDataFrame([], "prompt_tokens long, completion_tokens long")).first().prompt == 0


def test_rotation(spark):
    servers = spark.createDataFrame([(k, f"s{k}") for k in range(4)], "index int, name string")
    assert [r.name for r in policy.rotation(servers, 2, 4).collect()] == ["s2", "s3", "s0", "s1"]


def test_server_snapshot(spark):
    events = spark.createDataFrame([("a", T0, 1, "green"), ("b", T0, 2, "refusal"), ("a", T0, 3, "success")], "server string, ts timestamp, seq long, event string")
    row = policy.snapshot(policy.latest(policy.penalties(events).select("server", "ts", "seq", "ready"))).first()
    assert (row.available, row.servers, row.snapshot) == (1, 2, "a=UP, b=DOWN")
    text = spark.range(1).select(policy.exhausted(F.lit("IsSuccess=false: x"), F.lit("a=DOWN")).alias("t")).first().t
    assert "IsSuccess=false" in text and "a=DOWN" in text
