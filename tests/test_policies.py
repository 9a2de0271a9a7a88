"""States that are folded step by step against folds over all of the history."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from docloom.operators import policy
from docloom.schema import ATTEMPTS, MODEL_CALLS, SERVER_EVENTS, Settings
from docloom.sources.changelog import Journal
from docloom.streaming.policies import Policies, Standing, folded, STATES

T0 = datetime(2024, 1, 1)
DOC, INFRA = "x IsSuccess=false", "connection reset"


def history(seed: int, n: int = 500):
    rng, t, attempts, events, calls = random.Random(seed), 0, [], [], []
    for k in range(n):
        t += rng.choice([0, 1, 30, 90, 400, 4000] if k % 25 else [50_000])
        ts = T0 + timedelta(seconds=t)
        outcome = rng.choice(["transient"] * 8 + ["done", "empty", "rejected", "failed"])
        attempts.append((rng.randrange(12), ts, k, outcome, rng.choice([DOC, INFRA, None]), rng.choice(["a", "b"])))
        events.append((rng.choice(["s1", "s2", "s3"]), ts, k, rng.choice(["transport", "green", "refusal", "success"])))
        calls.append((rng.choice(["m1", "m2"]), ts, k, rng.random() < 0.3))
    return attempts, events, calls


@pytest.mark.parametrize("seed", [1, 2])
def test_counts_go_on_from_states(spark, seed):
    """Cut anywhere: the second part on top of the states after the first gives the rows of the whole."""
    attempts, events, calls = history(seed)
    frame = lambda rows, ddl: spark.createDataFrame(rows, ddl)
    key = lambda df, *c: sorted(tuple(r) for r in df.select(*c).collect())
    for cut in (3, 250, 431):
        states = folded(frame([], STATES), frame(attempts[:cut], ATTEMPTS), frame(events[:cut], SERVER_EVENTS), frame(calls[:cut], MODEL_CALLS))
        now = Standing.of(states)
        late = f"seq >= {cut}"
        columns = ("task_id", "seq", "specific", "outage", "poison", "any")
        got = policy.streaks(frame(attempts[cut:], ATTEMPTS), before=now.tasks.where("last is not null"), successes=now.instances)
        assert key(got, *columns) == key(policy.streaks(frame(attempts, ATTEMPTS)).where(late), *columns)
        columns = ("server", "seq", "failures", "paused")
        assert key(policy.breaker(frame(calls[cut:], MODEL_CALLS), "server", before=now.models), *columns) == key(policy.breaker(frame(calls, MODEL_CALLS), "server").where(late), *columns)
        columns = ("server", "seq", "ready")
        assert key(policy.penalties(frame(events[cut:], SERVER_EVENTS), before=now.servers), *columns) == key(policy.penalties(frame(events, SERVER_EVENTS)).where(late), *columns)


def test_ticks_fold_what_is_new(spark, tmp_path):
    """Over many ticks: states and verdicts equal those of the full history; a tick reads what was added since the last one."""
    attempts, events, calls = history(3, 240)
    journals = [Journal(spark, str(tmp_path / n), ddl) for n, ddl in (("a", ATTEMPTS), ("e", SERVER_EVENTS), ("c", MODEL_CALLS))]
    states = Policies(spark, str(tmp_path / "s"), buckets=2)
    assert states.catch_up(*journals) is None
    for k in range(6):
        for journal, rows, ddl in zip(journals, (attempts, events, calls), (ATTEMPTS, SERVER_EVENTS, MODEL_CALLS), strict=True):
            journal.append(spark.createDataFrame(rows[40 * k : 40 * k + 40], ddl), f"t/{k}")
        if k % 2:
            assert states.catch_up(*journals) is not None
            assert states.catch_up(*journals) is None
            assert [j.since(j.version() - 1)[1].count() for j in journals] == [40, 40, 40]
        if k == 3:
            states.log.compact()
            journals[0].compact()
    log = spark.createDataFrame(attempts, ATTEMPTS)
    now = F.lit(str(attempts[-1][1] + timedelta(seconds=20))).cast("timestamp")
    fresh = spark.createDataFrame([(k, attempts[-1][1] + timedelta(seconds=5), 1000 + k, "transient", DOC, "a") for k in range(14)], ATTEMPTS)
    here = states.standing()
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(policy.verdicts_after(here.tasks, here.instances, fresh)) == rows(policy.round_verdicts(log, fresh))
    assert rows(policy.ready_servers(here.servers, now)) == rows(policy.standing(spark.createDataFrame(events, SERVER_EVENTS), now))
    assert rows(policy.paused_models(here.models, now)) == rows(policy.paused(spark.createDataFrame(calls, MODEL_CALLS), now))
    later = F.lit(str(attempts[-1][1] + timedelta(minutes=61))).cast("timestamp")
    assert here.tasks.count() > 0 and states.evict(later, Settings()) is not None and states.standing().tasks.isEmpty() and states.evict(later) is None
    states.log.compact()
    assert states.log.read().where("kind = 'task'").isEmpty() and states.standing().models.count() == 2
