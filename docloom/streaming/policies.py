"""Where tasks, instances, models and servers stand, kept up to date from what the journals add.

A tick folds the attempts, events and calls that came since the last one onto the states before them and commits the states
that change, with the journals' versions, in one step of a change log. So its input is what is new and the states of keys
that are open, not the history. States of streaks that ended are dropped, as are, by `evict`, those that have been idle
for so long that the next failure starts anew. Several instances may fold: who comes second folds what the first left.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators import policy
from docloom.schema import Settings
from docloom.sources.changelog import ChangeLog, Journal

#: kind is task, instance, model, server or cursor; the other columns are what that kind needs.
STATES = "name string, kind string, key string, at timestamp, until timestamp, n long, m long"


def _of(states: DataFrame, kind: str, **columns: str) -> DataFrame:
    return states.where(F.col("kind") == kind).select(*[F.expr(x).alias(name) for name, x in columns.items()])


@dataclass(frozen=True)
class Standing:
    """The states as the policies take them."""

    tasks: DataFrame
    instances: DataFrame
    models: DataFrame
    servers: DataFrame

    @staticmethod
    def of(states: DataFrame) -> Standing:
        return Standing(
            _of(states, "task", task_id="cast(key as bigint)", last="at", poison0="n", any0="m"), _of(states, "instance", instance="key", succeeded="at"),
            _of(states, "model", server="key", failures0="n", at0="at"), _of(states, "server", server="key", transport0="at", logical0="until"),
        )


def _rows(frame: DataFrame, kind: str, key: str, **columns: str) -> DataFrame:
    given = {"kind": F.lit(kind), "key": F.col(key).cast("string")} | {c: F.col(x) for c, x in columns.items()}
    given["name"] = F.concat(F.lit(kind + "/"), F.coalesce(given["key"], F.lit("")))
    return frame.select(*[given.get(c, F.lit(None)).cast(t).alias(c) for c, t in (x.split() for x in STATES.split(", "))])


def folded(states: DataFrame, attempts: DataFrame, events: DataFrame, calls: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """The states that new attempts, events and calls change."""
    now = Standing.of(states)
    after = [
        _rows(policy.task_states(attempts, cfg, now.tasks, now.instances), "task", "task_id", at="last", n="poison0", m="any0"),
        _rows(policy.instance_states(attempts.where("instance is not null")), "instance", "instance", at="succeeded"),
        _rows(policy.model_states(calls, cfg, now.models), "model", "server", n="failures0", at="at0"),
        _rows(policy.server_states(events, cfg, now.servers), "server", "server", at="transport0", until="logical0"),
    ]
    return after[0].unionByName(after[1]).unionByName(after[2]).unionByName(after[3])


class Policies:
    """The states at a path."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 16):
        self.log = ChangeLog(spark, path, STATES, "name", buckets, alive="kind <> 'task' or at is not null")

    def standing(self) -> Standing:
        return Standing.of(self.log.read())

    def catch_up(self, attempts: Journal, events: Journal, calls: Journal, cfg: Settings = Settings()) -> int | None:
        """Folds what the journals added since the last time; None if nothing was."""
        journals = {"attempts": attempts, "events": events, "calls": calls}

        def step(states: DataFrame) -> DataFrame | None:
            seen = {r.key: r.n for r in states.where("kind = 'cursor'").select("key", "n").collect()}
            new = {name: j.since(seen.get(name, 0)) for name, j in journals.items()}
            moved = [(name, version) for name, (version, _) in new.items() if version > seen.get(name, 0)]
            if not moved:
                return None
            cursors = states.sparkSession.createDataFrame(moved, "journal string, version long")
            return folded(states, *(rows for _, rows in new.values()), cfg).unionByName(_rows(cursors, "cursor", "journal", n="version"))

        return self.log.change(step)

    def evict(self, now: Column, cfg: Settings = Settings()) -> int | None:
        """Ends the streaks whose last failure is longer ago than the idle time."""
        idle = (F.col("kind") == "task") & (F.col("at") < now - F.make_dt_interval(mins=F.lit(cfg.idle_minutes)))
        none = F.lit(None)

        def step(states: DataFrame) -> DataFrame | None:
            gone = states.where(idle)
            return None if gone.isEmpty() else gone.withColumns({"at": none.cast("timestamp"), "n": none.cast("long"), "m": none.cast("long")})

        return self.log.change(step)
