"""The policies of `operators.policy` as stateful streams: the same counts, kept per key between micro-batches.

State survives restarts, and is shared by all instances, as the checkpoint holds it. Events of a key within one
micro-batch are taken in the order (ts, seq).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from docloom.schema import Settings
from docloom.operators.policy import DOCUMENT_MARKS, TERMINAL

STREAK = "task_id long, ts timestamp, seq long, poison long, any long"
BREAKER = "server string, ts timestamp, seq long, failures long, paused_until timestamp, paused boolean"
PENALTY = "server string, ts timestamp, seq long, transport_until timestamp, logical_until timestamp, ready boolean"


def _in_order(batches: Iterator[pd.DataFrame]) -> Iterator:
    rows = pd.concat(list(batches))  # a key's events of one micro-batch
    return rows.sort_values(["ts", "seq"]).itertuples(index=False)


def streaks(attempts: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Streaks of the attempts (task_id, ts, seq, outcome, error, outage), as `policy.streaks` counts them."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        poison, any_, last = state.get if state.exists else (0, 0, None)
        out = []
        for e in _in_order(batches):
            if e.outcome in TERMINAL:
                poison, any_, last = 0, 0, None
            elif e.outcome == "transient":
                if last is not None and e.ts - pd.Timestamp(last) > pd.Timedelta(minutes=cfg.idle_minutes):
                    poison, any_ = 0, 0
                blames = e.error is not None and any(m in e.error for m in DOCUMENT_MARKS)
                poison, any_, last = poison + 1 if blames else 0, 0 if e.outage else any_ + 1, e.ts
                out.append((key[0], e.ts, e.seq, poison, any_))
        state.update((poison, any_, last))
        yield pd.DataFrame(out, columns=["task_id", "ts", "seq", "poison", "any"])

    return attempts.groupBy("task_id").applyInPandasWithState(step, STREAK, "poison long, any long, last timestamp", "append", GroupStateTimeout.NoTimeout)


def breaker(events: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """The breaker of each server at its events (server, ts, seq, ok)."""
    pause = pd.Timedelta(seconds=cfg.breaker_pause_seconds)

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        failures, until = state.get if state.exists else (0, None)
        out = []
        for e in _in_order(batches):
            paused = until is not None and e.ts < pd.Timestamp(until)
            failures = 0 if e.ok else failures + 1
            until = e.ts + pause if failures >= cfg.breaker_failures else None
            out.append((key[0], e.ts, e.seq, failures, until, paused))
        state.update((failures, until))
        yield pd.DataFrame(out, columns=["server", "ts", "seq", "failures", "paused_until", "paused"]).astype({"paused_until": "datetime64[ns]"})

    return events.groupBy("server").applyInPandasWithState(step, BREAKER, "failures long, until timestamp", "append", GroupStateTimeout.NoTimeout)


def penalties(events: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """The penalties of each server after its events (server, ts, seq, event)."""
    cooldown = pd.Timedelta(seconds=cfg.ocr_cooldown_seconds)

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        transport, logical = (None if x is None else pd.Timestamp(x) for x in state.get) if state.exists else (None, None)
        out = []
        for e in _in_order(batches):
            if e.event == "transport":
                transport = e.ts + cooldown
            elif e.event == "green":
                transport = None
            elif e.event == "refusal":
                logical = e.ts + cooldown if logical is None else max(logical, e.ts + cooldown)
            ready = not any(until is not None and e.ts < until for until in (transport, logical))
            out.append((key[0], e.ts, e.seq, transport, logical, ready))
        state.update((transport, logical))
        yield pd.DataFrame(out, columns=["server", "ts", "seq", "transport_until", "logical_until", "ready"]).astype({"transport_until": "datetime64[ns]", "logical_until": "datetime64[ns]"})

    return events.groupBy("server").applyInPandasWithState(step, PENALTY, "transport timestamp, logical timestamp", "append", GroupStateTimeout.NoTimeout)
