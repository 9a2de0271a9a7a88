"""The change log and journals: versions, marks, merging, several writers, what a step writes."""

from __future__ import annotations

import os
import random
import subprocess
import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from docloom.operators import queue
from docloom.schema import OUTCOMES, QUEUE, Settings
from docloom.sources import changelog
from docloom.sources.changelog import ChangeLog, Folder, Journal, only_missing
from docloom.sources.snapshots import Snapshots
from docloom.streaming import runner

ITEMS = "id long, value string, n int"


def rows(df) -> list[tuple]:
    return sorted(tuple(r) for r in df.collect())


def test_changes_are_merged_on_read(spark, tmp_path):
    """Against a dictionary, over random changes and compactions; earlier versions stay as they were."""
    log, plain, versions = ChangeLog(spark, str(tmp_path / "t"), ITEMS, "id", buckets=4), {}, {}
    assert log.version() == 0 and log.read().isEmpty() and not log.compact()
    rng = random.Random(1)
    for k in range(12):
        new = {rng.randrange(30): (f"v{k}", k) for _ in range(rng.randrange(1, 8))}
        version = log.change(lambda q, new=new: spark.createDataFrame([(i, *x) for i, x in new.items()], ITEMS), f"step/{k}")
        plain |= new
        versions[version] = dict(plain)
        if k % 5 == 4:
            assert log.compact()
        assert rows(log.read()) == sorted((i, *x) for i, x in plain.items())
    assert all(rows(log.read(v)) == sorted((i, *x) for i, x in then.items()) for v, then in versions.items())
    assert log.change(lambda q: q, "step/3") is None and log.has("step/3") and not log.has("step/12")
    again = ChangeLog(spark, str(tmp_path / "t"), ITEMS, "id", buckets=4)
    assert rows(again.read()) == rows(log.read()) and again.version() == log.version()
    assert log.change(lambda q: None) is None
    log.vacuum(keep=1)
    assert rows(again.read()) == rows(ChangeLog(spark, str(tmp_path / "t"), ITEMS, "id").read()) == sorted((i, *x) for i, x in plain.items())


def test_a_change_is_computed_anew_when_another_was_first(spark, tmp_path):
    log = ChangeLog(spark, str(tmp_path / "t"), ITEMS, "id")
    log.change(lambda q: spark.createDataFrame([(1, "a", 0)], ITEMS))
    other = ChangeLog(spark, str(tmp_path / "t"), ITEMS, "id")
    tries = []

    def add(q):
        tries.append(1)
        if len(tries) == 1:  # another writer commits between this one's read and its commit
            other.change(lambda r: r.withColumn("n", F.col("n") + 10))
        return q.withColumn("n", F.col("n") + 1)

    assert log.change(add) == 3 and len(tries) == 2 and rows(log.read()) == [(1, "a", 11)]
    assert len(Folder(spark, str(tmp_path / "t/data")).names()) == 3  # what the loser had written is gone


def test_compaction_beside_a_writer(spark, tmp_path, monkeypatch):
    """A base that was prepared before another commit takes a later version and leaves that commit's rows on top."""
    log, other = (ChangeLog(spark, str(tmp_path / "t"), ITEMS, "id", buckets=2) for _ in range(2))
    for k in range(3):
        log.change(lambda q, k=k: spark.createDataFrame([(k, "a", k)], ITEMS), f"s/{k}")
    written = log._written

    def slow(df, *parts):
        out = written(df, *parts)
        monkeypatch.setattr(log, "_written", written)
        other.change(lambda q: spark.createDataFrame([(1, "late", 9)], ITEMS), "late")
        return out

    monkeypatch.setattr(log, "_written", slow)
    assert log.compact() and log.version() == 5
    assert rows(log.read()) == rows(other.read()) == [(0, "a", 0), (1, "late", 9), (2, "a", 2)]
    assert log.has("late") and log.has("s/2") and len(log.state().deltas) == 1


def test_only_one_file_takes_a_place(spark, tmp_path):
    folder = Folder(spark, str(tmp_path / "f"))
    assert folder.names() == []
    assert [folder.create("1", t) for t in ("first", "second")] == [True, False]
    assert folder.read("1") == "first" and [n for n in folder.names() if not n.startswith(".")] == ["1"]
    folder.local = False  # the way of other file systems
    assert [folder.create("2", t) for t in ("first", "second")] == [True, False] and folder.read("2") == "first"


def test_journals(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(changelog, "MERGE_AFTER", 3)
    log = Journal(spark, str(tmp_path / "j"), ITEMS)
    assert log.read().isEmpty() and not log.has("a/0")
    one = lambda k: spark.createDataFrame([(k, "x", k)], ITEMS)
    for k in range(20):
        log.append(one(k), f"a/{k}")
        assert rows(log.read()) == [(i, "x", i) for i in range(k + 1)]
    state = log.state()
    assert len(state.deltas) < 3 and all(len(v) < 3 for v in state.base.values()) and max(map(int, state.base)) >= 1
    assert log.append(one(99), "a/2") is None and log.has("a/19")
    monkeypatch.setattr(changelog, "MERGE_AFTER", 99)
    log.append(one(50), "again")
    log.append(one(51), "again")  # a step that runs again replaces its rows
    assert rows(log.read())[-1] == (51, "x", 51) and log.read().count() == 21
    log.vacuum(keep=1)
    assert log.read().count() == 21


def test_journals_tell_what_was_added(spark, tmp_path):
    log = Journal(spark, str(tmp_path / "j"), ITEMS)
    one = lambda k: spark.createDataFrame([(k, "x", k)], ITEMS)
    log.append(one(1), "a/1")
    at, all_ = log.since(0)
    assert at == 1 and rows(all_) == [(1, "x", 1)]
    log.append(one(2), "a/2")
    now, new = log.since(at)
    assert now == 2 and rows(new) == [(2, "x", 2)] and log.since(2)[1].isEmpty()
    log.compact()
    assert [rows(log.since(k)[1]) for k in (1, 2, 0)] == [[(2, "x", 2)], [], [(1, "x", 1), (2, "x", 2)]]
    log.append(one(3), "a/3")
    assert rows(log.since(1)[1]) == [(2, "x", 2), (3, "x", 3)] and rows(log.since(3)[1]) == [(3, "x", 3)]


def test_rows_that_are_gone(spark, tmp_path):
    log = ChangeLog(spark, str(tmp_path / "t"), ITEMS, "id", buckets=2, alive="value is not null")
    log.change(lambda q: spark.createDataFrame([(k, "a", k) for k in range(6)], ITEMS))
    log.change(lambda q: q.where("id % 2 = 0").withColumn("value", F.lit(None).cast("string")))
    for _ in range(2):
        assert rows(log.read()) == [(1, "a", 1), (3, "a", 3), (5, "a", 5)]
        log.compact()
    log.change(lambda q: spark.createDataFrame([(0, "new", 0)], ITEMS))
    assert rows(log.read())[0] == (0, "new", 0)


def test_only_a_missing_path_means_nothing_yet(spark, tmp_path):
    assert only_missing(lambda: spark.read.parquet(str(tmp_path / "none")), lambda: spark.range(1)).count() == 1
    with pytest.raises(AnalysisException):
        only_missing(lambda: spark.range(1).select("nothing"), lambda: spark.range(1))
    table = Snapshots(spark, str(tmp_path / "s"), ITEMS)
    assert table.version() == 0
    table.write(spark.createDataFrame([(1, "a", 1)], ITEMS))
    Folder(spark, str(tmp_path / "s")).delete("pointer")
    with pytest.raises(ValueError, match="no pointer"):
        table.write(spark.createDataFrame([(2, "b", 2)], ITEMS))


def at():
    return F.lit("2024-01-31 00:00:00").cast("timestamp")


def tasks_of(spark, n: int):
    names = [c.split() for c in QUEUE.split(", ")]
    given = {"id": F.col("id"), "file_id": F.concat(F.lit("f"), F.col("id")), "file_name": F.lit("a.docx"), "status": F.lit(0), "retry_count": F.lit(0), "created_at": F.lit(datetime(2024, 1, 1))}
    return spark.range(n).select(*[given.get(c, F.lit(None)).cast(t).alias(c) for c, t in names])


def written(path: Path) -> int:
    return sum(p.stat().st_size for p in path.rglob("*") if p.is_file() and not p.name.endswith(".crc"))


def test_a_tick_writes_what_changes(spark, tmp_path):
    """A claim of 16 tasks, a heartbeat and their outcomes write kilobytes, whatever the queue's size; the table is that of whole rewrites."""
    log, whole = ChangeLog(spark, str(tmp_path / "q"), QUEUE, "id"), tasks_of(spark, 200_000)
    log.change(lambda q: whole)
    log.compact()
    size = written(tmp_path / "q")
    mine = runner.claim(log, "w", "t", 16, at()).select("id", "locked_by", "claim_token")
    outcomes = spark.createDataFrame([(r.id, "w", "t", "done", None, None, "x") for r in mine.collect()], OUTCOMES)
    log.change(lambda q: queue.renewed_rows(q, "w", at()), "beat/1")
    log.change(lambda q: queue.settled_rows(q, outcomes, at()), "settle/1")
    assert size > 1_000_000 and written(tmp_path / "q") - size < 60_000
    leased = queue.leased(whole, queue.claim(whole, at(), 16), "w", "t", at())
    assert rows(log.read().where("status > 0").select("id", "status", "updated_at")) == rows(queue.settled(leased, outcomes, at()).where("status > 0").select("id", "status", "updated_at"))
    assert log.read().count() == 200_000
    log.compact()
    assert rows(log.read().groupBy("status").count()) == [(0, 199_984), (2, 16)]


def test_claims_by_free_slots(spark, tmp_path):
    """An owner never holds more leases than it has slots; large files have their own."""
    log = ChangeLog(spark, str(tmp_path / "q"), QUEUE, "id")
    log.change(lambda q: tasks_of(spark, 60))
    files = spark.range(60).select(F.concat(F.lit("f"), F.col("id")).alias("file_id"), F.lit("a.docx").alias("file_name"), F.col("id").cast("string").alias("binary_id"))
    sizes = spark.range(60).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") < 3, 20 << 20).otherwise(5).alias("size_bytes"))
    cfg = Settings(slots=10, batch=6, heavy_batch=2)
    held = []
    for k in range(4):
        runner.claim(log, "w", f"t{k}", cfg.batch, at(), cfg, files, sizes)
        light = log.read().where("locked_by = 'w' and status = 1 and id >= 3").count()
        held.append((light, log.read().where("status = 1").count() - light))
    assert held[0] == (3, 3) and [a for a, _ in held] == [3, 9, 10, 10]
    from docloom.sources import catalog

    leases = log.read().where("status = 1")
    assert queue.free_slots(leases, catalog.headers(leases, files, sizes), "w", at(), cfg) == (0, 0)
    assert queue.free_slots(leases, catalog.headers(leases, files, sizes), "other", at(), cfg) == (10, 2)
    stale = F.lit("2024-02-01 00:00:00").cast("timestamp")
    assert queue.free_slots(leases, catalog.headers(leases, files, sizes), "w", stale, cfg) == (10, 2)


CLAIMER = """
import sys
from pyspark.sql import SparkSession, functions as F
from docloom.schema import QUEUE
from docloom.sources.changelog import ChangeLog
from docloom.streaming import runner
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.sql.session.timeZone", "UTC").getOrCreate()
log, now, owner = ChangeLog(spark, sys.argv[1], QUEUE, "id"), F.lit("2024-01-31 00:00:00").cast("timestamp"), sys.argv[2]
got = []
for k in range(8):
    got += [r.id for r in runner.claim(log, owner, f"{owner}-{k}", 5, now).collect()]
print("GOT", *got)
"""


def test_two_processes_claim_at_once(spark, tmp_path):
    log = ChangeLog(spark, str(tmp_path / "q"), QUEUE, "id")
    log.change(lambda q: tasks_of(spark, 200))
    start = lambda owner: subprocess.Popen([sys.executable, "-c", CLAIMER, str(tmp_path / "q"), owner], stdout=subprocess.PIPE, stderr=subprocess.DEVNULL, text=True, env=os.environ | {"PYSPARK_SUBMIT_ARGS": "--driver-memory 1g pyspark-shell"})
    found = [p.communicate(timeout=240)[0] for p in [start("a"), start("b")]]
    ids = [[int(x) for x in out.split("GOT", 1)[1].split()] for out in found]
    assert [len(x) for x in ids] == [40, 40] and len({*ids[0], *ids[1]}) == 80
    leased = log.read().where("status = 1")
    assert rows(leased.groupBy("locked_by").count()) == [("a", 40), ("b", 40)] and log.read().count() == 200
