from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from docloom.operators import metrics, queue
from docloom.schema import OUTCOMES, QUEUE, RESULTS, repeats
from docloom.sources.snapshots import Snapshots

NOW = datetime(2024, 1, 31)


def at():
    return F.lit("2024-01-31 00:00:00").cast("timestamp")



def task(id_: int, status: int, created: str, **own):
    base = dict(id=id_, file_id=f"f{id_}", file_name=f"f{id_}.pdf", status=status, retry_count=0, created_at=datetime.fromisoformat(created))
    names = [c.split()[0] for c in QUEUE.split(", ")]
    return tuple((base | own).get(n) for n in names)


@pytest.fixture(scope="module")
def tasks(spark):
    s = lambda n: NOW - timedelta(seconds=n)
    rows = [
        task(1, 0, "2024-01-30 10:00"), task(2, 0, "2024-01-30 12:00", next_attempt_at=NOW), task(3, 0, "2024-01-30 13:00", next_attempt_at=s(-1)), task(4, 1, "2024-01-01 00:00", locked_at=s(3600)),
        task(5, 1, "2024-01-01 00:00", locked_at=s(3601), locked_by="me", claim_token="t"), task(6, 3, "2024-01-05 00:00:00.200", retry_count=1, updated_at=s(61)), task(7, 3, "2024-01-05 00:00:00.900", retry_count=1, updated_at=s(61)),
        task(8, 3, "2024-01-03 00:00", retry_count=2, updated_at=s(14400)), task(9, 3, "2024-01-03 00:00", retry_count=9999, updated_at=s(14400)), task(10, 2, "2024-01-03 00:00", updated_at=s(14400)),
        task(11, 3, "2024-01-04 00:00"), task(12, 3, "2024-01-02 00:00", updated_at=s(3600)),
    ]
    return spark.createDataFrame(rows, QUEUE)


def test_claim_order(tasks):
    assert [r.id for r in queue.claim(tasks, at(), 100).collect()] == [5, 2, 1, 12, 7, 6]
    assert [r.id for r in queue.claim(tasks, at(), 2).collect()] == [5, 2]


def test_claim_never_takes_more_than_it_may(tasks):
    leased = queue.leased(tasks, queue.claim(tasks, at(), 3), "w", "tok", at())
    assert leased.count() == 12 and leased.where("claim_token = 'tok'").count() == 3
    assert leased.where("id = 5").first().updated_at is None


def test_depth_and_age(tasks):
    assert {r.status: r.n for r in metrics.queue_depth(tasks).collect()} == {0: 3, 1: 2, 2: 1, 3: 6}
    assert metrics.oldest_pending(tasks, at()).first().seconds == 2_505_600
    assert metrics.oldest_pending(tasks.where("false"), at()).first().seconds == 0
    assert {r.n for r in metrics.queue_depth(tasks.where("false")).collect()} == {0}


@pytest.mark.parametrize("wrong", [("other", "t"), ("me", "other"), (None, "t"), ("me", None)])
@pytest.mark.parametrize("outcome", queue.OUTCOMES)
def test_lease_fences(spark, tasks, wrong, outcome):
    did = spark.createDataFrame([(5, *wrong, outcome, "e", 5, "<x/>"), (999, "me", "t", outcome, "e", 5, None)], OUTCOMES)
    assert queue.settled(tasks, did, at()).exceptAll(tasks).isEmpty()


@pytest.mark.parametrize(
    ("outcome", "status", "retries", "free"),
    [("done", 2, 0, True), ("failed", 3, 1, True), ("empty", 3, 9999, True), ("transient", 0, 0, True), ("rejected", 3, 9999, True), ("missing", 3, 1, True), ("heartbeat", 1, 0, False)],
)
def test_transitions(spark, tasks, outcome, status, retries, free):
    did = spark.createDataFrame([(5, "me", "t", outcome, "why", 90, None)], OUTCOMES)
    after = queue.settled(tasks.withColumn("parsed_text", F.lit("p")), did, at())
    assert after.count() == 12 and after.where("id <> 5").exceptAll(tasks.withColumn("parsed_text", F.lit("p")).where("id <> 5")).isEmpty()
    row = after.where("id = 5").first()
    assert (row.status, row.retry_count, row.locked_by is None) == (status, retries, free)
    assert row.parsed_text == (None if outcome in ("done", "empty", "rejected") else "p")
    assert row.locked_at == (None if free else NOW)
    if outcome == "transient":
        assert row.next_attempt_at == NOW + timedelta(seconds=90)


def test_one_outcome_counts(spark, tasks):
    did = spark.createDataFrame([(5, "me", "t", "failed", "x", 1, None), (5, "me", "t", "done", None, 1, "<a/>"), (5, "me", "t", "nonsense", None, 1, None)], OUTCOMES)
    assert queue.settled(tasks, did, at()).where("id = 5").first().status == 2


def test_results_replace(spark, tasks):
    old = spark.createDataFrame([(5, "f5", "f5.pdf", "old", "x", NOW), (6, "f6", "f6.pdf", "stays", "x", NOW)], RESULTS)
    did = spark.createDataFrame([(5, "me", "t", "done", None, 1, "new"), (6, "me", "t", "done", None, 1, "stale")], OUTCOMES)
    got = {r.doc_id: r.xml_data for r in queue.with_results(old, tasks, did, at()).collect()}
    assert got == {5: "new", 6: "stays"}


def test_ingest_is_unique(spark, tasks):
    new = spark.createDataFrame([("f1", "again.pdf"), ("n1", "b.pdf"), ("n1", "a.pdf"), ("n2", "c.doc"), (None, "x.pdf")], "file_id string, file_name string")
    after = queue.ingested(tasks, new, at())
    assert after.count() == 14 and repeats(after, "file_id").isEmpty() and repeats(after, "id").isEmpty()
    added = {r.file_id: r for r in after.where("id > 12").collect()}
    assert sorted(r.id for r in added.values()) == [13, 14] and added["n1"].file_name == "a.pdf" and added["n2"].created_at == NOW


def test_snapshots(spark, tasks, tmp_path):
    store = Snapshots(spark, str(tmp_path / "q"), QUEUE, ("status",))
    assert store.version() == 0 and store.read().isEmpty()
    store.write(tasks, "a")
    assert store.read().exceptAll(tasks).isEmpty() and store.has("a") and not store.has("b")
    store.write(store.read().where("id < 3"))
    assert store.version() == 2 and store.read().count() == 2 and store.read(1).count() == 12


def test_top_k_is_distributed(tasks):
    plan = queue.claim(tasks, at(), 5)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
