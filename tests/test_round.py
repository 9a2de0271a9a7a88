"""A round of processing and its continuous form, with clients that answer by rule."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from docloom.plans.documents import docx_bytes
from docloom.plans.pdfs import pdf_bytes
from docloom.operators import metrics, queue
from docloom.operators.governed import Stepped, dealt
from docloom.plans.pipeline import History, Services, run_round
from docloom.schema import ATTEMPTS, MODEL_CALLS, OUTCOMES, QUEUE, RESULTS, SERVER_EVENTS, TEXTS, Settings
from docloom.sources import catalog
from docloom.sources.logs import matching, read_log, token_usage
from docloom.sources.changelog import ChangeLog, Journal
from docloom.sources.snapshots import Snapshots
from docloom.streaming import runner

NOW = datetime(2024, 1, 31)


def at():
    return F.lit("2024-01-31 00:00:00").cast("timestamp")

LONG = "A text that is long enough to be kept."


class Ocr:
    def ask(self, target, request):
        name = json.loads(request)["FileName"]
        if target == "bad":
            return 0, None, 1
        if name == "damaged.pdf":
            return 200, '{"IsSuccess":false,"Notes":"InvalidPdfException"}', 2
        return 200, '{"IsSuccess":true,"Notes":"Recognised text of a scanned page."}', 3


class Model:
    def ask(self, target, request):
        text = json.loads(request)["messages"][1]["content"]
        if "overload" in text:
            return 503, "busy", 4
        content = "no frame" if "nonsense" in text else "```xml\n<Document><Header><Name>A & B</Header></Document>```"
        return 200, json.dumps({"choices": [{"finish_reason": "stop", "message": {"content": content}}], "usage": {"prompt_tokens": 3, "completion_tokens": 4}}), 5


@pytest.fixture(scope="module")
def world(spark):
    files = {
        1: ("a.docx", docx_bytes([LONG])), 2: ("b.docx", docx_bytes(["short"])), 3: ("c.pdf", pdf_bytes([])), 4: ("damaged.pdf", pdf_bytes([])), 5: ("e.docx", docx_bytes([LONG, "nonsense"])),
        6: ("f.docx", docx_bytes([LONG, "overload"])), 7: ("g.docx", b"{\\rtf"), 9: ("i.docx", b"unread"),
    }
    names = [c.split()[0] for c in QUEUE.split(", ")]
    rows = [{"id": k, "file_id": f"f{k}", "file_name": files.get(k, (f"{k}.pdf",))[0], "status": 0, "retry_count": 0, "created_at": NOW, "parsed_text": LONG if k == 9 else None} for k in range(1, 10)]
    queue = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], QUEUE)
    table = spark.createDataFrame([(f"f{k}", n, f"b{k}") for k, (n, _) in files.items()], "file_id string, file_name string, binary_id string")
    data = spark.createDataFrame([(f"b{k}", bytearray(d)) for k, (_, d) in files.items()], "id string, data binary")
    return queue, table, data


def test_round(spark, world):
    services = Services(ocr=Ocr(), ocr_servers=("bad", "good"), llm=Model(), at_once=2, pace=Stepped())
    done = run_round(world[0], spark.createDataFrame([], RESULTS), world[1], world[2], services, "w", "t1", at())
    got = {r.id: r.outcome for r in done.outcomes.collect()}
    assert got == {1: "done", 2: "empty", 3: "done", 4: "transient", 5: "failed", 6: "transient", 7: "rejected", 8: "missing", 9: "done"}
    after = {r.id: r for r in done.queue.collect()}
    assert [after[k].status for k in range(1, 10)] == [2, 3, 2, 0, 3, 0, 3, 3, 2]
    assert after[6].parsed_text and after[1].parsed_text is None and after[8].retry_count == 1 and after[7].retry_count == 9999
    results = {r.doc_id: r.xml_data for r in done.results.collect()}
    assert set(results) == {1, 3, 9} and results[1].startswith("<Document><Header><Name>A &amp; B</Name></Header></Document>\n")


def test_round_without_model_and_empty_queue(spark, world):
    done = run_round(world[0].where("id in (1, 3)"), spark.createDataFrame([], RESULTS), world[1], world[2], Services(), "w", "t2", at())
    assert {r.id: r.outcome for r in done.outcomes.collect()} == {1: "done", 3: "transient"}
    none = run_round(world[0].where("false"), spark.createDataFrame([], RESULTS), world[1], world[2], Services(), "w", "t3", at())
    assert none.outcomes.isEmpty() and none.queue.isEmpty() and none.results.isEmpty()


def test_rounds_judge_by_their_history(spark, world, tmp_path):
    """Poison and zombies are rejected by the rounds' own attempts, delays grow, penalised servers are passed over, a paused model isn't asked."""
    histories = runner.Histories(spark, str(tmp_path / "h"))
    queue_, results = world[0].where("id in (1, 4, 6)"), spark.createDataFrame([], RESULTS)
    services, cfg = Services(ocr=Ocr(), ocr_servers=("bad", "good"), llm=Model(), at_once=2, pace=Stepped()), Settings(breaker_failures=99, zombie_retries=10)
    seen = []
    for k in range(10):
        now = F.lit(str(NOW + timedelta(minutes=5 * k))).cast("timestamp")
        done = run_round(queue_, results, world[1], world[2], services, "w", f"t{k}", now, cfg, histories.read())
        rows = {r.id: r for r in done.outcomes.collect()}
        histories.append(done.seen, f"t{k}")
        seen.append(rows)
        queue_ = done.queue.withColumn("next_attempt_at", F.lit(None).cast("timestamp"))
        if k == 0:  # keeps the instance alive: another document succeeds each time
            assert rows[1].outcome == "done"
        table = Snapshots(spark, str(tmp_path / f"q{k}"), QUEUE)
        table.write(queue_.withColumn("status", F.when(F.col("id") == 1, 0).otherwise(F.col("status"))))
        queue_ = table.read()
    assert [r[4].outcome for r in seen[:3]] == ["transient", "transient", "rejected"] and seen[2][4].error.startswith("Poison document: ") and 4 not in seen[3]
    assert [r[6].outcome for r in seen[:10]] == ["transient"] * 9 + ["rejected"] and seen[9][6].error.startswith("Zombie: 10 ") and "HTTP 503" in seen[9][6].error
    assert [30 <= seen[k][6].delay_seconds <= top for k, top in ((0, 60), (4, 393))] == [True, True] and seen[7][6].delay_seconds > 300
    assert {r.server for r in histories.read().events.where("event = 'transport'").collect()} <= {"bad"}


def test_penalised_servers_and_a_paused_model(spark, world):
    def history(events=(), calls=()):
        return History(spark.createDataFrame([], ATTEMPTS), spark.createDataFrame(list(events), SERVER_EVENTS), spark.createDataFrame(list(calls), MODEL_CALLS))

    one = world[0].where("id in (1, 3)")
    services = Services(ocr=Ocr(), ocr_servers=("bad", "good"), llm=Model(), at_once=2, pace=Stepped())
    run = lambda h, cfg=Settings(): run_round(one, spark.createDataFrame([], RESULTS), world[1], world[2], services, "w", "t", at(), cfg, h)
    done = run(history([("bad", NOW - timedelta(seconds=5), 1, "transport")]))
    assert {r.id: r.outcome for r in done.outcomes.collect()} == {1: "done", 3: "done"} and {r.server for r in done.seen.events.collect()} == {"good"}
    done = run(history([(s, NOW - timedelta(seconds=5), 1, "refusal") for s in ("bad", "good")]))
    rows = {r.id: r for r in done.outcomes.collect()}
    assert rows[3].outcome == "transient" and "bad=DOWN, good=DOWN" in rows[3].error and done.seen.events.isEmpty()
    done = run(history(calls=[("chat", NOW - timedelta(seconds=10 - k), k, False) for k in range(3)]))
    assert {r.id: r.error for r in done.outcomes.collect()} == {1: "Model: paused by the breaker", 3: "Model: paused by the breaker"} and done.seen.calls.isEmpty()
    done = run(history(), Settings(heavy_mb=0, heavy_batch=1))
    rows = {r.id: r for r in done.outcomes.collect()}
    assert rows[1].outcome == "done" and (rows[3].outcome, rows[3].delay_seconds) == ("transient", 10) and {r.task_id for r in done.seen.attempts.collect()} == {1}
    broken = world[2].where(F.raise_error(F.lit("no catalog")).cast("boolean"))
    done = run_round(one, spark.createDataFrame([], RESULTS), world[1], broken, services, "w", "t", at())
    assert {r.id: (r.outcome, r.delay_seconds) for r in done.outcomes.collect()} == {1: ("transient", 60), 3: ("transient", 60)} and done.seen.attempts.isEmpty()
    with pytest.raises(ValueError):
        run_round(one, one, world[1], world[2], Services(prompt=" "), "w", "t", at())


def test_metric_catalogue(spark, world):
    events = spark.createDataFrame([("a", NOW - timedelta(seconds=5), 1, "refusal")], SERVER_EVENTS)
    calls = spark.createDataFrame([("chat", NOW - timedelta(seconds=10 - k), k, False) for k in range(3)], MODEL_CALLS)
    done = run_round(world[0], spark.createDataFrame([], RESULTS), world[1], world[2], Services(ocr=Ocr(), ocr_servers=("bad", "good"), llm=Model(), at_once=2, pace=Stepped()), "w", "t1", at())
    servers = ("a", "b", "bad", "good")
    halves = [metrics.rolled(done.seen.samples.where(f"{sign} name like 'llm%'")) for sign in ("", "not")]  # rollups can be merged
    found = metrics.catalogue(world[0], halves[0].unionByName(halves[1]), events, calls, servers, at())
    got = {(r.name, *sorted(r.labels.items())): r.value for r in found.collect()}
    tasks = {k[1:]: v for k, v in got.items() if k[0] == "tasks_total" and v}
    assert tasks == {(("outcome", "done"),): 3, (("outcome", "empty"),): 1, (("outcome", "transient"),): 2, (("outcome", "missing"),): 1, (("kind", "llm_bad_output"), ("outcome", "failed")): 1, (("outcome", "rejected"), ("reason", "bad_format")): 1}
    assert got["tasks_claimed_total",] == 9 and got["tasks_total", ("outcome", "rejected"), ("reason", "poison")] == 0 and got["queue_depth", ("status", "new")] == 9 and got["ingest_new_total",] == 0
    asked = done.seen.events.where("event <> 'green'").count()
    assert sum(v for k, v in got.items() if k[0] == "ocr_requests_total") == asked and got["ocr_requests_total", ("outcome", "document_error"), ("server", "good")] == 1
    assert got["ocr_server_up", ("server", "a")] == 0 and got["ocr_servers_available",] == 3 and got["ocr_requests_total", ("outcome", "success"), ("server", "b")] == 0 and got["ocr_unavailable_total",] == 1
    assert got["llm_paused",] == 1 and got["llm_consecutive_failures",] == 3 and got["llm_requests_total", ("outcome", "server_error")] == 2 and got["llm_requests_total", ("outcome", "success")] == 4
    assert got["llm_tokens_total", ("type", "prompt")] == 12 and got["llm_xml_repair_total",] == 3 and got["llm_bad_output_total",] == 1 and got["llm_duration_seconds_count",] == 4 and got["llm_last_duration_ms",] == 5
    assert got["task_duration_seconds_count", ("phase", "model")] == 3 and got["task_duration_seconds_bucket", ("le", "+Inf"), ("phase", "total")] == 9 and got["llm_duration_seconds_bucket", ("le", "0.1")] == 4
    assert "ocr_servers_registered 4.0" in {r.line for r in metrics.exposition(found).collect()} and len(got) == found.count()


def test_triggers(spark, world, tmp_path):
    """Heartbeats, probes and reports at the ticks of a stream."""
    tasks, histories = Snapshots(spark, str(tmp_path / "q"), QUEUE), runner.Histories(spark, str(tmp_path / "h"))
    tasks.write(world[0].where("id in (1, 2)").withColumn("status", F.col("id").cast("int")).withColumn("locked_by", F.lit("w")).withColumn("claim_token", F.lit("t")))
    spark.range(1).coalesce(1).write.parquet(str(tmp_path / "ticks"))
    ticks = spark.readStream.schema("id long").parquet(str(tmp_path / "ticks"))
    steps = [runner.heartbeat(ticks, tasks, "w", at=lambda _: at()), runner.probe(ticks, ("a", "b"), histories.journals["events"], lambda s: s == "a", at=lambda _: at()), runner.report(ticks, tasks, histories, ("a", "b"), str(tmp_path / "m"), at=lambda _: at())]
    for k, step in enumerate(steps):
        run = step.option("checkpointLocation", str(tmp_path / f"cp{k}")).trigger(availableNow=True).start()
        assert run.awaitTermination(120)
    assert {r.id: r.locked_at for r in tasks.read().collect()} == {1: NOW, 2: None}
    assert {r.server: r.event for r in histories.read().events.collect()} == {"a": "green", "b": "transport"}
    assert 'ocr_server_up{server="b"} 0.0' in {r.value for r in spark.read.text(str(tmp_path / "m/report-0")).collect()}


def test_stream(spark, world, tmp_path):
    tasks, results = Snapshots(spark, str(tmp_path / "q"), QUEUE), Snapshots(spark, str(tmp_path / "r"), RESULTS)
    spark.createDataFrame([("f1", "a.docx"), ("f1", "a.docx"), ("f2", "b.pdf")], "file_id string, file_name string").coalesce(1).write.parquet(str(tmp_path / "files"))
    source = spark.readStream.schema("file_id string, file_name string").parquet(str(tmp_path / "files"))
    for k in range(2):  # the second run has nothing new; a lost checkpoint would meet the mark
        run = runner.ingest(source, tasks, at=lambda _: at()).option("checkpointLocation", str(tmp_path / f"cp{k}")).trigger(availableNow=True).start()
        assert run.awaitTermination(120)
    assert tasks.read().count() == 2 and tasks.version() == 1
    mine = runner.claim(tasks, "w", "tok", 5, at())
    assert mine.count() == 2
    spark.createDataFrame([(r.id, "w", "tok", "done", None, None, "<x/>") for r in mine.collect()] + [(1, "w", "late", "failed", "x", 1, None)], OUTCOMES).coalesce(1).write.parquet(str(tmp_path / "out"))
    run = runner.settle(spark.readStream.schema(OUTCOMES).parquet(str(tmp_path / "out")), tasks, results, at=lambda _: at()).option("checkpointLocation", str(tmp_path / "cpo")).trigger(availableNow=True).start()
    assert run.awaitTermination(120)
    assert {r.status for r in tasks.read().collect()} == {2} and results.read().count() == 2


def test_catalog(spark, tmp_path):
    tables = {
        "link_cards": [("c1",), ("c2",), ("c3",), ("c4",), ("c5",)], "card_main_info": [("c1", 0, NOW), ("c2", 1, NOW), ("c3", None, NOW), ("c4", 0, datetime(2024, 1, 27)), ("c5", 0, datetime(2024, 1, 26, 23, 59, 59))],
        "doc_sys": [(c, "KIND") for c in ("c1", "c2", "c3", "c4", "c5")], "doc_files": [(c, f"v{c}") for c in ("c1", "c2", "c3", "c4", "c5")] + [("c4", "vc1")], "v_files": [(f"vc{k}", f"f{k}") for k in range(1, 6)],
        "files": [(f"f{k}", f"n{k}.pdf", f"b{k}") for k in range(1, 6)], "binaries": [("b1", bytearray(b"xyz")), ("b4", None)],
    }
    for name, rows in tables.items():
        spark.createDataFrame(rows, catalog.SCHEMAS[name]).write.parquet(str(tmp_path / f"{name}.parquet"))
    found = catalog.read_catalog(spark, str(tmp_path))
    queue = spark.createDataFrame([], QUEUE)
    got = [r.file_id for r in catalog.ingest_candidates(found, queue, "kind", at()).orderBy("file_id").collect()]
    assert got == ["f1", "f4"]
    claims = spark.createDataFrame([(1, "t", "f1", "n"), (2, "t", "f2", "n"), (4, "t", "f4", "n")], "id long, claim_token string, file_id string, file_name string")
    heads = catalog.headers(claims, found["files"], found["binaries"])
    assert {r.id: r.size_bytes for r in heads.collect()} == {1: 3, 4: 0}
    assert [r.id for r in catalog.missing_sources(claims, heads).collect()] == [2]


def test_ingest_of_changes(spark, tmp_path):
    """Rows of the catalog's tables that come in any order and late: the tasks after each tick are those of the full joins."""
    import random

    rng, spread = random.Random(5), {name: [] for name in catalog.SCHEMAS if name != "binaries"}
    for k in range(40):
        card = f"c{k}"
        for name, row in (("link_cards", (card,)), ("card_main_info", (card, rng.choice([0, 0, 0, 1, None]), NOW - timedelta(days=rng.choice([0, 1, 3, 9])))), ("doc_sys", (card, rng.choice(["KIND", "kind", "other"]))), ("doc_files", (card, f"v{k}")), ("v_files", (f"v{k}", f"f{k % 30}"))):
            spread[name].append((rng.randrange(3), row))
        if k < 30:
            spread["files"].append((rng.randrange(3), (f"f{k}", f"n{k}.{rng.choice(['pdf', 'docx', 'txt'])}", f"b{k}")))
    journals = {name: Journal(spark, str(tmp_path / name), catalog.SCHEMAS[name]) for name in spread}
    tasks, marks = ChangeLog(spark, str(tmp_path / "q"), QUEUE, "id", buckets=2), ChangeLog(spark, str(tmp_path / "m"), runner.MARKS, "name", buckets=1)
    spark.range(1).coalesce(1).write.parquet(str(tmp_path / "ticks"))
    ticks = spark.readStream.schema("id long").parquet(str(tmp_path / "ticks"))
    counts = []
    for tick in range(3):
        for name, rows in spread.items():
            journals[name].append(spark.createDataFrame([r for t, r in rows if t == tick], catalog.SCHEMAS[name]), f"{name}/{tick}")
        run = runner.ingest_changes(ticks, journals, tasks, marks, "kind", at=lambda _: at()).option("checkpointLocation", str(tmp_path / f"cp{tick}")).trigger(availableNow=True).start()
        assert run.awaitTermination(240)
        full = catalog.ingest_candidates({n: j.read() for n, j in journals.items()}, spark.createDataFrame([], QUEUE), "kind", at())
        assert sorted((r.file_id, r.file_name) for r in tasks.read().collect()) == sorted((r.file_id, r.file_name) for r in full.collect())
        counts.append(tasks.read().count())
    assert counts[0] < counts[2] and tasks.read().select("id").distinct().count() == counts[2]


def test_logs(spark, tmp_path):
    (tmp_path / "a.log").write_text("before any\n2024-01-01 10:00:00.123 INFO  [w] tokens 120/45\n  at trace\n2024-01-01T10:01:00 ERROR [w] overload\nnoise\n2024-01-01 10:02:00,5 WARN tokens 7/80\n")
    log = read_log(spark, str(tmp_path / "a.log"))
    assert [r.message for r in log.orderBy("ts").collect()] == ["[w] tokens 120/45\n  at trace", "[w] overload\nnoise", "tokens 7/80"]
    assert log.count() == 3 and [r.message for r in matching(log, "overload").collect()] == ["[w] overload\nnoise"] and log.where("ts is null").isEmpty()
    assert [(r.prompt, r.completion) for r in token_usage(log).collect()] == [(7, 80), (120, 45)]


def test_logs_in_blocks(spark, tmp_path):
    """Files that are cut into many blocks, with messages longer than blocks and files without an entry, give the entries of a whole read."""
    import random

    from docloom.sources.logs import entries

    rng, texts = random.Random(2), {}
    for k in range(3):
        lines = [f"early {i}" for i in range(40)]
        for i in range(120):
            lines.append(f"2024-01-01 10:{i // 60:02}:{i % 60:02}.{k} {rng.choice(['INFO', 'ERROR'])} entry {i} of {k}")
            lines += [f"\tat line {j} of entry {i}" for j in range(rng.choice([0, 0, 1, 3, 200]))]
        texts[k] = lines
    texts[3] = ["no entry"] * 500
    for k, lines in texts.items():
        (tmp_path / f"{k}.log").write_text("\n".join(lines) + "\n", newline="\r\n" if k == 1 else "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        got = read_log(spark, str(tmp_path / "*.log"))
        assert spark.read.text(str(tmp_path / "0.log")).rdd.getNumPartitions() > 10
        rows = spark.createDataFrame([(str(k), i, x) for k, lines in texts.items() for i, x in enumerate(lines)], "file string, at long, value string")
        key = lambda df: sorted((r.ts, r.level, r.message) for r in df.collect())
        assert key(got) == key(entries(rows)) and got.count() == 360
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_poll(spark, world, tmp_path):
    tasks, results = Snapshots(spark, str(tmp_path / "q"), QUEUE), Snapshots(spark, str(tmp_path / "r"), RESULTS)
    tasks.write(world[0].where("id in (1, 2)"))
    spark.range(1).coalesce(1).write.parquet(str(tmp_path / "ticks"))
    ticks = spark.readStream.schema("id long").parquet(str(tmp_path / "ticks"))
    for k, paused in enumerate((True, False, False)):
        run = runner.poll(ticks, tasks, results, world[1], world[2], Services(), "w", paused=lambda p=paused: p, at=lambda _: at()).option("checkpointLocation", str(tmp_path / f"cp{k}")).trigger(availableNow=True).start()
        assert run.awaitTermination(240)
        assert tasks.version() == (1 if paused else 2)
    assert {r.id: r.status for r in tasks.read().collect()} == {1: 2, 2: 3} and results.read().count() == 1


def test_poll_with_journals(spark, world, tmp_path):
    """Results are appended, texts lie apart from the queue, and a later round finds a text there without reading the file again."""
    tasks, results, texts = Snapshots(spark, str(tmp_path / "q"), QUEUE), Journal(spark, str(tmp_path / "r"), RESULTS), Journal(spark, str(tmp_path / "t"), TEXTS)
    tasks.write(world[0].where("id in (1, 2, 6)"))
    spark.range(1).coalesce(1).write.parquet(str(tmp_path / "ticks"))
    ticks = spark.readStream.schema("id long").parquet(str(tmp_path / "ticks"))

    def tick(k, services, binaries, when):
        run = runner.poll(ticks, tasks, results, world[1], binaries, services, "w", name=f"poll{k}", at=lambda _: F.lit(when).cast("timestamp"), texts=texts).option("checkpointLocation", str(tmp_path / f"cp{k}")).trigger(availableNow=True).start()
        assert run.awaitTermination(240)

    assert not texts.has("poll0/0")
    tick(0, Services(llm=Model(), at_once=2, pace=Stepped()), world[2], "2024-01-31 00:00:00")
    assert texts.has("poll0/0") and [(r.id, r.parsed_text) for r in texts.read().collect()] == [(6, f"{LONG}\noverload\n")]
    after = {r.id: r for r in tasks.read().collect()}
    assert {k: r.status for k, r in after.items()} == {1: 2, 2: 3, 6: 0} and {r.parsed_text for r in after.values()} == {None}
    assert [r.doc_id for r in results.read().collect()] == [1]
    unreadable = world[2].withColumn("data", F.lit(b"x"))
    tick(1, Services(), unreadable, "2024-01-31 02:00:00")
    assert {r.id: r.status for r in tasks.read().collect()} == {1: 2, 2: 3, 6: 2}
    assert {r.doc_id: r.xml_data for r in queue.latest_results(results.read()).collect()}[6].rstrip().endswith("overload") and texts.read().count() == 1


def test_instances_on_a_log_of_changes(spark, world, tmp_path):
    """Two instances share a queue: each claims as many tasks as it has slots, settles its own, and a lost lease changes nothing."""
    tasks, results = ChangeLog(spark, str(tmp_path / "q"), QUEUE, "id", buckets=2), Journal(spark, str(tmp_path / "r"), RESULTS)
    tasks.change(lambda q: world[0].where("id in (1, 2, 6, 9)"))
    spark.range(1).coalesce(1).write.parquet(str(tmp_path / "ticks"))
    ticks = spark.readStream.schema("id long").parquet(str(tmp_path / "ticks"))
    histories = runner.Histories(spark, str(tmp_path / "h"))

    def tick(k, owner, cfg=Settings(), name="poll"):
        run = runner.poll(ticks, tasks, results, world[1], world[2], Services(llm=Model(), at_once=2, pace=Stepped()), owner, cfg, name=name, at=lambda _: at(), histories=histories).option("checkpointLocation", str(tmp_path / f"cp{k}")).trigger(availableNow=True).start()
        assert run.awaitTermination(240)

    busy = runner.claim(tasks, "a", "earlier", 1, at())  # a lease that another round of this instance holds
    assert [r.id for r in busy.collect()] == [1]
    tick(0, "a", Settings(slots=2))
    assert {r.id: (r.status, r.locked_by) for r in tasks.read().collect()} == {1: (1, "a"), 2: (3, None), 6: (0, None), 9: (0, None)}
    version = tasks.version()
    tick(1, "a", Settings(slots=2))  # a lost checkpoint: the tick's mark is there
    assert tasks.version() == version
    tick(2, "b")
    after = {r.id: r for r in tasks.read().collect()}
    assert {k: r.status for k, r in after.items()} == {1: 1, 2: 3, 6: 0, 9: 2} and after[6].parsed_text == f"{LONG}\noverload\n" and after[6].next_attempt_at > NOW
    assert [r.doc_id for r in results.read().collect()] == [9] and {r.instance for r in histories.read().attempts.collect()} == {"a", "b"}
    late = spark.createDataFrame([(1, "a", "other", "done", None, None, "x")], OUTCOMES)
    tasks.change(lambda q: queue.settled_rows(q, late, at()))
    assert {r.id: r.status for r in tasks.read().collect()}[1] == 1
    for k, step in enumerate((runner.heartbeat(ticks, tasks, "a", at=lambda _: F.lit("2024-01-31 00:30:00").cast("timestamp")), runner.ingest(spark.readStream.schema("file_id string, file_name string").parquet(str(tmp_path / "ticks")), tasks, at=lambda _: at()))):
        run = step.option("checkpointLocation", str(tmp_path / f"cpx{k}")).trigger(availableNow=True).start()
        assert run.awaitTermination(240)
    assert {r.id: r.locked_at for r in tasks.read().collect()}[1] == NOW + timedelta(minutes=30) and tasks.read().count() == 4


def test_latest_results(spark):
    rows = [(1, "f", "n", "old", "w", NOW), (1, "f", "n", "new", "w", NOW + timedelta(seconds=1)), (2, "f", "n", "a", "w", NOW), (2, "f", "n", "b", "w", NOW), (None, None, None, None, None, None)]
    got = {r.doc_id: r.xml_data for r in queue.latest_results(spark.createDataFrame(rows, RESULTS)).collect()}
    assert got == {1: "new", 2: "b", None: None} and queue.latest_results(spark.createDataFrame([], RESULTS)).isEmpty()


def test_http_client():
    import http.server
    import threading

    from docloom.sources.http import HttpClient, alive

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            body = self.rfile.read(int(self.headers["Content-Length"]))
            self.send_response(200 if self.path == "/ocr" else 503)
            self.end_headers()
            self.wfile.write(b"got " + body)

        def log_message(self, *_):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}/"
    assert HttpClient("/ocr", {"a": base}).ask("a", "{}")[:2] == (200, "got {}")
    assert HttpClient("/other").ask(base, "{}")[:2] == (503, "got {}")
    assert alive(base)
    server.shutdown()
    server.server_close()
    assert HttpClient("/ocr", timeout_seconds=2).ask(base, "{}")[:2] == (0, None) and not alive(base)


def test_waves_follow_ids_of_many_requests(spark):
    """Also beyond 10,000 requests, in whatever order and layout they come; the waves are full."""
    ids = spark.range(20_011).select((F.col("id") * 7919 % 20_011 - 5).alias("id"), F.lit("chat").alias("target"), F.lit("r").alias("request"))
    rows, waves = dealt(ids.repartition(3), 2000)
    assert waves == 11
    assert rows.where(F.floor((F.col("id") + 5) / 2000) != F.col("wave")).count() == 0 and rows.count() == 20_011


def test_no_request_no_wave_but_one(spark):
    rows, waves = dealt(spark.createDataFrame([], "id long, target string, request string"), 5)
    assert (rows.count(), waves) == (0, 1)
