"""A round of processing over a whole table, with services that answer by rule."""

from __future__ import annotations

import json
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators.governed import Stepped
from docloom.plans.documents import docx_bytes
from docloom.plans.pdfs import pdf_bytes
from docloom.plans.pipeline import History, Services, run_round
from docloom.plans.virtual import NOW, view
from docloom.schema import ATTEMPTS, MODEL_CALLS, QUEUE, RESULTS, SERVER_EVENTS, Settings
from docloom.sources.scratch import kept

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class RuledOcr:
    """Server `dead` takes no connection; the others blame files named damaged and read all else."""

    def ask(self, target: str, request: str) -> tuple[int, str | None, int]:
        if target == "dead":
            return 0, None, 1
        if json.loads(request)["FileName"].startswith("damaged"):
            return 200, '{"IsSuccess":false,"Notes":"InvalidPdfException"}', 2
        return 200, '{"IsSuccess":true,"Notes":"The text of a scanned page."}', 3


class RuledModel:
    """A header with one closing tag missing; none for texts with the word `overload`, which get a server error."""

    def ask(self, target: str, request: str) -> tuple[int, str | None, int]:
        if "overload" in json.loads(request)["messages"][1]["content"][:40]:
            return 503, "busy", 4
        content = "```xml\n<Document><Header><Name>x</Header></Document>```"
        return 200, json.dumps({"choices": [{"finish_reason": "stop", "message": {"content": content}}], "usage": {"prompt_tokens": 3, "completion_tokens": 4}}), 5


_KINDS = ["rtf", "docx", "scan", "damaged", "gone", "overload", "short", "cut"]

_SQL = """with d as (select doc_id as id, doc_id % 8 as k, '<Document><Header><Name>x</Name></Header></Document>' || chr(10) as header from documents)
select id, case k when 0 then 'rejected' when 1 then 'done' when 2 then 'done' when 3 then 'rejected' when 4 then 'missing' when 5 then 'transient' when 6 then 'empty' else 'failed' end as outcome,
 case k when 0 then 'Unsupported format RTF' when 3 then 'Poison document: OCR: IsSuccess=false' when 5 then 'Model: HTTP 503: busy' when 7 then 'not a word document' end as error,
 cast(case when k in (1, 2) then 2 when k = 5 then 0 else 3 end as int) as status, case when k = 5 then true end as waits,
 case k when 1 then header || 'A long enough text of number ' || id || chr(10) when 2 then header || 'The text of a scanned page.' end as xml_data from d"""


def round_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a task of one round: what each ends as, by the round's own attempts and the history before it."""
    ids = view(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    kind = F.element_at(F.array(*map(F.lit, _KINDS)), (F.col("id") % 8 + 1).cast("int"))
    name = F.concat(kind, F.lit("-"), F.col("id").cast("string"))
    now = F.lit(NOW).cast("timestamp")
    columns = {"id": F.col("id"), "file_id": name, "file_name": name, "status": F.lit(0), "retry_count": F.lit(0), "created_at": now}
    fields = [c.split() for c in QUEUE.split(", ")]
    tasks = ids.select(*[columns.get(c, F.lit(None)).cast(t).alias(c) for c, t in fields])
    files = ids.select(name.alias("file_id"), name.alias("file_name"), name.alias("binary_id"))

    def run(batches):
        for b in batches:
            def data(i: int) -> bytes:
                texts = {1: f"A long enough text of number {i}", 5: "overload of a long enough text", 6: "short"}
                whole = docx_bytes([texts.get(i % 8, "x")])
                return b"{\\rtf1" if i % 8 == 0 else pdf_bytes([]) if i % 8 in (2, 3) else whole[:40] if i % 8 == 7 else whole

            rows = b.column("id").to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([f"{'elsewhere' if i % 8 == 4 else _KINDS[i % 8]}-{i}" for i in rows]), pa.array([data(i) for i in rows], pa.binary())], names=["id", "data"])

    binaries = kept(ids.mapInArrow(run, "id string, data binary"), "round-binaries")
    # each damaged file failed twice before, an hour ago a server took no connection, and the instance works
    ago = lambda minutes: now - F.make_dt_interval(mins=F.lit(minutes))
    error = F.lit("OCR: IsSuccess=false, damaged file: InvalidPdfException")
    row = lambda rows, task, minutes, outcome, error: rows.select(task.alias("task_id"), ago(minutes).alias("ts"), F.lit(1).cast("long").alias("seq"), F.lit(outcome).alias("outcome"), error.cast("string").alias("error"), F.lit("w").alias("instance"))
    bad = ids.where("id % 8 = 3")
    attempts = row(bad, F.col("id"), 20, "transient", error).unionByName(row(bad, F.col("id"), 10, "transient", error))
    for minutes in (21, 11, 1):
        attempts = attempts.unionByName(row(spark.range(1), F.lit(-1).cast("long"), minutes, "done", F.lit(None)))
    events = spark.createDataFrame([], SERVER_EVENTS).unionByName(spark.range(1).select(F.lit("dead").alias("server"), ago(60).alias("ts"), F.lit(1).cast("long").alias("seq"), F.lit("transport").alias("event")))
    history = History(spark.createDataFrame([], ATTEMPTS).unionByName(attempts), events, spark.createDataFrame([], MODEL_CALLS))
    services = Services(ocr=RuledOcr(), ocr_servers=("dead", "well", "fine"), llm=RuledModel(), at_once=4, pace=Stepped())
    done = run_round(tasks, spark.createDataFrame([], RESULTS), files, binaries, services, "w", "token", now, Settings(batch=None, calls_per_slot=None), history)
    found = done.outcomes.join(done.queue.select("id", "status"), "id").join(done.results.select(F.col("doc_id").alias("id"), F.col("xml_data").alias("stored")), "id", "left")
    start = lambda text: F.when(F.startswith(F.col("error"), F.lit(text)), F.lit(text))
    words = F.coalesce(*map(start, ("Unsupported format RTF", "Poison document: OCR: IsSuccess=false", "Model: HTTP 503: busy", "not a word document")))
    return found.select("id", "outcome", words.alias("error"), "status", F.when(F.col("outcome") == "transient", F.col("delay_seconds").between(30, 60)).alias("waits"), F.col("stored").alias("xml_data"))


QUERIES["round_outcomes"] = round_outcomes
ORACLE["round_outcomes"] = _SQL
