"""OCR and language-model stages: pluggable clients, answers judged by column expressions, XML validated and repaired.

A client is any picklable object with `ask`. Calls are made in waves (`operators.governed`), their judged answers are
written, so a later step never repeats a call. Tasks may run twice after a lost executor: clients must bear that, and
results count only under a lease (`operators.queue`).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.text import base64_plain, blank, one_line, truncated
from docloom.functions.xml import REPAIRED, framed, repaired, sanitized
from docloom.operators.governed import Client, Limits, Pace, Wall, model_calls, server_calls
from docloom.operators.policy import ENVELOPE_MARKS, exhausted, has_any

#: Parts of a gateway's error pages.
GATEWAY_MARKS = ("Server Connection Error", "Bad Gateway")
COMPLETION = "error struct<message: string>, choices array<struct<finish_reason: string, message: struct<content: string, reasoning_content: string>>>, usage struct<prompt_tokens: int, completion_tokens: int>"


# OCR


def ocr_request(file_name: Column, data: Column) -> Column:
    return F.to_json(F.struct(file_name.alias("FileName"), base64_plain(data).alias("Base64Data")))


def ocr_answer(http_status: Column, body: Column) -> Column:
    """struct(outcome, text, error) of a server's answer.

    Plain text is a text; an envelope holds it in Notes if IsSuccess. An envelope that blames the file is a
    `document_error`, any other failure a `service_refusal`.
    """
    text = F.regexp_replace(body, r"\A\p{javaWhitespace}+|\p{javaWhitespace}+\z", "")
    parsed = F.try_parse_json(text)
    flag = F.try_variant_get(parsed, "$.IsSuccess", "boolean")
    has = F.try_variant_get(parsed, "$.IsSuccess", "string").isNotNull()
    notes = F.coalesce(F.try_variant_get(parsed, "$.Notes", "string"), F.lit(""))
    success = F.coalesce(flag, F.lit(False))
    blames = has_any(one_line(notes), ENVELOPE_MARKS)
    plain, envelope = ~blank(body) & ~F.startswith(text, F.lit("{")), ~blank(body) & F.startswith(text, F.lit("{"))
    outcome = (
        F.when(http_status == 0, "transport_error").when((http_status < 200) | (http_status > 299), "http_error").when(blank(body), "service_refusal").when(plain, "success")
        .when(envelope & success, "success").when(envelope & has & blames, "document_error").otherwise("service_refusal")
    )
    found = F.when(plain, text).when(envelope & success, notes)
    error = (
        F.when(http_status == 0, "connection failed").when((http_status < 200) | (http_status > 299), F.concat(F.lit("HTTP "), http_status.cast("string"))).when(blank(body), "empty answer")
        .when(envelope & has & ~success & blames, F.concat(F.lit("OCR: IsSuccess=false, damaged file: "), one_line(notes))).when(envelope & has & ~success, F.concat(F.lit("IsSuccess=false: "), one_line(notes)))
        .when(envelope & parsed.isNull(), F.concat(F.lit("broken JSON: "), one_line(text))).when(envelope & ~has, F.concat(F.lit("JSON without IsSuccess: "), one_line(text)))
    )
    ok = outcome == "success"
    return F.struct(outcome.alias("outcome"), F.when(ok, found).alias("text"), F.when(~ok, error).alias("error"))


#: How an answer counts for its server's penalties.
SERVER_EVENT = {"transport_error": "transport", "http_error": "transport", "service_refusal": "refusal", "success": "success", "document_error": "success"}


def recognized(files: DataFrame, servers: list[str], client: Client, at_once: int, tries: int = 3, down: tuple[str, ...] = (), cursor: int = 0, limits: Limits | None = None, pace: Pace | None = None) -> tuple[DataFrame, DataFrame]:
    """(texts, attempts) of files (id, file_name, data).

    Servers that are `down` (penalised, or dead to a probe) are passed over, which is no attempt; so are, for the cooldown,
    those that failed in this batch. An attempt asks the next server in the file's rotation. A file that is itself at
    fault settles at once. When no server is left, the error carries the last answer's words and who is up. texts: (id,
    text, error_kind, error); attempts: (id, target, outcome, error, elapsed_ms, attempt, wave, at_ms).
    """
    limits = replace(limits or Limits(per_slot=None), at_once=at_once)
    answer = ocr_answer(F.col("http_status"), F.col("body"))
    judged = {"outcome": answer["outcome"], "text": answer["text"], "error": answer["error"]}
    requests = files.select("id", ocr_request(F.col("file_name"), F.col("data")).alias("request"))
    every, out_of_use = server_calls(requests, servers, client, judged, "outcome string, text string, error string", limits, tries, pace or Wall(), down, cursor, ("success", "document_error"), ("transport_error", "http_error", "service_refusal"))
    line = F.lit(", ".join(f"{s}={'DOWN' if s in out_of_use else 'UP'}" for s in servers))
    last = files.select("id").join(every.groupBy("id").agg(F.max_by(F.struct("outcome", "text", "error"), "attempt").alias("r")), "id", "left")
    outcome = F.coalesce("r.outcome", F.lit("none"))
    kind = F.when(outcome != "success", "ocr_unavailable").when(blank(F.col("r.text")), "empty_ocr")
    error = F.when(outcome == "document_error", F.col("r.error")).when(outcome != "success", exhausted(F.col("r.error"), line))
    return last.select("id", "r.text", kind.alias("error_kind"), error.alias("error")), every.drop("text")


# language model


def assembled_prompt(prompt: str, *endings: str) -> str:
    """The instruction with its fixed endings; a blank one is a fault of the settings."""
    if not prompt.strip():
        raise ValueError("The prompt is blank")
    return "\n".join([prompt.strip(), *endings])


def normalized_type(name: Column, names: dict[str, str]) -> Column:
    """A document type by its usual name, looked up without regard to case and outer blanks; unknown ones stay."""
    key = F.lower(F.trim(name))
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in (pair[0].lower(), pair[1])]) if names else None
    return name if table is None else F.coalesce(F.try_element_at(table, key), name)


def llm_request(model: str, prompt: str, text: Column, temperature: float = 0.1, max_tokens: int = 20_000, max_chars: int = 40_000) -> Column:
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    messages = F.array(message("system", F.lit(prompt)), message("user", truncated(text, max_chars)))
    return F.to_json(F.struct(F.lit(model).alias("model"), messages.alias("messages"), F.lit(temperature).alias("temperature"), F.lit(max_tokens).alias("max_tokens"), F.lit(False).alias("stream")))


def llm_answer(http_status: Column, body: Column, refreshed: Column | None = None, retry_429: bool = False) -> Column:
    """struct(outcome, content, finish_reason, prompt_tokens, completion_tokens, breaker_failure) of a model's answer.

    outcome: ok, transient, permanent or bad_output. 401 and 403 are transient if the token could be refreshed. Other
    4xx are permanent unless a gateway's page; 429 too, as deployed, unless `retry_429`.
    """
    refreshed = F.lit(False) if refreshed is None else refreshed
    auth, gateway = http_status.isin(401, 403), has_any(body, GATEWAY_MARKS)
    limited = http_status == 429
    client_error = (http_status >= 400) & (http_status < 500)
    reply = F.from_json(body, COMPLETION)
    choice = F.get(reply["choices"], F.lit(0))
    finish = F.coalesce(choice["finish_reason"], F.lit(""))
    content = F.when(blank(choice["message"]["content"]), choice["message"]["reasoning_content"]).otherwise(choice["message"]["content"])
    ok = (http_status >= 200) & (http_status < 300)
    outcome = (
        F.when(auth, F.when(refreshed, "transient").otherwise("permanent")).when(client_error & gateway, "transient").when(limited & F.lit(retry_429), "transient").when(client_error, "permanent").when(~ok, "transient")
        .when(reply.isNull() | reply["error"].isNotNull() | choice.isNull(), "transient").when(finish.isin("length", "content_filter"), "bad_output").when(blank(content), "transient").otherwise("ok")
    )
    failure = (auth & ~refreshed) | limited | (client_error & gateway) | (~ok & ~client_error)
    tokens = lambda c: F.coalesce(reply["usage"][c], F.lit(-1))
    return F.struct(outcome.alias("outcome"), F.when(outcome == "ok", content).alias("content"), finish.alias("finish_reason"), tokens("prompt_tokens").alias("prompt_tokens"), tokens("completion_tokens").alias("completion_tokens"), failure.alias("breaker_failure"))


def near_limit(completion_tokens: Column, max_tokens: int = 20_000) -> Column:
    return completion_tokens * 5 >= max_tokens * 4


def slow(elapsed_ms: Column, most_ms: int = 60_000) -> Column:
    return elapsed_ms >= most_ms


def validated(answers: DataFrame, nested: bool = False) -> DataFrame:
    """(id, content) -> (id, xml, fix): the framed header, valid as it is or after a repair; xml is null if none helps."""
    rows = answers.select("id", framed(F.col("content")).alias("xml"))
    rows = rows.withColumn("clean", sanitized(F.col("xml")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [repaired(x, c, nested) if x is not None else (None, None) for x, c in zip(batch.column("xml").to_pylist(), batch.column("clean").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([x for x, _ in got], pa.string()), pa.array([f for _, f in got], pa.string())], names=["id", *REPAIRED.names])

    return rows.mapInArrow(run, "id long, xml string, fix string")


def answer_error(outcome: Column, http_status: Column, body: Column, finish: Column) -> Column:
    """Why an answer is no good, in words."""
    status = F.when(http_status == 0, "Model: connection failed").otherwise(F.concat(F.lit("Model: HTTP "), http_status.cast("string"), F.lit(": "), F.coalesce(one_line(body), F.lit(""))))
    return F.when(outcome == "bad_output", F.concat(F.lit("Model: answer ended by "), finish)).when(outcome != "ok", status)


def with_headers(texts: DataFrame, request: Column, client: Client, at_once: int = 6, tries: int = 2, limits: Limits | None = None, pace: Pace | None = None, failures: int = 0) -> tuple[DataFrame, DataFrame]:
    """(headers, calls) of texts (id, text, ...): transient answers are asked again, up to `tries` times, after a pause.

    headers: (id, xml, error_kind, error, fix); calls: (id, attempt, http_status, outcome, elapsed_ms, prompt_tokens,
    completion_tokens, ok, wave, at_ms), `ok` telling the breaker whether the model answered, null if an answer tells neither. Its outcomes
    paused and no_slot are attempts without a call. `failures` is how many in a row the breaker counts already.
    """
    limits = replace(limits or Limits(per_slot=None), at_once=at_once)
    a = llm_answer(F.col("http_status"), F.col("body"))
    ok = F.when(a["breaker_failure"], False).when(F.col("http_status").between(200, 299), True)
    error = answer_error(a["outcome"], F.col("http_status"), F.col("body"), a["finish_reason"])
    judged = {n: a[n] for n in ("outcome", "content", "prompt_tokens", "completion_tokens")} | {"ok": ok, "error": error}  # the status stays as it is
    every = model_calls(texts.select("id", request.alias("request")), client, judged, "http_status int, outcome string, content string, prompt_tokens int, completion_tokens int, ok boolean, error string", limits, tries, pace or Wall(), failures)
    last = every.groupBy("id").agg(F.max_by(F.struct("outcome", "content", "error"), "attempt").alias("r"))
    valid = validated(last.where("r.outcome = 'ok'").select("id", "r.content"))
    outcome = F.col("r.outcome")
    kind = F.when(outcome.isin("transient", "paused", "no_slot"), "llm_unavailable").when(outcome == "permanent", "llm_permanent").when(F.col("xml").isNull(), "llm_bad_output")
    without = F.when(outcome == "paused", "Model: paused by the breaker").when(outcome == "no_slot", f"Model: no free slot within {limits.slot_wait_ms} ms")
    error = F.coalesce("r.error", without, F.when(F.col("xml").isNull(), F.concat(F.lit("Model: no valid header in: "), one_line(F.col("r.content")))))
    headers = last.join(valid, "id", "left").select("id", "xml", kind.alias("error_kind"), error.alias("error"), "fix")
    return headers, every.select("id", "attempt", "http_status", "outcome", "elapsed_ms", "prompt_tokens", "completion_tokens", "ok", "wave", "at_ms")
