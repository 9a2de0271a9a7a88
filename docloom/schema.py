"""Table schemas (as DDL), statuses and settings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NEW, PROCESSING, DONE, ERROR = range(4)
#: The retry count of tasks that are never taken again, and messages of two outcomes.
TERMINAL_RETRIES = 9999
EMPTY_MESSAGE, MISSING_MESSAGE = "The extracted text is empty", "The source file is missing"

QUEUE = (
    "id long, file_id string, file_name string, status int, locked_by string, locked_at timestamp, claim_token string, error_message string, "
    "retry_count int, next_attempt_at timestamp, parsed_text string, created_at timestamp, updated_at timestamp"
)
RESULTS = "doc_id long, file_id string, file_name string, xml_data string, created_by string, created_at timestamp"
OUTCOMES = "id long, locked_by string, claim_token string, outcome string, error string, delay_seconds int, xml_data string"
#: What was read for tasks that are tried again, where the queue doesn't carry it.
TEXTS = "id long, parsed_text string"
ATTEMPTS = "task_id long, ts timestamp, seq long, outcome string, error string, instance string"
#: What a round saw of OCR servers (event: transport, refusal, green or success) and of the model (ok: whether it answered).
SERVER_EVENTS = "server string, ts timestamp, seq long, event string"
MODEL_CALLS = "server string, ts timestamp, seq long, ok boolean"

#: The header of a document; all leaves are text.
_PARTY = "Country: string, Name: string, Address: string, INN: string, Phones: struct<Phone: array<string>>"
HEADER = (
    "Header struct<DocumentType: string, RelatedDocument: string, Date: string, Number: string, OrderDate: string, OrderNumber: string, CopyNumber: string, Summa: string, NDS: string, Currency: string>, "
    f"Parties struct<Company: struct<{_PARTY}, Role: string, Phone: string, SignatoryCompany: string>, Counterparties: struct<Counterparty: array<struct<{_PARTY}, SignatoryCounterparty: string>>>>"
)


@dataclass(frozen=True)
class Settings:
    """Deployed values; all can be changed."""

    batch: int | None = 16  # None: every task that can be claimed
    slots: int = 20
    max_retries: int = 2
    stale_seconds: int = 3600
    retry_delay_seconds: int = 60
    lookback_days: int = 4
    min_text_length: int = 20
    heavy_mb: int = 10
    heavy_batch: int = 5
    ocr_max_mb: int = 12
    max_text_chars: int = 40_000
    poison_retries: int = 3
    zombie_retries: int = 10
    outage_minutes: int = 10
    idle_minutes: int = 60
    breaker_failures: int = 3
    breaker_pause_seconds: int = 60
    ocr_cooldown_seconds: int = 30
    ocr_tries: int = 3
    llm_tries: int = 2
    llm_at_once: int = 6
    calls_per_slot: int | None = 1  # in one wave of calls; None: all in one wave
    llm_slot_wait_ms: int = 120_000
    llm_backoff_ms: int = 2000
    ocr_in_flight: int = 4
    slow_response_ms: int = 60_000
    slow_parse_ms: int = 10_000
    max_tokens: int = 20_000
    header_retry_seconds: int = 60
    full_pool_retry_seconds: int = 10


def repeats(table: DataFrame, *keys: str) -> DataFrame:
    """Keys that break uniqueness, with their counts; empty if the table is sound."""
    return table.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
