"""Stand-ins for the queue, the catalog and the logs, derived from the driver's tables by the same text in both engines.

They are fixtures: the tables that this engine works on aren't among the driver's.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NOW = "2024-01-31 00:00:00"
KIND = "kind-a"

#: name -> SQL over the driver's tables.
TABLES = {
    "vqueue": """select event_id as id, cast(user_id as string) as file_id, concat('doc_', cast(event_id as string), '.docx') as file_name, cast(event_id % 4 as int) as status,
        ts as created_at, cast(case when event_id % 11 = 0 then 9999 else event_id % 5 end as int) as retry_count,
        case when event_id % 13 = 0 then null when event_id % 7 < 3 then ts + interval '1' hour when event_id % 7 < 5 then ts + interval '1' day else timestamp '2024-01-30 23:59:30' end as updated_at,
        case when event_id % 13 = 1 then null when event_id % 7 < 4 then ts + interval '2' hour else timestamp '2024-01-30 23:30:00' end as locked_at,
        case when event_id % 5 = 0 then timestamp '2024-01-31 06:00:00' when event_id % 5 = 1 then ts + interval '1' day end as next_attempt_at,
        concat('w', cast(event_id % 3 as string)) as locked_by, concat('t', cast(event_id % 2 as string)) as claim_token,
        case when event_id % 4 = 3 then concat('error ', cast(event_id as string)) end as error_message, case when event_id % 3 = 0 then concat('text ', cast(event_id as string)) end as parsed_text
        from events""",
    "vearlier": """select id, cast(cast(file_id as bigint) * 3 as string) as file_id, file_name, status, created_at, retry_count, updated_at, locked_at, next_attempt_at, locked_by, claim_token, error_message, parsed_text from vqueue""",
    "vdense": """select user_id % 40 as task_id, timestamp '2024-01-01 00:00:00' + interval '1' second * (event_id * 20) as ts, event_id as seq, case when event_type = 'error' or event_id % 3 < 2 then 'transient' when event_id % 97 = 0 then 'done' when event_type = 'signup' then 'failed' else 'other' end as outcome,
        case when user_id % 4 = 0 or event_id % 5 = 0 then 'OCR: IsSuccess=false, damaged file' else 'connection failed' end as error, concat('i', cast(user_id % 2 as string)) as instance from events""",
    "voutcomes": """select case when event_id % 3 < 2 then event_id else event_id + 1000000000000 end as id, concat('w', cast(event_id % 3 as string)) as locked_by, concat('t', cast(case when event_id % 9 = 0 then 7 else event_id % 2 end as string)) as claim_token,
        case event_id % 8 when 0 then 'done' when 1 then 'failed' when 2 then 'empty' when 3 then 'transient' when 4 then 'rejected' when 5 then 'missing' when 6 then 'heartbeat' else 'done' end as outcome,
        case when event_id % 5 = 0 then null else concat(repeat('x', cast(event_id % 700 as int)), ' failed') end as error, cast(60 + event_id % 60 as int) as delay_seconds,
        concat('<Document>', cast(event_id as string), '</Document>') as xml_data from events""",
    "vfiles": """select cast(doc_id as string) as file_id, concat('doc_', cast(doc_id as string), case doc_id % 8 when 0 then '.docx' when 1 then '.DOC' when 2 then '.pdf' when 3 then '.txt' when 4 then '' when 5 then '.Pdf '
        when 6 then ' Печатная форма.pdf' else '.tar.gz' end) as file_name, text, n_chars from documents""",
    "vlog": """select user_id as task_id, ts, event_id as seq, case event_type when 'error' then 'transient' when 'purchase' then 'done' when 'signup' then 'failed' else 'other' end as outcome,
        case when event_type = 'error' then case when event_id % 3 = 0 then 'OCR: IsSuccess=false, damaged file' else 'connection failed' end end as error, concat('i', cast(user_id % 3 as string)) as instance from events""",
    "vcalls": """select event_id as seq, user_id as doc_id, ts, concat('app', cast(user_id % 6 as string)) as server,
        case event_id % 7 when 0 then 'transport' when 1 then 'refusal' when 2 then 'green' else 'success' end as event, event_id % 4 <> 0 as ok, value,
        cast(floor(value * 100) as bigint) as elapsed_ms, cast(event_id % 300 - 20 as bigint) as prompt_tokens, cast(event_id % 90 - 10 as bigint) as completion_tokens from events""",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stand-in table, or one of the driver's."""
    if name not in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = TABLES[name]
    source = re.search(r"from (\w+)", text)[1]
    found = spark.sql(re.sub(rf"from {source}\b", "from {source_table}", text), source_table=view(spark, sf_dir, source))
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c, kind in found.dtypes if kind == "timestamp"})


def ctes(*names: str) -> str:
    """The stand-ins as common table expressions."""
    return "with " + ",\n".join(f"{n} as ({TABLES[n]})" for n in names)


def now() -> Column:
    return F.lit(NOW).cast("timestamp_ntz")
