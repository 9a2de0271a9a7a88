"""The registered queries of the document engine, each with SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docloom.plans import documents, logs, rounds, service, tasks

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = tasks.QUERIES | documents.QUERIES | logs.QUERIES | rounds.QUERIES | service.QUERIES
ORACLE: dict[str, str] = tasks.ORACLE | documents.ORACLE | logs.ORACLE | rounds.ORACLE | service.ORACLE
