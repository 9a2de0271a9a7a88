from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

HERE = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, HERE)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [HERE, os.environ.get("PYTHONPATH")]))  # for Python workers


@pytest.fixture(scope="session")
def spark(tmp_path_factory: pytest.TempPathFactory):
    from pyspark.sql import SparkSession

    os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
    work = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(work / "warehouse"))
        .config("spark.checkpoint.dir", str(work / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
