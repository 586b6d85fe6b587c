from __future__ import annotations

import sys
import tempfile
import uuid
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="run-")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", f"{folder}/shared")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def database(spark):
    name = f"db_{uuid.uuid4().hex[:12]}"
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


@pytest.fixture
def write(tmp_path):
    """Write documents and return their folder."""

    def write_documents(*documents: str | bytes, suffix: str = ".xml") -> str:
        folder = tmp_path / uuid.uuid4().hex[:8]
        folder.mkdir()
        for number, document in enumerate(documents):
            data = document.encode() if isinstance(document, str) else document
            (folder / f"d{number}{suffix}").write_bytes(data)
        return str(folder)

    return write_documents
