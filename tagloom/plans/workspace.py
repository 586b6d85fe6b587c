"""Where intermediate tables live."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tagloom.errors import IngestError


def shared_folder(spark: SparkSession) -> str:
    """The folder every node sees: `spark.checkpoint.dir`, or the warehouse where that is unset.

    A warehouse on the driver's own disk will not do on a cluster.
    """
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if (warehouse.startswith("file:") or "://" not in warehouse) and not spark.sparkContext.master.startswith("local"):
        raise IngestError("set spark.checkpoint.dir to a folder that all nodes share")
    return warehouse


#: Options of the files in work folders.
CLOSELY = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}


def new_run_id() -> str:
    return uuid.uuid4().hex[:12]


def new_work_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tagloom_work_{new_run_id()}"


def store(frame: DataFrame, work: str, name: str) -> DataFrame:
    """Write a table into a work folder and read it back.

    What is written there survives the loss of executors, and later steps start
    from the written files instead of the sources. Nobody else reads them, so they are packed more closely than
    tables: ascending numbers as differences.
    """
    path = f"{work}/{name}"
    frame.write.options(**CLOSELY).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@contextmanager
def work_folder(spark: SparkSession) -> Iterator[str]:
    """A folder for the tables of one run in the shared folder; removed at the end."""
    work = new_work_folder(spark)
    try:
        yield work
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(work)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
_lock = threading.Lock()
#: By session: how many loads are under way, and the setting to go back to after the last.
_small: dict[str, tuple[int, str]] = {}


@contextmanager
def small_methods(spark: SparkSession) -> Iterator[None]:
    """Keep generated methods small enough for the JVM to compile to machine code.

    HotSpot leaves methods over 8000 bytes interpreted, while Spark by default
    fuses operators up to 64 KB. A registry with many columns passes the former
    limit; Spark then runs the typing projections faster as operators of their own. Loads of one
    session at the same time share the setting; the last one puts it back.
    """
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        loads, before = _small.get(session) or (0, spark.conf.get(_METHOD_LIMIT))
        _small[session] = loads + 1, before
        spark.conf.set(_METHOD_LIMIT, "8000")
    try:
        yield
    finally:
        with _lock:
            loads, before = _small.pop(session)
            if loads > 1:
                _small[session] = loads - 1, before
            else:
                spark.conf.set(_METHOD_LIMIT, before)
