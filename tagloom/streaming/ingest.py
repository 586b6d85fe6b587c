"""Ingest of newly arrived files with Structured Streaming."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tagloom.errors import IngestError
from tagloom.operators.quality import findings
from tagloom.operators.typed import good_rows, rejected_rows
from tagloom.plans.events import record_events
from tagloom.plans.ingest import (
    QUARANTINE,
    STRICT,
    TEXT,
    ZIP,
    Source,
    faults,
    raise_on_errors,
    stage,
)
from tagloom.plans.sink import create_database, replace_partition
from tagloom.plans.workspace import new_run_id, work_folder
from tagloom.sources.archive import ZIP_GLOB
from tagloom.spec import Registry, default_registry
from tagloom.streaming.compact import BATCH, STREAM, finish

_FILES = "path string, modificationTime timestamp, length bigint, content binary"
_REJECT_COLUMNS = (
    "source string, violations array<struct<rule:string,column:string,value:string>>, row_xml string, "
    "offset bigint, line bigint"
)


def ingest_stream(
    spark: SparkSession,
    directory: str,
    database: str,
    checkpoint: str,
    *,
    kind: str = TEXT,
    prefix: str | None = None,
    registry: Registry | None = None,
    mode: str = QUARANTINE,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Append the XML files or archives arriving in `directory` to the tables of `database`.

    A file is the unit of arrival: the stream carries names, and a micro-batch reads its
    own files just as `ingest` does. Tables are partitioned by stream and micro-batch, and a
    repeated batch replaces its own partition, so every file is loaded once even where a
    batch fails half way. The name of a stream is kept in its checkpoint: other streams
    into the same database, and this one with a new checkpoint, add to its rows. `compact` merges
    the partitions of old batches.
    """
    registry = registry or default_registry()
    _create_tables(spark, database, registry)
    finish(spark, database)
    stream_id = _stream_id(spark, checkpoint)
    reader = spark.readStream.format("binaryFile").schema(_FILES)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if kind == ZIP:
        reader = reader.option("pathGlobFilter", ZIP_GLOB)
    arriving = reader.load(directory).select("path")

    def load(batch: DataFrame, batch_id: int) -> None:
        files = [r.path for r in batch.collect()]
        if files:
            source = Source(files, kind, prefix=prefix)
            _load_batch(batch.sparkSession, source, stream_id, batch_id, database, registry, mode)
        # a batch runs in a session of its own; let the caller's see the new files
        for name in registry.names():
            spark.catalog.refreshTable(f"`{database}`.`{name}`")
            spark.catalog.refreshTable(f"`{database}`.`{name}__rejects`")

    writer = arriving.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The name of the stream of a checkpoint, made up when the checkpoint is new."""
    path = f"{checkpoint.rstrip('/')}/tagloom_stream"
    try:
        return spark.read.text(path).first().value
    except AnalysisException:
        name = new_run_id()
        spark.createDataFrame([(name,)], "value string").coalesce(1).write.text(path)
        return name


def _load_batch(
    spark: SparkSession,
    source: Source,
    stream_id: str,
    batch_id: int,
    database: str,
    registry: Registry,
    mode: str,
) -> None:
    part = {STREAM: stream_id, BATCH: batch_id}
    with work_folder(spark) as work:
        typed, counted = stage(spark, source, registry, work)
        bad = faults(typed, counted, work)
        found = findings(counted, bad, registry)
        events = record_events(spark, database, f"stream-{stream_id}-{batch_id}", found)
        if mode == STRICT:
            raise_on_errors(events)
        for spec in registry:
            table = f"`{database}`.`{spec.name}"
            replace_partition(good_rows(typed, spec), f"{table}`", part)
            replace_partition(rejected_rows(bad, spec, registry), f"{table}__rejects`", part)


def _create_tables(spark: SparkSession, database: str, registry: Registry) -> None:
    create_database(spark, database)
    for spec in registry:
        _create_table(spark, database, spec.name, spec.column_sql())
        _create_table(spark, database, f"{spec.name}__rejects", _REJECT_COLUMNS)


def _create_table(spark: SparkSession, database: str, name: str, columns: str) -> None:
    table = f"`{database}`.`{name}`"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {STREAM} string, {BATCH} bigint) "
        f"USING parquet PARTITIONED BY ({STREAM}, {BATCH})"
    )
    if STREAM not in spark.table(table).columns:
        raise IngestError(f"{table} was not created by a stream; use another database")
