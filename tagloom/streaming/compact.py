"""Compaction of the partitions that micro-batches leave behind.

Consecutive batches of a stream are packed by size into one partition of about the wanted size, that of
the last of them. The newest batch is left alone, as a stream may repeat it; all older ones are committed, so
no batch that could still replace its partition is touched.

What is to be switched is written into a ledger first. If a compaction fails between its
steps, the next one, or the next start of a stream into the database, finishes it from there: every step can be
done twice. Within the two catalog calls that switch a partition a reader may meet rows twice.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tagloom.plans.sink import replace_partition

LEDGER = "stream_ledger"
PLANNED, SWITCHED = "planned", "switched"
STREAM, BATCH = "stream_id", "batch_id"
_COLUMNS = (
    "table_name string, stream_id string, batches array<bigint>, bytes bigint, location string, old_location string, "
    "state string, entry string"
)
TARGET_BYTES = 128 << 20


def compact(spark: SparkSession, database: str, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Merge small batches of all stream tables of `database`; return the ledger entries of this run.

    (table_name, stream_id, batches, bytes, location, old_location, state, entry). Nothing is merged where
    partitions are as large as wanted; running it again right away changes nothing.
    """
    finish(spark, database)
    made = []
    for table in _stream_tables(spark, database):
        for stream, batches in _batches(spark, table).items():
            sizes = {b: _bytes(spark, _location(spark, table, stream, b)) for b in batches[:-1]}
            for group in packed(sizes, target_bytes):
                made.append(_merge(spark, database, table, stream, group, sum(sizes[b] for b in group), target_bytes))
    return _ledger(spark, database).filter(F.col("entry").isin(made))


def packed(sizes: dict[int, int], target: int) -> list[list[int]]:
    """Runs of consecutive batches of `target` bytes at most, where there are several in one."""
    runs: list[list[int]] = []
    total = 0
    for batch in sorted(sizes):
        if not runs or total + sizes[batch] > target:
            runs.append([])
            total = 0
        runs[-1].append(batch)
        total += sizes[batch]
    return [run for run in runs if len(run) > 1]


def finish(spark: SparkSession, database: str) -> None:
    """Switch what an earlier compaction has planned and not switched."""
    for entry in _ledger(spark, database).filter(F.col("state") == PLANNED).collect():
        _switch(spark, database, entry.asDict())


def _ledger(spark: SparkSession, database: str) -> DataFrame:
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{LEDGER}` ({_COLUMNS}) USING parquet PARTITIONED BY (entry)")
    return spark.table(f"`{database}`.`{LEDGER}`")


def _record(spark: SparkSession, database: str, entry: dict, state: str) -> None:
    names = ("table_name", STREAM, "batches", "bytes", "location", "old_location")
    schema = _COLUMNS.rpartition(", entry")[0]
    row = spark.createDataFrame([(*(entry[n] for n in names), state)], schema)
    replace_partition(row, f"`{database}`.`{LEDGER}`", {"entry": entry["entry"]})


def _merge(spark: SparkSession, database: str, table: str, stream: str, batches: list[int], size: int, target: int) -> str:
    root = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").first().data_type
    entry = {
        "table_name": table, STREAM: stream, "batches": batches, "bytes": size, "entry": uuid.uuid4().hex,
        "location": f"{root}__compacted/{uuid.uuid4().hex}", "old_location": _location(spark, table, stream, batches[-1]),
    }
    rows = spark.table(table).filter((F.col(STREAM) == stream) & F.col(BATCH).isin(batches)).drop(STREAM, BATCH)
    rows.coalesce(max(1, -(-size // target))).write.parquet(entry["location"])
    _record(spark, database, entry, PLANNED)
    _switch(spark, database, entry)
    return entry["entry"]


def _switch(spark: SparkSession, database: str, entry: dict) -> None:
    table, stream, last = entry["table_name"], entry[STREAM], entry["batches"][-1]
    part = lambda b: f"PARTITION ({STREAM} = '{stream}', {BATCH} = {b})"
    spark.sql(f"ALTER TABLE {table} {part(last)} SET LOCATION '{entry['location']}'")
    _drop(spark, table, [part(b) for b in entry["batches"][:-1]])
    path = spark._jvm.org.apache.hadoop.fs.Path(entry["old_location"])
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    spark.catalog.refreshTable(table)
    _record(spark, database, entry, SWITCHED)


def _drop(spark: SparkSession, table: str, parts: list[str]) -> None:
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(parts)}")


def _stream_tables(spark: SparkSession, database: str) -> list[str]:
    found = []
    for table in spark.catalog.listTables(database):
        name = f"`{database}`.`{table.name}`"
        if table.tableType != "VIEW" and [c.name for c in spark.catalog.listColumns(name) if c.isPartition] == [STREAM, BATCH]:
            found.append(name)
    return found


def _batches(spark: SparkSession, table: str) -> dict[str, list[int]]:
    """Batches that have a partition, by stream, in order."""
    found: dict[str, list[int]] = {}
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        stream, batch = (part.split("=", 1)[1] for part in row.partition.split("/"))
        found.setdefault(stream, []).append(int(batch))
    return {stream: sorted(batches) for stream, batches in found.items()}


def _location(spark: SparkSession, table: str, stream: str, batch: int) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({STREAM} = '{stream}', {BATCH} = {batch})")
    return described.filter("col_name = 'Location'").first().data_type


def _bytes(spark: SparkSession, location: str) -> int:
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return store.getContentSummary(path).getLength() if store.exists(path) else 0
