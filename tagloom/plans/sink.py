"""Tables of a database: creation, staging, and one commit for all of them.

The rows of all loads of a table are in one table of ``<database>__data``, partitioned by load. What
users read are views that keep the rows of the current load. Which load that is stands in the
manifest, a folder of numbered one-line files whose last one counts. Views look it up when a query
runs; a query over several views looks it up once, so it never mixes loads.

A load writes partitions that no view shows, then creates the manifest file with the next number. Of
loads that began at the same number, only one can create it; the others are refused.
That one file switches all tables. The rows of the load before stay for open readers until the
next load or `vacuum`.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tagloom.errors import IngestError
from tagloom.spec import Registry, TableSpec

LOAD = "load_id"
MAX_RECORDS_LIMIT = 1_000_000
#: A manifest line: the number, padded so that lines sort as numbers do, and the load.
_DIGITS = 12


def check_max_records(value: int | None) -> None:
    if value is not None and not 1 <= value <= MAX_RECORDS_LIMIT:
        raise IngestError(f"max_records_per_file must be in 1..{MAX_RECORDS_LIMIT}, got {value}")


def create_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")


def create_table(spark: SparkSession, database: str, spec: TableSpec) -> None:
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{database}`.`{spec.name}` ({spec.column_sql()}) USING parquet"
    )


def create_tables(spark: SparkSession, database: str, registry: Registry) -> None:
    """Every known table, empty where it does not exist yet."""
    create_database(spark, database)
    for spec in registry:
        create_table(spark, database, spec)


def replace_partition(rows: DataFrame, table: str, part: dict[str, str | int]) -> None:
    """Write `rows` as one partition of `table`; written again, they replace themselves."""
    named = ", ".join(f"{k} = '{v}'" if isinstance(v, str) else f"{k} = {v}" for k, v in part.items())
    rows.sparkSession.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION ({named}) SELECT * FROM {{rows}}", rows=rows
    )


# --- the manifest ------------------------------------------------------------


@dataclass(frozen=True)
class Version:
    """What the manifest says: its last number, and the load that is current, if any."""

    number: int
    load: str | None


def _manifest(spark: SparkSession, database: str) -> str:
    described = spark.sql(f"DESCRIBE DATABASE `{database}`")
    location = described.filter("info_name = 'Location'").first().info_value.rstrip("/")
    return f"{location}__manifest"


def current(spark: SparkSession, database: str) -> Version:
    """The current version; a database without one gets a manifest that names no load."""
    folder = _manifest(spark, database)
    _create(spark, folder, 0, "")
    last = spark.read.text(folder).agg({"value": "max"}).first()[0]
    return Version(int(last[:_DIGITS]), last[_DIGITS + 1 :] or None)


def commit(spark: SparkSession, database: str, seen: Version, load: str) -> None:
    """Make `load` current, unless another load has become so since `seen`."""
    if not _create(spark, _manifest(spark, database), seen.number + 1, load):
        raise IngestError(f"another load of {database} was published since this one began; load again")


def new_load(seen: Version) -> str:
    """The name of a load that begins at `seen`: the number it wants, and something of its own."""
    return f"{seen.number + 1:0{_DIGITS}d}-{uuid.uuid4().hex[:8]}"


def _number(load: str) -> int:
    return int(load.split("-")[0])


def _create(spark: SparkSession, folder: str, number: int, load: str) -> bool:
    """Create one manifest file, all of it or nothing; False if there is one of that number."""
    name, line = f"{number:0{_DIGITS}d}", f"{number:0{_DIGITS}d} {load}\n"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if store.exists(path):
        return False
    store.mkdirs(path.getParent())
    if store.getScheme() == "file":
        local = path.toUri().getPath()
        made = f"{os.path.dirname(local)}/.{name}-{uuid.uuid4().hex}"
        with open(made, "x") as file:
            file.write(line)
        try:
            os.link(made, local)  # fails if there is one
        except FileExistsError:
            return False
        finally:
            os.unlink(made)
        return True
    try:  # without overwriting; until it is closed the file is empty, and the number before counts
        stream = store.create(path, False)
    except Exception as error:  # noqa: BLE001 - raised again unless it says that the file is there
        if store.exists(path):
            return False
        raise error
    stream.write(line.encode())
    stream.close()
    return True


# --- tables of loads ---------------------------------------------------------


def _data(database: str) -> str:
    return f"{database}__data"


def _held(table: DataFrame, name: str) -> str:
    """The name of the data table for such columns; other columns, another table."""
    return f"{name}__{zlib.crc32(','.join(f'{c} {k}' for c, k in table.dtypes).encode()):08x}"


def write_table(table: DataFrame, database: str, name: str, load: str, max_records: int | None) -> None:
    """The rows of one table as a partition of `load`, which nobody sees yet; an empty one is created too."""
    spark, data = table.sparkSession, _data(database)
    create_database(spark, data)
    full = f"`{data}`.`{_held(table, name)}`"
    columns = ", ".join(f"`{c}` {kind}" for c, kind in table.dtypes)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {full} ({columns}, {LOAD} string) USING parquet PARTITIONED BY ({LOAD})")
    location = spark.sql(f"DESCRIBE TABLE EXTENDED {full}").filter("col_name = 'Location'").first().data_type
    writer = table.write.mode("errorifexists")
    if max_records is not None:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.parquet(f"{location}/{LOAD}={load}")
    spark.sql(f"ALTER TABLE {full} ADD IF NOT EXISTS PARTITION ({LOAD} = '{load}')")


def _tables(spark: SparkSession, database: str) -> list[str]:
    if not spark.catalog.databaseExists(_data(database)):
        return []
    return [t.name for t in spark.catalog.listTables(_data(database)) if re.search("__[0-9a-f]{8}$", t.name)]


def _loads(spark: SparkSession, database: str, table: str) -> set[str]:
    found = spark.sql(f"SHOW PARTITIONS `{_data(database)}`.`{table}`").collect()
    return {r.partition.split("=", 1)[1] for r in found}


def refuse_existing(spark: SparkSession, database: str, registry: Registry) -> None:
    """Fail if there are tables that a load would replace."""
    if not spark.catalog.databaseExists(database):
        return
    present = [n for n in registry.names() if spark.catalog.tableExists(f"`{database}`.`{n}`")]
    if present and (current(spark, database).load or not all(_is_view(spark, database, n) for n in present)):
        raise IngestError(f"{database} already has {present}; pass overwrite=True to replace them")


def _is_view(spark: SparkSession, database: str, name: str) -> bool:
    return spark.catalog.getTable(f"`{database}`.`{name}`").tableType == "VIEW"


def publish(spark: SparkSession, database: str, names: list[str], load: str, seen: Version) -> None:
    """Make `load` the current one of all tables."""
    held = _tables(spark, database)
    for name in names:
        with_load = {t: _loads(spark, database, t) for t in held if t.rpartition("__")[0] == name}
        own = [t for t, loads in with_load.items() if load in loads]
        if not own:  # a load published meanwhile has dropped it
            break
        before = [t for t, loads in with_load.items() if t not in own and seen.load in loads]
        _show(spark, database, name, own[0], before)
    commit(spark, database, seen, load)


def _show(spark: SparkSession, database: str, name: str, own: str, others: list[str]) -> None:
    """The view of a table: rows of the current load, from its data table or those with the columns of earlier loads.

    A view is replaced before its load is current, so it must go on showing the one before.
    """
    if spark.catalog.tableExists(f"`{database}`.`{name}`") and not _is_view(spark, database, name):
        raise IngestError(f"{database}.{name} exists but was not written by an ingest run")
    data, folder = _data(database), _manifest(spark, database).replace("`", "``")
    wanted = f"{LOAD} = (SELECT substring(max(value), {_DIGITS + 2}) FROM text.`{folder}`)"
    columns = [(c, k) for c, k in spark.table(f"`{data}`.`{own}`").dtypes if c != LOAD]
    parts = []
    for table in [own, *others]:
        known = dict(spark.table(f"`{data}`.`{table}`").dtypes)
        shown = [f"`{c}`" if known.get(c) == k else f"CAST(NULL AS {k}) AS `{c}`" for c, k in columns]
        parts.append(f"SELECT {', '.join(shown)} FROM `{data}`.`{table}` WHERE {wanted}")
    spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS {' UNION ALL '.join(parts)}")


def read_version(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """All tables of the current load by name; later loads do not change what these frames read."""
    version = current(spark, database)
    found = {}
    for table in _tables(spark, database):
        if version.load in _loads(spark, database, table):
            rows = spark.table(f"`{_data(database)}`.`{table}`")
            found[table.rpartition("__")[0]] = rows.filter(rows[LOAD] == version.load).drop(LOAD)
    return found


def discard(spark: SparkSession, database: str, load: str) -> None:
    """Remove what a load has written that is not to be published."""
    for table in _tables(spark, database):
        spark.sql(f"ALTER TABLE `{_data(database)}`.`{table}` DROP IF EXISTS PARTITION ({LOAD} = '{load}')")


def vacuum(spark: SparkSession, database: str) -> None:
    """Drop the rows of all loads but the current one; who still reads those will fail."""
    drop_loads(spark, database, {current(spark, database).load})


def drop_loads(spark: SparkSession, database: str, keep: set[str | None]) -> None:
    """Drop the published loads not in `keep`, and those that can no longer be published."""
    newest = max((_number(load) for load in keep if load), default=0)
    for table in _tables(spark, database):
        for load in _loads(spark, database, table) - keep:
            if _number(load) <= newest:
                spark.sql(f"ALTER TABLE `{_data(database)}`.`{table}` DROP IF EXISTS PARTITION ({LOAD} = '{load}')")
