"""The event table of a database: what each run loaded, skipped and refused."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tagloom.plans.sink import replace_partition
from tagloom.spec import Registry

EVENTS = "ingest_events"
_COLUMNS = (
    "created timestamp, level string, source string, table_name string, rule string, "
    "column_name string, occurrences bigint, sample string, offset bigint, line bigint, run_id string"
)


def record_events(spark: SparkSession, database: str, run_id: str, findings: DataFrame) -> DataFrame:
    """Store `findings` under `run_id` and return them as stored.

    One partition per run: a repeated run replaces its own events.
    """
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{database}`.`{EVENTS}` ({_COLUMNS}) USING parquet "
        "PARTITIONED BY (run_id)"
    )
    events = findings.select(
        F.current_timestamp().alias("created"),
        "level",
        "source",
        "table_name",
        "rule",
        "column_name",
        F.col("occurrences").cast("bigint").alias("occurrences"),
        "sample",
        "offset",
        "line",
    )
    replace_partition(events, f"`{database}`.`{EVENTS}`", {"run_id": run_id})
    return read_events(spark, database).filter(F.col("run_id") == run_id)


def read_events(spark: SparkSession, database: str, level: str | None = None) -> DataFrame:
    events = spark.table(f"`{database}`.`{EVENTS}`")
    return events if level is None else events.filter(F.col("level") == level)


def rows_by_table(spark: SparkSession, events: DataFrame, registry: Registry) -> DataFrame:
    """(table_name, rows) of every known table and of all together as ``(total)``."""
    loaded = (
        events.filter(F.col("rule") == "rows_loaded")
        .groupBy("table_name")
        .agg(F.sum("occurrences").alias("n"))
    )
    names = spark.createDataFrame([(n,) for n in registry.names()], "table_name string")
    return (
        names.join(loaded, "table_name", "left")
        .rollup("table_name")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
        .select(F.coalesce("table_name", F.lit("(total)")).alias("table_name"), "rows")
    )
