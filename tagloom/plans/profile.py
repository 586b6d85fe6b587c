"""Profile of documents without loading them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tagloom.operators.places import unknown_runs
from tagloom.operators.rows import OK, OUTSIDE
from tagloom.plans.ingest import Source, survey
from tagloom.plans.workspace import new_work_folder
from tagloom.spec import Registry, default_registry


def profile(spark: SparkSession, source: Source, registry: Registry | None = None) -> DataFrame:
    """(source, tag, known, rows, elements, faults) per source and row tag.

    `tag` is NULL for what stands outside rows. `elements` counts every element
    at any depth; over all lines of a source it is the total of the document. `faults`
    counts rows and documents that are not well formed. Doubtful documents are read as a whole,
    as for a load; no values are typed. The result reads counts from the shared folder.
    """
    registry = registry or default_registry()
    _, counted = survey(spark, source, registry, new_work_folder(spark))
    fault = ~F.col("status").isin(OK, OUTSIDE)
    return (
        counted.groupBy("source", "tag")
        .agg(
            F.sum(F.when(F.col("tag").isNotNull(), F.col("n")).otherwise(0)).alias("rows"),
            F.sum("elements").alias("elements"),
            F.sum(F.when(fault, F.col("n")).otherwise(0)).alias("faults"),
            F.sum("depth").alias("depth"),
        )
        .withColumn("known", F.col("tag").isNotNull() & registry.is_known(F.col("tag")))
    )


def totals(profiled: DataFrame) -> DataFrame:
    """One line: elements, distinct table tags, and tags of unknown tables."""
    return profiled.agg(
        F.sum("elements").alias("elements"),
        F.count_distinct("tag").alias("tables"),
        F.count_distinct(F.when(~F.col("known"), F.col("tag"))).alias("unknown_tables"),
    )


def unknown_tables(profiled: DataFrame) -> DataFrame:
    """(source, tag, rows) of tables that are not known."""
    return profiled.filter(F.col("tag").isNotNull() & ~F.col("known")).select(
        "source", "tag", "rows"
    )


def runs_of_unknown_tables(spark: SparkSession, source: Source, registry: Registry | None = None) -> DataFrame:
    """(source, tag, runs, rows) of tables that are not known; equal rows in a row are one run."""
    rows, _ = survey(spark, source, registry or default_registry(), new_work_folder(spark))
    return unknown_runs(rows)
