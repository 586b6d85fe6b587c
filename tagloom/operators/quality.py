"""Findings about typed rows, aggregated per source, table, rule and column."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tagloom.operators.outline import DONE
from tagloom.operators.rows import MALFORMED, OK, OUTSIDE, STATES_TO_REREAD
from tagloom.operators.typed import violations
from tagloom.spec import Registry

INFO, WARNING, ERROR = "INFO", "WARNING", "ERROR"


def count_rows(typed: DataFrame) -> DataFrame:
    """Rows and open elements per source, tag and state.

    The one aggregation over all rows. It reads narrow columns and combines inside
    each task before it shuffles, so a source or table with very many rows is one
    line per task.
    """
    return typed.groupBy("source", "tag", "known", "status", "good").agg(
        F.count("*").alias("n"),
        F.sum("depth").alias("depth"),
        F.sum("elements").alias("elements"),
        F.max("loose.else").alias("other_text"),
    )


def findings(counted: DataFrame, faults: DataFrame, registry: Registry) -> DataFrame:
    """(level, source, table_name, rule, column_name, occurrences, sample, offset, line) of all that was found.

    Rows loaded, unknown tables, violations and damaged sources. `counted` is the stored result of
    `count_rows`, `faults` that of `tagloom.operators.places.located`. `offset` and `line` are those of the first occurrence.
    """
    none = {
        "table_name": "string", "column_name": "string", "sample": "string", "offset": "bigint", "line": "bigint",
    }
    columns = ("level", "source", "table_name", "rule", "column_name", "occurrences", "sample", "offset", "line")

    def shaped(frame: DataFrame, level) -> DataFrame:
        frame = frame.withColumn("level", level)
        return frame.select(*[F.col(c) if c in frame.columns else F.lit(None).cast(none[c]).alias(c) for c in columns])

    is_row = F.col("tag").isNotNull()
    rows = (
        counted.filter(is_row & F.col("good"))
        .groupBy("source", F.col("tag").alias("table_name"), "known")
        .agg(F.sum("n").alias("occurrences"))
        .withColumn("rule", F.when(F.col("known"), "rows_loaded").otherwise("unknown_table"))
    )
    first = [F.min("offset").alias("offset"), F.min("line").alias("line")]
    damaged = faults.filter(~is_row).groupBy("source", F.col("status").alias("rule")).agg(F.count("*").alias("occurrences"), *first)
    unbalanced = (
        counted.groupBy("source")
        .agg(F.sum("depth").cast("bigint").alias("depth"))
        .filter(F.col("depth") != 0)
        .select("source", F.lit("unbalanced_document").alias("rule"), F.abs("depth").alias("occurrences"))
    )
    broken_rules = (
        faults.filter(is_row)
        .select("source", F.col("tag").alias("table_name"), "offset", "line", F.explode(violations(registry)).alias("v"))
        .groupBy("source", "table_name", "v.rule", F.col("v.column").alias("column_name"))
        .agg(F.count("*").alias("occurrences"), F.min("v.value").alias("sample"), *first)
    )
    return (
        shaped(rows, F.when(F.col("known"), INFO).otherwise(WARNING))
        .unionByName(shaped(damaged, F.lit(ERROR)))
        .unionByName(shaped(unbalanced, F.lit(ERROR)))
        .unionByName(shaped(broken_rules, F.lit(ERROR)))
    )


def sources_to_reread(counted: DataFrame, outlined: DataFrame) -> DataFrame:
    """(source, unbound) of sources that could not be cut into rows safely, or may not be well formed.

    Safe are those without a doubtful state whose tags add up, where one element is
    around all rows, or one row is the root, and the root declares all prefixes that are used.
    """
    unsafe = F.col("status").isin(*STATES_TO_REREAD) | F.coalesce("other_text", F.lit(False))
    one_root = (F.array_join("tags", " ") == DONE) & F.col("enclosed")
    row_is_root = (F.size("tags") == 0) & (F.col("rows") == 1)
    return (
        counted.groupBy("source")
        .agg(
            F.max(unsafe).alias("unsafe"),
            F.sum("depth").alias("depth"),
            F.coalesce(F.sum(F.when(F.col("tag").isNotNull(), F.col("n"))), F.lit(0)).alias("rows"),
            F.max(F.col("tag").isNull() & ~F.col("status").isin(OK, OUTSIDE, *STATES_TO_REREAD)).alias("lost"),
        )
        .join(outlined, "source", "left")
        .filter(
            ~F.col("lost")
            & (F.col("unsafe") | (F.col("depth") != 0) | ~F.coalesce(one_root | row_is_root, F.lit(False)) | (F.size("unbound") > 0))
        )
        .select("source", F.when(~F.col("scoped"), F.col("unbound")).alias("unbound"))
    )


def refuse_unbound(typed: DataFrame, unbound: DataFrame) -> DataFrame:
    """`typed` with rows that use prefixes nobody declares, named by source in `unbound`, as malformed."""
    names = unbound.filter(F.size("unbound") > 0).select("source", F.col("unbound").alias("_unbound"))
    bad = F.coalesce(F.arrays_overlap("foreign", "_unbound"), F.lit(False))
    return typed.join(names, "source", "left").select(
        *[
            F.when(bad, MALFORMED).otherwise(F.col("status")).alias("status") if c == "status"
            else (F.col("good") & ~bad).alias("good") if c == "good" else F.col(c)
            for c in typed.columns
        ]
    )


def broken_sources(typed: DataFrame) -> DataFrame:
    """Sources that are damaged as a whole."""
    return damages(typed).select("source")


def damages(typed: DataFrame) -> DataFrame:
    """Lines of `typed` that stand for the damage of a source."""
    return typed.filter(F.col("tag").isNull() & ~F.col("status").isin(OK, OUTSIDE))
