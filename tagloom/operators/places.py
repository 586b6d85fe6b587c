"""Where faulty rows stand: byte offset and line, by prefix sums over splits.

Each record knows its bytes and line ends. What is before a row is the sum over the splits before its own, of which there
are few, and over the records before it in its split, which are looked at only in splits
that hold a fault. Nothing of this runs for documents without one. Offsets count from 0 in bytes of the document as UTF-8, lines
from 1, both to the `<` of the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tagloom.operators.rows import OK, OUTSIDE


def is_faulty() -> Column:
    """Lines of typed rows that stand for a bad row or for the damage of a document."""
    return ~F.col("good") | F.col("tag").isNull() & ~F.col("status").isin(OK, OUTSIDE)


def located(typed: DataFrame) -> DataFrame:
    """The faulty lines of `typed` with `offset` and `line`; those of documents read as a whole have them already."""
    faulty, cut = typed.filter(is_faulty()), typed.filter("split IS NOT NULL")
    sizes = cut.select("source", "split", "at", F.coalesce("bytes", F.lit(0)).alias("size"), F.coalesce("ends", F.lit(0)).alias("ends"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    sums = lambda w, size, ends: {
        size: F.coalesce(F.sum("size").over(before(w)), F.lit(0)),
        ends: F.coalesce(F.sum("ends").over(before(w)), F.lit(0)),
    }
    places = faulty.filter("split IS NOT NULL").select("source", "split", "at").distinct()
    sources = places.select("source").distinct()
    splits = sizes.join(sources, "source", "left_semi").groupBy("source", "split").agg(F.sum("size").alias("size"), F.sum("ends").alias("ends"))
    bases = splits.withColumns(sums(Window.partitionBy("source").orderBy("split"), "base", "base_ends"))
    inside = sizes.join(places.select("source", "split").distinct(), ["source", "split"], "left_semi")
    inside = inside.withColumns(sums(Window.partitionBy("source", "split").orderBy("at"), "start", "start_ends"))
    found = (
        inside.join(places, ["source", "split", "at"], "left_semi")
        .join(bases.select("source", "split", "base", "base_ends"), ["source", "split"])
        .select(
            "source", "split", "at", (F.col("base") + F.col("start")).alias("found_offset"),
            (F.col("base_ends") + F.col("start_ends") + 1).alias("found_line"),
        )
    )
    new = {c: F.coalesce(c, f"found_{c}").alias(c) for c in ("offset", "line")}
    return faulty.join(found, ["source", "split", "at"], "left").select(*[new.get(c, F.col(c)) for c in typed.columns])


def unknown_runs(typed: DataFrame) -> DataFrame:
    """(source, tag, runs, rows) of rows of unknown tables, in the order of the document.

    A run is a row of such rows with the same tag; rows of known tables between them do not end it. Runs
    are told within each split; the last of a split and the first of the next that has any are one if
    their tags are equal.
    """
    rows = typed.filter(F.col("tag").isNotNull() & ~F.col("known")).select(
        "source", F.coalesce("split", F.lit(0)).alias("split"), "at", "tag"
    )
    inside = Window.partitionBy("source", "split").orderBy("at")
    begins = F.coalesce((F.lag("tag").over(inside) != F.col("tag")), F.lit(True))
    marked = rows.withColumn("begins", begins.cast("bigint"))
    per_split = marked.groupBy("source", "split", "tag").agg(
        F.sum("begins").alias("runs"), F.count("*").alias("rows"), F.min("at").alias("first_at"), F.max("at").alias("last_at")
    )
    ends = per_split.groupBy("source", "split").agg(
        F.min_by("tag", "first_at").alias("first_tag"), F.max_by("tag", "last_at").alias("last_tag")
    )
    order = Window.partitionBy("source").orderBy("split")
    goes_on = ends.withColumn("before", F.lag("last_tag").over(order)).filter(F.col("before") == F.col("first_tag"))
    joined = goes_on.groupBy("source", F.col("first_tag").alias("tag")).agg(F.count("*").alias("joined"))
    return (
        per_split.groupBy("source", "tag").agg(F.sum("runs").alias("runs"), F.sum("rows").alias("rows"))
        .join(joined, ["source", "tag"], "left")
        .select("source", "tag", (F.col("runs") - F.coalesce("joined", F.lit(0))).alias("runs"), "rows")
    )
