"""Duplicate lines over a whole corpus, returned as keep bitmaps instead of texts.

Lines become (hash, document, position). They are range-partitioned by hash and document
and sorted by hash, document and position, so equal lines follow each other in document
order; a line that a third of all documents share is spread over many ranges, since the
range goes on through the documents. Streaming over that order gives one run for each
line and text, with the positions of its occurrences; runs give the number of
documents and the first occurrence of each line. Lines of too few documents end here; the
others turn into bitmaps, one row per text that loses something.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tagloom.llm.shared import BLANKS, Scratch, ascii_lower, unused

WORD = 64


def line_key(line: Column) -> Column:
    """A line without ASCII white space at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def keep_bitmaps(
    docs: DataFrame,
    scratch: Scratch | None = None,
    min_docs: int = 2,
    min_chars: int = 1,
    keep_first: bool = True,
) -> DataFrame:
    """(doc_id, text_hash, keep array<struct<word int, bits bigint>>) of each text that loses a line.

    Bit p % 64 of word p div 64 is 1 if the line at position p (split at \\n, from 0)
    stays. Words with nothing but ones are left out, and so are texts that lose
    nothing. Lines whose key has at least `min_chars` code points and occurs in at least
    `min_docs` documents are duplicates; the first occurrence, by document and then
    position, stays if `keep_first`. Keys are compared by 96 bits of two hashes. Null and
    empty texts are one empty line. Rows that share a doc_id count as one document, and each
    loses its own lines: bitmaps are addressed by id and hash of the text. Rows without doc_id
    count for no document, come last and lose lines like any other. Repeated rows share a bitmap.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    key = line_key(F.col("line"))
    seen = (
        docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(lines(F.col("text"))).alias("pos", "line"))
        .select("doc_id", "text_hash", "pos", key.alias("key"))
        .filter(F.length("key") >= min_chars)
        .select(F.xxhash64("key").alias("h"), F.hash("key").alias("g"), "doc_id", "text_hash", "pos")
    )
    # repeated rows are one, before they meet in a range; written, so that the ranges are drawn from a light table
    seen = scratch.keep(seen.distinct())
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = scratch.keep(
        seen.repartitionByRange(parts, "h", "g", "doc_id", "text_hash")
        .sortWithinPartitions("h", "g", "doc_id", "text_hash", "pos")
        .groupBy("h", "g", "doc_id", "text_hash")
        .agg(F.collect_list("pos").alias("at"))
    )
    scratch.drop(seen)
    # written, so that its size is known to the join, which else could not split a hot line
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")
    common = scratch.keep(
        runs.groupBy("h", "g")
        .agg(F.count_distinct("doc_id").alias("docs"), F.min(order).alias("first"))
        .filter(F.col("docs") >= min_docs)
    )
    held = order.eqNullSafe(F.col("first")) & F.lit(keep_first)
    gone = F.when(held, F.array_except("at", F.array(F.array_min("at")))).otherwise(F.col("at"))
    return (
        runs.join(common, ["h", "g"])
        .select("doc_id", "text_hash", F.explode(gone).alias("pos"))
        .groupBy("doc_id", "text_hash", F.expr(f"int(pos div {WORD})").alias("word"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, pos % {WORD})")).alias("gone"))
        .groupBy("doc_id", "text_hash")
        .agg(F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("gone").alias("bits")))).alias("keep"))
    )


def kept_text(text: Column, keep: Column) -> Column:
    """The lines that a bitmap keeps, joined by \\n; the whole text where there is none."""
    split = lines(text)
    words = F.sequence(F.lit(0), F.expr("0") + F.floor((F.size(split) - 1) / WORD).cast("int"))
    by_word = F.map_from_entries(keep)
    dense = F.transform(words, lambda w: F.coalesce(F.try_element_at(by_word, w), F.lit(-1).cast("bigint")))
    stays = lambda line, p: F.getbit(F.get(dense, (p / WORD).cast("int")), p % WORD) == 1
    return F.when(keep.isNull(), text).otherwise(F.array_join(F.filter(split, stays), "\n"))


def dropped_lines(text: Column, keep: Column) -> Column:
    """How many lines of the text a bitmap drops."""
    n = F.size(lines(text))
    inside = F.aggregate(
        F.filter(keep, lambda w: w["word"] * WORD < n),
        F.lit(0).cast("bigint"),
        lambda total, w: total + WORD - F.bit_count(w["bits"]),
    )
    return F.coalesce(inside, F.lit(0).cast("bigint"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, name: str = "_keep") -> DataFrame:
    """All rows and columns of `docs`, and the bitmap of the row's text or null as the column `name`.

    A column of `docs` that has this name is replaced; others may have any names.
    """
    own = unused([*docs.columns, name])
    found = bitmaps.select(F.col("doc_id").alias(f"{own}id"), F.col("text_hash").alias(f"{own}hash"), F.col("keep").alias(f"{own}keep"))
    same = F.col("doc_id").eqNullSafe(F.col(f"{own}id")) & (F.xxhash64("text") == F.col(f"{own}hash"))
    return docs.drop(name).join(found, same, "left").drop(f"{own}id", f"{own}hash").withColumnRenamed(f"{own}keep", name)
