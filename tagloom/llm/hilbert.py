"""Shards along a Hilbert curve through several metadata dimensions.

Each dimension is quantised by its own quantiles, the cells are ordered by their place on
the curve, and the ordered rows are cut into runs. Neighbours on the curve are neighbours
in every dimension, so a shard's file covers a small range of each, and a reader that
filters on any of them skips most files by their minima and maxima.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tagloom.llm.shared import Scratch

BITS = 8
DIMENSIONS = ("lang", "source", "n_chars")
ROW = 33  # bits of monotonically_increasing_id that count rows


def hilbert_index(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of points (rows) with coordinates below 2**bits.

    Rotates and reflects the frame of each level into that of the level above, then reads
    the Gray code of the coordinates' bits, dimension by dimension within a level.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        q, below = 1 << level, (1 << level) - 1
        for i in range(n):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & below)
            x[0] = np.where(flip, x[0] ^ below, x[0] ^ swap)
            x[i] ^= swap if i else 0
    for i in range(1, n):
        x[i] ^= x[i - 1]
    parity = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        parity ^= np.where(x[n - 1] & (1 << level), (1 << level) - 1, 0)
    x ^= parity
    place = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            place = (place << 1) | ((x[i] >> level) & 1)
    return place


def _coded(light: DataFrame, name: str, scratch: Scratch) -> DataFrame:
    """`light` with a text column replaced by the rank of its value among all distinct ones, as a number; null stays null.

    Values are counted before they are shuffled and range-partitioned by themselves, so a common one is one row.
    """
    parts = int(light.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = light.select(F.col(name).alias("value")).filter("value IS NOT NULL").distinct()
    ordered = scratch.keep(
        distinct.repartitionByRange(parts, "value").sortWithinPartitions("value").withColumn("at", F.monotonically_increasing_id())
    )
    ranked, _ = _ranked(ordered, "at")
    ranks = ranked.select("value", F.col("rank").cast("double").alias("rank"))
    kept = [c for c in light.columns if c != name]
    return light.join(ranks, F.col(name) == F.col("value"), "left").select(*kept, F.col("rank").alias(name))


def shards(
    docs: DataFrame, dimensions: Sequence[str] = DIMENSIONS, count: int = 24,
    bits: int = BITS, scratch: Scratch | None = None,
) -> DataFrame:
    """(doc_id, size, text_crc32, curve, shard, slot, row_key) of every row of `docs`.

    `size`: UTF-8 bytes of the text plus 8; `text_crc32`: of the same bytes; null counts as
    none. Rows are ordered by curve, crc and doc_id and cut into `count` runs whose lengths
    differ by one at most; `slot` counts from 0 within a run. Texts are coded by the rank of the whole
    value. Nulls take the first cell of a dimension. Fewer rows than shards leave the last shards empty. Equal rows are equal in
    all but the slot. `row_key`: a hash of doc_id, text and dimensions, by which `write_shards`
    finds the row.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark)
    names = [f"d{k}" for k in range(len(dimensions))]
    texts = [d for d in dimensions if isinstance(docs.schema[d].dataType, T.StringType)]
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    light = scratch.keep(
        docs.select(
            "doc_id", (F.octet_length(text) + 8).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"),
            _row_key(docs, dimensions).alias("row_key"),
            *[(F.col(d) if d in texts else F.col(d).cast("double")).alias(n) for d, n in zip(dimensions, names)],
        )
    )
    if texts:
        plain = light
        for d, n in zip(dimensions, names):
            light = _coded(light, n, scratch) if d in texts else light
        light = scratch.keep(light)
        scratch.drop(plain)
    cuts = [k / (1 << bits) for k in range(1, 1 << bits)]
    row = light.agg(*[F.percentile_approx(n, F.array(*map(F.lit, cuts)), F.lit(10_000)).alias(n) for n in names]).first()
    bounds = [np.unique(np.array(row[n] or [], float)) for n in names]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = []
            for name, bound in zip(names, bounds):
                values = batch.column(name).to_numpy(zero_copy_only=False).astype(float)
                at = np.where(np.isnan(values), 0, np.searchsorted(bound, values, side="left"))
                cells.append(at * (1 << bits) // (len(bound) + 1))
            curve = hilbert_index(np.stack(cells, axis=1).reshape(-1, len(names)), bits)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "size", "text_crc32", "row_key")), pa.array(curve, pa.int64())],
                ["doc_id", "size", "text_crc32", "row_key", "curve"],
            )

    kind = light.schema["doc_id"].dataType.simpleString()
    on_curve = scratch.keep(light.mapInArrow(place, f"doc_id {kind}, size bigint, text_crc32 bigint, row_key bigint, curve bigint"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["curve", "text_crc32", "doc_id"]
    ranked = scratch.keep(
        on_curve.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .withColumn("at", F.monotonically_increasing_id())
    )
    scratch.drop(light)
    ranked, total = _ranked(ranked, "at")
    small, larger = divmod(total, count)
    first = larger * (small + 1)
    shard = F.when(F.col("rank") < first, F.expr(f"rank div {small + 1}")).otherwise(
        F.expr(f"{larger} + (rank - {first}) div {max(small, 1)}")
    )
    start = F.col("shard") * small + F.least(F.col("shard"), F.lit(larger))
    return (
        ranked.withColumn("shard", shard.cast("int"))
        .withColumn("slot", (F.col("rank") - start).cast("bigint"))
        .select("doc_id", "size", "text_crc32", "curve", "shard", "slot", "row_key")
    )


def _row_key(docs: DataFrame, dimensions: Sequence[str]) -> Column:
    """A hash of all that decides the place of a row; rows that are equal in it can change places."""
    names = ("doc_id", "text", *dimensions)
    return F.xxhash64(*names, *[F.col(c).isNull() for c in names])


def _ranked(placed: DataFrame, at: str) -> tuple[DataFrame, int]:
    """`placed`, a written table, with `rank` in the order of its partitions and rows; and how many rows it has.

    `at` is the monotonically_increasing_id it was written with; one number for each task is collected.
    """
    part = F.shiftright(at, ROW).cast("int")
    held = {r["part"]: r["n"] for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    before, total = [0] * (max(held, default=0) + 1), 0
    for p in sorted(held):
        before[p], total = total, total + held[p]
    base = F.get(F.array(*[F.lit(b).cast("bigint") for b in before]), part)
    return placed.withColumn("rank", base + F.col(at).bitwiseAND(F.lit((1 << ROW) - 1))), total


def _by_key(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """`rows` written in the order of `_key`; a key of very many rows goes on through several tasks."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return scratch.keep(
        rows.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(parts, "_key", "_tie").sortWithinPartitions("_key", "_tie").drop("_tie")
        .withColumn("_at", F.monotonically_increasing_id())
    )


def write_shards(
    docs: DataFrame, found: DataFrame, path: str, dimensions: Sequence[str] = DIMENSIONS,
    file_bytes: int = 128 << 20, scratch: Scratch | None = None,
) -> None:
    """Every row of `docs` as Parquet, a folder `shard=k` for each shard, rows in slot order.

    `found`: from `shards` over the same rows and dimensions. Rows meet their places by
    their number in the order of `row_key`, so null and repeated ids are rows like any other.
    A shard is cut into files of equal row counts and about `file_bytes` bytes of text, each
    written by a task of its own; the order of their names is that of the slots.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    texts = _by_key(docs.withColumn("_key", _row_key(docs, dimensions)), scratch)
    places = _by_key(found.select(F.col("row_key").alias("_key"), "shard", F.col("slot").alias("_slot")), scratch)
    (left, n), (right, placed) = _ranked(texts, "_at"), _ranked(places, "_at")
    if n != placed:
        raise ValueError(f"{n} rows of documents, {placed} places")
    held = {r["shard"]: r for r in found.groupBy("shard").agg(F.count("*").alias("n"), F.sum("size").alias("size")).collect()}
    first, per, files = [], [], 0
    for shard in range(max(held, default=0) + 1):
        rows, size = (held[shard]["n"], held[shard]["size"]) if shard in held else (0, 0)
        first.append(files)
        per.append(max(1, rows * file_bytes // max(size, 1)))
        files += -(-rows // per[-1])
    of_shard = lambda numbers: F.get(F.array(*[F.lit(x).cast("bigint") for x in numbers]), F.col("shard"))
    rows = left.join(right.withColumnRenamed("_key", "_placed").drop("_at"), "rank").withColumn(
        "shard", F.when(F.col("_key") == F.col("_placed"), F.col("shard")).otherwise(F.raise_error(F.lit("the places are those of other rows")))
    )
    file = of_shard(first) + F.floor(F.col("_slot") / of_shard(per))
    (
        rows.repartitionById(max(files, 1), file.cast("int")).sortWithinPartitions("shard", "_slot")
        .select(*docs.columns, "shard").write.partitionBy("shard").parquet(path)
    )
    scratch.drop(texts)
    scratch.drop(places)
