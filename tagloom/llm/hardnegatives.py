"""Hard negatives by a vertical scan: dimension after dimension, with candidates leaving on the way.

Rows are packed into blocks of bounded size that hold one dimension after another, with the
least and greatest value of each. Anchors are packed into groups, and each group meets each
block once. For an anchor the dimensions are read in the order of its own components, the largest by
magnitude first. After each few of them, what is left can add no less and no more than the
extremes of the remaining dimensions allow. That bounds every candidate's score, and those
that can no longer be among the results leave the candidate bitmap. Scores of the few that see the last
dimension are exact integers.

Two scans: the nearest rows of an anchor's own label are its positives; their scores give
windows, and the best rows of other labels inside a window are its negatives. Rows that
repeat an id, a label and a vector are packed once, with their number, so that copies cost
nothing; they count one by one in the results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tagloom.llm.shared import Scratch

#: Rows of a block and anchors of a group, on average: a task holds one of each.
BLOCK, GROUP = 4096, 1024
#: Dimensions read between two tests of the bitmap.
STEP = 8
#: Magnitude of a scaled component from which a row is out of range: below, no sum leaves 64 bits in 2^14 dimensions.
LIMIT = 1 << 24


def scaled(vector: Column, factor: int) -> Column:
    """floor(factor * x) of each component, in double precision; null if a component is null, not finite or out of range."""
    ok = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < LIMIT / factor, F.lit(False)))
    return F.when(ok, F.transform(vector, lambda x: F.floor(F.lit(float(factor)) * x.cast("double")).cast("int")))


# --- packing -----------------------------------------------------------------

PACKED = "ids binary, copies binary, labels binary, vectors binary"


def _pack(keys: list[str], table: pa.Table) -> pa.Table:
    """One row of one block: ids, copies and labels as 64-bit integers, vectors as one run of integers per dimension."""
    matrix = table["v"].combine_chunks().flatten().to_numpy().reshape(len(table), table["dims"][0].as_py()).T
    narrow = np.int16 if matrix.size and -(1 << 15) <= matrix.min() and matrix.max() < 1 << 15 else np.int32
    columns = {k: pa.array([table[k][0].as_py()], pa.int32()) for k in keys}
    for name, column in (("ids", "vec_id"), ("copies", "copies"), ("labels", "label_id")):
        columns[name] = pa.array([table[column].to_numpy().astype(np.int64).tobytes()])
    head = np.array([matrix.shape[0], np.dtype(narrow).itemsize], np.int32).tobytes()
    columns["vectors"] = pa.array([head + np.ascontiguousarray(matrix.astype(narrow)).tobytes()])
    return pa.table(columns)


class Block:
    def __init__(self, row: dict):
        self.ids, self.copies, self.labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "copies", "labels"))
        dims, width = np.frombuffer(row["vectors"], np.int32, 2)
        kept = np.frombuffer(row["vectors"], f"i{width}", offset=8)
        self.matrix = kept.reshape(dims, len(self.ids))
        self.low, self.high = (f(axis=1).astype(np.int64) if dims else np.zeros(0, np.int64) for f in (self.matrix.min, self.matrix.max))


# --- scanning ----------------------------------------------------------------


def scan(block: Block, anchor: np.ndarray, alive: np.ndarray, shrink: Callable) -> tuple[np.ndarray, np.ndarray]:
    """(places in the block, exact scores) of the candidates that `shrink` leaves; `alive` is the bitmap to begin with.

    `shrink` takes the least and the greatest score that each candidate can still reach and
    returns which may stay.
    """
    order = np.argsort(-np.abs(anchor), kind="stable")
    ends = np.stack([anchor * block.low, anchor * block.high])
    least, most = (np.append(np.cumsum(x[order][::-1])[::-1], 0) for x in (ends.min(axis=0), ends.max(axis=0)))
    # sums under 2^53 are exact as doubles, which multiply faster
    exact = np.float64 if max(np.abs(ends).max(axis=0, initial=0).sum(), 1) < 1 << 53 else np.int64
    at = np.flatnonzero(alive)
    score = np.zeros(len(at), exact)
    for k in range(0, len(order), STEP):
        dims = order[k : k + STEP]
        rows = block.matrix[dims] if len(at) == len(block.ids) else block.matrix[dims[:, None], at]
        score += anchor[dims].astype(exact) @ rows.astype(exact)
        done = min(k + STEP, len(order))
        stays = shrink(score + exact(least[done]), score + exact(most[done]))
        if not stays.all():
            at, score = at[stays], score[stays]
        if not len(at):
            break
    return at, score.astype(np.int64)


def _kth(scores: np.ndarray, k: int) -> float:
    """The k-th largest; below everything if there are fewer."""
    return np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) >= k else -np.inf


def _best(block: Block, at: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """The first k by score, then id, as indices into `at`."""
    return np.lexsort((block.ids[at], -score))[:k]


def _near(block: Block, a: dict, k: int) -> Iterator[tuple]:
    """The k best rows of an anchor's label; a single row that is the anchor itself is none of them."""
    own = a["vector"]
    alive = block.labels == a["label"]
    same = alive & (block.ids == a["id"])
    if same.any():
        same[same] = (block.matrix[:, same] == own[:, None]).all(axis=0)
        alive &= ~(same & (block.copies == 1))

    at, score = scan(block, own, alive, lambda low, high: high >= _kth(low, k))
    for i in _best(block, at, score, k):
        copies = int(block.copies[at[i]]) - int(same[at[i]])
        yield a["row"], 0, int(block.ids[at[i]]), int(score[i]), copies


def _inside(block: Block, a: dict, k: int) -> Iterator[tuple]:
    """The k best rows of other labels in each window of an anchor."""
    windows = a["windows"]
    if not windows:
        return

    def shrink(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        stays = np.zeros(len(low), bool)
        for _, first, last in windows:
            fits = (high >= first) & (low <= last)
            sure = low[(low >= first) & (high <= last)]
            stays |= fits & (high >= _kth(sure, k))
        return stays

    at, score = scan(block, a["vector"], block.labels != a["label"], shrink)
    for w, first, last in windows:
        held = np.flatnonzero((score >= first) & (score <= last))
        for i in held[_best(block, at[held], score[held], k)]:
            yield a["row"], w, int(block.ids[at[i]]), int(score[i]), int(block.copies[at[i]])


FOUND = "anchor bigint, w int, id bigint, score bigint, copies bigint"


def _meet(blocks: pa.Table, groups: pa.Table, kind: Callable) -> pa.Table:
    """Every anchor of a group against a block."""
    out = []
    for packed in blocks.to_pylist():
        block = Block(packed)
        for row in groups.to_pylist():
            group = Block(row)
            windows = np.frombuffer(row["windows"], np.int64).reshape(len(group.ids), -1, 2)
            rows = np.frombuffer(row["rows"], np.int64)
            for k in range(len(group.ids)):
                w = [(j, int(x), int(y)) for j, (x, y) in enumerate(windows[k]) if x <= y]
                a = {"row": int(rows[k]), "id": group.ids[k], "label": group.labels[k], "vector": group.matrix[:, k].astype(np.int64), "windows": w}
                out += kind(block, a)
    columns = zip(*out) if out else [()] * 5
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], ["anchor", "w", "id", "score", "copies"])


def _pack_anchors(keys: list[str], table: pa.Table) -> pa.Table:
    packed = _pack(keys, table)
    rows = table["row"].to_numpy().astype(np.int64).tobytes()
    windows = table["windows"].combine_chunks().flatten().to_numpy().astype(np.int64).tobytes()
    return packed.append_column("rows", pa.array([rows])).append_column("windows", pa.array([windows]))


def _scan_all(rows: DataFrame, anchors: DataFrame, by: list[str], kind: Callable, scratch: Scratch) -> DataFrame:
    """FOUND of all anchors and blocks whose columns `by` are equal. rows, anchors: `by`, row, vec_id, copies, label_id, v.

    Sizes of `by` are counted, so that blocks and groups are of bounded size whatever is common.
    """

    def parted(frame: DataFrame, size: int, name: str) -> tuple[DataFrame, DataFrame]:
        sizes = frame.groupBy(*by).agg(F.ceil(F.count("*") / size).cast("int").alias(f"{name}s"))
        return frame.join(sizes, by).withColumn(name, F.pmod(F.xxhash64("row"), F.col(f"{name}s")).cast("int")), sizes

    parts, n_parts = parted(rows, BLOCK, "part")
    groups, n_groups = parted(anchors, GROUP, "grp")
    numbered = ", ".join(f"{k} int" for k in by)
    parts = parts.groupBy(*by, "part").applyInArrow(lambda table: _pack([*by, "part"], table), f"{numbered}, part int, {PACKED}")
    groups = groups.groupBy(*by, "grp").applyInArrow(
        lambda table: _pack_anchors([*by, "grp"], table), f"{numbered}, grp int, {PACKED}, rows binary, windows binary"
    )
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    parts = scratch.keep(parts).join(n_groups, by).withColumn("grp", every("grps"))
    groups = scratch.keep(groups).join(n_parts, by).withColumn("part", every("parts"))
    key = [*by, "part", "grp"]
    met = parts.groupBy(*key).cogroup(groups.groupBy(*key)).applyInArrow(lambda left, right: _meet(left, right, kind), FOUND)
    return scratch.keep(met)


# --- the operator ------------------------------------------------------------


def _first(found: DataFrame, k: int, by: list[str]) -> DataFrame:
    """The first k of each group by score, then id, copies counted one by one, with `rank` from 1."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    before = F.coalesce(F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (
        found.withColumn("before", before).filter(F.col("before") < k)
        .withColumn("rank", F.explode(F.sequence(F.col("before") + 1, F.least(F.lit(k), F.col("before") + F.col("copies")))))
        .withColumn("rank", F.col("rank").cast("int")).drop("before", "copies")
    )


def hard_negatives(
    vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    factor: int = 256, scratch: Scratch | None = None,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the anchors' hard negatives.

    `vectors`: vec_id, label (both whole numbers), embedding; other columns are unused and may have any names. `anchors`: a condition on vec_id. A
    score is the integer inner product of two rows' components, each floor(factor * x). Positives: an anchor's first
    other rows of its label by score, then id. For each, the first rows of other labels whose score is `low` to `high`
    percent of the positive's, by score, then id; `rank` counts them from 1. Rows whose id, label or vector is null, or
    with a null, non-finite or out-of-range component (factor * |x| >= 2^24), take no part; nor do rows of unlike
    length meet. Rows are rows: copies of an anchor are other rows, and each copy of an anchor or positive has results of
    its own. An empty table, an anchor without positives and a positive without negatives give no rows.
    """
    scratch = scratch or Scratch(vectors.sparkSession)
    rows = vectors.select("vec_id", F.col("label").cast("bigint").alias("label_id"), scaled(F.col("embedding"), factor).alias("v"))
    rows = rows.filter("vec_id IS NOT NULL AND label_id IS NOT NULL AND v IS NOT NULL")
    rows = rows.groupBy("vec_id", "label_id", "v").agg(F.count("*").alias("copies"))
    rows = scratch.keep(rows.select("*", F.size("v").alias("dims"), F.monotonically_increasing_id().alias("row")))
    none = F.array().cast("array<bigint>")
    chosen = rows.filter(anchors)

    near = _scan_all(
        rows.withColumn("label_key", F.hash("label_id")),
        chosen.select("*", F.hash("label_id").alias("label_key"), none.alias("windows")),
        ["dims", "label_key"], partial(_near, k=positives), scratch,
    )
    near = scratch.keep(
        _first(near, positives, ["anchor"]).select("anchor", F.col("rank").alias("p"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    )
    # windows: 100 * score from low to high times the positive's, so score from the least to the greatest whole number
    window = F.array(
        F.expr(f"bigint(ceil({low} * positive_score / 100BD))"), F.expr(f"bigint(floor({high} * positive_score / 100BD))")
    )
    empty = F.array(F.lit(1).cast("bigint"), F.lit(0).cast("bigint"))
    held = near.groupBy("anchor").agg(F.collect_list(F.struct("p", window.alias("w"))).alias("ws"))
    padded = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.lit(positives)),
            lambda p: F.coalesce(F.get(F.filter("ws", lambda x: x["p"] == p), F.lit(0))["w"], empty),
        )
    )
    queries = chosen.join(held, F.col("row") == F.col("anchor")).select(*chosen.columns, padded.alias("windows"))
    far = _scan_all(rows, queries, ["dims"], partial(_inside, k=negatives), scratch)
    far = _first(far, negatives, ["anchor", "w"]).select("anchor", (F.col("w") + 1).alias("p"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = chosen.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("copy"))
    return (
        near.join(far, ["anchor", "p"]).join(named, "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
