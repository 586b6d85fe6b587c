"""SimHash near-duplicates by a self-join of the binary trie of fingerprints.

Documents with one fingerprint form a class; the join runs over classes. The top of the
trie is cut into nodes of a bounded number of fingerprints. A fingerprint is sent to each
node that its own prefix differs from in at most `budget` bits; there the node's sub-trie
and the visitors' sub-tries are walked together, pair of nodes by pair of nodes, and a
pair is given up as soon as its differing bits exceed the budget. What a task returns is
a spanning forest of the links it found, so groups of near copies give as many links as
members. A node with very many visitors is copied, and each copy meets a part of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tagloom.llm.components import connected_components, forest
from tagloom.llm.shared import Scratch, unused

BITS = 64
SEED = 42
#: Visits of a node beyond which its visitors are spread over further tasks.
PART = 4096


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """SimHash over word shingles of UTF-8 text, repeats included; zero without words.

    The hashes are XXH64 with seed 42. A bit is set if it is set in over half of them.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        joined: Iterator[bytes] = iter([b" ".join(words)])
    else:
        joined = map(b" ".join, zip(*(islice(words, k, None) for k in range(shingle))))
    total, ones = 0, np.zeros(BITS, np.int64)
    hashed = (xxhash.xxh64_intdigest(s, SEED) for s in joined)
    while len(part := np.fromiter(islice(hashed, 1 << 14), np.uint64)):
        total += len(part)
        bits = np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, BITS)
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp bigint) of every document; the bits of `fp` are the fingerprint's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            found = np.fromiter((fingerprint(t.as_py(), shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"]
            )

    columns = docs.select("doc_id", "text")
    return columns.mapInArrow(run, f"doc_id {columns.schema['doc_id'].dataType.simpleString()}, fp bigint")


def _prefix(fp: Column, depth: int) -> Column:
    return F.shiftrightunsigned(fp, BITS - depth) if depth else F.lit(0).cast("bigint")


def _masks(bits: int, budget: int) -> list[int]:
    return [sum(1 << b for b in bs) for k in range(budget + 1) for bs in combinations(range(bits), k)]


def visits(codes: DataFrame, count: int, scratch: Scratch, budget: int = 2, size: int = 2048, stride: int = 8) -> DataFrame:
    """(depth, node, fp): which trie nodes each distinct fingerprint is compared in.

    A fingerprint visits its own node and, of the nodes within the budget, those that a hash
    of both prefixes picks as the meeting place, so any two fingerprints within the budget
    meet in exactly one node and no node is picked more often than others. A node of more
    than `size` own fingerprints is cut `stride` bits deeper, for its visitors as well,
    until none is.
    """
    depth = max(0, math.ceil(math.log2(max(count, 1) / size)))
    fp, done = F.col("fp"), []

    def met(own: Column, node: Column) -> Column:
        low, high = F.least(own, node), F.greatest(own, node)
        return node == F.when(F.xxhash64(low, high) % 2 == 0, low).otherwise(high)

    moves = F.array(*[F.lit(m).cast("bigint") for m in _masks(depth, budget)])
    open_ = (
        codes.select("fp", F.explode(moves).alias("move"))
        .select(F.lit(depth).alias("depth"), _prefix(fp, depth).bitwiseXOR(F.col("move")).alias("node"), "fp",
                F.bit_count("move").alias("err"))
        .filter(met(_prefix(fp, depth), F.col("node")))
    )
    while True:
        own = open_.filter("err = 0").groupBy("node").count().filter(F.col("count") > size).select("node")
        own = scratch.keep(own)
        if depth == BITS or own.isEmpty():
            break
        step = min(stride, BITS - depth)
        done.append(open_.join(own, "node", "left_anti").select("depth", "node", "fp"))
        deeper = F.array(*[F.lit(m).cast("bigint") for m in _masks(step, budget)])
        depth += step
        below = (1 << step) - 1
        part = _prefix(fp, depth).bitwiseAND(F.lit(below).cast("bigint"))
        open_ = scratch.keep(
            open_.join(own, "node")
            .select("fp", "node", "err", F.explode(deeper).alias("move"))
            .filter(F.col("err") + F.bit_count("move") <= budget)
            .select(
                F.lit(depth).alias("depth"),
                F.shiftleft("node", step).bitwiseOR(part.bitwiseXOR(F.col("move"))).alias("node"),
                "fp",
                (F.col("err") + F.bit_count("move")).alias("err"),
                (F.col("err") == 0).alias("own"),
            )
            .filter(~F.col("own") | met(_prefix(fp, depth), F.col("node")))
            .drop("own")
        )
    for frame in done:
        open_ = open_.select("depth", "node", "fp").unionAll(frame)
    return open_.select("depth", "node", "fp")


def near_pairs(a: np.ndarray, b: np.ndarray, depth: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) with at most `budget` bits between a[i] and b[j].

    Both are sorted and free of repeats. All of `b` has one prefix of `depth` bits. Nodes
    are runs of the sorted codes; each step takes all open pairs of nodes one bit down.
    """
    if not len(a) or not len(b):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    top = a >> np.uint64(BITS - depth) if depth else np.zeros(len(a), np.uint64)
    lo = np.flatnonzero(np.concatenate([[True], top[1:] != top[:-1]]))
    hi = np.append(lo[1:], len(a))
    home = b[0] >> np.uint64(BITS - depth) if depth else np.uint64(0)
    err = np.bitwise_count(top[lo] ^ home).astype(np.int64)
    pairs = np.stack([lo, hi, np.zeros_like(lo), np.full_like(lo, len(b)), err])[:, err <= budget]
    for bit in range(depth, BITS):
        shift = np.uint64(BITS - 1 - bit)
        before = [np.concatenate([[0], np.cumsum((x >> shift) & np.uint64(1), dtype=np.int64)]) for x in (a, b)]
        alo, ahi, blo, bhi, err = pairs
        amid = ahi - (before[0][ahi] - before[0][alo])
        bmid = bhi - (before[1][bhi] - before[1][blo])
        pairs = np.concatenate(
            [
                np.stack([alo, amid, blo, bmid, err]),
                np.stack([amid, ahi, bmid, bhi, err]),
                np.stack([alo, amid, bmid, bhi, err + 1]),
                np.stack([amid, ahi, blo, bmid, err + 1]),
            ],
            axis=1,
        )
        pairs = pairs[:, (pairs[0] < pairs[1]) & (pairs[2] < pairs[3]) & (pairs[4] <= budget)]
    return pairs[0], pairs[2]


def _join_nodes(batches: Iterator[pa.RecordBatch], budget: int, block: int = 8192) -> Iterator[pa.RecordBatch]:
    """Links from rows sorted by node and part, a node's own fingerprints first.

    Each part of a node has all of its own fingerprints and some of the visitors; the first
    part joins the own ones with each other.
    """
    node, own, own_parts, waiting = None, None, [], []

    def links(a: np.ndarray, b: np.ndarray, depth: int, within: bool) -> pa.RecordBatch:
        i, j = near_pairs(a, b, depth, budget)
        if within:
            i, j = i[i < j], j[i < j]
        left, right = forest(a[i], b[j]) if len(i) else (a[:0], b[:0])
        return pa.RecordBatch.from_arrays([pa.array(left.view(np.int64)), pa.array(right.view(np.int64))], ["a", "b"])

    def settled() -> Iterator[pa.RecordBatch]:
        nonlocal own
        if own is None:
            own = np.sort(np.concatenate([np.empty(0, np.uint64), *own_parts]))
            for k in range(0, 0 if node[2] else len(own), block):
                yield links(own[k : k + block], own, node[0], len(own) <= block)

    def visited() -> Iterator[pa.RecordBatch]:
        nonlocal waiting
        yield from settled()
        if waiting:
            yield links(np.sort(np.concatenate(waiting)), own, node[0], False)
        waiting = []

    for batch in batches:
        names = ("depth", "node", "part", "away", "fp")
        *keys, fp = (batch.column(n).to_numpy(zero_copy_only=False) for n in names)
        depth, at, part, away = keys
        fp = fp.view(np.uint64)
        cuts = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(fp)]):
            if hi == lo:
                continue
            if node != (depth[lo], at[lo], part[lo]):
                if node is not None:
                    yield from visited()
                node, own, own_parts, waiting = (depth[lo], at[lo], part[lo]), None, [], []
            if not away[lo]:
                own_parts.append(fp[lo:hi])
                continue
            yield from settled()
            for k in range(lo, hi, block):
                waiting.append(fp[k : min(hi, k + block)])
                if sum(map(len, waiting)) >= block:
                    yield from visited()
    if node is not None:
        yield from visited()


def near_duplicates(docs: DataFrame, scratch: Scratch | None = None, shingle: int = 3, budget: int = 2) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of `docs` (doc_id, text; others unused).

    `fingerprint`: 16 hexadecimal digits. `component_id`: the smallest doc_id reachable
    over links between fingerprints of at most `budget` differing bits. Rows without words
    (null, empty, blank) have fingerprint zero and are linked like any other. Repeated rows
    come back as often as given; a component of null ids only has a null id.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    marked = scratch.keep(fingerprints(docs, shingle))
    classes = scratch.keep(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    own = F.expr(f"CASE WHEN depth = 0 THEN 0 ELSE shiftrightunsigned(fp, {BITS} - depth) END")
    met = visits(classes.select("fp"), classes.count(), scratch, budget).withColumn("away", own != F.col("node"))
    crowded = scratch.keep(
        met.groupBy("depth", "node").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts")).filter("parts > 1")
    )
    parts = F.coalesce("parts", F.lit(1))
    one = F.array(F.pmod(F.xxhash64("fp"), parts).cast("int"))
    links = (
        met.join(crowded, ["depth", "node"], "left")
        .select("depth", "node", "fp", "away", F.explode(F.when(F.col("away"), one).otherwise(F.sequence(F.lit(0), parts - 1))).alias("part"))
        .repartition("depth", "node", "part")
        .sortWithinPartitions("depth", "node", "part", "away")
        .mapInArrow(lambda batches: _join_nodes(batches, budget), "a bigint, b bigint")
    )
    roots = connected_components(links, scratch).toDF("fp", "root")
    classes = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    named = scratch.keep(classes.join(smallest, "root").select("fp", "component_id"))
    return marked.join(named, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, scratch: Scratch | None = None, shingle: int = 3, budget: int = 2) -> DataFrame:
    """The document of smallest id of every near-duplicate group, with all columns of `docs`.

    Rows that repeat that id and text give one row. Rows without an id cannot be named, so
    they all stay.
    """
    own = unused(docs.columns)
    found = near_duplicates(docs, scratch, shingle, budget)
    kept = found.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias(f"{own}id")).distinct()
    rows = docs.join(kept, F.col("doc_id") == F.col(f"{own}id")).withColumn(f"{own}id", F.xxhash64("text"))
    return rows.dropDuplicates(["doc_id", f"{own}id"]).drop(f"{own}id").unionAll(docs.filter("doc_id IS NULL"))
