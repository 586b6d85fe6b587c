"""Embedding near-duplicates by range search on a robust-pruned flat graph.

Vectors of one label form a region. A region is covered by overlapping cells, each the
vectors nearest to a centre and those for which it comes second. A task builds the graph
of a cell: every vector keeps the neighbours that robust pruning leaves of its closest
ones. The adjacency lists of a vector's cells are united. Search tasks hold the graph of a
region and a block of its vectors as queries; each query walks greedily from the medoids,
then expands every vector in range, so that groups of near copies are followed to their
end. Links are verified in double precision. Tasks return, per vector, the number of its
links and a spanning forest of them, never the pairs. Recall is audited by brute force.

Equal vectors of a label are one node with a count. Regions of more than `region_size`
nodes are first covered by overlapping regions themselves, whose centres lie apart, so a
dense group is not cut; a pair that meets in several regions counts in the lowest only.
Regions that stay larger, such as a dense group around one centre, get no graph: they are
dealt into blocks of half a region and joined block by block, exactly.
"""

from __future__ import annotations

import logging

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tagloom.llm.components import connected_components, forest
from tagloom.llm.shared import Scratch

log = logging.getLogger(__name__)
SALT_ROWS = 8192
SAMPLE_PER_CELL = 32
#: Entries of a matrix of pairs that are worked on at once.
SLICE = 1 << 22


def usable(vector: Column) -> Column:
    """Neither null nor zero, and no component null, infinite or not a number."""
    sound = lambda x: x.isNotNull() & (F.abs(x) < float("inf"))  # noqa: E731  NaN is above infinity
    return F.coalesce(F.forall(vector, sound) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(vectors: pd.Series) -> np.ndarray:
    """Rows of length one; scaled first, so that no square overflows or vanishes."""
    x = np.stack(vectors.to_numpy()).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cover(nodes: DataFrame, group: str, size: int, apart: float, scratch: Scratch, overlap: int = 2) -> DataFrame:
    """(*columns of `nodes`, cell int): each row once for each of its `overlap` nearest centres.

    `nodes` has node, vec and `group`. Groups of at most `size` rows are one cell. Centres
    are picked by a task per group from a sample of about 32 rows for each centre (of at
    most 1,024 centres), no two of a cosine above `apart`. Rows meet their group's centres
    in buckets of about 8,192, so a large group is spread over many tasks.
    """
    sizes = nodes.groupBy(group).count()
    sized = nodes.join(sizes, group)
    cells = F.least(F.lit(1024), F.greatest(F.lit(8), F.ceil(F.col("count") / size)))
    small, large = sized.filter(F.col("count") <= size), sized.filter(F.col("count") > size)
    if large.isEmpty():
        return small.select(*nodes.columns, F.lit(0).alias("cell"))
    large = large.withColumns({"cells": cells.cast("int"), "salts": F.ceil(F.col("count") / SALT_ROWS).cast("int")})
    draw = F.pmod(F.xxhash64(F.lit("centre"), "node"), F.lit(1 << 30)) / float(1 << 30)
    sample = large.filter(draw < SAMPLE_PER_CELL * F.col("cells") / F.col("count")).select(group, "cells", "salts", "node", "vec")

    def pick(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node")
        x = _unit(rows["vec"])
        chosen: list[int] = []
        for i in np.random.default_rng(5).permutation(len(x)):
            if len(chosen) == rows["cells"].iloc[0]:
                break
            if not chosen or (x[chosen] @ x[i]).max() <= apart:
                chosen.append(i)
        salts = rows["salts"].iloc[0]
        return pd.DataFrame(
            {group: rows[group].iloc[0], "salt": np.tile(np.arange(salts), len(chosen)),
             "centre": [list(x[c]) for c in chosen for _ in range(salts)]}
        )

    kind = nodes.schema[group].dataType.simpleString()
    centres = sample.groupBy(group).applyInPandas(pick, f"{group} {kind}, salt int, centre array<double>")
    centres = scratch.keep(centres)
    salted = large.withColumn("salt", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int"))

    def assign(rows: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame({group: [], "node": pd.Series(dtype="int64"), "cell": pd.Series(dtype="int32")})
        if not len(near):
            return pd.DataFrame({group: rows[group], "node": rows["node"], "cell": 0})
        close = _unit(rows["vec"]) @ np.stack(near["centre"].map(np.asarray).to_numpy()).T
        best = np.argsort(-close, axis=1, kind="stable")[:, :overlap]
        return pd.DataFrame(
            {group: rows[group].iloc[0], "node": np.repeat(rows["node"].to_numpy(), best.shape[1]), "cell": best.ravel().astype(np.int32)}
        )

    assigned = (
        salted.select(group, "salt", "node", "vec").groupBy(group, "salt")
        .cogroup(centres.groupBy(group, "salt")).applyInPandas(assign, f"{group} {kind}, node bigint, cell int")
    )
    return small.select(*nodes.columns, F.lit(0).alias("cell")).unionAll(
        large.join(assigned, [group, "node"]).select(*nodes.columns, "cell")
    )


def robust_prune(x: np.ndarray, degree: int = 24, pool: int = 64, alpha: float = 1.2) -> np.ndarray:
    """Neighbours of each row, -1 where there are fewer.

    From the `pool` closest rows the closest is kept again and again, and those drop out
    that are `alpha` times nearer to it than to the row itself. The closest of all `degree`
    fill the places left, so that near copies stay linked among each other.
    """
    n = len(x)
    pool, out = min(pool, n - 1), np.full((n, degree), -1, np.int32)
    if pool < 1:
        return out
    step = max(1, min(1024, 2 * SLICE // n))
    for lo in range(0, n, step):
        hi = min(n, lo + step)
        close = x[lo:hi] @ x.T
        close[np.arange(hi - lo), np.arange(lo, hi)] = -np.inf
        near = np.argpartition(-close, pool - 1, axis=1)[:, :pool]
        order = np.argsort(-np.take_along_axis(close, near, 1), axis=1, kind="stable")
        near = np.take_along_axis(near, order, 1)
        gap = np.sqrt(np.maximum(0, 2 - 2 * np.take_along_axis(close, near, 1)))
        for part in range(0, hi - lo, 256):
            rows = near[part : part + 256]
            between = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("iad,ibd->iab", x[rows], x[rows], optimize=True)))
            alive, kept = np.ones(rows.shape, bool), np.zeros(rows.shape, bool)
            own = gap[part : part + 256]
            for k in range(pool):
                take = alive[:, k] & (kept.sum(1) < degree)
                kept[:, k] = take
                alive &= ~(take[:, None] & (alpha * between[:, k] <= own))
            rank = np.where(kept, 0, pool) + np.arange(pool)
            first = np.argsort(rank, axis=1, kind="stable")[:, :degree]
            out[lo + part : lo + part + len(rows), : first.shape[1]] = np.take_along_axis(rows, first, 1)
    return out


def range_search(
    x: np.ndarray, adjacency: np.ndarray, entries: np.ndarray, queries: np.ndarray, least: float, beam: int = 24
) -> np.ndarray:
    """found[q, v]: rows v that the search of row queries[q] met at a cosine of at least `least`.

    All queries walk at once. From the entries and itself, each expands the closest row of
    its beam until none is left unexpanded, then every row in range, and those they lead to.
    """
    n, nq = len(x), len(queries)
    single = x.astype(np.float32)
    seen, found = np.zeros((nq, n), bool), np.zeros((nq, n), bool)

    def visit(q: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Cosines of pairs not met before, -inf of the others."""
        new = (v >= 0) & ~seen[q, v]
        close = np.full(v.shape, -np.inf, np.float32)
        qs, vs = q[new], v[new]
        close[new] = np.einsum("id,id->i", single[queries[qs]], single[vs])
        seen[qs, vs] = True
        near = close[new] >= least - 1e-4
        a, b = qs[near], vs[near]
        found[a, b] = np.einsum("id,id->i", x[queries[a]], x[b]) >= least
        return close

    start = np.concatenate([np.tile(entries, (nq, 1)), queries[:, None]], axis=1)
    ids, close = start, np.full(start.shape, -np.inf, np.float32)
    every = np.arange(nq)
    for k in range(start.shape[1]):
        close[:, k] = visit(every, start[:, k])
    done = np.isneginf(close)
    active = every
    while len(active):
        open_ = np.where(done[active], -np.inf, close[active])
        pick = open_.argmax(1)
        going = ~np.isneginf(open_[np.arange(len(active)), pick])
        active, pick = active[going], pick[going]
        if not len(active):
            break
        done[active, pick] = True
        onward = adjacency[ids[active, pick]]
        fresh = visit(np.repeat(active, onward.shape[1]), onward.ravel()).reshape(onward.shape)
        all_ids = np.concatenate([ids[active], onward], axis=1)
        all_close = np.concatenate([close[active], fresh], axis=1)
        all_done = np.concatenate([done[active], np.isneginf(fresh)], axis=1)
        width = min(beam, all_ids.shape[1])
        top = np.argpartition(-all_close, width - 1, axis=1)[:, :width]
        if ids.shape[1] != width:
            pad = lambda a, v: np.concatenate([a, np.full((nq, width), v, a.dtype)], axis=1)[:, :width]
            ids, close, done = pad(ids, 0), pad(close, -np.inf), pad(done, True)
        ids[active], close[active], done[active] = (np.take_along_axis(a, top, 1) for a in (all_ids, all_close, all_done))
    expanded = np.zeros_like(found)
    for part in _slices(nq, n):
        while len(pending := np.argwhere(found[part] & ~expanded[part])):
            for k in range(0, len(pending), 1 << 14):
                q, v = pending[k : k + (1 << 14)].T
                q = q + part.start
                expanded[q, v] = True
                onward = adjacency[v]
                q2, v2 = np.repeat(q, onward.shape[1]), onward.ravel()
                new = (v2 >= 0) & ~seen[q2, v2]
                if new.any():
                    pairs = np.unique(q2[new] * np.int64(n) + v2[new])
                    visit(pairs // n, pairs % n)
    return found


def _slices(rows: int, width: int) -> Iterator[slice]:
    """Runs of the rows of a matrix, of at most SLICE entries or one row."""
    step = max(1, SLICE // max(width, 1))
    return (slice(lo, min(rows, lo + step)) for lo in range(0, rows, step))


def _lower(regions: pd.Series, here: int) -> tuple[np.ndarray, np.ndarray]:
    """The regions of each row that are below `here`, padded, and where there is one."""
    lists = [[r for r in held if r < here] for held in regions]
    width = max(map(len, lists), default=0)
    ids, real = np.zeros((len(lists), width), np.int64), np.zeros((len(lists), width), bool)
    for i, held in enumerate(lists):
        ids[i, : len(held)], real[i, : len(held)] = held, True
    return ids, real


def _met_below(lower: tuple[np.ndarray, np.ndarray], q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Of each pair (q[i], v[j]), whether a lower region has both."""
    ids, real = lower
    met = np.zeros((len(q), len(v)), bool)
    for a in range(ids.shape[1]):
        for b in range(ids.shape[1]):
            met |= (ids[q, a][:, None] == ids[v, b]) & real[q, a][:, None] & real[v, b]
    return met


def _join_blocks(x: np.ndarray, copies: np.ndarray, lower: tuple, q: np.ndarray, v: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(links of each row, forest a, b) by all pairs of the rows q and v; these are equal or have no row in common."""
    links, a, b = np.zeros(len(x), np.int64), q[:0], v[:0]
    same = np.array_equal(q, v)
    for part in _slices(len(q), len(v)):
        near = x[q[part]] @ x[v].T >= least
        near &= ~_met_below(lower, q[part], v) & (q[part][:, None] != v)
        links[q[part]] += near @ copies[v]
        if not same:
            links[v] += copies[q[part]] @ near
        i, j = np.nonzero(near)
        if len(i):
            a, b = forest(np.concatenate([a, q[part][i]]), np.concatenate([b, v[j]]))
    return links, a, b


def _linked(nodes: np.ndarray, links: np.ndarray, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    size = max(len(nodes), len(a))
    pad = lambda s: pd.Series(s, dtype="Int64").reindex(range(size))
    return pd.DataFrame({"node": pad(nodes), "links": pad(links), "a": pad(a), "b": pad(b)})


def _links(nodes: DataFrame, scratch: Scratch, least: float, beam: int, cell_size: int, region_size: int, block: int) -> tuple[DataFrame, DataFrame]:
    """(node, links) and links of a forest (a, b). nodes: node, region0, vec, copies."""
    apart = 0.85
    wide = cover(nodes, "home", region_size, apart, scratch)
    region = F.xxhash64("home", "cell")
    wide = scratch.keep(wide.withColumn("region", region).drop("cell", "home"))
    regions = wide.groupBy("node").agg(F.sort_array(F.collect_set("region")).alias("regions"))
    counts = scratch.keep(wide.groupBy("region").count())
    dense = counts.filter(F.col("count") > region_size)
    linked = "node bigint, links bigint, a bigint, b bigint"
    blockwise = None
    if not dense.isEmpty():
        blockwise = _dense_links(wide.join(dense, "region").join(regions, "node"), least, max(1, region_size // 2), linked)
        wide = wide.join(dense, "region", "left_anti")
    cells = cover(wide.select("node", "region", "vec"), "region", cell_size, apart, scratch)

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node")
        x, ids = _unit(rows["vec"]), rows["node"].to_numpy()
        medoid = int((x @ x.mean(axis=0)).argmax())
        near = robust_prune(x)
        return pd.DataFrame(
            {"region": rows["region"], "node": ids, "near": [list(ids[r[r >= 0]]) for r in near], "medoid": np.arange(len(ids)) == medoid}
        )

    lists = cells.groupBy("region", "cell").applyInPandas(build, "region bigint, node bigint, near array<bigint>, medoid boolean")
    graph = lists.groupBy("region", "node").agg(
        F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"), F.max("medoid").alias("medoid")
    )
    sizes = counts.select("region", F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    whole = (
        wide.join(graph, ["region", "node"]).join(regions, "node").join(sizes, "region")
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node", ignore_index=True)
        x, ids = _unit(rows["vec"]), rows["node"].to_numpy()
        queries = np.flatnonzero(rows["own"].to_numpy() == rows["block"].iloc[0])
        if not len(queries):
            return pd.DataFrame({"node": [], "links": [], "a": [], "b": []})
        lists = rows["near"].map(np.asarray).to_list()
        adjacency = np.full((len(ids), max(map(len, lists), default=0) or 1), -1, np.int64)
        for i, near in enumerate(lists):
            adjacency[i, : len(near)] = np.searchsorted(ids, near)
        found = range_search(x, adjacency, np.flatnonzero(rows["medoid"].to_numpy()), queries, least, beam)
        found[np.arange(len(queries)), queries] = False
        lower, copies = _lower(rows["regions"], rows["region"].iloc[0]), rows["copies"].to_numpy()
        links, a, b = np.zeros(len(queries), np.int64), ids[:0], ids[:0]
        for part in _slices(len(queries), len(ids)):
            near = found[part] & ~_met_below(lower, queries[part], np.arange(len(ids)))
            links[part] = near @ copies
            q, v = np.nonzero(near)
            if len(q):
                a, b = forest(np.concatenate([a, ids[queries[part][q]]]), np.concatenate([b, ids[v]]))
        return _linked(ids[queries], links, a, b)

    met = whole.groupBy("region", "block").applyInPandas(search, linked)
    met = scratch.keep(met if blockwise is None else met.unionAll(blockwise))
    counted = met.filter("node IS NOT NULL").groupBy("node").agg(F.sum("links").alias("links"))
    return counted, met.filter("a IS NOT NULL").select("a", "b")


def _dense_links(rows: DataFrame, least: float, block: int, linked: str) -> DataFrame:
    """Links of regions (region, node, vec, copies, count, regions) by all pairs, a task for each pair of blocks of about `block` rows."""
    dealt = rows.withColumn("parts", F.ceil(F.col("count") / block).cast("int")).withColumn(
        "own", F.pmod(F.xxhash64(F.lit("block"), "node"), F.col("parts")).cast("int")
    )
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumns(
        {"low": F.least("own", "other"), "high": F.greatest("own", "other")}
    )

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        ids, own = rows["node"].to_numpy(), rows["own"].to_numpy()
        q, v = (np.flatnonzero(own == rows[end].iloc[0]) for end in ("low", "high"))
        lower = _lower(rows["regions"], rows["region"].iloc[0])
        links, a, b = _join_blocks(_unit(rows["vec"]), rows["copies"].to_numpy(), lower, q, v, least)
        return _linked(ids, links, ids[a], ids[b])

    return pairs.groupBy("region", "low", "high").applyInPandas(join, linked)


def audit(nodes: DataFrame, counted: DataFrame, least: float, queries: int = 256) -> float:
    """Share of the links of about `queries` nodes, chosen by a hash, that the search found; the
    mean share of a node where that is less, as one large group else decides the figure.

    The chosen nodes are compared with all nodes of their label, in blocks; what is
    broadcast is the chosen vectors, a bounded number.
    """
    total = max(nodes.count(), 1)
    draw = F.pmod(F.xxhash64(F.lit("audit"), "node"), F.lit(1 << 30)) / float(1 << 30)
    chosen = nodes.filter(draw < queries / total).limit(2 * queries).select("home", "node", "vec").toPandas()
    if not len(chosen):
        return 1.0
    by_home = {home: (rows["node"].to_numpy(), _unit(rows["vec"])) for home, rows in chosen.groupby("home")}

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for home, rows in frame[frame["home"].isin(by_home)].groupby("home"):
                ids, x = by_home[home]
                near = (x @ _unit(rows["vec"]).T >= least) & (ids[:, None] != rows["node"].to_numpy())
                yield pd.DataFrame({"node": ids, "true": near @ rows["copies"].to_numpy()})

    true = nodes.mapInPandas(compare, "node bigint, true bigint").groupBy("node").agg(F.sum("true").alias("true"))
    held = true.filter(F.col("true") > 0).join(counted, "node", "left").withColumn("found", F.least(F.col("true"), F.coalesce("links", F.lit(0))))
    row = held.agg((F.sum("found") / F.sum("true")).alias("links"), F.avg(F.col("found") / F.col("true")).alias("nodes")).first()
    return 1.0 if row["links"] is None else min(row["links"], row["nodes"])


def near_duplicates(
    embeddings: DataFrame, least: float = 0.93, scratch: Scratch | None = None, least_recall: float = 0.9,
    beam: int = 24, cell_size: int = 512, region_size: int = 32_768, block: int = 2048,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of `embeddings` (vec_id, embedding, label).

    Rows are linked if their labels are equal and not null, their vectors are of one length
    and their cosine is at least `least`. Null, zero and non-finite vectors link with nothing.
    `n_links` counts rows, repeated ones too. `component_id`: the smallest vec_id reachable.
    The audited recall of the graph must reach `least_recall`; else the beam is doubled, up to
    twice, before the operator refuses to return.
    """
    scratch = scratch or Scratch(embeddings.sparkSession)
    rows = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("vec"), "label")
    sound = rows.filter(F.col("label").isNotNull() & usable(F.col("vec")))
    home = F.xxhash64(F.col("label"), F.size("vec")).alias("home")
    nodes = scratch.keep(
        sound.groupBy("label", "vec").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first"))
        .select(F.monotonically_increasing_id().alias("node"), home, "label", "vec", "copies", "first")
    )
    light = nodes.select("node", "home", "vec", "copies")
    for attempt in range(3):
        counted, links = _links(light, scratch, least, beam << attempt, cell_size, region_size, block)
        recall = audit(light, counted, least)
        log.info("recall %.4f at a beam of %d", recall, beam << attempt)
        if recall >= least_recall:
            break
    else:
        raise RuntimeError(f"recall {recall:.3f} stayed under {least_recall}")
    roots = connected_components(links, scratch).toDF("node", "root")
    joined = nodes.join(roots, "node", "left").join(counted, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    named = joined.join(smallest, "root").select(
        F.col("label").alias("_label"), F.col("vec").alias("_vec"), "component_id",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    named = scratch.keep(named)
    out = rows.join(named, (F.col("label") == F.col("_label")) & (F.col("vec") == F.col("_vec")), "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
