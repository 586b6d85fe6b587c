from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from tagloom.llm import simhash
from tagloom.llm.components import connected_components, forest
from tagloom.llm.simhash import fingerprint, near_duplicates, near_pairs, one_of_each, visits


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[k : k + 3]) for k in range(max(len(words) - 2, min(1, len(words))))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) << b for b in range(64))


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return {n: find(n) for n in nodes}


def brute(documents):
    codes = {d: plain(t) for d, t in documents}
    links = [(a, b) for a, b in combinations(codes, 2) if (codes[a] ^ codes[b]).bit_count() <= 2]
    return {(d, f"{codes[d]:016x}", c) for d, c in components(codes, links).items()}


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "a b", "A b\x0bC d É é", "x " * 50, "\x1c y\x85z"])
def test_fingerprint_equals_the_definition(text):
    assert fingerprint(None if text is None else text.encode()) == plain(text)


@pytest.mark.parametrize("depth", [0, 3, 60])
def test_trie_join_finds_exactly_the_pairs_within_the_budget(depth):
    rng = np.random.default_rng(depth)
    centre = rng.integers(0, 1 << 63, 1, dtype=np.uint64)
    near = centre ^ np.bitwise_xor.reduce(np.uint64(1) << rng.integers(0, 64 - depth, (200, 3)).astype(np.uint64), axis=1)
    b = np.unique(near)
    a = np.unique(np.concatenate([b[::2], b ^ np.uint64(1 << 63), rng.integers(0, 1 << 63, 50, dtype=np.uint64)]))
    i, j = near_pairs(a, b, depth, 2)
    expected = {(x, y) for x in range(len(a)) for y in range(len(b)) if int(a[x] ^ b[y]).bit_count() <= 2}
    assert set(zip(i.tolist(), j.tolist())) == expected and len(i) == len(expected)


@pytest.mark.parametrize("size,stride", [(2, 3), (4, 8), (10_000, 8)])
def test_near_codes_meet_in_exactly_one_node(spark, scratch, size, stride):
    rng = random.Random(size)
    codes = {rng.getrandbits(64) for _ in range(30)}
    codes |= {c ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for c in list(codes) * 2}
    codes = [c - (1 << 64) if c >> 63 else c for c in codes]
    frame = spark.createDataFrame([(c,) for c in codes], "fp long")
    where = {}
    for depth, node, fp in visits(frame, len(codes), scratch, size=size, stride=stride).collect():
        where.setdefault(fp, set()).add((depth, node))
    mask = (1 << 64) - 1
    home = lambda c: [(d, n) for d, n in where[c] if n & mask == (c & mask) >> 64 - d]
    for a, b in combinations(codes, 2):
        if ((a ^ b) & mask).bit_count() <= 2:
            shared = [n for n in where[a] & where[b] if n in home(a) or n in home(b)]
            assert len(shared) == 1


def test_near_duplicates_equal_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(300)]
    documents = []
    for group in range(25):
        text = [rng.choice(words) for _ in range(rng.choice([1, 2, 40, 300]))]
        for _ in range(rng.choice([1, 1, 2, 6])):
            copy = list(text)
            if rng.random() < 0.7:
                copy[rng.randrange(len(copy))] = rng.choice(words)
            documents.append((len(documents), " ".join(copy)))
    documents += [(1000, None), (1001, ""), (1002, " \n"), (1003, documents[4][1].upper())]
    frame = spark.createDataFrame([(d, t, 1, 2) for d, t in documents], "doc_id long, text string, fp int, component_id int")
    assert {tuple(r) for r in near_duplicates(frame).collect()} == brute(documents)
    monkeypatch.setattr(simhash.visits, "__defaults__", (2, 4, 8))
    monkeypatch.setattr(simhash, "PART", 3)
    assert {tuple(r) for r in near_duplicates(frame).collect()} == brute(documents)


def test_repeated_rows_null_ids_and_empty_tables(spark):
    rows = [(2, "a b c d"), (2, "a b c d"), (1, "a b c d"), (None, "q r s t u"), (None, "a b c d")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r[0] is None, r[0], r[2]) for r in near_duplicates(frame).collect() if r[1] == f"{plain('a b c d'):016x}")
    assert [c for _, _, c in found] == [1, 1, 1, 1]
    assert sorted(str(r["doc_id"]) for r in one_of_each(frame).collect()) == ["1", "None", "None"]
    empty = frame.limit(0)
    assert near_duplicates(empty).collect() == [] and one_of_each(empty).collect() == []


def test_components_of_chains_stars_and_rings(spark, scratch):
    chain = [(k, k + 1) for k in range(100, 160)]
    star = [(k, 500) for k in range(400, 450)]
    ring = [(k, (k + 1) % 7 + 900) for k in range(900, 907)]
    edges = chain + star + ring + [(1, 1), (2, 3), (3, 2)]
    found = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long"), scratch).collect()))
    edges.remove((1, 1))
    expected = components({n for e in edges for n in e}, edges)
    assert set(found) == set(expected)
    for a, b in combinations(found, 2):
        assert (found[a] == found[b]) == (expected[a] == expected[b])


def test_a_forest_joins_what_the_links_join():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 60, 90), rng.integers(0, 60, 90)
    x, y = forest(a, b)
    nodes = set(a.tolist()) | set(b.tolist())
    assert components(nodes, zip(a.tolist(), b.tolist())) == components(nodes, zip(x.tolist(), y.tolist()))
    assert len(x) < len(nodes)
