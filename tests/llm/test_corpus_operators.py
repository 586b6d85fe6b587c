"""URL reputation, Hilbert shards, WARC archives and the embedding graph against plain versions of themselves."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tagloom.llm import hilbert, neargraph, urls, warc
from tagloom.llm.queries import URL_RULES

# --- urls --------------------------------------------------------------------

URLS = [
    ("http://A.Example.NET/en/x?q#f", "a.example.net", "/en/x", "example.net/en/", "allow"),
    ("https://a.example.net/EN/", "a.example.net", "/EN/", "net/", "block"),
    ("https://example.net", "example.net", "", None, "allow"),
    ("ftp://xexample.net/en/", "xexample.net", "/en/", "net/", "block"),
    ("http://É.example.com/de/", "É.example.com", "/de/", "example.com/de/", "block"),
    ("http://b.org/fr/?/", "b.org", "/fr/", "org/fr/", "allow"),
    ("http://h.xy?a://b/c", "h.xy", "", None, "allow"),
    ("a/b://c.xy/d\ne", "c.xy", "/d\ne", None, "allow"),
    ("nothing", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
]


def test_hosts_paths_and_the_longest_rule(spark):
    pages = spark.createDataFrame([(k, u[0], "x") for k, u in enumerate(URLS)] + [(3, URLS[3][0], "x")], "page_id long, url string, host string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = sorted(tuple(r)[:5] for r in urls.judge_urls(pages, labels, URL_RULES).collect())
    assert found == sorted([(k, *u[1:]) for k, u in enumerate(URLS)] + [(3, *URLS[3][1:])])
    assert urls.judge_urls(pages.limit(0), labels, URL_RULES).collect() == []


LEVELS = {
    "a.b.co.uk": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "uk": ("uk", "uk"), "x.com": ("x.com", "com"), "y.x.com.": ("x.com", "com"),
    "a.co.uk:8080": ("a.co.uk", "co.uk"), "me:pw@www.x.org:1": ("x.org", "org"), "10.0.0.1": ("10.0.0.1", ""), "10.0.0.1:80": ("10.0.0.1", ""),
    "[::1]:80": ("[::1]", ""), "": ("", ""), "com.example": ("com.example", "example"), "a.com.au": ("a.com.au", "com.au"), "com": ("com", "com"),
}


def test_registered_domains_and_suffixes(spark):
    hosts = spark.createDataFrame([(h,) for h in LEVELS], "host string")
    assert {r[0]: (r[1], r[2]) for r in hosts.select("host", *urls.levels_of(F.col("host"))).collect()} == LEVELS


def test_reputation_equals_the_formulas_and_blocks_bad_hosts(spark):
    rng = np.random.default_rng(4)
    rates = {f"h{k}.{d}.{s}": r for s in ("com", "net") for d, r in (("good", 0.05), ("bad", 0.8)) for k in range(4)}
    pages, labels = [], []
    for k in range(4000):
        host = list(rates)[k % len(rates)]
        pages.append((k, host))
        if k % 3:
            bad = rng.random() < rates[host]
            labels.append((k, int(not bad or k % 2), int(bad and k % 2)))
    pages += [(9000, "new.bad.com"), (9001, "new.good.com"), (None, None)]
    labels += [(9001, None, None), (1, 1, 0), (8888, 0, 0)]
    frame, marks = spark.createDataFrame(pages, "page_id long, host string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    outcome = {}
    for d, q, t in labels:
        if q is not None:
            outcome[d] = max(outcome.get(d, 0), int(q == 0 or t == 1))
    n, k = Counter(h for p, h in pages if p in outcome), Counter(h for p, h in pages if outcome.get(p))
    hosts = {h for _, h in pages if h}
    up = {"host": lambda h: h, "domain": lambda h: ".".join(h.split(".")[-2:]), "suffix": lambda h: h.split(".")[-1]}
    mean = {None: (sum(k.values()) + 0.1) / (sum(n.values()) + 1)}
    parent = {"suffix": lambda x: None, "domain": up["suffix"], "host": up["domain"]}
    for level in ("suffix", "domain", "host"):
        ns, ks = Counter(), Counter()
        for h in hosts:
            ns[up[level](h)] += n[h]
            ks[up[level](h)] += k[h]
        m = {x: mean[parent[level](x)] for x in ns}
        used = [x for x in ns if ns[x]]
        q = sum(ns[x] * (ks[x] / ns[x] - m[x]) ** 2 / (m[x] * (1 - m[x])) for x in used)
        rho = (q - len(used)) / sum(ns[x] - 1 for x in used)
        s = min(1000, max(2, 1 / rho - 1)) if rho > 0 else 1000
        mean |= {x: (ks[x] + s * m[x]) / (ns[x] + s) for x in ns}
    found = {r["host"]: r for r in urls.reputation(frame, marks).collect() if r["host"]}
    assert set(found) == hosts
    for h in hosts:
        assert found[h]["n"] == n[h] and found[h]["k"] == k[h]
        assert found[h]["rate"] == pytest.approx(mean[h], rel=1e-9)
        assert found[h]["lower"] < found[h]["rate"] < found[h]["upper"]
    assert found["new.bad.com"]["rate"] > 0.5 > found["new.good.com"]["rate"]
    urls_of = frame.select("page_id", F.concat(F.lit("http://"), "host", F.lit("/")).alias("url"))
    verdicts = {r["host"]: r["verdict"] for r in urls.judge_urls(urls_of, marks).collect()}
    assert all((verdicts[h] == "block") == (".bad." in h) for h in hosts if not h.startswith("new"))


# --- shards ------------------------------------------------------------------


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2), (1, 5)])
def test_the_curve_visits_every_cell_in_steps_of_one(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    place = hilbert.hilbert_index(cells, bits)
    assert sorted(place) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(1) == 1).all()


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size string, slot int")


@pytest.mark.parametrize("rows", [0, 1, 23, 24, 100])
def test_shards_differ_by_one_row_and_slots_have_no_gap(spark, rows):
    made = [(k, None if k == 5 else "é" * (k % 7), None if k == 6 else f"l{k % 3}", f"src{k % 5}", None if k == 7 else k % 11, "", 1) for k in range(rows)]
    made += made[:2]
    found = hilbert.shards(documents(spark, made)).collect()
    assert len(found) == len(made)
    expected = sorted((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in made)
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == expected
    sizes = Counter(r["shard"] for r in found)
    assert set(sizes) <= set(range(24)) and max(sizes.values(), default=0) - min([sizes[s] for s in range(24)]) <= 1
    for s in sizes:
        assert sorted(r["slot"] for r in found if r["shard"] == s) == list(range(sizes[s]))
    ordered = sorted(found, key=lambda r: (r["shard"], r["slot"]))
    assert [r["curve"] for r in ordered] == sorted(r["curve"] for r in found)


def test_cells_and_places_on_the_curve_equal_brute_force(spark):
    rng = np.random.default_rng(6)
    made = [
        (k, "t", None if k % 50 == 7 else f"common-start-{rng.integers(40)}", f"s{rng.integers(600)}", None if k % 40 == 3 else int(rng.integers(5000)), "", 1)
        for k in range(1500)
    ]
    found = {r["doc_id"]: r["curve"] for r in hilbert.shards(documents(spark, made)).collect()}
    cells = []
    for column in (2, 3, 4):
        values = [r[column] for r in made]
        ranks = {v: k for k, v in enumerate(sorted({v for v in values if v is not None}))} if column < 4 else {v: v for v in values}
        codes = np.array([np.nan if v is None else ranks[v] for v in values], float)
        known = np.sort(codes[~np.isnan(codes)])
        bounds = np.unique([known[max(0, -(-k * len(known) // 256) - 1)] for k in range(1, 256)])
        cells.append(np.where(np.isnan(codes), 0, np.searchsorted(bounds, codes, "left")) * 256 // (len(bounds) + 1))
    place = hilbert.hilbert_index(np.stack(cells, 1))
    assert [found[r[0]] for r in made] == place.tolist()


def test_shards_narrow_every_dimension_and_are_written_as_files(spark, tmp_path):
    rng = np.random.default_rng(0)
    made = [(k, "t", f"l{rng.integers(8)}", f"https://common.example/{rng.integers(8):02}", int(rng.integers(1000)), "", 1) for k in range(2000)]
    docs = documents(spark, made)
    found = hilbert.shards(docs)
    rows = docs.drop("slot", "size").join(found, "doc_id").toPandas()
    share = [rows.groupby("shard")[c].nunique().mean() / rows[c].nunique() for c in ("lang", "source")]
    assert max(share) < 0.75
    hilbert.write_shards(docs.drop("slot"), found, f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == 2000 and back.select("shard").distinct().count() == 24
    assert all(len(list(p.glob("*.parquet"))) == 1 for p in (tmp_path / "out").glob("shard=*"))


def test_null_and_repeated_ids_are_written_once_each_in_files_of_bounded_size(spark, tmp_path):
    made = [(None if k % 3 == 0 else k % 7, None if k == 4 else f"text {k % 50}" * 9, f"l{k % 4}", f"s{k % 5}", k % 90, "", 1) for k in range(400)]
    made += [(None, "", "en", "s", 0, "", 1)] * 300
    docs = documents(spark, made).drop("slot", "size").repartition(7)
    found = hilbert.shards(docs, count=3)
    hilbert.write_shards(docs, found, f"{tmp_path}/out", file_bytes=1000)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert Counter(map(tuple, back.drop("shard").collect())) == Counter(r[:5] for r in made)
    sizes = {r["row_key"]: r["shard"] for r in found.collect()}
    once = {k for k, n in Counter(r["row_key"] for r in found.collect()).items() if n == 1}
    marked = back.withColumn("k", hilbert._row_key(back, hilbert.DIMENSIONS)).collect()
    assert all(r["shard"] == sizes[r["k"]] for r in marked if r["k"] in once) and once
    for shard in range(3):
        files = sorted((tmp_path / "out" / f"shard={shard}").glob("*.parquet"))
        assert len(files) > 1
        written = [zlib.crc32((t or "").encode()) for f in files for t in pq.ParquetFile(f).read()["text"].to_pylist()]
        assert written == [r["text_crc32"] for r in found.filter(F.col("shard") == shard).orderBy("slot").collect()]
    with pytest.raises(ValueError):
        hilbert.write_shards(docs.limit(9), found, f"{tmp_path}/other")


# --- archives ----------------------------------------------------------------


def fake(page, body):
    return f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:pages:{page}>\r\nContent-Length: {len(body)}\r\n\r\n{body}\r\n\r\n"


PAGES = [
    (1, "http://a/", "same"), (2, "http://b/", "same"), (3, None, ""), (4, "x\r\nWARC-Type: q", None),
    (5, "http://c/é", fake(77, "HTTP/1\r\n\r\nab") + fake(78, "zz") + "tail"), (6, "", "WARC/1.1\r\nWARC/1.1\r\n" * 3),
    (7, "u", "\r\n\r\nWARC/1.1\r\nContent-Length: 999999999999999999\r\n\r\n"), (8, "u", "é\n" * 5000 + "WARC/1.1\r\n" + "q" * 9000),
    (9, "u", "same"), (9, "u", "same"), (10, "u", "W"), (None, "u", "nameless"),
]


@pytest.mark.parametrize("split", ["1k", "128m"])
@pytest.mark.parametrize("min_bytes", [0, 5])
def test_archives_come_back_and_payload_text_is_no_record(spark, tmp_path, split, min_bytes):
    path = f"{tmp_path}/{uuid.uuid4().hex}"
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        pages = spark.createDataFrame([(*p, "extra", 1) for p in PAGES], "page_id long, url string, html string, digest string, size int").coalesce(2)
        warc.write_archives(pages, path, min_bytes)
        found = [tuple(r)[2:] for r in warc.read_archives(spark, path).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    largest = {}
    for p, _, html in PAGES:
        if p is not None and len((html or "").encode()) >= min_bytes:
            largest[html or ""] = max(p, largest.get(html or "", 0))
    expected = []
    for p, _, html in PAGES:
        data = (html or "").encode()
        leader = largest.get(html or "", p)
        kind = ("response", None) if leader == p or p is None else ("revisit", leader)
        expected.append((p, *kind, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode()))
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_urls_with_line_ends_of_any_kind_harm_no_record(spark, tmp_path):
    breaks = ["\r", "\n", "\x0b", "\x0c", "\x85", "\u2028", "\u2029", "\x00", "\x7f"]
    pages = [(k, f"http://a/{c}Content-Length: 5{c}x", f"<p>{k}</p>") for k, c in enumerate(breaks)]
    warc.write_archives(spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1), f"{tmp_path}/w")
    found = warc.read_archives(spark, f"{tmp_path}/w", strict=True).orderBy("page_id").collect()
    digests = [base64.b32encode(hashlib.sha1(h.encode()).digest()).decode() for _, _, h in pages]
    assert [(r["page_id"], r["payload_bytes"], r["payload_digest"]) for r in found] == [(k, 8, d) for k, d in enumerate(digests)]
    text = b"".join(p.read_bytes() for p in (tmp_path / "w").glob("part*")).decode()
    assert "/%E2%80%A8Content-Length" in text and "/%C2%85Content-Length" in text and "/%0AContent-Length" in text


def test_any_bigint_comes_back_as_page_id(spark, tmp_path):
    ids = [10**15, -7, 0, 2**63 - 1, -(2**63), 1234567890123456789]
    pages = [(k, "u", f"page {k}") for k in ids] + [(-9, "u", "page -7"), (10**16, "u", f"page {2**63 - 1}")]
    warc.write_archives(spark.createDataFrame(pages, "page_id long, url string, html string"), f"{tmp_path}/w")
    found = {(r["page_id"], r["record_type"], r["refers_to"]) for r in warc.read_archives(spark, f"{tmp_path}/w").collect()}
    assert found == {(k, "response", None) for k in ids} | {(-9, "revisit", -7), (10**16, "revisit", 2**63 - 1)}


def test_a_damaged_file_gives_the_records_before_the_damage(spark, tmp_path, scratch):
    path = f"{tmp_path}/w"
    pages = spark.createDataFrame([(k, "u", f"page {k} " * 9) for k in range(40)], "page_id long, url string, html string").coalesce(1)
    warc.write_archives(pages, path)
    file = next((tmp_path / "w").glob("part*"))
    data = file.read_bytes()
    at = data.index(b"urn:pages:20>")
    for crc in (tmp_path / "w").glob(".*.crc"):
        crc.unlink()
    file.write_bytes(data[:at].replace(b"Content-Length: 2", b"Content-Length: 2") + data[at:].replace(b"Content-Length: ", b"Content-Length: 9", 1))
    found = warc.read_archives(spark, path, scratch)
    assert {r["page_id"] for r in found.collect()} >= set(range(20))
    assert not {r["page_id"] for r in found.collect()} & set(range(21, 40))
    with pytest.raises(ValueError, match="do not reach the end"):
        warc.read_archives(spark, path, strict=True)
    ends = warc.chain_ends(warc.reachable(warc.candidates(spark, path, scratch), scratch)).collect()
    assert [r["complete"] for r in ends] == [False]


def test_an_empty_table_gives_an_empty_archive(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(pages, f"{tmp_path}/w")
    assert warc.read_archives(spark, f"{tmp_path}/w").collect() == []


# --- embeddings --------------------------------------------------------------


def plain_links(rows, least):
    unit = []
    for v, e, label in rows:
        good = label is not None and e is not None and all(x is not None and np.isfinite(x) for x in e) and any(x != 0 for x in e)
        x = np.array(e, float) if good else None
        unit.append((v, x / np.linalg.norm(x) if good else None, label))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [0] * len(rows)
    for i, (_, x, a) in enumerate(unit):
        for j, (_, y, b) in enumerate(unit[:i]):
            if x is not None and y is not None and a == b and len(x) == len(y) and x @ y >= least:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    smallest = {}
    for i, (v, _, _) in enumerate(unit):
        smallest[find(i)] = min(v, smallest.get(find(i), v))
    return sorted((v, links[i], smallest[find(i)], v == smallest[find(i)]) for i, (v, _, _) in enumerate(unit))


@pytest.mark.parametrize("sizes", [{}, {"cell_size": 24, "region_size": 10_000, "block": 50}, {"cell_size": 24, "region_size": 120, "block": 40}])
def test_links_and_components_equal_brute_force(spark, sizes):
    rng = np.random.default_rng(len(sizes))
    rows = []
    for label in (0, 1):
        centres = rng.normal(size=(60, 16))
        for c, centre in enumerate(centres):
            for _ in range(rng.choice([1, 1, 3]) if c else 40):
                rows.append((len(rows), (centre + 0.08 * rng.normal(size=16)).tolist(), label))
    rows += [(v + 5000, e, label) for v, e, label in rows[:9]] + [(7000, [2 * x for x in rows[3][1]], 0), (7001, rows[3][1], None)]
    rows += [(7002, None, 0), (7003, [0.0] * 16, 0), (7004, [float("nan")] * 16, 0), (7005, [None] * 16, 0), (7006, [1.0], 0), (7007, [2.0], 0), (7008, [], 0)]
    rows += [(7009, [1e-200] * 16, 1), (7010, [float("inf")] * 16, 1)]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, label int, node int, home int")
    found = sorted(map(tuple, neargraph.near_duplicates(frame, **sizes).collect()))
    expected = plain_links(rows, 0.93)
    true, got = sum(r[1] for r in expected), sum(r[1] for r in found)
    assert [r[0] for r in found] == [r[0] for r in expected]
    assert all(f[1] <= e[1] for f, e in zip(found, expected)) and got >= 0.97 * true
    if not sizes:
        assert found == expected
    assert all(f[2] >= e[2] for f, e in zip(found, expected)) and np.mean([f[2] == e[2] for f, e in zip(found, expected)]) > 0.97
    assert all(kept == (v == c) for v, _, c, kept in found)
    assert neargraph.near_duplicates(frame.limit(0)).collect() == []


def test_a_dense_group_larger_than_a_region_is_joined_in_blocks_of_bounded_size(spark, monkeypatch):
    rng = np.random.default_rng(8)
    centre, other = rng.normal(size=(2, 8))
    rows = [(k, (centre + 0.12 * rng.normal(size=8)).tolist(), 0) for k in range(300)]
    rows += [(k, (other + 0.3 * rng.normal(size=8)).tolist(), 0) for k in range(300, 400)]
    rows += [(k + 1000, e, label) for k, e, label in rows[:5]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    asked, block_join = [], neargraph._dense_links
    monkeypatch.setattr(neargraph, "_dense_links", lambda rows, least, block, linked: asked.append(block) or block_join(rows, least, block, linked))
    found = neargraph.near_duplicates(frame, cell_size=24, region_size=60, block=40)
    met = sorted(map(tuple, found.collect()))
    expected = plain_links(rows, 0.93)
    assert [r[0] for r in met] == [r[0] for r in expected] and met[:300] == expected[:300]
    assert all(f[1] <= e[1] for f, e in zip(met, expected)) and asked and set(asked) == {30}


def test_a_node_of_two_groups_takes_only_the_cells_of_each_and_small_groups_weigh_in_the_audit(spark, scratch):
    x = np.random.default_rng(3).normal(size=(90, 6))
    rows = [(k, g, x[k].tolist()) for g, lo, hi in ((1, 0, 60), (2, 30, 90)) for k in range(lo, hi)]
    nodes = spark.createDataFrame(rows, "node long, region long, vec array<double>")
    cells = Counter((r["node"], r["region"]) for r in neargraph.cover(nodes, "region", 10, 0.85, scratch).collect())
    assert set(cells) == {(k, g) for k, g, _ in rows} and set(cells.values()) == {2}
    held = [(k, 0, [1.0, 0.0], 1) for k in range(60)] + [(100 + k, 1 + k // 2, [0.0, 1.0], 1) for k in range(60)]
    frame = spark.createDataFrame(held, "node long, home long, vec array<double>, copies long")
    counted = spark.createDataFrame([(k, 59 if k < 60 else 0) for k, *_ in held], "node long, links long")
    assert neargraph.audit(frame, counted.filter("node < 60"), 0.93, queries=10_000) == pytest.approx(0.5)


def test_pruning_keeps_the_closest_and_spreads_the_rest():
    x = np.random.default_rng(0).normal(size=(300, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = neargraph.robust_prune(x, degree=8)
    close = x @ x.T - 2 * np.eye(300)
    assert all(close[i].argmax() in near[i] and i not in near[i] for i in range(300))
    assert len(neargraph.robust_prune(x[:1])) == 1 and (neargraph.robust_prune(x[:2])[:, 0] == [1, 0]).all()
