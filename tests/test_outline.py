"""Elements around rows, prefixes and comments: what cutting says of a document is what a parser says."""

from __future__ import annotations

import random
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tagloom import IngestError, Source, ingest, profile, read_table
from tagloom.operators.outline import outlines, reduced
from tagloom.plans.events import read_events
from tests.helpers import document, row, values, zipped


@contextmanager
def splits_of(spark, size):
    keys = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def plainly(tokens):
    """The same reduction, on a stack."""
    before, stack = [], []
    for t in tokens:
        if t == "!" or t.startswith("/") and stack and stack[-1] != t[1:]:
            return ["!"]
        if t == "*":
            if not stack:
                before.append(t)
        elif not t.startswith("/"):
            stack.append(t)
        elif stack:
            stack.pop()
            if not stack:
                before.append("*")
        else:
            before.append(t)
    short = []
    for t in before:
        if not (t == "*" and short[-2:] == ["*", "*"]):
            short.append(t)
    return short + stack


def test_reduction_merges(spark):
    rng = random.Random(5)
    sequences = [[rng.choice(["a", "/a", "a", "/a", "b", "/b", "*"]) for _ in range(rng.randint(0, 12))] for _ in range(400)]
    sequences += [["a", "/a"] * 9, ["a", "b", "/b", "/a", "!"], []]
    frame = spark.createDataFrame([(k, s, c := rng.randint(0, len(s)), s[:c], s[c:]) for k, s in enumerate(sequences)], "k int, s array<string>, c int, x array<string>, y array<string>")
    both = F.concat(reduced(F.col("x")), reduced(F.col("y")))
    for r in frame.select("s", reduced(F.col("s")).alias("whole"), reduced(both).alias("merged")).collect():
        assert r["whole"] == r["merged"] == plainly(r["s"]), r["s"]


def _rows_of(spark, source, mode="strict"):
    return sorted((tuple(r) for r in read_table(spark, source, "t_object", mode=mode).collect()), key=repr)


def test_wrappers_are_matched_without_a_second_reading(spark, write, monkeypatch):
    def refuse(*_args, **_kwargs):
        raise AssertionError("read again")

    monkeypatch.setattr("tagloom.plans.ingest.read_whole_rows", refuse)
    rows = [row(name=f"n{k}") for k in range(12)]
    each = [f'<part k="{k}"><list>{r}</list></part>\n' for k, r in enumerate(rows)]
    shapes = [
        document(*each),
        document("<all>", *rows[:6], "</all><all>", *rows[6:], "</all><none/>"),
        document(*[f"<a{k}>" for k in range(9)], *rows, *[f"</a{k}>" for k in reversed(range(9))]),
        document('<w xmlns="urn:x" a="1 &amp; 2">', *rows, "</w>"),
    ]
    expected = sorted([values(name=f"n{k}") for k in range(12)], key=repr)
    folder = write(*shapes)
    for size in (1000, 1 << 27):
        with splits_of(spark, size):
            assert _rows_of(spark, Source(folder)) == sorted(expected * len(shapes), key=repr)
    assert profile(spark, Source(folder)).agg(F.sum("faults")).first()[0] == 0
    archives = write(*[zipped(SolutionDataset=t) for t in shapes], suffix=".zip")
    assert _rows_of(spark, Source(archives, "zip")) == sorted(expected * len(shapes), key=repr)


def with_prefix(inner, declared=""):
    return document(row(extra=inner)).replace("<SolutionDataset ", f"<SolutionDataset {declared} ")


Q = 'xmlns:q="urn:q"'
SOUND = {
    "declared by the root": with_prefix("<q:x>1</q:x>", Q),
    "declared by the row": document(row(attributes=f" {Q}", extra="<q:x>1</q:x>")),
    "declared by the child": document(row(extra=f"<q:x {Q}>1</q:x>")),
    "declared by a wrapper": document(f"<w {Q}>", row(extra="<q:x>1</q:x>"), "</w>"),
    "an attribute with a prefix": with_prefix('<x q:y="1"/>', Q),
    "colons in values": document(row(extra="<x a='b:c = d'>u:v w:x = 1</x>")),
    "the prefix of xml": document(row(extra='<x xml:lang="en"/>')),
    "a comment": document("<!-- a - b -->", row(extra="<!-- c -->")),
    "hyphens in a section": document(row(extra="<x><![CDATA[<!-- a -- b -->]]></x>")),
}
UNSOUND = {
    "no declaration": with_prefix("<q:x>1</q:x>"),
    "an attribute without one": with_prefix('<x q:y="1"/>'),
    "declared by another wrapper": document(f"<w {Q}/>", row(extra="<q:x>1</q:x>")),
    "declared by another row": document(row(attributes=f" {Q}"), row(extra="<q:x>1</q:x>")),
    "declared by a sibling": document(row(extra=f"<a {Q}/><q:x>1</q:x>")),
    "a wrapper without one": document("<q:w>", row(), "</q:w>"),
    "a root without one": document(row()).replace("SolutionDataset", "q:SolutionDataset"),
    "two hyphens in a row": document(row(extra="<!-- a -- b -->")),
    "two hyphens beside rows": document(row(), "<!-- a -- b -->"),
    "three hyphens at the end": document(row(extra="<!-- a --->")),
    "crossing wrappers": document("<a>", row(), "<b>", row(), "</a></b>"),
    "a wrapper left open": document("<a>", row(), row()),
    "a wrapper closed twice": document("<a>", row(), "</a></a>", row()),
    "a row behind the root": document(row()) + row(),
    "a row before the root": row() + document(row(), head=""),
    "two roots": document(row()) + document(row(), head=""),
    "an attribute twice": document('<w a="1" a="2">', row(), "</w>"),
    "a bad reference": document('<w a="&nope;">', row(), "</w>"),
    "an end tag with an attribute": document("<w>", row(), '</w a="1">'),
}


def test_cutting_and_parsing_agree(spark, write, database):
    folder = write(*SOUND.values(), *UNSOUND.values())
    refused = {}
    with splits_of(spark, 500):
        for kind in ("text", "whole"):
            ingest(spark, Source(folder, kind), database, mode="quarantine", overwrite=True)
            run = read_events(spark, database, "ERROR").orderBy(F.desc("created")).first().run_id
            events = read_events(spark, database, "ERROR").filter(F.col("run_id") == run)
            refused[kind] = {r.source.rsplit("/", 1)[-1] for r in events.select("source").distinct().collect()}
    names = {f"d{k + len(SOUND)}.xml": name for k, name in enumerate(UNSOUND)}
    for kind, found in refused.items():
        assert found == set(names), (kind, [names.get(n, n) for n in found ^ set(names)])


def test_rows_with_unbound_prefixes_are_rejected_alone(spark, write, database):
    folder = write(document(row(name="a"), row(name="b", extra="<q:x/>"), row(name="c", extra="<!-- x -- y -->")))
    with pytest.raises(IngestError, match="malformed_row"):
        read_table(spark, Source(folder), "t_object")
    ingest(spark, Source(folder), database, mode="quarantine")
    assert [r.name for r in spark.table(f"{database}.t_object").collect()] == ["a"]
    rejects = spark.table(f"{database}.t_object__rejects").select("violations.rule", "row_xml").collect()
    assert sorted(r.rule for r in rejects) == [["malformed_row"]] * 2
    assert all(r.row_xml.startswith("<t_object>") for r in rejects)


@pytest.mark.parametrize("encoding", ["iso-8859-1", "windows-1252", "koi8-r"])
def test_encodings_of_one_byte_are_cut(spark, write, monkeypatch, encoding):
    def refuse(*_args, **_kwargs):
        raise AssertionError("read as a whole")

    monkeypatch.setattr("tagloom.plans.ingest.read_whole_rows", refuse)
    name = {"iso-8859-1": "ñ ß ½", "windows-1252": "€ ‰ “ÿ”", "koi8-r": "Ж я ═"}[encoding]
    text = document("<w>", *[row(name=f"{name}{k}") for k in range(20)], "</w>", head=f'<?xml version="1.0" encoding="{encoding}"?>\n')
    folder = write(text.encode(encoding), document(row()))
    with splits_of(spark, 700):
        assert _rows_of(spark, Source(folder)) == sorted([values(name=f"{name}{k}") for k in range(20)] + [values()], key=repr)


def test_a_byte_that_stands_for_nothing_is_refused(spark, write):
    head = '<?xml version="1.0" encoding="windows-1252"?>\n'
    data = document(row(name="a"), row(name="bad!"), head=head).encode("cp1252").replace(b"bad!", b"\x81")
    for kind in ("text", "whole"):
        with pytest.raises(IngestError):
            read_table(spark, Source(write(data), kind), "t_object")
    assert [r.name for r in read_table(spark, Source(write(data)), "t_object", mode="quarantine").collect()] == ["a"]


def _records(spark, records):
    """Records of sources: (source, split, at, tag, names of loose tags, foreign prefixes)."""
    some = "array<string>"
    frame = spark.createDataFrame(records, f"source string, split bigint, at bigint, tag string, names {some}, foreign {some}")
    none = F.array().cast(some)
    loose = F.struct(F.col("names").alias("tags"), none.alias("first_declares"), none.alias("declares"), none.alias("uses"))
    return frame.withColumn("loose", F.when(F.col("names").isNotNull(), loose)).drop("names")


def test_outlines_tell_rows_beside_the_root_over_splits(spark):
    row_, first, last = ("t_a", None, None), (None, ["r"], None), (None, ["/r"], None)
    given = {
        "around": [(0, 0, *first), (0, 1, *row_), (9, 1 << 33, *row_), (9, (1 << 33) + 1, *last)],
        "behind": [(0, 0, *first), (0, 1, *row_), (9, 1 << 33, *last), (9, (1 << 33) + 1, *row_)],
        "before": [(0, 0, *row_), (0, 1, *first), (9, 1 << 33, *last)],
        "foreign": [(0, 0, *first), (0, 1, "t_a", None, ["q"]), (9, 1 << 33, *row_), (9, (1 << 33) + 1, *last)],
        "untagged": [(0, 0, *row_), (9, 1 << 33, None, None, None)],
        "empty": [(0, 0, None, None, None)],
    }
    found = outlines(_records(spark, [(name, *r) for name, records in given.items() for r in records])).collect()
    assert {r.source: (r.tags, r.enclosed, r.unbound, r.scoped) for r in found} == {
        "around": (["*"], True, [], False),
        "behind": (["*"], False, [], False),
        "before": (["*"], False, [], False),
        "foreign": (["*"], True, ["q"], False),
        "untagged": ([], None, [], False),
        "empty": ([], True, [], False),
    }


def test_only_records_with_loose_tags_or_prefixes_are_collected_for_an_outline(spark):
    plan = outlines(_records(spark, [("a", 0, 0, "t_a", None, None)]))._jdf.queryExecution().analyzed().toString().split("\n")
    collected = [k for k, line in enumerate(plan) if "Aggregate [source" in line and "collect_set(" in line]
    assert collected and all("isnotnull(loose" in next(line for line in plan[k:] if "Filter" in line) for k in collected)
