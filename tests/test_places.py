"""Where faults are, and runs of unknown tables: the same whatever the splits, and as brute force says."""

from __future__ import annotations

from itertools import groupby
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tagloom import IngestError, Source, ingest, read_table
from tagloom.plans.events import read_events
from tagloom.plans.profile import runs_of_unknown_tables
from tests.helpers import document, row
from tests.test_outline import splits_of

TEXTS = [
    document(*[row(name=f"é{k}" if k % 3 else None, object_id=str(k)) for k in range(9)]),
    document("\n\n<!-- two\nlines -->", row(), row(name="x", extra="<q:a/>"), row(index="x"), "<w>\n</w>", row(extra="<a><b></a></b>")),
]


def test_offsets_and_lines_do_not_depend_on_splits(spark, write, database):
    folder = write(*TEXTS)
    found = []
    for size in (300, 1 << 27):
        with splits_of(spark, size):
            ingest(spark, Source(folder), database, mode="quarantine", overwrite=True)
        rejects = spark.table(f"{database}.t_object__rejects").select("source", "offset", "line", "row_xml").collect()
        found.append(sorted(map(tuple, rejects)))
        for source, offset, line, xml in found[-1]:
            data = Path(source.removeprefix("file:").replace("//", "/")).read_bytes()
            assert data[offset:].startswith(xml.rpartition("</t_object>")[0].encode()) and data[:offset].count(b"\n") + 1 == line
    assert found[0] == found[1] and len(found[0]) == 6
    first = {}
    for source, offset, line, _ in found[0]:
        first[source] = min((offset, line), first.get(source, (1 << 60, 0)))
    events = read_events(spark, database, "ERROR").filter("table_name IS NOT NULL").groupBy("source").agg(F.min("offset"), F.min("line"))
    assert {r[0]: (r[1], r[2]) for r in events.collect()} == first


def test_the_parser_tells_where_it_stopped(spark, write):
    text = document(row(), "<w>\n</v>")
    line, offset = text[: text.index("</v>")].count("\n") + 1, text.index("</v>") + 2
    with pytest.raises(IngestError, match=f"first at line {line}, byte {offset}"):
        read_table(spark, Source(write(text), "whole"), "t_object")


def test_runs_of_unknown_tables(spark, write):
    tags = list("aabbbaacabbaaaaaacc")
    texts = [document(*[f"<t_{t}><x>1</x></t_{t}>" + (row() if k % 4 == 0 else "") for k, t in enumerate(tags[n:])]) for n in range(2)]
    folder = write(*texts)
    expected = {}
    for n in range(2):
        for tag, run in groupby(tags[n:]):
            runs, rows = expected.get((f"d{n}.xml", f"t_{tag}"), (0, 0))
            expected[f"d{n}.xml", f"t_{tag}"] = (runs + 1, rows + len(list(run)))
    for size in (250, 1 << 27):
        with splits_of(spark, size):
            found = runs_of_unknown_tables(spark, Source(folder)).collect()
        assert {(r.source.rsplit("/", 1)[-1], r.tag): (r.runs, r.rows) for r in found} == expected
