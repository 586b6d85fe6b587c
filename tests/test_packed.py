"""Plain documents packed by gzip: the same records, rows and places as without, whatever the blocks and the stretches."""

from __future__ import annotations

import gzip
import random
from pathlib import Path

import pytest

import tagloom_fixtures as fx
from tagloom import IngestError, Source, ingest, profile
from tagloom.plans.events import read_events
from tagloom.sources import layout, packed, read_packed_records, read_records
from tests.conftest import SF
from tests.helpers import document, row


def blocked(text: bytes, size: int) -> bytes:
    return b"".join(packed.block(text[at : at + size]) for at in range(0, len(text), size)) + packed.LAST_BLOCK


def test_records_are_the_same_whatever_the_blocks_and_stretches():
    random.seed(1)
    for _ in range(500):
        text = "".join(random.choices(["<t_", "a", "<", "t_", "xyz"], k=random.randint(0, 60))).encode()
        places = [0, *sorted(random.choices(range(len(text) + 1), k=5)), len(text)]
        texts = [(10 * k, text[a:b]) for k, (a, b) in enumerate(zip(places, places[1:]))]
        ends = sorted({*random.choices(range(1, 60), k=3), 60})
        found = []
        for start, end in zip([0, *ends], ends):
            own = [t for t in texts if t[0] >= start]
            if own and own[0][0] < end:
                for records in packed.records_of(iter(own), end, b"<t_", start == 0, random.choice([1, 5, 100])):
                    found += records
        assert found == text.split(b"<t_")


@pytest.mark.parametrize("size, split_bytes", [(7, 700), (1000, 50), (packed.MOST_TEXT, 1 << 20)])
def test_records_are_those_of_the_plain_file(spark, write, size, split_bytes):
    text = document(*[row(object_id=str(k), name=f"é<![CDATA[{k}]]>") for k in range(30)]).encode() + b"\xff"
    plain = read_records(spark, write(text))
    found = read_packed_records(spark, write(blocked(text, size), suffix=".xml.gz"), split_bytes=split_bytes)
    told = [[r.record for r in f.selectExpr("split", "at", "hex(record) AS record").sort("split", "at").collect()] for f in (plain, found)]
    assert told[0] == told[1]


@pytest.mark.parametrize("pack", [gzip.compress, lambda t: blocked(t, 500), lambda t: gzip.compress(t[:99]) + gzip.compress(t[99:])])
def test_packed_documents_are_loaded_beside_plain_ones(spark, write, database, pack):
    texts = [document(*[row(object_id=str(10 * k + i)) for i in range(9)]).encode() for k in range(3)]
    latin = document(row(object_id="77", name="é"), head='<?xml version="1.0" encoding="iso-8859-1"?>\n').encode("latin-1")
    wide = document(row(object_id="78"), head='<?xml version="1.0" encoding="utf-16"?>\n').encode("utf-16")
    nested = document(f"<!-- {row(object_id='0')} -->" + row(object_id="79")).encode()
    folder = Path(write(texts[0]))
    for k, text in enumerate([*texts[1:], latin, wide, nested]):
        (folder / f"p{k}.xml.gz").write_bytes(pack(text))
    ingest(spark, Source(str(folder)), database)
    rows = spark.table(f"{database}.t_object").select("object_id", "name").collect()
    assert sorted(r.object_id for r in rows) == [10 * k + i for k in range(3) for i in range(9)] + [77, 78, 79]
    assert {r.name for r in rows if r.object_id == 77} == {"é"}


def test_faults_have_their_places_in_the_inflated_text(spark, write, database):
    text = document(*[row(object_id="x" if k % 7 == 0 else str(k)) for k in range(40)])
    places = {}
    for name, data, suffix in (("plain", text.encode(), ".xml"), ("packed", blocked(text.encode(), 300), ".xml.gz")):
        ingest(spark, Source(write(data, suffix=suffix)), f"{database}_{name}", mode="quarantine")
        rejects = spark.table(f"{database}_{name}.t_object__rejects").select("offset", "line", "row_xml")
        places[name] = sorted(map(tuple, rejects.collect()))
        spark.sql(f"DROP DATABASE {database}_{name} CASCADE")
    assert len(places["plain"]) == 6 and places["plain"] == places["packed"]


def test_damaged_packed_documents_are_reported_each_by_itself(spark, write, database):
    text = document(*[row(object_id=str(k * 7919)) for k in range(200)]).encode()
    folder = Path(write(gzip.compress(document(row()).encode()), suffix=".xml.gz"))
    for name, pack in (("stream", gzip.compress), ("blocks", lambda t: blocked(t, 500))):
        data = pack(text)
        half = len(data) // 2
        flipped = data[:half] + bytes([data[half] ^ 0x55]) + data[half + 1 :]
        for damage, damaged in (("cut", data[:half]), ("head", data[:20]), ("flip", flipped), ("empty", pack(b""))):
            (folder / f"{name}_{damage}.xml.gz").write_bytes(damaged)
    with pytest.raises(IngestError, match="bad_archive"):
        ingest(spark, Source(str(folder)), database)
    ingest(spark, Source(str(folder)), database, mode="quarantine", overwrite=True)
    events = read_events(spark, database, "ERROR").filter("rule LIKE 'bad_%'").collect()
    told = {(Path(e.source).name.split(".")[0], e.rule) for e in events}
    faults = {"cut": "bad_archive", "head": "bad_archive", "flip": "bad_archive", "empty": "bad_document"}
    assert told == {(f"{n}_{d}", rule) for n in ("stream", "blocks") for d, rule in faults.items()}
    assert spark.table(f"{database}.t_object").filter("object_id = 4").count() == 1


def test_blocked_documents_are_cut_into_several_partitions(spark, write):
    text = document(*[row(object_id=str(k * 7919)) for k in range(500)]).encode()
    files = [write(pack(text), suffix=".xml.gz") for pack in (lambda t: blocked(t, 1000), gzip.compress)]
    parts = [read_packed_records(spark, f, split_bytes=1000).rdd.getNumPartitions() for f in files]
    assert parts[0] > 5 and parts[1] == 1


def test_documents_of_all_tables_are_packed(spark):
    """As plain text they took ten times the disk (F1 to F7)."""
    folder = fx.documents(spark, SF, fx.everything)
    files = sorted(Path(folder.removeprefix("file:")).glob("*.gz"))
    texts = [gzip.decompress(f.read_bytes()).decode() for f in files]
    assert len(files) == fx.FILES and sum(f.stat().st_size for f in files) * 4 < sum(map(len, texts))
    opening, closing = fx._around()
    assert all(t.startswith(f"{opening}\n") and t.endswith(f"\n{closing}\n") for t in texts)
    rows = "".join(t[len(opening) + 1 : -len(closing) - 1] for t in texts)
    assert sorted(rows) == sorted("".join(f"{r.value}\n" for r in fx.everything(spark, SF).collect()))
    assert not layout(spark, folder).cut and len(layout(spark, folder).packed["", "utf-8"]) == fx.FILES
    assert profile(spark, Source(folder)).groupBy().sum("rows").first()[0] == rows.count("</t_")
