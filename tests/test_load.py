"""Loading: all or nothing, overwrite, quarantine, archives, events, streaming."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tagloom import Field, IngestError, Registry, Source, TableSpec, default_registry, ingest
from tagloom import ingest_stream, profile, read_table
from tagloom.plans import sink
from tagloom.plans.events import read_events
from tagloom.plans.workspace import shared_folder, store
from tagloom.sources import read_archive_records
from tagloom.spec import INTEGER, VARCHAR
from tests.helpers import document, row, values, zipped


def _rows(spark, database, table="t_object"):
    return sorted((tuple(r) for r in spark.table(f"{database}.{table}").collect()), key=repr)


def _events(spark, database, level):
    events = read_events(spark, database, level).select("table_name", "rule", "column_name")
    return sorted((tuple(r) for r in events.collect()), key=repr)


def test_load_overwrite_and_failure(spark, write, database):
    good, bad = write(document(row())), write(document(row(name="b"), row(name=None)))
    stats = {r.table_name: r["rows"] for r in ingest(spark, Source(good), database).collect()}
    assert stats == {"t_object": 1, "t_property": 0, "t_key": 0, "(total)": 1}
    assert _rows(spark, database) == [values()]
    assert spark.table(f"{database}.t_key").schema == default_registry()["t_key"].schema

    with pytest.raises(IngestError, match="overwrite=True"):
        ingest(spark, Source(good), database)
    with pytest.raises(IngestError, match="missing_column in name"):
        ingest(spark, Source(bad), database, overwrite=True)
    assert _rows(spark, database) == [values()]
    assert ("t_object", "missing_column", "name") in _events(spark, database, "ERROR")

    open_before = spark.table(f"{database}.t_object")
    ingest(spark, Source(bad), database, overwrite=True, mode="quarantine")
    assert _rows(spark, database) == [values(name="b")]
    assert [tuple(r) for r in open_before.collect()] == [values()]  # its files are still there
    rejected = spark.table(f"{database}.t_object__rejects").collect()
    assert [(v.rule, v.column, v.value) for v in rejected[0].violations] == [
        ("missing_column", "name", None)
    ]
    assert rejected[0].row_xml.startswith("<t_object>")
    def loads():
        return sink._loads(spark, database, next(t for t in sink._tables(spark, database) if t.startswith("t_object__") and "rejects" not in t))

    assert len(loads()) == 2
    ingest(spark, Source(good), database, overwrite=True)
    assert len(loads()) == 2  # of three loads, the last two
    sink.vacuum(spark, database)
    assert loads() == {sink.current(spark, database).load}
    assert _rows(spark, database) == [values()]
    assert spark.table(f"{database}.t_object__rejects").count() == 0  # this load had none
    assert not list(Path(shared_folder(spark)).glob("tagloom_work_*/first0"))


def test_a_failed_load_leaves_nothing(spark, write, database, monkeypatch):
    ingest(spark, Source(write(document(row()))), database)
    written = sink.write_table

    def fail_at_third(table, database, name, *rest):
        if name == "t_key":
            raise RuntimeError("lost")
        written(table, database, name, *rest)

    monkeypatch.setattr(sink, "write_table", fail_at_third)
    with pytest.raises(RuntimeError, match="lost"):
        ingest(spark, Source(write(document(row(name="b")))), database, overwrite=True)
    assert _rows(spark, database) == [values()]
    assert all(sink._loads(spark, database, t) == {sink.current(spark, database).load} for t in sink._tables(spark, database))


def test_all_tables_change_at_once(spark, write, database, monkeypatch):
    """Whatever a reader asks between the steps of a load, all tables are of one load."""
    prop = "<t_property>" + "".join(f"<{f.source}>{{0}}</{f.source}>" for f in default_registry()["t_property"].fields) + "</t_property>"
    one, two = (write(document(row(object_id=str(k)), prop.format(k))) for k in (1, 2))
    ingest(spark, Source(one), database)
    both = f"SELECT (SELECT max(object_id) FROM {database}.t_object) AS o, (SELECT max(property_id) FROM {database}.t_property) AS p"
    seen, show = [], sink._show

    def look():
        seen.append(tuple(spark.sql(both).first()))

    monkeypatch.setattr(sink, "_show", lambda *args: (show(*args), look()))
    committed = sink.commit
    monkeypatch.setattr(sink, "commit", lambda *args: (look(), committed(*args), look()))
    pinned = sink.read_version(spark, database)
    ingest(spark, Source(two), database, overwrite=True)
    assert seen == [(1, 1)] * 4 + [(2, 2)]
    assert pinned["t_object"].first().object_id == pinned["t_property"].first().property_id == 1
    # one query looks the current load up once
    joined = spark.sql(f"SELECT count(*) FROM {database}.t_object JOIN {database}.t_property ON object_id = property_id")
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "ReusedSubquery" in plan


def test_of_two_loads_at_once_one_is_refused(spark, write, database, monkeypatch):
    ingest(spark, Source(write(document(row()))), database)
    late, publish = write(document(row(name="late"))), sink.publish

    def overtaken(*args):
        monkeypatch.setattr(sink, "publish", publish)
        ingest(spark, Source(write(document(row(name="first")))), database, overwrite=True)
        publish(*args)

    monkeypatch.setattr(sink, "publish", overtaken)
    with pytest.raises(IngestError, match="another load"):
        ingest(spark, Source(late), database, overwrite=True)
    assert _rows(spark, database) == [values(name="first")]
    seen = sink.current(spark, database)
    sink.commit(spark, database, seen, sink.new_load(seen))
    with pytest.raises(IngestError, match="another load"):
        sink.commit(spark, database, seen, sink.new_load(seen))


def test_a_table_with_other_columns(spark, write, database):
    folder = write(document("<t_band><a>1</a><b>x</b></t_band>"))
    first = Registry.of(TableSpec("t_band", (Field("a", INTEGER),)))
    second = Registry.of(TableSpec("t_band", (Field("a", INTEGER), Field("b", VARCHAR))))
    ingest(spark, Source(folder), database, registry=first)
    ingest(spark, Source(folder), database, registry=second, overwrite=True)
    assert _rows(spark, database, "t_band") == [(1, "x")]
    ingest(spark, Source(folder), database, registry=first, overwrite=True)
    assert _rows(spark, database, "t_band") == [(1,)]


def test_damaged_documents_are_refused(spark, write, database):
    whole = document(row(), row(name="b"))
    cut_off = whole.rpartition("<show>")[0]
    no_end = whole.replace("</SolutionDataset>", "")
    for text in (cut_off, no_end):
        with pytest.raises(IngestError):
            ingest(spark, Source(write(text)), database)
        with pytest.raises(IngestError, match="bad_document"):
            ingest(spark, Source(write(text), "whole"), database)
    empty = write(zipped(SolutionDataset=""), suffix=".zip")
    with pytest.raises(IngestError, match="bad_document"):
        ingest(spark, Source(empty, "zip"), database)
    assert ("unbalanced_document" in {r.rule for r in read_events(spark, database).collect()})
    assert not spark.catalog.tableExists(f"{database}.t_object")


def test_archives(spark, write, database):
    text = document(row(), row(name="b"), "<t_band><band_id>1</band_id></t_band>")
    inside = {"SolutionDataset": text, "Other": document(row(name="no"))}
    folder = write(zipped(**inside), zipped(SolutionDataset=document(row(name="c"))), suffix=".ZIP")
    ingest(spark, Source(folder, "zip"), database)
    assert _rows(spark, database) == sorted(
        [values(), values(name="b"), values(name="c")], key=repr
    )
    assert _events(spark, database, "WARNING") == [("t_band", "unknown_table", None)]

    ingest(spark, Source(folder, "zip", "*.xml"), database, overwrite=True)
    assert values(name="no") in _rows(spark, database)

    utf16 = write(zipped(SolutionDataset=text.replace("utf-8", "utf-16").encode("utf-16")), suffix=".zip")
    ingest(spark, Source(utf16, "zip"), database, overwrite=True)
    assert len(_rows(spark, database)) == 2

    nested = write(zipped(SolutionDataset=document(row(extra=row(name="in")), row())), suffix=".zip")
    ingest(spark, Source(nested, "zip"), database, overwrite=True)
    assert len(_rows(spark, database)) == 3

    damaged = bytearray(zipped(SolutionDataset=document(*[row(name=str(i)) for i in range(999)])))
    damaged[2000:2100] = bytes(100)
    for data, rule in (
        (zipped(Other=text), "member_missing"),
        (b"not a zip", "bad_archive"),
        (bytes(damaged), "bad_archive"),
    ):
        with pytest.raises(IngestError, match=rule):
            ingest(spark, Source(write(data, suffix=".zip"), "zip"), database, overwrite=True)
    assert len(_rows(spark, database)) == 3


def test_archive_blocks(spark, write):
    """Blocks of any size give the same records."""
    from tagloom.sources import read_archive_records

    text = document(*[row(name=f"n{i}", object_id=str(i)) for i in range(300)])
    folder = write(zipped(SolutionDataset=text), suffix=".zip")
    found = []
    for size in (10, 1000, 1 << 22):
        records = read_archive_records(spark, folder, "SolutionDataset.xml", block_bytes=size)
        found.append(sorted(r.record for r in records.collect()))
    assert len(found[2]) == 301
    rows_only = [sorted(r.partition("</t_object>")[0] for r in f if r.startswith("object>")) for f in found]
    assert rows_only[0] == rows_only[1] == rows_only[2]


def test_arguments(spark, write, database):
    good = write(document(row()))
    for size in (0, 1_000_001):
        with pytest.raises(IngestError, match="max_records_per_file"):
            ingest(spark, Source(good), database, max_records_per_file=size)
    with pytest.raises(IngestError, match="mode"):
        ingest(spark, Source(good), database, mode="other")
    with pytest.raises(IngestError, match="kind"):
        ingest(spark, Source(good, "other"), database)
    for member in ("", "a.txt"):
        with pytest.raises(IngestError, match="member"):
            ingest(spark, Source(good, "zip", member), database)
    with pytest.raises(IngestError, match="no .zip"):
        ingest(spark, Source(good, "zip"), database)
    with pytest.raises(IngestError, match="not known"):
        default_registry()["t_band"]
    with pytest.raises(IngestError, match="must start"):
        TableSpec("object", ())
    many = write(document(*[row(object_id=str(i)) for i in range(10)]))
    ingest(spark, Source(many), database, max_records_per_file=3, overwrite=True)
    assert spark.table(f"{database}.t_object").select(F.input_file_name()).distinct().count() == 4


def test_split_invariance(spark, write):
    rows = [row(name=f"n{i}" * (i % 7), object_id=str(i)) for i in range(2000)]
    folder = write(document(*rows))
    key, found = "spark.sql.files.maxPartitionBytes", set()
    before = spark.conf.get(key)
    try:
        for size in ("1000", "4097", "64k", "2m", "128m"):
            spark.conf.set(key, size)
            counted = profile(spark, Source(folder)).collect()
            found.add(tuple(sorted((str(r.tag), r["rows"], r.elements, r.faults) for r in counted)))
    finally:
        spark.conf.set(key, before)
    assert found == {(("None", 0, 1, 0), ("t_object", 2000, 16000, 0))}


def test_prefixed_documents(spark, write, database):
    text = document(row(), row(name="a &amp; b"), "<t_band><a/></t_band>")
    text = text.replace("<", "<s:").replace("<s:/", "</s:").replace("<s:?", "<?")
    folder = write(text.replace("xmlns=", "xmlns:s="))
    ingest(spark, Source(folder), database)
    assert _rows(spark, database) == [values(), values(name="a & b")]
    # a document with another prefix than the first one is read as a whole
    mixed = write(text.replace("xmlns=", "xmlns:s="), document(row(name="c")))
    ingest(spark, Source(mixed), database, overwrite=True)
    assert len(_rows(spark, database)) == 3
    ingest(spark, Source(mixed, prefix=""), database, overwrite=True)
    assert len(_rows(spark, database)) == 3


def test_many_files_to_read_again(spark, write, database):
    inner = document(row(extra=row(name="in")))
    folder = write(inner, document(row()), inner)
    ingest(spark, Source(folder), database)
    assert [r[1] for r in _rows(spark, database)].count("in") == 2
    archives = write(zipped(SolutionDataset=inner), zipped(SolutionDataset=inner), suffix=".zip")
    ingest(spark, Source(archives, "zip"), database, overwrite=True)
    assert len(_rows(spark, database)) == 4


def test_reading_heals_or_refuses(spark, write):
    """What `read_table` and `profile` say of documents that cannot simply be cut."""
    good = document(row())
    prefixed = document(row(name="p")).replace("<", "<s:").replace("<s:/", "</s:").replace("<s:?", "<?")
    latin = document(row(name="ñ"), head='<?xml version="1.0" encoding="iso-8859-1"?>').encode("latin-1")
    wide = document(row(name="w")).replace("utf-8", "utf-16").encode("utf-16")
    folder = write(
        document("<!-- ", row(name="c1"), row(name="c2"), "-->", row(name="real")), good,
        prefixed.replace("xmlns=", "xmlns:s="), latin, wide, document(row(extra=row(name="inner"))),
    )
    names = sorted(r.name for r in read_table(spark, Source(folder), "t_object").collect())
    assert names == sorted(["real", "SEN", "SEN", "p", "ñ", "w", "inner"])
    counted = profile(spark, Source(folder)).filter("tag = 't_object'").agg(F.sum("rows"), F.sum("faults")).first()
    assert tuple(counted) == (7, 0)
    archives = write(*[zipped(SolutionDataset=d) for d in (prefixed.replace("xmlns=", "xmlns:s="), good, wide)], suffix=".zip")
    assert sorted(r.name for r in read_table(spark, Source(archives, "zip"), "t_object").collect()) == ["SEN", "p", "w"]

    bad = write(document(row(), row(name=None, extra="<a><b></a></b>")))
    with pytest.raises(IngestError, match="malformed_row"):
        read_table(spark, Source(bad), "t_object")
    assert read_table(spark, Source(bad), "t_object", mode="quarantine").count() == 1
    assert profile(spark, Source(bad)).agg(F.sum("faults")).first()[0] > 0


NOT_WELL_FORMED = [
    document(row(), "<t_band><a>1</b></t_band>"),
    document(row(), "<x>&nope;</y>"),
    row() + row(),
    document(row(extra="<1a>x</1a>")),
    document(row()) + "<again/>",
    document(row()) + "text",
    document(row()).replace("</SolutionDataset>", "</Other>"),
    document(row(extra="<1a>x</1a>" + "<x>1</x>" * 3000)),
]


def test_documents_that_are_not_well_formed_are_refused(spark, write, database):
    folder = write(*NOT_WELL_FORMED, document(row(name="b")))
    with pytest.raises(IngestError):
        ingest(spark, Source(folder), database)
    events = read_events(spark, database, "ERROR").filter(F.col("rule").isin("bad_document", "malformed_row"))
    found = {r.source.rsplit("/", 1)[-1] for r in events.select("source").distinct().collect()}
    assert found == {f"d{k}.xml" for k in range(len(NOT_WELL_FORMED))}
    ingest(spark, Source(folder), database, mode="quarantine")
    assert values(name="b") in _rows(spark, database)


def test_both_ways_of_reading_a_row_agree(spark, write, database):
    """A row is plain or parsed by its length; neither changes what it says."""
    registry = Registry.of(
        TableSpec("t_a", (Field("w", INTEGER), Field("GUID", VARCHAR, required=False))),
        TableSpec("t_b", (Field("w", INTEGER), Field("guid", VARCHAR, required=False))),
    )
    found = []
    for padding in ("", "<pad>" + "x" * 9000 + "</pad>"):
        texts = [
            f"<t_{t}><w>{k}</w>{child}{padding}</t_{t}>"
            for t in "ab"
            for k, child in enumerate(["<GUID>keep</GUID>", "<guid>keep</guid>", "<Guid>keep</Guid>", "<guid/>", "<guid>7<sub>q</sub></guid>"])
        ]
        ingest(spark, Source(write(document(*texts))), database, registry=registry, overwrite=True)
        found.append([_rows(spark, database, t) for t in ("t_a", "t_b")])
        whole = read_table(spark, Source(write(document(*texts)), "whole"), "t_b", registry)
        assert sorted(map(tuple, whole.collect())) == sorted(found[-1][1])
    assert found[0] == found[1] == [[(k, v) for k, v in enumerate(["keep"] * 3 + ["", "7"])]] * 2


def test_entities_of_a_doctype(spark, write):
    head = '<?xml version="1.0"?><!DOCTYPE SolutionDataset [<!ENTITY who "SEN">]>'
    folder = write(document(row(name="&who;"), head=head))
    assert [tuple(r) for r in read_table(spark, Source(folder), "t_object").collect()] == [values()]


def test_one_bad_file_does_not_end_a_load(spark, write, database):
    encrypted = bytearray(zipped(SolutionDataset=document(row())))
    for mark, at in ((b"PK\x03\x04", 6), (b"PK\x01\x02", 8)):
        encrypted[encrypted.index(mark) + at] |= 1
    packed = bytearray(zipped(SolutionDataset=document(row())))
    for mark, at in ((b"PK\x03\x04", 8), (b"PK\x01\x02", 10)):
        packed[packed.index(mark) + at] = 97
    unknown = document(row()).replace("utf-8", "klingon")
    archives = write(
        bytes(encrypted), bytes(packed), zipped(SolutionDataset=unknown), zipped(SolutionDataset=""), zipped(Other="x"),
        b"", zipped(SolutionDataset=document(row())), suffix=".zip",
    )
    ingest(spark, Source(archives, "zip"), database, mode="quarantine")
    assert _rows(spark, database) == [values()]
    rules = [e[1] for e in _events(spark, database, "ERROR")]
    assert sorted(rules) == [
        "bad_document", "bad_document", "encrypted_member", "member_missing", "unknown_encoding", "unsupported_compression",
    ]
    plain = write(unknown, "", document(row(name="ж"), head='<?xml version="1.0" encoding="koi8-r"?>').encode("koi8-r"))
    ingest(spark, Source(plain), database, mode="quarantine", overwrite=True)
    assert _rows(spark, database) == [values(name="ж")]
    with pytest.raises(IngestError, match="bad_document"):
        ingest(spark, Source(write("")), database, overwrite=True)


def test_a_source_is_scanned_once(spark, write, monkeypatch):
    plans = []

    def kept(frame, work, name):
        plans.append((name, frame._jdf.queryExecution().executedPlan().toString()))
        return store(frame, work, name)

    monkeypatch.setattr("tagloom.plans.ingest.store", kept)
    text, archive = write(document(row())), write(zipped(SolutionDataset=document(row())), suffix=".zip")
    for folder, kind, scan in ((text, "text", "FileScan text"), (archive, "zip", "BatchScan")):
        plans.clear()
        read_table(spark, Source(folder, kind), "t_object").collect()
        assert sum(plan.count(scan) for name, plan in plans if name.startswith("first")) == 1
        assert not any(scan in plan for name, plan in plans if not name.startswith("first"))


def test_long_text_after_the_last_row_of_an_archive_is_cut(spark, write):
    from tagloom.sources import read_archive_records

    text = document(row(), "<x>" + "<y/>" * 5000 + "</x>")
    folder = write(zipped(SolutionDataset=text), suffix=".zip")
    records = read_archive_records(spark, folder, "SolutionDataset.xml", block_bytes=1000).collect()
    assert max(len(r.record) for r in records) < 4000
    assert read_table(spark, Source(folder, "zip"), "t_object").count() == 1


def test_registry(spark, write, database):
    registry = default_registry()
    registry.register(
        TableSpec(
            "t_band",
            (
                Field("band_id", INTEGER, column="band"),
                Field("size", INTEGER, required=False, default=7),
                Field("twice", INTEGER, convert=lambda v: v.try_cast("int") * 2),
            ),
        )
    )
    band = "<t_band><band_id>1</band_id><twice>{}</twice></t_band>"
    folder = write(document(band.format(4), band.format("x")))
    ingest(spark, Source(folder), database, registry=registry, mode="quarantine")
    assert _rows(spark, database, "t_band") == [(1, 7, 8)]
    assert ("t_band", "not_convertible", "twice") in _events(spark, database, "ERROR")
    assert registry.to_csv().splitlines() == ["table_name", "t_object", "t_property", "t_key", "t_band"]
    assert '"count": 4' in registry.to_json()
    assert registry.listing(spark).count() == 26
    sink.create_tables(spark, database, default_registry())


def test_stream(spark, write, tmp_path, database):
    folder = write(document(row(), row(name=None)), document(row(name="b")))
    checkpoint = str(tmp_path / "checkpoint")

    def run():
        ingest_stream(spark, folder, database, checkpoint, max_files_per_trigger=1).awaitTermination()
        return sorted(r.name for r in spark.table(f"{database}.t_object").collect())

    assert run() == ["SEN", "b"]
    (tmp_path / folder / "d9.xml").write_text(document(row(name="c"), row(extra=row(name="in"))))
    assert run() == ["SEN", "SEN", "b", "c", "in"]
    assert run() == ["SEN", "SEN", "b", "c", "in"]
    assert spark.table(f"{database}.t_object__rejects").count() == 1
    # a batch that is repeated replaces its own rows
    commits = sorted((tmp_path / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    assert run() == ["SEN", "SEN", "b", "c", "in"]


def test_two_streams_into_one_database(spark, write, tmp_path, database):
    folders = [write(document(row(name=n))) for n in ("first", "second")]
    for k, folder in enumerate(folders):
        ingest_stream(spark, folder, database, str(tmp_path / f"checkpoint{k}")).awaitTermination()
    assert sorted(r.name for r in spark.table(f"{database}.t_object").collect()) == ["first", "second"]
    loaded = read_events(spark, database, "INFO").filter("table_name = 't_object'")
    assert loaded.select("run_id").distinct().count() == 2
    archives = write(zipped(SolutionDataset=document(row(name="z"))), suffix=".zip")
    ingest_stream(spark, archives, database, str(tmp_path / "zips"), kind="zip").awaitTermination()
    assert spark.table(f"{database}.t_object").count() == 3


def test_shared_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_members_of_an_archive_are_partitions(spark, write):
    from tagloom.sources.members import Member, packed, read_members

    folder = write(zipped(**{f"m{k:02}": document(row(name=f"n{k}")) for k in range(50)}), suffix=".zip")
    archives = [(str(p), str(p)) for p in Path(folder).glob("*.zip")]
    blocks = read_members(spark, archives, "m*.xml", "<t_", 1 << 20)
    assert blocks.rdd.getNumPartitions() == 50
    assert read_table(spark, Source(folder, "zip", "m*.xml"), "t_object").count() == 50
    bins = packed([Member("s", "p", packed=k) for k in range(100)], 7)
    assert len(bins) == 7 and max(sum(m.packed for m in b) for b in bins) - min(sum(m.packed for m in b) for b in bins) < 100


def test_work_files_hold_ascending_numbers_as_differences(spark, tmp_path):
    rows = spark.range(0, 300_000, 1, 1).select((F.col("id") + (1 << 33)).alias("at"))
    assert store(rows, f"file://{tmp_path}", "rows").agg(F.sum("at")).first()[0] == 300_000 * (1 << 33) + 299_999 * 150_000
    assert sum(f.stat().st_size for f in tmp_path.glob("rows/*.parquet")) < 300_000


def test_columns_of_one_child(spark, write, database):
    """Plain rows, in order or not, and rows that are parsed; an absent child is missing in each required column."""
    band, twice = Field("n", INTEGER, column="band"), Field("n", INTEGER, column="twice", convert=lambda v: v.try_cast("int") * 2)
    maybe = Field("m", INTEGER, required=False, column="maybe"), Field("m", VARCHAR, required=False, column="text")
    registry = Registry.of(TableSpec("t_band", (band, twice, *maybe)))
    rows = ("<n>1</n><m>5</m>", "<m>6</m><n>2</n>", "<n>3</n>", "<n>4</n><m>7</m><!-- x -->", "<m>8</m>", "<n>x</n>")
    source = Source(write(document(*[f"<t_band>{r}</t_band>" for r in rows])))
    ingest(spark, source, database, registry=registry, mode="quarantine")
    assert _rows(spark, database, "t_band") == [(1, 2, 5, "5"), (2, 4, 6, "6"), (3, 6, None, None), (4, 8, 7, "7")]
    found = spark.table(f"{database}.t_band__rejects").collect()
    assert sorted([(v.rule, v.column) for v in r.violations] for r in found) == [
        [(rule, c) for c in ("band", "twice")] for rule in ("missing_column", "not_convertible")
    ]
    with pytest.raises(IngestError, match="child declared twice"):
        TableSpec("t_band", (band, Field("N", INTEGER, column="other")))


def test_blocks_of_archives_are_not_held_for_their_shuffle(spark, write):
    """They go to no more partitions than Spark writes row by row, however many other shuffles have."""
    folder = write(*[zipped(SolutionDataset=document(*[row(name=str(i)) for i in range(9)])) for _ in range(3)], suffix=".zip")
    shuffles, unheld = spark.conf.get("spark.sql.shuffle.partitions"), 200
    try:
        for asked, given in (("1000", unheld), ("3", 3)):
            spark.conf.set("spark.sql.shuffle.partitions", asked)
            records = read_archive_records(spark, folder, "SolutionDataset.xml", block_bytes=256)
            plan = records._jdf.queryExecution().executedPlan().toString()
            dealt = [int(n) for n in re.findall(r"Exchange hashpartitioning\(.*?, (\d+)\), REBALANCE", plan)]
            assert dealt == [given]
            assert records.filter("record LIKE 'object>%'").count() == 27
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
