"""The ingest job: XML documents to checked tables, all or nothing."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tagloom.errors import IngestError
from tagloom.operators.outline import outlines
from tagloom.operators.places import is_faulty, located
from tagloom.operators.quality import (
    ERROR,
    broken_sources,
    count_rows,
    damages,
    findings,
    refuse_unbound,
    sources_to_reread,
)
from tagloom.operators.rows import split_rows
from tagloom.operators.typed import (
    good_rows,
    plain_rows,
    rejected_rows,
    type_plain,
    type_rows,
    untyped_rows,
)
from tagloom.plans import sink
from tagloom.plans.events import record_events, rows_by_table
from tagloom.plans.workspace import (
    new_run_id,
    new_work_folder,
    small_methods,
    store,
    work_folder,
)
from tagloom.sources import Layout, layout, read_archive_records, read_packed_records, read_records, read_whole_rows
from tagloom.sources.archive import ZIP_GLOB
from tagloom.sources.documents import BAD_DOCUMENT, empty_files, list_files
from tagloom.sources.heads import UTF8
from tagloom.spec import Registry, default_registry

# Fixed value: the document inside an archive.
DEFAULT_MEMBER = "SolutionDataset.xml"

TEXT, ZIP, WHOLE = "text", "zip", "whole"
DECODED = "decoded"  # in place of an encoding: text of archives
STRICT, QUARANTINE = "strict", "quarantine"


@dataclass(frozen=True)
class Source:
    """Documents to read.

    kind: ``text`` for plain XML, packed by gzip or not, split over many tasks; ``zip`` for archives;
    ``whole`` for plain XML read one document per task. `prefix` is the namespace
    prefix of the row elements; None takes that of each document's root.
    """

    paths: str | list[str]
    kind: str = TEXT
    member: str = DEFAULT_MEMBER
    prefix: str | None = None

    def __post_init__(self) -> None:
        if self.kind not in (TEXT, ZIP, WHOLE):
            raise IngestError(f"unknown kind of source: {self.kind}")

    def layout(self, spark: SparkSession) -> Layout:
        """How the files are read: cut by prefix, as a whole, or not at all."""
        if self.kind == TEXT:
            return layout(spark, self.paths, self.prefix)
        paths = [self.paths] if isinstance(self.paths, str) else self.paths
        glob = ZIP_GLOB if self.kind == ZIP else None
        read = [r.source for r in list_files(spark, paths, glob).select("source").collect()]
        empty = empty_files(spark, paths, glob, read)
        if self.kind == ZIP:
            return Layout(cut={(self.prefix or "", DECODED): paths}, empty=empty)
        return Layout(whole=paths, empty=empty)

    def records(self, spark: SparkSession, found: Layout) -> dict[tuple[str, str], DataFrame]:
        """The records of the files that are cut, by prefix and encoding."""
        if self.kind == ZIP:
            return {k: read_archive_records(spark, f, self.member, k[0]) for k, f in found.cut.items()}
        ways = ((read_records, found.cut), (read_packed_records, found.packed))
        parts = {key: [read(spark, files[key], *key) for read, files in ways if key in files] for key in {**found.cut, **found.packed}}
        return {key: reduce(DataFrame.unionByName, frames) for key, frames in parts.items()}

    def whole_rows(
        self, spark: SparkSession, registry: Registry, paths: list[str], only: DataFrame | None = None
    ) -> DataFrame:
        return read_whole_rows(spark, paths, registry.children(), self.member if self.kind == ZIP else None, only)


def read_table(
    spark: SparkSession,
    source: Source,
    name: str,
    registry: Registry | None = None,
    mode: str = STRICT,
) -> DataFrame:
    """One table of a source without loading it.

    Damaged documents and bad rows of the table are an error, or are left out in mode
    ``quarantine``. The typed rows are written to the shared folder, where the result
    reads them; the source is scanned once. For several tables `ingest` reads it once.
    """
    _check_mode(mode)
    only = Registry.of((registry or default_registry())[name])
    work = new_work_folder(spark)
    typed, counted = stage(spark, source, only, work)
    if mode == STRICT:
        raise_on_errors(findings(counted, faults(typed, counted, work), only))
    return good_rows(typed, only[name])


def stage(
    spark: SparkSession, source: Source, registry: Registry, work: str
) -> tuple[DataFrame, DataFrame]:
    """Typed rows of all tables and their counts, written to the work folder.

    The source is scanned once. That pass types the plain rows and keeps the few
    other records as they are; a second, small pass takes them from there. Documents
    that cannot be cut into rows are then read as a whole.
    """
    found = source.layout(spark)
    parts = []
    with small_methods(spark):
        for number, ((prefix, encoding), records) in enumerate(source.records(spark, found).items()):
            first = store(type_plain(records, registry, prefix), work, f"first{number}")
            others = first.filter(~F.col("done")).select("source", "split", "at", "source_status", "record")
            rows = split_rows(others, registry, prefix, decoded=encoding != UTF8)
            second = store(type_rows(rows, registry), work, f"second{number}")
            parts.append(plain_rows(first, second, registry).unionAll(second))
        if found.whole:
            parts.append(store(type_rows(source.whole_rows(spark, registry, found.whole), registry), work, "whole"))
    return _judged(spark, parts, source, found, registry, work, type_rows)


def survey(spark: SparkSession, source: Source, registry: Registry, work: str) -> tuple[DataFrame, DataFrame]:
    """`tagloom.operators.typed.untyped_rows` of all records and their counts, written to the work folder.

    The source is scanned once, and no value is typed or written.
    """
    found = source.layout(spark)
    parts = []
    with small_methods(spark):
        for number, ((prefix, encoding), records) in enumerate(source.records(spark, found).items()):
            rows = split_rows(records, registry, prefix, decoded=encoding != UTF8)
            parts.append(store(untyped_rows(rows, registry), work, f"rows{number}"))
        if found.whole:
            parts.append(store(untyped_rows(source.whole_rows(spark, registry, found.whole), registry), work, "whole"))
    return _judged(spark, parts, source, found, registry, work, untyped_rows)


def _judged(
    spark: SparkSession, parts: list[DataFrame], source: Source, found: Layout, registry: Registry, work: str, shape: Callable
) -> tuple[DataFrame, DataFrame]:
    empty = _unread(spark, found.empty, registry, shape)
    rows = reduce(DataFrame.unionByName, [*parts, empty]) if parts else empty
    counted = store(count_rows(rows), work, "counted")
    return heal(rows, counted, source, found, registry, work, shape)


def faults(typed: DataFrame, counted: DataFrame, work: str) -> DataFrame:
    """The faulty lines of `typed` with their places; looked for only where the counts tell of some."""
    if counted.filter(is_faulty()).isEmpty():
        return typed.limit(0)
    return store(located(typed), work, "faults")


def _names(spark: SparkSession, names: list[str]) -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], "source string")


def _unread(spark: SparkSession, sources: list[str], registry: Registry, shape: Callable) -> DataFrame:
    """Lines that report documents without content."""
    lines = _names(spark, sources).select(
        "source",
        F.lit(BAD_DOCUMENT).alias("status"),
        F.lit(None).cast("string").alias("tag"),
        F.lit(0).alias("depth"),
        F.lit(0).cast("bigint").alias("elements"),
        F.lit(None).cast("map<string,string>").alias("fields"),
        *[F.lit(None).cast("bigint").alias(c) for c in ("at", "offset", "line")],
    )
    return shape(lines, registry)


def heal(
    typed: DataFrame,
    counted: DataFrame,
    source: Source,
    found: Layout,
    registry: Registry,
    work: str,
    shape: Callable = type_rows,
) -> tuple[DataFrame, DataFrame]:
    """Read sources that cannot be cut into rows again, as whole documents.

    Where that reading finds the document well formed it replaces the first one;
    where it does not, the rows found by cutting stay, each judged by itself and by the
    prefixes its document declares, and the document is reported.
    """
    spark = typed.sparkSession
    cut = [path for group in (found.cut, found.packed) for files in group.values() for path in files]
    if not cut:
        return typed, counted
    unsafe = sources_to_reread(counted, outlines(typed))
    if found.whole or found.empty:  # not cut
        unsafe = unsafe.join(typed.filter("split IS NULL AND tag IS NULL").select("source"), "source", "left_anti")
    unsafe = store(unsafe, work, "unsafe")
    if unsafe.isEmpty():
        return typed, counted
    again = store(shape(source.whole_rows(spark, registry, cut, unsafe), registry), work, "again")
    whole = again.select("source").distinct().join(broken_sources(again), "source", "left_anti")
    healed = store(whole, work, "healed")
    typed = (
        refuse_unbound(typed.join(healed, "source", "left_anti"), unsafe)
        .unionByName(again.join(healed, "source", "left_semi"))
        .unionByName(_newly_damaged(again, typed))
    )
    typed = store(typed, work, "typed")
    return typed, store(count_rows(typed), work, "recounted")


def _newly_damaged(again: DataFrame, typed: DataFrame) -> DataFrame:
    """Damage that only the second reading has seen."""
    return damages(again).join(broken_sources(typed), "source", "left_anti")


def _check_mode(mode: str) -> None:
    if mode not in (STRICT, QUARANTINE):
        raise IngestError(f"unknown mode: {mode}")


def ingest(
    spark: SparkSession,
    source: Source,
    database: str,
    *,
    registry: Registry | None = None,
    mode: str = STRICT,
    overwrite: bool = False,
    max_records_per_file: int | None = None,
    keep_previous: bool = False,
) -> DataFrame:
    """Load the documents into the tables of `database`; return rows per table.

    strict: any violation or damaged document fails the load and leaves the
    tables as they were. quarantine: violating rows go to ``<table>__rejects``.
    Both record what they found in ``ingest_events``. All tables change at once, and of
    loads of a database at the same time only the first to end is published.
    """
    registry = registry or default_registry()
    _check_mode(mode)
    sink.check_max_records(max_records_per_file)
    if not overwrite:
        sink.refuse_existing(spark, database, registry)
    run_id = new_run_id()
    sink.create_database(spark, database)
    seen = sink.current(spark, database)
    load = sink.new_load(seen)
    with work_folder(spark) as work:
        typed, counted = stage(spark, source, registry, work)
        bad = faults(typed, counted, work)
        events = record_events(spark, database, run_id, findings(counted, bad, registry))
        if mode == STRICT:
            raise_on_errors(events)
        try:
            names = _write_load(typed, bad, database, load, registry, mode, max_records_per_file)
            sink.publish(spark, database, names, load, seen)
        except Exception:
            sink.discard(spark, database, load)
            raise
    if not keep_previous:
        sink.drop_loads(spark, database, {load, seen.load})
    return rows_by_table(spark, events, registry)


def raise_on_errors(events: DataFrame) -> None:
    """Fail with the first findings of level ERROR, if there are any."""
    errors = events.filter(F.col("level") == ERROR)
    shown = errors.orderBy("source", "table_name", "rule", "column_name").limit(20).collect()
    if shown:
        lines = [
            f"{e.source}: {e.table_name or 'document'}: {e.rule}"
            + (f" in {e.column_name}" if e.column_name else "")
            + f", {e.occurrences} times"
            + (f", e.g. {e.sample!r}" if e.sample is not None else "")
            + (f", first at line {e.line}, byte {e.offset}" if e.line is not None else "")
            for e in shown
        ]
        if (total := errors.count()) > len(lines):
            lines.append(f"and {total - len(lines)} more of {total} findings")
        raise IngestError("\n".join(["the load was refused:", *lines]))


def _write_load(
    typed: DataFrame, bad: DataFrame, database: str, load: str, registry: Registry, mode: str, max_records: int | None
) -> list[str]:
    names = []
    for spec in registry:
        sink.write_table(good_rows(typed, spec), database, spec.name, load, max_records)
        names.append(spec.name)
        if mode == QUARANTINE:
            rejects = f"{spec.name}__rejects"
            sink.write_table(rejected_rows(bad, spec, registry), database, rejects, load, max_records)
            names.append(rejects)
    return names
