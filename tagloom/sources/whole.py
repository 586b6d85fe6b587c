"""Documents that cannot be cut into records.

A row inside a row, or a row start inside a comment or a CDATA section, cannot
be told apart without reading the document from its start. Such documents are
rare in this format; they are read here with a streaming parser, a document by
one task, in constant memory. The result has one line per row element.
"""

from __future__ import annotations

import codecs
import zipfile
from collections.abc import Iterator
from contextlib import ExitStack
from typing import BinaryIO
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tagloom.sources.archive import ZIP_GLOB, check_member
from tagloom.sources.documents import (
    BAD_DOCUMENT,
    chosen_files,
    encoding_of,
    fault_of,
    list_files,
    open_file,
    opened_document,
)

ROW_SCHEMA = (
    "source string, status string, tag string, depth int, elements bigint, "
    "fields map<string,string>, at bigint, offset bigint, line bigint"
)
_ARROW_SCHEMA = pa.schema(
    [
        ("source", pa.string()),
        ("status", pa.string()),
        ("tag", pa.string()),
        ("depth", pa.int32()),
        ("elements", pa.int64()),
        ("fields", pa.map_(pa.string(), pa.string())),
        ("at", pa.int64()),
        ("offset", pa.int64()),
        ("line", pa.int64()),
    ]
)
BATCH_ROWS = 10_000
READ_BYTES = 1 << 20


def read_whole_rows(
    spark: SparkSession,
    paths: str | list[str],
    children: list[str],
    member: str | None = None,
    only: DataFrame | None = None,
) -> DataFrame:
    """Rows of whole documents, in the shape of `tagloom.operators.rows.split_rows`.

    `only` keeps the documents named in its column `source`; with `member`, which reads ZIP
    archives, it has to be given, and names members as `archive!member`.
    Child names in `fields` are lower case and limited to `children`.
    """
    wanted = frozenset(c.lower() for c in children)
    if member is None:
        scan = chosen_files(spark, paths, only=only).withColumn("member", F.lit(None).cast("string"))
        return scan.mapInArrow(lambda batches: _parse(batches, wanted), ROW_SCHEMA)
    check_member(member)
    # the documents of an archive are spread over tasks, too
    archive, name = (F.regexp_extract("source", r"(?is)^(.*?\.zip)!(.*)$", k) for k in (1, 2))
    wanted_members = only.select(archive.alias("archive"), "source", name.alias("member"))
    files = list_files(spark, paths, ZIP_GLOB).select(F.col("source").alias("archive"), "path")
    scan = files.join(wanted_members, "archive").select("source", "path", "member").hint("rebalance", "source")
    return scan.mapInArrow(lambda batches: _parse(batches, wanted), ROW_SCHEMA)


def _parse(batches, wanted) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for source, path, member in zip(*(batch.column(c).to_pylist() for c in ("source", "path", "member"))):
            with ExitStack() as closing:
                if member is None:
                    stream, _ = closing.enter_context(opened_document(path))
                else:
                    archive = closing.enter_context(open_file(path))
                    stream = closing.enter_context(zipfile.ZipFile(archive).open(member))
                buffer = []
                for at, (*row, place) in enumerate(_rows(stream, wanted)):
                    buffer.append((source, *row, at, *place))
                    if len(buffer) >= BATCH_ROWS:
                        yield _batch(buffer)
                        buffer = []
                yield _batch(buffer)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_ARROW_SCHEMA)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _ARROW_SCHEMA)], schema=_ARROW_SCHEMA
    )


class _Collector:
    """Expat callbacks that gather the child texts of every open row."""

    def __init__(self, wanted: frozenset[str], parser, skipped: int) -> None:
        self.wanted, self.parser, self.skipped = wanted, parser, skipped
        self.path: list[_Open] = []
        self.done: list[tuple] = []
        self.elements = 0  # elements closed since the last row was handed out

    def start(self, name: str, _attributes) -> None:
        if self.path:
            self.path[-1].leading = False
        self.path.append(opened := _Open(name.rsplit("}", 1)[-1]))
        if opened.fields is not None:
            opened.place = self.place()

    def place(self) -> tuple[int, int]:
        """Byte offset and line of what the parser is at."""
        return self.parser.CurrentByteIndex + self.skipped, self.parser.CurrentLineNumber

    def text(self, data: str) -> None:
        if self.path and self.path[-1].leading:
            self.path[-1].text += data

    def end(self, _name: str) -> None:
        closed = self.path.pop()
        self.elements += 1
        if closed.fields is not None:
            self.done.append(("ok", closed.name, 0, self.elements, list(closed.fields.items()), closed.place))
            self.elements = 0
        parent = self.path[-1] if self.path else None
        if parent is not None and parent.fields is not None:
            child = closed.name.lower()
            if child in self.wanted:
                parent.fields[child] = closed.text.strip()


class _Open:
    """An element that is not closed yet; only text before its first child counts."""

    __slots__ = ("name", "text", "leading", "fields", "place")

    def __init__(self, name: str) -> None:
        self.name = name
        self.text = ""
        self.leading = True
        self.fields = {} if name.startswith("t_") else None


def _rows(stream: BinaryIO, wanted: frozenset[str]) -> Iterator[tuple]:
    """(status, tag, depth, elements, fields, (offset, line)) per row, then one entry for the rest."""
    seen, parser, fault, place = None, None, None, (None, None)
    try:
        head = stream.read(READ_BYTES)
        encoding = encoding_of(head)
        decoder = codecs.getincrementaldecoder(encoding)()
        parser = expat.ParserCreate("utf-8", namespace_separator="}")
        seen = _Collector(wanted, parser, len(codecs.BOM_UTF8) if head.startswith(codecs.BOM_UTF8) else 0)
        parser.buffer_text = True
        parser.StartElementHandler = seen.start
        parser.EndElementHandler = seen.end
        parser.CharacterDataHandler = seen.text
        data = head
        while data:
            parser.Parse(decoder.decode(data).encode(), False)
            yield from seen.done
            seen.done = []
            data = stream.read(READ_BYTES)
        parser.Parse(decoder.decode(b"", True).encode(), True)
    except expat.ExpatError:
        fault, place = BAD_DOCUMENT, (parser.ErrorByteIndex + seen.skipped, parser.ErrorLineNumber)
    except UnicodeDecodeError:
        fault = BAD_DOCUMENT
    except Exception as error:  # noqa: BLE001 - raised again unless it is a fault of the file
        if (fault := fault_of(error)) is None:
            raise
    yield from seen.done if seen else ()
    yield (fault or "outside", None, 0, seen.elements if seen else 0, None, place)
