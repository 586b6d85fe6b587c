"""Plain XML files packed by gzip, as a Spark data source: read in parallel where they are packed in blocks.

The blocked form is that of bgzip: members of at most 64 KB, each with its packed length in its header, so a block is
found from any place of a file. A partition is a stretch of the packed bytes. Its records are those whose separator begins in
a block that begins in the stretch; for the end of the last one the task reads on into the next. A file of any other
gzip form can only be inflated from its start, and is one partition; a file that begins with a block has to consist of
them. Records are the same as those of `tagloom.sources.splittable`, whatever the blocks.
"""

from __future__ import annotations

import gzip
import io
import json
import struct
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tagloom.sources.documents import fault_of, list_files, open_file
from tagloom.sources.heads import UTF8
from tagloom.sources.members import READERS
from tagloom.sources.splittable import decoded, separator

SPLIT_BYTES = 4 * 1024 * 1024  # packed; some tens of megabytes of text
READ_BYTES = 1 << 20
RECORDS_SCHEMA = "source string, split bigint, first bigint, source_status string, records array<binary>"
#: Fixed values of the format: a header with one extra field, called BC, for the length of the block less one; the trailer; the last block.
MARK, EXTRA, HEADER, TRAILER = b"\x1f\x8b\x08\x04", b"\x06\x00BC\x02\x00", 18, 8
MOST_PACKED, MOST_TEXT = 1 << 16, 0xFF00
LAST_BLOCK = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")


def block(text: bytes, level: int = 6) -> bytes:
    """A block of at most MOST_TEXT bytes."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    data = deflate.compress(text) + deflate.flush()
    if HEADER + len(data) + TRAILER > MOST_PACKED:
        deflate = zlib.compressobj(0, zlib.DEFLATED, -15)
        data = deflate.compress(text) + deflate.flush()
    head = MARK + b"\x00\x00\x00\x00\x00\xff" + EXTRA + struct.pack("<H", HEADER + len(data) + TRAILER - 1)
    return head + data + struct.pack("<II", zlib.crc32(text), len(text))


def block_size(head: bytes) -> int | None:
    """The packed length of the block that begins so, or None if none does."""
    if len(head) < HEADER or head[:4] != MARK or head[10:16] != EXTRA:
        return None
    return struct.unpack_from("<H", head, 16)[0] + 1


def first_block(stream: BinaryIO, start: int) -> int | None:
    """The place of the first block at or after `start`; what follows it must be a block or the end of the file."""
    stream.seek(start)
    held = stream.read(2 * MOST_PACKED + HEADER)
    at = held.find(MARK)
    while at >= 0:
        if size := block_size(held[at : at + HEADER]):
            following = held[at + size : at + size + HEADER]
            if block_size(following) or not following and at + size == len(held):
                return start + at
        at = held.find(MARK, at + 1)
    if len(held) == 2 * MOST_PACKED + HEADER:
        raise zlib.error(f"no block within {len(held)} bytes after {start}")
    return None  # inside the last block


def blocks(stream: BinaryIO, at: int) -> Iterator[tuple[int, bytes]]:
    """(place, text) of the blocks from one on."""
    stream.seek(at)
    while head := stream.read(HEADER):
        size = block_size(head)
        if size is None:
            raise zlib.error(f"no block at {at}")
        body = stream.read(size - HEADER)
        if len(body) < size - HEADER:
            raise EOFError(f"the block at {at} is cut off")
        text = zlib.decompress(body[:-TRAILER], -15)
        if struct.unpack("<II", body[-TRAILER:]) != (zlib.crc32(text), len(text)):
            raise zlib.error(f"the checksum of the block at {at} does not fit")
        yield at, text
        at += size


def _inflated(stream: BinaryIO) -> Iterator[tuple[int, bytes]]:
    """The text of a file in any gzip form, all of it as from its start."""
    with gzip.GzipFile(fileobj=stream) as whole:
        while text := whole.read(READ_BYTES):
            yield 0, text


def records_of(texts: Iterator[tuple[int, bytes]], end: int, sep: bytes, first: bool, batch_bytes: int = READ_BYTES) -> Iterator[list[bytes]]:
    """Records whose separator begins in the texts placed before `end`; with `first`, also what is before the first separator."""
    edge = len(sep) - 1  # so much of a separator may be in a text before
    inside, held = first, [b""]  # the record that is not over yet; outside of records, what a separator may have begun in
    waiting, size, behind = [], 0, None

    def taken() -> list[bytes]:
        nonlocal inside, held
        text = b"".join(waiting)
        if sep not in held[-1][-edge:] + text:
            held = [*held, text] if inside else [held[-1] + text]
            if len(held[-1]) < edge:
                held = [b"".join(held)]
            if not inside:
                held = [held[-1][-edge:]]
            return []
        found = (b"".join(held) + text).split(sep)
        given, inside, held = found[0 if inside else 1 : -1], True, found[-1:]
        return given

    for at, text in texts:
        if at >= end:
            behind = text
            break
        waiting.append(text)
        size += len(text)
        if size >= batch_bytes:
            yield taken()
            waiting, size = [], 0
    yield taken()
    # a separator that begins before the end is this stretch's, too; the next one ends the last record
    tail, begun = b"".join(held), 0
    own = len(tail)
    while behind is not None:
        tail, begun = tail + behind, max(0, len(tail) - edge)
        at = tail.find(sep, begun)
        if 0 <= at < own:
            if inside:
                yield [tail[:at]]
            inside, tail, own = True, tail[at + len(sep) :], 0
            at = tail.find(sep)
        if at >= own:
            tail = tail[:at]
            break
        if not inside and len(tail) >= own + edge:
            return
        behind = next((text for _, text in texts), None)
    if inside:
        yield [tail]


@dataclass(frozen=True)
class PackedFile:
    source: str
    path: str
    length: int


@dataclass
class Stretch(InputPartition):
    file: PackedFile
    start: int
    end: int
    blocked: bool


class PackedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.files = [PackedFile(*f) for f in json.loads(options["files"])]
        self.separator, self.split_bytes = options["separator"].encode(), int(options["split_bytes"])

    def partitions(self) -> list[InputPartition]:
        with ThreadPoolExecutor(READERS) as readers:
            blocked = readers.map(is_blocked, [f.path for f in self.files])
            return [s for f, is_cut in zip(self.files, blocked) for s in self._stretches(f, is_cut)]

    def _stretches(self, file: PackedFile, blocked: bool) -> Iterator[Stretch]:
        step = self.split_bytes if blocked else file.length
        for start in range(0, file.length, step):
            yield Stretch(file, start, min(start + step, file.length), blocked)

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return stretch_records(partition, self.separator)


def is_blocked(path: str) -> bool:
    with open_file(path) as stream:
        return block_size(stream.read(HEADER)) is not None


def stretch_records(stretch: Stretch, sep: bytes) -> Iterator[pa.RecordBatch]:
    """The records of a stretch; a file that cannot be inflated gives a line that says so, behind the records found before."""
    number = 0
    try:
        with open_file(stretch.file.path) as raw, io.BufferedReader(raw, READ_BYTES) as stream:
            start = first_block(stream, stretch.start) if stretch.blocked and stretch.start else stretch.start
            if start is None or start >= stretch.end:
                return
            texts = blocks(stream, start) if stretch.blocked else _inflated(stream)
            for records in records_of(texts, stretch.end, sep, stretch.start == 0):
                if records:
                    yield _batch(stretch, number, records, "ok")
                    number += len(records)
    except Exception as error:  # noqa: BLE001 - raised again unless it is a fault of the file
        if (fault := fault_of(error)) is None:
            raise
        yield _batch(stretch, number, [None], fault)


def _batch(stretch: Stretch, number: int, records: list[bytes | None], status: str) -> pa.RecordBatch:
    columns = {
        "source": pa.array([stretch.file.source]),
        "split": pa.array([stretch.start], pa.int64()),
        "first": pa.array([number], pa.int64()),
        "source_status": pa.array([status]),
        "records": pa.ListArray.from_arrays([0, len(records)], pa.array(records, pa.binary())),
    }
    return pa.RecordBatch.from_pydict(columns)


class PackedDocuments(DataSource):
    """Records of gzip files, many in a line. Options: `files`, a JSON list of [source, path, length]; `separator`; `split_bytes`."""

    @classmethod
    def name(cls) -> str:
        return "tagloom_packed"

    def schema(self) -> str:
        return RECORDS_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return PackedReader(dict(self.options))


def read_packed_records(
    spark: SparkSession, paths: str | list[str], prefix: str = "", encoding: str = UTF8, split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """(source, split, at, source_status, record) of gzip files, as `read_records` gives them of plain ones."""
    files = [(r.source, r.path, r.length) for r in list_files(spark, paths).collect()]
    spark.dataSource.register(PackedDocuments)
    options = {"files": json.dumps(files), "separator": separator(prefix), "split_bytes": split_bytes}
    raw = spark.read.format(PackedDocuments.name()).options(**options).load()
    lines = raw.select("source", "split", "first", "source_status", F.posexplode("records").alias("k", "record"))
    text = F.col("record").cast("string") if encoding == UTF8 else decoded(F.col("record"), encoding)
    return lines.select("source", "split", (F.col("first") + F.col("k")).alias("at"), "source_status", text.alias("record"))
