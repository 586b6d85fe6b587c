"""What the first bytes of plain files tell: how each is to be read.

A file is read up to the start tag of its root element, however far that is, by a
task that opens it by path. Only names come back to the driver, as they do when
Spark lists files.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import SparkSession

from tagloom.sources.documents import empty_files, encoding_of, fault_of, list_files, opened_document

READ_BYTES = 1 << 16
CUT, PACKED, WHOLE = "cut", "packed", "whole"
ROOT = re.compile(rb"<(?:([A-Za-z_][\w.-]*):)?[A-Za-z_\x80-\xff][^\s/>:]*[\s/>]")
ASCII_BASED = ("utf-8", "utf8", "utf-8-sig", "us-ascii", "ascii")


#: Encodings of one byte a character that agree with ASCII, by their names in Python.
SINGLE_BYTE = {
    *(f"iso8859-{k}" for k in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 13, 14, 15, 16)),
    *(f"cp125{k}" for k in range(9)),
    *("koi8-r", "koi8-u", "mac-roman", "cp437", "cp850", "cp852", "cp866"),
}
UTF8 = "utf-8"


@dataclass
class Layout:
    """Files by the way they are read: cut at row starts, by prefix and encoding, those packed by gzip apart; as a whole; not at all."""

    cut: dict[tuple[str, str], list[str]] = field(default_factory=dict)
    packed: dict[tuple[str, str], list[str]] = field(default_factory=dict)
    whole: list[str] = field(default_factory=list)
    empty: list[str] = field(default_factory=list)


def layout(spark: SparkSession, paths: str | list[str], prefix: str | None = None) -> Layout:
    """How to read the files of `paths`; a given `prefix` is taken for all of them."""
    found = Layout()
    heads = list_files(spark, paths).mapInArrow(_heads, "source string, path string, way string, prefix string, encoding string").collect()
    found.empty = empty_files(spark, paths, None, [h.source for h in heads])
    for head in heads:
        if head.way in (CUT, PACKED):
            key = (head.prefix if prefix is None else prefix, head.encoding)
            (found.cut if head.way == CUT else found.packed).setdefault(key, []).append(head.path)
        else:
            found.whole.append(head.path)
    return found


def _heads(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ways = []
        for path in batch.column("path").to_pylist():
            with opened_document(path) as (stream, packed):
                ways.append(_packed_head(stream) if packed else read_head(stream))
        told = [pa.array(column, pa.string()) for column in (zip(*ways) if ways else [()] * 3)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("source"), batch.column("path"), *told], ["source", "path", "way", "prefix", "encoding"]
        )


def _packed_head(stream: BinaryIO) -> tuple[str, str, str]:
    """`read_head` of a gzip file; one that cannot be inflated is left to the reading as a whole, which tells its fault."""
    try:
        way, *told = read_head(stream)
    except Exception as error:  # noqa: BLE001 - raised again unless it is a fault of the file
        if fault_of(error) is None:
            raise
        return WHOLE, "", ""
    return (PACKED if way == CUT else way), *told


def cuttable(encoding: str) -> str | None:
    """The name of an encoding in which files can be cut at bytes, or None."""
    if encoding.lower() in ASCII_BASED:
        return UTF8
    try:
        name = codecs.lookup(encoding).name
    except LookupError:
        return None
    return name if name in SINGLE_BYTE else None


def read_head(stream: BinaryIO) -> tuple[str, str, str]:
    """(way, prefix of the root, encoding). Whole: wide or unknown encodings, a DOCTYPE, or no root in sight."""
    held = stream.read(READ_BYTES)
    encoding = cuttable(encoding_of(held))
    whole = WHOLE, "", ""
    if encoding is None or b"\x00" in held[:4]:
        return whole
    at = 3 if held.startswith(b"\xef\xbb\xbf") else 0
    while True:
        at = re.compile(rb"\s*").match(held, at).end()
        end = None
        if held.startswith(b"<?", at):
            end = held.find(b"?>", at)
        elif held.startswith(b"<!--", at):
            end = held.find(b"-->", at)
        elif root := ROOT.match(held, at):
            return CUT, (root.group(1) or b"").decode("ascii"), encoding
        elif len(held) - at > 9 and not (held[at : at + 1] == b"<" and re.match(rb"<[^\s/>]*\Z", held[at:])):
            return whole
        if end is not None and end >= 0:
            at = held.index(b">", end) + 1
            continue
        data = stream.read(READ_BYTES)
        if not data:
            return whole
        held, at = held[at:] + data, 0
