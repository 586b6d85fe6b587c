"""ZIP archives as a Spark data source: a task for each member, whatever archive it is in.

Planning reads only the directories at the ends of the archives, many at a time, as Spark does
when it lists files. A partition is a member: its archive, the place of its data and how it is packed. A
task seeks there and inflates that member alone, so an archive of fifty members is read by
fifty tasks. Beyond MOST_PARTITIONS members, several share a partition, packed by size.
"""

from __future__ import annotations

import fnmatch
import heapq
import json
import struct
import zipfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tagloom.sources.documents import BAD_ARCHIVE, ENCRYPTED, MISSING, fault_of, open_file

BLOCK_SCHEMA = "source string, source_status string, block bigint, text string"
MOST_PARTITIONS = 10_000
READERS = 32
#: Fixed values of the format: a local header ends with the lengths of a name and of extra fields.
LOCAL_HEADER, LOCAL_MARK, LOCAL_BYTES = "<4s22xHH", b"PK\x03\x04", 30


@dataclass(frozen=True)
class Member:
    """A member of an archive, or in its place what is wrong with it."""

    source: str
    path: str
    status: str = "ok"
    name: str = ""
    offset: int = 0
    method: int = 0
    packed: int = 0
    size: int = 0
    crc: int = 0
    flags: int = 0


def directory(source: str, path: str, member: str) -> list[Member]:
    """The members of an archive that are called `member` or match it, from its directory alone.

    An unreadable archive or a missing member gives one entry that says so.
    """
    try:
        with open_file(path) as raw, zipfile.ZipFile(raw) as archive:
            known = {info.filename: info for info in archive.infolist()}
    except zipfile.BadZipFile:
        return [Member(source, path, BAD_ARCHIVE)]
    names = [member] if member in known else fnmatch.filter(known, member)
    if not names:
        return [Member(source, path, MISSING)]
    infos = [known[n] for n in names]
    return [
        Member(
            f"{source}!{i.filename}", path, ENCRYPTED if i.flag_bits & 1 else "ok", i.filename, i.header_offset,
            i.compress_type, i.compress_size, i.file_size, i.CRC, i.flag_bits,
        )
        for i in infos
    ]


def opened(member: Member, raw: BinaryIO) -> BinaryIO:
    """The inflated bytes of a member; `raw` is its archive. Checks sizes and the checksum at the end."""
    raw.seek(member.offset)
    head = raw.read(LOCAL_BYTES)
    if len(head) < LOCAL_BYTES or head[:4] != LOCAL_MARK:
        raise zipfile.BadZipFile(f"no member starts at {member.offset} of {member.path}")
    _, name, extra = struct.unpack(LOCAL_HEADER, head)
    raw.seek(member.offset + LOCAL_BYTES + name + extra)
    info = zipfile.ZipInfo(member.name)
    info.header_offset, info.compress_type, info.flag_bits = member.offset, member.method, member.flags
    info.compress_size, info.file_size, info.CRC = member.packed, member.size, member.crc
    return zipfile.ZipExtFile(raw, "r", info)


def packed(members: list[Member], most: int = MOST_PARTITIONS) -> list[list[Member]]:
    """Members dealt to at most `most` partitions, the largest first, each to the one with the least so far."""
    if len(members) <= most:
        return [[m] for m in members]
    bins: list[list[Member]] = [[] for _ in range(most)]
    least = [(0, k) for k in range(most)]
    for member in sorted(members, key=lambda m: -m.packed):
        size, k = heapq.heappop(least)
        bins[k].append(member)
        heapq.heappush(least, (size + member.packed + 1, k))
    return bins


@dataclass
class Members(InputPartition):
    members: list[Member]


class MemberReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.archives = json.loads(options["archives"])
        self.member, self.separator = options["member"], options["separator"]
        self.block_bytes, self.most = int(options["block_bytes"]), int(options["partitions"])

    def partitions(self) -> list[InputPartition]:
        with ThreadPoolExecutor(READERS) as readers:
            found = readers.map(lambda a: directory(*a, self.member), self.archives)
            members = [m for listed in found for m in listed]
        return [Members(group) for group in packed(members, self.most)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        from tagloom.sources.archive import text_blocks

        for member in partition.members:
            yield from blocks_of(member, lambda stream: text_blocks(stream, self.separator, self.block_bytes))


def blocks_of(member: Member, cut) -> Iterator[pa.RecordBatch]:
    """The text blocks of one member, or its fault; `cut` gives (status, text) for a stream."""
    if member.status != "ok":
        yield _block(member.source, member.status, 0, None)
        return
    number = 0
    try:
        with open_file(member.path) as raw:
            for number, (status, text) in enumerate(cut(opened(member, raw))):
                yield _block(member.source, status, number, text)
    except Exception as error:  # noqa: BLE001 - raised again unless it is a fault of the file
        if (fault := fault_of(error)) is None:
            raise
        yield _block(member.source, fault, number + 1, None)


def _block(source: str, status: str, number: int, text: str | None) -> pa.RecordBatch:
    values = [pa.array([source]), pa.array([status]), pa.array([number], pa.int64()), pa.array([text], pa.string())]
    return pa.RecordBatch.from_arrays(values, ["source", "source_status", "block", "text"])


class ArchiveMembers(DataSource):
    """Text blocks of the members of ZIP archives.

    Options: `archives`, a JSON list of [source, path]; `member`, a name or pattern; `separator`, at which text is cut;
    `block_bytes`; `partitions`, at most.
    """

    @classmethod
    def name(cls) -> str:
        return "tagloom_members"

    def schema(self) -> str:
        return BLOCK_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return MemberReader(dict(self.options))


def read_members(
    spark: SparkSession, archives: list[tuple[str, str]], member: str, separator: str, block_bytes: int, most: int = MOST_PARTITIONS
):
    """BLOCK_SCHEMA of the members of `archives` (source, path) that match `member`."""
    spark.dataSource.register(ArchiveMembers)
    options = {"archives": json.dumps(archives), "member": member, "separator": separator, "block_bytes": block_bytes, "partitions": most}
    return spark.read.format(ArchiveMembers.name()).options(**options).load()
