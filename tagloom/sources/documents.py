"""Opening whole files inside tasks.

Used where Spark has no reader: ZIP members, documents that cannot be cut into
records, and the first bytes of plain files. One task per file; a file of any
size is opened by path and read as a stream.
"""

from __future__ import annotations

import codecs
import gzip
import re
import zipfile
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from typing import BinaryIO
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

# Status of a source that cannot be read
BAD_ARCHIVE = "bad_archive"  # not a ZIP file, or damaged, as a gzip file may be
ENCRYPTED = "encrypted_member"
UNSUPPORTED = "unsupported_compression"
MISSING = "member_missing"
UNKNOWN_ENCODING = "unknown_encoding"
BAD_DOCUMENT = "bad_document"  # not well formed, or empty

DECLARED = re.compile(rb"""^\s*<\?xml[^>]*?encoding\s*=\s*["']([\w.-]+)["']""")
GZIP_MARK = b"\x1f\x8b"
MARKS = (
    (codecs.BOM_UTF8, "utf-8-sig"),
    (codecs.BOM_UTF32_LE, "utf-32"),
    (codecs.BOM_UTF32_BE, "utf-32"),
    (codecs.BOM_UTF16_LE, "utf-16"),
    (codecs.BOM_UTF16_BE, "utf-16"),
)


def list_files(spark: SparkSession, paths: str | list[str], glob: str | None = None) -> DataFrame:
    """(source, path, length); no content is read."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(paths)
    return files.select(F.col("_metadata.file_path").alias("source"), "path", "length")


def empty_files(spark: SparkSession, paths: str | list[str], glob: str | None, read: list[str]) -> list[str]:
    """Listed files that are not among those `read`: Spark's scans leave out files of length 0."""
    plain = lambda name: re.sub("^file:/+", "/", unquote(name))
    known = {plain(name) for name in read}
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return [name for name in reader.load(paths).inputFiles() if plain(name) not in known]


def chosen_files(
    spark: SparkSession,
    paths: str | list[str],
    glob: str | None = None,
    only: DataFrame | None = None,
) -> DataFrame:
    """(source, path); `only` keeps the files named in its column `source`."""
    files = list_files(spark, paths, glob)
    if only is not None:
        files = files.join(only, "source", "left_semi")
    return files.select("source", "path")


def open_file(path: str) -> BinaryIO:
    """A seekable stream over a file; runs in a task."""
    if path.startswith("file:") or "://" not in path:
        return open(re.sub(r"^file:(//)?", "", path), "rb")
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(quote(re.sub("^s3[an]:", "s3:", path), safe="/:@"))
    return system.open_input_file(name)


@contextmanager
def opened_document(path: str) -> Iterator[tuple[BinaryIO, bool]]:
    """The content of a plain file, inflated where it is packed by gzip, and whether it is; runs in a task."""
    with open_file(path) as stream:
        packed = stream.read(len(GZIP_MARK)) == GZIP_MARK
        stream.seek(0)
        yield gzip.GzipFile(fileobj=stream) if packed else stream, packed


def fault_of(error: Exception) -> str | None:
    """The status an error while reading stands for; None for errors of other kinds."""
    if isinstance(error, (UnicodeDecodeError, zipfile.BadZipFile, gzip.BadGzipFile, zlib.error, EOFError)):
        return BAD_ARCHIVE
    if isinstance(error, LookupError):
        return UNKNOWN_ENCODING
    if isinstance(error, NotImplementedError):
        return UNSUPPORTED
    if isinstance(error, RuntimeError) and "encrypted" in str(error):
        return ENCRYPTED
    return None


def encoding_of(head: bytes) -> str:
    """Name of the encoding that the first bytes of a document tell."""
    for mark, name in MARKS:
        if head.startswith(mark):
            return name
    declared = DECLARED.match(head)
    return declared.group(1).decode("ascii") if declared else "utf-8"
