"""XML inside ZIP archives.

A deflate stream can only be read from its start, so a member is inflated by
one task. That task does nothing else: it cuts the text into blocks of a few
megabytes at row starts and passes them on. Splitting blocks into records, and
everything after it, runs in the JVM, on as many tasks as there are blocks. Blocks go to these
tasks by a shuffle of so few partitions that Spark writes each block straight to its partition's file; with more it
would hold a member's blocks in memory to order them by partition, and spill those of a large member.
"""

from __future__ import annotations

import codecs
import io
import re
from collections.abc import Iterator
from typing import BinaryIO

from pyspark.sql import DataFrame, SparkSession, functions as F

from tagloom.errors import IngestError
from tagloom.sources.documents import BAD_DOCUMENT, encoding_of, list_files
from tagloom.sources.heads import CUT, read_head
from tagloom.sources.members import read_members
from tagloom.sources.splittable import separator

ZIP_GLOB = "*.[zZ][iI][pP]"
BLOCK_BYTES = 4 * 1024 * 1024
REREAD = "reread"  # to be read as a whole


def check_member(member: str) -> None:
    if not member:
        raise IngestError("the XML member name is empty")
    if not member.lower().endswith(".xml"):
        raise IngestError(f"the member must be an .xml file: {member}")


def read_archive_records(
    spark: SparkSession,
    paths: str | list[str],
    member: str,
    prefix: str = "",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(source, split, at, source_status, record) of the members matching `member`."""
    check_member(member)
    archives = [(r.source, r.path) for r in list_files(spark, paths, ZIP_GLOB).collect()]
    if not archives:
        raise IngestError(f"no .zip file in {paths}")
    sep = separator(prefix)
    blocks = read_members(spark, archives, member, sep, block_bytes)
    # members differ in size: spread the blocks over the cluster
    blocks = blocks.hint("rebalance", spread_over(spark), "source", "block")
    records = F.posexplode_outer(F.split("text", rf"\Q{sep}\E")).alias("at", "record")
    return blocks.select("source", F.col("block").alias("split"), "source_status", records).select(
        "source", "split", F.col("at").cast("bigint").alias("at"), "source_status", "record"
    )


def spread_over(spark: SparkSession) -> int:
    """Partitions to shuffle blocks to: as many as Spark writes without holding rows, and no more than for other shuffles."""
    unheld = int(spark.sparkContext.getConf().get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    return max(1, min(unheld, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def text_blocks(stream: BinaryIO, sep: str, block_bytes: int) -> Iterator[tuple[str, str | None]]:
    """(status, text) of the blocks of a document; an empty one is a fault."""
    for number, text in enumerate(_cut(stream, sep, block_bytes)):
        if text is None:
            yield REREAD, None
        elif number == 0 and not text:
            yield BAD_DOCUMENT, None
        else:
            yield "ok", text


def _cut(stream: BinaryIO, sep: str, block_bytes: int) -> Iterator[str | None]:
    """The text in pieces; all but the first start right behind a separator or with a tag.

    A document whose root has another prefix than `sep` gives None: it is read as a whole.
    """
    first = stream.read(block_bytes)
    way, prefix, _ = read_head(io.BytesIO(_without_declaration(first)))
    if first and way == CUT and separator(prefix) != sep:
        yield None
        return
    end_sep = "</" + sep[1:]
    decoder = codecs.getincrementaldecoder(encoding_of(first))()
    held, in_rows = decoder.decode(first), False
    while data := stream.read(block_bytes):
        at = held.rfind(sep)
        if at >= 0:
            yield held[:at]
            held, in_rows = held[at + len(sep) :], True
        else:
            # text before the first row, or after the last one's end, may be cut at any tag
            end = held.find(">", held.find(end_sep)) if in_rows and end_sep in held else -1 if in_rows else 0
            at = held.rfind("<")
            if end >= 0 and at > end:
                yield held[:at]
                held, in_rows = held[at:], False
        held += decoder.decode(data)
    yield held + decoder.decode(b"", True)


def _without_declaration(first: bytes) -> bytes:
    """The first bytes as UTF-8; what they declare no longer holds."""
    text = codecs.decode(first, encoding_of(first), "ignore")
    return re.sub(r"^\ufeff?\s*<\?xml.*?\?>", "", text, count=1, flags=re.S).encode()
