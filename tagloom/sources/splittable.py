"""Plain XML files, read in parallel.

The text source cuts a file at every ``<t_``, so one large file is spread over
many tasks. A record then is one whole row element without those three
characters, its end tag included::

    object><class_id>1</class_id> ... </t_object>\\n

followed by whatever stands between this row and the next. The first record of
a file is what precedes the first row. Because a record carries its own end
tag, a mismatched or missing end tag is visible in the record itself.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tagloom.errors import IngestError
from tagloom.sources.heads import UTF8

PREFIX_SHAPE = re.compile(r"^[A-Za-z_][\w.-]*$")


def separator(prefix: str = "") -> str:
    """What rows start with; `prefix` is the namespace prefix of the document, if any."""
    if prefix and not PREFIX_SHAPE.match(prefix):
        raise IngestError(f"not a namespace prefix: {prefix!r}")
    return f"<{prefix}:t_" if prefix else "<t_"


def decoded(value: Column, encoding: str) -> Column:
    """Text of bytes in an encoding of one byte a character; a byte that stands for nothing becomes U+0001, which XML forbids."""
    upper = bytes(range(0x80, 0x100))
    table = "".join(bytes([b]).decode(encoding, "replace").replace("\ufffd", "\x01") for b in upper)
    return F.translate(F.decode(value.cast("binary"), "ISO-8859-1"), upper.decode("latin-1"), table)


def read_records(spark: SparkSession, paths: str | list[str], prefix: str = "", encoding: str = UTF8) -> DataFrame:
    """(source, split, at, source_status, record) of XML files; `split` and `at` order a file's records.

    The separator is ASCII, so files in encodings of one byte a character are cut like those in UTF-8, and their
    records are decoded in the JVM.
    """
    raw = spark.read.option("lineSep", separator(prefix)).text(paths)
    value = F.col("value")
    return raw.select(
        F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"),
        F.lit("ok").alias("source_status"),
        (value if encoding == UTF8 else decoded(value, encoding)).alias("record"),
    )
