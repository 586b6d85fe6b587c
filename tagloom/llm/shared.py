"""Tables of a run that later steps read more than once, in the folder all nodes share."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: ASCII white space: the bytes 20 and 09 to 0D.
BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else left alone."""
    return F.translate(text, UPPER, LOWER)


def ddl(frame: DataFrame) -> str:
    """The schema of a frame as text; back ticks in names are doubled."""
    return ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in frame.schema)


def quoted(name: str) -> str:
    """A column's name for Spark, whatever is in it."""
    return "`" + name.replace("`", "``") + "`"


def text_parts(texts: pa.Array, most: int = 4 << 20) -> Iterator[tuple[int, pa.Array]]:
    """(first row, slice) of texts, in slices of about `most` bytes or a single text."""
    lo = size = 0
    for k in range(len(texts)):
        size += len(texts[k].as_buffer() or b"")
        if size >= most or k + 1 == len(texts):
            yield lo, texts.slice(lo, k + 1 - lo)
            lo, size = k + 1, 0


def unused(columns: Iterable[str], prefix: str = "_") -> str:
    """The prefix, lengthened until no column begins with it, in whatever case."""
    while any(c.lower().startswith(prefix.lower()) for c in columns):
        prefix += "_"
    return prefix


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`; the warehouse where that is unset, unless that is the driver's own disk on a cluster."""
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if (warehouse.startswith("file:") or "://" not in warehouse) and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all nodes share")
    return warehouse


class Scratch:
    """Written tables that cut lineage and outlive executors, one folder per run.

    Frames handed out to callers read from it, so it stays until the owner of the
    shared folder clears it, as with checkpoints. `drop` removes what is no longer read.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/tagloom-llm-{uuid.uuid4().hex[:12]}"
        self.paths: dict[int, str] = {}

    def keep(self, frame: DataFrame) -> DataFrame:
        path = f"{self.root}/{len(self.paths)}"
        frame.write.parquet(path)
        kept = self.spark.read.schema(frame.schema).parquet(path)
        self.paths[len(self.paths)] = path
        kept._tagloom_path = path
        return kept

    def drop(self, frame: DataFrame) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(frame._tagloom_path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
