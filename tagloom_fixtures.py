"""XML and ZIP documents made by Spark from the Parquet test tables.

One document per partition: documents are written in parallel and grow in size
with the tables. Every document mixes all the given row elements. What is shuffled for that are the columns
of the Parquet tables that rows are made of, not the rows or their XML.
"""

from __future__ import annotations

import io
import re
import shutil
import sys
import uuid
import zipfile
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tagloom.plans.workspace import shared_folder
from tagloom.sources import packed
from tagloom.sources.documents import list_files, open_file

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FILES = 8
NAMESPACE = "urn:example:solution"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def guid(key: Column) -> Column:
    digest = F.md5(key.cast("string"))
    ends = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digest, a, n) for a, n in ends])


#: Columns of the tables that rows are made of.
USED = {
    "part": ("p_partkey", "p_name", "p_size"),
    "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"),
    "lineitem": ("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"),
    "supplier": ("s_suppkey",),
}
#: The children of rows by tag and name; made from the columns above.
Shapes = dict[str, dict[str, Column]]


def _used(spark: SparkSession, sf_dir: str, name: str, tag: str) -> DataFrame:
    """The columns of a table that rows are made of, as one struct in a column named as the rows' tag."""
    return table(spark, sf_dir, name).select(F.struct(*USED[name]).alias(tag))


def _object_columns() -> dict[str, Column]:
    key = F.col("p_partkey")
    return {
        "class_id": F.col("p_size").cast("string"),
        "name": F.col("p_name"),
        "category_id": F.col("p_size") % 7,
        "index": key % 100,
        "object_id": key,
        "show": F.when(key % 3 == 0, "true").when(key % 3 == 1, "Y").otherwise("no"),
        "GUID": F.when(key % 4 == 0, "").otherwise(guid(key)),
    }


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _objects(spark, sf_dir, _object_columns())


def _objects(spark: SparkSession, sf_dir: str, columns: dict[str, Column]) -> DataFrame:
    return _texts(_used(spark, sf_dir, "part", "t_object"), {"t_object": columns})


def bad_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with an undeclared child and, some of them, violations.

    Every 10th lacks its name, every 11th has no number as class_id, every 13th an
    empty category_id, and every 17th an index past the range.
    """
    key = F.col("p_partkey")
    columns = _object_columns()
    columns["name"] = F.when(key % 10 != 0, columns["name"])
    columns["class_id"] = F.when(key % 11 == 0, "abc").otherwise(columns["class_id"])
    columns["category_id"] = F.when(key % 13 == 0, "").otherwise(columns["category_id"].cast("string"))
    columns["index"] = F.when(key % 17 == 0, "3000000000").otherwise(columns["index"].cast("string"))
    columns["note"] = F.lit("not declared")
    return _objects(spark, sf_dir, columns)


def malformed_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three of ten rows are not well formed.

    A child nobody declared holds tags that do not match, or has a prefix nobody declared, or there is a
    comment with two hyphens in it.
    """
    faults = {0: "<a><b></a></b>", 3: "<!-- a -- b -->", 5: "<q:a/>"}
    value = F.col("value")
    for digit, fault in faults.items():
        broken = F.replace("value", F.lit("</t_object>"), F.lit(f"{fault}</t_object>"))
        value = F.when(F.col("value").rlike(rf"<object_id>\d*{digit}</object_id>"), broken).otherwise(value)
    return objects(spark, sf_dir).select(value.alias("value"))


def spelled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of two tables, each with GUID or guid."""
    key = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select(
        F.explode(F.array(F.lit("t_a"), F.lit("t_b"))).alias("tag"),
        F.when(key % 2 == 0, "GUID").otherwise("guid").alias("child"),
        key.cast("string").alias("key"),
    )
    text = "format_string('<%1$s><key>%3$s</key><%2$s>g%3$s</%2$s></%1$s>', tag, child, key)"
    return rows.repartition(FILES, "tag", "key").select(F.expr(text).alias("value"))


def odd_documents(spark: SparkSession, sf_dir: str) -> list[str]:
    """Folders that hold the objects among them in documents that cannot simply be cut.

    A fourth each: plain, with a prefix, with a copy of every row in a comment, and inside
    further elements.
    """
    rows = objects(spark, sf_dir).withColumn(
        "k", F.regexp_extract("value", r"<object_id>(\d+)<", 1).cast("bigint") % 4
    )
    part = [rows.filter(F.col("k") == k).select("value") for k in range(4)]
    hidden = F.concat(F.lit("<!-- "), "value", F.lit(" -->"), "value")
    inside = F.concat(F.lit("<part><list>"), "value", F.lit("</list></part>"))
    return [
        write_documents(part[0]),
        write_documents(prefixed(part[1], "s"), prefix="s"),
        write_documents(part[2].select(hidden.alias("value"))),
        write_documents(part[3].select(inside.alias("value"))),
    ]


def numbered_documents(rows: DataFrame) -> str:
    """Documents by the column `file`, with the rows in `value` in order of `at`; the folder has one folder for each."""
    folder = fresh_folder(rows.sparkSession, "xml")
    end = lambda at, tag: F.struct(F.lit(at).cast("bigint").alias("at"), F.lit(tag).alias("value"))
    ends = F.explode(F.array(end(-1, "<SolutionDataset>"), end(1 << 60, "</SolutionDataset>"))).alias("e")
    whole = rows.unionByName(rows.select("file").distinct().select("file", ends).select("file", "e.at", "e.value"))
    ordered = whole.repartition(FILES, "file").sortWithinPartitions("file", "at")
    ordered.select("file", "value").write.partitionBy("file").text(folder)
    return folder


def faulty_archives(spark: SparkSession, sf_dir: str, member: str) -> str:
    """The objects by key modulo FILES in as many archives, of which all but the first and the last have a fault of their own."""
    key = F.regexp_extract("value", r"<object_id>(\d+)<", 1).cast("bigint")
    target = re.sub("^file:(//)?", "", fresh_folder(spark, "zip"))

    def archive(k: int, text: bytes) -> bytes:
        if k == 5:
            text = b""
        elif k == 6:
            text = b'<?xml version="1.0" encoding="klingon"?>' + text
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as packed:
            packed.writestr("Other.xml" if k == 3 else member, text)
        data = bytearray(out.getvalue())
        # flags and method stand in the local header and in the directory
        for mark, flags in ((b"PK\x03\x04", 6), (b"PK\x01\x02", 8)):
            at = data.index(mark) + flags
            data[at] |= k == 1
            data[at + 2] = 97 if k == 2 else data[at + 2]
        return bytes(data[: len(data) // 2] if k == 4 else data)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(target)
        system.create_dir(base)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                k = int(re.search(r"/file=(\d+)/", path)[1])
                with open_file(path) as document, system.open_output_stream(f"{base}/{k}.zip") as out:
                    out.write(archive(k, document.read()))
                yield pa.RecordBatch.from_pydict({"path": [f"{base}/{k}.zip"]})

    def write() -> str:
        rows = objects(spark, sf_dir).select((key % FILES).alias("file"), key.alias("at"), "value")
        list_files(spark, numbered_documents(rows), "*.txt").select("path").mapInArrow(pack, "path string").count()
        return target

    return cached(spark, sf_dir, f"faulty/{member}", write)


def alternating_documents(spark: SparkSession, sf_dir: str) -> str:
    """Suppliers in order of their keys, as rows of two unknown tables by turns; documents by key modulo FILES.

    Objects are between them.
    """

    def text() -> str:
        key = F.col("s_suppkey")
        tag = F.when(key % 5 < 2, "t_band").otherwise("t_zone")
        row = F.concat(F.lit("<"), tag, F.lit("><id>"), key, F.lit("</id></"), tag, F.lit(">"))
        known = F.concat(F.lit("<t_key><key_id>"), key, F.lit("</key_id></t_key>"))
        both = F.concat(row, F.lit("\n"), F.when(key % 3 == 0, known).otherwise(""))
        return numbered_documents(
            table(spark, sf_dir, "supplier").select((key % FILES).alias("file"), key.cast("bigint").alias("at"), both.alias("value"))
        )

    return cached(spark, sf_dir, "alternating", text)


def unfinished_documents(spark: SparkSession, sf_dir: str) -> str:
    """The objects in documents whose root has no end tag."""
    return write_documents(objects(spark, sf_dir), ended=False)


def rows_at(spark: SparkSession, folder: str, rejects: DataFrame, piece: int = 1 << 20) -> DataFrame:
    """`rejects` with `there`, the text at their offset as long as they are, and `line_there`, the line it is in.

    Found in the bytes of the documents, in pieces of a fixed size: line ends are counted by piece and summed up before each
    piece, and a task that has the rejects of a piece reads that piece and what its last row needs behind it.
    """
    number = F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.expr(f"(length - 1) div {piece}")))).alias("piece")
    pieces = list_files(spark, folder).select("source", "path", number).repartition("source", "piece")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = []
            for path, k in zip(batch.column("path").to_pylist(), batch.column("piece").to_pylist()):
                with open_file(path) as document:
                    document.seek(k * piece)
                    ends.append(document.read(piece).count(b"\n"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends, pa.int64())], ["source", "path", "piece", "ends"])

    counted = pieces.mapInArrow(count, "source string, path string, piece bigint, ends bigint")
    earlier = Window.partitionBy("source").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    bases = counted.select("source", "path", "piece", F.coalesce(F.sum("ends").over(earlier), F.lit(0)).alias("base"))
    asked = rejects.withColumn("piece", F.expr(f"offset div {piece}")).join(bases, ["source", "piece"])
    asked = asked.select("path", "piece", "base", "offset", "line", "row_xml").repartition("path", "piece")
    asked = asked.sortWithinPartitions("path", "piece", "offset")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, data, seen, lines = None, b"", 0, 0
        for batch in batches:
            there, line_there = [], []
            for row in batch.to_pylist():
                start, size = row["offset"] - row["piece"] * piece, len(row["row_xml"].encode())
                if held != (row["path"], row["piece"]):
                    held, seen, lines = (row["path"], row["piece"]), 0, row["base"]
                    with open_file(row["path"]) as document:
                        document.seek(row["piece"] * piece)
                        data = document.read(piece)
                text = data[start : start + size]
                if start + size > piece:
                    with open_file(row["path"]) as document:
                        document.seek(row["offset"])
                        text = document.read(size)
                lines += data.count(b"\n", seen, start)
                seen = start
                there.append(text.decode("utf-8", "replace"))
                line_there.append(lines + 1)
            columns = [*(batch.column(c) for c in ("line", "row_xml")), pa.array(there, pa.string()), pa.array(line_there, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["line", "row_xml", "there", "line_there"])

    return asked.mapInArrow(look, "line bigint, row_xml string, there string, line_there bigint")


def odd_guid_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GUIDs in braces, upper case, without hyphens, and malformed ones."""
    key = F.col("p_partkey")
    good = guid(key)
    columns = _object_columns()
    columns["GUID"] = (
        F.when(key % 5 == 0, F.concat(F.lit("{"), good, F.lit("}")))
        .when(key % 5 == 1, F.upper(good))
        .when(key % 5 == 2, F.replace(good, F.lit("-"), F.lit("")))
        .when(key % 5 == 3, F.concat(F.lit("nope-"), key.cast("string")))
        .otherwise(good)
    )
    return _objects(spark, sf_dir, columns)


def _property_columns() -> dict[str, Column]:
    order, cust = F.col("o_orderkey"), F.col("o_custkey")
    flag = lambda n: F.when(order % n == 0, "1").otherwise("0")
    return {
        "property_id": order,
        "collection_id": cust,
        "enum_id": F.when(order % 5 == 0, None)
        .when(order % 5 == 1, "")
        .otherwise((order % 9).cast("string")),
        "name": F.col("o_orderpriority"),
        "summary_name": F.col("o_orderstatus"),
        "unit_id": cust % 11,
        "summary_unit_id": cust % 13,
        "is_multi_band": flag(2),
        "is_period": flag(3),
        "is_summary": flag(4),
        "lang_id": order % 6,
    }


def properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(_used(spark, sf_dir, "orders", "t_property"), {"t_property": _property_columns()})


def _key_columns() -> dict[str, Column]:
    return {
        "key_id": F.col("l_orderkey") * 10 + F.col("l_linenumber"),
        "membership_id": F.col("l_suppkey"),
        "phase_id": F.col("l_linenumber"),
        "property_id": F.col("l_partkey"),
        "period_type_id": F.col("l_linenumber") % 5,
    }


def keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(_used(spark, sf_dir, "lineitem", "t_key"), {"t_key": _key_columns()})


def everything(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of all tables, one of them a table that the default registry does not know."""
    shapes = {
        "t_object": _object_columns(),
        "t_property": _property_columns(),
        "t_key": _key_columns(),
        "t_band": {"band_id": F.col("s_suppkey")},
    }
    parts = [_used(spark, sf_dir, name, tag) for name, tag in zip(("part", "orders", "lineitem", "supplier"), shapes)]
    return _texts(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), shapes)


def _texts(rows: DataFrame, shapes: Shapes | None = None) -> DataFrame:
    """Rows of one or several tables, dealt to FILES partitions, then shaped and written out as XML.

    `rows` has a struct for each tag; a tag's children are made from its fields by `shapes`, or are these fields.
    """
    dealt = rows.repartition(FILES, *rows.columns)
    if shapes:
        flat = dealt.select("*", *[f"{tag}.*" for tag in shapes])
        dealt = flat.select(
            *[F.when(F.col(tag).isNotNull(), F.struct(*[c.alias(n) for n, c in shapes[tag].items()])).alias(tag) for tag in shapes]
        )
    texts = [F.when(F.col(f.name).isNotNull(), _element(f.name, f.dataType.fields)) for f in dealt.schema]
    return dealt.select(F.coalesce(*texts).alias("value"))


def _element(tag: str, fields: list[T.StructField]) -> Column:
    """What `to_xml` makes of a struct of numbers and texts, several times as fast; a NULL has no element."""
    children = []
    for field in fields:
        value = F.col(tag)[field.name]
        if isinstance(field.dataType, T.StringType):
            for char, entity in (("&", "&amp;"), ("<", "&lt;"), ("]]>", "]]&gt;")):
                value = F.replace(value, F.lit(char), F.lit(entity))
        children.append(F.concat(F.lit(f"    <{field.name}>"), value.cast("string"), F.lit(f"</{field.name}>")))
    return F.concat_ws("\n", F.lit(f"<{tag}>"), *children, F.lit(f"</{tag}>"))


def prefixed(rows: DataFrame, prefix: str) -> DataFrame:
    """The same rows with a namespace prefix on every tag."""
    return rows.select(F.regexp_replace("value", r"<(/?)(\w)", rf"<$1{prefix}:$2").alias("value"))


def fresh_folder(spark: SparkSession, what: str) -> str:
    return f"{shared_folder(spark)}/tagloom_{what}_{uuid.uuid4().hex[:12]}"


def _around(prefix: str = "") -> tuple[str, str]:
    """What stands before and behind the rows of a document."""
    root = f"{prefix}:SolutionDataset" if prefix else "SolutionDataset"
    declared = f"xmlns:{prefix}" if prefix else "xmlns"
    return f'<?xml version="1.0" encoding="utf-8"?>\n<{root} {declared}="{NAMESPACE}">', f"</{root}>"


def write_documents(rows: DataFrame, files: int | None = None, prefix: str = "", ended: bool = True) -> str:
    """Write XML documents into a fresh folder and return it; those that are not `ended` lack the end tag of their root.

    One document per partition of `rows`, or `files` documents. The rows are dealt by their hash, so that nothing is sorted
    for the deal to be the same in a repeated task.
    """
    folder = fresh_folder(rows.sparkSession, "xml")
    opening, closing = _around(prefix)

    def wrap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"value": [opening]})
        for batch in batches:
            yield pa.RecordBatch.from_arrays(batch.columns, ["value"])
        if ended:
            yield pa.RecordBatch.from_pydict({"value": [closing]})

    dealt = rows if files is None else rows.repartition(files, "value")
    dealt.mapInArrow(wrap, "value string").write.text(folder)
    return folder


def zip_documents(rows: DataFrame, member: str) -> str:
    """Write a document per partition of `rows` into a ZIP file of its own; return the folder."""
    target = re.sub("^file:(//)?", "", fresh_folder(rows.sparkSession, "zip"))
    opening, closing = _around()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(target)
        system.create_dir(base)
        name = f"{base}/{TaskContext.get().partitionId()}.zip"  # a repeated task replaces its own
        with system.open_output_stream(name) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
            with archive.open(member, "w", force_zip64=True) as inside:
                inside.write(f"{opening}\n".encode())
                for batch in batches:
                    inside.write("".join(f"{text}\n" for text in batch.column(0).to_pylist()).encode())
                inside.write(f"{closing}\n".encode())
        yield pa.RecordBatch.from_pydict({"path": [name]})

    rows.mapInArrow(pack, "path string").count()
    return target


def packed_documents(rows: DataFrame) -> str:
    """Write the documents that `write_documents` writes, packed by gzip in blocks, so that they can be read in parallel."""
    target = re.sub("^file:(//)?", "", fresh_folder(rows.sparkSession, "gz"))
    opening, closing = _around()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(target)
        system.create_dir(base)
        name = f"{base}/part-{TaskContext.get().partitionId():05d}.xml.gz"  # a repeated task replaces its own
        held = bytearray(f"{opening}\n".encode())
        with system.open_output_stream(name, compression=None) as out:

            def put(last: bool = False) -> None:
                whole = memoryview(bytes(held))
                end = len(whole) if last else len(whole) // packed.MOST_TEXT * packed.MOST_TEXT
                for at in range(0, end, packed.MOST_TEXT):
                    out.write(packed.block(bytes(whole[at : min(end, at + packed.MOST_TEXT)])))
                del held[:end]

            for batch in batches:
                held.extend("".join(f"{text}\n" for text in batch.column(0).to_pylist()).encode())
                put()
            held.extend(f"{closing}\n".encode())
            put(last=True)
            out.write(packed.LAST_BLOCK)
        yield pa.RecordBatch.from_pydict({"path": [name]})

    rows.mapInArrow(pack, "path string").count()
    return target


def shared_archives(spark: SparkSession, sf_dir: str, make: Callable, archives: int = 2) -> str:
    """Folder of a few ZIP files, each with several of the documents as members and one that is no document."""
    folder, target = documents(spark, sf_dir, make), re.sub("^file:(//)?", "", fresh_folder(spark, "zip"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(target)
        system.create_dir(base)
        paths = [p for batch in batches for p in batch.column("path").to_pylist()]
        name = f"{base}/{TaskContext.get().partitionId()}.zip"  # a repeated task replaces its own
        with system.open_output_stream(name) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("readme.txt", "no document")
            for path in paths:
                with open_file(path) as document:
                    with archive.open(f"{path.rsplit('/', 1)[-1]}.xml", "w", force_zip64=True) as inside:
                        shutil.copyfileobj(document, inside, 1 << 20)
        yield pa.RecordBatch.from_pydict({"path": [name]})

    def write() -> str:
        list_files(spark, folder, "*.txt").select("path").coalesce(1).repartition(archives).mapInArrow(pack, "path string").count()
        return target

    return cached(spark, sf_dir, f"{make.__name__}/shared/{archives}", write)


_made: dict[tuple[str, str, str], str] = {}


def cached(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], str]) -> str:
    """Make a folder of documents once per session and scale."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _made:
        _made[key] = make()
    return _made[key]


def documents(spark: SparkSession, sf_dir: str, make: Callable, prefix: str = "") -> str:
    """Folder of the documents of one of the row makers above; those of all tables are packed, the others are not."""

    def write() -> str:
        rows = make(spark, sf_dir)
        if make is everything and not prefix:
            return packed_documents(rows)
        return write_documents(prefixed(rows, prefix) if prefix else rows, prefix=prefix)

    return cached(spark, sf_dir, f"{make.__name__}/{prefix}", write)


def archives(spark: SparkSession, sf_dir: str, make: Callable, member: str) -> str:
    """Folder of the same documents as ZIP files, written from the rows: the plain documents need not be there."""
    return cached(
        spark, sf_dir, f"{make.__name__}/zip/{member}", lambda: zip_documents(make(spark, sf_dir), member)
    )
